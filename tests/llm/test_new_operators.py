"""Packing by the sum of squares, alignment of tokenizers and spelling variants against plain Python, with all edge cases."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from public_tokenizers import path
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
from hackstand.llm import common
from hackstand.llm import op11_sum_of_squares as op11
from hackstand.llm import op12_identity_map as op12
from hackstand.llm import op13_partenum_variants as op13
from hackstand.llm.word_ids import word_encoder

SF = "/root/testdata/sf0.001"
WORDS = Tokenizer.from_file(path("word_bpe_49k.json"))
A = Tokenizer.from_file(path("byte_bpe_50k.json"))
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=path("piece_bpe_32k.model"))
BYTES_A, BYTES_B = op12.bytes_of_a(A), op12.bytes_of_b(B)
SIGNS = st.one_of(st.sampled_from(list(" \n\t\r\x0b\x1c\x85\xa0　 aBéÉßİΣς'st.,!?0½1▁<|endoftext|>ẞ̌̇jJ-_é")), st.characters(codec="utf-8"))
LONG = "Long text of words, Écoutez! " * 3000
EDGES = [(1, "Some words. And more words\nNext line  two  spaces <|endoftext|> it's"), (1, "Some words. And more words\nNext line  two  spaces <|endoftext|> it's"), (2, None), (3, ""), (None, "no id"), (None, None),
         (4, " \n\t "), (5, LONG), (6, "▁ a literal sign"), (7, "x"), (8, "日本語 ａｂ é " * 40), (1, "another text of the same id")]


@pytest.fixture(scope="module")
def docs():
    return [(r["doc_id"], r["text"]) for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()]


@pytest.fixture(scope="module")
def edges(spark):
    rows = [(i, t, 1, "k", 2, "s", "w", 3, "b", 4) for i, t in EDGES]
    return spark.createDataFrame(rows, "id long, body string, key int, doc_id string, text long, letters string, word string, block int, pair string, length int")


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


# ---- op11


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=SIGNS), max_size=6))
def test_word_ids_equal_the_librarys(texts):
    texts = [*texts, None, "a <|endoftext|> B. it's <|EndOfText|>", "J̌ ǰ Ångström. U.S.A?"]
    ids, bounds = word_encoder().encode(pa.array(texts, pa.string()))
    for k, text in enumerate(texts):
        assert ids[bounds[k] : bounds[k + 1]].tolist() == WORDS.encode(text or "", add_special_tokens=False).ids


def check_packing(rows, texts, window):
    """Every piece of every document once, with its ids, and sequences without gaps; gives the number of sequences and of tokens."""
    wanted = collections.Counter()
    for i, text in texts:
        own = [*WORDS.encode(text or "", add_special_tokens=False).ids, 1]
        for k, start in enumerate(range(0, len(own), window)):
            part = own[start : start + window]
            wanted[i, k, start, len(part), crc(part)] += 1
    assert collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], r.get("ids_crc32") or zlib.crc32(r["ids"])) for r in rows) == wanted
    sequences = collections.defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= window
    return len(sequences), sum(r["length"] for r in rows)


def test_op11_query(spark, docs):
    rows = [r.asDict() for r in entry.queries()["op11_sum_of_squares"](spark, SF).collect()]
    sequences, tokens = check_packing(rows, docs, 4096)
    assert sequences <= 1.01 * tokens / 4096 + 1


def test_op11_many_groups_waste_no_more_than_one(spark, docs):
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    rows = [r.asDict() for r in op11.pack(df, window=2000, group=16).collect()]
    sequences, tokens = check_packing(rows, docs, 2000)
    one = [r.asDict() for r in op11.pack(df, window=2000, group=10_000).collect()]
    assert sequences <= 1.03 * check_packing(one, docs, 2000)[0] + 1


def test_op11_edges(spark, edges):
    rows = [r.asDict() for r in op11.pack(edges, "id", "body", window=512).collect()]
    check_packing(rows, EDGES, 512)
    assert op11.pack(edges.limit(0), "id", "body").count() == 0


def test_op11_pieces_that_cannot_share(spark):
    """Nothing fits beside anything: as many sequences as pieces, however many groups there are."""
    df = spark.createDataFrame([(k, "word " * 60) for k in range(300)], "doc_id long, text string")
    rows = op11.pack(df, window=100, group=20).collect()
    assert len({r["sequence_id"] for r in rows}) == len(rows) == 300


def plain_sum_of_squares(lengths, window):
    """Each piece tried in every open sequence, counting the squares anew."""
    gaps = []
    for size in sorted(lengths, reverse=True):
        best = None
        for k, gap in enumerate(gaps):
            if gap >= size:
                after = collections.Counter(g for g in [*gaps[:k], gap - size, *gaps[k + 1 :]] if g)
                cost = (sum(n * n for n in after.values()), gap)
                best = min(best or (cost, k), (cost, k))
        if best is None:
            gaps.append(window - size)
        else:
            gaps[best[1]] -= size
    return sorted(gaps)


def test_op11_places_by_least_squares():
    rng = random.Random(4)
    for window in (7, 20, 64):
        for _ in range(60):
            lengths = np.array([rng.randint(1, window - 1) for _ in range(rng.randint(1, 40))])
            sequence, offset, gaps = op11.place(lengths, window)
            assert sorted(gaps.tolist()) == plain_sum_of_squares(lengths.tolist(), window)
            assert (np.bincount(sequence, lengths, len(gaps)) == window - gaps).all()


# ---- op12


def plain_alignment(texts):
    counts, found = collections.Counter(), []
    for text in texts:
        want = (" " + (text or "")).encode()
        a = A.encode(" " + text, add_special_tokens=False).ids if text else []
        b = B.encode(text) if text else []
        if b"".join(BYTES_A[x] for x in a) != want or b"".join(BYTES_B[x] for x in b) != want:
            found.append((0, 0, [], ""))
            continue
        ends_a, ends_b = (np.cumsum([len(t[x]) for x in ids]).tolist() for t, ids in ((BYTES_A, a), (BYTES_B, b)))
        place, links, groups, from_a, from_b = {e: j for j, e in enumerate(ends_b)}, [], [], 0, 0
        for i, e in enumerate(ends_a):
            if e in place:
                j = place[e]
                links.append((a[i], b[j]))
                groups.append(",".join(map(str, a[from_a : i + 1])) + "|" + ",".join(map(str, b[from_b : j + 1])))
                from_a, from_b = i + 1, j + 1
        counts.update(links)
        found.append((len(a), len(b), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    best = collections.Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    rows = [(n_a, n_b, len(links), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), digest) for n_a, n_b, links, digest in found]
    return rows, counts


FIELDS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def test_op12_query(spark, docs):
    got = {r["doc_id"]: tuple(r[c] for c in FIELDS) for r in entry.queries()["op12_identity_map"](spark, SF).collect()}
    assert got == dict(zip((i for i, _ in docs), plain_alignment([t for _, t in docs])[0]))


def test_op12_edges_and_pairs(spark, edges):
    made = op12.Alignment(edges.repartition(3), "id", "body")
    rows, counts = plain_alignment([t for _, t in EDGES])
    got = collections.Counter((r["doc_id"], *(r[c] for c in FIELDS)) for r in made.documents().collect())
    assert got == collections.Counter((i, *r) for (i, _), r in zip(EDGES, rows))
    assert {(r["id_a"], r["id_b"]): r["n"] for r in made.pairs().collect()} == counts
    empty = op12.Alignment(edges.limit(0), "id", "body")
    assert empty.documents().count() == 0 and empty.pairs().count() == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=SIGNS), max_size=5))
def test_op12_segments_equal_whole_texts(texts):
    texts = [*texts, "One.Two\nThree\n\nFour   five .six", None, "▁x", " <|endoftext|><s> <0x0A>"]
    n_a, n_b, n_groups, digests, *_ = op12.aligner(path("byte_bpe_50k.json"), path("piece_bpe_32k.model")).align(pa.array(texts, pa.string()))
    assert list(zip(n_a, n_b, n_groups, digests)) == [(r[0], r[1], r[2], r[6]) for r in plain_alignment(texts)[0]]


def test_op12_loop_over_tokens_reads_no_arrays(monkeypatch):
    """An array's element costs more than the rest of a step; the loop runs once for each token of each distinct segment."""
    own = op12.aligner(path("byte_bpe_50k.json"), path("piece_bpe_32k.model"))
    monkeypatch.setattr(own, "same", None)
    for text in ("word", "two words", "Anthropomorphous  naïveté, 12345678!", "日本語 text\n\nend"):
        n_a, n_b, n_groups, groups, plain, other = own._align((" " + text).encode(), A.encode(" " + text, add_special_tokens=False).ids, B.encode(text))
        want, counts = plain_alignment([text])
        assert (n_a, n_b, n_groups, hashlib.sha256(groups).hexdigest()) == (*want[0][:3], want[0][6])
        mapped = np.frombuffer(plain, np.uint16).tolist()
        links = [(x, own.mapped[x]) for x in mapped] + [(x >> 16, x & 0xFFFF) for x in np.frombuffer(other, np.uint32).tolist()]
        assert collections.Counter(links) == counts


# ---- op13


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain_variants(texts, every=97, least_length=5, least_count=3):
    import re

    counts = collections.Counter()
    for i, text in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= least_length and n >= least_count}
    near = {w: [v for v in words if v != w and abs(len(v) - len(w)) < 2 and one_apart(v, w)] for w in words}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 2 * words[w] else None

    def root(w):
        return root(form[w]) if form[w] else w

    return {(w, form[w], root(w), n, len(near[w]), words[form[w]] if form[w] else None) for w, n in words.items()}


def variants(df, **rules):
    rows = [tuple(r) for r in op13.variants(df, **rules).select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_op13_against_all_pairs(spark):
    rng = random.Random(8)
    base = ["".join(rng.choice("abcdeéèßo") for _ in range(rng.randint(5, 8))) for _ in range(40)]

    def bent(w):
        k, c = rng.randrange(len(w)), rng.choice("abcdeéèßo")
        return rng.choice([w[:k] + w[k + 1 :], w[:k] + c + w[k:], w[:k] + c + w[k + 1 :], w])

    texts = [(k, " ".join(bent(bent(rng.choice(base))).capitalize() for _ in range(60))) for k in range(60)] + [(None, "Abcde abcde ABCDE abcdé"), (1, None), (2, ""), (3, "aaaaa aaaaab aaaaabb " * 5)]
    df = spark.createDataFrame([(t, i, 1, 2, 3) for i, t in texts], "text string, doc_id long, word int, n int, letters int")
    for rules in ({}, {"every": 3, "least_count": 1}):
        want = plain_variants(texts, **rules)
        assert variants(df, **rules) == want and len({r[2] for r in want}) < len(want)
    assert variants(df.limit(0)) == set()


def test_op13_edges(spark, edges):
    renamed = edges
    assert {tuple(r) for r in op13.variants(renamed, "id", "body", least_count=1).select("word", "form", "root", "n", "n_near", "form_n").collect()} == plain_variants(EDGES, least_count=1)


def test_op13_long_chain_of_forms(spark):
    words = ["".join(chr(97 + k) for k in range(n)) for n in range(5, 17)]
    texts = [(k, " ".join([w] * (3 * 2**n))) for k, (n, w) in enumerate(enumerate(words))]
    got = {r["word"]: r["root"] for r in op13.variants(spark.createDataFrame(texts, "doc_id long, text string"), every=1 << 40).collect()}
    assert set(got) == set(words) and set(got.values()) == {words[-1]}


def test_op13_joins_by_shuffle_alone(spark, monkeypatch):
    """Signatures are 21 rows a word out of an explode that Spark does not count: no table of words may be broadcast because its file looks small."""
    plans, keep = [], op13.store
    noted = lambda df, label="result": plans.append((label, df._jdf.queryExecution().executedPlan().toString())) or df
    monkeypatch.setattr(op13, "store", lambda df, label: keep(noted(df, label), label))
    texts = spark.createDataFrame([(k, "abcde abcdef abcdefg abcdefg abcdefg") for k in range(9)], "doc_id long, text string")
    noted(op13.variants(texts)).collect()
    assert sum(plan.count("SortMergeJoin") for _, plan in plans) >= 6 and {"forms", "roots", "result"} <= {label for label, plan in plans if "SortMergeJoin" in plan}
    assert not [label for label, plan in plans if "Broadcast" in plan]


def test_a_large_table_is_not_broadcast_for_its_small_file(spark):
    stored = common.store(spark.range(100).select(F.lit(7).alias("k"), "id"), "small")
    plans = [spark.range(9).withColumnRenamed("id", "k").join(common.if_small(stored, rows), "k")._jdf.queryExecution().executedPlan().toString() for rows in (99, 100)]
    assert ["BroadcastExchange" in p for p in plans] == [False, True] and "SortMergeJoin" in plans[0]
