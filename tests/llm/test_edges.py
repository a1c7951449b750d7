"""Nulls, empty and very long texts, ties and repeated rows, empty tables and clashing column names, for every operator."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hackstand.llm import (op1_fertility_rules as op1, op2_sentence_spans as op2, op3_byte_convnet as op3, op4_repair_ids as op4, op5_boosted_pii as op5, op6_bloom_lm as op6,
                           op7_sampled_splitters as op7, op8_multi_order_join as op8, op9_nnls_packing as op9, op10_spaced_seeds as op10, repair)
from hackstand.llm.common import shared_path

LONG = " ".join(f"w{i * 7919 % 5003}x. Then" for i in range(40_000))
SAME = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen. And so on it goes. Call +1 (778) 555-8933 now."
ROWS = [(1, SAME, "en"), (1, SAME, "en"), (2, SAME, None), (2, "other text of the same id. " * 3, "en"), (3, None, "en"), (4, "", ""), (None, "no id at all here", "en"),
        (None, None, None), (5, " \n\t ", "de"), (6, LONG, "en"), (7, "x", "en"), (8, "é" * 300, None)]
CLASH = "id long, body string, lang string, row long, doc_id string, text long, s string, h string, words string, seed int, shard int, size string, _row int, _hit int, label int, n_chars long"


@pytest.fixture(scope="module")
def full(spark):
    rows = [(i, t, g, 1, "a", 2, "b", "c", "d", 3, 4, "e", 5, 6, 7, 8) for i, t, g in ROWS]
    return spark.createDataFrame(rows, CLASH)


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, SAME), (2, None), (3, "short item"), (None, "one two three four five six seven eight nine ten eleven zwölf thirteen fourteen")], "item_id long, text string")


def labels(spark):
    return spark.createDataFrame([(1, 1), (1, 0), (2, 0), (None, 1), (6, 1), (7, None)], "doc_id long, quality int")


OPS = {
    "op1": lambda s, d, b: op1.apply_rules(d, id_col="id", text_col="body"),
    "op2": lambda s, d, b: op2.drop_repeated_spans(d, "id", "body"),
    "op3": lambda s, d, b: op3.score(d, op3.fit(d, labels(s), "id", "body"), "id", "body"),
    "op4": lambda s, d, b: _ids(s, d),
    "op5": lambda s, d, b: op5.find(d, "id", "body", op5.fit(d, "id", "body")),
    "op6": lambda s, d, b: op6.score_texts(d, "id", "body"),
    "op7": lambda s, d, b: _shards(s, d),
    "op8": lambda s, d, b: op8.near_duplicates(d, "id", "body"),
    "op9": lambda s, d, b: op9.pack(d, "id", "body"),
    "op10": lambda s, d, b: op10.contaminated(d, b, "id", "body"),
}


def _ids(spark, df):
    path = shared_path(spark, "ids")
    op4.write_ids(df, path, "id", "body")
    return op4.read_ids(spark, path)


def _shards(spark, df):
    path = shared_path(spark, "shards")
    op7.write_shards(df, path, "id", "body")
    return op7.read_shards(spark, path)


@pytest.mark.parametrize("name", OPS)
def test_empty_table(spark, full, bench, name):
    assert OPS[name](spark, full.limit(0), bench).count() == 0


@pytest.mark.parametrize("name", OPS)
def test_every_row_has_a_result(spark, full, bench, name):
    got = OPS[name](spark, full, bench).collect()
    if name == "op9":
        whole = {}
        for r in got:
            whole.setdefault(r["doc_id"], []).append(r["length"])
        assert sum(sum(v) for v in whole.values()) == sum(r["n_tokens"] for r in OPS["op4"](spark, full, bench).collect())
    elif name == "op10":
        assert {(r["doc_id"], r["item_id"]) for r in got} == {(1, 1), (2, 1), (1, None), (2, None)}
    else:
        assert sorted(r["doc_id"] or -1 for r in got) == sorted(i or -1 for i, _, _ in ROWS)


def test_op2_first_run_stays(spark, full):
    got = sorted((r["doc_id"], r["n_removed"]) for r in op2.drop_repeated_spans(full.where("id in (1, 2)"), "id", "body").collect())
    assert got == [(1, 0), (1, 0), (2, 0), (2, 4)] or got == [(1, 0), (1, 0), (2, 0), (2, 3)]


def test_op8_groups_and_keep_one(spark, full):
    got = {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in op8.near_duplicates(full, "id", "body").collect()}
    assert got[2, max(n for i, n in got if i == 2)] == 1 and got[3, 0] == 3 and got[4, 0] == 4 and got[None, 0] is None and got[7, 1] == 7
    kept = op8.keep_one(full, "id", "body")
    assert kept.columns == full.columns
    assert {r["_row"] for r in kept.collect()} == {5}
    ids = sorted((r["id"] or -1) for r in kept.collect())
    assert ids == [-1, -1, 1, 2, 3, 4, 5, 6, 7, 8]


def test_op8_loses_no_link(spark):
    rng = np.random.default_rng(1)
    base = [[f"t{x}" for x in rng.integers(0, 400, 60)] for _ in range(12)]
    texts = []
    for k in range(240):
        words = list(base[k % 12])
        for _ in range(int(rng.integers(0, 5))):
            words[int(rng.integers(0, len(words)))] = f"t{rng.integers(0, 400)}"
        texts.append(" ".join(words[: int(rng.integers(50, 61))]))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [{tuple(w[i : i + 4]) for i in range(len(w) - 3)} for w in (t.split() for t in texts)]
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    assert {r["doc_id"]: r["component_id"] for r in op8.near_duplicates(df).collect()} == {k: root(k) for k in range(len(sets))}


def test_op10_filter_keeps_clean_rows(spark, full, bench):
    kept = op10.drop_contaminated(full, bench, "id", "body")
    assert kept.columns == full.columns and sorted((r["id"] or -1) for r in kept.collect()) == [-1, -1, 2, 3, 4, 5, 6, 7, 8]


def test_op10_tolerates_substitutions(spark, bench):
    words = SAME.split()
    words[3] = words[8] = "changed"
    docs = spark.createDataFrame([(1, "before it " + " ".join(words) + " after"), (2, "one two three four five six seven apples on a tree in the garden of my aunt")], "doc_id long, text string")
    assert {r["doc_id"] for r in op10.contaminated(docs, bench.where("item_id = 1"), seeds_per_pass=20).collect()} == {1}


def test_op5_redacts_all_columns_stay(spark, full):
    out = op5.redact(full, None, "body")
    assert out.columns == full.columns and "[PHONE]" in out.where("id = 1").first()["body"] and out.where("id = 3").first()["body"] is None


def test_op5_trees_add_disguised_spans():
    texts = [f"some words here user{k}.x{k % 7}@mail{k % 9}.example.com and {10 + k % 200}.{k % 250}.7.{k % 99} or call +1 ({200 + k % 700}) 555-{1000 + k} then {k * 37 % 977} end" for k in range(400)]
    rows = [op5.examples(t) for t in texts]
    flat = lambda part: (np.array([f for r in part for f, _ in r], float), np.array([y for r in part for _, y in r], float))
    model = op5.boost(*flat(rows[:300]))
    op5.calibrate(model, *flat(rows[300:]))
    base, added = op5.spans("please write to john.smith at mail3.example dot com today, order 2021-11 12.30", model)
    assert not base and [k for _, k, _ in added] == [0]


def test_op7_hot_key_is_split(spark):
    df = spark.createDataFrame([(5 if k % 3 else k, "x" * (50 + k % 40) + str(k)) for k in range(6000)], "doc_id long, text string")
    path = shared_path(spark, "hot")
    op7.write_shards(df, path)
    load = {r["shard"]: r["b"] for r in op7.read_shards(spark, path).groupBy("shard").agg({"size": "sum"}).withColumnRenamed("sum(size)", "b").collect()}
    assert len(load) == 24 and max(load.values()) < 1.02 * sum(load.values()) / 24


def test_repair_round_trip_and_random_access():
    rng = np.random.default_rng(3)
    for n in (1, 2, 50, 30_000):
        ids = (rng.zipf(1.4, n) % 700).astype(np.uint32)
        ends = rng.random(n) < 0.01
        ends[-1] = True
        symbols, marks, rules, lengths = repair.compress(ids, ends, 50_257)
        assert (repair.expand(symbols, rules, lengths, 50_257) == ids).all() and marks.sum() == ends.sum()
        stops, true_stops = np.flatnonzero(marks) + 1, np.flatnonzero(ends) + 1
        k = len(stops) // 2
        a, b = (stops[k - 1], true_stops[k - 1]) if k else (0, 0)
        assert (repair.expand(symbols[a : stops[k]], rules, lengths, 50_257) == ids[b : true_stops[k]]).all()
    assert len(symbols) < 0.8 * n


def test_op9_plan_tiles_every_document():
    rng = np.random.default_rng(5)
    for lengths in (np.array([1]), np.array([2048, 4096, 5000]), rng.integers(1, 9000, 4000), np.full(3000, 700), np.full(900, 1025)):
        p = op9.plan(lengths)
        order = np.lexsort((p[:, 1], p[:, 0]))
        p = p[order]
        same = p[1:, 0] == p[:-1, 0]
        assert (p[:, 2] > 0).all() and (p[1:, 1][same] == (p[:-1, 1] + p[:-1, 2])[same]).all() and (np.bincount(p[:, 0], p[:, 2], len(lengths)) == lengths).all()
        used = np.bincount(p[:, 3], p[:, 2])
        assert used.max() <= 2048 and used.sum() >= 0.99 * 2048 * (len(used) - 1)


def test_op3_learns_repetition_and_is_deterministic():
    rng = np.random.default_rng(2)
    words = ["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(300)]
    good = [" ".join(rng.choice(words, 80)) for _ in range(150)]
    bad = [" ".join(w for w in rng.choice(words, 10) for _ in range(8)) for _ in range(150)]
    y = np.array([1.0] * 150 + [0.0] * 150, np.float32)
    net = op3.train(good + bad, y, epochs=12)
    got = net.score(pa.array(good + bad))
    assert ((got >= 0.5) == y).mean() > 0.95
    assert np.allclose(net.score(pa.array(good[:3])), got[:3], atol=1e-5)


def test_op6_weights_read_every_training_token(spark, monkeypatch):
    """What the fit reads counts each training token once, however many texts there are."""
    seen = []
    fit = op6.fit_weights
    monkeypatch.setattr(op6, "fit_weights", lambda ratio, tier, n: seen.append(n.sum()) or fit(ratio, tier, n))
    df = spark.range(2500).selectExpr("id as doc_id", "concat('word', id % 7, ' next', id % 11, ' last') as text")
    assert {r["train_tokens"] for r in op6.score_texts(df).collect()} == {int(seen[0])}


def test_op6_holds_every_pair(spark, monkeypatch):
    rng = np.random.default_rng(11)
    held = [k for k in range(400) if zlib.crc32(str(k).encode()) % 10 == 0][:2]
    train = [k for k in range(400) if zlib.crc32(str(k).encode()) % 10][:40]
    words = [f"w{x}" for x in range(60)]
    texts = {k: " ".join(rng.permutation(words)) for k in train}
    once = [f"u{x}" for x in range(60)]
    texts[train[0]] = " ".join(once)  # each pair stands once in training
    texts[held[0]], texts[held[1]] = texts[train[0]], " ".join([once[0], *rng.permutation(once[1:-1]), once[-1]])
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    whole = {r["doc_id"]: r["score"] for r in op6.score_texts(df).collect()}
    assert whole[held[0]] > whole[held[1]] + 1e-4
    monkeypatch.setattr(op6, "FILTER_BYTES", 64, raising=False)
    assert {r["doc_id"]: r["score"] for r in op6.score_texts(df).collect()} == whole


def test_op1_rejects_planted_junk(spark):
    row = lambda i, chars, bits, tokens: (i, "en", 200, 900, 0, 0, 0, 4 * tokens, tokens, chars, 0.0, bits, "latin")
    good = [row(i, 4.0 + i % 11 * 0.02, 7.0 + i % 7 * 0.03, 300) for i in range(100)]
    # outside a narrow band, and alone in a cell of its length
    junk = [row(1000, 3.4, 7.1, 300), row(1001, 4.1, 6.4, 300), row(1002, 1.2, 7.1, 5000), row(1003, 4.1, 1.0, 20_000)]
    got = {r["doc_id"]: r["reason"] for r in op1.judge(spark.createDataFrame(good + junk, op1.SCHEMA)).collect()}
    assert {k: v for k, v in got.items() if v} == {1000: "chars_per_token", 1001: "token_entropy", 1002: "chars_per_token", 1003: "token_entropy"}


@pytest.mark.parametrize("span, kind", [("10-0-0-1", "IP"), ("8 . 8 . 8 . 8", "IP"), ("192-0-2-1", "IP"), ("john at mail.org", "EMAIL"), ("john at mail(dot)org", "EMAIL"), ("john at mail [dot] org", "EMAIL")])
def test_op5_proposes_short_disguises(span, kind):
    every = op5.Trees([np.zeros(0)] * op5.FEATURES, [], 9.0, [0.5] * len(op5.KINDS))
    assert op5.redacted(f"so: {span}, yes", every) == f"so: [{kind}], yes"


def test_op3_long_text_costs_one_row(spark):
    ids = [k for k in range(40) if zlib.crc32(str(k).encode()) % 3 != 1]
    df = spark.createDataFrame([(k, f"text {k}") for k in ids], "doc_id long, text string")
    first = df.where("doc_id % 2 = 0").orderBy(F.xxhash64(F.lit(3), "doc_id")).first()["doc_id"]
    df = df.withColumn("text", F.when(F.col("doc_id") == first, F.repeat(F.lit("long "), 1000)).otherwise(F.col("text")))
    assert isinstance(op3.fit(df, df.select("doc_id", (F.col("doc_id") % 2).alias("quality")), size=2000), op3.Net)


def test_op5_secrets_recall_and_precision():
    """Trees taught on some texts find planted secrets of others, with their exact ends, and leave lookalikes alone."""
    rng = random.Random(5)
    words = ["ordinary", "winter", "harbour", "letters", "number", "follow", "street", "under"]
    fill = lambda: " ".join(rng.choice(words) for _ in range(25))
    taught = [op5.examples(f"{fill()} mail jane{i}@host{i}.example or +1 555 {1000 + i} 22 {fill()}") for i in range(250)]
    flat = lambda part: (np.array([f for r in part for f, _ in r]), np.array([y for r in part for _, y in r], float))
    model = op5.boost(*flat(taught[:180]))
    op5.calibrate(model, *flat(taught[180:]))
    found = right = planted = 0
    for i in range(300):
        value = op5.made_secret(rng)
        text = f"{fill()} " + op5.ASSIGNMENTS[i % len(op5.ASSIGNMENTS)].format(n=op5.NAMES[i % len(op5.NAMES)], v=value) + f" {fill()}"
        text += f" commit {i:040x} and release-2021-{words[i % 8]}-notes {fill()}"
        at = text.index(value)
        added = op5.spans(text, model)[1]
        planted, found, right = planted + 1, found + len(added), right + ((at, 4, at + len(value)) in added)
    assert right / planted >= 0.9 and right / found >= 0.95, (planted, found, right)
    assert op5.redacted('x token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" y', model) == 'x token = "[SECRET]" y'


@pytest.mark.parametrize("kind", ["words", "runs", "noise"])
def test_grammar_leaves_no_frequent_pair_and_decodes(kind):
    rng = np.random.default_rng(5)
    ids = {"words": np.minimum(rng.zipf(1.3, 60_000), 50_000), "runs": np.repeat(rng.integers(0, 3, 900), rng.integers(1, 90, 900)),
           "noise": rng.integers(0, 200, 50_000)}[kind].astype(np.uint32)
    ends = rng.random(len(ids)) < 0.01
    ends[-1] = True
    symbols, marks, rules, lengths = repair.compress(ids, ends, 50_257)
    assert (repair.expand(symbols, rules, lengths, 50_257) == ids).all() and marks.sum() == ends.sum()
    left: dict = {}
    at = 0
    while at < len(symbols) - 1:  # pairs that do not overlap themselves, as a round counts them
        pair = (int(symbols[at]), int(symbols[at + 1]))
        if not marks[at]:
            left[pair] = left.get(pair, 0) + 1
        at += 2 if pair[0] == pair[1] and not marks[at] else 1
    assert max(left.values(), default=0) < repair.LEAST


def test_op10_texts_without_a_hit_are_not_shuffled(spark, full, bench):
    for df in (op10.contaminated(full, bench, "id", "body"), op10.drop_contaminated(full, bench, "id", "body")):
        plan = df._jdf.queryExecution().sparkPlan().toString()
        assert "LeftSemi, BuildRight" in plan or "LeftAnti, BuildRight" in plan
        assert "SortMergeJoin [xxhash64" not in plan


@pytest.mark.parametrize("postings, sizes", [(op8.BLOCK_POSTINGS, op8.BLOCK_SIZES), (3, 100)])
def test_op8_families_make_no_rows_by_pairs(spark, monkeypatch, postings, sizes):
    """Many texts of one family, each just under the threshold to all others, beside a few that link; in one block and in pairs of small ones."""
    monkeypatch.setattr(op8, "BLOCK_POSTINGS", postings)
    monkeypatch.setattr(op8, "BLOCK_SIZES", sizes)
    texts = [" ".join([f"c{x}" for x in range(100)] + [f"u{k}_{x}" for x in range(11)]) for k in range(80)]
    texts += [" ".join([f"c{x}" for x in range(100)] + [f"u{k}_{x}" for x in range(9)] + ["last", f"w{k}"]) for k in range(0, 80, 10)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    join = op8.Join(df)
    written = []
    monkeypatch.setattr(op8, "store", lambda frame, label, real=op8.store: written.append((label, real(frame, label))) or written[-1][1])
    got = {r["doc_id"]: r["component_id"] for r in join.documents().collect()}
    assert got == {k: k if k < 80 else (k - 80) * 10 for k in range(88)}
    if postings > 3:
        assert max(x.count() for label, x in written if label not in ("profile", "postings", "shared", "parts")) <= 4 * len(texts)


def test_workers_forget_other_operators_vocabularies():
    from hackstand.llm import common, tokens

    tokens.encoder(tokens.vocabulary()).encode(pa.array(["some words to keep"]))
    assert tokens._ENCODERS
    list(op8._profile(4)([]))
    assert not tokens._ENCODERS and not any(common._KEPT)


def test_op8_passes_hold_little_beside_their_texts():
    import tracemalloc

    rng = random.Random(2)
    texts = [" ".join(f"word{rng.randrange(10**6)}" for _ in range(1000)) for _ in range(600)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(600)), pa.array(range(600)), pa.array(texts)], ["row", "doc_id", "text"])
    tracemalloc.start()
    for _ in op8._profile(4)([batch]):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 8 * batch.nbytes


def test_op8_sketches_are_short_and_never_overstate():
    rng = np.random.default_rng(5)
    sets = []
    for size in (1, 40, 300, 511, 1900, 2047, 2048, 2300, 9000, 40_000):
        base = rng.integers(0, 1 << 63, size, dtype=np.uint64)
        sets += [np.unique(base), np.unique(np.append(base[size // 9 :], rng.integers(0, 1 << 63, size // 12, dtype=np.uint64)))]
    blobs = [op8.sketch(x) for x in sets]
    assert len(op8.sketch(sets[4])) <= 32
    i, j = (x.ravel() for x in np.meshgrid(np.arange(len(sets)), np.arange(len(sets))))
    true = np.array([len(np.setxor1d(sets[a], sets[b])) for a, b in zip(i, j)])
    apart = op8.Sketches(blobs).apart(i, j)
    assert (apart <= true).all()
    # sets of equal size without a common token are told apart
    other = [rng.integers(0, 1 << 63, len(x), dtype=np.uint64) for x in sets]
    both = op8.Sketches(blobs + [op8.sketch(x) for x in other])
    far = both.apart(np.arange(len(sets)), len(sets) + np.arange(len(sets)))
    sizes = np.array([len(x) for x in sets])
    assert (far[sizes > 30] > (2 * sizes - 2 * op8.overlap(sizes, sizes, 85))[sizes > 30]).all()


def test_op8_chance_meetings_move_no_text(spark):
    """Texts that share one of many posted tokens with others, and near copies of a few of them."""
    texts = [" ".join([f"u{k}_{x}" for x in range(196)] + [f"p{k // 2}_{x}" for x in range(4)]) for k in range(40)]
    texts += [t.replace("u0_7 ", "x ").replace("u5_7 ", "x ") for t in texts[:6:5]]
    join = op8.Join(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    moved = []
    join._linked, linked = (lambda cells: moved.append(cells.select("sign").distinct().count()) or linked(cells)), join._linked
    got = {r["doc_id"]: r["component_id"] for r in join.documents().collect()}
    assert got == {k: k for k in range(40)} | {40: 0, 41: 5}
    assert moved[0] <= 8
