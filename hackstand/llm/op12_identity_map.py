"""Alignment of two public tokenizers over a corpus, with a fast path for tokens of equal bytes.

A: a byte-level vocabulary (tokenizers library); B: pieces with byte fallback (sentencepiece). Every text is taken as a space and the
text. Byte places where tokens of both end cut it into groups; the tokens that end there are linked. For each id of A the id
of B with the same bytes is known beforehand. A group of one token each that follows this map is counted in a vector with one
place per id of A; only the links of other groups become pairs of ids and are counted by a shuffle. That shuffle takes each pair
once per block of texts, so a very common pair has few rows.

Neither vocabulary has a token across the places where texts are cut into segments (a single space before a word, a stop after a
letter, a letter after a line break), so each distinct segment is encoded and aligned once and texts are sums of segments. Whether
B's pieces allow the last two cuts is read from its vocabulary.

A first pass writes, per text, its numbers and the links it has, by block; a second gives each block the corpus-wide
counts of its pairs. Only vectors of vocabulary length go through the driver.

* Null or empty text, or one whose tokens' bytes differ from it (a literal U+2581): no tokens, zeros, empty digest; its
  tokens count nowhere. Special tokens' strings inside texts are plain text.
* Repeated rows or ids: each row counts and is answered for itself. Null ids are kept.
* Other columns are not carried. An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hackstand.llm.common import kept, narrow, store, text_slices
from hackstand.llm.tokens import _SURE as SURE
from hackstand.llm.tokens import BYTE_SIGNS, vocabulary
from hackstand.llm.word_ids import distinct, gather
from hackstand.llm.words import raw_bytes

#: Segments whose alignment a worker keeps; beyond, it forgets and starts anew. Bounds memory only.
KEPT_SEGMENTS = 200_000

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_STOP = np.zeros(256, bool)
_STOP[list(b".,;:!?")] = True
#: A word of ASCII or Latin-1 letters, perhaps after a space: one piece of A's pre-tokeniser.
_WORD = re.compile(rb" ?(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+").fullmatch

_FIRST = "kind int, block long, row int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, plain binary, other binary, pair long, n long"
_LAST = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


class Aligner:
    """Both tokenizers of a worker and the segments it has aligned; see ``aligner``."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole, self.bare = Tokenizer.from_file(path_a), Tokenizer.from_file(path_a)
        self.whole.encode_special_tokens = True
        self.bare.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_a, self.bytes_b = bytes_of_a(self.whole), bytes_of_b(self.b)
        self.same = same_bytes(self.bytes_a, [self.b.is_byte(i) for i in range(len(self.bytes_b))], self.bytes_b)
        # plain lists for the loop over tokens: an array's element costs more than the rest of a step
        self.mapped, self.size_a, self.size_b = self.same.tolist(), [len(x) for x in self.bytes_a], [len(x) for x in self.bytes_b]
        self.name = [str(i) for i in range(max(len(self.size_a), len(self.size_b)))]
        self.cut_lines = not any(b"\n" in x and len(x) > 1 for x in self.bytes_b)
        self.cut_stops = self.cut_lines and not any(re.search(rb"[A-Za-z][.,;:!?]", x) for x in self.bytes_b)
        self.kept: dict[bytes, tuple] = {}

    def _learn(self, segments: list[bytes]) -> None:
        words = [bool(_WORD(s)) for s in segments]
        texts = [s.decode() for s in segments]
        coded = {True: iter(self.bare.encode_batch_fast([t for t, w in zip(texts, words) if w], add_special_tokens=False)),
                 False: iter(self.whole.encode_batch_fast([t for t, w in zip(texts, words) if not w], add_special_tokens=False))}
        # B adds a space before a text: the segment's own, or one before a line break, which no piece shares with what follows
        pieces = self.b.encode([t[1:] if t[0] == " " else "\n" + t for t in texts], num_threads=1)
        for s, w, b in zip(segments, words, pieces):
            self.kept[s] = self._align(s, next(coded[w]).ids, b if s[0] == 0x20 else b[2:])

    def _align(self, segment: bytes, a: list[int], b: list[int]) -> tuple:
        """Numbers of tokens of A and B and of groups (-1: bytes differ), the groups as text, plain links (ids of A), other links (both ids)."""
        bytes_a, bytes_b = self.bytes_a, self.bytes_b
        if b"".join([bytes_a[x] for x in a]) != segment or b"".join([bytes_b[x] for x in b]) != segment:
            return 0, 0, -1, b"", b"", b""
        same, name, size_a, size_b = self.mapped, self.name, self.size_a, self.size_b
        groups, plain, other = [], [], []
        j = from_i = from_j = at_a = at_b = 0
        for i, x in enumerate(a, 1):
            at_a += size_a[x]
            while at_b < at_a:
                y = b[j]
                at_b += size_b[y]
                j += 1
            if at_a == at_b:
                if i - from_i == 1 and j - from_j == 1:
                    groups.append(f"{name[x]}|{name[y]}")
                    if same[x] == y:
                        plain.append(x)
                    else:
                        other.append(x << 16 | y)
                else:
                    groups.append(",".join([name[k] for k in a[from_i:i]]) + "|" + ",".join([name[k] for k in b[from_j:j]]))
                    other.append(x << 16 | y)
                from_i, from_j = i, j
        return len(a), len(b), len(groups), ";".join(groups).encode(), array("H", plain).tobytes() if plain else b"", array("I", other).tobytes() if other else b""

    def align(self, texts: pa.Array):
        """Per text: tokens of A, of B, groups, digest; then plain links and other links of all texts, each with where a text's begin."""
        raw, offsets = raw_bytes(texts)
        sizes = np.diff(offsets)
        filled = sizes > 0
        spaced = np.full(len(raw) + int(filled.sum()), 0x20, np.uint8)
        begins = np.cumsum(sizes + filled) - (sizes + filled)
        body = np.ones(len(spaced), bool)
        body[begins[filled]] = False
        spaced[body] = raw
        raw = spaced
        if not len(raw):
            none, bounds = np.zeros(len(texts), np.int64), np.zeros(len(texts) + 1, np.int64)
            return none, none, none, [""] * len(texts), np.zeros(0, np.uint16), bounds, np.zeros(0, np.uint32), bounds
        cut = np.zeros(len(raw), bool)
        cut[1:-1] = (raw[1:-1] == 0x20) & SURE[raw[:-2]] & SURE[raw[2:]]
        if self.cut_stops:
            cut[1:] |= _STOP[raw[1:]] & _LETTER[raw[:-1]]
        if self.cut_lines:
            cut[2:] |= _LETTER[raw[2:]] & (raw[1:-1] == 0x0A) & SURE[raw[:-2]]
        cut[begins[filled]] = True
        starts = np.flatnonzero(cut)
        bounds = np.searchsorted(starts, np.append(begins, len(raw)))
        segments, codes = distinct(raw, starts)
        kept = self.kept
        new = [s for s in segments if s not in kept]
        if len(kept) + len(new) > KEPT_SEGMENTS and len(new) < len(segments):
            kept.clear()
            new = segments
        self._learn(new)
        n_a, n_b, n_groups, strings, plain, other = zip(*[kept[s] for s in segments])
        good = np.ones(len(texts), bool)
        numbers = np.array([n_a, n_b, n_groups], np.int64)
        bad = numbers[2] < 0
        if bad.any():
            where = np.flatnonzero(bad[codes])
            good[np.searchsorted(bounds, where, "right") - 1] = False
            codes = codes[np.repeat(good, np.diff(bounds))]
            bounds = np.append(0, np.cumsum(np.where(good, np.diff(bounds), 0)))
        sums = np.concatenate([np.zeros((3, 1), np.int64), np.cumsum(numbers[:, codes], 1)], 1)
        totals = sums[:, bounds[1:]] - sums[:, bounds[:-1]]
        digests, listed = [], codes.tolist()
        for p, q in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            digests.append(hashlib.sha256(b";".join([strings[c] for c in listed[p:q]])).hexdigest() if q > p else "")
        plain, at_plain = gather(list(plain), codes, np.uint16)
        other, at_other = gather(list(other), codes, np.uint32)
        return *totals, digests, plain, at_plain[bounds], other, at_other[bounds]


def bytes_of_a(tokenizer) -> list[bytes]:
    """Each id's bytes in the byte-level vocabulary."""
    byte = {chr(sign): b for b, sign in BYTE_SIGNS.items()}
    out = [b""] * tokenizer.get_vocab_size()
    for token, i in tokenizer.get_vocab().items():
        out[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
    return out


def bytes_of_b(processor) -> list[bytes]:
    """Each id's bytes in the piece vocabulary."""
    pieces = [processor.id_to_piece(i) for i in range(processor.get_piece_size())]
    return [bytes([int(p[3:5], 16)]) if processor.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]


def same_bytes(bytes_a: list[bytes], fallback: list[bool], bytes_b: list[bytes]) -> np.ndarray:
    """For each id of A the id of B with the same bytes, a piece before a fallback byte; -1 for none."""
    by_bytes = {x: i for only in (True, False) for i, x in reversed(list(enumerate(bytes_b))) if fallback[i] is only}
    return np.array([by_bytes.get(x, -1) if x else -1 for x in bytes_a], np.int64)


_ALIGNERS: dict[tuple, Aligner] = kept()


def aligner(path_a: str, path_b: str) -> Aligner:
    if (path_a, path_b) not in _ALIGNERS:
        _ALIGNERS[path_a, path_b] = Aligner(path_a, path_b)
    return _ALIGNERS[path_a, path_b]


def _rows(**columns) -> pa.RecordBatch:
    names, kinds = zip(*[c.split() for c in _FIRST.split(", ")])
    types = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    count = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[c], types[k]) if c in columns else pa.nulls(count, types[k]) for c, k in zip(names, kinds)], list(names))


def _first_pass(path_a: str, path_b: str):
    """Rows of three kinds: 0, a text; 1, another link's pair of ids in a block; 2, the plain links of an id of A in the task."""

    def run(batches):
        own = aligner(path_a, path_b)
        block = TaskContext.get().partitionId() << 32
        vector = np.zeros(len(own.same), np.int64)
        for batch in batches:
            for part in text_slices(batch):
                n_a, n_b, n_groups, digests, plain, at_plain, other, at_other = own.align(part.column("text"))
                vector += np.bincount(plain, minlength=len(vector))
                pairs, place, counts = np.unique(other, return_inverse=True, return_counts=True)
                place = place.astype(np.uint32)
                k = part.num_rows
                yield _rows(kind=np.zeros(k, np.int32), block=np.full(k, block), row=np.arange(k, dtype=np.int32), doc_id=part.column("doc_id"), n_a=n_a, n_b=n_b, n_groups=n_groups,
                            n_links=n_groups, groups_sha256=digests, plain=[plain[p:q].tobytes() for p, q in zip(at_plain[:-1], at_plain[1:])],
                            other=[place[p:q].tobytes() for p, q in zip(at_other[:-1], at_other[1:])])
                k = len(pairs)
                yield _rows(kind=np.ones(k, np.int32), block=np.full(k, block), pair=pairs.astype(np.int64), n=counts)
                block += 1
        seen = np.flatnonzero(vector)
        yield _rows(kind=np.full(len(seen), 2, np.int32), pair=seen, n=vector[seen])

    return run


def _second_pass(shared):
    """A block's texts with the counts of their links."""

    def run(texts: pa.Table, pairs: pa.Table) -> pa.Table:
        plain_count, plain_best, best = shared.value
        order = np.argsort(pairs["pair"].to_numpy())
        pair, count = pairs["pair"].to_numpy()[order], pairs["n"].to_numpy()[order]
        is_best = count == best[pair & 0xFFFF]
        texts = texts.sort_by("row")
        sums = np.zeros((2, len(texts)), np.int64)
        for column, kind, numbers, hits in (("plain", np.uint16, plain_count, plain_best), ("other", np.uint32, count, is_best)):
            blobs = texts[column].to_pylist()
            ids = np.frombuffer(b"".join(blobs), kind)
            at = np.append(0, np.cumsum([len(x) for x in blobs])) // np.dtype(kind).itemsize
            for k, values in enumerate((hits, numbers)):
                run_sum = np.append(0, np.cumsum(values[ids], dtype=np.int64)) if len(ids) else np.zeros(1, np.int64)
                sums[k] += run_sum[at[1:]] - run_sum[at[:-1]]
        kept = [texts[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")]
        return pa.Table.from_arrays([*kept, pa.array(sums[0]), pa.array(sums[1]), texts["groups_sha256"]],
                                    ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    return run


class Alignment:
    """The alignment of one table: ``pairs()`` counts linked ids over the corpus, ``documents()`` answers each row."""

    def __init__(self, df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_a: str | None = None, path_b: str | None = None):
        path_a, path_b = path_a or vocabulary("byte_bpe_50k.json"), path_b or vocabulary("piece_bpe_32k.model")
        self.spark, self.same = df.sparkSession, aligner(path_a, path_b).same
        self.first = store(narrow(df, id_col, text_col).mapInArrow(_first_pass(path_a, path_b), _FIRST), "aligned")
        self.other = store(self.first.where("kind = 1").groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
        self.plain = self.first.where("kind = 2").groupBy(F.col("pair").alias("id")).agg(F.sum("n").alias("n"))

    def pairs(self) -> DataFrame:
        """id_a, id_b, n (links in the corpus) of every linked pair of ids."""
        same = self.spark.createDataFrame([(i, int(b)) for i, b in enumerate(self.same) if b >= 0], "id long, id_b long")
        plain = self.plain.join(F.broadcast(same), "id").select(F.col("id").alias("id_a"), "id_b", "n")
        return plain.unionByName(self.other.select(F.shiftright("pair", 16).alias("id_a"), F.col("pair").bitwiseAND(0xFFFF).alias("id_b"), "n"))

    def documents(self) -> DataFrame:
        """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row."""
        # at most one row per id of A and one per id of B
        plain = self.plain.toPandas()
        tops = self.other.groupBy(F.col("pair").bitwiseAND(0xFFFF).alias("id")).agg(F.max("n").alias("n")).toPandas()
        count = np.zeros(len(self.same), np.int64)
        count[plain["id"].to_numpy(np.int64)] = plain["n"].to_numpy(np.int64)
        best = np.zeros(1 << 16, np.int64)
        best[tops["id"].to_numpy(np.int64)] = tops["n"].to_numpy(np.int64)
        mapped = np.flatnonzero(self.same >= 0)
        np.maximum.at(best, self.same[mapped], count[mapped])
        shared = self.spark.sparkContext.broadcast((count, (self.same >= 0) & (count == best[self.same]), best))
        texts = self.first.where("kind = 0").select("block", "row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "plain", "other")
        answers = self.first.where("kind = 1").select(F.col("block").alias("of"), "pair").join(self.other, "pair")
        return texts.groupBy("block").cogroup(answers.groupBy("of")).applyInArrow(_second_pass(shared), _LAST)


def digest(df: DataFrame) -> DataFrame:
    return Alignment(df).documents()
