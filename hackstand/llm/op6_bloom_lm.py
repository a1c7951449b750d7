"""Language-model scores from a log-frequency Bloom filter of n-gram counts.

Documents form blocks of a few megabytes. A block's distinct words and word pairs, with their counts in training documents, meet those
of all other blocks in hash buckets, where the counts are merged. A count is quantised to a level on a log scale, and a bucket's
stretch of the filter holds one entry for each level up to it; a reader probes level after level until one is missing. The filter is
never in one place: a bucket fills its stretch, probes it for the blocks that asked, and the levels found go back to them. A pair's
probability is interpolated between the pair level and the word, with a weight per level of the first word's count, fitted by expectation
maximisation on left-out counts of all training tokens: each block counts its tokens by level and by the ratio of both probabilities on
a log scale (``STEPS`` to a doubling), and the sums of these counts are all that the fit reads.

The base score takes exact counts, which the buckets return for every word.

* Null or empty text: one token, the end. Repeated rows and ids: each row is scored (and, if in training, counted) for itself.
* A null id has no fold; it counts as training. An empty table gives an empty table; without training text every count is 0.
* Other columns are not carried.

Sizes: each stretch has ``BITS`` bits for each of its entries, so the filter grows with the n-grams and holds all of them, pairs
seen once too. The number of buckets follows the bytes of text; a task holds one bucket or one block at a time. A block travels as one
compressed row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hackstand.llm.common import SLICE_BYTES, crc_fold, narrow, small_batches, store, text_slices
from hackstand.llm.words import Words, mix

#: Words whose exact counts the model reads, at most; it reads the levels of the others.
COMMON = 1 << 18
BITS, PROBES = 10, 5
#: Least count of each level.
LEVELS = np.array([1, 2, 3, 4, 6, 8, 11, 16, 23, 32, 45, 64, 91, 128, 181, 256, 512, 1024, 2048, 4096, 8192, 16384, 1 << 15, 1 << 16, 1 << 18, 1 << 20, 1 << 24, 1 << 28])
#: What a level stands for: the middle of its counts on the log scale.
MEANS = np.append(np.sqrt(LEVELS[:-1] * (LEVELS[1:] - 1.0)), LEVELS[-1])
BUCKET_BYTES = 16 << 20
#: Ranges of a bucket's keys (a power of two).
RANGES = 8
WEIGHT_TIERS, STEPS = 28, 16

END = mix(np.array([1], np.uint64), 1001)[0]
START = mix(np.array([2], np.uint64), 1001)[0]


def token_streams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, each text's words and then the end; and where each text begins (one more at the end)."""
    words = Words(texts)
    h = words.hashes()
    sizes = np.diff(words.bounds) + 1
    bounds = np.append(0, np.cumsum(sizes))
    out = np.full(int(bounds[-1]), END, np.uint64)
    body = np.ones(len(out), bool)
    body[bounds[1:] - 1] = False
    out[body] = h
    return out, bounds


def pair_keys(tokens: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A key for each token with the one before it; a text begins with the start."""
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[bounds[:-1]] = START
    with np.errstate(over="ignore"):
        return mix(before * np.uint64(0x9E3779B97F4A7C15) + tokens, 2)


def _pack5(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def _unpack5(b: bytes) -> np.ndarray:
    out = np.zeros((len(b) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(b, np.uint8).reshape(-1, 5)
    return out.view("<u8").ravel()


#: Tells a pair's key from a word's.
PAIR = np.uint64(1 << 63)


def _places(key: np.ndarray, level: int, bits: int):
    a = mix(key, 100 + level)
    b = mix(key, 300 + level) | np.uint64(1)
    for i in range(PROBES):
        with np.errstate(over="ignore"):
            yield lambda own, i=i: ((a[own] + np.uint64(i) * b[own]) % np.uint64(bits)).astype(np.int64)


def fill(keys: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The bytes of a stretch with one entry for each level of each count."""
    entries = int(np.searchsorted(LEVELS, n, "right").sum())
    bits = max(64, -(-entries * BITS // 8) * 8)
    flags = np.zeros(bits, bool)
    for level, least in enumerate(LEVELS):
        keys, n = keys[n >= least], n[n >= least]
        if not len(keys):
            break
        everyone = np.arange(len(keys))
        for p in _places(keys, level, bits):
            flags[p(everyone)] = True
    return np.packbits(flags, bitorder="little")


def levels_held(segment: np.ndarray, key: np.ndarray) -> np.ndarray:
    """How many levels of each key a stretch holds, probed upwards; 0 for a key that it doesn't hold."""
    found = np.zeros(len(key), np.uint8)
    rest = np.arange(len(key))
    for level in range(len(LEVELS)):
        for p in _places(key, level, len(segment) * 8):
            at = p(rest)
            rest = rest[(segment[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1]
        if not len(rest):
            break
        found[rest] = level + 1
    return found


class Model:
    """What workers get: the totals, and the least count that the model reads exactly."""

    def __init__(self, n: int, v: int, texts: int, buckets: int, least: int):
        self.n, self.v, self.texts, self.buckets, self.least = n, v, texts, buckets, least

    def floor(self) -> float:
        return self.n + 0.1 * (self.v + 1)

    def parts(self, tokens: np.ndarray, bounds: np.ndarray, answers: pa.Table):
        """Per token: exact count, word probability, pair count and its history's count, and the history's tier."""
        answers = answers.sort_by("bucket")
        told = lambda c, t: np.frombuffer(b"".join(answers.column(c).to_pylist()), t)
        word_n, word_levels, pair_levels = told("word_n", "<i8"), told("word_levels", "<u1"), told("pair_levels", "<u1")
        own, _, at = asked(tokens, self.buckets)
        of_pairs, _, pair_at = asked(pair_keys(tokens, bounds), self.buckets, 24)
        if (len(own), len(own), len(of_pairs)) != (len(word_n), len(word_levels), len(pair_levels)):
            raise ValueError("the counts of a block don't belong to its n-grams")
        # the last entry of MEANS stands for level 0 too, and is not read there
        means = np.where(word_n >= self.least, word_n, np.where(word_levels > 0, MEANS[word_levels.astype(int) - 1], 0.0))
        exact, count = word_n[at], means[at]
        word = (count + 0.1) / self.floor()
        level = pair_levels[pair_at].astype(int)
        pair = np.where(level > 0, LEVELS[level - 1], 0.0)
        history = np.empty(len(tokens))
        history[1:] = count[:-1]
        history[bounds[:-1]] = max(1.0, float(self.texts))
        history = np.maximum(history, np.maximum(pair, 1.0))
        return exact, word, pair, history, np.minimum(WEIGHT_TIERS - 1, np.log2(history).astype(int))


def asked(keys: np.ndarray, buckets: int, shift: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct keys (without ``shift`` low bits) of each bucket in order: buckets and keys; and where each given key stands in them."""
    distinct, back = np.unique(keys, return_inverse=True)
    own, value = (distinct % np.uint64(buckets)).astype(np.int64), distinct >> np.uint64(shift)
    order = np.argsort(own, kind="stable")
    own, value = own[order], value[order]
    new = np.ones(len(own), bool)
    new[1:] = (own[1:] != own[:-1]) | (value[1:] != value[:-1])
    place = np.empty(len(own), np.int64)
    place[order] = np.cumsum(new) - 1
    return own[new], value[new], place[back]


def _blocks(batches):
    """One row per block of consecutive rows of a task: its number and its rows, compressed."""
    block = TaskContext.get().partitionId() << 33

    def row(held):
        table = pa.Table.from_batches(held)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_table(table.combine_chunks())
        return pa.RecordBatch.from_arrays([pa.array([block]), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["block", "docs"])

    held, size = [], 0
    for batch in batches:
        for piece in text_slices(batch):
            own = piece.column("text").nbytes
            if held and size + own > SLICE_BYTES:
                yield row(held)
                block, held, size = block + 1, [], 0
            held.append(piece)
            size += own
    if held:
        yield row(held)


def opened(docs: pa.Scalar) -> pa.Table:
    """The rows of a block."""
    return pa.ipc.open_stream(docs.as_buffer()).read_all().combine_chunks()


def _tokens(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of a block, where each text begins, and which tokens are of training texts."""
    tokens, bounds = token_streams(rows.column("text").combine_chunks())
    return tokens, bounds, np.repeat(rows.column("fold").to_numpy() != 0, np.diff(bounds))


ASKED = "bucket long, block long, words binary, word_counts binary, pairs binary, pair_counts binary, pair_more binary"


def _ask(buckets: int):
    """Rows (bucket, block, words, word_counts, pairs, pair_counts, pair_more): the distinct n-grams of a block with their counts in its training texts.

    A pair's count takes a byte; those of 255 or more follow in ``pair_more``.
    """
    names = [x.strip().split(" ")[0] for x in ASKED.split(",")]

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                tokens, bounds, train = _tokens(opened(batch.column("docs")[k]))
                sides = []
                for keys, shift in ((tokens, 0), (pair_keys(tokens, bounds), 24)):
                    own, value, at = asked(keys, buckets, shift)
                    sides.append((own, value, np.bincount(at[train], minlength=len(own)).astype("<u4")))
                ids = np.unique(np.concatenate([own for own, _, _ in sides]))
                cut = [(np.searchsorted(own, ids), np.searchsorted(own, ids, "right")) for own, _, _ in sides]
                cells = [[] for _ in range(5)]
                for i in range(len(ids)):
                    (w, wn), (q, qn) = ((value[first[i] : last[i]], n[first[i] : last[i]]) for (_, value, n), (first, last) in zip(sides, cut))
                    for c, x in zip(cells, (w.astype("<u8").tobytes(), wn.tobytes(), _pack5(q), np.minimum(qn, 255).astype("<u1").tobytes(), qn[qn >= 255].tobytes())):
                        c.append(x)
                block = np.full(len(ids), batch.column("block")[k].as_py())
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(block), *[pa.array(c, pa.binary()) for c in cells]], names)

    return run


ANSWERS = "block long, bucket long, word_n binary, word_levels binary, pair_levels binary, n_words long, n_tokens long, levels array<long>"


def _answer(batches):
    """For each block of a bucket its n-grams' counts and levels in their order; and a row without a block that holds the bucket's totals."""
    kinds = [pa.int64(), pa.int64(), *[pa.binary()] * 3, pa.int64(), pa.int64(), pa.list_(pa.int64())]
    names = [x.strip().split(" ")[0] for x in ANSWERS.split(",")]
    for batch in batches:
        for k in range(batch.num_rows):
            held = batch.column("held")[k].values
            cell = lambda c, t: [np.frombuffer(x, t) for x in held.field(c).to_pylist()]  # noqa: E731, B023
            words, pairs = cell("words", "<u8"), [_unpack5(x) for x in held.field("pairs").to_pylist()]
            pair_n = []
            for n, more in zip(cell("pair_counts", "<u1"), cell("pair_more", "<u4")):
                n = n.astype(np.int64)
                n[n == 255] = more
                pair_n.append(n)
            sides = [_judged(words, cell("word_counts", "<u4"), 64, np.uint64(0)), _judged(pairs, pair_n, 40, PAIR)]
            (word_n, word_levels, totals), (_, pair_levels, _) = sides
            blocks = held.field("block").to_pylist()
            bucket = batch.column("bucket")[k].as_py()
            cells = [[*x, None] for x in (word_n, word_levels, pair_levels)]
            none = [None] * len(blocks)
            columns = [[*blocks, None], [bucket] * (len(blocks) + 1), *cells, *[[*none, x] for x in totals]]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)


def _judged(keys: list[np.ndarray], counts: list[np.ndarray], bits: int, kind: np.uint64):
    """Counts and filter levels of each block's keys, as bytes; and the totals: distinct keys, their counts, keys by level.

    The keys of a bucket are taken in ``RANGES`` ranges, each with a stretch of the filter of its own, so that the arrays of one are held at a time.
    """
    told, levels = [[] for _ in keys], [[] for _ in keys]
    distinct, total, by_level = 0, 0, np.zeros(len(LEVELS), np.int64)
    cuts = [np.searchsorted(x >> np.uint64(bits - RANGES.bit_length() + 1), np.arange(RANGES + 1, dtype=np.uint64)) for x in keys]
    for r in range(RANGES):
        own = [x[c[r] : c[r + 1]] for x, c in zip(keys, cuts)]
        k, at = np.unique(np.concatenate(own), return_inverse=True)
        n = np.bincount(at, np.concatenate([x[c[r] : c[r + 1]] for x, c in zip(counts, cuts)]), len(k)).astype(np.int64)
        seen = n > 0
        level = levels_held(fill(k[seen] | kind, n[seen]), k | kind)
        distinct, total = distinct + int(seen.sum()), total + int(n.sum())
        by_level += np.bincount(np.searchsorted(LEVELS, n[seen], "right") - 1, minlength=len(LEVELS))
        ends = np.append(0, np.cumsum([len(x) for x in own]))
        for i in range(len(keys)):
            mine = at[ends[i] : ends[i + 1]]
            told[i].append(n[mine].astype("<i8").tobytes())
            levels[i].append(level[mine].tobytes())
    return [b"".join(x) for x in told], [b"".join(x) for x in levels], (distinct, total, by_level.tolist())


def _each(blocks: DataFrame, answers: DataFrame, each, schema: str) -> DataFrame:
    """``each`` applied to a block and the answers to its n-grams."""
    told = answers.where("block is not null").select("block", "bucket", "word_n", "word_levels", "pair_levels")
    return blocks.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(each, schema)


def _ratios(model: Model):
    """Training tokens of a block by tier and ratio: pair shares with one count left out against word probabilities. No ratio: no share."""

    def run(rows, answers):
        tokens, bounds, train = _tokens(opened(rows.column("docs")[0]))
        _, word, pair, history, tier = model.parts(tokens, bounds, answers)
        ratio = (np.maximum(pair - 1, 0) / np.maximum(history - 1, 1) / word)[train]
        step = np.rint(np.log2(np.where(ratio > 0, ratio, 1.0)) * STEPS).astype(np.int64)
        code, n = np.unique((tier[train] << 32) + np.where(ratio > 0, step + (1 << 20), 0), return_counts=True)
        step = code & 0xFFFFFFFF
        return pa.table([pa.array((code >> 32).astype(np.int32)), pa.array((step - (1 << 20)).astype(np.int32), mask=step == 0), pa.array(n)], ["tier", "step", "n"])

    return run


def fit_weights(ratio: np.ndarray, tier: np.ndarray, n: np.ndarray, rounds: int = 30) -> np.ndarray:
    """The pair's weight for each tier of the history's count, from ``n`` tokens of each tier and ratio."""
    weights = np.full(WEIGHT_TIERS, 0.2)
    seen = np.bincount(tier, n, WEIGHT_TIERS)
    for _ in range(rounds):
        top = weights[tier] * ratio
        part = top / (top + 1 - weights[tier])
        weights = np.where(seen > 0, (np.bincount(tier, part * n, WEIGHT_TIERS) + 0.2) / (seen + 1), weights)
    return np.clip(weights, 1e-6, 0.999)


def _score(model: Model, weights: np.ndarray):
    names = ["doc_id", "fold", "n_tokens", "known", "base", "score"]

    def run(rows, answers):
        docs = opened(rows.column("docs")[0])
        tokens, bounds, _ = _tokens(docs)
        exact, word, pair, history, tier = model.parts(tokens, bounds, answers)
        w = weights[tier]
        sums = [np.add.reduceat(x, bounds[:-1]) for x in ((exact > 0).astype(np.int64), np.log10((exact + 0.1) / model.floor()), np.log10(w * pair / history + (1 - w) * word))]
        return pa.table([docs.column("doc_id"), docs.column("fold"), *map(pa.array, (np.diff(bounds), *sums))], names)

    return run


def weights_of(blocks: DataFrame, answers: DataFrame, model: Model) -> np.ndarray:
    """Weights fitted on all training tokens; what reaches the driver is a row per tier and ratio."""
    counts = _each(blocks, answers, _ratios(model), "tier int, step int, n long").groupBy("tier", "step").agg(F.sum("n").alias("n")).toPandas().sort_values(["tier", "step"])
    ratio = np.where(counts["step"].isna(), 0.0, np.exp2(counts["step"].fillna(0).to_numpy(float) / STEPS))
    return fit_weights(ratio, counts["tier"].to_numpy(int), counts["n"].to_numpy(float))


def score_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    small_batches(df.sparkSession)
    docs = narrow(df, id_col, text_col).select("doc_id", "text", F.coalesce(F.pmod(crc_fold(), F.lit(10)), F.lit(1)).cast("int").alias("fold"))
    total, training = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count(F.when(F.col("fold") != 0, 1))).first()
    buckets = max(8, -(-int(total) // BUCKET_BYTES))
    blocks = store(docs.mapInArrow(_blocks, "block long, docs binary"), "blocks")
    held = blocks.mapInArrow(_ask(buckets), ASKED).groupBy("bucket").agg(
        F.collect_list(F.struct("block", "words", "word_counts", "pairs", "pair_counts", "pair_more")).alias("held"))
    answers = store(held.mapInArrow(_answer, ANSWERS), "answers")
    sums = answers.where("block is null").agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("n_words", "n_tokens", *[F.get("levels", F.lit(i)) for i in range(len(LEVELS))])]).first()
    v, n = int(sums[0]), int(sums[1])
    # the least count that at most COMMON words reach
    reach = np.cumsum(np.array(sums[2:], np.int64)[::-1])[::-1]
    least = int(LEVELS[np.flatnonzero(reach <= COMMON)[0]]) if (reach <= COMMON).any() else int(LEVELS[-1]) * 2
    model = Model(n, v, int(training), buckets, least)
    scored = _each(blocks, answers, _score(model, weights_of(blocks, answers, model)), "doc_id long, fold int, n_tokens long, known long, base double, score double")
    return scored.select(
        "doc_id", (F.col("fold") == 0).alias("held_out"), "n_tokens", F.col("known").alias("n_known"), F.lit(n).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), "score")
