"""Similarity join on word n-gram sets with prefix filters under several global orders.

A document's set holds its distinct shingles of ``n`` words. Two sets with Jaccard similarity of ``percent`` or more share
a token among the first ``size - ceil(percent * size) + 1`` tokens of each, under any one order of all tokens. Three
orders are used: in each, tokens known to be frequent come last by the size of their count, and the rest in the order of a
hash of their own. Postings under the first order give candidates; a candidate whose prefixes under the second or the third
order do not meet is dropped; what is left is verified on the whole sets.

Equal sets are one class. Each class first meets the hub (of a token and a size class) with which it shares most postings, which
joins most near copies; one that shares few with any hub waits. What the links leave apart is compared across components, token by token inside tasks: pairs are never
listed, only the classes that still have a candidate are put into families, by a forest of candidates. The texts of a family go
to one task, a large family's in pairs of blocks, where its pairs are verified unless already linked, and a forest of links
comes back. So rows, shuffles and memory grow with the classes, and no link between different components is lost.

* Null text, empty text or no word: empty set, linked with nothing, its own component.
* Fewer than ``n`` words: the whole word sequence is the one shingle.
* Repeated rows and repeated ids: each row gives one result row; wholly equal sets are one class.
* A null id: kept as null; its component takes the smallest id that is not null.
* Other columns are not carried. An empty table gives an empty table.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hackstand.llm.common import forget, free_name, if_small, narrow, row_key, small_batches, store, text_slices
from hackstand.llm.components import components
from hackstand.llm.words import Words, mix, ngrams

N, PERCENT = 4, 85
ORDERS = 3
#: Tokens whose count the orders know; others count as rare. A bound on what is broadcast, with no effect on the result.
KNOWN_TOKENS = 1 << 18
#: Tokens held at once while their repeats inside one task are counted.
BLOCK_TOKENS = 3_000_000
#: Text bytes for each bucket of rare tokens.
BUCKET_BYTES = 16 << 20
#: Bytes of text whose shingles are made at once.
PIECE_BYTES = 1 << 20
#: Least number of counts in a set's sketch; from so many on, a count has eight bits instead of four. Most tokens that a count has on average.
LEAST_COUNTS, WIDE_COUNTS, MOST_IN_A_COUNT = 32, 256, 32
#: A class meets its hub if they share this part of its posted tokens. It saves moving texts that meet by chance; the families find all other links.
HUB_SHARE = 8
#: Postings of a token, and tokens of a family, that one block holds; more are met in pairs of blocks.
BLOCK_POSTINGS, BLOCK_SIZES = 2_048, 500_000
#: Classes whose links a task remembers while it makes a forest; beyond, it starts anew and may repeat links.
KEPT_CLASSES = 300_000


def shingle_sets(texts: pa.Array, n: int):
    """The sorted distinct shingle hashes of each text."""
    words = Words(texts)
    h = words.hashes()
    for part in words.texts():
        own = h[part]
        yield np.unique(ngrams(own, n if len(own) >= n else max(1, len(own))))


def signature(tokens: np.ndarray) -> int:
    with np.errstate(over="ignore"):
        return int(mix(mix(tokens, 99).sum(dtype=np.uint64) + np.uint64(len(tokens)), 98).astype(np.int64))


def prefix_size(size: int, percent: int) -> int:
    return size + (percent * size) // -100 + 1


def overlap(size_a: int, size_b: int, percent: int) -> int:
    """The least number of common tokens of two similar sets."""
    return -(-percent * (size_a + size_b) // (100 + percent))


def sketch(tokens: np.ndarray) -> bytes:
    """Tokens counted by hash in 32 places or more, twice as many for four times the tokens; modulo 16, two in a byte, or modulo 256 from 256 places on.

    The differences of two sketches add up to at most the number of tokens in which the sets differ.
    """
    places = LEAST_COUNTS
    while places * places * 4 <= len(tokens) * LEAST_COUNTS or places * MOST_IN_A_COUNT < len(tokens):
        places *= 2
    shift = np.uint64(64 - places.bit_length() + 1)
    counts = np.bincount((mix(tokens, 7) >> shift).astype(np.int64), minlength=places).astype(np.uint8)
    return (counts if places >= WIDE_COUNTS else (counts[::2] & 15) << 4 | counts[1::2] & 15).tobytes()


def unpacked(blob: bytes) -> np.ndarray:
    """The counts of a sketch."""
    counts = np.frombuffer(blob, np.uint8)
    return counts if len(counts) >= WIDE_COUNTS else np.stack([counts >> 4, counts & 15], 1).ravel()


class Sketches:
    """Sketches of several lengths, folded to the shorter length of each pair."""

    def __init__(self, blobs: list[bytes]):
        counts = [unpacked(x) for x in blobs]
        self.lengths = np.array([len(x) for x in counts], np.int64)
        self.rows, self.at = {}, {}
        for k in np.unique(self.lengths):
            rows = np.flatnonzero(self.lengths >= k)
            folded = [counts[i].reshape(k, -1).sum(axis=1, dtype=np.uint8) for i in rows]
            self.rows[k] = np.stack(folded)
            self.at[k] = np.zeros(len(blobs), np.int64)
            self.at[k][rows] = np.arange(len(rows))

    def apart(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """The least number of tokens in which the sets of each pair differ."""
        out, k_of = np.zeros(len(i), np.int64), np.minimum(self.lengths[i], self.lengths[j])
        for k in np.unique(k_of):
            own = np.flatnonzero(k_of == k)
            d = self.rows[k][self.at[k][i[own]]] - self.rows[k][self.at[k][j[own]]]
            if k < WIDE_COUNTS:  # one of the two is modulo 16
                out[own] = np.minimum(d & 15, -d & 15).sum(axis=1, dtype=np.int64)
            else:
                out[own] = np.minimum(d, -d).sum(axis=1, dtype=np.int64)
        return out


def tiers(tokens: np.ndarray, known) -> np.ndarray:
    """The size of each known token's count; 0 for others."""
    tokens_known, tiers_known = known
    if not len(tokens_known):
        return np.zeros(len(tokens), np.int64)
    at = np.minimum(np.searchsorted(tokens_known, tokens), len(tokens_known) - 1)
    return np.where(tokens_known[at] == tokens, tiers_known[at], 0)


def prefix(tokens: np.ndarray, tier: np.ndarray, k: int, percent: int) -> np.ndarray:
    """Places of the tokens that come first in the ``k``-th order, sorted by it."""
    p = prefix_size(len(tokens), percent)
    rank = (tier.astype(np.uint64) << np.uint64(58)) | (mix(tokens, 11 + k) >> np.uint64(6))
    first = np.argpartition(rank, p - 1)[:p] if p < len(tokens) else np.arange(len(tokens))
    return first[np.argsort(rank[first])]


def whole_groups(batches, key: str):
    """Tables of whole groups from batches that are sorted by ``key``."""
    held: list = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy()
        if held and held[-1].column(key)[-1].as_py() != keys[0]:
            yield pa.Table.from_batches(held)
            held = []
        cut = int(np.searchsorted(keys, keys[-1]))
        if cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def _int64(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64, copy=False))


def _profile(n: int):
    """Rows of two kinds: 0, a document (key: row, value: signature, size); 1, a token seen more than once (key, value: count)."""

    def run(batches):
        forget()
        seen: set = set()
        block, held = [], 0

        def repeats():
            tokens, counts = np.unique(np.concatenate(block), return_counts=True)
            more = counts > 1
            k = int(more.sum())
            return pa.RecordBatch.from_arrays([pa.array(np.ones(k, np.int32)), _int64(tokens[more]), pa.nulls(k, pa.int64()), _int64(counts[more]), pa.nulls(k, pa.int64())],
                                              ["kind", "key", "doc_id", "value", "size"])

        for batch in batches:
            for piece in text_slices(batch, budget=PIECE_BYTES):
                signs, sizes = [], []
                for tokens in shingle_sets(piece.column("text"), n):
                    sign = signature(tokens)
                    signs.append(sign)
                    sizes.append(len(tokens))
                    if len(tokens) and sign not in seen:
                        seen.add(sign)
                        block.append(tokens)
                        held += len(tokens)
                k = piece.num_rows
                yield pa.RecordBatch.from_arrays([pa.array(np.zeros(k, np.int32)), piece.column("row"), piece.column("doc_id"), pa.array(signs, pa.int64()), pa.array(sizes, pa.int64())],
                                                 ["kind", "key", "doc_id", "value", "size"])
                if held > BLOCK_TOKENS:
                    yield repeats()
                    seen.clear()
                    block, held = [], 0
        if block:
            yield repeats()

    return run


def _postings(n: int, percent: int, known, buckets: int):
    """Rows of three kinds: 0, a block of rare postings of one bucket; 1, a posting of a known token; 2, a class with its sketch."""
    names = ["kind", "key", "sign", "size", "place", "blob"]

    def run(batches):
        forget()
        seen: set = set()
        held: list = []
        count = 0

        def flush():
            tok, sign, size, place, tier = (np.concatenate(x) for x in zip(*held))
            hot = tier > 0
            k = int(hot.sum())
            yield pa.RecordBatch.from_arrays([pa.array(np.ones(k, np.int32)), _int64(tok[hot]), _int64(sign[hot]), _int64(size[hot]), _int64(place[hot]), pa.nulls(k, pa.binary())], names)
            cold = ~hot
            bucket = (mix(tok[cold], 5) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            packed = np.empty(len(order), [("t", "<u8"), ("s", "<i8"), ("n", "<i4"), ("p", "<i4")])
            for f, x in zip("tsnp", (tok, sign, size, place)):
                packed[f] = x[cold][order]
            ids, starts = np.unique(bucket[order], return_index=True)
            ends = np.append(starts[1:], len(order))
            blobs = [packed[a:b].tobytes() for a, b in zip(starts, ends)]
            k = len(ids)
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(k, np.int32)), _int64(ids), *[pa.nulls(k, pa.int64())] * 3, pa.array(blobs, pa.binary())], names)

        for batch in batches:
            for piece in text_slices(batch, budget=PIECE_BYTES):
                signs, sizes, blobs = [], [], []
                for tokens in shingle_sets(piece.column("text"), n):
                    if not len(tokens) or (sign := signature(tokens)) in seen:
                        continue
                    seen.add(sign)
                    tier = tiers(tokens, known.value)
                    first = prefix(tokens, tier, 0, percent)
                    p = len(first)
                    held.append((tokens[first], np.full(p, sign), np.full(p, len(tokens)), np.arange(p), tier[first]))
                    count += p
                    signs.append(sign)
                    sizes.append(len(tokens))
                    blobs.append(sketch(tokens))
                k = len(signs)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(k, 2, np.int32)), pa.nulls(k, pa.int64()), pa.array(signs, pa.int64()), pa.array(sizes, pa.int64()), pa.nulls(k, pa.int64()), pa.array(blobs, pa.binary())], names)
                if count > BLOCK_TOKENS // 4:
                    yield from flush()
                    seen.clear()
                    held, count = [], 0
        if held:
            yield from flush()

    return run


def _shared_rare(batches):
    """Of each bucket's rare postings those whose token stands in two classes or more."""
    forget()
    for batch in batches:
        for key_blobs in batch.column("blobs"):
            rows = np.concatenate([np.frombuffer(x.as_buffer(), [("t", "<u8"), ("s", "<i8"), ("n", "<i4"), ("p", "<i4")]) for x in key_blobs.values])
            rows = rows[np.lexsort((rows["s"], rows["t"]))]
            fresh = np.ones(len(rows), bool)
            fresh[1:] = (rows["t"][1:] != rows["t"][:-1]) | (rows["s"][1:] != rows["s"][:-1])
            rows = rows[fresh]
            same = rows["t"][1:] == rows["t"][:-1]
            shared = np.append(same, False) | np.append(False, same)
            rows = rows[shared]
            yield pa.RecordBatch.from_arrays([_int64(np.ascontiguousarray(rows["t"])), _int64(np.ascontiguousarray(rows["s"])), _int64(rows["n"]), _int64(rows["p"])], ["token", "sign", "size", "place"])


def _near(percent: int):
    """From postings sorted by cell, a forest (a, b) of the pairs in one cell whose parts differ and whose sizes, places and sketches allow the similarity."""

    def run(batches):
        forget()
        above: dict = {}

        def top(x):
            while (y := above.get(x, x)) != x:
                above[x] = x = above.get(y, y)
            return x

        for table in whole_groups(batches, "cell"):
            cell, sign, size, place, part = (table.column(c).to_numpy() for c in ("cell", "sign", "size", "place", "part"))
            sketches = Sketches(table.column("sketch").to_pylist())
            at, step, links = np.arange(len(cell)), 0, set()
            while True:  # rows of a cell meet at every distance
                step += 1
                at = at[: np.searchsorted(at, len(cell) - step)]
                at = at[cell[at] == cell[at + step]]
                if not len(at):
                    break
                i = at[part[at] != part[at + step]]
                i = i[np.minimum(size[i], size[i + step]) * 100 >= np.maximum(size[i], size[i + step]) * percent]
                j = i + step
                need = overlap(size[i], size[j], percent)
                ok = np.minimum(place[i], place[j]) + 1 + np.minimum(size[i] - place[i] - 1, size[j] - place[j] - 1) >= need
                i, j, need = i[ok], j[ok], need[ok]
                ok = sketches.apart(i, j) <= size[i] + size[j] - 2 * need
                links.update(zip(sign[i[ok]].tolist(), sign[j[ok]].tolist()))
            if len(above) > KEPT_CLASSES:
                above.clear()
            forest = []
            for a, b in links:
                x, y = top(a), top(b)
                if x != y:
                    above[max(x, y)] = min(x, y)
                    forest.append((a, b))
            if forest:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*forest)], ["a", "b"])

    return run


def _shared_tokens(mark: np.ndarray, flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> np.ndarray:
    """How many of the tokens of each class in ``which`` are marked."""
    own = sizes[which]
    begin = np.cumsum(own) - own
    at = np.repeat(starts[which] - begin, own) + np.arange(int(own.sum()))
    return np.add.reduceat(mark[flat[at]], begin, dtype=np.int64)


def forest_of_links(signs: np.ndarray, parts: np.ndarray, sets: list, percent: int, known) -> list[tuple[int, int]]:
    """Links between similar sets that join what ``parts`` leave apart: a forest, in which no similar pair stays unjoined.

    A pair whose prefixes share too few tokens under a further order is dropped: the prefix that ends first in an order holds all
    common tokens up to its end, and these are in both prefixes; any other common token is among the ``size - prefix`` after it.
    """
    keep = np.unique(signs, return_index=True)[1]
    keep = keep[np.argsort([len(sets[k]) for k in keep], kind="stable")]
    signs, sets, root = signs[keep], [sets[k] for k in keep], np.unique(parts[keep], return_inverse=True)[1]
    if not root.any():
        return []
    sizes = np.array([len(x) for x in sets], np.int64)
    starts = np.cumsum(sizes) - sizes
    ids = np.unique(np.concatenate(sets), return_inverse=True)[1]
    mark = np.zeros(int(ids.max()) + 1, bool)
    heads = prefix_size(sizes, percent)
    head_starts = np.cumsum(heads) - heads
    orders = [[] for _ in range(ORDERS - 1)]
    for x, at in zip(sets, starts):
        tier = tiers(x, known)
        for k, order in enumerate(orders):
            order.append(ids[at + prefix(x, tier, k + 1, percent)])
    orders = [np.concatenate(x) for x in orders]
    ends, links = np.searchsorted(sizes, 100 * sizes // percent, "right"), []
    for a in range(len(sets) - 1):
        b = np.arange(a + 1, ends[a])
        b = b[root[b] != root[a]]
        for order in orders:
            if not len(b):
                break
            own = order[head_starts[a] : head_starts[a] + heads[a]]
            mark[own] = True
            least = np.maximum(1, overlap(sizes[a], sizes[b], percent) - np.maximum(sizes[a] - heads[a], sizes[b] - heads[b]))
            b = b[_shared_tokens(mark, order, head_starts, heads, b) >= least]
            mark[own] = False
        if not len(b):
            continue
        own = ids[starts[a] : starts[a] + sizes[a]]
        mark[own] = True
        common = _shared_tokens(mark, ids, starts, sizes, b)
        mark[own] = False
        b = b[100 * common >= percent * (sizes[a] + sizes[b] - common)]
        roots, first = np.unique(root[b], return_index=True)
        links += [(int(signs[a]), int(signs[k])) for k in b[first]]
        root[np.isin(root, roots)] = root[a]
    return links


def _links(n: int, percent: int, known):
    """From texts sorted by cell, the forest of links of each cell."""

    def run(batches):
        forget()
        for table in whole_groups(batches, "cell"):
            cells = table.column("cell").to_numpy()
            bounds = np.append(np.flatnonzero(np.append(True, cells[1:] != cells[:-1])), len(cells))
            links = []
            for i, j in zip(bounds[:-1], bounds[1:]):
                rows = table.slice(i, j - i).combine_chunks().to_batches()[0]
                sets = [x for piece in text_slices(rows, budget=PIECE_BYTES) for x in shingle_sets(piece.column("text"), n)]
                links += forest_of_links(rows.column("sign").to_numpy(), rows.column("part").to_numpy(), sets, percent, known.value)
            if links:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*links)], ["a", "b"])

    return run


class Join:
    """The join of one table; ``documents()`` has row, doc_id, sign, size and component of every row."""

    def __init__(self, df: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N, percent: int = PERCENT):
        self.n, self.percent, self.spark = n, percent, df.sparkSession
        small_batches(self.spark)
        self.keyed = narrow(df, id_col, text_col).select(row_key().alias("row"), "doc_id", "text")

    def links(self) -> DataFrame:
        profile = store(self.keyed.mapInArrow(_profile(self.n), "kind int, key long, doc_id long, value long, size long"), "profile")
        self.docs = profile.where("kind = 0").select(F.col("key").alias("row"), "doc_id", F.col("value").alias("sign"), "size")
        known = profile.where("kind = 1").groupBy("key").agg(F.sum("value").alias("n")).orderBy(F.desc("n"), "key").limit(KNOWN_TOKENS).toPandas()
        tokens = known["key"].to_numpy(np.int64).view(np.uint64)
        order = np.argsort(tokens)
        heights = np.minimum(63, 1 + np.log2(np.maximum(2, known["n"].to_numpy(np.float64))).astype(np.int64))
        self.known = self.spark.sparkContext.broadcast((tokens[order], heights[order]))
        total = self.docs.agg(F.sum("size")).first()[0] or 0
        buckets = max(8, int(total * 6 // BUCKET_BYTES))
        made = store(self.keyed.select("text").mapInArrow(_postings(self.n, self.percent, self.known, buckets), "kind int, key long, sign long, size long, place long, blob binary"), "postings")
        rare = made.where("kind = 0").groupBy("key").agg(F.collect_list("blob").alias("blobs")).select("blobs").mapInArrow(_shared_rare, "token long, sign long, size long, place long")
        hot = made.where("kind = 1").select(F.col("key").alias("token"), "sign", "size", "place").distinct()
        self.postings = store(rare.unionByName(hot), "shared")
        self.classes = made.where("kind = 2").groupBy("sign").agg(F.first("size").alias("size"), F.first("blob").alias("sketch"))
        first = self._linked(self._stars())
        families = self._families(components(first))
        return first if families is None else first.unionByName(self._linked(families))

    def _stars(self) -> DataFrame:
        """sign, part, cell: every class that shares a posted token, beside the hub with which it shares most, if that is a fair part of its posted tokens."""
        posts = self.postings.withColumn("level", self._level())
        hubs = posts.groupBy("token", "level").agg(F.min("sign").alias("hub"), F.count("*").alias("c")).where("c > 1").drop("c")
        met = posts.join(hubs, ["token", "level"]).where("sign <> hub").groupBy("sign", "hub").agg(F.count("*").alias("c"), F.first("size").alias("size"))
        best = met.groupBy("sign").agg(F.max(F.struct("c", "hub")).alias("best"), F.first("size").alias("size"))
        best = best.where(F.col("best.c") * HUB_SHARE * 100 >= F.col("size") * (100 - self.percent))
        best = store(best.select("sign", "size", "best.hub"), "stars")
        blocks = best.groupBy("hub").agg(F.ceil(F.sum("size") / BLOCK_SIZES).alias("blocks"))
        near = best.join(blocks, "hub").select("sign", F.col("sign").alias("part"), F.xxhash64("hub", F.pmod(F.xxhash64("sign"), "blocks")).alias("cell"))
        centre = blocks.select("hub", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("k"))
        return near.unionByName(centre.select(F.col("hub").alias("sign"), F.col("hub").alias("part"), F.xxhash64("hub", "k").alias("cell")))

    def _families(self, labels: DataFrame) -> DataFrame | None:
        """sign, part, cell: the classes that have a candidate in another component, beside all they may be similar to."""
        posts = self.postings.join(labels, F.col("sign") == F.col("node"), "left").select("token", "sign", "size", "place", F.coalesce("label", "sign").alias("part"))
        posts = store(posts, "parts")
        mixed = posts.groupBy("token", "part").agg(F.count("*").alias("c")).groupBy("token").agg(
            F.count("*").alias("parts"), F.sum("c").alias("c"), F.max(F.struct("c", "part")).alias("star")).where("parts > 1")
        # a token's largest part meets only the others; blocks bound what one task holds
        mixed = mixed.select("token", F.col("star.part").alias("star"), F.ceil(F.col("star.c") / BLOCK_POSTINGS).alias("n"), F.ceil((F.col("c") - F.col("star.c")) / BLOCK_POSTINGS).alias("m"))
        open_ = posts.join(mixed, "token").join(self.classes.select("sign", "sketch"), "sign")
        own, from_0 = F.xxhash64("sign"), lambda c: F.sequence(F.lit(0).cast("long"), F.col(c) - 1)
        row, col = F.pmod(own, "n"), F.pmod(own, "m")
        cell = lambda i, j: F.xxhash64("token", i, j)
        stars = F.transform(from_0("m"), lambda j: cell(row, j))
        others = F.transform(from_0("n"), lambda i: cell(i, col))
        among = F.when((F.col("n") == 1) & (F.col("m") == 1), F.array().cast("array<bigint>")).otherwise(F.transform(from_0("m"), lambda j: cell(-1 - F.greatest(j, col), F.least(j, col))))
        cells = F.when(F.col("part") == F.col("star"), stars).otherwise(F.concat(others, among))
        dealt = open_.select(F.explode(cells).alias("cell"), "sign", "size", "place", "part", "sketch")
        forest = store(dealt.repartition("cell").sortWithinPartitions("cell").mapInArrow(_near(self.percent), "a long, b long"), "forest")
        if not forest.limit(1).count():
            return None
        family = components(forest)
        nodes = family.join(self.classes.select("sign", "size"), F.col("node") == F.col("sign")).join(labels.withColumnsRenamed({"node": "sign", "label": "part"}), "sign", "left")
        nodes = store(nodes.select("sign", "size", F.coalesce("part", "sign").alias("part"), "label"), "families")
        # similar sets lie in one size level or in two next to each other
        nodes = nodes.withColumn("level", F.explode(F.array(self._level(), self._level() + 1)))
        blocks = nodes.groupBy("label", "level").agg(F.ceil(F.sum("size") / BLOCK_SIZES).alias("n"), F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo <> hi")
        pairs = F.transform(from_0("n"), lambda k: F.xxhash64("label", "level", F.least(k, row), F.greatest(k, row)))
        return nodes.join(blocks, ["label", "level"]).select("sign", "part", F.explode(pairs).alias("cell"))

    def _level(self) -> Column:
        """Size levels so wide that similar sets differ by one at most, whatever the rounding of the logarithm."""
        return F.floor(F.log(F.col("size").cast("double")) / (math.log(100 / self.percent) * 1.001)).cast("int")

    def _linked(self, cells: DataFrame) -> DataFrame:
        """A forest of the links in each cell of ``cells`` (sign, part, cell). Only the texts of their classes move, once per cell."""
        cells = store(cells.groupBy("sign").agg(F.first("part").alias("part"), F.collect_list("cell").alias("cells")), "cells")
        rows = self.docs.join(if_small(cells.select("sign")), "sign", "left_semi").groupBy("sign").agg(F.min("row").alias("row"))
        rows = store(rows.join(cells, "sign"), "rows")
        texts = self.keyed.join(if_small(rows), "row").select("sign", "part", F.explode("cells").alias("cell"), "text")
        dealt = texts.repartition("cell").sortWithinPartitions("cell")
        return store(dealt.mapInArrow(_links(self.n, self.percent, self.known), "a long, b long"), "verified")

    def documents(self) -> DataFrame:
        labels = components(self.links())
        classes = self.docs.where("size > 0").groupBy("sign").agg(F.min("doc_id").alias("least"))
        classes = classes.join(labels, F.col("sign") == F.col("node"), "left").select("sign", "least", F.coalesce("label", "sign").alias("part"))
        parts = classes.groupBy("part").agg(F.min("least").alias("component_id"))
        named = classes.join(parts, "part").select("sign", "part", "component_id")
        return self.docs.join(named, "sign", "left").select(
            "row", "doc_id", "sign", "size", "part", F.when(F.col("size") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id for every row."""
    return Join(df, id_col, text_col, n, percent).documents().select("doc_id", F.col("size").alias("n_shingles"), "component_id")


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N, percent: int = PERCENT) -> DataFrame:
    """``df`` with one row of each component: that of the smallest id, then of the smallest text hash; rows without words all stay."""
    row, copies = free_name(df, "row"), free_name(df, "copies")
    found = store(Join(df, id_col, text_col, n, percent).documents(), "groups")
    rank = F.coalesce("doc_id", F.lit(2**63 - 1))
    first = found.where("size > 0").groupBy("part").agg(F.min(rank).alias("least"))
    chosen = found.where("size > 0").join(first, "part").where(rank == F.col("least")).groupBy("part").agg(F.min("row").alias("row")).select("row")
    counted = found.groupBy("row").agg(F.count("*").alias("copies"), F.max("size").alias("size"))
    # rows without words count as single: all of them stay
    kept = chosen.union(found.where("size = 0").select("row").distinct()).join(counted, "row").select(
        F.col("row").alias(row), F.when(F.col("size") == 0, 1).otherwise(F.col("copies")).alias(copies))
    rows = df.withColumn(row, row_key(F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`"))).join(kept, row)
    single, more = rows.where(F.col(copies) == 1), rows.where(F.col(copies) > 1).dropDuplicates([row])
    return single.unionByName(more).select(*[F.col(f"`{c}`") for c in df.columns])


def sql(n: int = N, percent: int = PERCENT) -> str:
    words = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ \\t-\\r]+')"
    shingle = ", ".join(f"w[i + {k}]" for k in range(1, n + 1))
    return f"""
with recursive d as (select doc_id, {words} as w from documents),
     s as (select distinct doc_id, case when len(w) < {n} then array_to_string(w, ' ') else concat_ws(' ', {shingle}) end as g
           from (select doc_id, w, unnest(range(greatest(1, len(w) - {n - 1}))) as i from d where len(w) > 0)),
     c as (select doc_id, count(*) as n from s group by doc_id),
     p as (select x.doc_id as a, y.doc_id as b, count(*) as m from s x join s y on x.g = y.g and x.doc_id < y.doc_id group by all),
     l as (select a, b from p join c ca on ca.doc_id = a join c cb on cb.doc_id = b where 100 * m >= {percent} * (ca.n + cb.n - m)),
     e as (select a, b from l union all select b, a from l),
     r as (select doc_id as a, doc_id as b from d union select r.a, e.b from r join e on r.b = e.a)
select d.doc_id, cast(coalesce(c.n, 0) as bigint) as n_shingles, (select min(r.b) from r where r.a = d.doc_id) as component_id
from d left join c on c.doc_id = d.doc_id
"""
