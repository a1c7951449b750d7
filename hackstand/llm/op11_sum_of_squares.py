"""Packing of whole documents into as few sequences as possible, by the sum of squares.

Each document is encoded and ended with one end id; only documents longer than a sequence are cut, into full pieces and one rest.
Full pieces are sequences of their own. The others are placed by length, the longest first: among the open sequences with room,
each goes where the squared counts of open sequences per residual gap add up to least, ties to the smallest gap; a new
sequence is opened where none has room. That keeps many different gaps open, so that later pieces close them exactly.

Placing needs lengths only. Pieces are written once; their lengths are dealt by hash into groups of about ``GROUP`` pieces, each
placed in one task. The emptiest sequences of a group, of at most an eighth of its pieces, are dissolved and dealt again with those
of other groups, until one group is left: so a group's remnant costs no sequence, and no task sees more than a group. ``pack``
then joins ids and places by piece.

* Null text: empty, one end id. Null ids are kept as null.
* Repeated rows or ids: each row is placed for itself. Pieces of equal length are taken in the order of their keys.
* Other columns are not carried. An empty table gives no piece.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hackstand.llm.common import narrow, store, text_slices
from hackstand.llm.word_ids import word_encoder

WINDOW, END_ID = 4096, 1
#: Pieces that one task places; an eighth of them may be placed again with those of other groups.
GROUP = 20_000
#: Tokens of padding from which a sequence counts as unfinished.
UNFINISHED = 64

_PIECE = "key long, doc_id long, piece int, start long, length long, ids binary"
_PLACE = "key long, length long, sequence_id long, offset long, open boolean"


def place(lengths: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece, and the gap left in each sequence."""
    open_ = np.zeros(window + 1, np.int64)  # open sequences by gap
    with_gap: dict[int, list[int]] = {}
    sequence, offset, gaps = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), []
    for at in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[at])
        room = np.flatnonzero(open_[size:])  # the gap that would be left
        if len(room):
            # one sequence leaves its gap and, unless full now, joins those with the gap left
            change = 2 * (np.where(room > 0, open_[room], 0) - open_[room + size]) + 1 + (room > 0)
            left = int(room[np.argmin(change)])
            own = with_gap[left + size].pop()
            open_[left + size] -= 1
        else:
            left, own = window - size, len(gaps)
            gaps.append(window)
        sequence[at], offset[at] = own, window - left - size
        gaps[own] = left
        if left:
            open_[left] += 1
            with_gap.setdefault(left, []).append(own)
    return sequence, offset, np.array(gaps, np.int64)


def _pieces(path: str | None, end_id: int, window: int):
    def run(batches):
        key = TaskContext.get().partitionId() << 36
        for batch in batches:
            for part in text_slices(batch):
                ids, bounds = word_encoder(path).encode(part.column("text"))
                sizes = np.diff(bounds) + 1
                closed = np.full(len(ids) + len(sizes), end_id, np.uint32)
                body = np.ones(len(closed), bool)
                body[np.cumsum(sizes) - 1] = False
                closed[body] = ids
                pieces = -(-sizes // window)
                owner = np.repeat(np.arange(len(sizes)), pieces)
                nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = nth * window
                length = np.minimum(window, sizes[owner] - start)
                cuts = np.append(0, np.cumsum(length))
                blob = pa.Array.from_buffers(pa.large_binary(), len(owner), [None, pa.py_buffer(cuts * 4), pa.py_buffer(closed)]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key + np.arange(len(owner))), part.column("doc_id").take(pa.array(owner)), pa.array(nth.astype(np.int32)), pa.array(start), pa.array(length), blob],
                    ["key", "doc_id", "piece", "start", "length", "ids"])
                key += len(owner)

    return run


def _place(window: int, again: int):
    """Places of a partition's pieces; the emptiest sequences with at most ``again`` pieces together are marked open."""

    def run(batches):
        held = list(batches)
        if not held:
            return
        table = pa.Table.from_batches(held)
        order = np.argsort(table["key"].to_numpy())
        keys, lengths = table["key"].to_numpy()[order], table["length"].to_numpy()[order]
        sequence, offset, gaps = place(lengths, window)
        emptiest = np.argsort(-gaps, kind="stable")
        pieces = np.bincount(sequence, minlength=len(gaps))
        reopened = np.zeros(len(gaps), bool)
        reopened[emptiest] = (np.cumsum(pieces[emptiest]) <= again) & (gaps[emptiest] >= UNFINISHED)
        first = np.zeros(len(gaps), np.int64)
        first[sequence[offset == 0]] = keys[offset == 0]
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(lengths), pa.array(first[sequence]), pa.array(offset), pa.array(reopened[sequence])],
                                         ["key", "length", "sequence_id", "offset", "open"])

    return run


def pieces(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocab: str | None = None, end_id: int = END_ID, window: int = WINDOW) -> DataFrame:
    """key, doc_id, piece, start, length, ids (little-endian unsigned 32-bit) of every piece; to be written before use."""
    return narrow(df, id_col, text_col).mapInArrow(_pieces(vocab, end_id, window), _PIECE)


def places(written: DataFrame, window: int = WINDOW, group: int = GROUP) -> DataFrame:
    """key, sequence_id (the key of the sequence's first piece), offset of written pieces (key, length)."""
    done = written.where(F.col("length") == window).select("key", F.col("key").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = written.where(F.col("length") < window).select("key", "length")
    while True:
        groups = -(-rest.count() // group)
        dealt = rest.repartition(groups, "key") if groups > 1 else rest.repartition(1)
        placed = store(dealt.mapInArrow(_place(window, group // 8 if groups > 1 else 0), _PLACE), "placed")
        done = done.unionByName(placed.where("not open").select("key", "sequence_id", "offset"))
        if groups <= 1:
            return done
        rest = placed.where("open").select("key", "length")


def _packed(written: DataFrame, window: int, group: int) -> DataFrame:
    return written.join(places(written, window, group), "key").drop("key")


def pack(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocab: str | None = None, end_id: int = END_ID, window: int = WINDOW, group: int = GROUP) -> DataFrame:
    """doc_id, piece, start, length, ids, sequence_id, offset of every piece."""
    return _packed(store(pieces(df, id_col, text_col, vocab, end_id, window), "pieces"), window, group)


def digest(df: DataFrame) -> DataFrame:
    """The packing with a checksum of each piece's ids; the ids themselves are not written."""
    written = pieces(df).withColumn("ids", F.crc32("ids")).withColumnRenamed("ids", "ids_crc32")
    return _packed(store(written, "pieces"), WINDOW, GROUP)
