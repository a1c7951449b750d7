"""Packing of documents into windows, planned by non-negative least squares on the histogram of lengths.

Each document is encoded and ended with one end id. Whole windows are cut off long documents first. What is left of each
document falls into one of ``CLASSES`` length classes; combinations of up to three classes that fill a window are enumerated, and
the repeat counts whose sum comes nearest to the histogram are found by non-negative least squares. The counts are
rounded down, documents are taken by class, and the residual documents fill the small gaps and then new windows greedily,
cut where a window ends. Packing runs over groups of about ``GROUP_IDS`` ids inside a task, so memory is bounded, nothing
is shuffled, and a group leaves at most one window partly filled.

* Null text: empty, one end id. Null ids are kept as null.
* Repeated rows or ids: each row is packed for itself. Ties are taken in the order of the table.
* Other columns are not carried. An empty table gives no piece.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hackstand.llm.common import narrow, text_slices
from hackstand.llm.tokens import encoder, vocabulary

WINDOW, END_ID = 2048, 1
CLASSES = 64
GROUP_IDS = 6_000_000
#: Shorter gaps are left as padding rather than filled by a cut.
LEAST_GAP = 8


@lru_cache(maxsize=4)
def combinations(classes: int) -> np.ndarray:
    """Columns of class counts (classes, k): one to three classes whose upper bounds fill a window up to two classes' width."""
    found = [(classes,), (classes - 1,)]
    for total in (classes, classes - 1, classes - 2):
        found += [(a, total - a) for a in range(1, total // 2 + 1)]
        found += [(a, b, total - a - b) for a in range(1, total // 3 + 1) for b in range(a, (total - a) // 2 + 1)]
    out = np.zeros((classes, len(found)))
    for k, combination in enumerate(found):
        for c in combination:
            out[c - 1, k] += 1
    return out


def nnls(a: np.ndarray, b: np.ndarray, sweeps: int = 25) -> np.ndarray:
    """Non-negative x that makes ``a @ x`` nearest to ``b``, by cyclic coordinate descent."""
    x, left = np.zeros(a.shape[1]), b.astype(float).copy()
    rows = [np.flatnonzero(a[:, k]) for k in range(a.shape[1])]
    weights = [a[r, k] for k, r in enumerate(rows)]
    norms = [float(w @ w) for w in weights]
    for _ in range(sweeps):
        moved = 0.0
        for k, (r, w, n) in enumerate(zip(rows, weights, norms)):
            new = max(0.0, x[k] + float(left[r] @ w) / n)
            step = new - x[k]
            if step:
                left[r] -= step * w
                x[k] = new
                moved = max(moved, abs(step))
        if moved < 0.25:
            break
    return x


def plan(lengths: np.ndarray, window: int = WINDOW, classes: int = CLASSES) -> np.ndarray:
    """Pieces (document, start, length, sequence, offset) of documents of the given lengths; every id in exactly one piece."""
    lengths = lengths.astype(np.int64)
    docs = np.arange(len(lengths))
    full = lengths // window
    owner = np.repeat(docs, full)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(full) - full, full)
    pieces = [np.stack([owner, nth * window, np.full(len(owner), window), np.arange(len(owner)), np.zeros(len(owner), np.int64)], 1)]
    sequences = len(owner)
    tails = lengths % window
    rest = docs[tails > 0]
    width = window // classes
    group = -(-tails[rest] // width)
    order = np.lexsort((rest, group))
    rest, group = rest[order], group[order]
    histogram = np.bincount(group - 1, minlength=classes)
    queue, stop = np.cumsum(histogram) - histogram, np.cumsum(histogram)
    columns = combinations(classes)
    counts = np.floor(nnls(columns, histogram)).astype(np.int64)
    gaps: list[np.ndarray] = []
    for k in np.argsort(-counts, kind="stable"):
        wanted = np.repeat(np.flatnonzero(columns[:, k]), columns[np.flatnonzero(columns[:, k]), k].astype(int))
        each = {c: int((wanted == c).sum()) for c in wanted}
        n = min([int(counts[k])] + [int((stop[c] - queue[c]) // m) for c, m in each.items()])
        if n <= 0:
            continue
        seq = sequences + np.arange(n)
        offset = np.zeros(n, np.int64)
        for c in wanted:
            own = rest[queue[c] : queue[c] + n]
            queue[c] += n
            size = tails[own]
            pieces.append(np.stack([own, lengths[own] - size, size, seq, offset], 1))
            offset = offset + size
        sequences += n
        gaps.append(np.stack([seq, offset, window - offset], 1)[window - offset >= LEAST_GAP])
    left = np.concatenate([rest[a:b] for a, b in zip(queue, stop)]) if len(rest) else rest
    if len(left):
        left = left[np.lexsort((left, -tails[left]))]
        total = int(tails[left].sum())
        fresh = -(-total // window)
        room = np.concatenate([*gaps, np.stack([sequences + np.arange(fresh), np.zeros(fresh, np.int64), np.full(fresh, window)], 1)])
        # documents and rooms both tile one line; every stretch between two marks of either is a piece
        ends, walls = np.cumsum(tails[left]), np.cumsum(room[:, 2])
        marks = np.unique(np.concatenate([[0], ends, walls[walls < total]]))
        a, size = marks[:-1], np.diff(marks)
        d, r = np.searchsorted(ends, a, "right"), np.searchsorted(walls, a, "right")
        own = left[d]
        inside = a - (ends[d] - tails[own])
        pieces.append(np.stack([own, lengths[own] - tails[own] + inside, size, room[r, 0], room[r, 1] + a - (walls[r] - room[r, 2])], 1))
    return np.concatenate(pieces)


def _pack(path: str, end_id: int, window: int):
    def run(batches):
        part = TaskContext.get().partitionId()
        held, count, sequence = [], 0, part << 32

        def flush():
            nonlocal sequence
            names = pa.concat_arrays([x for x, _, _ in held])
            sizes = np.concatenate([x for _, x, _ in held])
            ids = np.concatenate([x for _, _, x in held])
            first = np.cumsum(sizes) - sizes
            pieces = plan(sizes, window)
            begin = first[pieces[:, 0]] + pieces[:, 1]
            at = 0
            while at < len(pieces):  # batches of about 8 MB
                stop = at + 1000
                p, b = pieces[at:stop], begin[at:stop]
                cuts = np.append(0, np.cumsum(p[:, 2]))
                body = ids[np.repeat(b - cuts[:-1], p[:, 2]) + np.arange(cuts[-1])]
                binary = pa.Array.from_buffers(pa.binary(), len(p), [None, pa.py_buffer((cuts * 4).astype(np.int32)), pa.py_buffer(body)])
                yield pa.RecordBatch.from_arrays(
                    [names.take(pa.array(p[:, 0])), pa.array(p[:, 1]), pa.array(p[:, 2]), binary, pa.array(sizes[p[:, 0]]), pa.array(p[:, 3] + sequence), pa.array(p[:, 4])],
                    ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])
                at = stop
            sequence += int(pieces[:, 3].max()) + 1

        for batch in batches:
            for piece in text_slices(batch):
                ids, bounds = encoder(path).encode(piece.column("text"))
                sizes = np.diff(bounds) + 1
                closed = np.full(len(ids) + len(sizes), end_id, np.uint32)
                body = np.ones(len(closed), bool)
                body[np.cumsum(sizes) - 1] = False
                closed[body] = ids
                held.append((piece.column("doc_id"), sizes, closed))
                count += len(closed)
                if count >= GROUP_IDS:
                    yield from flush()
                    held, count = [], 0
        if held:
            yield from flush()

    return run


def pack(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocab: str | None = None, end_id: int = END_ID, window: int = WINDOW) -> DataFrame:
    """doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset of every piece."""
    return narrow(df, id_col, text_col).mapInArrow(
        _pack(vocab or vocabulary(), end_id, window), "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


def digest(df: DataFrame) -> DataFrame:
    return pack(df).withColumn("ids", F.crc32("ids")).withColumnRenamed("ids", "ids_crc32")
