"""What the corpus operators share: narrow inputs, the shared folder, bounded slices of Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hackstand.session import by_shuffle, materialise, scratch_path

#: Bytes of text that one step inside a task holds with its temporary arrays.
SLICE_BYTES = 4 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def narrow(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id (as long) and the text, under fixed names: no other column of ``df`` can clash."""
    return df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))


def row_key(doc_id: str | Column = "doc_id", text: str | Column = "text") -> Column:
    """64 bits of a row's id and text; equal rows share it, nulls count as values of their own."""
    doc_id, text = (F.col(c) if isinstance(c, str) else c for c in (doc_id, text))
    return F.xxhash64(doc_id.isNull(), doc_id, text.isNull(), text)


def free_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def store(df: DataFrame, label: str) -> DataFrame:
    """Write once to the shared folder and read back."""
    return materialise(df, label)


#: Rows of a few numbers that may be broadcast (about 50 MB on a worker).
BROADCAST_ROWS = 1_000_000


def if_small(stored: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A written table of narrow rows, to be broadcast if it has few; a larger one is joined by shuffle."""
    return F.broadcast(stored) if stored.limit(rows + 1).count() <= rows else by_shuffle(stored)


def shared_path(spark: SparkSession, label: str) -> str:
    return scratch_path(spark, label)


def text_slices(batch: pa.RecordBatch, column: str = "text", budget: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of a batch with about ``budget`` bytes of text each; a longer text is alone."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends, start = np.cumsum(sizes), 0
    while start < len(ends):
        base = ends[start] - sizes[start]
        stop = max(start + 1, int(np.searchsorted(ends, base + budget, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def small_batches(spark: SparkSession, size: int = 2 * SLICE_BYTES) -> None:
    """Arrow batches of about ``size`` bytes in this session: whole rows go through Python in few at a time, however long their texts. Results stay the same."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


#: What operators keep in a worker from task to task, one store each.
_KEPT: list[dict] = []


def kept() -> dict:
    """A store for what a worker keeps from task to task until another operator's task calls ``forget``."""
    _KEPT.append({})
    return _KEPT[-1]


def forget() -> None:
    """Drop what tasks of other operators left in this worker: Spark uses its workers again, and their memory adds up over the steps of a job."""
    if any(_KEPT):
        for store_ in _KEPT:
            store_.clear()
        pa.default_memory_pool().release_unused()


def crc_fold(column: str = "doc_id") -> Column:
    """The unsigned crc32 of an id's decimal text; null for a null id."""
    return F.crc32(F.encode(F.col(column).cast("string"), "UTF-8"))
