"""Running streams into tables on the shared storage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hackstand.operators.selection import filter_dynamic, top_n_per_group
from hackstand.session import scratch_path

BATCH, BASE, UPTO = "_batch", "base", "upto"
#: Batches between two merges; a table has at most twice as many batch folders and two bases.
COMPACT_EVERY = 16


def append_table(rows: DataFrame, path: str, checkpoint: str, available_now: bool = True):
    """Append-mode rows to parquet with exactly-once file commits."""
    writer = rows.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)


def upsert_table(groups: DataFrame, path: str, checkpoint: str, available_now: bool = True, keys=None, compact_every: int = COMPACT_EVERY,
                 keep: Callable[[DataFrame], DataFrame] | None = None):
    """Changed groups of every micro-batch, one folder per batch, merged into a base every ``compact_every`` batches.

    A batch that runs again after a failure replaces its own folder, so the table stays exact. Without ``keys`` nothing is merged.
    """
    spark = groups.sparkSession

    def write(changed: DataFrame, batch_id: int) -> None:
        changed.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")
        if keys and batch_id % compact_every == compact_every - 1:
            compact(spark, path, keys, batch_id, keep)

    writer = groups.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration())


def _committed(spark: SparkSession, folder: str, name: str) -> dict[int, str]:
    """Complete folders ``name=N`` by N. Their number is bounded by compaction. A folder counts once its writer has put the success
    mark into it, as the last and atomic act of a write; what a crash leaves half-written is not seen."""
    fs, of = _file_system(spark, folder), spark._jvm.org.apache.hadoop.fs.Path
    if not fs.exists(of(folder)):
        return {}
    names = [s.getPath().getName() for s in fs.listStatus(of(folder))]
    found = {int(n.split("=")[1]): f"{folder}/{n}" for n in names if n.startswith(f"{name}=")}
    return {n: p for n, p in sorted(found.items()) if fs.exists(of(f"{p}/_SUCCESS"))}


def _rows(spark: SparkSession, path: str, after: int = -1, upto: int | None = None, schema=None) -> DataFrame | None:
    """The newest base and the batches after it, with the batch each row was written in; None for an empty table."""
    bases = {n: p for n, p in _committed(spark, f"{path}/{BASE}", UPTO).items() if upto is None or n <= upto}
    newest = max(bases, default=-1)
    deltas = [p for n, p in _committed(spark, path, BATCH).items() if n > max(newest, after) and (upto is None or n <= upto)]
    reader = spark.read if schema is None else spark.read.schema(schema)
    parts = [reader.option("basePath", path).parquet(*deltas).withColumn(BATCH, F.col(BATCH).cast("long"))] if deltas else []
    if newest > after:
        parts.append(spark.read.parquet(bases[newest]))
    if not parts:
        return None
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return rows.filter(F.col(BATCH) > after) if after >= 0 else rows


def _newest(rows: DataFrame, keys) -> DataFrame:
    return top_n_per_group(rows, keys, [F.col(BATCH).desc()], 1).drop("_rank")


def compact(spark: SparkSession, path: str, keys, upto: int, keep: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Merge the newest base and the batches up to ``upto`` into a new base, then drop what the base before it had replaced.

    Every row keeps the batch it was last changed in, so increments stay exact across bases. The new base takes effect with its
    success mark. Files that readers of the base before may still hold stay until the next compaction. ``keep`` may drop rows, such as expired ones.
    """
    rows = _rows(spark, path, upto=upto)
    bases = [n for n in _committed(spark, f"{path}/{BASE}", UPTO) if n < upto]
    if rows is not None:
        merged = _newest(rows, keys)
        (keep(merged) if keep else merged).write.mode("overwrite").parquet(f"{path}/{BASE}/{UPTO}={upto}")
    fs, of = _file_system(spark, path), spark._jvm.org.apache.hadoop.fs.Path
    before = max(bases, default=-1)
    old = [p for n, p in _committed(spark, path, BATCH).items() if n <= before] + [f"{path}/{BASE}/{UPTO}={n}" for n in bases if n < before]
    for folder in old:
        fs.delete(of(folder), True)


def latest(spark: SparkSession, path: str, keys, schema=None) -> DataFrame:
    """Current value of every group: its row from the newest batch that touched it."""
    rows = _rows(spark, path, schema=schema)
    if rows is None:
        if schema is None:
            raise FileNotFoundError(f"no batch has been written to {path}")
        return spark.createDataFrame([], schema)
    return _newest(rows, keys).drop(BATCH)


def increments(spark: SparkSession, path: str, keys, after_batch: int, filters=None) -> DataFrame:
    """Groups changed after a snapshot was taken, each once, as its newest batch left it; before any batch, none."""
    rows = _rows(spark, path, after=after_batch)
    if rows is None:
        everything = _rows(spark, path)
        if everything is None:
            raise FileNotFoundError(f"no batch has been written to {path}")
        rows = everything.limit(0)
    return filter_dynamic(_newest(rows, keys), filters or {})


def run_append(rows: DataFrame, label: str) -> DataFrame:
    """Drain a stream into a new table and read it back."""
    spark = rows.sparkSession
    path = scratch_path(spark, label)
    query = append_table(rows, path, f"{path}-checkpoint")
    query.awaitTermination()
    return spark.read.schema(rows.schema).parquet(path)


def run_upsert(groups: DataFrame, keys, label: str) -> DataFrame:
    """Drain an aggregation into a new upsert table and read its current state."""
    spark = groups.sparkSession
    path = scratch_path(spark, label)
    query = upsert_table(groups, path, f"{path}-checkpoint", keys=keys)
    query.awaitTermination()
    return latest(spark, path, keys)
