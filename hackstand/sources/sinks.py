"""Table writers."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hackstand.operators.cleaning import FILE, REASON, ROW
from hackstand.operators.columns import union_drift
from hackstand.session import materialise
from hackstand.sources.files import exists, listing, partition_value, scan_mart
from hackstand.sources.footers import drift_report, read_footers

ROWS_PER_FILE = 2_000_000
KEYS = ("service_id", "year", "month")
#: Folder of the commit records; readers of the table skip names that begin with an underscore.
COMMITS = "_commits"
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def target_files(rows: int, rows_per_file: int = ROWS_PER_FILE, most: int = 32) -> int:
    return max(1, min(most, math.ceil(rows / rows_per_file)))


def _sized(df: DataFrame, keys) -> DataFrame:
    """Gather each partition's rows into few files; adaptive execution splits large ones."""
    return df.hint("rebalance", *keys) if keys else df.hint("rebalance")


def write_partitioned(df: DataFrame, path: str, keys=KEYS) -> None:
    """Replace only the partitions that ``df`` holds, then record them as committed.

    The record is written last. A job that dies before it leaves partitions without a record, which count as absent. A
    partition replaced again keeps its record, so a replacement that died has to be run again by its caller.
    """
    spark = df.sparkSession
    # unlike the listing itself, a written copy outlives the files that are replaced
    before = materialise(listing(spark, path).select("path"), "listing") if exists(spark, path) else None
    writer = _sized(df, keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.option("maxRecordsPerFile", ROWS_PER_FILE).partitionBy(*keys).parquet(path)
    added = listing(spark, path)
    if before is not None:
        added = added.join(before, "path", "left_anti")
    _partitions(added, keys).write.mode("append").parquet(f"{path}/{COMMITS}")


def _partitions(paths: DataFrame, keys) -> DataFrame:
    return paths.select(*[F.nullif(partition_value(F.col("path"), k), F.lit(NULL_FOLDER)).alias(k) for k in keys]).distinct()


def committed_partitions(spark: SparkSession, path: str, keys=KEYS) -> DataFrame:
    """Partitions whose write has finished, as strings."""
    if not exists(spark, f"{path}/{COMMITS}"):
        return spark.createDataFrame([], ", ".join(f"`{k}` string" for k in keys))
    return spark.read.schema(", ".join(f"`{k}` string" for k in keys)).parquet(f"{path}/{COMMITS}").distinct()


def write_incremental(df: DataFrame, path: str, keys=KEYS) -> None:
    """Write the partitions that are not committed yet; the others are left as they are.

    A partition that an interrupted job wrote in part has no record and is replaced as a whole.
    """
    done = committed_partitions(df.sparkSession, path, keys)
    same = [F.col(k).cast("string").eqNullSafe(F.col(f"_d_{k}")) for k in keys]
    write_partitioned(df.join(done.select(*[F.col(k).alias(f"_d_{k}") for k in keys]), same, "left_anti"), path, keys)


def write_stage_reject(tagged: DataFrame, path: str, scope) -> None:
    """Clean and rejected rows in one pass, as two branches of one table.

    Nothing is cached: one write routes every row, where two writes would scan twice.
    """
    outcome = F.when(F.col(REASON).isNull(), "stage").otherwise("reject")
    write_partitioned(tagged.drop(FILE, ROW).withColumn("outcome", outcome), path, ("outcome", *scope))


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).filter("outcome = 'stage'").drop("outcome", REASON)


def read_reject(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).filter("outcome = 'reject'").drop("outcome")


def export_table(spark: SparkSession, source: str, target: str, rows_per_file: int = 5 * ROWS_PER_FILE) -> int:
    """A partitioned table as plain snappy parquet with its keys as columns. Returns the number of files.

    Rows are gathered by size, so a small table is one file; none holds more than ``rows_per_file``.
    """
    writer = _sized(scan_mart(spark, source), ()).write.mode("overwrite").option("compression", "snappy")
    writer.option("maxRecordsPerFile", rows_per_file).parquet(target)
    return listing(spark, target).count()


def export_drift(spark: SparkSession, source: str, keys=KEYS) -> DataFrame:
    """Columns that only some partitions of ``source`` hold, from the footers: name, kinds, present, groups."""
    files = read_footers(listing(spark, source))
    return drift_report(files.select("*", *[partition_value(F.col("path"), k).alias(k) for k in keys]), *keys)


def drifted_columns(spark: SparkSession, paths) -> list[str]:
    """Columns of any path that the first path does not have."""
    schemas = [set(spark.read.parquet(p).columns) for p in paths]
    return sorted(set().union(*schemas) - schemas[0])


def merge_artifacts(tables: dict[str, DataFrame]) -> DataFrame:
    """Per-service model tables as one, with the service as a column."""
    return union_drift([df.withColumn("service_id", F.lit(s)) for s, df in tables.items()])
