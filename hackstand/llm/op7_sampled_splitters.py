"""Sharding by sampled splitters: shards of nearly equal bytes from ranges of the key.

Keys are sampled with a chance in proportion to their size, quantiles of the sample bound many narrow ranges, every record
falls into one range, and ranges that turn out too full are sampled again and split. Exact byte and row counts of the
ranges then place each record: the key order is cut into shards at equal bytes, inside a range if need be.

* Size: UTF-8 bytes of the text (null: none) plus 8.
* A key that holds many bytes spans several ranges; its rows are spread over them by a hash of the text.
* Wholly equal rows are told apart by nothing and stand beside each other in any order. Null ids come first.
* Other columns are not carried. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hackstand.llm.common import narrow, shared_path

SHARDS = 24
RANGES_PER_SHARD, SAMPLES_PER_RANGE = 32, 8
#: A range is about this large at most, so their number, and what the driver holds of them, is input / RANGE_BYTES.
RANGE_BYTES = 256 << 20
LOWEST = -(2**63)


def _sized(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return narrow(df, id_col, text_col).select(
        "doc_id", "text", F.coalesce("doc_id", F.lit(LOWEST)).alias("k"), (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.xxhash64("text", "doc_id").alias("salt"))


def _draw(sized: DataFrame, per_byte: float, seed: int) -> np.ndarray:
    """Keys drawn by size, as often as their size says; the draw depends on the row alone."""
    chance = F.col("size") * F.lit(per_byte)
    u = F.pmod(F.xxhash64(F.lit(seed), "salt"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    times = (F.floor(chance) + (u < chance - F.floor(chance)).cast("int")).cast("int")
    got = sized.select("k", times.alias("n")).where("n > 0").toPandas()
    return np.sort(np.repeat(got["k"].to_numpy(np.int64), got["n"].to_numpy(np.int64)))


def _quantiles(keys: np.ndarray, parts: int) -> np.ndarray:
    return keys[(np.arange(1, parts) * len(keys)) // parts] if len(keys) and parts > 1 else np.zeros(0, np.int64)


def _range_of(splitters: np.ndarray):
    """Number of the range (b[i-1], b[i]]; a key that is several splitters spreads over the ranges between them."""

    @F.pandas_udf("long")
    def of(k: pd.Series, salt: pd.Series) -> pd.Series:
        keys, salts = k.to_numpy(np.int64), salt.to_numpy(np.int64)
        low, high = np.searchsorted(splitters, keys, "left"), np.searchsorted(splitters, keys, "right")
        return pd.Series(low + (salts & 0x7FFFFFFF) % np.maximum(1, high - low))

    return of("k", "salt")


def splitters(sized: DataFrame, total: int, shards: int) -> np.ndarray:
    ranges = max(shards * RANGES_PER_SHARD, -(-total // RANGE_BYTES))
    bounds = _quantiles(_draw(sized, ranges * SAMPLES_PER_RANGE / total, 1), ranges)
    counted = _count(sized, bounds)
    full = counted[counted["bytes"] > 2 * total / ranges]
    if len(full):
        ids = full["r"].to_numpy(np.int64)
        inside = sized.withColumn("r", _range_of(bounds)).where(F.col("r").isin([int(x) for x in ids]))
        more = _draw(inside.drop("r"), 4 * ranges * SAMPLES_PER_RANGE / total, 2)
        finer, where = [bounds], np.searchsorted(bounds, more, "left")
        for r, size in zip(ids, full["bytes"]):
            finer.append(_quantiles(more[where == r], int(np.ceil(size * ranges / total))))
        bounds = np.sort(np.concatenate(finer))
    return bounds


def _count(sized: DataFrame, bounds: np.ndarray) -> pd.DataFrame:
    """Bytes and rows of every range that has rows, in range order."""
    return (sized.select(_range_of(bounds).alias("r"), "size").groupBy("r").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
            .toPandas().sort_values("r", ignore_index=True))


def place(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS) -> DataFrame:
    """doc_id, text, size, shard, position (row number over all shards, in shard order)."""
    sized = _sized(df, id_col, text_col)
    total = sized.agg(F.sum("size")).first()[0]
    if not total:
        return sized.select("doc_id", "text", "size", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("position"))
    bounds = splitters(sized, total, shards)
    counted = _count(sized, bounds)
    before = np.zeros((len(bounds) + 2, 2), np.int64)
    before[counted["r"].to_numpy(np.int64) + 1] = counted[["bytes", "rows"]].to_numpy(np.int64)
    before = np.cumsum(before, axis=0)

    def offset(column):
        @F.pandas_udf("long")
        def of(r: pd.Series) -> pd.Series:
            return pd.Series(before[r.to_numpy(np.int64), column])

        return of("r")

    order = Window.partitionBy("r").orderBy("k", "salt")  # a range is bounded by RANGE_BYTES, whatever the input
    inside = sized.withColumn("r", _range_of(bounds)).select(
        "doc_id", "text", "size", "r", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("upto"), F.row_number().over(order).alias("nth"))
    middle = F.col("start") + F.col("upto") - F.col("size") / 2
    return inside.withColumn("start", offset(0)).withColumn("earlier", offset(1)).select(
        "doc_id", "text", "size", F.least(F.lit(shards - 1), F.floor(middle * shards / F.lit(float(total)))).cast("int").alias("shard"),
        (F.col("earlier") + F.col("nth") - 1).cast("long").alias("position"))


def write_shards(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS) -> None:
    """One folder per shard with doc_id, text, size and position."""
    place(df, id_col, text_col, shards).write.partitionBy("shard").option("compression", "zstd").parquet(path)


def read_shards(spark, path: str) -> DataFrame:
    """The written records with their slot: the row number inside the shard, from 0."""
    schema = "doc_id long, text string, size long, position long, shard int"
    rows = spark.read.schema(schema).parquet(path)
    first = rows.groupBy("shard").agg(F.min("position").alias("first"))
    return rows.join(F.broadcast(first), "shard").select("doc_id", "text", "size", "shard", (F.col("position") - F.col("first")).alias("slot"))


def digest(df: DataFrame) -> DataFrame:
    path = shared_path(df.sparkSession, "shards")
    write_shards(df, path)
    return read_shards(df.sparkSession, path).select(
        "doc_id", "size", F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
