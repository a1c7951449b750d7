"""Per-key numbering, flags, shares and differences that survive hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hackstand.functions.numeric import percent
from hackstand.operators.selection import top_n_per_group
from hackstand.session import materialise


def _prefixed(df: DataFrame, keys, prefix: str, *rest) -> DataFrame:
    return df.select(*[F.col(k).alias(f"{prefix}{k}") for k in keys], *rest)


def _attach(df: DataFrame, side: DataFrame, keys, prefix: str) -> DataFrame:
    """Left join on null-safe keys; adaptive execution splits a hot key on the left."""
    same = [F.col(k).eqNullSafe(F.col(f"{prefix}{k}")) for k in keys]
    return df.join(side, same, "left").drop(*[f"{prefix}{k}" for k in keys])


def with_key_stats(df: DataFrame, keys, **stats: Column) -> DataFrame:
    """Aggregates per key on every row: combine on the map side, then join back."""
    sums = df.groupBy(*keys).agg(*[c.alias(n) for n, c in stats.items()])
    return _attach(df, _prefixed(sums, keys, "_s_", *stats), keys, "_s_")


def numbered(df: DataFrame, keys, order, alias: str, parts: int | None = None) -> DataFrame:
    """Position 1..n of each row within its key by ``order`` (columns; null keys are a key of their own).

    Rows are dealt into ranges of (keys, order) by sampled splitters, so a key with many rows spans many ranges, each is numbered by
    itself and shifted by the key's rows in earlier ranges. The ranges are written once, so a lost task finds the same ones.
    Only rows equal in all of keys and order stay together; end ``order`` in a unique column.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    by = [*[F.col(k) for k in keys], *order]
    ranged = df.repartitionByRange(parts, *by) if parts else df.repartitionByRange(*by)
    placed = materialise(ranged.withColumn("_part", F.spark_partition_id()), "ranges")
    return _shifted(placed, keys, order, alias).drop("_part")


def _shifted(placed: DataFrame, keys, order, alias: str) -> DataFrame:
    counts = placed.groupBy(*keys, "_part").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    shifts = counts.withColumn("_shift", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    inside = F.row_number().over(Window.partitionBy(*keys, "_part").orderBy(*order))
    cells = [*keys, "_part"]
    out = _attach(placed.withColumn("_inside", inside), _prefixed(shifts, cells, "_r_", "_shift"), cells, "_r_")
    return out.withColumn(alias, (F.col("_inside") + F.col("_shift")).cast("int")).drop("_inside", "_shift")


def ordinal(df: DataFrame, keys, moment: str, ties, alias: str) -> DataFrame:
    """Position 1..n of each row within its key by time, then by ``ties``."""
    return numbered(df, keys, [moment, *ties], alias)


def run_flags(df: DataFrame, key: str, start: str = "inicio", ties=()) -> DataFrame:
    """Run number, latest-run flag and number of runs per key; history stays whole."""
    numbered = ordinal(df, [key], start, ties, "n_corrida")
    flagged = with_key_stats(numbered, [key], _last=F.max(start), total_corridas=F.count(F.lit(1)).cast("int"))
    return flagged.withColumn("es_ultima_corrida", F.col(start) == F.col("_last")).drop("_last")


def latest_per_key(df: DataFrame, keys, moment: str, ties=()) -> DataFrame:
    order = [F.col(moment).desc_nulls_last(), *ties]
    return top_n_per_group(df, keys, order, 1).drop("_rank")


def mode_per_group(counts: DataFrame, group, value: str, count: str) -> DataFrame:
    """Most frequent value per group of a table of counts; ties go to the smaller value."""
    return top_n_per_group(counts, group, [F.col(count).desc(), F.col(value)], 1).drop("_rank")


def group_share(counts: DataFrame, group, count: str, alias: str = "pct") -> DataFrame:
    """Share of each row in its group's total, in percent."""
    wide = with_key_stats(counts, group, _total=F.sum(count))
    return wide.withColumn(alias, percent(F.col(count), F.col("_total"))).drop("_total")


def gap_fill(series: DataFrame, keys, moment: str, value: str) -> DataFrame:
    """Every hour between a key's first and last one; hours without rows count 0."""
    spans = series.groupBy(*keys).agg(F.min(moment).alias("_a"), F.max(moment).alias("_b"))
    hours = spans.select(*keys, F.explode(F.sequence("_a", "_b", F.expr("interval 1 hour"))).alias(moment))
    return hours.join(series.select(*keys, moment, value), [*keys, moment], "left").withColumn(
        value, F.coalesce(F.col(value).cast("double"), F.lit(0.0))
    )


def lag_differences(series: DataFrame, keys, moment: str, value: str, season: int = 24) -> DataFrame:
    """First, seasonal and combined differences of a gap-free hourly series.

    One window per series; its length is bounded by the hours of the calendar.
    """
    w = Window.partitionBy(*keys).orderBy(moment)
    y = F.col(value)
    return series.select(
        *keys, moment, value,
        (y - F.lag(value, 1).over(w)).alias("d1"),
        (y - F.lag(value, season).over(w)).alias(f"d{season}"),
        (y - F.lag(value, 1).over(w) - F.lag(value, season).over(w) + F.lag(value, season + 1).over(w)).alias(f"d1_{season}"),
    )
