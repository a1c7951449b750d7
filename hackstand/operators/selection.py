"""Filters, ordering, paging, top-k and sampling."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def filter_dynamic(df: DataFrame, wanted: dict) -> DataFrame:
    """AND of column tests: a list means IN, a scalar means =, None is ignored."""
    tests = [
        F.col(c).isin(*v) if isinstance(v, (list, tuple, set)) else F.col(c) == v
        for c, v in wanted.items() if v is not None
    ]
    return df.filter(reduce(Column.__and__, tests)) if tests else df


def filter_time_range(df: DataFrame, column: str, start: str | None, end: str | None) -> DataFrame:
    """Between ``start`` and ``end``; a bare end date includes its whole day."""
    if start:
        df = df.filter(F.col(column) >= F.lit(start).cast("timestamp"))
    if end:
        last = end if "T" in end else f"{end[:10]}T23:59:59"
        df = df.filter(F.col(column) <= F.lit(last).cast("timestamp"))
    return df


def filter_audit(df: DataFrame, category: str | None = None, year: int | None = None) -> DataFrame:
    """Substring tests on the first of ``source_file`` / ``mart_name`` present."""
    name = next((c for c in ("source_file", "mart_name") if c in df.columns), None)
    if name is None:
        return df
    if category:
        df = df.filter(F.col(name).contains(category))
    if year is not None:
        df = df.filter(F.col(name).contains(f"{year}-"))
    return df


def ordering(order_by) -> list[Column]:
    return [F.col(c).desc_nulls_last() if d == "desc" else F.col(c).asc_nulls_last() for c, d in order_by]


def sort_multi(df: DataFrame, order_by) -> DataFrame:
    return df.orderBy(*ordering(order_by))


def page(df: DataFrame, order_by, limit: int | None = None, offset: int | None = None) -> DataFrame:
    """A page of a totally ordered result; ``order_by`` should end in a unique column."""
    df = sort_multi(df, order_by) if order_by else df
    if offset:
        df = df.offset(offset)
    return df if limit is None else df.limit(limit)


def top_values(df: DataFrame, column: str, n: int) -> DataFrame:
    """The n most frequent values, ties by value."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("ocurrencias"))
    return counts.orderBy(F.col("ocurrencias").desc(), F.col(column)).limit(n)


def top_n_per_group(df: DataFrame, group, order, n: int, rank: str = "_rank") -> DataFrame:
    """First n rows per group. Catalyst limits each map task to n rows per group before the
    shuffle (n up to ``spark.sql.optimizer.windowGroupLimitThreshold``), so a hot group is cheap."""
    place = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn(rank, place).filter(F.col(rank) <= n)


def top_n_with_rest(df: DataFrame, group, label: str, value: str, n: int, rest: str) -> DataFrame:
    """The n largest labels per group and one row with the sum of all others.

    The remainder is the group total less the kept rows, so no task sees a whole group.
    """
    kept = top_n_per_group(df, group, [F.col(value).desc(), F.col(label)], n).select(*group, label, value)
    sums = df.groupBy(*group).agg(F.sum(value).alias("_all"), F.count(F.lit(1)).alias("_labels"))
    shown = kept.groupBy(*group).agg(F.sum(value).alias("_shown"))
    others = sums.filter(F.col("_labels") > n).join(shown, group).select(
        *group, F.lit(rest).alias(label), (F.col("_all") - F.col("_shown")).alias(value)
    )
    return kept.unionByName(others)


def draw(key: Column, salt: str = "") -> Column:
    """A uniform draw in [0, 1) fixed by the key: the first 32 bits of its MD5."""
    text = F.concat(key.cast("string"), F.lit(salt))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def sample_fraction(df: DataFrame, key: Column, fraction: float, salt: str = "") -> DataFrame:
    """Bernoulli sample by key hash: the same rows whatever the layout or retries."""
    return df.filter(draw(key, salt) < fraction)


def sample_cap(df: DataFrame, group, key: Column, cap: int, salt: str = "") -> DataFrame:
    """At most ``cap`` rows per group: those with the smallest draws.

    Group sizes come from a combinable count. A threshold a little above cap/size thins each
    group to about ``cap`` rows before any ranking, so no task ever holds a whole group.
    """
    sizes = df.groupBy(*group).agg(F.count(F.lit(1)).alias("_n")).select(
        *[F.col(c).alias(f"_g_{c}") for c in group], "_n"
    )
    same = [F.col(c).eqNullSafe(F.col(f"_g_{c}")) for c in group]
    slack = cap + 8.0 * cap**0.5 + 64.0
    drawn = df.withColumn("_draw", draw(key, salt)).join(sizes, same).filter(
        F.col("_draw") < F.lit(slack) / F.col("_n")
    )
    place = F.row_number().over(Window.partitionBy(*group).orderBy("_draw", key))
    return (
        drawn.withColumn("_place", place).filter(F.col("_place") <= cap)
        .drop("_n", "_draw", "_place", *[f"_g_{c}" for c in group])
    )
