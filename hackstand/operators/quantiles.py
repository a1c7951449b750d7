"""Exact quantiles per group without gathering or ordering a group's values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hackstand.session import materialise

#: Half width of the first bracket, in steps of the sketch's accuracy.
FIRST_STEPS = 4
#: Sub-intervals that a bracket is cut into; a target never has more rows than this and two.
BINS = 1024


def exact_quantile(df: DataFrame, keys, value: str, p: float, alias: str, accuracy: int = 10_000) -> DataFrame:
    """Interpolated quantile ``p`` of ``value`` per key; see ``exact_quantiles``."""
    return exact_quantiles(df, keys, value, {alias: p}, accuracy)


def exact_quantiles(df: DataFrame, keys, value: str, wanted: dict[str, float], accuracy: int = 10_000) -> DataFrame:
    """Interpolated quantiles of ``value`` per key, equal to sorting each group; ``wanted`` maps column names to probabilities.

    A mergeable sketch brackets every quantile in one pass. Then brackets are narrowed: the values in one are counted by equal
    sub-intervals, and the sub-interval that holds the wanted rank, shrunk to the values in it, is the next bracket, until it holds
    one value. Values outside a bracket are counted with it, so a bracket off its target corrects itself and the sketch
    decides the cost of the result and never its value. Counts combine on the map side: a group of any size is spread over
    all tasks, and what meets per group and quantile is a row per sub-interval.
    """
    # up to three passes: the narrow rows are written once, so that nothing before them is computed again
    x = materialise(df.select(*keys, F.col(value).cast("double").alias("_x")).filter(F.col("_x").isNotNull()), "values")
    brackets, rest, found = materialise(_sketched(x, keys, wanted, accuracy), "brackets"), x, None
    while True:
        narrowed = materialise(_narrowed(rest, brackets, keys, first=rest is x), "brackets")
        settled = narrowed.filter("_lo = _hi")
        found = settled if found is None else found.unionByName(settled)
        brackets = narrowed.filter("_lo <> _hi")
        if brackets.isEmpty():
            break
        if rest is x:  # from here on only the few values inside brackets are read, each once
            rest = materialise(x.join(brackets, [*_same(keys), F.col("_x").between(F.col("_lo"), F.col("_hi"))], "left_semi"), "bracketed")
    following = F.when((F.col("_rank") + 1 < F.col("_skip") + F.col("_c")) | (F.col("_w") == 0), F.col("_lo")).otherwise(F.coalesce("_next", "_lo"))
    value_at = F.when(following == F.col("_lo"), F.col("_lo")).otherwise(F.col("_lo") + (following - F.col("_lo")) * F.col("_w"))
    return found.groupBy(*[F.col(f"_q_{k}").alias(k) for k in keys]).agg(*[F.max(F.when(F.col("_alias") == a, value_at)).alias(a) for a in wanted])


def _same(keys) -> list[Column]:
    return [F.col(k).eqNullSafe(F.col(f"_q_{k}")) for k in keys]


def _sketched(x: DataFrame, keys, wanted: dict[str, float], accuracy: int) -> DataFrame:
    """Per key and quantile: wanted rank (from 0), weight of the next value, bracket, values before it (0), next value after it."""
    pad = FIRST_STEPS / accuracy
    ends = [min(max(p + s, 0.0), 1.0) for p in wanted.values() for s in (-pad, pad)]
    sketch = x.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.percentile_approx("_x", ends, accuracy).alias("_b"))
    targets = F.array(*[F.struct(F.lit(a).alias("_alias"), (F.lit(p) * (F.col("_n") - 1)).alias("_pos"), F.col("_b")[2 * i].alias("_lo"), F.col("_b")[2 * i + 1].alias("_hi"))
                        for i, (a, p) in enumerate(wanted.items())])
    return sketch.select(*[F.col(k).alias(f"_q_{k}") for k in keys], F.inline(targets)).select(
        *[f"_q_{k}" for k in keys], "_alias", F.floor("_pos").alias("_rank"), (F.col("_pos") - F.floor("_pos")).alias("_w"), "_lo", "_hi",
        F.lit(0).cast("long").alias("_skip"), F.lit(None).cast("double").alias("_next"))


def sub_interval() -> Column:
    """Number of a value's sub-interval: -1 before the bracket, ``BINS`` after it. Each end has one of its own, so every round excludes values."""
    x, lo, hi = F.col("_x"), F.col("_lo"), F.col("_hi")
    share = F.nanvl((x / 2 - lo / 2) / F.nullif(hi / 2 - lo / 2, F.lit(0.0)), F.lit(0.0))  # halves: the difference cannot overflow
    inner = F.least(F.greatest(F.floor(share * (BINS - 2)) + 1, F.lit(1)), F.lit(BINS - 2)).cast("int")
    return F.when(x < lo, -1).when(x > hi, BINS).when(x == hi, BINS - 1).when(x == lo, 0).otherwise(F.coalesce(inner, F.lit(1)))


def _narrowed(x: DataFrame, brackets: DataFrame, keys, first: bool) -> DataFrame:
    """The brackets, each replaced by its sub-interval that holds the wanted rank."""
    target = [f"_q_{k}" for k in keys] + ["_alias", "_rank", "_w", "_skip", "_next"]
    # after the first round the values outside a bracket are known by their number and by the next one
    inside = F.lit(True) if first else F.col("_x").between(F.col("_lo"), F.col("_hi"))
    counts = x.join(brackets, [*_same(keys), inside]).groupBy(*target, sub_interval().alias("_bin")).agg(
        F.count(F.lit(1)).alias("_c"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
    by_bin = Window.partitionBy(*[f"_q_{k}" for k in keys], "_alias").orderBy("_bin")
    upto = F.sum("_c").over(by_bin.rowsBetween(Window.unboundedPreceding, 0))
    ranked = counts.withColumns({"_end": F.col("_skip") + upto, "_after": F.lead("_lo").over(by_bin)})
    start = F.col("_end") - F.col("_c")
    return ranked.filter((start <= F.col("_rank")) & (F.col("_rank") < F.col("_end"))).select(
        *target[:-2], "_lo", "_hi", start.alias("_skip"), F.coalesce("_after", "_next").alias("_next"), "_c")


def impute_median(df: DataFrame, keys, columns, medians: DataFrame | None = None) -> DataFrame:
    """NULL becomes the group's median of that column, or 0 if the group has none."""
    medians = group_medians(df, keys, columns) if medians is None else medians
    side = medians.select(*[F.col(k).alias(f"_m_{k}") for k in keys], *[F.col(c).alias(f"_med_{c}") for c in columns])
    joined = df.join(side, [F.col(k).eqNullSafe(F.col(f"_m_{k}")) for k in keys], "left")
    filled = {c: F.coalesce(F.col(c).cast("double"), F.col(f"_med_{c}"), F.lit(0.0)) for c in columns}
    return joined.withColumns(filled).drop(*[f"_m_{k}" for k in keys], *[f"_med_{c}" for c in columns])


def group_medians(df: DataFrame, keys, columns) -> DataFrame:
    """Medians of several columns per key, all columns in the same two passes."""
    pairs = F.array(*[F.struct(F.lit(c).alias("_feature"), F.col(c).cast("double").alias("_value")) for c in columns])
    tall = df.select(*keys, F.inline(pairs))
    found = exact_quantile(tall, [*keys, "_feature"], "_value", 0.5, "_median")
    return found.groupBy(*keys).agg(*[
        F.max(F.when(F.col("_feature") == c, F.col("_median"))).alias(c) for c in columns])
