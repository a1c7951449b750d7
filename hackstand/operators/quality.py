"""Quality profile on eight dimensions.

One aggregation pass measures all files at once; only uniqueness (grouped by key) and
validity (grouped by value) need a second grouping, and both combine on the map side.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from hackstand.functions.clock import minutes_between
from hackstand.functions.numeric import (
    count_where, exact_avg, guarded_ratio, half_up, pass_percent, percent, total,
)
from hackstand.operators.cleaning import FILE, ROW, TripRoles, flag_known_zone, roles_for
from hackstand.operators.columns import first_match
from hackstand.operators.selection import top_n_per_group
from hackstand.settings import DEFAULTS, QualityRules

DIMENSIONS = ("accuracy", "completeness", "consistency", "integrity",
              "reasonableness", "timeliness", "uniqueness", "validity")
#: Keys that one task counts where the number of rows is known.
KEYS_PER_TASK = 500_000


@dataclass(frozen=True)
class Profile:
    """What to measure on one source."""

    roles: TripRoles
    columns: tuple[str, ...]
    nullable: tuple[str, ...] = ()
    ranges: dict = field(default_factory=dict)
    total: str | None = None
    components: tuple[str, ...] = ()
    distance: str | None = None
    passengers: str | None = None
    request: str | None = None
    described: tuple[str, ...] = ()
    tolerance: float = 0.02
    max_minutes: int = 1440


def profile_for(category: str, columns, described=(), scope=("file_year", "file_month"),
                rules: QualityRules = DEFAULTS.quality) -> Profile:
    data = tuple(c for c in columns if c not in scope and c not in (FILE, ROW))
    spelled = {c.lower(): c for c in data}
    formula = rules.amount_formulas.get(category)
    parts = tuple(spelled[c.lower()] for c in (formula[1] if formula else ()) if c.lower() in spelled)
    return Profile(
        roles=roles_for(category, columns, rules.nullable, scope),
        columns=data,
        nullable=tuple(rules.nullable.get(category, ())),
        ranges={spelled[c.lower()]: r for c, r in rules.ranges.get(category, {}).items() if c.lower() in spelled},
        total=formula[0] if formula and parts and formula[0] in data else None,
        components=parts,
        distance=first_match(data, ("trip_distance", "trip_miles")),
        passengers=first_match(data, ("passenger_count",)),
        request=first_match(data, ("request_datetime",)),
        described=tuple(c for c in data if c in set(described)),
        tolerance=rules.amount_tolerance,
        max_minutes=rules.max_trip_minutes,
    )


def amount_gap(p: Profile) -> Column:
    return F.abs(F.col(p.total) - total([F.coalesce(F.col(c), F.lit(0.0)) for c in p.components]))


def _times(p: Profile) -> tuple[Column, Column]:
    return F.col(p.roles.pickup).try_cast("timestamp"), F.col(p.roles.dropoff).try_cast("timestamp")


def measures(p: Profile) -> dict[str, Column]:
    """Every aggregate of the single pass; unused ones are pruned by Catalyst."""
    out = {"rows": F.count(F.lit(1))}
    if p.total:
        gap = amount_gap(p)
        out["amount_rows"] = F.count(p.total)
        out["amount_bad"] = count_where(gap > p.tolerance)
        out["amount_max"] = F.max(gap)
    for c in p.columns:
        out[f"nulls_{c}"] = count_where(F.col(c).isNull())
    if p.roles.pickup:
        pickup = F.col(p.roles.pickup).try_cast("timestamp")
        out["pickups"] = F.count(pickup)
        if p.roles.file_year:
            on_time = (F.year(pickup) == F.col(p.roles.file_year)) & (F.month(pickup) == F.col(p.roles.file_month))
            out["off_period"] = count_where(~on_time)
        out["first_pickup"], out["last_pickup"] = F.min(pickup), F.max(pickup)
        if p.request:
            out["late_requests"] = count_where(pickup < F.col(p.request).try_cast("timestamp"))
    if p.roles.pickup and p.roles.dropoff:
        start, end = _times(p)
        length = minutes_between(start, end)
        out["inverted"] = count_where(end < start)
        out["too_long"] = count_where(length > p.max_minutes)
        out["longest"] = F.max(length)
    if p.distance:
        out["bad_distance"] = count_where(F.col(p.distance) < 0)
    if p.passengers:
        out["bad_passengers"] = count_where(F.col(p.passengers) < 0)
    for c, flag in ((p.roles.pu, "_known_pu"), (p.roles.do, "_known_do")):
        if c:
            out[f"placed_{c}"] = F.count(c)
            out[f"unplaced_{c}"] = count_where(F.col(c).isNotNull() & F.col(flag).isNull())
    for c, (low, high) in p.ranges.items():
        out[f"n_{c}"] = F.count(c)
        out[f"low_{c}"] = count_where(F.col(c) < low)
        out[f"high_{c}"] = count_where(F.col(c) > high)
        out[f"min_{c}"] = F.min(c).cast("double")
        out[f"max_{c}"] = F.max(c).cast("double")
    return out


def measure(df: DataFrame, zones: DataFrame, p: Profile) -> DataFrame:
    for location, flag in ((p.roles.pu, "_known_pu"), (p.roles.do, "_known_do")):
        if location:
            df = flag_known_zone(df, zones, location, flag)
    return df.groupBy(*p.roles.scope).agg(*[c.alias(n) for n, c in measures(p).items()])


def repeated_rows(df: DataFrame, p: Profile, rows: int | None = None) -> DataFrame:
    """Rows per file that share their key with another row: all members count.

    Nearly every row has a key of its own, so what a task holds grows with its rows. With ``rows``, the most rows there can be, the
    keys are dealt over as many tasks as they need; without it the session's number of shuffle partitions decides.
    """
    scope = p.roles.scope
    keys = df.select(*scope, *p.roles.keys)
    if rows is not None:
        keys = keys.repartition(max(1, math.ceil(rows / KEYS_PER_TASK)), *keys.columns)
    by_key = keys.groupBy(*keys.columns).agg(F.count(F.lit(1)).alias("_n"))
    return by_key.groupBy(*scope).agg(
        F.sum("_n").alias("key_rows"),
        F.sum(F.when(F.col("_n") > 1, F.col("_n")).otherwise(0)).alias("repeated"),
    )


def allowed_values(dictionary: DataFrame) -> DataFrame:
    """(column, value) pairs a dictionary admits: text before ``=``, or a leading Y / N."""
    text = F.trim("valor")
    code = F.trim(F.regexp_extract("valor", r"(.+?)\s*=", 1))
    flag = F.regexp_extract(text, r"^([YN])\b", 1)
    return (
        dictionary.filter(F.col("valor").isNotNull())
        .select(F.col("nombre_campo").alias("column"), F.explode(F.array(code, flag)).alias("value"))
        .filter("value <> ''").distinct()
    )


def value_counts(df: DataFrame, p: Profile) -> DataFrame:
    """Rows per file, described column and value; the shuffle carries counts, not rows."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in p.described])
    return (
        df.select(*p.roles.scope, F.inline(pairs)).filter(F.col("value").isNotNull())
        .groupBy(*p.roles.scope, "column", "value").agg(F.count(F.lit(1)).alias("n"))
    )


def judged_values(df: DataFrame, p: Profile, dictionary: DataFrame) -> DataFrame:
    """Value counts with ``valid``; columns whose dictionary lists no values are left out."""
    allowed = allowed_values(dictionary)
    listed = allowed.select("column").distinct()
    return (
        value_counts(df, p).join(listed, "column", "left_semi")
        .join(allowed.withColumn("_ok", F.lit(True)), ["column", "value"], "left")
        .withColumn("valid", F.coalesce("_ok", F.lit(False))).drop("_ok")
    )


def validity(df: DataFrame, p: Profile, dictionary: DataFrame) -> DataFrame:
    """Per file and column: non-null values, invalid ones, valid percent."""
    return (
        judged_values(df, p, dictionary).groupBy(*p.roles.scope, "column")
        .agg(F.sum("n").alias("filled"), F.sum(F.when(~F.col("valid"), F.col("n")).otherwise(0)).alias("invalid"))
        .withColumn("valid_pct", percent(F.col("filled") - F.col("invalid"), F.col("filled")))
    )


def _row(dimension: str, metric: str, value: Column, passed: Column) -> Column:
    return F.struct(F.lit(dimension).alias("dimension"), F.lit(metric).alias("metric"),
                    value.cast("double").alias("value"), passed.alias("passed"))


def _pct(bad: str, whole: str = "rows") -> Column:
    return pass_percent(F.col(bad), F.col(whole))


def _none(bad: str) -> Column:
    return F.col(bad) == 0


def unallowed_nulls(p: Profile) -> Column:
    optional = {c.lower() for c in p.nullable}
    strict = [F.col(f"nulls_{c}") for c in p.columns if c.lower() not in optional]
    return total(strict) if strict else F.lit(0)


def consistency_metrics(p: Profile) -> dict[str, tuple[Column, str]]:
    out = {}
    if p.roles.pickup and p.roles.dropoff:
        share = half_up(guarded_ratio(F.col("inverted"), F.col("rows")) * 100.0, 4)
        out["pickup_before_dropoff_pct"] = (half_up(F.lit(100.0) - share, 2), "inverted")
        if p.request:
            out["request_before_pickup_pct"] = (_pct("late_requests"), "late_requests")
        out["trip_duration_lt_24h_pct"] = (_pct("too_long"), "too_long")
    if p.distance:
        out[f"{p.distance}_non_negative_pct"] = (_pct("bad_distance"), "bad_distance")
    if p.passengers:
        out["passenger_count_non_negative_pct"] = (_pct("bad_passengers"), "bad_passengers")
    return out


def metric_rows(p: Profile, dimension: str) -> list[Column]:
    """The metrics of one dimension over a measured row."""
    if dimension == "accuracy" and p.total:
        ok = _none("amount_bad")
        return [
            _row(dimension, "total_amount_match_pct", _pct("amount_bad", "amount_rows"), ok),
            _row(dimension, "total_amount_mismatch_count", F.col("amount_bad"), ok),
            _row(dimension, "total_amount_max_diff", half_up(F.coalesce("amount_max", F.lit(0.0)), 4), ok),
        ]
    if dimension == "completeness":
        optional = {c.lower() for c in p.nullable}
        bad, cells = unallowed_nulls(p), F.col("rows") * len(p.columns)
        whole = _row(dimension, "completeness_score", half_up(half_up(1.0 - bad / cells, 4) * 100.0, 2), bad == 0)
        return [whole] + [
            _row(dimension, f"null_pct_{c}", percent(F.col(f"nulls_{c}"), F.col("rows"), 4),
                 F.lit(True) if c.lower() in optional else _none(f"nulls_{c}"))
            for c in p.columns
        ]
    if dimension == "consistency":
        return [_row(dimension, m, v, _none(bad)) for m, (v, bad) in consistency_metrics(p).items()]
    if dimension == "integrity":
        return [_row(dimension, f"{c}_valid_pct", _pct(f"unplaced_{c}", f"placed_{c}"), _none(f"unplaced_{c}"))
                for c in (p.roles.pu, p.roles.do) if c]
    if dimension == "reasonableness":
        rows = []
        for c in p.ranges:
            bad = F.col(f"low_{c}") + F.col(f"high_{c}")
            rows += [
                _row(dimension, f"{c}_in_range_pct", pass_percent(bad, F.col(f"n_{c}")), bad == 0),
                *[_row(dimension, f"{c}_{k}", F.col(f"{k}_{c}"), bad == 0) for k in ("low", "high", "min", "max")],
            ]
        return rows
    if dimension == "timeliness" and p.roles.pickup:
        return [_row(dimension, "pickup_in_period_pct", _pct("off_period", "pickups"), _none("off_period"))]
    return []


def metrics(measured: DataFrame, p: Profile, *dimensions: str) -> DataFrame:
    """Long rows (file, dimension, metric, value, passed) of the measured dimensions."""
    rows = [r for d in dimensions for r in metric_rows(p, d)]
    return measured.select(*p.roles.scope, F.inline(F.array(*rows)))


def _mean(parts: list[Column]) -> Column:
    return half_up(total(parts) / float(len(parts)), 4)


def _score(dimension: str, score: Column, passed: Column) -> Column:
    return F.struct(F.lit(dimension).alias("dimension"), score.cast("double").alias("score"), passed.alias("passed"))


def scores(df: DataFrame, zones: DataFrame, p: Profile, dictionary: DataFrame | None = None, rows: int | None = None) -> DataFrame:
    """Score and verdict of the eight dimensions per file; what does not apply scores 1. ``rows``: see ``repeated_rows``."""
    measured = measure(df, zones, p)
    scope = list(p.roles.scope)
    most, rows = rows, []
    if p.total:
        rows.append(_score("accuracy", half_up(_pct("amount_bad", "amount_rows") / 100.0, 4), _none("amount_bad")))
    if p.columns:
        bad = unallowed_nulls(p)
        rows.append(_score("completeness", half_up(1.0 - bad / (F.col("rows") * len(p.columns)), 4), bad == 0))
    checks = consistency_metrics(p)
    if checks:
        rows.append(_score("consistency", _mean([F.lit(1.0)] + [v / 100.0 for v, _ in checks.values()]),
                           reduce(Column.__and__, [_none(b) for _, b in checks.values()])))
    places = [c for c in (p.roles.pu, p.roles.do) if c]
    if places:
        rows.append(_score("integrity", _mean([_pct(f"unplaced_{c}", f"placed_{c}") / 100.0 for c in places]),
                           reduce(Column.__and__, [_none(f"unplaced_{c}") for c in places])))
    if p.ranges:
        out = {c: F.col(f"low_{c}") + F.col(f"high_{c}") for c in p.ranges}
        rows.append(_score("reasonableness", _mean([pass_percent(b, F.col(f"n_{c}")) / 100.0 for c, b in out.items()]),
                           reduce(Column.__and__, [b == 0 for b in out.values()])))
    timed = bool(p.roles.pickup and p.roles.file_year)
    if timed:
        rows.append(_score("timeliness", half_up(_pct("off_period", "pickups") / 100.0, 4), _none("off_period")))

    wide = measured
    if p.roles.keys:
        wide = wide.join(repeated_rows(df, p, most), scope, "left")
        rows.append(_score("uniqueness", half_up(pass_percent(F.col("repeated"), F.col("key_rows")) / 100.0, 4),
                           _none("repeated")))
    if dictionary is not None and p.described:
        by_file = validity(df, p, dictionary).groupBy(*scope).agg(
            (exact_avg(F.col("valid_pct")) / 100.0).alias("_valid"), F.sum("invalid").alias("_invalid"))
        wide = wide.join(by_file, scope, "left")
        known = all(c in p.described for c in p.columns)
        rows.append(_score("validity", half_up(F.coalesce("_valid", F.lit(1.0)), 4),
                           (F.coalesce("_invalid", F.lit(0)) == 0) & F.lit(known)))
    applies = {
        "accuracy": bool(p.total), "completeness": bool(p.columns), "consistency": bool(checks),
        "integrity": bool(places), "reasonableness": bool(p.ranges), "timeliness": timed,
        "uniqueness": bool(p.roles.keys), "validity": dictionary is not None and bool(p.described),
    }
    rows += [_score(d, F.lit(1.0), F.lit(True)) for d in DIMENSIONS if not applies[d]]
    return wide.select(*scope, F.inline(F.array(*rows)))


def without(p: Profile, dimension: str) -> Profile:
    """The profile with one dimension switched off."""
    roles = p.roles
    return {
        "accuracy": lambda: replace(p, total=None, components=()),
        "completeness": lambda: replace(p, columns=()),
        "consistency": lambda: replace(p, distance=None, passengers=None, request=None, roles=replace(roles, dropoff=None)),
        "integrity": lambda: replace(p, roles=replace(roles, pu=None, do=None)),
        "reasonableness": lambda: replace(p, ranges={}),
        "timeliness": lambda: replace(p, roles=replace(roles, file_year=None)),
        "uniqueness": lambda: replace(p, roles=replace(roles, keys=())),
        "validity": lambda: replace(p, described=()),
    }[dimension]()


def failing_dimensions(df: DataFrame, zones: DataFrame, p: Profile, dictionary: DataFrame | None = None) -> dict[str, str]:
    """Dimensions that cannot run over these columns, with the reason: a column is missing or has a type that cannot be measured.

    Each dimension is analysed alone; no job runs. Amounts and ranges ask for numbers, as text would end the job at its first odd value.
    """
    numbers = {"accuracy": [c for c in (p.total, *p.components) if c], "consistency": [c for c in (p.distance, p.passengers) if c],
               "reasonableness": list(p.ranges)}
    kinds = {f.name: f.dataType for f in df.schema.fields}
    failed = {}
    for dimension in DIMENSIONS:
        text = [c for c in numbers.get(dimension, ()) if c in kinds and not isinstance(kinds[c], NumericType)]
        if text:
            failed[dimension] = f"not a number: {', '.join(text)}"
            continue
        alone = reduce(without, [d for d in DIMENSIONS if d != dimension], p)
        try:
            scores(df, zones, alone, dictionary)
        except AnalysisException as error:
            failed[dimension] = error.getCondition() or "analysis"
    return failed


def safe_scores(df: DataFrame, zones: DataFrame, p: Profile, dictionary: DataFrame | None = None, rows: int | None = None) -> DataFrame:
    """``scores`` with ``error``: a dimension that cannot run scores 0 and fails, and the others are still measured."""
    failed = failing_dimensions(df, zones, p, dictionary)
    scored = scores(df, zones, reduce(without, failed, p), dictionary, rows)
    if not failed:
        return scored.withColumn("error", F.lit(None).cast("string"))
    reason = F.coalesce(*[F.when(F.col("dimension") == d, F.lit(why)) for d, why in failed.items()])
    return scored.withColumn("error", reason).withColumns({
        "score": F.when(F.col("error").isNull(), F.col("score")).otherwise(F.lit(0.0)),
        "passed": F.col("error").isNull() & F.col("passed")})


def report(scored: DataFrame, scope) -> DataFrame:
    """Overall score per file next to the eight results, which are gathered per file: the scores are computed once."""
    results = [c for c in scored.columns if c not in scope]
    overall = scored.dropna(subset=list(scope)).groupBy(*scope).agg(
        F.collect_list(F.struct(*results)).alias("_results"),
        half_up(exact_avg(F.col("score")), 4).alias("overall_score"),
        F.min(F.col("passed").cast("int")).cast("boolean").alias("all_passed"),
    )
    return overall.select(*scope, F.inline("_results"), "overall_score", "all_passed")


def summary(scored: DataFrame, category: str = "service_id") -> DataFrame:
    """Per category and dimension: mean score, failed files, worst score."""
    return scored.groupBy(category, "dimension").agg(
        F.count(F.lit(1)).alias("archivos"),
        half_up(exact_avg(F.col("score")), 4).alias("score_promedio"),
        count_where(~F.col("passed")).alias("meses_reprobados"),
        F.min(F.when(~F.col("passed"), F.col("score"))).alias("peor_score"),
    )


def worst_amounts(df: DataFrame, p: Profile, keys, n: int = 10) -> DataFrame:
    """The n largest gaps between a total and its components."""
    gap = half_up(amount_gap(p), 4)
    return (
        df.filter(amount_gap(p) > p.tolerance).select(*keys, p.total, gap.alias("_diff"))
        .orderBy(F.col("_diff").desc(), *keys).limit(n)
    )


def off_periods(df: DataFrame, p: Profile, n: int = 5) -> DataFrame:
    """The n months that appear most often in files of another month."""
    pickup = F.col(p.roles.pickup).try_cast("timestamp")
    on_time = (F.year(pickup) == F.col(p.roles.file_year)) & (F.month(pickup) == F.col(p.roles.file_month))
    return (
        df.filter(~on_time).groupBy(F.date_format(pickup, "yyyy-MM").alias("period"))
        .agg(F.count(F.lit(1)).alias("count")).orderBy(F.col("count").desc(), "period").limit(n)
    )


def invalid_values(df: DataFrame, p: Profile, dictionary: DataFrame, n: int = 5) -> DataFrame:
    """The n most frequent invalid values per described column."""
    counts = (
        judged_values(df, p, dictionary).filter(~F.col("valid"))
        .groupBy("column", "value").agg(F.sum("n").alias("ocurrencias"))
    )
    return top_n_per_group(counts, ["column"], [F.col("ocurrencias").desc(), F.col("value")], n).drop("_rank")


def emptiest_columns(df: DataFrame, p: Profile, n: int = 15) -> DataFrame:
    """Per file the n columns with the largest share of nulls, those without nulls left out. One pass for all columns and files."""
    scope = list(p.roles.scope)
    counts = df.groupBy(*scope).agg(F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(c)).alias(f"_c{i}") for i, c in enumerate(p.columns)])
    optional = {c.lower() for c in p.nullable}
    tall = counts.select(*scope, "_rows", F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), (F.col("_rows") - F.col(f"_c{i}")).alias("null_count"), F.lit(c.lower() in optional).alias("nullable")) for i, c in enumerate(p.columns)])))
    found = tall.filter("null_count > 0").withColumn("null_pct", percent(F.col("null_count"), F.col("_rows"), 4)).drop("_rows")
    return top_n_per_group(found, scope, [F.col("null_pct").desc(), F.col("column")], n).drop("_rank")


def unknown_zones(df: DataFrame, zones: DataFrame, p: Profile, n: int = 5) -> DataFrame:
    """Per file up to n zone ids that no zone has, the most frequent first: those of the pick-up, or of the drop-off where all pick-ups are known.

    Ids are counted before they are looked up, so the lookup sees one row per file and id.
    """
    scope = list(p.roles.scope)
    ends = [(i, c) for i, c in enumerate((p.roles.pu, p.roles.do)) if c is not None]
    ids = df.select(*scope, F.inline(F.array(*[F.struct(F.lit(i).alias("_end"), F.lit(c).alias("column"), F.col(c).alias("value")) for i, c in ends])))
    counts = ids.filter(F.col("value").isNotNull()).groupBy(*scope, "_end", "column", "value").agg(F.count(F.lit(1)).alias("ocurrencias"))
    bad = flag_known_zone(counts, zones, "value", "_known").filter(F.col("_known").isNull()).drop("_known")
    first = bad.groupBy(*[F.col(c).alias(f"_s_{c}") for c in scope]).agg(F.min("_end").alias("_first"))
    shown = bad.join(first, [*[F.col(c).eqNullSafe(F.col(f"_s_{c}")) for c in scope], F.col("_end") == F.col("_first")]).drop("_first", "_end", *[f"_s_{c}" for c in scope])
    return top_n_per_group(shown, scope, [F.col("ocurrencias").desc(), F.col("value")], n).drop("_rank")
