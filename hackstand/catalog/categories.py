"""Queries: cleaning and profile of each category under the column names, nullable sets, ranges and formulas of its own files."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hackstand import fixed_values as fv
from hackstand.catalog.registry import query
from hackstand.catalog.sql import compose, half, pass_pct, pct, xavg, xsum
from hackstand.catalog.tables import BRONZE
from hackstand.functions.numeric import exact_sum
from hackstand.operators import cleaning
from hackstand.operators import quality as q

SCOPE = ("file_year", "file_month")
# What the data dictionaries of the categories list: field, described value.
DESCRIBED = {
    "yellow": (("RatecodeID", "1 = Standard rate"), ("RatecodeID", "2 = JFK"), ("RatecodeID", "3 = Newark"), ("payment_type", "1 = Credit card"),
               ("payment_type", "2 = Cash"), ("store_and_fwd_flag", "Y = store and forward trip"), ("store_and_fwd_flag", "N = not a store and forward trip")),
    "green": (("payment_type", "1 = Credit card"), ("payment_type", "2 = Cash"), ("payment_type", "3 = No charge"), ("payment_type", "4 = Dispute")),
    "fhv": (),
    "fhvhv": (("hvfhs_license_num", "HV0002 = Juno"), ("hvfhs_license_num", "HV0003 = Uber"), ("hvfhs_license_num", "HV0005 = Lyft"),
              ("shared_match_flag", "Y = shared"), ("shared_match_flag", "N = alone")),
}


def _per_category(build) -> DataFrame:
    return reduce(DataFrame.unionByName, [build(c).withColumn("service_id", F.lit(c)) for c in fv.SERVICES])


def _clean(t, category: str) -> DataFrame:
    """Outcomes per file and the money of its rows; ranking after the row rules, so that ties of copies cannot change a count."""
    bronze = t.bronze(category)
    roles = cleaning.roles_for(category, bronze.columns)
    money = roles.prefer[0] if roles.prefer else None
    return cleaning.tag_rejects(bronze, t.zones, roles, dedup_after_rejects=True).groupBy(*SCOPE, F.coalesce(cleaning.REASON, F.lit("clean")).alias("outcome")).agg(
        F.count(F.lit(1)).alias("filas"), (exact_sum(F.col(money)) if money else F.lit(None).cast("double")).alias("importe"))


def _profile(t, category: str) -> q.Profile:
    listed = {field for field, _ in DESCRIBED[category]}
    return q.profile_for(category, [*BRONZE[category], *SCOPE, cleaning.FILE, cleaning.ROW], listed)


def _dictionary(t, category: str) -> DataFrame:
    return t.spark.createDataFrame(list(DESCRIBED[category]), "nombre_campo string, valor string")


def _scores(t, category: str) -> DataFrame:
    return q.safe_scores(t.bronze(category), t.zones, _profile(t, category), _dictionary(t, category), t.most_trips)


# ---- SQL ----

_IDS = "(select location_id from zones)"


def _role(category: str, names) -> str:
    return next(c for c in names if c in BRONZE[category])


def _source(category: str) -> str:
    names = ", ".join(f'{ours} as "{theirs}"' for theirs, ours in BRONZE[category].items())
    pu, do = (next(ours for theirs, ours in BRONZE[category].items() if theirs in names) for names in (fv.PU_NAMES, fv.DO_NAMES))
    return (f"(select {names}, file_year, file_month, {pu} not in {_IDS} as bad_pu, {do} not in {_IDS} as bad_do "
            f"from trips where service_id = '{category}')")


def _strict(category: str) -> list[str]:
    optional = {c.lower() for c in fv.NULLABLE[category]}
    return [c for c in BRONZE[category] if c.lower() not in optional]


def _keys(category: str) -> str:
    return ", ".join(f'"{c}"' for c in fv.TRIP_KEYS[category])


def _outcomes(category: str) -> str:
    start, end = _role(category, fv.PICKUP_NAMES), _role(category, fv.DROPOFF_NAMES)
    pu, do = _role(category, fv.PU_NAMES), _role(category, fv.DO_NAMES)
    money = next((c for c in ("total_amount", "driver_pay") if c in BRONZE[category]), None)
    nulls = " ".join(f"when \"{c}\" is null then 'incomplete_{c}'" for c in _strict(category))
    ranked = (f"row_number() over (partition by reason is null, file_year, file_month, {_keys(category)} order by {money or start} desc nulls last)")
    return f"""
    select '{category}' as service_id, file_year, file_month, case when reason is not null then reason when rn > 1 then 'uniqueness_duplicate' else 'clean' end as outcome,
      count(*) as filas, {xsum(money) if money else 'cast(null as double)'} as importe
    from (select *, {ranked} as rn from (
      select *, case {nulls} when year("{start}") <> file_year or month("{start}") <> file_month then 'timeliness_off_period'
        when "{end}" < "{start}" then 'datetime_inverted' when bad_pu then 'integrity_invalid_{pu}' when bad_do then 'integrity_invalid_{do}' end as reason
      from {_source(category)})) group by all"""


def _n(condition: str) -> str:
    return f"count(case when {condition} then 1 end)"


def _mean(parts) -> str:
    return half(f"({' + '.join(parts)})/{len(parts)}e0", 4)


def _dimensions(category: str) -> dict[str, tuple[str, str]]:
    """Score and verdict of the dimensions that one grouping of the rows can say; absent ones do not apply."""
    data = list(BRONZE[category])
    start, end = _role(category, fv.PICKUP_NAMES), _role(category, fv.DROPOFF_NAMES)
    pu, do = _role(category, fv.PU_NAMES), _role(category, fv.DO_NAMES)
    out = {}
    whole, parts = fv.AMOUNT_FORMULAS.get(category, (None, ()))
    if whole in data:
        gap = f"abs({whole} - (" + " + ".join(f"coalesce({c}, 0e0)" for c in parts if c in data) + "))"
        bad = _n(f"{gap} > 0.02")
        out["accuracy"] = half(pass_pct(bad, f"count({whole})") + "/100e0", 4), f"{bad} = 0"
    nulls = "(" + " + ".join(f'count(*) - count("{c}")' for c in _strict(category)) + ")"
    out["completeness"] = half(f"1e0 - cast({nulls} as double)/(count(*)*{len(data)})", 4), f"{nulls} = 0"
    inverted = _n(f'"{end}" < "{start}"')
    checks = [(half(f"100e0 - {half(f'cast({inverted} as double)/count(*)*100e0', 4)}"), inverted)]
    rules = [f'"{start}" < request_datetime'] if "request_datetime" in data else []
    rules += [f'(epoch("{end}") - epoch("{start}"))/60e0 > 1440'] + [f"{c} < 0" for c in ("trip_distance", "trip_miles", "passenger_count") if c in data]
    checks += [(pass_pct(_n(r), "count(*)"), _n(r)) for r in rules]
    out["consistency"] = _mean(["1e0"] + [f"{v}/100e0" for v, _ in checks]), " and ".join(f"{b} = 0" for _, b in checks)
    out["integrity"] = (_mean([f"{pass_pct(_n(b), f'count({c})')}/100e0" for b, c in (("bad_pu", f'"{pu}"'), ("bad_do", f'"{do}"'))]),
                        f"{_n('bad_pu')} = 0 and {_n('bad_do')} = 0")
    ranges = {c: r for c, r in fv.RANGES[category].items() if c in data}
    if ranges:
        wrong = {c: _n(f"{c} < {low} or {c} > {high}") for c, (low, high) in ranges.items()}
        out["reasonableness"] = (_mean([f"{pass_pct(b, f'count({c})')}/100e0" for c, b in wrong.items()]), " and ".join(f"{b} = 0" for b in wrong.values()))
    off = _n(f'year("{start}") <> file_year or month("{start}") <> file_month')
    out["timeliness"] = half(pass_pct(off, f'count("{start}")') + "/100e0", 4), f"{off} = 0"
    return out


def _score_sql(category: str) -> str:
    source, keep = _source(category), f"'{category}' as service_id, file_year, file_month"
    found = _dimensions(category)
    # the grouped values are named first: one grouping serves every dimension
    wide = f"(select file_year, file_month, " + ", ".join(f"{v} as s_{d}, {ok} as p_{d}" for d, (v, ok) in found.items()) + f" from {source} group by 1, 2)"
    rows = [f"select {keep}, '{d}' as dimension, s_{d} as score, p_{d} as passed from {wide}" for d in found]
    twice = "sum(case when n > 1 then n else 0 end)"
    rows.append(f"select {keep}, 'uniqueness', {half(pass_pct(twice, 'sum(n)') + '/100e0', 4)}, {twice} = 0 from "
                f"(select file_year, file_month, count(*) as n from {source} group by file_year, file_month, {_keys(category)}) group by 1, 2, 3")
    allowed = {}
    for field, value in DESCRIBED[category]:
        allowed.setdefault(field, []).append(value.split(" =")[0])
    if allowed:
        valid = " union all ".join(
            f"select file_year, file_month, {pct(_n(f'cast({c} as varchar) in ({values})'), f'count({c})')} as v from {source} group by 1, 2 having count({c}) > 0"
            for c, values in ((c, ", ".join(f"'{v}'" for v in vs)) for c, vs in allowed.items()))
        rows.append(f"select {keep}, 'validity', {half(xavg('v') + '/100e0', 4)}, false from ({valid}) group by 1, 2, 3")
    applied = {*found, "uniqueness", *(["validity"] if allowed else [])}
    rows += [f"select {keep}, '{d}', 1e0, true from {source} group by 1, 2, 3" for d in q.DIMENSIONS if d not in applied]
    return " union all ".join(rows)


_SCORED = "(" + " union all ".join(_score_sql(c) for c in fv.SERVICES) + ")"
query("category_clean", compose(" union all ".join(_outcomes(c) for c in fv.SERVICES)))(lambda t: _per_category(lambda c: _clean(t, c)))
query("category_profile", compose(f"select *, cast(null as varchar) as error from {_SCORED}"))(lambda t: _per_category(lambda c: _scores(t, c)))
query("category_report", compose(f"""
select service_id, file_year, file_month, {half(xavg('score'), 4)} as overall_score, bool_and(passed) as all_passed, count(*) as dimensiones
from {_SCORED} group by 1, 2, 3
"""))(lambda t: q.report(_per_category(lambda c: _scores(t, c)), ["service_id", *SCOPE]).groupBy("service_id", *SCOPE).agg(
    F.first("overall_score").alias("overall_score"), F.first("all_passed").alias("all_passed"), F.count(F.lit(1)).alias("dimensiones")))
