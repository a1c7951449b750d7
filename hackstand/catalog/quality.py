"""Queries: the eight-dimension quality profile, one row set per source file."""

from pyspark.sql import functions as F

from hackstand.catalog.registry import query
from hackstand.catalog.sql import compose, half, pass_pct, pct, time, xavg
from hackstand.catalog.tables import TRIP_REQUIRED, TRIP_ROLES
from hackstand.operators import quality as q

COLUMNS = TRIP_REQUIRED + ("on_scene_datetime", "store_and_fwd_flag")
RANGES = {"passenger_count": (0, 5), "trip_distance": (2, 48), "fare_amount": (1000, 90000)}
COMPONENTS = ("fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge",
              "congestion_surcharge", "airport_fee")
PROFILE = q.Profile(
    roles=TRIP_ROLES, columns=COLUMNS, nullable=("on_scene_datetime", "store_and_fwd_flag"), ranges=RANGES,
    total="total_amount", components=COMPONENTS, distance="trip_distance", passengers="passenger_count",
    request="request_datetime", described=("payment_type_id", "ratecode_id", "store_and_fwd_flag"), max_minutes=120,
)
# What a data dictionary file holds: field, type, described value.
DICTIONARY = (
    ("payment_type_id", "int", "1 = Tarjeta de credito"), ("payment_type_id", "int", "2= Efectivo"),
    ("payment_type_id", "int", "3 = Sin cargo"), ("ratecode_id", "int", "1 = Standard rate"),
    ("ratecode_id", "int", "2 = JFK"), ("ratecode_id", "int", "3 = Newark"), ("ratecode_id", "int", "5 = Negotiated"),
    ("store_and_fwd_flag", "string", "N not a store and forward trip"), ("trip_distance", "double", None),
)
ALLOWED = "(values ('payment_type_id','1'),('payment_type_id','2'),('payment_type_id','3'),('ratecode_id','1'),('ratecode_id','2'),('ratecode_id','3'),('ratecode_id','5'),('store_and_fwd_flag','N')) a(\"column\", value)"


def dictionary(t):
    return t.spark.createDataFrame(list(DICTIONARY), "nombre_campo string, tipo_dato string, valor string")


_S = "service_id, file_year, file_month"
_GAP = "abs(total_amount - (" + " + ".join(f"coalesce({c}, 0)" for c in COMPONENTS) + "))"


def _long(rows, source="trips"):
    """One UNION ALL branch per metric over a grouped scan."""
    names = ", ".join(f"{v} as v{i}, {ok} as p{i}" for i, (_, _, v, ok) in enumerate(rows))
    return f"with g as (select {_S}, {names} from {source} group by 1,2,3) " + " union all ".join(
        f"select {_S}, '{d}' as dimension, '{m}' as metric, cast(v{i} as double) as value, p{i} as passed from g"
        for i, (d, m, _, _) in enumerate(rows)
    )


def _n(cond):
    return f"count(case when {cond} then 1 end)"


_OFF = "year(pickup_datetime) <> file_year or month(pickup_datetime) <> file_month"
_MIN = "(epoch(dropoff_datetime) - epoch(pickup_datetime))/60e0"
_BAD_PU = "pickup_location_id not in (select location_id from zones)"
_BAD_DO = "dropoff_location_id not in (select location_id from zones)"
_CELLS = f"count(*)*{len(COLUMNS)}"
_UNALLOWED = "(" + " + ".join(f"count(*) - count({c})" for c in TRIP_REQUIRED) + ")"
_COMPLETE = half(f"1e0 - cast({_UNALLOWED} as double)/({_CELLS})", 4)
_CONSISTENCY = [
    ("pickup_before_dropoff_pct", half(f"100e0 - {half('cast(' + _n('dropoff_datetime < pickup_datetime') + ' as double)/count(*)*100e0', 4)}"), _n("dropoff_datetime < pickup_datetime")),
    ("request_before_pickup_pct", pass_pct(_n("pickup_datetime < request_datetime"), "count(*)"), _n("pickup_datetime < request_datetime")),
    ("trip_duration_lt_24h_pct", pass_pct(_n(f"{_MIN} > 120"), "count(*)"), _n(f"{_MIN} > 120")),
    ("trip_distance_non_negative_pct", pass_pct(_n("trip_distance < 0"), "count(*)"), _n("trip_distance < 0")),
    ("passenger_count_non_negative_pct", pass_pct(_n("passenger_count < 0"), "count(*)"), _n("passenger_count < 0")),
]
_AMOUNT_BAD = _n(f"{_GAP} > 0.02")
METRIC_SQL = {
    "accuracy": [
        ("total_amount_match_pct", pass_pct(_AMOUNT_BAD, "count(total_amount)"), f"{_AMOUNT_BAD} = 0"),
        ("total_amount_mismatch_count", _AMOUNT_BAD, f"{_AMOUNT_BAD} = 0"),
        ("total_amount_max_diff", half(f"coalesce(max({_GAP}), 0)", 4), f"{_AMOUNT_BAD} = 0"),
    ],
    "completeness": [("completeness_score", half(f"{_COMPLETE}*100e0"), f"{_UNALLOWED} = 0")] + [
        (f"null_pct_{c}", pct(f"(count(*) - count({c}))", "count(*)", 4),
         "true" if c in PROFILE.nullable else f"count(*) - count({c}) = 0") for c in COLUMNS],
    "consistency": [(m, v, f"{b} = 0") for m, v, b in _CONSISTENCY],
    "integrity": [
        ("pickup_location_id_valid_pct", pass_pct(_n(_BAD_PU), "count(pickup_location_id)"), f"{_n(_BAD_PU)} = 0"),
        ("dropoff_location_id_valid_pct", pass_pct(_n(_BAD_DO), "count(dropoff_location_id)"), f"{_n(_BAD_DO)} = 0"),
    ],
    "reasonableness": [
        row for c, (lo, hi) in RANGES.items() for row in (
            (f"{c}_in_range_pct", pass_pct(_n(f"{c} < {lo} or {c} > {hi}"), f"count({c})"), f"{_n(f'{c} < {lo} or {c} > {hi}')} = 0"),
            (f"{c}_low", _n(f"{c} < {lo}"), f"{_n(f'{c} < {lo} or {c} > {hi}')} = 0"),
            (f"{c}_high", _n(f"{c} > {hi}"), f"{_n(f'{c} < {lo} or {c} > {hi}')} = 0"),
            (f"{c}_min", f"min({c})", f"{_n(f'{c} < {lo} or {c} > {hi}')} = 0"),
            (f"{c}_max", f"max({c})", f"{_n(f'{c} < {lo} or {c} > {hi}')} = 0"),
        )],
    "timeliness": [("pickup_in_period_pct", pass_pct(_n(_OFF), "count(pickup_datetime)"), f"{_n(_OFF)} = 0")],
}
# zone membership as a column: aggregates over subqueries stay simple
_FLAGGED = f"(select *, {_BAD_PU} as bad_pu, {_BAD_DO} as bad_do from trips)"


def _plain(text):
    return text.replace(_BAD_PU, "bad_pu").replace(_BAD_DO, "bad_do")


for _dim, _rows in METRIC_SQL.items():
    query(f"dq_{_dim}", compose(_long([(_dim, m, _plain(v), _plain(ok)) for m, v, ok in _rows], _FLAGGED)))(
        lambda t, d=_dim: q.metrics(q.measure(t.trips, t.zones, PROFILE), PROFILE, d))

_NULLS = " union all ".join(
    f"select {_S}, '{c}' as \"column\", count(*) - count({c}) as null_count, {str(c in PROFILE.nullable).lower()} as nullable, {pct(f'(count(*) - count({c}))', 'count(*)', 4)} as null_pct "
    "from trips group by 1, 2, 3" for c in COLUMNS)
query("dq_emptiest_columns", compose(f"""
select * exclude (rn) from (select *, row_number() over (partition by {_S} order by null_pct desc, "column") as rn from ({_NULLS}) where null_count > 0) where rn <= 15
"""))(lambda t: q.emptiest_columns(t.trips, PROFILE))
_IDS = (f"select {_S}, 0 as e, 'pickup_location_id' as \"column\", pickup_location_id as value from {_FLAGGED} where bad_pu union all "
        f"select {_S}, 1, 'dropoff_location_id', dropoff_location_id from {_FLAGGED} where bad_do")
query("dq_unknown_zones", compose(f"""
select * exclude (rn, e, least_e) from (
  select *, row_number() over (partition by {_S} order by ocurrencias desc, value) as rn from (
    select *, min(e) over (partition by {_S}) as least_e from (select {_S}, e, "column", value, count(*) as ocurrencias from ({_IDS}) group by all)) where e = least_e) where rn <= 5
"""))(lambda t: q.unknown_zones(t.trips, t.zones, PROFILE))

_KEYED = f"(select {_S}, order_key, line_no, count(*) as n from trips group by all)"
query("dq_uniqueness", compose(f"""
select {_S}, cast(sum(n) as bigint) as total_rows, cast(sum(case when n > 1 then n else 0 end) as bigint) as duplicated_rows,
  {pass_pct('sum(case when n > 1 then n else 0 end)', 'sum(n)')} as unique_rows_pct from {_KEYED} group by 1,2,3
"""))(lambda t: q.repeated_rows(t.trips, PROFILE, t.most_trips).select(
    *TRIP_ROLES.scope, F.col("key_rows").alias("total_rows"), F.col("repeated").alias("duplicated_rows"),
    q.pass_percent(F.col("repeated"), F.col("key_rows")).alias("unique_rows_pct")))

_COUNTS = "select {s}, c as \"column\", v as value, count(*) as n from ({u}) where v is not null group by all"
_UNPIVOT = " union all ".join(f"select {_S}, '{c}' as c, cast({c} as varchar) as v from trips" for c in PROFILE.described)
_JUDGED = (f"(select {_S}, x.\"column\", x.value, n, a.value is not null as valid from ({_COUNTS.format(s=_S, u=_UNPIVOT)}) x "
           f"left join {ALLOWED} on a.\"column\" = x.\"column\" and a.value = x.value)")
_VALID = (f"select {_S}, \"column\", cast(sum(n) as bigint) as filled, cast(sum(case when not valid then n else 0 end) as bigint) as invalid, "
          f"{pct('(sum(n) - sum(case when not valid then n else 0 end))', 'sum(n)')} as valid_pct from {_JUDGED} group by 1,2,3,4")
query("dq_validity", compose(_VALID))(lambda t: q.validity(t.trips, PROFILE, dictionary(t)))
query("topk_values", compose(f"""
select "column", value, cast(n as bigint) as ocurrencias from (
  select "column", value, sum(n) as n, row_number() over (partition by "column" order by sum(n) desc, value) as rn
  from {_JUDGED} where not valid group by 1,2) where rn <= 5
"""))(lambda t: q.invalid_values(t.trips, PROFILE, dictionary(t)))
query("topk_off_periods", compose(f"""
select strftime(pickup_datetime, '%Y-%m') as period, count(*) as count from trips where {_OFF} group by 1 order by 2 desc, 1 limit 5
"""))(lambda t: q.off_periods(t.trips, PROFILE))
query("topk_worst", compose(f"""
select order_key, line_no, part_key, total_amount, {half(_GAP, 4)} as _diff from trips where {_GAP} > 0.02
order by 5 desc, 1, 2, 3 limit 10
"""))(lambda t: q.worst_amounts(t.trips, PROFILE, ["order_key", "line_no", "part_key"]))
query("dq_time_span", compose(f"""
select {_S}, {time('min(pickup_datetime)')} as first_pickup, {time('max(pickup_datetime)')} as last_pickup from trips group by 1,2,3
"""))(lambda t: q.measure(t.trips, t.zones, PROFILE).select(*TRIP_ROLES.scope, "first_pickup", "last_pickup"))


def _mean_sql(parts):
    return half(f"({' + '.join(parts)})/{float(len(parts))}e0".replace(".0e0", "e0"), 4)


def _m(dim, metric):
    return next(_plain(v) for m, v, _ in METRIC_SQL[dim] if m == metric)


def _ok(dim):
    return " and ".join(_plain(ok) for _, _, ok in METRIC_SQL[dim] if ok != "true")


_SCORE_ROWS = {
    "accuracy": half(f"{_m('accuracy', 'total_amount_match_pct')}/100e0", 4),
    "completeness": _COMPLETE,
    "consistency": _mean_sql(["1e0"] + [f"{v}/100e0" for _, v, _ in _CONSISTENCY]),
    "integrity": _mean_sql([f"{_plain(v)}/100e0" for _, v, _ in METRIC_SQL["integrity"]]),
    "reasonableness": _mean_sql([f"{v}/100e0" for m, v, _ in METRIC_SQL["reasonableness"] if m.endswith("_pct")]),
    "timeliness": half(f"{_m('timeliness', 'pickup_in_period_pct')}/100e0", 4),
}
_SCORES = (
    f"with g as (select {_S}, " + ", ".join(f"{v} as s_{d}, {_ok(d)} as p_{d}" for d, v in _SCORE_ROWS.items())
    + f" from {_FLAGGED} group by 1,2,3), scored as ("
    + " union all ".join(f"select {_S}, '{d}' as dimension, s_{d} as score, p_{d} as passed from g" for d in _SCORE_ROWS)
    + f" union all select {_S}, 'uniqueness', {half(pass_pct('sum(case when n > 1 then n else 0 end)', 'sum(n)') + '/100e0', 4)}, "
      f"sum(case when n > 1 then n else 0 end) = 0 from {_KEYED} group by 1,2,3"
    + f" union all select {_S}, 'validity', {half(xavg('valid_pct') + '/100e0', 4)}, false from ({_VALID}) group by 1,2,3) "
)
query("dq_scores", compose(_SCORES + "select * from scored"))(lambda t: q.scores(t.trips, t.zones, PROFILE, dictionary(t), t.most_trips))
query("dq_report", compose(_SCORES + f"""
select s.*, overall_score, all_passed from scored s join (select {_S}, {half(xavg('score'), 4)} as overall_score,
  bool_and(passed) as all_passed from scored group by 1,2,3) using ({_S})
"""))(lambda t: q.report(q.scores(t.trips, t.zones, PROFILE, dictionary(t), t.most_trips), TRIP_ROLES.scope))
query("dq_summary", compose(_SCORES + f"""
select service_id, dimension, count(*) as archivos, {half(xavg('score'), 4)} as score_promedio,
  count(case when not passed then 1 end) as meses_reprobados, min(case when not passed then score end) as peor_score
from scored group by 1,2
"""))(lambda t: q.summary(q.scores(t.trips, t.zones, PROFILE, dictionary(t), t.most_trips)))
query("src_dictionary", compose(
    "select nombre_campo, value, count(*) as filas from (values "
    + ", ".join(f"('{f}', '{v}')" for f, v in (("payment_type_id", "1"), ("payment_type_id", "2"), ("payment_type_id", "3")))
    + ") d(nombre_campo, value) join trips on cast(payment_type_id as varchar) = value group by 1,2"
))(lambda t: q.allowed_values(dictionary(t)).filter("column = 'payment_type_id'").join(
    t.trips.select(F.col("payment_type_id").cast("string").alias("value")), "value")
    .groupBy(F.col("column").alias("nombre_campo"), "value").agg(F.count(F.lit(1)).alias("filas")))
