"""Queries: schema harmonisation, reject rules, star schema, column functions."""

from pyspark.sql import functions as F

from hackstand import fixed_values as fv
from hackstand.catalog.registry import query
from hackstand.catalog.sql import (
    INCOMPLETE, INTEGRITY, INVERTED, TAXI, TIMELINESS, UNIQUENESS, block_sql, compose, day, generosity_sql, half,
    part_sql, passengers_sql, time, values_sql, xsum,
)
from hackstand.catalog.tables import TRIP_ROLES
from hackstand.functions import clock, rules
from hackstand.functions.numeric import count_where, exact_sum, half_up, percent
from hackstand.operators import cleaning, columns, selection, star, zones
from hackstand.settings import DEFAULTS

# ---- rejection ----

_ROW = "order_key, line_no, part_key"


def _one_rule(rule: str):
    def build(t):
        tagged = cleaning.tag_rejects(t.trips, t.zones, cleaning.only(TRIP_ROLES, rule))
        return tagged.filter(F.col(cleaning.REASON).isNotNull()).select(
            "order_key", "line_no", "part_key", F.col(cleaning.REASON).alias("reject_reason")
        )
    return build


for _rule, _case in (("incomplete", INCOMPLETE), ("timeliness", TIMELINESS), ("datetime", INVERTED),
                     ("integrity", INTEGRITY), ("uniqueness", UNIQUENESS)):
    query(f"reject_{_rule}", compose(
        f"select * from (select {_ROW}, {_case} as reject_reason from trips) where reject_reason is not null"
    ))(_one_rule(_rule))

query("clean_split", compose(f"select {_ROW}, service_id, coalesce(reject_reason, 'clean') as outcome from tagged"))(
    lambda t: t.tagged.select("order_key", "line_no", "part_key", "service_id",
                              F.coalesce(cleaning.REASON, F.lit("clean")).alias("outcome"))
)


@query("conservation_check", compose("""
select service_id, file_year, file_month, count(*) as bronce, count(*) - count(reject_reason) as limpios,
  count(reject_reason) as rechazados, true as cuadra from tagged group by 1,2,3
"""))
def _conservation(t):
    return cleaning.conservation(t.tagged, ["service_id", "file_year", "file_month"])


@query("reject_reasons", compose(f"""
select reject_reason, count(case when service_id='fhv' then 1 end) as fhv, count(case when service_id='fhvhv' then 1 end) as fhvhv,
  count(case when service_id='green' then 1 end) as green, count(case when service_id='yellow' then 1 end) as yellow,
  {half("cast(count(*) as double)/(select count(*) from trips)*100e0", 3)} as pct_del_total
from rejects group by 1
"""))
def _reasons(t):
    services = ("fhv", "fhvhv", "green", "yellow")
    by_reason = t.tagged.groupBy(cleaning.REASON).agg(
        F.count(F.lit(1)).alias("n"), *[count_where(F.col("service_id") == s).alias(s) for s in services]
    )
    whole = t.trips.agg(F.count(F.lit(1))).scalar()
    return by_reason.filter(F.col(cleaning.REASON).isNotNull()).select(
        F.col(cleaning.REASON).alias("reject_reason"), *services,
        half_up(F.col("n").cast("double") / whole * 100.0, 3).alias("pct_del_total"),
    )


# ---- harmonisation ----

query("normalize_types", compose("""
select order_key, line_no, cast(vendor_id as integer) as "VendorID", cast(ratecode_id as integer) as "RatecodeID",
  cast(payment_type_id as integer) as payment_type, cast(passenger_count as integer) as passenger_count
from clean where service_id = 'yellow'
"""))(lambda t: columns.normalize_types(
    t.raw_category("yellow").withColumn("passenger_count", F.col("passenger_count").cast("double"))
).select("order_key", "line_no", "VendorID", "RatecodeID", "payment_type", "passenger_count"))


@query("first_match", compose(f"""
select 'pickup' as role, year, month, count(*) as n, {time('min(pickup_datetime)')} as first_seen from facts where service_id = 'fhv' group by 1,2,3
union all select 'dropoff', year, month, count(*), {time('min(dropoff_datetime)')} from facts where service_id = 'fhv' group by 1,2,3
"""))
def _first_match(t):
    raw = t.raw_category("fhv")
    out = []
    for role, names in (("pickup", fv.PICKUP_NAMES), ("dropoff", fv.DROPOFF_NAMES)):
        column = columns.first_match(raw.columns, names)
        out.append(raw.groupBy(F.lit(role).alias("role"), "year", "month").agg(
            F.count(F.lit(1)).alias("n"), F.min(column).alias("first_seen")))
    return columns.union_drift(out)


query("col_or_null", compose(
    "select trip_id, fare_amount, cast(null as double) as ehail_fee from facts where service_id = 'green'"
))(lambda t: t.facts.filter("service_id = 'green'").select(
    "trip_id", columns.col_or_null(t.facts, "fare_amount").alias("fare_amount"),
    columns.col_or_null(t.facts, "ehail_fee").alias("ehail_fee")))

query("safe_select", compose(
    "select trip_id, fare_amount, fare_amount*2 as doubled from facts where service_id = 'yellow'"
))(lambda t: columns.safe_select(
    t.facts.filter("service_id = 'yellow'"), "trip_id", "fare_amount", "cbd_congestion_fee",
    (F.col("fare_amount") * 2).alias("doubled")))

_DATES = "strftime(pickup_datetime, '%Y-%m-%d %H:%M:%S') as pickup_datetime, strftime(dropoff_datetime, '%Y-%m-%d %H:%M:%S') as dropoff_datetime"
_FACT_HEAD = "order_key, line_no, date_key, " + _DATES
_KEY = "year(pickup_datetime)*10000 + month(pickup_datetime)*100 + day(pickup_datetime) as date_key"
_LEN = f"{half('(epoch(dropoff_datetime) - epoch(pickup_datetime))/60e0')} as trip_duration_minutes"
_TAXI_COLS = ("vendor_id, ratecode_id, payment_type_id, pickup_location_id, dropoff_location_id, passenger_count, "
              "trip_distance, fare_amount, extra, mta_tax, tip_amount, tolls_amount, improvement_surcharge, "
              "total_amount, congestion_surcharge")
_FACT_SQL = {
    "yellow": f"{_TAXI_COLS}, airport_fee, {_LEN}",
    "green": f"{_TAXI_COLS}, {_LEN}",
    "fhvhv": ("pickup_location_id, dropoff_location_id, hvfhs_license_num, "
              "strftime(request_datetime, '%Y-%m-%d %H:%M:%S') as request_datetime, "
              "strftime(on_scene_datetime, '%Y-%m-%d %H:%M:%S') as on_scene_datetime, trip_distance as trip_miles, "
              "fare_amount as base_passenger_fare, tolls_amount as tolls, bcf, sales_tax, congestion_surcharge, "
              f"airport_fee, tip_amount as tips, driver_pay, shared_request_flag, shared_match_flag, {_LEN}"),
    "fhv": "pickup_location_id, dropoff_location_id",
}
for _cat in fv.SERVICES:
    query(f"fact_{_cat}", compose(
        f"select {_KEY}, {_DATES}, {_FACT_SQL[_cat]}, file_year as year, file_month as month from clean where service_id = '{_cat}'"
    ))(lambda t, c=_cat: star.fact_trips(c, t.raw_category(c)).drop("trip_id"))

query("trip_id", compose("""
select service_id, count(*) as trips, count(distinct (vendor_id, pickup_datetime, dropoff_datetime, pickup_location_id)) as trip_ids
from clean group by 1
"""))(lambda t: t.clean.withColumn("trip_id", rules.trip_id(
    *[F.col(c) for c in ("vendor_id", "pickup_datetime", "dropoff_datetime", "pickup_location_id")]
)).groupBy("service_id").agg(F.count(F.lit(1)).alias("trips"), F.countDistinct("trip_id").alias("trip_ids")))

query("date_key", compose("select date_key, service_id, count(*) as viajes from facts group by 1,2"))(
    lambda t: t.facts.groupBy("date_key", "service_id").agg(F.count(F.lit(1)).alias("viajes")))
query("trip_duration", compose("select trip_id, trip_duration_minutes from facts"))(
    lambda t: t.facts.select("trip_id", "trip_duration_minutes"))
query("revenue_norm", compose(
    f"select trip_id, service_id, case when {TAXI} then total_amount when service_id = 'fhvhv' then base_passenger_fare end as revenue from facts"
))(lambda t: t.facts.select("trip_id", "service_id", rules.revenue(
    F.col("service_id"), F.col("total_amount"), F.col("base_passenger_fare")).alias("revenue")))
query("stringify_sample", compose("""
select cast(trip_id as varchar) as trip_id, service_id, cast(pickup_location_id as varchar) as pickup_location_id
from facts order by facts.trip_id limit 10
"""))(lambda t: columns.as_strings(
    selection.page(t.facts.select("trip_id", "service_id", "pickup_location_id"), [("trip_id", "asc")], 10)))

query("union_facts", compose(f"""
select service_id, year as _file_year, month as _file_month, {_DATES}, pickup_location_id as pu_location_id,
  dropoff_location_id as do_location_id,
  case when {TAXI} then total_amount when service_id = 'fhvhv' then base_passenger_fare end as revenue from facts
"""))(lambda t: star.union_facts(t.facts))


@query("union_drift", compose("""
select 'yellow' as service_id, file_year as year, trip_distance, cast(null as double) as trip_miles, fare_amount,
  cast(null as double) as driver_pay from clean where service_id = 'yellow'
union all select 'fhvhv', file_year, null, trip_distance, null, driver_pay from clean where service_id = 'fhvhv'
"""))
def _drift(t):
    picks = {"yellow": ("year", "trip_distance", "fare_amount"), "fhvhv": ("year", "trip_miles", "driver_pay")}
    return star.unify({c: t.raw_category(c).select(*p) for c, p in picks.items()})


query("union_all_by_name", compose("""
select service_id, pickup_location_id, trip_id from facts where service_id in ('yellow', 'fhv')
"""))(lambda t: t.facts.filter("service_id = 'yellow'").select("service_id", "pickup_location_id", "trip_id").unionByName(
    t.facts.filter("service_id = 'fhv'").select("trip_id", "service_id", "pickup_location_id")))


@query("schema_diff", compose("""
select 'unknown' as kind, 'extra' as column_name, count(*) as filas from trips
union all select 'unknown', 'off_meter', count(*) from trips union all select 'missing', 'ehail_fee', count(*) from trips
"""))
def _schema_diff(t):
    have = t.trips.select("fare_amount", "tip_amount", "extra", F.lit(True).alias("off_meter"))
    diff = columns.schema_diff(have, ["fare_amount", "tip_amount", "ehail_fee"])
    names = F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(c).alias("column_name"))
                      for k, cs in diff.items() for c in cs])
    return have.agg(F.count(F.lit(1)).alias("filas")).select(F.inline(names), "filas")


# ---- dimensions, each against the trips it describes ----

_CAL = ("select cast(range as date) as date from range(make_date((select min(year(pickup_datetime)) from facts), 1, 1), "
        "make_date((select max(year(pickup_datetime)) + 1 from facts), 1, 1), interval 1 day)")


@query("dim_date", compose(f"""
select year(date)*10000+month(date)*100+day(date) as date_key, {day('date')} as date, year(date) as year, month(date) as month,
  day(date) as day, quarter(date) as quarter, isodow(date) as weekday, dayname(date) as day_name, monthname(date) as month_name,
  isodow(date) >= 6 as is_weekend, count(trip_id) as viajes
from ({_CAL}) left join facts on cast(pickup_datetime as date) = date group by all
"""))
def _dim_date(t):
    trips = t.facts.groupBy("date_key").agg(F.count(F.lit(1)).alias("viajes"))
    return star.dim_date_of(t.facts, "pickup_datetime").join(trips, "date_key", "left").fillna(0, ["viajes"])


@query("dim_date_gold", compose(f"""
select year(date)*10000+month(date)*100+day(date) as date_key, {day('date')} as date, isodow(date) as weekday,
  case when isodow(date) >= 6 then 'Fin de Semana' else 'Día Laborable' end as dia_categoria, isodow(date) >= 6 as is_weekend,
  false as is_holiday from ({_CAL})
"""))
def _dim_date_gold(t):
    return star.dim_date_gold(star.dim_date_of(t.facts, "pickup_datetime"))


query("dim_zone", compose("select location_id as \"LocationID\", borough as \"Borough\", zone as \"Zone\" from zones"))(
    lambda t: star.dim_zone(t.zones))
query("dim_zone_gold", compose("""
select location_id as "LocationID", z.borough as "Borough", zone as "Zone",
  coalesce(es, z.borough) as borough_name_es
from zones z left join (values ('EUROPE', 'Europa'), ('ASIA', 'Asia')) v(borough, es) on v.borough = z.borough
"""))(lambda t: star.dim_zone_gold(t.zones, (("EUROPE", "Europa"), ("ASIA", "Asia"))))

query("dim_ratecode", compose(f"""
select v.id as ratecode_id, v.name as ratecode_name, count(trip_id) as viajes
from (values {values_sql(fv.RATECODE_NAMES)}) v(id, name) left join facts on ratecode_id = v.id group by 1,2
"""))(lambda t: star.dim_ratecode(t.spark).join(
    t.facts.filter("ratecode_id is not null").groupBy("ratecode_id").agg(F.count(F.lit(1)).alias("viajes")),
    "ratecode_id", "left").fillna(0, ["viajes"]))
query("dim_payment_type", compose(f"""
select v.id as payment_type_id, v.name as payment_type_name, count(trip_id) as viajes
from (values {values_sql(fv.PAYMENT_NAMES)}) v(id, name) left join facts on payment_type_id = v.id group by 1,2
"""))(lambda t: star.dim_payment_type(t.spark).join(
    t.facts.filter("payment_type_id is not null").groupBy("payment_type_id").agg(F.count(F.lit(1)).alias("viajes")),
    "payment_type_id", "left").fillna(0, ["viajes"]))

_FLAT = "case when ratecode_id = 2 then 70e0 end"
_RATE_NAME = f"(select name from (values {values_sql(fv.RATECODE_NAMES)}) v(id, name) where id = ratecode_id)"
query("dim_ratecode_theoretical", compose(f"""
select ratecode_id, year as fiscal_year, {_FLAT} as flat_fare, {_RATE_NAME} as ratecode_name, count(*) as viajes
from facts where {TAXI} group by 1,2,3,4
"""))(lambda t: t.tariffs.join(
    t.facts.filter(F.col("service_id").isin(*fv.TAXI_SERVICES)).groupBy("ratecode_id", F.col("year").alias("fiscal_year"))
    .agg(F.count(F.lit(1)).alias("viajes")), ["ratecode_id", "fiscal_year"]))

# ---- joins ----

query("with_zone", compose("""
select trip_id, p.borough as pu_borough, p.zone as pu_zone, d.borough as do_borough, d.zone as do_zone
from facts left join zones p on p.location_id = pickup_location_id left join zones d on d.location_id = dropoff_location_id
"""))(lambda t: zones.with_zone(
    zones.with_zone(t.facts.select("trip_id", "pickup_location_id", "dropoff_location_id"), t.zones, "pickup_location_id", "pu_"),
    t.zones, "dropoff_location_id", "do_").drop("pickup_location_id", "dropoff_location_id"))
query("join_ratecode_year", compose(f"""
select trip_id, ratecode_id, year, {_FLAT} as flat_fare, {_RATE_NAME} as ratecode_name from facts where {TAXI}
"""))(lambda t: zones.with_flat_fare(
    t.facts.filter(F.col("service_id").isin(*fv.TAXI_SERVICES)).select("trip_id", "ratecode_id", "year"), t.tariffs))
query("join_lookup_names", compose(f"""
select trip_id, (select name from (values {values_sql(fv.PAYMENT_NAMES)}) v(id, name) where id = payment_type_id) as payment_type,
  {_RATE_NAME} as ratecode from facts where {TAXI}
"""))(lambda t: zones.with_lookup(
    zones.with_lookup(
        t.facts.filter(F.col("service_id").isin(*fv.TAXI_SERVICES)).select("trip_id", "payment_type_id", "ratecode_id"),
        star.dim_payment_type(t.spark), "payment_type_id", "payment_type_id", "payment_type_name", "payment_type"),
    star.dim_ratecode(t.spark), "ratecode_id", "ratecode_id", "ratecode_name", "ratecode").select("trip_id", "payment_type", "ratecode"))

# ---- column functions ----

_HOUR = "hour(pickup_datetime)"


def _function(name: str, sql: str, **out):
    query(name, compose(f"select trip_id, {sql} from facts"))(
        lambda t: t.facts.select("trip_id", *[c().alias(k) for k, c in out.items()]))


_HOUR_COL = lambda: F.hour("pickup_datetime")
_DOW_COL = lambda: clock.iso_weekday(F.col("pickup_datetime"))
_function("bloque_horario", f"{block_sql(_HOUR)} as bloque", bloque=lambda: clock.bloque_horario(_HOUR_COL()))
_function("franja_horaria", f"{part_sql(_HOUR)} as franja", franja=lambda: clock.franja_horaria(_HOUR_COL()))
_function("iso_weekday", "isodow(pickup_datetime) as dia", dia=_DOW_COL)
_function("dia_categoria", "case when isodow(pickup_datetime) >= 6 then 'Fin de Semana' else 'Día Laborable' end as dia_categoria, "
          "isodow(pickup_datetime) >= 6 as is_weekend",
          dia_categoria=lambda: clock.dia_categoria(_DOW_COL()), is_weekend=lambda: clock.is_weekend(_DOW_COL()))
_function("passenger_group", f"{passengers_sql('passenger_count')} as grupo",
          grupo=lambda: rules.passenger_group(F.col("passenger_count")))
_TIP = half("case when payment_type_id = 1 and fare_amount > 0 then tip_amount/fare_amount*100e0 end")
_function("categoria_generosidad", f"{generosity_sql(_TIP)} as categoria", categoria=lambda: rules.categoria_generosidad(
    half_up(F.when((F.col("payment_type_id") == 1) & (F.col("fare_amount") > 0),
                   F.col("tip_amount") / F.col("fare_amount") * 100.0), 2), DEFAULTS.generosity))
_function("desviacion_tarifa", "case when ratecode_id = 2 then abs(fare_amount - 70e0) end as desviacion",
          desviacion=lambda: rules.desviacion_tarifa(F.col("fare_amount"), F.when(F.col("ratecode_id") == 2, 70.0)))
_SEC_SQL = "(epoch(dropoff_datetime) - epoch(pickup_datetime))"
SPEED_SQL = f"case when {_SEC_SQL} > 0 and trip_distance > 0 then {half(f'trip_distance/({_SEC_SQL}/3600e0)')} end"
COST_SQL = half("fare_amount/(trip_distance + 0.001e0)", 4)
TOLL_SQL = f"case when fare_amount > 0 then {half('tolls_amount/fare_amount', 4)} end"


def _seconds():
    return F.unix_timestamp("dropoff_datetime") - F.unix_timestamp("pickup_datetime")


_function("speed_mph", f"{SPEED_SQL} as mph, {COST_SQL} as costo, {TOLL_SQL} as peaje",
          mph=lambda: rules.speed_mph(F.col("trip_distance"), _seconds()),
          costo=lambda: rules.cost_per_mile(F.col("fare_amount"), F.col("trip_distance")),
          peaje=lambda: rules.toll_ratio(F.col("tolls_amount"), F.col("fare_amount")))
CANDIDATE_SQL = (
    "(ratecode_id = 2 and abs(fare_amount - 70e0) > 15) or ({s} is not null and {s} > 80) or "
    "(ratecode_id = 1 and {s} is not null and {s} > 0 and {s} <= 80 and {c} > 30) or fare_amount <= 0"
).format(s=f"({SPEED_SQL})", c=COST_SQL)
query("is_anomaly_candidate", compose(f"select trip_id, {CANDIDATE_SQL} as candidato from facts where {TAXI}"))(
    lambda t: t.facts.filter(rules.is_taxi(F.col("service_id"))).select("trip_id", rules.is_anomaly_candidate(
        F.col("ratecode_id"), F.col("fare_amount"), F.when(F.col("ratecode_id") == 2, 70.0),
        rules.speed_mph(F.col("trip_distance"), _seconds()),
        rules.cost_per_mile(F.col("fare_amount"), F.col("trip_distance"))).alias("candidato")))
_function("block_floor", f"cast(floor(epoch(pickup_datetime)/900)*900 as bigint) as segundo, {time('time_bucket(interval 15 minutes, pickup_datetime)')} as bloque",
          segundo=lambda: clock.block_start(F.col("pickup_datetime"), 900),
          bloque=lambda: clock.from_block(clock.block_start(F.col("pickup_datetime"), 900)))
_function("date_parts", f"{day('cast(pickup_datetime as date)')} as dia, hour(pickup_datetime) as hora, year(pickup_datetime) as anio, "
          f"month(pickup_datetime) as mes, {time(chr(39).join(['date_trunc(', 'hour', ', pickup_datetime)']))} as inicio_hora, "
          "strftime(pickup_datetime, '%Y-%m') as periodo",
          dia=lambda: F.to_date("pickup_datetime"), hora=_HOUR_COL, anio=lambda: F.year("pickup_datetime"),
          mes=lambda: F.month("pickup_datetime"), inicio_hora=lambda: F.date_trunc("hour", "pickup_datetime"),
          periodo=lambda: F.date_format("pickup_datetime", "yyyy-MM"))
_function("to_timestamp", f"{time('pickup_datetime')} as leido, cast(null as varchar) as ilegible, cast(epoch(pickup_datetime) as bigint) as segundos",
          leido=lambda: F.try_to_timestamp(F.date_format("pickup_datetime", "yyyy-MM-dd HH:mm:ss")),
          ilegible=lambda: F.try_to_timestamp(F.concat(F.lit("x"), F.col("trip_id").cast("string"))).cast("string"),
          segundos=lambda: F.unix_timestamp("pickup_datetime"))
query("is_holiday", compose(f"""
select h.borough, {time('h.pickup_hour')} as pickup_hour, 0e0 as is_holiday, cast(isodow(h.pickup_hour) >= 6 as double) as is_weekend,
  cast(hour(h.pickup_hour) in (7,8,9,16,17,18,19) as double) as is_rush_hour, 0e0 as is_airport_borough, trip_count, service_id
from hourly h
"""))(lambda t: t.hourly.select("borough", "service_id", "pickup_hour", "trip_count", *[
    c.alias(n) for n, c in clock.calendar_flags(F.col("pickup_hour"), F.col("borough")).items()]))
_function("is_weekend", "isodow(pickup_datetime) >= 6 as is_weekend", is_weekend=lambda: clock.is_weekend(_DOW_COL()))
_function("cost_per_mile", f"{COST_SQL} as costo", costo=lambda: rules.cost_per_mile(F.col("fare_amount"), F.col("trip_distance")))
_function("toll_ratio", f"{TOLL_SQL} as peaje", peaje=lambda: rules.toll_ratio(F.col("tolls_amount"), F.col("fare_amount")))
_function("unix_timestamp", "cast(epoch(dropoff_datetime) as bigint) as segundos", segundos=lambda: F.unix_timestamp("dropoff_datetime"))
_function("is_rush_hour", f"{_HOUR} in (7,8,9,16,17,18,19) as punta", punta=lambda: clock.is_rush_hour(_HOUR_COL()))
query("is_airport_borough", compose("""
select trip_id, coalesce(borough in ('EWR', 'Queens'), false) as aeropuerto from facts left join zones on pickup_location_id = location_id
"""))(lambda t: zones.with_zone(t.facts.select("trip_id", "pickup_location_id"), t.zones, "pickup_location_id", "pu_").select(
    "trip_id", F.coalesce(clock.is_airport_borough(F.col("pu_borough")), F.lit(False)).alias("aeropuerto")))
query("fs_safe", compose("select trip_id, regexp_replace(service_id || '/' || cast(pickup_location_id as varchar) || ':?', '[<>:\"/\\\\|?*]', '_', 'g') as ruta from facts"))(
    lambda t: t.facts.select("trip_id", rules.fs_safe(F.concat(
        "service_id", F.lit("/"), F.col("pickup_location_id").cast("string"), F.lit(":?"))).alias("ruta")))
query("string_ops", compose("""
select trip_id, concat_ws('||', service_id, cast(year as varchar)) as unido, contains(service_id, 'fhv') as es_fhv,
  split_part('bronze/' || service_id || '/x', '/', 2) as parte, regexp_extract(service_id || '-2020', '(\\d{4})$', 1) as anio_texto from facts
"""))(lambda t: t.facts.select(
    "trip_id", F.concat_ws("||", "service_id", F.col("year").cast("string")).alias("unido"),
    F.col("service_id").contains("fhv").alias("es_fhv"),
    F.split_part(F.concat(F.lit("bronze/"), "service_id", F.lit("/x")), F.lit("/"), F.lit(2)).alias("parte"),
    F.regexp_extract(F.concat("service_id", F.lit("-2020")), r"(\d{4})$", 1).alias("anio_texto")))
query("math_ops", compose(f"""
select service_id, {half('stddev_samp(trip_duration_minutes)', 4)} as desviacion, min(fare_amount) as minimo, max(fare_amount) as maximo,
  {xsum('abs(coalesce(tip_amount, tips, 0) - 5)')} as suma_abs, cast(sum(floor(coalesce(fare_amount, 0))) as bigint) as suma_piso
from facts group by 1
"""))(lambda t: t.facts.groupBy("service_id").agg(
    half_up(F.stddev_samp("trip_duration_minutes"), 4).alias("desviacion"),
    F.min("fare_amount").alias("minimo"), F.max("fare_amount").alias("maximo"),
    exact_sum(F.abs(F.coalesce("tip_amount", "tips", F.lit(0.0)) - 5)).alias("suma_abs"),
    F.sum(F.floor(F.coalesce("fare_amount", F.lit(0.0)))).alias("suma_piso")))

# ---- filters, sorts, samples ----

query("filter_dynamic", compose("select trip_id, service_id, payment_type_id from facts where service_id in ('yellow','green') and payment_type_id = 1"))(
    lambda t: selection.filter_dynamic(t.facts, {"service_id": ["yellow", "green"], "payment_type_id": 1, "month": None})
    .select("trip_id", "service_id", "payment_type_id"))
query("filter_time_range", compose(f"""
select borough, service_id, {time('pickup_hour')} as pickup_hour, trip_count from hourly
where pickup_hour >= timestamp '1997-03-01' and pickup_hour <= timestamp '1997-06-30 23:59:59'
"""))(lambda t: selection.filter_time_range(t.hourly.drop("year", "month"), "pickup_hour", "1997-03-01", "1997-06-30"))
query("sample_fraction", compose("""
select trip_id, service_id from facts where service_id <> 'fhvhv'
  or cast(('0x' || substr(md5(cast(trip_id as varchar) || 'seed42'), 1, 8)) as ubigint)/4294967296e0 < 0.05
"""))(lambda t: t.facts.filter((F.col("service_id") != "fhvhv") | (selection.draw(F.col("trip_id"), "seed42") < 0.05))
      .select("trip_id", "service_id"))
query("sample_cap", compose("""
select trip_id, ratecode_id from (
  select trip_id, ratecode_id, row_number() over (partition by ratecode_id order by substr(md5(cast(trip_id as varchar) || 'cap'), 1, 8), trip_id) as rn
  from facts where ratecode_id is not null) where rn <= 200
"""))(lambda t: selection.sample_cap(
    t.facts.filter("ratecode_id is not null").select("trip_id", "ratecode_id"), ["ratecode_id"], F.col("trip_id"), 200, "cap"))
query("distinct_keys", compose("select distinct service_id, ratecode_id, pickup_location_id from facts"))(
    lambda t: t.facts.select("service_id", "ratecode_id", "pickup_location_id").distinct())
