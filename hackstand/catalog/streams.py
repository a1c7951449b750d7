"""Queries: ride events through streams, live accumulators, merged views."""

from datetime import timedelta

from pyspark.sql import functions as F

from hackstand import fixed_values as fv
from hackstand.catalog.models import SERVICE, _F, _seeded
from hackstand.catalog.registry import query
from hackstand.catalog.sections import long_form, section_sql
from hackstand.catalog.sql import (
    TAXI, block_sql, compose, day, define, generosity_sql, half, part_sql, passengers_sql, ratio, time, values_sql, xsum,
)
from hackstand.catalog.tables import AS_OF
from hackstand.plans import forest, kmodes, serving
from hackstand.session import materialise, scratch_path
from hackstand.streaming import expiry, live, rides, scoring, sinks

_T = (f"{time('pickup_datetime')} as pickup_datetime, {time('dropoff_datetime')} as dropoff_datetime")
_PARSED = ["event_id", "service_id", "pickup_datetime", "dropoff_datetime", "pu_location_id", "do_location_id", "vendor_id",
           "fare_amount", "tip_amount", "total_amount", "trip_distance", "hvfhs_license_num"]
_PARSED_SQL = compose(f"select event_id, service_id, {_T}, pu_location_id, do_location_id, vendor_id, fare_amount, tip_amount, total_amount, trip_distance, hvfhs_license_num from rides_sent")
query("src_events", _PARSED_SQL)(lambda t: rides.parse_events(t.lines, keep=("event_id",)).select(*_PARSED))
query("stream_source", _PARSED_SQL)(
    lambda t: sinks.run_append(rides.parse_events(t.stream_lines, keep=("event_id",)).select(*_PARSED), "parsed"))
query("stream_reject", compose("select event_id, reject_reason from rides_judged where reject_reason is not null"))(
    lambda t: sinks.run_append(t.judged(t.stream_lines).filter("reject_reason is not null").select("event_id", "reject_reason"), "rejected"))
query("stream_accept", compose("select event_id, service_id, pu_location_id from rides_judged where reject_reason is null"))(
    lambda t: sinks.run_append(t.judged(t.stream_lines).filter("reject_reason is null").select("event_id", "service_id", "pu_location_id"), "accepted"))
_RICH = ["event_id", "service_id", "pickup_hour", "bloque_horario", "franja_horaria", "dia_categoria", "is_weekend", "pu_borough", "pu_zone",
         "do_borough", "do_zone", "trip_duration_minutes", "revenue", "passenger_group", "categoria_generosidad", "fecha_viaje"]
_RICH_SQL = ", ".join(c for c in _RICH if c != "fecha_viaje") + f", {day('fecha_viaje')} as fecha_viaje"
query("stream_enrich", compose(f"select {_RICH_SQL} from rides_all"))(
    lambda t: sinks.run_append(t.accepted(t.stream_lines).select(*_RICH), "enriched"))
query("stream_dedup", compose(f"select {_RICH_SQL} from rides"))(
    lambda t: sinks.run_append(rides.first_delivery(t.accepted(t.stream_lines)), "deduplicated").select(*_RICH))

# ---- accumulators: SQL of each view ----

define("live_demand", "select service_id, fecha_viaje, pickup_hour, pu_location_id, count(*) as viajes from rides group by 1,2,3,4")
_TX = lambda c: f"{xsum(f'case when {TAXI} then {c} end')} as {c}"
_AP = lambda c, a: f"{xsum(chr(32).join(['case when service_id =', repr('fhvhv'), 'then', c, 'end']))} as {a}"
define("live_financial", f"""
select service_id, fecha_viaje, bloque_horario, pu_location_id, count(*) as viajes, {_TX('fare_amount')},
  {xsum(f'case when {TAXI} then 0.5e0 end')} as extra, {xsum(f'case when {TAXI} then 0.5e0 end')} as mta_tax, {_TX('tip_amount')}, {_TX('tolls_amount')}, {_TX('total_amount')},
  {_AP('fare_amount', 'base_passenger_fare')}, {_AP('tolls_amount', 'tolls')}, {_AP('tip_amount', 'tips')}, {_AP('driver_pay', 'driver_pay')}
from rides group by 1,2,3,4
""")
define("live_operational", f"""
select service_id, fecha_viaje, bloque_horario, pu_location_id, count(*) as viajes, sum(cast(round(trip_duration_minutes*60) as bigint))/60e0 as duracion_total_min,
  {xsum('trip_distance')} as distancia_total_millas, {xsum('case when trip_duration_minutes > 0 and trip_distance > 0 then trip_distance end')} as millas_validas_sum,
  {half("sum(case when trip_duration_minutes > 0 and trip_distance > 0 then cast(round(trip_duration_minutes*60) as bigint) end)/3600e0", 4)} as horas_validas_sum,
  count(case when shared_request_flag = 'Y' then 1 end) as solicitud_compartida, count(case when shared_match_flag = 'Y' then 1 end) as match_compartido
from rides group by 1,2,3,4
""")
define("live_balance", """
select loc as location_id, make_timestamp(cast(t*1000000 as bigint)) as bloque_temporal_t, cast(sum(came) as bigint) as entrantes, cast(sum(went) as bigint) as salientes,
  cast(sum(came) - sum(went) as bigint) as flujo_neto_oferta, sum(came) - sum(went) < -10 as deficit_severo_flag
from (select do_location_id as loc, floor(epoch(dropoff_datetime)/900)*900 as t, 1 as came, 0 as went from rides
      union all select pu_location_id, floor(epoch(pickup_datetime)/900)*900 - 900, 0, 1 from rides) where loc is not null and t is not null group by 1,2
""")
define("live_tipping", f"""
select service_id, fecha_viaje, pu_borough, do_borough, case when service_id <> 'fhvhv' then payment_type_id end as payment_type_id, categoria_generosidad,
  count(*) as viajes, {xsum('tip_amount')} as propina_total, {xsum('case when usable then fare_amount end')} as tarifa_base_sum,
  {xsum('case when usable then tip_amount end')} as propina_base_sum, {xsum('trip_distance')} as millas_sum
from rides where service_id <> 'fhv' group by 1,2,3,4,5,6
""")
_DAY = f"replace ({day('fecha_viaje')} as fecha_viaje)"
_BLK = f"replace ({time('bloque_temporal_t')} as bloque_temporal_t)"
for _view, _name, _r in (("demand", "stream_demand", _DAY), ("financial", "stream_financial", _DAY),
                         ("operational", "stream_operational", _DAY), ("balance", "stream_supply_demand", _BLK),
                         ("tipping", "stream_tipping", _DAY)):
    query(_name, compose(f"select * {_r} from live_{_view}"))(
        lambda t, v=_view: sinks.run_upsert(live.VIEWS[v](t.ride_stream()), live.KEYS[v], v))

_TTL_KEYS = ["service_id", "pu_location_id", "payment_type_id"]


@query("stream_state_ttl", compose(f"""
select service_id, pu_location_id, payment_type_id, count(*) as viajes, {time('min(pickup_datetime)')} as desde, {time('max(pickup_datetime)')} as hasta,
  max(pickup_datetime) + interval 48 hour < (select max(pickup_datetime) from rides) as expirado
from (select *, sum(nueva) over (partition by service_id, pu_location_id, payment_type_id order by pickup_datetime) as racha
      from (select *, case when pickup_datetime - lag(pickup_datetime) over (partition by service_id, pu_location_id, payment_type_id order by pickup_datetime)
                              > interval 48 hour then 1 else 0 end as nueva from rides)) group by 1, 2, 3, racha
"""))
def _state_ttl(t):
    """Rides arrive in slices of five days; each slice is a run of one stream that goes on from its checkpoint."""
    arrivals = materialise(t.rides.select(*_TTL_KEYS, "pickup_datetime"), "arrivals")
    feed, out = scratch_path(t.spark, "feed"), scratch_path(t.spark, "living")
    first, last = arrivals.agg(F.min("pickup_datetime"), F.max("pickup_datetime")).first()
    while first <= last:
        upto = first + timedelta(days=5)
        arrivals.filter((F.col("pickup_datetime") >= F.lit(first)) & (F.col("pickup_datetime") < F.lit(upto))).write.mode("append").parquet(feed)
        stream = expiry.accumulate(t.spark.readStream.schema(arrivals.schema).parquet(feed), _TTL_KEYS, "pickup_datetime", {"viajes": F.lit(1)})
        sinks.upsert_table(stream, out, f"{out}-checkpoint", keys=[*_TTL_KEYS, expiry.FROM], compact_every=4).awaitTermination()
        first = upto
    return sinks.latest(t.spark, out, [*_TTL_KEYS, expiry.FROM])


query("stream_to_row", compose(f"""
select * {_DAY}, {half(ratio('propina_base_sum', 'tarifa_base_sum') + '*100e0')} as porcentaje_propina_ponderado,
  {half(ratio('propina_total', 'millas_sum'), 4)} as propina_por_milla from live_tipping
"""))(lambda t: live.mart_rows("tipping", live.tipping(t.rides)))


def _live_rows(t, view, zones=None, miles=None):
    """Mart rows of a view that a stream has filled."""
    fill = lambda v: sinks.run_upsert(live.VIEWS[v](t.ride_stream()), live.KEYS[v], v)
    return live.mart_rows(view, fill(view), zones, fill(miles) if miles else None)


query("stream_to_row_demand", compose(f"""
select * {_DAY}, borough as pu_borough, zone as pu_zone, {block_sql('pickup_hour')} as bloque_horario, isodow(fecha_viaje) as dia_semana, isodow(fecha_viaje) >= 6 as is_weekend
from (select d.*, borough, zone from live_demand d left join zones on pu_location_id = location_id)
""".replace(f"* {_DAY}", f"* exclude (borough, zone) {_DAY}")))(lambda t: _live_rows(t, "demand", t.zones))
query("stream_to_row_financial", compose(f"""
select f.* {_DAY}, {half('base_passenger_fare - driver_pay')} as margen_plataforma, {half(ratio('driver_pay', 'base_passenger_fare'), 4)} as ratio_pago_conductor,
  {half(ratio("case when f.service_id = 'fhvhv' then base_passenger_fare else total_amount end", 'distancia_total_millas'), 4)} as ingreso_bruto_por_milla
from live_financial f left join live_operational o on f.service_id is not distinct from o.service_id and f.fecha_viaje is not distinct from o.fecha_viaje
  and f.bloque_horario is not distinct from o.bloque_horario and f.pu_location_id is not distinct from o.pu_location_id
""".replace(day('fecha_viaje'), day('f.fecha_viaje'))))(lambda t: _live_rows(t, "financial", miles="operational"))
query("stream_to_row_operational", compose(f"""
select * {_DAY}, {half(ratio('duracion_total_min', 'viajes'))} as duracion_promedio_min, {half(ratio('millas_validas_sum', 'horas_validas_sum'))} as velocidad_promedio_mph,
  {half(ratio('distancia_total_millas', 'viajes'), 4)} as distancia_promedio_millas,
  case when service_id = 'fhvhv' then {half(ratio('match_compartido', 'viajes'), 4)} end as tasa_ocupacion_compartida from live_operational
"""))(lambda t: _live_rows(t, "operational"))
query("stream_to_row_balance", compose(f"""
select l.* {_BLK}, borough, zone, {time('l.bloque_temporal_t + interval 15 minute')} as bloque_temporal_t_plus_1
from live_balance l left join zones z on z.location_id = l.location_id
""".replace(time('bloque_temporal_t'), time('l.bloque_temporal_t'))))(lambda t: _live_rows(t, "balance", t.zones))


@query("stream_snapshot_increments", compose(f"select * {_DAY} from live_demand where service_id = 'green'"))
def _increments(t):
    path = scratch_path(t.spark, "increments")
    sinks.upsert_table(live.demand(t.ride_stream()), path, f"{path}-checkpoint", keys=live.KEYS["demand"]).awaitTermination()
    return sinks.increments(t.spark, path, live.KEYS["demand"], -1, {"service_id": "green"}).drop(sinks.BATCH)


# ---- batch and live together: the batch layer knows the rides before the 20th ----

_CUT = "2024-01-20"
define("batch_demand", f"select service_id, fecha_viaje, pickup_hour, pu_location_id, count(*) as viajes from rides_all where fecha_viaje < date '{_CUT}' group by 1,2,3,4")
_ANTI = ("not exists (select 1 from batch_demand b where b.service_id is not distinct from l.service_id and b.fecha_viaje is not distinct from l.fecha_viaje "
         "and b.pickup_hour is not distinct from l.pickup_hour and b.pu_location_id is not distinct from l.pu_location_id)")
define("merged_demand", f"select *, 'batch' as origen from batch_demand union all select *, 'realtime' from live_demand l where {_ANTI}")


def _batch_demand(t):
    everything = t.accepted(t.lines).filter(F.col("fecha_viaje") < F.lit(_CUT).cast("date"))
    return live.demand_for_merge(live.demand(everything))


query("merge_batch_realtime", compose(f"select * {_DAY} from merged_demand"))(
    lambda t: live.merge(_batch_demand(t), live.demand(t.rides), live.KEYS["demand"]))
query("keyed_union", compose(f"select * {_DAY} from merged_demand"))(
    # text dates on the live side still meet the batch's dates
    lambda t: live.merge(_batch_demand(t), live.demand(t.rides).withColumn("fecha_viaje", F.col("fecha_viaje").cast("string")),
                         live.KEYS["demand"]))
query("merged_view", compose(f"""
select * {_DAY} from (select * from merged_demand where service_id in ('yellow','fhvhv')
  order by fecha_viaje desc, service_id, pickup_hour, pu_location_id limit 300)
"""))(lambda t: live.merged_view(_batch_demand(t), live.demand(t.rides), live.KEYS["demand"], "fecha_viaje",
                                 {"service_id": ["yellow", "fhvhv"]}, 300))
query("realtime_abc_xyz", compose(f"""
select pu_location_id, service_id, viajes_realtime, coalesce(ingresos_realtime, 0) as ingresos_realtime
from (select pu_location_id, service_id, cast(sum(viajes) as bigint) as viajes_realtime from live_demand group by 1,2)
left join (select pu_location_id, service_id, {half(xsum('coalesce(total_amount, 0) + coalesce(base_passenger_fare, 0)'))} as ingresos_realtime
           from live_financial group by 1,2) using (pu_location_id, service_id)
"""))(lambda t: live.abc_xyz(live.demand(t.rides), live.financial(t.rides)))
query("realtime_rollup", compose(" union all ".join([
    section_sql("total", [], {"value": "sum(viajes)"}, "live_demand"),
    section_sql("top", ["coalesce(cast(pu_location_id as varchar), '?')"], {"value": "sum(viajes)"}, "live_demand",
                " order by sum(viajes) desc, 1 limit 15")])))(
    lambda t: long_form({k: (v, ["name"] if k == "top" else [], ["value"])
                         for k, v in serving.realtime_rollup(live.demand(t.rides), "pu_location_id", "viajes").items()}))

# ---- scoring ----

_SEC = "case when dropoff_datetime > pickup_datetime then epoch(dropoff_datetime) - epoch(pickup_datetime) end"
define("ride_inputs", f"""
select *, {half('fare_amount/(trip_distance + 0.001e0)', 4)} as costo_por_distancia,
  case when seg > 0 and trip_distance > 0 then {half('trip_distance/(seg/3600e0)')} end as mph,
  case when fare_amount > 0 then {half('tolls_amount/fare_amount', 4)} end as ratio_peaje_tarifa
from (select *, {_SEC} as seg from rides) where trip_distance is not null and fare_amount is not null
""")
query("stream_fraud_candidates", compose("""
select event_id, cast(seg as bigint) as duracion_viaje_segundos, mph as velocidad_promedio_calculada, costo_por_distancia, ratio_peaje_tarifa,
  coalesce((ratecode_id = 2 and abs(fare_amount - 70e0) > 15) or (mph is not null and mph > 80) or
    (ratecode_id = 1 and mph is not null and mph > 0 and mph <= 80 and costo_por_distancia > 30) or fare_amount <= 0, false) as is_anomaly_candidate
from ride_inputs
"""))(lambda t: sinks.run_append(scoring.fraud_inputs(rides.first_delivery(t.accepted(t.stream_lines))).select(
    "event_id", "duracion_viaje_segundos", "velocidad_promedio_calculada", "costo_por_distancia", "ratio_peaje_tarifa",
    "is_anomaly_candidate"), "candidates"))


def _stored_model(t) -> str:
    """Training is a job of its own; the stream reads the model it has written."""
    path = f"{scratch_path(t.spark, 'fraud_model')}/version=1"
    forest.train(materialise(t.fraud_features, "fraud"))[0].save(path)
    return path


query("stream_fraud")(lambda t: sinks.run_append(
    scoring.score_fraud(rides.first_delivery(t.accepted(t.stream_lines)), forest.Model.load(t.spark, _stored_model(t))), "fraud"))
query("read_fraud", compose(f"""
select event_id as trip_id, service_id, ratecode_id, {time('pickup_datetime')} as timestamp, costo_por_distancia as anomaly_score
from ride_inputs where service_id in ('yellow','green') and ratecode_id = 1 order by pickup_datetime desc, event_id limit 40 offset 10
"""))(lambda t: live.read_scored(
    scoring.fraud_inputs(t.rides).select(F.col("event_id").alias("trip_id"), "service_id", "ratecode_id",
                                         F.col("pickup_datetime").alias("timestamp"), F.col("costo_por_distancia").alias("anomaly_score")),
    "timestamp", 40, 10, service_id=["yellow", "green"], ratecode_id=1))

_RNAMES = {
    "borough_pu": "pu_borough", "borough_do": "do_borough", "franja_horaria": "franja_horaria", "dia_categoria": "dia_categoria",
    "payment_type": f"(select name from (values {values_sql(fv.PAYMENT_NAMES)}) v(id, name) where id = payment_type_id)",
    "ratecode": f"(select name from (values {values_sql(fv.RATECODE_NAMES)}) v(id, name) where id = ratecode_id)",
    "passenger_group": "passenger_group",
}
define("ride_features", "select event_id, service_id, pickup_datetime, " + ", ".join(f"{e} as {n}" for n, e in _RNAMES.items())
       + f" from rides where service_id = '{SERVICE}'")


def _rgap(s):
    return "(" + " + ".join(f"(case when r.{f} = {s}.{f} then 0 else 1 end)" for f in _F) + ")"


define("ride_clusters", f"""
select event_id, service_id, case when g0 <= g1 and g0 <= g2 then 0 when g1 <= g2 then 1 else 2 end as cluster_id from (
  select r.event_id, r.service_id, {_rgap('a')} as g0, {_rgap('b')} as g1, {_rgap('s')} as g2
  from ride_features r join seed0 a on true join seed1 b on true join seed2 s on true where """
       + " and ".join(f"r.{f} is not null" for f in _F) + ")")


def _clusters(t, source):
    modes = {SERVICE: _seeded(t.cluster_features)[1]}
    return scoring.score_clusters(source.withColumn("trip_id", F.col("event_id")), modes)


# the same for every service that has features, each with its own
_SERVICES = ("yellow", "green", "fhvhv")


def _differ(left, right, features):
    return "(" + " + ".join(f"(case when {left}.{f} = {right}.{f} then 0 else 1 end)" for f in features) + ")"


for _s in _SERVICES:
    _fs = list(kmodes.features_of(_s))
    _all, _own = ", ".join(_fs), ", ".join(f"d.{f}" for f in _fs)
    _filled = " and ".join(f"{f} is not null" for f in _fs)
    _g0, _g1 = _differ("d", "a", _fs), _differ("d", "b", _fs)
    define(f"dense_{_s}", f"select *, {' + '.join(f'sum(w) over (partition by {f})' for f in _fs)} as density from "
           f"(select {_all}, count(*) as w from kfeat where service_id = '{_s}' and {_filled} group by all)")
    define(f"first_{_s}", f"select {_all} from dense_{_s} order by density desc, {_all} limit 1")
    define(f"second_{_s}", f"select {_own} from dense_{_s} d join first_{_s} a on true order by {_g0}*density desc, {_own} limit 1")
    define(f"third_{_s}", f"select {_own} from dense_{_s} d join first_{_s} a on true join second_{_s} b on true order by least({_g0}, {_g1})*density desc, {_own} limit 1")
_RIDE_NAMES = {**_RNAMES, "hvfhs_license_num": "hvfhs_license_num"}
define("service_rides", "select event_id, service_id, " + ", ".join(f"{e} as {n}" for n, e in _RIDE_NAMES.items()) + " from rides")


def _nearest_sql(service):
    features = list(kmodes.features_of(service))
    gaps = ", ".join(f"{_differ('r', m, features)} as g{i}" for i, m in enumerate("abc"))
    filled = " and ".join(f"r.{f} is not null" for f in features)
    return (f"select event_id as trip_id, case when g0 <= g1 and g0 <= g2 then 0 when g1 <= g2 then 1 else 2 end as cluster_id, service_id from "
            f"(select r.event_id, r.service_id, {gaps} from service_rides r join first_{service} a on true join second_{service} b on true "
            f"join third_{service} c on true where r.service_id = '{service}' and {filled})")


@query("stream_cluster_services", compose(" union all ".join(_nearest_sql(s) for s in _SERVICES)))
def _cluster_services(t):
    modes = {}
    features = materialise(t.cluster_features, "features")
    for service in _SERVICES:
        combos = materialise(kmodes.combinations(features, service), "combos")
        modes[service] = kmodes.initial_modes(combos, list(kmodes.features_of(service)), 3)
    kept = rides.first_delivery(t.accepted(t.stream_lines)).withColumn("trip_id", F.col("event_id"))
    return sinks.run_append(scoring.score_clusters(kept, modes), "clusters")


query("stream_cluster", compose("select event_id as trip_id, cluster_id, service_id from ride_clusters"))(
    lambda t: sinks.run_append(_clusters(t, rides.first_delivery(t.accepted(t.stream_lines))), "clusters"))
query("read_clusters", compose("select event_id as trip_id, cluster_id, service_id from ride_clusters where cluster_id in (0, 1) order by event_id limit 30 offset 5"))(
    lambda t: live.read_scored(_clusters(t, t.rides), None, 30, 5, cluster_id=[0, 1]))
