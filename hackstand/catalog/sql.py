"""SQL building blocks for the checks: named table expressions and a composer."""

from __future__ import annotations

import re

TABLE_EXPRESSIONS: dict[str, str] = {}


def half(expr: str, digits: int = 2) -> str:
    return f"(floor(({expr})*1e{digits}+0.5)/1e{digits})"


def xsum(expr: str, digits: int = 4) -> str:
    return f"(cast(sum(cast(floor(({expr})*1e{digits}+0.5) as bigint)) as double)/1e{digits})"


def wsum(expr: str, over: str) -> str:
    return f"(cast(sum(cast(floor(({expr})*1e4+0.5) as bigint)) over ({over}) as double)/1e4)"


def ratio(top: str, bottom: str) -> str:
    return f"(case when {bottom} > 0 then cast({top} as double)/cast({bottom} as double) end)"


def xavg(expr: str) -> str:
    return ratio(xsum(expr), f"count({expr})")


def pct(part: str, whole: str, digits: int = 2) -> str:
    return half(f"{ratio(part, whole)}*100e0", digits)


def pass_pct(bad: str, whole: str, digits: int = 2) -> str:
    good = half(f"(1e0 - cast({bad} as double)/cast({whole} as double))*100e0", digits)
    return f"(case when {whole} > 0 then {good} else 100e0 end)"


def day(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d')"


def time(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S')"


def block_sql(hour: str) -> str:
    return (
        f"(case when {hour} between 0 and 5 then 'Madrugada' when {hour} between 6 and 9 then 'Punta Mañana' "
        f"when {hour} between 10 and 15 then 'Mediodía' when {hour} between 16 and 19 then 'Punta Tarde' "
        f"when {hour} between 20 and 23 then 'Noche' end)"
    )


def part_sql(hour: str) -> str:
    return (
        f"(case when {hour} between 0 and 5 then 'Madrugada' when {hour} between 6 and 11 then 'Mañana' "
        f"when {hour} between 12 and 18 then 'Tarde' when {hour} between 19 and 23 then 'Noche' end)"
    )


def generosity_sql(p: str) -> str:
    return (
        f"(case when {p} <= 0 then 'Sin Propina' when {p} < 10 then 'Baja' when {p} <= 18 then 'Estándar' "
        f"when {p} > 18 then 'Alta' end)"
    )


def passengers_sql(n: str) -> str:
    return (
        f"(case when {n} = 1 then 'Solo' when {n} = 2 then 'Pareja' when {n} between 3 and 4 then 'Grupo pequeño' "
        f"when {n} >= 5 then 'Grupo grande' else 'Desconocido' end)"
    )


def values_sql(rows) -> str:
    return ", ".join("(" + ", ".join("NULL" if v is None else repr(v) for v in r) + ")" for r in rows)


def define(name: str, body: str) -> None:
    TABLE_EXPRESSIONS[name] = body.strip()


def compose(body: str) -> str:
    """Prefix ``body`` with every table expression it mentions, in order of need."""
    ordered: list[str] = []

    def visit(text: str, inside: frozenset) -> None:
        for name in TABLE_EXPRESSIONS:
            if name in ordered or name in inside:
                continue
            if re.search(rf"\b(?:from|join)\s+{name}\b", text, re.IGNORECASE) or re.search(
                rf",\s*{name}\b(?=\s+(?:as\s+)?\w+\s+where)", text, re.IGNORECASE
            ):
                visit(TABLE_EXPRESSIONS[name], inside | {name})
                ordered.append(name)

    visit(body, frozenset())
    if not ordered:
        return body.strip()
    ctes = ",\n".join(f"{n} AS (\n{TABLE_EXPRESSIONS[n]}\n)" for n in ordered)
    text = body.strip()
    if re.match(r"with\b", text, re.IGNORECASE):
        return f"WITH {ctes},\n{text[4:].strip()}"
    return f"WITH {ctes}\n{text}"


TAXI = "service_id in ('yellow','green')"

define("zones", """
select n_nationkey as location_id, r_name as borough, n_name as zone
from nation join region on n_regionkey = r_regionkey
""")

define("lines", f"""
select *,
  case when l_returnflag = 'A' then 'yellow' when l_returnflag = 'R' then 'green'
       when l_linestatus = 'F' then 'fhv' else 'fhvhv' end as service_id,
  o_orderdate + to_minutes(cast((l_orderkey*37 + l_linenumber*101) % 1440
    + case when l_tax = 0.08 and l_linenumber = 7 then 57600 else 0 end as bigint)) as pickup_datetime,
  {half('l_extendedprice*l_discount')} as tip_amount,
  {half('l_extendedprice*l_tax')} as tolls_amount,
  0.5e0 * (l_linenumber % 3) as extra,
  case when l_linenumber % 2 = 0 then 2.5e0 else 0e0 end as congestion_surcharge,
  case when l_partkey % 7 = 0 then 1.25e0 else 0e0 end as airport_fee,
  case when l_partkey % 50 = 0 then 1e0 else 0e0 end as off_amount
from lineitem join orders on l_orderkey = o_orderkey
join supplier on l_suppkey = s_suppkey join customer on o_custkey = c_custkey
""")

define("trips", f"""
select l_orderkey as order_key, l_linenumber as line_no, l_partkey as part_key, service_id,
  cast(l_suppkey % 3 as integer) as vendor_id,
  cast(year(o_orderdate) as integer) as file_year, cast(month(o_orderdate) as integer) as file_month,
  pickup_datetime,
  pickup_datetime + to_minutes(cast(l_quantity*3 - case when l_discount = 0.1 and l_linenumber = 1 then 400 else 0 end as bigint))
    as dropoff_datetime,
  s_nationkey + 2 as pickup_location_id, c_nationkey + 2 as dropoff_location_id,
  l_linenumber - 1 as passenger_count, cast(l_partkey % 6 + 1 as integer) as ratecode_id,
  l_linenumber % 4 + 1 as payment_type_id,
  case when not (l_tax = 0.07 and l_linenumber = 2) then l_quantity end as trip_distance,
  l_extendedprice as fare_amount, tip_amount, tolls_amount, extra,
  0.5e0 as mta_tax, 1e0 as improvement_surcharge, congestion_surcharge, airport_fee,
  {half('l_extendedprice + tip_amount + tolls_amount + extra + 0.5e0 + 1e0 + congestion_surcharge + airport_fee + off_amount')} as total_amount,
  'HV000' || cast(l_suppkey % 4 + 2 as varchar) as hvfhs_license_num,
  'B' || cast(l_suppkey % 50 as varchar) as dispatching_base_num,
  pickup_datetime - to_minutes(cast(l_partkey % 20 + 1 as bigint)) as request_datetime,
  case when l_partkey % 5 <> 0 then pickup_datetime - to_minutes(cast(l_partkey % 20 + 1 as bigint))
    + to_minutes(cast(l_partkey % 9 as bigint)) end as on_scene_datetime,
  {half('l_extendedprice*0.03e0')} as bcf, {half('l_extendedprice*0.08875e0')} as sales_tax,
  {half('l_extendedprice*0.75e0')} as driver_pay,
  case when l_linenumber % 5 = 0 then 'Y' else 'N' end as shared_request_flag,
  case when l_partkey % 10 = 0 then 'Y' else 'N' end as shared_match_flag,
  case when l_linenumber = 3 then 'Y' when l_linenumber < 7 then 'N' end as store_and_fwd_flag
from lines
""")

INCOMPLETE = "case when trip_distance is null then 'incomplete_trip_distance' end"
TIMELINESS = ("case when year(pickup_datetime) <> file_year or month(pickup_datetime) <> file_month "
              "then 'timeliness_off_period' end")
INVERTED = "case when dropoff_datetime < pickup_datetime then 'datetime_inverted' end"
INTEGRITY = ("coalesce(case when pickup_location_id not in (select location_id from zones) "
             "then 'integrity_invalid_pickup_location_id' end, "
             "case when dropoff_location_id not in (select location_id from zones) "
             "then 'integrity_invalid_dropoff_location_id' end)")
UNIQUENESS = ("case when row_number() over (partition by service_id, file_year, file_month, order_key, line_no "
              "order by fare_amount desc, part_key) > 1 then 'uniqueness_duplicate' end")

define("tagged", f"""
select *, coalesce({INCOMPLETE}, {TIMELINESS}, {INVERTED}, {INTEGRITY}, {UNIQUENESS}) as reject_reason
from trips
""")
define("clean", "select * exclude (reject_reason) from tagged where reject_reason is null")
define("rejects", "select * from tagged where reject_reason is not null")


def taxi(c: str, alias: str | None = None) -> str:
    return f"case when {TAXI} then {c} end as {alias or c}"


def app(c: str, alias: str | None = None) -> str:
    return f"case when service_id = 'fhvhv' then {c} end as {alias or c}"


define("facts", f"""
select (order_key*10 + line_no)*4 + case service_id when 'green' then 0 when 'yellow' then 1 when 'fhv' then 2 else 3 end as trip_id, service_id, file_year as year, file_month as month,
  year(pickup_datetime)*10000 + month(pickup_datetime)*100 + day(pickup_datetime) as date_key,
  pickup_datetime, dropoff_datetime, pickup_location_id, dropoff_location_id,
  {', '.join(taxi(c) for c in ('passenger_count', 'trip_distance', 'fare_amount', 'tip_amount', 'tolls_amount', 'extra', 'mta_tax', 'improvement_surcharge', 'total_amount', 'vendor_id', 'ratecode_id', 'payment_type_id'))},
  {', '.join(app(c) for c in ('hvfhs_license_num', 'request_datetime', 'on_scene_datetime', 'bcf', 'sales_tax', 'driver_pay', 'shared_request_flag', 'shared_match_flag'))},
  {app('trip_distance', 'trip_miles')}, {app('fare_amount', 'base_passenger_fare')},
  {app('tolls_amount', 'tolls')}, {app('tip_amount', 'tips')},
  case when service_id <> 'fhv' then congestion_surcharge end as congestion_surcharge,
  case when service_id in ('yellow','fhvhv') then airport_fee end as airport_fee,
  case when service_id <> 'fhv' then {half('(epoch(dropoff_datetime) - epoch(pickup_datetime))/60e0')} end as trip_duration_minutes
from clean
""")

define("demand", f"""
select service_id, fecha_viaje, pickup_hour, {block_sql('pickup_hour')} as bloque_horario,
  isodow(fecha_viaje) as dia_semana, isodow(fecha_viaje) >= 6 as is_weekend, pu_location_id,
  borough as pu_borough, zone as pu_zone, hvfhs_license_num, viajes, espera_total_min, viajes_con_espera,
  espera_promedio_min, year, month
from (
  select service_id, year, month, fecha_viaje, pickup_hour, pu_location_id, hvfhs_license_num, count(*) as viajes,
    {half('cast(sum(wait) as double)/60e0')} as espera_total_min, count(wait) as viajes_con_espera, {half(ratio('(cast(sum(wait) as double)/60e0)', 'count(wait)'))} as espera_promedio_min
  from (select *, cast(pickup_datetime as date) as fecha_viaje, hour(pickup_datetime) as pickup_hour,
        pickup_location_id as pu_location_id, cast(epoch(on_scene_datetime) - epoch(request_datetime) as bigint) as wait from facts)
  group by all
) left join zones on pu_location_id = location_id
""")

_FIN = ("fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge",
        "congestion_surcharge", "airport_fee", "total_amount", "base_passenger_fare", "tolls", "bcf",
        "sales_tax", "tips", "driver_pay", "trip_distance", "trip_miles")
define("financial", f"""
select service_id, fecha_viaje, bloque_horario, pu_location_id, borough as pu_borough, zone as pu_zone, viajes,
  {', '.join(_FIN)}, cast(null as double) as cbd_congestion_fee, cast(null as double) as ehail_fee,
  {half(f"case when {TAXI} then {ratio('total_amount', 'trip_distance')} else {ratio('base_passenger_fare', 'trip_miles')} end", 4)} as ingreso_bruto_por_milla,
  case when not ({TAXI}) then {half('base_passenger_fare - driver_pay')} end as margen_plataforma,
  case when not ({TAXI}) then {half(ratio('driver_pay', 'base_passenger_fare'), 4)} end as ratio_pago_conductor,
  year, month
from (
  select service_id, year, month, cast(pickup_datetime as date) as fecha_viaje,
    {block_sql('hour(pickup_datetime)')} as bloque_horario, pickup_location_id as pu_location_id, count(*) as viajes,
    {', '.join(f'{half(xsum(c))} as {c}' for c in _FIN)}
  from facts where service_id <> 'fhv' group by 1,2,3,4,5,6
) left join zones on pu_location_id = location_id
""")

define("operational", f"""
select service_id, fecha_viaje, bloque_horario, pu_location_id, borough as pu_borough, zone as pu_zone, viajes,
  duracion_total_min, duracion_promedio_min, distancia_total_millas, distancia_promedio_millas,
  {half(ratio('ok_mi', '(ok_min/60e0)'))} as velocidad_promedio_mph,
  viajes_solicitud_compartida, viajes_match_compartido,
  case when service_id = 'fhvhv' then {half('cast(viajes_match_compartido as double)/viajes', 4)} end as tasa_ocupacion_compartida,
  year, month
from (
  select service_id, year, month, fecha_viaje, bloque_horario, pu_location_id, count(*) as viajes,
    {half(xsum('mins'))} as duracion_total_min, {half(xavg('mins'))} as duracion_promedio_min,
    {half(xsum('mi'))} as distancia_total_millas, {half(xavg('mi'), 4)} as distancia_promedio_millas,
    {xsum('case when mins > 0 and mi > 0 then mi end')} as ok_mi,
    {xsum('case when mins > 0 and mi > 0 then mins end')} as ok_min,
    cast(sum(case when shared_request_flag = 'Y' then 1 when shared_request_flag is not null then 0 end) as bigint) as viajes_solicitud_compartida,
    cast(sum(case when shared_match_flag = 'Y' then 1 when shared_match_flag is not null then 0 end) as bigint) as viajes_match_compartido
  from (select *, cast(pickup_datetime as date) as fecha_viaje, {block_sql('hour(pickup_datetime)')} as bloque_horario,
        pickup_location_id as pu_location_id, trip_duration_minutes as mins,
        case when {TAXI} then trip_distance else trip_miles end as mi from facts where service_id <> 'fhv')
  group by all
) left join zones on pu_location_id = location_id
""")

define("balance", """
select coalesce(i.loc, o.loc) as location_id, borough, zone,
  make_timestamp(cast(coalesce(i.t, o.t)*1000000 as bigint)) as bloque_temporal_t,
  make_timestamp(cast((coalesce(i.t, o.t) + 900)*1000000 as bigint)) as bloque_temporal_t_plus_1,
  coalesce(n_in, 0) as taxis_entrantes_zona_t, coalesce(n_out, 0) as taxis_salientes_zona_t_plus_1,
  coalesce(n_in, 0) - coalesce(n_out, 0) as flujo_neto_oferta,
  coalesce(n_in, 0) - coalesce(n_out, 0) < -10 as deficit_severo_flag,
  year(make_timestamp(cast(coalesce(i.t, o.t)*1000000 as bigint))) as year,
  month(make_timestamp(cast(coalesce(i.t, o.t)*1000000 as bigint))) as month
from (select dropoff_location_id as loc, floor(epoch(dropoff_datetime)/900)*900 as t, count(*) as n_in from facts group by 1,2) i
full outer join
  (select pickup_location_id as loc, floor(epoch(pickup_datetime)/900)*900 - 900 as t, count(*) as n_out from facts group by 1,2) o
  on i.loc = o.loc and i.t = o.t
left join zones z on z.location_id = coalesce(i.loc, o.loc)
""")

define("abc_stats", f"""
select service_id, year, pu_location_id, {xsum('revenue')} as ingresos, avg(trips) as media, stddev_samp(trips) as desviacion
from (select service_id, year, pickup_location_id as pu_location_id, cast(pickup_datetime as date) as day, count(*) as trips,
        {xsum(f'case when {TAXI} then total_amount else base_passenger_fare end')} as revenue
      from facts where service_id <> 'fhv' group by 1,2,3,4)
group by 1,2,3
""")
_RUN = "partition by service_id, year order by ingresos desc, pu_location_id rows between unbounded preceding and current row"
define("abc_xyz", f"""
select pu_location_id, borough, zone, service_id, year, {half('ingresos')} as ingresos_totales_zona,
  {half('media')} as viajes_diarios_promedio, {half('desviacion')} as viajes_diarios_std,
  {half('cv', 4)} as coeficiente_variacion_xyz,
  case when cv < 0.2 then 'X' when cv <= 0.5 then 'Y' when cv is not null then 'Z' end as clase_xyz,
  share as porcentaje_acumulado_ingresos,
  case when share <= 0.8 then 'A' when share <= 0.95 then 'B' when share is not null then 'C' end as clase_abc
from (select *, {ratio('desviacion', 'media')} as cv,
        {half(ratio(wsum('ingresos', _RUN), wsum('ingresos', 'partition by service_id, year')), 4)} as share
      from abc_stats)
left join zones on pu_location_id = location_id
""")

define("tipping", f"""
select service_id, fecha_viaje, pu_borough, do_borough, payment_type_id, is_credit_card, categoria_generosidad, viajes,
  viajes_con_propina, propina_total, porcentaje_propina_promedio,
  {half(f"{ratio('base_tip', 'base_fare')}*100e0")} as porcentaje_propina_ponderado,
  {half(ratio('propina_total', 'mi'), 4)} as propina_por_milla, year, month
from (
  select service_id, year, month, fecha_viaje, pu_borough, do_borough, payment_type_id, payment_type_id = 1 as is_credit_card,
    {generosity_sql(half('p'))} as categoria_generosidad, count(*) as viajes,
    count(case when tip > 0 then 1 end) as viajes_con_propina, {half(xsum('tip'))} as propina_total,
    {half(xavg('p'))} as porcentaje_propina_promedio,
    {xsum('case when usable then fare end')} as base_fare, {xsum('case when usable then tip end')} as base_tip, {xsum('mi')} as mi
  from (select *, case when usable then tip/fare*100e0 end as p from (
    select f.service_id, year, month, cast(pickup_datetime as date) as fecha_viaje, zp.borough as pu_borough, zd.borough as do_borough,
      payment_type_id, case when {TAXI} then tip_amount else tips end as tip,
      case when {TAXI} then fare_amount else base_passenger_fare end as fare,
      case when {TAXI} then trip_distance else trip_miles end as mi,
      case when {TAXI} then payment_type_id = 1 and fare_amount > 0 else base_passenger_fare > 0 end as usable
    from facts f left join zones zp on zp.location_id = pickup_location_id
    left join zones zd on zd.location_id = dropoff_location_id where service_id <> 'fhv'))
  group by 1,2,3,4,5,6,7,8,9
)
""")

define("hourly", """
select coalesce(borough, 'Unknown') as borough, service_id, date_trunc('hour', pickup_datetime) as pickup_hour,
  count(*) as trip_count, year(date_trunc('hour', pickup_datetime)) as year, month(date_trunc('hour', pickup_datetime)) as month
from facts left join zones on pickup_location_id = location_id group by 1,2,3
""")
