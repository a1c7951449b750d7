"""SQL of the ride events: sent, judged, accepted, first deliveries."""

from hackstand.catalog.sql import TAXI, block_sql, define, generosity_sql, half, part_sql, passengers_sql
from hackstand.catalog.tables import AS_OF

_K = "cast(regexp_extract(props, '\"k\": *(\\d+)', 1) as integer)"
define("rides_sent", f"""
select *, {half('value + tip_amount + tolls_amount')} as total_amount from (
select event_id, k, case event_type when 'click' then 'yellow' when 'view' then 'green' when 'signup' then 'fhv' else 'fhvhv' end as service_id,
  moment as pickup_datetime, moment - to_minutes(cast(k % 9 + 1 as bigint)) as request_datetime,
  case when k % 11 <> 0 then moment + to_minutes(cast(k % 60 - 2 as bigint)) end as dropoff_datetime,
  case when k % 17 <> 0 then cast(user_id % 25 + 2 as integer) end as pu_location_id,
  case when k % 13 <> 0 then cast(event_id % 25 + 2 as integer) end as do_location_id,
  case when k % 19 <> 0 then cast(user_id % 3 as integer) end as vendor_id, k % 6 + 1 as ratecode_id, k % 4 + 1 as payment_type_id,
  k % 7 as passenger_count, case when k % 23 <> 0 then {half('value/7e0')} end as trip_distance, value, value as fare_amount,
  {half('value*(k % 30)/100e0')} as tip_amount, {half('value*(k % 5)/50e0')} as tolls_amount,
  'HV000' || cast(user_id % 4 + 2 as varchar) as hvfhs_license_num, 'B' || cast(user_id as varchar) as dispatching_base_num, {half('value*0.75e0')} as driver_pay,
  case when k % 5 = 0 then 'Y' else 'N' end as shared_request_flag, case when k % 10 = 0 then 'Y' else 'N' end as shared_match_flag,
  unnest(generate_series(1, case when k % 5 = 0 then 2 else 1 end)) as delivery
from (select *, {_K} as k, date_trunc('second', ts) as moment from events))
""")
define("rides_judged", f"""
select *, coalesce(
  case when {TAXI} and vendor_id is null then 'incomplete_vendor_id' when pu_location_id is null then 'incomplete_pu_location_id' end,
  case when pickup_datetime < timestamp '{AS_OF}' - interval 30 day or pickup_datetime >= timestamp '{AS_OF}' + interval 1 day then 'timeliness_window' end,
  case when dropoff_datetime < pickup_datetime then 'datetime_inverted' end,
  case when pu_location_id is not null and pu_location_id not in (select location_id from zones) then 'integrity_invalid_pu_location_id' end,
  case when do_location_id is not null and do_location_id not in (select location_id from zones) then 'integrity_invalid_do_location_id' end) as reject_reason
from rides_sent
""")
_FARE_TIP = f"case when {TAXI} then payment_type_id = 1 and fare_amount > 0 else fare_amount > 0 end"
_PCT = half(f"case when {_FARE_TIP} then tip_amount/fare_amount*100e0 end")
define("rides_all", f"""
select r.*, cast(pickup_datetime as date) as fecha_viaje, hour(pickup_datetime) as pickup_hour, {block_sql('hour(pickup_datetime)')} as bloque_horario,
  p.borough as pu_borough, p.zone as pu_zone, d.borough as do_borough, d.zone as do_zone,
  {part_sql('hour(pickup_datetime)')} as franja_horaria,
  case when isodow(pickup_datetime) >= 6 then 'Fin de Semana' else 'Día Laborable' end as dia_categoria, isodow(pickup_datetime) >= 6 as is_weekend,
  case when dropoff_datetime > pickup_datetime then (epoch(dropoff_datetime) - epoch(pickup_datetime))/60e0 end as trip_duration_minutes,
  case when {TAXI} then total_amount when service_id = 'fhvhv' then fare_amount end as revenue,
  {passengers_sql('passenger_count')} as passenger_group, {generosity_sql(_PCT)} as categoria_generosidad, {_FARE_TIP} as usable
from rides_judged r left join zones p on p.location_id = pu_location_id left join zones d on d.location_id = do_location_id
where reject_reason is null
""")
# the fields that make a trip, by service; of its deliveries within 48 hours after another only the first counts
_TRIP = (f"case when {TAXI} then concat_ws('|', 't', coalesce(cast(vendor_id as varchar), ''), pickup_datetime, coalesce(cast(dropoff_datetime as varchar), ''), coalesce(cast(pu_location_id as varchar), '')) "
         "when service_id = 'fhvhv' then concat_ws('|', 'h', hvfhs_license_num, request_datetime, pickup_datetime, coalesce(cast(dropoff_datetime as varchar), '')) "
         "else concat_ws('|', 'f', dispatching_base_num, pickup_datetime, coalesce(cast(dropoff_datetime as varchar), '')) end")
define("rides", f"""
select * exclude (viaje, puesto, antes) from (
  select *, lag(pickup_datetime) over (partition by viaje order by pickup_datetime, event_id, delivery) as antes,
    row_number() over (partition by viaje, pickup_datetime order by event_id, delivery) as puesto
  from (select *, {_TRIP} as viaje from rides_all))
where puesto = 1 and (antes is null or pickup_datetime > antes + interval 48 hour or antes = pickup_datetime)
""")
