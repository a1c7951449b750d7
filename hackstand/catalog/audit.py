"""Queries: audit logs, windows and set operations over them."""

from pyspark.sql import functions as F

from hackstand.catalog.registry import query
from hackstand.catalog.sections import long_form, section_sql
from hackstand.catalog.sql import compose, day, define, half, pct, ratio, time, xavg
from hackstand.functions.numeric import count_where
from hackstand.operators import columns, ranking, selection
from hackstand.plans import audit, marts, serving

_MONTH = "cast(file_year as varchar) || '-' || lpad(cast(file_month as varchar), 2, '0')"


def _runs_sql(source: str, runs: int, extra: str) -> str:
    start = "make_timestamp(file_year, file_month, run + 1, 0, 0, 0) + to_microseconds(cast(n*500000 as bigint))"
    return f"""
select *, service_id || '|' || ym || '|' || cast(run as varchar) as id, strftime(st, '%Y-%m-%dT%H:%M:%S.%g') as start_timestamp,
  strftime(st + to_microseconds(cast(n*137000 as bigint)), '%Y-%m-%dT%H:%M:%S.%g') as end_timestamp
from (select *, {_MONTH} as ym, {start} as st from (
  select service_id, file_year, file_month, line_no % {runs} as run, count(*) as n, {extra} from {source} group by 1,2,3,4))"""


define("audit_b", f"""select md5('b' || id) as audit_id, service_id || '_' || ym as name,
  'data\\bronze\\' || service_id || '\\' || ym || '.parquet' as source_file, cast(bytecount as bigint) as bytecount,
  n as rowcount, start_timestamp, end_timestamp from ({_runs_sql('trips', 3, 'sum(part_key) as bytecount')})""")
define("audit_s", f"""select md5('s' || id) as audit_id, case when file_month = 3 then 'gone' else md5('b' || id) end as bronze_audit_id,
  'data/bronze/' || service_id || '/' || ym || '.parquet' as source_file, n as rowcount_bronze, n - rej as rowcount_quality,
  rej as rowcount_quarantined, start_timestamp, end_timestamp
  from ({_runs_sql('tagged', 2, 'count(reject_reason) as rej')}) where not (file_month = 7 and service_id = 'fhv')""")
define("audit_g", f"""select md5('g' || id) as gold_audit_id, md5('s' || id) as silver_audit_id, 'mart_' || service_id as mart_name,
  'marts' as subdir, case when run = 0 then 'full' else 'incremental' end as mode, n as rowcount_output, start_timestamp, end_timestamp
  from ({_runs_sql('trips', 2, '1 as one')})""")
define("audit_m", f"""select md5('m' || id) as ml_audit_id, service_id as pipeline, n as rowcount_output, start_timestamp as started_at
  from ({_runs_sql('trips', 2, '1 as one')})""")

_PATH = "replace(source_file, '\\', '/')"
_PARSED = (f"nullif(regexp_extract({_PATH}, 'bronze/([^/]+)/', 1), '') as categoria, "
           f"try_cast(regexp_extract({_PATH}, '/(\\d{{4}})-\\d{{2}}\\.parquet$', 1) as integer) as anio, "
           f"try_cast(regexp_extract({_PATH}, '/\\d{{4}}-(\\d{{2}})\\.parquet$', 1) as integer) as mes")
_ST, _EN = "cast(start_timestamp as timestamp)", "cast(end_timestamp as timestamp)"
_DUR = half(f"date_diff('microsecond', {_ST}, {_EN})/1e6", 3)
_SEC = f"cast(floor(date_diff('microsecond', {_ST}, {_EN})/1e6) as bigint)"
_FLAGS = ("cast(row_number() over (partition by {k} order by inicio, {t}) as integer) as n_corrida, "
          "inicio = max(inicio) over (partition by {k}) as es_ultima_corrida, cast(count(*) over (partition by {k}) as integer) as total_corridas")
_INICIO = "strftime(inicio, '%Y-%m-%d %H:%M:%S') as inicio"
_FIN = "strftime(fin, '%Y-%m-%d %H:%M:%S') as fin"
define("exp_b", f"""select *, {_FLAGS.format(k='source_file', t='audit_id')}, {half('bytecount/1048576e0')} as mb_descargados, categoria = 'zone-lookup' as es_zone_lookup
  from (select audit_id, name, {_PATH} as source_file, {_PARSED}, bytecount, rowcount, {_ST} as inicio, {_EN} as fin, {_DUR} as duracion_segundos from audit_b)""")
_REJ = half(ratio("rowcount_quarantined", "rowcount_bronze") + "*100e0", 4)
define("exp_s", f"""select *, {_FLAGS.format(k='source_file', t='audit_id')}, {_REJ} as pct_rechazo
  from (select audit_id, bronze_audit_id, {_PATH} as source_file, {_PARSED}, rowcount_bronze, rowcount_quality, rowcount_quarantined,
    {_ST} as inicio, {_EN} as fin, {_DUR} as duracion_segundos from audit_s)""")

query("audit_parse_source", compose(f"select audit_id, {_PATH} as source_file, {_PARSED} from audit_b"))(
    lambda t: audit.parse_source(t.audit_bronze).select("audit_id", "source_file", "categoria", "anio", "mes"))
query("audit_timestamps", compose(f"select audit_id, {time(_ST)} as inicio, {time(_EN)} as fin, {_DUR} as duracion_segundos from audit_b"))(
    lambda t: audit.with_times(t.audit_bronze).select("audit_id", "inicio", "fin", "duracion_segundos"))
define("lineage_log", f"""
select 'bronze' as layer, audit_id, cast(null as varchar) as fk_audit_id, source_file as source_name, cast(null as bigint) as rows_in,
  rowcount as rows_out, cast(null as bigint) as rows_rejected, start_timestamp, end_timestamp, {_SEC} as duration_sec from audit_b
union all select 'silver', audit_id, bronze_audit_id, source_file, rowcount_bronze, rowcount_quality, rowcount_quarantined, start_timestamp, end_timestamp, {_SEC} from audit_s
union all select 'gold', gold_audit_id, silver_audit_id, mart_name, null, rowcount_output, null, start_timestamp, end_timestamp, {_SEC} from audit_g""")


def _lineage(t, layer=None):
    return audit.lineage(t.audit_bronze, t.audit_silver, t.audit_gold, layer)


query("audit_lineage", compose("select * from lineage_log"))(lambda t: _lineage(t))
query("newest_first", compose("select * from lineage_log order by start_timestamp desc, audit_id limit 50 offset 20"))(
    lambda t: audit.lineage_page(_lineage(t), 50, 20))
query("concat_diagonal", compose("""
select ml_audit_id, pipeline, rowcount_output, started_at, cast(null as varchar) as orden from audit_m
union all select gold_audit_id, null, rowcount_output, start_timestamp, mode from audit_g
"""))(lambda t: columns.union_drift([t.audit_ml, t.audit_gold.select(
    F.col("gold_audit_id").alias("ml_audit_id"), "rowcount_output", F.col("start_timestamp").alias("started_at"), F.col("mode").alias("orden"))]))
query("filter_audit", compose("select audit_id, source_file from audit_s where contains(source_file, 'fhv') and contains(source_file, '1997-')"))(
    lambda t: selection.filter_audit(t.audit_silver, "fhv", 1997).select("audit_id", "source_file"))
query("anti_orphan_audit", compose("""
select 'silver' as layer, audit_id, bronze_audit_id as fk_audit_id from audit_s where bronze_audit_id not in (select audit_id from audit_b)
union all select 'gold', gold_audit_id, silver_audit_id from audit_g where silver_audit_id not in (select audit_id from audit_s)
"""))(lambda t: audit.orphans(t.audit_silver, t.audit_bronze, "bronze_audit_id", "audit_id").select(
    F.lit("silver").alias("layer"), "audit_id", F.col("bronze_audit_id").alias("fk_audit_id")).unionByName(
    audit.orphans(t.audit_gold, t.audit_silver, "silver_audit_id", "audit_id").select(
        F.lit("gold").alias("layer"), F.col("gold_audit_id").alias("audit_id"), F.col("silver_audit_id").alias("fk_audit_id"))))


def _summary(name, source, plan, shape, sql):
    query(name, compose(" union all ".join(sql)))(
        lambda t: long_form({k: (v, *shape[k]) for k, v in plan(getattr(t, source)).items()}))


_CLOCK = {"total_duration_sec": f"sum({_SEC})", "avg_duration_sec": half(xavg(_SEC), 1)}
_summary("audit_summary_bronze", "audit_bronze", audit.summary_bronze, {
    "total": ([], ["total_files", "total_bytes", "total_rows", "avg_rows", *_CLOCK]),
    "by_category": (["category"], ["files", "rows", "bytes"]), "by_month": (["period"], ["rows", "files"]),
}, [
    section_sql("total", [], {"total_files": "count(*)", "total_bytes": "sum(bytecount)", "total_rows": "sum(rowcount)",
                              "avg_rows": half(xavg("rowcount"), 0), **_CLOCK}, "audit_b"),
    section_sql("by_category", ["split_part(name, '_', 1)"], {"files": "count(*)", "rows": "sum(rowcount)", "bytes": "sum(bytecount)"}, "audit_b"),
    section_sql("by_month", ["right(name, 7)"], {"rows": "sum(rowcount)", "files": "count(*)"}, "audit_b"),
])
_SUMS = {"bronze_rows": "sum(rowcount_bronze)", "quality_rows": "sum(rowcount_quality)", "quarantined_rows": "sum(rowcount_quarantined)"}
_RATE = {"reject_rate": f"coalesce({pct('sum(rowcount_quarantined)', 'sum(rowcount_bronze)')}, 0)"}
_summary("audit_summary_silver", "audit_silver", audit.summary_silver, {
    "total": ([], ["files", *_SUMS, *_RATE, *_CLOCK]), "by_category": (["category"], ["files", *_SUMS, *_RATE]),
    "by_month": (["period"], [*_SUMS, "files"]),
}, [
    section_sql("total", [], {"files": "count(*)", **_SUMS, **_RATE, **_CLOCK}, "audit_s"),
    section_sql("by_category", ["split_part(source_file, '/', 3)"], {"files": "count(*)", **_SUMS, **_RATE}, "audit_s"),
    section_sql("by_month", ["replace(split_part(source_file, '/', 4), '.parquet', '')"], {**_SUMS, "files": "count(*)"}, "audit_s"),
])
_summary("audit_summary_gold", "audit_gold", audit.summary_gold, {
    "total": ([], ["total_builds", "total_output_rows", *_CLOCK]), "by_mart": (["mart_name"], ["rows", "builds"]),
    "mode_breakdown": (["mode"], ["count"]),
}, [
    section_sql("total", [], {"total_builds": "count(*)", "total_output_rows": "sum(rowcount_output)", **_CLOCK}, "audit_g"),
    section_sql("by_mart", ["mart_name"], {"rows": "sum(rowcount_output)", "builds": "count(*)"}, "audit_g"),
    section_sql("mode_breakdown", ["mode"], {"count": "count(*)"}, "audit_g"),
])
query("audit_run_flags", compose("select audit_id, source_file, n_corrida, es_ultima_corrida, total_corridas from exp_b"))(
    lambda t: audit.history("bronze", t.audit_bronze).select("audit_id", "source_file", "n_corrida", "es_ultima_corrida", "total_corridas"))
query("audit_export", compose(f"select * replace ({_INICIO}, {_FIN}) from exp_b"))(lambda t: audit.history("bronze", t.audit_bronze))
query("audit_export_silver", compose(f"select * replace ({_INICIO}, {_FIN}) from exp_s"))(lambda t: audit.history("silver", t.audit_silver))
query("audit_export_gold", compose(f"""
select gold_audit_id, silver_audit_id, mart_name, subdir, mode, rowcount_output, {_INICIO}, {_FIN}, {_DUR} as duracion_segundos,
  {_FLAGS.format(k='mart_name', t='gold_audit_id')}, filas_en_disco
from (select *, {_ST} as inicio, {_EN} as fin from audit_g)
left join (select 'mart_' || service_id as mart_name, count(*) as filas_en_disco from demand group by 1) using (mart_name)
"""))(lambda t: audit.with_stored_rows(audit.history("gold", t.audit_gold), t.demand.groupBy(F.concat(F.lit("mart_"), "service_id").alias("mart_name"))
                                  .agg(F.count(F.lit(1)).alias("filas_en_disco"))))
query("audit_export_ml", compose(f"""
select ml_audit_id, pipeline, rowcount_output, {_INICIO}, {_FLAGS.format(k='pipeline', t='ml_audit_id')}
from (select *, cast(started_at as timestamp) as inicio from audit_m)
"""))(lambda t: audit.history("ml", t.audit_ml))
query("join_audit_lineage", compose(f"""
select b.source_file, categoria, anio, mes, rowcount as filas_descargadas, bytecount, rowcount_bronze, rowcount_quality, rowcount_quarantined,
  {half('bytecount/1048576e0')} as mb_descargados, {_REJ} as pct_rechazo, rowcount_quality is null as falta_en_silver
from (select * from exp_b where es_ultima_corrida and not es_zone_lookup) b
left join (select source_file, rowcount_bronze, rowcount_quality, rowcount_quarantined from exp_s where es_ultima_corrida) s on s.source_file = b.source_file
"""))(lambda t: audit.export_lineage(t.audit_bronze, t.audit_silver))
query("audit_latest_per_file", compose("""
select * exclude (rn) from (select *, row_number() over (partition by source_file order by end_timestamp desc, audit_id) as rn from audit_s) where rn = 1
"""))(lambda t: audit.latest_per_file(t.audit_silver))
query("latest_audit_id", compose("select audit_id from audit_s order by start_timestamp desc, audit_id desc limit 1"))(
    lambda t: audit.latest_audit_id(t.audit_silver))

# ---- windows ----

query("win_dup_count", compose("select order_key, line_no, part_key, count(*) over (partition by service_id, order_key, line_no) as copias from trips"))(
    lambda t: ranking.with_key_stats(t.trips.select("service_id", "order_key", "line_no", "part_key"),
                                     ["service_id", "order_key", "line_no"], copias=F.count(F.lit(1))).drop("service_id"))
query("win_dup_rank", compose("""
select order_key, line_no, part_key, puesto, puesto = 1 as es_primera from (
  select *, cast(row_number() over (partition by service_id, order_key, line_no order by fare_amount desc, part_key, pickup_datetime, dropoff_datetime) as integer) as puesto from trips)
"""))(lambda t: ranking.numbered(
    t.trips.select("service_id", "order_key", "line_no", "part_key", "fare_amount", "pickup_datetime", "dropoff_datetime"), ["service_id", "order_key", "line_no"],
    [F.col("fare_amount").desc(), "part_key", "pickup_datetime", "dropoff_datetime"], "puesto").select(
        "order_key", "line_no", "part_key", "puesto", (F.col("puesto") == 1).alias("es_primera")))
query("win_pareto", compose("select service_id, year, pu_location_id, porcentaje_acumulado_ingresos, clase_abc from abc_xyz"))(
    lambda t: t.abc_xyz.select("service_id", "year", "pu_location_id", "porcentaje_acumulado_ingresos", "clase_abc"))
query("win_run_number", compose("""
select trip_id, row_number() over (partition by service_id, pickup_location_id order by pickup_datetime, trip_id) as n_viaje from facts
"""))(lambda t: ranking.ordinal(t.facts.select("trip_id", "service_id", "pickup_location_id", "pickup_datetime"),
                                ["service_id", "pickup_location_id"], "pickup_datetime", ["trip_id"], "n_viaje").select("trip_id", "n_viaje"))
query("win_latest_flag", compose("""
select trip_id, pickup_datetime = max(pickup_datetime) over (partition by pickup_location_id) as es_ultimo from facts
"""))(lambda t: ranking.with_key_stats(t.facts.select("trip_id", "pickup_location_id", "pickup_datetime"), ["pickup_location_id"],
                                       _last=F.max("pickup_datetime")).select(
    "trip_id", (F.col("pickup_datetime") == F.col("_last")).alias("es_ultimo")))
query("win_total_runs", compose("select trip_id, count(*) over (partition by service_id, pickup_location_id) as total from facts"))(
    lambda t: ranking.with_key_stats(t.facts.select("trip_id", "service_id", "pickup_location_id"),
                                     ["service_id", "pickup_location_id"], total=F.count(F.lit(1))).select("trip_id", "total"))
_SERIES = """(select h.borough, h.service_id, h.t as pickup_hour, coalesce(cast(trip_count as double), 0) as trip_count
from (select borough, service_id, unnest(generate_series(min(pickup_hour), max(pickup_hour), interval 1 hour)) as t from hourly group by 1,2) h
left join hourly y on y.borough = h.borough and y.service_id = h.service_id and y.pickup_hour = h.t)"""
query("gap_fill", compose(f"""
select borough, service_id, {day('pickup_hour')} as dia, count(*) as horas, cast(sum(trip_count) as bigint) as viajes,
  count(case when trip_count = 0 then 1 end) as horas_vacias from {_SERIES} group by 1,2,3
"""))(lambda t: ranking.gap_fill(t.hourly, ["borough", "service_id"], "pickup_hour", "trip_count")
      .groupBy("borough", "service_id", F.to_date("pickup_hour").alias("dia")).agg(
    F.count(F.lit(1)).alias("horas"), F.sum("trip_count").cast("long").alias("viajes"),
    count_where(F.col("trip_count") == 0).alias("horas_vacias")))
query("win_lags", compose(f"""
select borough, service_id, {day('pickup_hour')} as dia, count(d1_24) as n, sum(d1) as d1, sum(abs(d24)) as d24, sum(d1_24*d1_24) as d1_24 from (
  select borough, service_id, pickup_hour, trip_count - lag(trip_count, 1) over w as d1, trip_count - lag(trip_count, 24) over w as d24,
    trip_count - lag(trip_count, 1) over w - lag(trip_count, 24) over w + lag(trip_count, 25) over w as d1_24
  from {_SERIES} window w as (partition by borough, service_id order by pickup_hour)) group by 1,2,3
"""))(lambda t: ranking.lag_differences(
    ranking.gap_fill(t.hourly, ["borough", "service_id"], "pickup_hour", "trip_count"),
    ["borough", "service_id"], "pickup_hour", "trip_count")
    .groupBy("borough", "service_id", F.to_date("pickup_hour").alias("dia")).agg(
    F.count("d1_24").alias("n"), F.sum("d1").alias("d1"), F.sum(F.abs("d24")).alias("d24"),
    F.sum(F.col("d1_24") * F.col("d1_24")).alias("d1_24")))
_ZC = "(select service_id, zone, count(*) as n from facts join zones on location_id = pickup_location_id group by 1,2)"


def _zone_counts(t):
    from hackstand.operators.zones import with_zone
    by = t.facts.groupBy("service_id", "pickup_location_id").agg(F.count(F.lit(1)).alias("c"))
    return with_zone(by, t.zones, "pickup_location_id", "", ("borough", "zone")).groupBy("service_id", "zone").agg(F.sum("c").alias("n"))


query("win_group_share", compose(f"select service_id, zone, n, {half('cast(n as double)/sum(n) over (partition by service_id)*100e0')} as pct from {_ZC}"))(
    lambda t: ranking.group_share(_zone_counts(t), ["service_id"], "n"))
query("join_group_totals", compose(f"select service_id, zone, n, {half('cast(n as double)/(sum(n) over (partition by zone))*100e0')} as pct from {_ZC}"))(
    lambda t: ranking.group_share(_zone_counts(t), ["zone"], "n"))
query("win_mode", compose(f"select service_id, zone, n from (select *, row_number() over (partition by service_id order by n desc, zone) as rn from {_ZC}) where rn = 1"))(
    lambda t: ranking.mode_per_group(_zone_counts(t), ["service_id"], "zone", "n"))
query("topn_with_rest", compose(f"""
select service_id, case when rn <= 8 then zone else 'Otros' end as zone, cast(sum(n) as bigint) as n
from (select *, row_number() over (partition by service_id order by n desc, zone) as rn from {_ZC}) group by 1,2
"""))(lambda t: selection.top_n_with_rest(_zone_counts(t), ["service_id"], "zone", "n", 8, "Otros"))
