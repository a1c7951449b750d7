"""Queries: sources and sinks, each written to the shared folder and read back."""

from pyspark.sql import functions as F

from hackstand import fixed_values as fv
from hackstand.catalog.registry import query
from hackstand.catalog.sql import compose, day
from hackstand.catalog.tables import TRIP_ROLES
from hackstand.plans import audit
from hackstand.session import materialise, scratch_path
from hackstand.settings import DEFAULTS
from hackstand.sources import files, sinks

_D = f"replace ({day('fecha_viaje')} as fecha_viaje)"


def _stored(t, df, label="mart", keys=sinks.KEYS):
    path = scratch_path(t.spark, label)
    sinks.write_partitioned(df, path, keys)
    return path


def _trips(t):
    return t.trips.select("service_id", F.col("file_year").alias("year"), F.col("file_month").alias("month"),
                          "order_key", "line_no", "part_key", "fare_amount")


@query("src_trip_month", compose("""
select service_id, file_year as year, file_month as month, order_key, line_no, part_key, fare_amount from trips
where service_id = 'yellow' and file_year = 1997 and file_month in (3, 4)
"""))
def _month(t):
    """Two months as files whose keys differ in width, and a month that is absent."""
    root, trips = scratch_path(t.spark, "months"), _trips(t).filter("service_id = 'yellow' and year = 1997")
    for month, kind in ((3, "int"), (4, "long")):
        one = trips.filter(F.col("month") == month).drop("year", "month").withColumn("order_key", F.col("order_key").cast(kind))
        one.write.parquet(files.month_path(root, "yellow", 1997, month))
    found = files.read_months(t.spark, root, files.expand_targets([("yellow", 1997, m) for m in (3, 4, 5)]))["yellow"]
    return found.select("service_id", F.col("file_year").alias("year"), F.col("file_month").alias("month"), "order_key", "line_no", "part_key", "fare_amount")


@query("month_footers", compose("""
select category, year, month, filas, case when filas is null then 'absent' end as error from (
  select c as category, cast(1998 as integer) as year, cast(m as integer) as month from (values ('green'), ('fhv')) s(c), generate_series(1, 4) b(m))
left join (select service_id as category, file_year as year, file_month as month, count(*) as filas from trips
           where service_id = 'green' and file_year = 1998 and file_month in (1, 2) group by 1,2,3) using (category, year, month)
"""))
def _month_footers(t):
    """Rows of each wanted month as its footers tell them, without a scan."""
    root, trips = scratch_path(t.spark, "months"), _trips(t).filter("service_id = 'green' and year = 1998")
    for month in (1, 2):
        trips.filter(F.col("month") == month).write.parquet(files.month_path(root, "green", 1998, month))
    wanted = files.expand_targets([(c, 1998, m) for c in ("green", "fhv") for m in range(1, 5)])
    return files.month_footers(t.spark, root, wanted).groupBy("category", "year", "month").agg(F.sum("rows").alias("filas"), F.min("error").alias("error"))


@query("src_zone_lookup", compose("select location_id as \"LocationID\", borough as \"Borough\", zone as \"Zone\", 'zone ' || zone as service_zone from zones"))
def _zones(t):
    path = scratch_path(t.spark, "zones")
    t.zones.withColumn("service_zone", F.concat(F.lit("zone "), "Zone")).write.option("header", True).csv(f"{path}.csv")
    return files.store_zone_lookup(t.spark, f"{path}.csv", path)


_TARGETS = ("(select c as category, cast(y as integer) as year, cast(m as integer) as month from (values ('green'),('yellow'),('fhv'),('fhvhv')) s(c), "
            "generate_series(1994, 2001) a(y), generate_series(1, 12) b(m))")


@query("expand_targets", compose(f"""
select category, year, month, (select count(*) from trips where service_id = category and file_year = year and file_month = month) as filas from {_TARGETS}
"""))
def _targets(t):
    wanted = files.targets_frame(t.spark, files.expand_targets(range(1994, 2002)))
    counts = _trips(t).groupBy(F.col("service_id").alias("category"), "year", "month").agg(F.count(F.lit(1)).alias("filas"))
    return wanted.join(counts, ["category", "year", "month"], "left").fillna(0, ["filas"])


@query("missing_partitions", compose(f"""
select category, year, month from {_TARGETS} except
select service_id, file_year, file_month from trips
"""))
def _missing(t):
    path = _stored(t, _trips(t), "trips")
    wanted = files.targets_frame(t.spark, files.expand_targets(range(1994, 2002)))
    return files.missing_partitions(wanted, files.present_months(t.spark, path))


@query("file_inventory", compose("select file_year as year, file_month as month, " + ", ".join(
    f"nullif(count(case when service_id = '{s}' then 1 end), 0) as {s}" for s in fv.SERVICES) + " from trips group by 1,2"))
def _inventory(t):
    return files.inventory_pivot(files.inventory(t.spark, _stored(t, _trips(t), "trips")))


@query("scan_mart", compose(f"select * {_D} from demand where year in (1996, 1998) and month = 5"))
def _scan(t):
    return files.scan_mart(t.spark, _stored(t, t.demand), [1996, 1998], [5], integers=("viajes",))


@query("sink_partitioned", compose("""
select service_id, year, month, cast(sum(case when service_id = 'green' and year = 1999 then viajes*2 else viajes end) as bigint) as viajes
from demand group by 1,2,3
"""))
def _partitioned(t):
    demand = materialise(t.demand, "demand")
    path = _stored(t, demand)
    again = demand.filter("service_id = 'green' and year = 1999").withColumn("viajes", F.col("viajes") * 2)
    sinks.write_partitioned(again, path)
    return files.scan_mart(t.spark, path).groupBy(*sinks.KEYS).agg(F.sum("viajes").alias("viajes"))


@query("sink_incremental", compose("""
select service_id, year, month, cast(sum(case when year > 1998 then viajes*10 else viajes end) as bigint) as viajes from demand group by 1,2,3
"""))
def _incremental(t):
    demand = materialise(t.demand, "demand")
    path = _stored(t, demand.filter("year <= 1998"))
    sinks.write_incremental(demand.withColumn("viajes", F.col("viajes") * 10), path)
    return files.scan_mart(t.spark, path).groupBy(*sinks.KEYS).agg(F.sum("viajes").alias("viajes"))


@query("sink_stage_reject", compose("""
select service_id, file_year, file_month, count(case when reject_reason is null then 1 end) as limpios, count(reject_reason) as rechazados
from tagged group by 1,2,3
"""))
def _stage_reject(t):
    path = scratch_path(t.spark, "silver")
    sinks.write_stage_reject(t.tagged, path, TRIP_ROLES.scope)
    clean = sinks.read_stage(t.spark, path).groupBy(*TRIP_ROLES.scope).agg(F.count(F.lit(1)).alias("limpios"))
    bad = sinks.read_reject(t.spark, path).groupBy(*TRIP_ROLES.scope).agg(F.count(F.lit(1)).alias("rechazados"))
    return clean.join(bad, list(TRIP_ROLES.scope), "full_outer").fillna(0, ["limpios", "rechazados"])


@query("export_consolidate", compose(f"select * {_D} from tipping"))
def _export(t):
    source = _stored(t, t.tipping)
    sinks.export_table(t.spark, source, f"{source}-export")
    return t.spark.read.parquet(f"{source}-export")


@query("export_drift", compose("""
select 'recargo' as name, 'double' as kinds, (select count(*) from (select distinct service_id, year, month from demand where year > 1998)) as present,
  (select count(*) from (select distinct service_id, year, month from demand)) as groups
"""))
def _drift(t):
    """A column that came in a later year, found in the footers."""
    demand = materialise(t.demand, "demand")
    path = _stored(t, demand.filter("year <= 1998"))
    sinks.write_incremental(demand.withColumn("recargo", F.lit(0.5)), path)
    return sinks.export_drift(t.spark, path).withColumn("kinds", F.array_join("kinds", ","))


@query("file_sizing", compose("""
select service_id, count(*) as filas, cast(greatest(1, least(32, ceil(count(*)/1000e0))) as integer) as archivos from trips group by 1
"""))
def _sizing(t):
    counts = t.trips.groupBy("service_id").agg(F.count(F.lit(1)).alias("filas")).collect()  # four services
    rows = [(r["service_id"], r["filas"], sinks.target_files(r["filas"], 1000)) for r in counts]
    return t.spark.createDataFrame(rows, "service_id string, filas long, archivos int")


query("export_cluster_artifacts", compose("""
select service_id, franja_horaria, count(*) as count from kfeat where service_id in ('yellow', 'green', 'fhvhv') group by 1,2
"""))(lambda t: sinks.merge_artifacts({s: t.cluster_features.filter(F.col("service_id") == s).groupBy("franja_horaria").count()
                                       for s in ("yellow", "green", "fhvhv")}))


@query("audit_append", compose(
    "select pipeline, filas from (select service_id as pipeline, count(*) as filas from trips group by 1) union all select 'todos', count(*) from trips"))
def _append(t):
    """One run is appended per service and one for all, each as a record of its own."""
    path = scratch_path(t.spark, "audit")
    counts = t.trips.groupBy("service_id").agg(F.count(F.lit(1)).alias("n")).orderBy("service_id").collect()  # four services
    for name, rows in [*((r["service_id"], r["n"]) for r in counts), ("todos", sum(r["n"] for r in counts))]:
        audit.append_run(t.spark, path, {"pipeline": name, "filas": rows}, DEFAULTS)
    return t.spark.read.parquet(path).select("pipeline", "filas")
