"""Reads over stored marts: the generic query and the dashboard summaries.

Every summary is a dict of small DataFrames over one stored mart, so a caller runs only the
parts it shows and each part reads only its own columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hackstand import fixed_values as fv
from hackstand.functions.numeric import (
    count_where, exact_avg, exact_sum, guarded_ratio, half_up, percent,
)
from hackstand.operators.selection import filter_dynamic, page

AGGREGATES = {
    "sum": F.sum, "mean": F.avg, "min": F.min, "max": F.max, "count": F.count, "std": F.stddev_samp,
    "var": F.var_samp, "median": F.median, "n_unique": F.count_distinct,
}


def query_mart(mart: DataFrame, filters=None, group_by=None, agg=None, order_by=None, limit=None, offset=None) -> DataFrame:
    """Filter, aggregate by name, order, and cut a page."""
    df = filter_dynamic(mart, filters or {})
    if group_by and agg:
        df = df.groupBy(*group_by).agg(*[AGGREGATES[fn](F.col(c)).alias(c) for c, fn in agg.items()])
    return page(df, order_by, limit, offset)


def count_mart(mart: DataFrame, filters=None) -> DataFrame:
    return filter_dynamic(mart, filters or {}).agg(F.count(F.lit(1)).alias("total"))


def _zero(column: str) -> Column:
    """Sum in which an all-NULL column counts as zero."""
    return F.coalesce(exact_sum(F.col(column)), F.lit(0.0))


def _trips(alias: str = "viajes") -> Column:
    return F.sum("viajes").alias(alias)


def summary_demand(mart: DataFrame) -> dict[str, DataFrame]:
    return {
        "timeline": mart.groupBy("fecha_viaje").agg(_trips(), _zero("espera_total_min").alias("espera_total_min")),
        "top_zones": top_zones(mart, ["pu_zone"]),
        "by_service": mart.groupBy("service_id").agg(_trips()),
        "by_hour": mart.groupBy("pickup_hour", "service_id").agg(_trips()),
        "by_borough": mart.groupBy("pu_borough").agg(_trips()),
        "total": mart.agg(_trips(), _zero("espera_total_min").alias("espera_total_min"),
                          F.sum("viajes_con_espera").alias("viajes_con_espera")),
    }


def top_zones(mart: DataFrame, by=("pu_zone", "pu_borough"), n: int = 10) -> DataFrame:
    return mart.groupBy(*by).agg(_trips()).orderBy(F.col("viajes").desc(), *by).limit(n)


def demand_monthly_pivot(mart: DataFrame, unit: float = 1e6) -> DataFrame:
    """Trips per month and service, in units of ``unit``."""
    counts = mart.groupBy("month").pivot("service_id", list(fv.SERVICES)).agg(F.sum("viajes"))
    return counts.select("month", *[half_up(F.col(s) / unit, 2).alias(s) for s in fv.SERVICES])


def demand_service_groups(mart: DataFrame) -> dict[str, DataFrame]:
    app = F.col("service_id").isin(*fv.APP_SERVICES)
    return {
        "groups": mart.agg(
            F.sum(F.when(app, F.col("viajes")).otherwise(0)).alias("apps"),
            F.sum(F.when(~app, F.col("viajes")).otherwise(0)).alias("taxis"),
            guarded_ratio(exact_sum(F.col("espera_total_min")), F.sum("viajes_con_espera")).alias("espera_prom"),
        ),
        "by_hour": mart.groupBy("pickup_hour").pivot("service_id", list(fv.SERVICES)).agg(F.sum("viajes")).fillna(0),
    }


def summary_financial(mart: DataFrame) -> dict[str, DataFrame]:
    gross = (_zero("total_amount") + _zero("base_passenger_fare"))

    def paid(*names: str) -> Column:
        return exact_sum(F.coalesce(*[F.col(n) for n in names], F.lit(0.0)))

    margin, base, driver = _zero("margen_plataforma"), _zero("base_passenger_fare"), _zero("driver_pay")
    return {
        "total": mart.agg(
            gross.alias("ingreso_bruto"), margin.alias("margen_plataforma"), base.alias("base_passenger_fare"),
            driver.alias("driver_pay"), half_up(guarded_ratio(driver, base), 4).alias("ratio_pago_conductor"),
            half_up(guarded_ratio(margin, base), 4).alias("margen_promedio"),
        ),
        "by_service": mart.groupBy("service_id").agg(
            paid("fare_amount", "base_passenger_fare").alias("fare"), paid("tip_amount", "tips").alias("tips"),
            paid("tolls_amount", "tolls").alias("tolls"), paid("congestion_surcharge", "bcf").alias("congestion"),
            gross.alias("ingreso_bruto"), margin.alias("margen"),
            half_up(guarded_ratio(driver, base), 4).alias("ratio"),
        ),
        "matrix": mart.groupBy("year", "month", "service_id").agg(
            gross.alias("ingreso_total"), half_up(guarded_ratio(margin, base), 4).alias("margen_promedio")
        ),
    }


def summary_operational(mart: DataFrame) -> dict[str, DataFrame]:
    def mean(c: str, alias: str) -> Column:
        return exact_avg(F.col(c)).alias(alias)

    return {
        "by_block": mart.groupBy("bloque_horario").agg(
            mean("velocidad_promedio_mph", "velocidad_promedio"), mean("distancia_promedio_millas", "distancia_promedio"),
            _zero("distancia_total_millas").alias("distancia_total"), mean("duracion_promedio_min", "duracion_promedio"),
            mean("tasa_ocupacion_compartida", "tasa_ocupacion"),
        ),
        "by_borough": mart.groupBy("pu_borough").agg(
            _trips(), mean("velocidad_promedio_mph", "velocidad_promedio"),
            mean("distancia_promedio_millas", "distancia_promedio"),
        ),
        "scatter": mart.groupBy("bloque_horario", "service_id").agg(
            mean("duracion_promedio_min", "duracion"), mean("distancia_promedio_millas", "distancia")
        ),
        "shared_efficiency": mart.agg(_trips(), F.sum("viajes_match_compartido").alias("viajes_match")),
        "total": mart.agg(
            mean("duracion_promedio_min", "duracion_promedio"), mean("velocidad_promedio_mph", "velocidad_promedio"),
            mean("tasa_ocupacion_compartida", "tasa_ocupacion"),
        ),
    }


_ZONE = ["location_id", "zone", "borough"]


def busiest_zones(mart: DataFrame, n: int = 20) -> DataFrame:
    counts = mart.groupBy(*_ZONE).agg(F.count(F.lit(1)).alias("periods"))
    return counts.orderBy(F.col("periods").desc(), "location_id").limit(n)


def summary_supply_demand(mart: DataFrame, demand: DataFrame) -> dict[str, DataFrame]:
    flow = F.sum("flujo_neto_oferta").alias("flujo_neto_oferta")
    severe = count_where(F.col("deficit_severo_flag"))
    zone_flow = mart.groupBy(*_ZONE).agg(flow)
    ids = busiest_zones(mart).select("location_id")
    return {
        "by_borough": mart.groupBy("borough").agg(
            flow, severe.alias("deficit_count"), F.count(F.lit(1)).alias("periods")
        ),
        "by_zone_hour": mart.join(ids, "location_id", "left_semi")
        .groupBy(*_ZONE, F.hour("bloque_temporal_t").alias("hour")).agg(flow),
        "top_deficit_zones": zone_flow.orderBy("flujo_neto_oferta", "location_id").limit(10),
        "top_surplus_zones": zone_flow.orderBy(F.col("flujo_neto_oferta").desc(), "location_id").limit(10),
        "total": mart.agg(
            percent(severe, F.count(F.lit(1))).alias("deficit_ratio"),
            F.count(F.lit(1)).alias("total_periods"),
            F.count_distinct(F.when(F.col("deficit_severo_flag"), F.col("location_id"))).alias("critical_zones_count"),
            F.sum("flujo_neto_oferta").cast("double").alias("global_net_flow"),
        ),
        "wait": demand.agg(exact_avg(F.col("espera_promedio_min")).alias("avg_wait_min")),
    }


def summary_abc_xyz(mart: DataFrame) -> dict[str, DataFrame]:
    return {
        "scatter": mart,
        "abc_distribution": mart.groupBy("clase_abc").agg(F.count(F.lit(1)).alias("count")),
        "xyz_distribution": mart.groupBy("clase_xyz").agg(F.count(F.lit(1)).alias("count")),
    }


def abc_xyz_matrix(mart: DataFrame) -> DataFrame:
    cells = mart.filter(F.col("clase_abc").isNotNull() & F.col("clase_xyz").isNotNull())
    return cells.groupBy("clase_abc").pivot("clase_xyz", ["X", "Y", "Z"]).count().fillna(0)


def pareto_curve(mart: DataFrame, n: int = 40) -> DataFrame:
    """The n largest zones with cumulative share, and all others as one last point.

    Only the n kept rows enter the ordered window; the rest is total minus kept.
    """
    keys = ["service_id", "year", "pu_location_id"]
    rows = mart.select(*keys, "zone", F.col("ingresos_totales_zona").alias("ingresos"))
    whole = rows.agg(exact_sum(F.col("ingresos")).alias("_all"), F.count(F.lit(1)).alias("_n"))
    top = rows.orderBy(F.col("ingresos").desc_nulls_last(), *keys).limit(n)
    order = Window.orderBy(F.col("ingresos").desc_nulls_last(), *keys)
    units = F.floor(F.col("ingresos") * 1e4 + 0.5).cast("long")
    running = F.sum(units).over(order.rowsBetween(Window.unboundedPreceding, 0)).cast("double") / 1e4
    curve = top.select(F.row_number().over(order).alias("pos"), "zone", "ingresos", running.alias("_cum"))
    kept = top.agg(exact_sum(F.col("ingresos")).alias("_kept"))
    rest = whole.filter(F.col("_n") > n).select(
        F.lit(n + 1).alias("pos"), F.lit("Otras zonas").alias("zone"),
        half_up(F.col("_all") - kept.scalar(), 2).alias("ingresos"), F.col("_all").alias("_cum"),
    )
    share = guarded_ratio(F.col("_cum"), whole.select("_all").scalar())
    return curve.unionByName(rest).select("pos", "zone", "ingresos", half_up(share * 100.0, 1).alias("acumulado_pct"))


def summary_tipping(mart: DataFrame) -> dict[str, DataFrame]:
    rated = mart.filter(F.col("categoria_generosidad").isNotNull())
    share = exact_avg(F.col("porcentaje_propina_ponderado"))
    untipped = half_up((F.lit(1.0) - F.sum("viajes_con_propina") / F.sum("viajes")) * 100.0, 2)
    return {
        "total": rated.agg(
            share.alias("pct_propina_promedio"), exact_avg(F.col("propina_por_milla")).alias("propina_prom_por_milla"),
            _trips(), F.when(F.sum("viajes") > 0, untipped).otherwise(0.0).alias("pct_viajes_sin_propina"),
        ),
        "by_borough_origin": rated.groupBy("pu_borough").agg(share.alias("pct_propina"), _trips()),
        "by_borough_destination": rated.groupBy("do_borough").agg(share.alias("pct_propina"), _trips()),
        "generosity_by_service": mart.groupBy("service_id", "categoria_generosidad").agg(_trips()),
    }


def tipping_borough_compare(mart: DataFrame) -> dict[str, DataFrame]:
    parts = summary_tipping(mart)
    there = parts["by_borough_destination"].select(F.col("do_borough").alias("borough"), F.col("pct_propina").alias("destino"))
    here = parts["by_borough_origin"].filter("pu_borough is not null").select(
        F.col("pu_borough").alias("borough"), F.col("pct_propina").alias("origen"))
    labels = ["Sin Propina", "Baja", "Estándar", "Alta"]
    return {
        "compare": here.join(there, "borough", "left"),
        "stack": mart.groupBy("service_id").pivot("categoria_generosidad", labels).agg(F.sum("viajes")).fillna(0),
    }


def realtime_rollup(rows: DataFrame, category: str, value: str, n: int = 15) -> dict[str, DataFrame]:
    """Total of a live view and its n largest categories."""
    by = rows.groupBy(F.coalesce(F.col(category).cast("string"), F.lit("?")).alias("name")).agg(
        exact_sum(F.coalesce(F.col(value), F.lit(0))).alias("value"))
    return {
        "total": rows.agg(exact_sum(F.coalesce(F.col(value), F.lit(0))).alias("value")),
        "top": by.orderBy(F.col("value").desc(), "name").limit(n),
    }
