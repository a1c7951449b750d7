"""Queries: reads over stored marts."""

from pyspark.sql import functions as F

from hackstand.catalog.registry import query
from hackstand.catalog.sections import long_form, section_sql
from hackstand.catalog.sql import compose, half, pct, ratio, time, wsum, xavg, xsum
from hackstand.plans import marts, serving
from hackstand.session import materialise


def stored(df, name):
    """A mart as readers meet it: a table on the shared storage."""
    return materialise(df, name)


def bundle(name, mart, plan, shape, sql, facts=None):
    """``shape`` gives each part's keys and measures; ``facts`` the columns of the facts that a plan over several marts stores first."""
    @query(name, compose(" union all ".join(sql)))
    def build(t):
        t = t.with_stored_facts(*facts) if facts else t
        parts = plan(t, stored(getattr(t, mart), mart))
        return long_form({k: (parts[k], *shape[k]) for k in shape})
    return build


def _z(c):
    return f"coalesce({xsum(c)}, 0)"


query("query_mart", compose(f"""
select service_id, month, cast(sum(viajes) as bigint) as viajes, max(espera_promedio_min) as espera_promedio_min from demand
where service_id in ('fhvhv','yellow') group by 1,2 order by viajes desc, service_id, month limit 10 offset 3
"""))(lambda t: serving.query_mart(
    stored(t.demand, "demand"), {"service_id": ["fhvhv", "yellow"], "year": None}, ["service_id", "month"],
    {"viajes": "sum", "espera_promedio_min": "max"},
    [("viajes", "desc"), ("service_id", "asc"), ("month", "asc")], limit=10, offset=3))
query("count_mart", compose("select count(*) as total from demand where service_id = 'green' and pickup_hour in (8, 9)"))(
    lambda t: serving.count_mart(t.demand, {"service_id": "green", "pickup_hour": [8, 9]}))
query("sort_multi", compose("""
select service_id, pu_borough, cast(sum(viajes) as bigint) as viajes from demand group by 1,2 order by 1, 3 desc limit 7
"""))(lambda t: serving.query_mart(t.demand, None, ["service_id", "pu_borough"], {"viajes": "sum"},
                                   [("service_id", "asc"), ("viajes", "desc")], limit=7))
query("page_slice", compose("select * from (select pu_zone, cast(sum(viajes) as bigint) as viajes from demand group by 1) order by 2 desc, 1 offset 5"))(
    lambda t: serving.query_mart(t.demand, None, ["pu_zone"], {"viajes": "sum"}, [("viajes", "desc"), ("pu_zone", "asc")], offset=5))
query("topk_zones", compose("select pu_zone, pu_borough, cast(sum(viajes) as bigint) as viajes from demand group by 1,2 order by 3 desc, 1, 2 limit 20"))(
    lambda t: serving.top_zones(t.demand, n=20))
query("top_zones", compose("select pu_zone, pu_borough, cast(sum(viajes) as bigint) as viajes from demand group by 1,2 order by 3 desc, 1, 2 limit 10"))(
    lambda t: serving.top_zones(t.demand))
query("demand_monthly_pivot", compose("select month, " + ", ".join(
    half(f"cast(sum(case when service_id = '{s}' then viajes end) as double)/1e3") + f" as {s}" for s in ("green", "yellow", "fhv", "fhvhv")
) + " from demand group by 1"))(lambda t: serving.demand_monthly_pivot(t.demand, 1e3))

bundle("summary_demand", "demand", lambda t, m: serving.summary_demand(m), {
    "timeline": (["fecha_viaje"], ["viajes", "espera_total_min"]), "top_zones": (["pu_zone"], ["viajes"]),
    "by_service": (["service_id"], ["viajes"]), "by_hour": (["pickup_hour", "service_id"], ["viajes"]),
    "by_borough": (["pu_borough"], ["viajes"]), "total": ([], ["viajes", "espera_total_min", "viajes_con_espera"]),
}, [
    section_sql("timeline", ["fecha_viaje"], {"viajes": "sum(viajes)", "espera_total_min": _z("espera_total_min")}, "demand"),
    section_sql("top_zones", ["pu_zone"], {"viajes": "sum(viajes)"}, "demand", " order by sum(viajes) desc, pu_zone limit 10"),
    section_sql("by_service", ["service_id"], {"viajes": "sum(viajes)"}, "demand"),
    section_sql("by_hour", ["pickup_hour", "service_id"], {"viajes": "sum(viajes)"}, "demand"),
    section_sql("by_borough", ["pu_borough"], {"viajes": "sum(viajes)"}, "demand"),
    section_sql("total", [], {"viajes": "sum(viajes)", "espera_total_min": _z("espera_total_min"),
                              "viajes_con_espera": "sum(viajes_con_espera)"}, "demand"),
])

_GROSS = f"({_z('total_amount')} + {_z('base_passenger_fare')})"
_SHARE = half(ratio(_z("driver_pay"), _z("base_passenger_fare")), 4)
_MARGIN = half(ratio(_z("margen_plataforma"), _z("base_passenger_fare")), 4)
bundle("summary_financial", "financial", lambda t, m: serving.summary_financial(m), {
    "total": ([], ["ingreso_bruto", "margen_plataforma", "base_passenger_fare", "driver_pay", "ratio_pago_conductor", "margen_promedio"]),
    "by_service": (["service_id"], ["fare", "tips", "tolls", "congestion", "ingreso_bruto", "margen", "ratio"]),
    "matrix": (["year", "month", "service_id"], ["ingreso_total", "margen_promedio"]),
}, [
    section_sql("total", [], {"ingreso_bruto": _GROSS, "margen_plataforma": _z("margen_plataforma"),
                              "base_passenger_fare": _z("base_passenger_fare"), "driver_pay": _z("driver_pay"),
                              "ratio_pago_conductor": _SHARE, "margen_promedio": _MARGIN}, "financial"),
    section_sql("by_service", ["service_id"], {
        "fare": xsum("coalesce(fare_amount, base_passenger_fare, 0)"), "tips": xsum("coalesce(tip_amount, tips, 0)"),
        "tolls": xsum("coalesce(tolls_amount, tolls, 0)"), "congestion": xsum("coalesce(congestion_surcharge, bcf, 0)"),
        "ingreso_bruto": _GROSS, "margen": _z("margen_plataforma"), "ratio": _SHARE}, "financial"),
    section_sql("matrix", ["year", "month", "service_id"], {"ingreso_total": _GROSS, "margen_promedio": _MARGIN}, "financial"),
])

bundle("summary_operational", "operational", lambda t, m: serving.summary_operational(m), {
    "by_block": (["bloque_horario"], ["velocidad_promedio", "distancia_promedio", "distancia_total", "duracion_promedio", "tasa_ocupacion"]),
    "by_borough": (["pu_borough"], ["viajes", "velocidad_promedio", "distancia_promedio"]),
    "scatter": (["bloque_horario", "service_id"], ["duracion", "distancia"]),
    "shared_efficiency": ([], ["viajes", "viajes_match"]),
    "total": ([], ["duracion_promedio", "velocidad_promedio", "tasa_ocupacion"]),
}, [
    section_sql("by_block", ["bloque_horario"], {
        "velocidad_promedio": xavg("velocidad_promedio_mph"), "distancia_promedio": xavg("distancia_promedio_millas"),
        "distancia_total": _z("distancia_total_millas"), "duracion_promedio": xavg("duracion_promedio_min"),
        "tasa_ocupacion": xavg("tasa_ocupacion_compartida")}, "operational"),
    section_sql("by_borough", ["pu_borough"], {"viajes": "sum(viajes)", "velocidad_promedio": xavg("velocidad_promedio_mph"),
                                               "distancia_promedio": xavg("distancia_promedio_millas")}, "operational"),
    section_sql("scatter", ["bloque_horario", "service_id"], {"duracion": xavg("duracion_promedio_min"),
                                                              "distancia": xavg("distancia_promedio_millas")}, "operational"),
    section_sql("shared_efficiency", [], {"viajes": "sum(viajes)", "viajes_match": "sum(viajes_match_compartido)"}, "operational"),
    section_sql("total", [], {"duracion_promedio": xavg("duracion_promedio_min"), "velocidad_promedio": xavg("velocidad_promedio_mph"),
                              "tasa_ocupacion": xavg("tasa_ocupacion_compartida")}, "operational"),
])

_BUSY = "(select location_id from balance group by 1 order by count(*) desc, 1 limit 20)"
_Z = ["location_id", "zone", "borough"]
bundle("summary_supply_demand", "balance", lambda t, m: serving.summary_supply_demand(m, t.demand), {
    "by_borough": (["borough"], ["flujo_neto_oferta", "deficit_count", "periods"]),
    "by_zone_hour": (_Z + ["hour"], ["flujo_neto_oferta"]),
    "top_deficit_zones": (_Z, ["flujo_neto_oferta"]), "top_surplus_zones": (_Z, ["flujo_neto_oferta"]),
    "total": ([], ["deficit_ratio", "total_periods", "critical_zones_count", "global_net_flow"]),
    "wait": ([], ["avg_wait_min"]),
}, [
    section_sql("by_borough", ["borough"], {"flujo_neto_oferta": "sum(flujo_neto_oferta)",
                                            "deficit_count": "count(case when deficit_severo_flag then 1 end)", "periods": "count(*)"}, "balance"),
    section_sql("by_zone_hour", _Z + ["hour(bloque_temporal_t)"], {"flujo_neto_oferta": "sum(flujo_neto_oferta)"},
                f"balance where location_id in {_BUSY}"),
    section_sql("top_deficit_zones", _Z, {"flujo_neto_oferta": "sum(flujo_neto_oferta)"}, "balance",
                " order by sum(flujo_neto_oferta), location_id limit 10"),
    section_sql("top_surplus_zones", _Z, {"flujo_neto_oferta": "sum(flujo_neto_oferta)"}, "balance",
                " order by sum(flujo_neto_oferta) desc, location_id limit 10"),
    section_sql("total", [], {"deficit_ratio": pct("count(case when deficit_severo_flag then 1 end)", "count(*)"), "total_periods": "count(*)",
                              "critical_zones_count": "count(distinct case when deficit_severo_flag then location_id end)",
                              "global_net_flow": "sum(flujo_neto_oferta)"}, "balance"),
    section_sql("wait", [], {"avg_wait_min": xavg("espera_promedio_min")}, "demand"),
], facts=("dropoff_datetime", "dropoff_location_id", "hvfhs_license_num", "on_scene_datetime", "request_datetime"))
query("semi_top_ids", compose(f"select location_id, {time('bloque_temporal_t')} as bloque_temporal_t, flujo_neto_oferta from balance where location_id in {_BUSY}"))(
    lambda t: t.balance.join(serving.busiest_zones(t.balance).select("location_id"), "location_id", "left_semi")
    .select("location_id", "bloque_temporal_t", "flujo_neto_oferta"))

bundle("summary_abc_xyz", "abc_xyz", lambda t, m: serving.summary_abc_xyz(m), {
    "scatter": (["service_id", "year", "pu_location_id"], ["ingresos_totales_zona", "porcentaje_acumulado_ingresos"]),
    "abc_distribution": (["clase_abc"], ["count"]), "xyz_distribution": (["clase_xyz"], ["count"]),
}, [
    section_sql("scatter", ["service_id", "year", "pu_location_id"], {
        "ingresos_totales_zona": "max(ingresos_totales_zona)", "porcentaje_acumulado_ingresos": "max(porcentaje_acumulado_ingresos)"}, "abc_xyz"),
    section_sql("abc_distribution", ["clase_abc"], {"count": "count(*)"}, "abc_xyz"),
    section_sql("xyz_distribution", ["clase_xyz"], {"count": "count(*)"}, "abc_xyz"),
])
query("abc_xyz_matrix", compose("select clase_abc, " + ", ".join(
    f"count(case when clase_xyz = '{x}' then 1 end) as \"{x}\"" for x in "XYZ") + " from abc_xyz where clase_abc is not null and clase_xyz is not null group by 1"))(
    lambda t: serving.abc_xyz_matrix(t.abc_xyz))
_PORDER = "ingresos_totales_zona desc, service_id, year, pu_location_id"
query("pareto_curve", compose(f"""
with ranked as (select zone, ingresos_totales_zona as ingresos, row_number() over (order by {_PORDER}) as pos,
    {wsum('ingresos_totales_zona', f'order by {_PORDER} rows between unbounded preceding and current row')} as cum from abc_xyz),
  whole as (select {xsum('ingresos')} as al, {xsum('case when pos <= 40 then ingresos end')} as kept, count(*) as n from ranked)
select pos, zone, ingresos, {half('cum/al*100e0', 1)} as acumulado_pct from ranked, whole where pos <= 40
union all select 41, 'Otras zonas', {half('al - kept')}, 100e0 from whole where n > 40
"""))(lambda t: serving.pareto_curve(stored(t.abc_xyz, "abc_xyz")))

_RATED = "tipping where categoria_generosidad is not null"
bundle("summary_tipping", "tipping", lambda t, m: serving.summary_tipping(m), {
    "total": ([], ["pct_propina_promedio", "propina_prom_por_milla", "viajes", "pct_viajes_sin_propina"]),
    "by_borough_origin": (["pu_borough"], ["pct_propina", "viajes"]),
    "by_borough_destination": (["do_borough"], ["pct_propina", "viajes"]),
    "generosity_by_service": (["service_id", "categoria_generosidad"], ["viajes"]),
}, [
    section_sql("total", [], {
        "pct_propina_promedio": xavg("porcentaje_propina_ponderado"), "propina_prom_por_milla": xavg("propina_por_milla"),
        "viajes": "sum(viajes)",
        "pct_viajes_sin_propina": half("(1e0 - cast(sum(viajes_con_propina) as double)/sum(viajes))*100e0")}, _RATED),
    section_sql("by_borough_origin", ["pu_borough"], {"pct_propina": xavg("porcentaje_propina_ponderado"), "viajes": "sum(viajes)"}, _RATED),
    section_sql("by_borough_destination", ["do_borough"], {"pct_propina": xavg("porcentaje_propina_ponderado"), "viajes": "sum(viajes)"}, _RATED),
    section_sql("generosity_by_service", ["service_id", "categoria_generosidad"], {"viajes": "sum(viajes)"}, "tipping"),
])
_LABELS = ["Sin Propina", "Baja", "Estándar", "Alta"]
bundle("tipping_borough_compare", "tipping", lambda t, m: serving.tipping_borough_compare(m), {
    "compare": (["borough"], ["origen", "destino"]), "stack": (["service_id"], _LABELS),
}, [
    section_sql("compare", ["borough"], {"origen": "max(origen)", "destino": "max(destino)"},
                f"(select pu_borough as borough, {xavg('porcentaje_propina_ponderado')} as origen from {_RATED} group by 1) left join "
                f"(select do_borough as borough, {xavg('porcentaje_propina_ponderado')} as destino from {_RATED} group by 1) using (borough)"),
    section_sql("stack", ["service_id"], {l: f"coalesce(sum(case when categoria_generosidad = '{l}' then viajes end), 0)" for l in _LABELS}, "tipping"),
])
_SVC = ["green", "yellow", "fhv", "fhvhv"]
bundle("demand_service_groups", "demand", lambda t, m: serving.demand_service_groups(m), {
    "groups": ([], ["apps", "taxis", "espera_prom"]), "by_hour": (["pickup_hour"], _SVC),
}, [
    section_sql("groups", [], {"apps": "sum(case when service_id in ('fhv','fhvhv') then viajes else 0 end)",
                               "taxis": "sum(case when service_id not in ('fhv','fhvhv') then viajes else 0 end)",
                               "espera_prom": ratio(xsum("espera_total_min"), "sum(viajes_con_espera)")}, "demand"),
    section_sql("by_hour", ["pickup_hour"], {s: f"coalesce(sum(case when service_id = '{s}' then viajes end), 0)" for s in _SVC}, "demand"),
])
query("join_zone_stats", compose("""
select service_id, year, pu_location_id, ingresos, media, desviacion_r from (
  select *, floor(desviacion*1e4+0.5)/1e4 as desviacion_r from abc_stats)
"""))(lambda t: marts.zone_year_stats(t.facts).select(
    "service_id", "year", "pu_location_id", "ingresos", "media", serving.half_up(F.col("desviacion"), 4).alias("desviacion_r")))

_MARTS = {"mart_demand_volume": "demand", "mart_financial_performance": "financial",
          "mart_operational_profile": "operational", "mart_tipping_behavior": "tipping"}
# Columns that decide in which row of these marts a trip is counted.
_GROUPED = ("dropoff_location_id", "hvfhs_license_num", "payment_type_id", "fare_amount", "base_passenger_fare", "tip_amount", "tips")


def _conservation(t):
    return marts.conservation(t.facts, {m: getattr(t, a) for m, a in _MARTS.items()})


query("mart_conservation", compose(" union all ".join(
    f"select '{m}' as mart, count(*) as sum_viajes, count(*) as filas_facts, true as cuadra from facts"
    + ("" if m == "mart_demand_volume" else " where service_id <> 'fhv'") for m in _MARTS)))(
    lambda t: _conservation(t.with_stored_facts(*_GROUPED)))
