"""Aggregated marts over the unified facts.

Each mart is one scan and one shuffle on its grain. Facts carry ``service_id`` and the
``year``/``month`` of their file; columns missing from a source become typed NULLs, so the
output schema never changes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hackstand import fixed_values as fv
from hackstand.functions import clock, rules
from hackstand.functions.numeric import (
    count_where, exact_avg, exact_sum, guarded_ratio, half_up,
)
from hackstand.operators.columns import col_or_null
from hackstand.operators.star import union_facts
from hackstand.operators.zones import with_zone
from hackstand.session import materialise
from hackstand.settings import DEFAULTS, AbcXyzSettings, BalanceSettings, GenerositySettings

PU, DO = "pickup_location_id", "dropoff_location_id"
FILE_KEYS = ["service_id", "year", "month"]


def _priced(facts: DataFrame) -> DataFrame:
    """The services that publish fares and distances."""
    return facts.filter(F.col("service_id").isin(*fv.PRICED_SERVICES))


def _taxi_else_app(facts: DataFrame, taxi: str, app: str) -> Column:
    return F.when(rules.is_taxi(F.col("service_id")), col_or_null(facts, taxi)).otherwise(col_or_null(facts, app))


def demand_volume(facts: DataFrame, zones: DataFrame) -> DataFrame:
    """Trips and waits per date, hour, pickup zone and licence."""
    seconds = [F.unix_timestamp(col_or_null(facts, c, "timestamp")) for c in ("on_scene_datetime", "request_datetime")]
    trips = facts.select(
        *FILE_KEYS,
        F.to_date("pickup_datetime").alias("fecha_viaje"),
        F.hour("pickup_datetime").alias("pickup_hour"),
        F.col(PU).alias("pu_location_id"),
        col_or_null(facts, "hvfhs_license_num", "string").alias("hvfhs_license_num"),
        (seconds[0] - seconds[1]).alias("_wait"),
    )
    grain = [*FILE_KEYS, "fecha_viaje", "pickup_hour", "pu_location_id", "hvfhs_license_num"]
    minutes = F.sum("_wait").cast("double") / F.lit(60.0)  # whole seconds add up exactly; rounding follows once
    volume = trips.groupBy(*grain).agg(
        F.count(F.lit(1)).alias("viajes"),
        half_up(minutes, 2).alias("espera_total_min"),
        F.count("_wait").alias("viajes_con_espera"),
        half_up(guarded_ratio(minutes, F.count("_wait")), 2).alias("espera_promedio_min"),
    )
    # each group has one hour, date and zone, so their names are looked up once per group
    weekday = clock.iso_weekday(F.col("fecha_viaje"))
    return with_zone(volume, zones, "pu_location_id", "pu_").select(
        "service_id", "fecha_viaje", "pickup_hour",
        clock.bloque_horario(F.col("pickup_hour")).alias("bloque_horario"),
        weekday.alias("dia_semana"),
        clock.is_weekend(weekday).alias("is_weekend"),
        "pu_location_id", "pu_borough", "pu_zone", "hvfhs_license_num",
        "viajes", "espera_total_min", "viajes_con_espera", "espera_promedio_min", "year", "month",
    )


def _day_block(facts: DataFrame) -> list[Column]:
    return [
        *[F.col(k) for k in FILE_KEYS],
        F.to_date("pickup_datetime").alias("fecha_viaje"),
        clock.bloque_horario(F.hour("pickup_datetime")).alias("bloque_horario"),
        F.col(PU).alias("pu_location_id"),
    ]


_DAY_BLOCK = [*FILE_KEYS, "fecha_viaje", "bloque_horario", "pu_location_id"]


def financial_performance(facts: DataFrame, zones: DataFrame) -> DataFrame:
    """Summed fare components and ratios of the rounded sums."""
    facts = _priced(facts)
    trips = facts.select(*_day_block(facts), *[col_or_null(facts, c).alias(c) for c in fv.FINANCIAL_SUMS])
    sums = trips.groupBy(*_DAY_BLOCK).agg(
        F.count(F.lit(1)).alias("viajes"),
        *[half_up(exact_sum(F.col(c)), 2).alias(c) for c in fv.FINANCIAL_SUMS],
    )
    taxi = rules.is_taxi(F.col("service_id"))
    per_mile = F.when(taxi, guarded_ratio(F.col("total_amount"), F.col("trip_distance"))).otherwise(
        guarded_ratio(F.col("base_passenger_fare"), F.col("trip_miles"))
    )
    margin = F.col("base_passenger_fare") - F.col("driver_pay")
    share = guarded_ratio(F.col("driver_pay"), F.col("base_passenger_fare"))
    return with_zone(sums, zones, "pu_location_id", "pu_").select(
        "service_id", "fecha_viaje", "bloque_horario", "pu_location_id", "pu_borough", "pu_zone", "viajes",
        *fv.FINANCIAL_SUMS,
        half_up(per_mile, 4).alias("ingreso_bruto_por_milla"),
        F.when(~taxi, half_up(margin, 2)).alias("margen_plataforma"),
        F.when(~taxi, half_up(share, 4)).alias("ratio_pago_conductor"),
        "year", "month",
    )


def operational_profile(facts: DataFrame, zones: DataFrame) -> DataFrame:
    """Duration, distance, distance-weighted speed and shared-ride counts."""
    facts = _priced(facts)
    minutes = col_or_null(facts, "trip_duration_minutes")
    miles = _taxi_else_app(facts, "trip_distance", "trip_miles")
    usable = (minutes > 0) & (miles > 0)
    trips = facts.select(
        *_day_block(facts),
        minutes.alias("_min"),
        miles.alias("_mi"),
        F.when(usable, miles).alias("_ok_mi"),
        F.when(usable, minutes).alias("_ok_min"),
        (col_or_null(facts, "shared_request_flag", "string") == "Y").cast("int").alias("_asked"),
        (col_or_null(facts, "shared_match_flag", "string") == "Y").cast("int").alias("_matched"),
    )
    sums = trips.groupBy(*_DAY_BLOCK).agg(
        F.count(F.lit(1)).alias("viajes"),
        half_up(exact_sum(F.col("_min")), 2).alias("duracion_total_min"),
        half_up(exact_avg(F.col("_min")), 2).alias("duracion_promedio_min"),
        half_up(exact_sum(F.col("_mi")), 2).alias("distancia_total_millas"),
        half_up(exact_avg(F.col("_mi")), 4).alias("distancia_promedio_millas"),
        exact_sum(F.col("_ok_mi")).alias("_ok_mi"),
        exact_sum(F.col("_ok_min")).alias("_ok_min"),
        F.sum("_asked").alias("viajes_solicitud_compartida"),
        F.sum("_matched").alias("viajes_match_compartido"),
    )
    mph = guarded_ratio(F.col("_ok_mi"), F.col("_ok_min") / F.lit(60.0))
    matched = F.col("viajes_match_compartido") / F.col("viajes")
    return with_zone(sums, zones, "pu_location_id", "pu_").select(
        "service_id", "fecha_viaje", "bloque_horario", "pu_location_id", "pu_borough", "pu_zone", "viajes",
        "duracion_total_min", "duracion_promedio_min", "distancia_total_millas", "distancia_promedio_millas",
        half_up(mph, 2).alias("velocidad_promedio_mph"),
        "viajes_solicitud_compartida", "viajes_match_compartido",
        F.when(F.col("service_id") == "fhvhv", half_up(matched, 4)).alias("tasa_ocupacion_compartida"),
        "year", "month",
    )


def _balance_rows(flows: DataFrame, zones: DataFrame, settings: BalanceSettings) -> DataFrame:
    step = settings.block_minutes * 60
    net = F.col("entrantes") - F.col("salientes")
    start = clock.from_block(F.col("t_unix"))
    named = with_zone(flows, zones, "location_id", "", ("borough", "zone"))
    return named.select(
        "location_id", "borough", "zone",
        start.alias("bloque_temporal_t"),
        clock.from_block(F.col("t_unix") + step).alias("bloque_temporal_t_plus_1"),
        F.col("entrantes").alias("taxis_entrantes_zona_t"),
        F.col("salientes").alias("taxis_salientes_zona_t_plus_1"),
        net.alias("flujo_neto_oferta"),
        (net < settings.deficit_threshold).alias("deficit_severo_flag"),
        F.year(start).alias("year"),
        F.month(start).alias("month"),
    )


def supply_demand_balance(
    facts: DataFrame, zones: DataFrame, settings: BalanceSettings = DEFAULTS.balance
) -> DataFrame:
    """Arrivals in block t against departures in block t+1, per zone.

    A trip yields two rows, its departure filed one block early, so that one scan and one
    aggregation replace two aggregations and an outer join.
    """
    step = settings.block_minutes * 60
    ends = F.array(
        F.struct(
            F.col("do_location_id").alias("location_id"),
            clock.block_start(F.col("dropoff_datetime"), step).alias("t_unix"),
            F.lit(1).alias("arrived"), F.lit(0).alias("left"),
        ),
        F.struct(
            F.col("pu_location_id").alias("location_id"),
            (clock.block_start(F.col("pickup_datetime"), step) - step).alias("t_unix"),
            F.lit(0).alias("arrived"), F.lit(1).alias("left"),
        ),
    )
    flows = (
        union_facts(facts)
        .select(F.inline(ends))
        .filter(F.col("location_id").isNotNull() & F.col("t_unix").isNotNull())
        .groupBy("location_id", "t_unix")
        .agg(F.sum("arrived").alias("entrantes"), F.sum("left").alias("salientes"))
    )
    return _balance_rows(flows, zones, settings)


def supply_demand_join(
    facts: DataFrame, zones: DataFrame, settings: BalanceSettings = DEFAULTS.balance
) -> DataFrame:
    """The same mart written as a shifted full outer join, for two separate flow tables.

    Where and in which block each trip starts and ends is written once; both flows are counted from there.
    """
    step = settings.block_minutes * 60
    ends = materialise(union_facts(facts).select(
        F.col("do_location_id").alias("_to"), clock.block_start(F.col("dropoff_datetime"), step).alias("_end"),
        F.col("pu_location_id").alias("_from"), (clock.block_start(F.col("pickup_datetime"), step) - step).alias("_before")), "ends")
    inbound, outbound = (
        ends.filter(F.col(place).isNotNull() & F.col(block).isNotNull())
        .groupBy(F.col(place).alias("location_id"), F.col(block).alias("t_unix")).agg(F.count(F.lit(1)).alias(flow))
        for place, block, flow in (("_to", "_end", "entrantes"), ("_from", "_before", "salientes")))
    flows = inbound.join(outbound, ["location_id", "t_unix"], "full_outer").fillna(0, ["entrantes", "salientes"])
    return _balance_rows(flows, zones, settings)


def zone_year_stats(facts: DataFrame) -> DataFrame:
    """Revenue and daily trip statistics per zone, service and year, from one daily rollup."""
    view = union_facts(_priced(facts)).filter(F.col("pu_location_id").isNotNull())
    daily = view.groupBy(
        "service_id", F.col("_file_year").alias("year"), "pu_location_id",
        F.to_date("pickup_datetime").alias("day"),
    ).agg(F.count(F.lit(1)).alias("trips"), exact_sum(F.col("revenue")).alias("revenue"))
    counted = F.when(F.col("day").isNotNull(), F.col("trips"))
    return daily.groupBy("service_id", "year", "pu_location_id").agg(
        exact_sum(F.col("revenue")).alias("ingresos"),
        F.avg(counted).alias("media"),
        F.stddev_samp(counted).alias("desviacion"),
    )


def abc_xyz_zones(facts: DataFrame, zones: DataFrame, settings: AbcXyzSettings = DEFAULTS.abc_xyz) -> DataFrame:
    """Pareto class by revenue and variability class by daily trips.

    The window orders the zones of one service and year: at most one row per zone.
    """
    stats = zone_year_stats(facts).withColumn("_cv", guarded_ratio(F.col("desviacion"), F.col("media")))
    group = Window.partitionBy("service_id", "year")
    ranked = group.orderBy(F.col("ingresos").desc_nulls_last(), "pu_location_id").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    money = F.col("ingresos")
    share = half_up(guarded_ratio(_running(money, ranked), _running(money, group)), 4)
    classed = stats.withColumn("porcentaje_acumulado_ingresos", share)
    cumulative, cv = F.col("porcentaje_acumulado_ingresos"), F.col("_cv")
    return with_zone(classed, zones, "pu_location_id", "", ("borough", "zone")).select(
        "pu_location_id", "borough", "zone", "service_id", "year",
        half_up(money, 2).alias("ingresos_totales_zona"),
        half_up(F.col("media"), 2).alias("viajes_diarios_promedio"),
        half_up(F.col("desviacion"), 2).alias("viajes_diarios_std"),
        half_up(cv, 4).alias("coeficiente_variacion_xyz"),
        F.when(cv < settings.x_max, "X").when(cv <= settings.y_max, "Y").when(cv.isNotNull(), "Z").alias("clase_xyz"),
        cumulative,
        F.when(cumulative <= settings.a_share, "A").when(cumulative <= settings.ab_share, "B")
        .when(cumulative.isNotNull(), "C").alias("clase_abc"),
    )


def _running(money: Column, window) -> Column:
    """Windowed exact sum of a 4-decimal amount."""
    units = F.floor(money * F.lit(1e4) + F.lit(0.5)).cast("long")
    return F.sum(units).over(window).cast("double") / F.lit(1e4)


def tipping_behavior(
    facts: DataFrame, zones: DataFrame, settings: GenerositySettings = DEFAULTS.generosity
) -> DataFrame:
    """Tips per date, boroughs, payment and generosity class.

    Rows are keyed by names, so names come first; a few dozen pairs of names keep the groups small.
    """
    facts = _priced(facts)
    payment = col_or_null(facts, "payment_type_id", "int")
    fare = _taxi_else_app(facts, "fare_amount", "base_passenger_fare")
    tip = _taxi_else_app(facts, "tip_amount", "tips")
    usable = rules.tip_is_recorded(F.col("service_id"), payment, fare)
    pct = F.when(usable, tip / fare * F.lit(100.0))
    trips = facts.select(
        *FILE_KEYS,
        F.to_date("pickup_datetime").alias("fecha_viaje"),
        PU, DO,
        payment.alias("payment_type_id"),
        (payment == 1).alias("is_credit_card"),
        rules.categoria_generosidad(half_up(pct, 2), settings).alias("categoria_generosidad"),
        tip.alias("_tip"), pct.alias("_pct"),
        F.when(usable, fare).alias("_base_fare"),
        F.when(usable, tip).alias("_base_tip"),
        _taxi_else_app(facts, "trip_distance", "trip_miles").alias("_mi"),
    )
    placed = with_zone(with_zone(trips, zones, PU, "pu_"), zones, DO, "do_")
    grain = [*FILE_KEYS, "fecha_viaje", "pu_borough", "do_borough", "payment_type_id",
             "is_credit_card", "categoria_generosidad"]
    sums = placed.groupBy(*grain).agg(
        F.count(F.lit(1)).alias("viajes"),
        count_where(F.col("_tip") > 0).alias("viajes_con_propina"),
        half_up(exact_sum(F.col("_tip")), 2).alias("propina_total"),
        half_up(exact_avg(F.col("_pct")), 2).alias("porcentaje_propina_promedio"),
        exact_sum(F.col("_base_fare")).alias("_base_fare"),
        exact_sum(F.col("_base_tip")).alias("_base_tip"),
        exact_sum(F.col("_mi")).alias("_mi"),
    )
    weighted = guarded_ratio(F.col("_base_tip"), F.col("_base_fare")) * F.lit(100.0)
    return sums.select(
        "service_id", "fecha_viaje", "pu_borough", "do_borough", "payment_type_id", "is_credit_card",
        "categoria_generosidad", "viajes", "viajes_con_propina", "propina_total",
        "porcentaje_propina_promedio",
        half_up(weighted, 2).alias("porcentaje_propina_ponderado"),
        half_up(guarded_ratio(F.col("propina_total"), F.col("_mi")), 4).alias("propina_por_milla"),
        "year", "month",
    )


def hourly_trips(facts: DataFrame, zones: DataFrame) -> DataFrame:
    """Hourly trip counts per borough and service; unmatched zones count as Unknown.

    Counts per zone first, so the borough join sees the rollup and not the trips.
    """
    by_zone = (
        union_facts(facts)
        .filter(F.col("pickup_datetime").isNotNull())
        .groupBy("service_id", "pu_location_id", F.date_trunc("hour", "pickup_datetime").alias("pickup_hour"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    named = with_zone(by_zone, zones, "pu_location_id", "", ("borough", "zone"))
    return (
        named.groupBy(F.coalesce("borough", F.lit("Unknown")).alias("borough"), "service_id", "pickup_hour")
        .agg(F.sum("n").alias("trip_count"))
        .select("borough", "service_id", "pickup_hour", "trip_count",
                F.year("pickup_hour").alias("year"), F.month("pickup_hour").alias("month"))
    )


def conservation(facts: DataFrame, marts: dict[str, DataFrame]) -> DataFrame:
    """Per mart: trips counted against the fact rows it should cover."""
    rows = facts.groupBy("service_id").agg(F.count(F.lit(1)).alias("n"))
    fact_totals = rows.agg(
        F.sum("n").alias("all_rows"),
        F.sum(F.when(F.col("service_id") != "fhv", F.col("n"))).alias("priced_rows"),
    )
    out = None
    for name, mart in marts.items():
        counted = mart.agg(F.sum("viajes").alias("sum_viajes")).withColumn("mart", F.lit(name))
        out = counted if out is None else out.unionByName(counted)
    expected = fact_totals.select(F.explode(F.create_map(
        F.lit("all"), F.col("all_rows"), F.lit("priced"), F.col("priced_rows")
    )).alias("kind", "filas_facts"))
    kind = F.when(F.col("mart") == "mart_demand_volume", "all").otherwise("priced")
    return (
        out.withColumn("kind", kind).join(expected, "kind")
        .select("mart", "sum_viajes", "filas_facts", (F.col("sum_viajes") == F.col("filas_facts")).alias("cuadra"))
    )
