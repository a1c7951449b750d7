"""Live accumulators over accepted rides, with the keys and columns of the marts.

Each function is a plain grouping. On a stream the event-time window in the key lets the
watermark drop state older than the time to live.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hackstand.functions import clock, rules
from hackstand.functions.numeric import count_where, exact_sum, guarded_ratio, half_up
from hackstand.operators.selection import filter_dynamic, page
from hackstand.operators.zones import with_zone
from hackstand.settings import DEFAULTS, Settings

KEYS = {
    "demand": ["service_id", "fecha_viaje", "pickup_hour", "pu_location_id"],
    "financial": ["service_id", "fecha_viaje", "bloque_horario", "pu_location_id"],
    "operational": ["service_id", "fecha_viaje", "bloque_horario", "pu_location_id"],
    "balance": ["location_id", "bloque_temporal_t"],
    "tipping": ["service_id", "fecha_viaje", "pu_borough", "do_borough", "payment_type_id", "categoria_generosidad"],
}


def _watermarked(rides: DataFrame, settings: Settings, column: str = "pickup_datetime") -> DataFrame:
    return rides.withWatermark(column, f"{settings.speed.state_hours} hours") if rides.isStreaming else rides


def _grouped(rides: DataFrame, keys, width: str, settings: Settings, column: str = "pickup_datetime"):
    return _watermarked(rides, settings, column).groupBy(F.window(column, width).alias("_window"), *keys)


def _taxi(c: str) -> Column:
    return exact_sum(F.when(rules.is_taxi(F.col("service_id")), F.col(c))).alias(c)


def _app(c: str, alias: str) -> Column:
    return exact_sum(F.when(F.col("service_id") == "fhvhv", F.col(c))).alias(alias)


def demand(rides: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    return _grouped(rides, KEYS["demand"], "1 hour", settings).agg(F.count(F.lit(1)).alias("viajes")).drop("_window")


def financial(rides: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    taxi = [_taxi(c) for c in ("fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "total_amount")]
    app = [_app("base_passenger_fare", "base_passenger_fare"), _app("tolls_amount", "tolls"), _app("tips", "tips"),
           _app("driver_pay", "driver_pay")]
    return _grouped(rides, KEYS["financial"], "1 day", settings).agg(
        F.count(F.lit(1)).alias("viajes"), *taxi, *app).drop("_window")


def operational(rides: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    miles = F.when(rules.is_taxi(F.col("service_id")), F.col("trip_distance")).otherwise(F.col("trip_miles"))
    length = F.col("trip_duration_minutes")
    seconds = F.round(length * 60.0).cast("long")  # whole seconds add up exactly; rounded minutes do not
    usable = (length > 0) & (miles > 0)
    return _grouped(rides, KEYS["operational"], "1 day", settings).agg(
        F.count(F.lit(1)).alias("viajes"),
        (F.sum(seconds) / 60.0).alias("duracion_total_min"),
        exact_sum(miles).alias("distancia_total_millas"),
        exact_sum(F.when(usable, miles)).alias("millas_validas_sum"),
        half_up(F.sum(F.when(usable, seconds)) / 3600.0, 4).alias("horas_validas_sum"),
        count_where(F.col("shared_request_flag") == "Y").alias("solicitud_compartida"),
        count_where(F.col("shared_match_flag") == "Y").alias("match_compartido"),
    ).drop("_window")


def balance(rides: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Arrivals in block t and departures of block t+1 per zone, as in the batch mart."""
    step = settings.speed.block_minutes * 60
    ends = F.array(
        F.struct(F.col("do_location_id").alias("location_id"),
                 clock.block_start(F.col("dropoff_datetime"), step).alias("t"), F.lit(1).alias("came"), F.lit(0).alias("went")),
        F.struct(F.col("pu_location_id").alias("location_id"),
                 (clock.block_start(F.col("pickup_datetime"), step) - step).alias("t"), F.lit(0).alias("came"), F.lit(1).alias("went")),
    )
    moves = rides.select(F.inline(ends)).filter(F.col("location_id").isNotNull() & F.col("t").isNotNull())
    keyed = _watermarked(
        moves.withColumn("bloque_temporal_t", clock.from_block(F.col("t"))), settings, "bloque_temporal_t")
    net = F.sum("came") - F.sum("went")
    return keyed.groupBy("location_id", "bloque_temporal_t").agg(
        F.sum("came").alias("entrantes"), F.sum("went").alias("salientes"), net.alias("flujo_neto_oferta"),
        (net < settings.balance.deficit_threshold).alias("deficit_severo_flag"))


def tipping(rides: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    app = F.col("service_id") == "fhvhv"
    fare = F.when(app, F.col("base_passenger_fare")).otherwise(F.col("fare_amount"))
    tip = F.when(app, F.col("tips")).otherwise(F.col("tip_amount"))
    usable = rules.tip_is_recorded(F.col("service_id"), F.col("payment_type_id"), fare)
    rows = rides.withColumns({
        "payment_type_id": F.when(~app, F.col("payment_type_id")), "_tip": tip,
        "_fare": F.when(usable, fare), "_base_tip": F.when(usable, tip),
        "_mi": F.when(app, F.col("trip_miles")).otherwise(F.col("trip_distance")),
    }).filter(F.col("service_id") != "fhv")
    return _grouped(rows, KEYS["tipping"], "1 day", settings).agg(
        F.count(F.lit(1)).alias("viajes"), exact_sum(F.col("_tip")).alias("propina_total"),
        exact_sum(F.col("_fare")).alias("tarifa_base_sum"), exact_sum(F.col("_base_tip")).alias("propina_base_sum"),
        exact_sum(F.col("_mi")).alias("millas_sum")).drop("_window")


VIEWS = {"demand": demand, "financial": financial, "operational": operational, "balance": balance, "tipping": tipping}


def mart_rows(view: str, live: DataFrame, zones: DataFrame | None = None, miles: DataFrame | None = None) -> DataFrame:
    """Accumulator rows with the derived columns of their mart.

    ``zones`` names the zones of demand and balance. ``miles`` are the operational rows, which share the financial key and hold the
    distances that the financial accumulator does not.
    """
    app = F.col("service_id") == "fhvhv"
    if view == "demand":
        weekday = clock.iso_weekday(F.col("fecha_viaje"))
        return _named(live, zones, "pu_location_id", "pu_").withColumns({
            "bloque_horario": clock.bloque_horario(F.col("pickup_hour")), "dia_semana": weekday, "is_weekend": clock.is_weekend(weekday)})
    if view == "operational":
        return live.withColumns({
            "duracion_promedio_min": half_up(guarded_ratio(F.col("duracion_total_min"), F.col("viajes")), 2),
            "velocidad_promedio_mph": half_up(guarded_ratio(F.col("millas_validas_sum"), F.col("horas_validas_sum")), 2),
            "distancia_promedio_millas": half_up(guarded_ratio(F.col("distancia_total_millas"), F.col("viajes")), 4),
            "tasa_ocupacion_compartida": F.when(app, half_up(guarded_ratio(F.col("match_compartido"), F.col("viajes")), 4))})
    if view == "tipping":
        return live.withColumns({
            "porcentaje_propina_ponderado": half_up(
                guarded_ratio(F.col("propina_base_sum"), F.col("tarifa_base_sum")) * 100.0, 2),
            "propina_por_milla": half_up(guarded_ratio(F.col("propina_total"), F.col("millas_sum")), 4)})
    if view == "financial":
        rows = live.withColumns({
            "margen_plataforma": half_up(F.col("base_passenger_fare") - F.col("driver_pay"), 2),
            "ratio_pago_conductor": half_up(guarded_ratio(F.col("driver_pay"), F.col("base_passenger_fare")), 4)})
        if miles is None:
            return rows
        keys = KEYS["financial"]
        known = miles.select(*[F.col(k).alias(f"_m_{k}") for k in keys], F.col("distancia_total_millas").alias("_miles"))
        income = F.when(app, F.col("base_passenger_fare")).otherwise(F.col("total_amount"))
        return rows.join(known, [F.col(k).eqNullSafe(F.col(f"_m_{k}")) for k in keys], "left").withColumn(
            "ingreso_bruto_por_milla", half_up(guarded_ratio(income, F.col("_miles")), 4)).drop("_miles", *[f"_m_{k}" for k in keys])
    if view == "balance":
        step = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(DEFAULTS.speed.block_minutes))
        return _named(live, zones, "location_id", "").withColumn("bloque_temporal_t_plus_1", F.col("bloque_temporal_t") + step)
    return live


def _named(live: DataFrame, zones: DataFrame | None, location: str, prefix: str) -> DataFrame:
    return live if zones is None else with_zone(live, zones, location, prefix)


def within_ttl(live: DataFrame, moment: str, settings: Settings = DEFAULTS) -> DataFrame:
    """Accumulators younger than the time to live, counted back from the newest event."""
    newest = live.agg(F.max(F.col(moment).cast("timestamp"))).scalar()
    return live.filter(F.col(moment).cast("timestamp") >= newest - F.make_dt_interval(
        F.lit(0), F.lit(settings.speed.state_hours)))


def merge(batch: DataFrame, live: DataFrame, keys) -> DataFrame:
    """Batch rows, plus live rows whose key the batch does not have; keys compare null-safe.

    Keys are cast to the batch types, so a text date still meets a date.
    """
    types = dict(batch.dtypes)
    live = live.withColumns({k: F.col(k).cast(types[k]) for k in keys})
    known = batch.select(*[F.col(k).alias(f"_b_{k}") for k in keys]).distinct()
    fresh = live.join(known, [F.col(k).eqNullSafe(F.col(f"_b_{k}")) for k in keys], "left_anti")
    return batch.withColumn("origen", F.lit("batch")).unionByName(
        fresh.withColumn("origen", F.lit("realtime")), allowMissingColumns=True)


def merged_view(batch: DataFrame, live: DataFrame, keys, time_column: str | None, filters=None, limit: int = 1000) -> DataFrame:
    merged = filter_dynamic(merge(batch, live, keys), filters or {})
    order = ([(time_column, "desc")] if time_column else []) + [(k, "asc") for k in keys if k != time_column]
    return page(merged, order, limit)


def demand_for_merge(mart: DataFrame) -> DataFrame:
    """The demand mart on the live key: licences summed, so that no row overwrites another."""
    return mart.groupBy(*KEYS["demand"]).agg(F.sum("viajes").alias("viajes"))


def abc_xyz(demand_rows: DataFrame, financial_rows: DataFrame) -> DataFrame:
    """Live trips and revenue per zone and service from two accumulator tables."""
    keys = ["pu_location_id", "service_id"]
    trips = demand_rows.groupBy(*keys).agg(F.sum("viajes").alias("viajes_realtime"))
    income = F.coalesce(F.col("total_amount"), F.lit(0.0)) + F.coalesce(F.col("base_passenger_fare"), F.lit(0.0))
    money = financial_rows.groupBy(*keys).agg(half_up(exact_sum(income), 2).alias("ingresos_realtime"))
    return trips.join(money, keys, "left").fillna(0.0, ["ingresos_realtime"])


def read_scored(rows: DataFrame, moment: str | None, limit: int = 100, offset: int = 0, **filters) -> DataFrame:
    """Filtered page of a scored sink table, newest first."""
    order = ([(moment, "desc")] if moment else []) + [("trip_id", "asc")]
    return page(filter_dynamic(rows, filters), order, limit, offset)
