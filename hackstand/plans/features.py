"""Trip-grain feature stores for the models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hackstand import fixed_values as fv
from hackstand.functions import clock, rules
from hackstand.operators.columns import col_or_null
from hackstand.operators.zones import with_flat_fare, with_lookup, with_zone


def fraud_features(facts: DataFrame, tariffs: DataFrame) -> DataFrame:
    """Fare features of taxi trips and the heuristic candidate flag."""
    taxis = with_flat_fare(facts.filter(F.col("service_id").isin(*fv.TAXI_SERVICES)), tariffs)
    fare, distance = F.col("fare_amount"), F.col("trip_distance")
    seconds = F.unix_timestamp("dropoff_datetime") - F.unix_timestamp("pickup_datetime")
    mph = rules.speed_mph(distance, seconds)
    cost = rules.cost_per_mile(fare, distance)
    ratecode = F.col("ratecode_id").cast("int")
    return taxis.select(
        "trip_id", "service_id", ratecode.alias("ratecode_id"),
        seconds.alias("duracion_viaje_segundos"),
        "trip_distance", "fare_amount",
        col_or_null(taxis, "extra").alias("extra"),
        col_or_null(taxis, "mta_tax").alias("mta_tax"),
        mph.alias("velocidad_promedio_calculada"),
        cost.alias("costo_por_distancia"),
        rules.toll_ratio(F.col("tolls_amount"), fare).alias("ratio_peaje_tarifa"),
        rules.is_anomaly_candidate(ratecode, fare, F.col("flat_fare"), mph, cost).alias("is_anomaly_candidate"),
        "year", "month",
    )


def cluster_features(
    facts: DataFrame, zones: DataFrame, payments: DataFrame, ratecodes: DataFrame,
    app_fraction: float = 1.0, seed: int = 42,
) -> DataFrame:
    """Categorical features per trip; app trips may be thinned to size the training input.

    The sample is a threshold on a hash of the trip id: unlike ``sample`` it picks the same
    trips whatever the partitioning, also when a lost task runs again.
    """
    trips = facts.filter(F.col("service_id").isin(*fv.PRICED_SERVICES))
    app = F.col("service_id") == "fhvhv"
    if app_fraction < 1.0:
        drawn = F.pmod(F.xxhash64(F.lit(seed), F.col("trip_id")), F.lit(1_000_000)) < int(app_fraction * 1_000_000)
        trips = trips.filter(~app | drawn)
    weekday = clock.iso_weekday(F.col("pickup_datetime"))
    trips = trips.select(
        "trip_id", "service_id", "year", "month", "pickup_location_id", "dropoff_location_id",
        clock.franja_horaria(F.hour("pickup_datetime")).alias("franja_horaria"),
        clock.dia_categoria(weekday).alias("dia_categoria"),
        F.when(app, F.col("hvfhs_license_num")).alias("hvfhs_license_num"),
        F.when(~app, F.col("payment_type_id")).alias("_pay"),
        F.when(~app, F.col("ratecode_id")).alias("_rate"),
        F.when(~app, rules.passenger_group(F.col("passenger_count"))).alias("passenger_group"),
    )
    placed = with_zone(with_zone(trips, zones, "pickup_location_id", "pu_"), zones, "dropoff_location_id", "do_")
    named = with_lookup(placed, payments, "_pay", "payment_type_id", "payment_type_name", "payment_type")
    named = with_lookup(named, ratecodes, "_rate", "ratecode_id", "ratecode_name", "ratecode")
    return named.select(
        "trip_id", "service_id",
        F.col("pu_borough").alias("borough_pu"), F.col("do_borough").alias("borough_do"),
        "franja_horaria", "dia_categoria", "hvfhs_license_num", "payment_type", "ratecode",
        "passenger_group", "year", "month",
    )
