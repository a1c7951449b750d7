"""Stateless model scoring of rides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hackstand import fixed_values as fv
from hackstand.functions import rules
from hackstand.plans import forest, kmodes
from hackstand.settings import DEFAULTS, Settings


def fraud_inputs(rides: DataFrame, flat_fares=fv.FLAT_FARES) -> DataFrame:
    """Fraud features of rides that carry a distance and a fare."""
    fare, distance = F.col("fare_amount"), F.col("trip_distance")
    seconds = F.when(
        F.col("dropoff_datetime") > F.col("pickup_datetime"),
        F.unix_timestamp("dropoff_datetime") - F.unix_timestamp("pickup_datetime"))
    year = F.year("pickup_datetime")
    flat = F.coalesce(*[F.when((F.col("ratecode_id") == c) & (year == y), F.lit(v)) for c, y, v in flat_fares])
    mph, cost = rules.speed_mph(distance, seconds), rules.cost_per_mile(fare, distance)
    return rides.filter(distance.isNotNull() & fare.isNotNull()).withColumns({
        "duracion_viaje_segundos": seconds,
        "velocidad_promedio_calculada": mph,
        "costo_por_distancia": cost,
        "ratio_peaje_tarifa": rules.toll_ratio(F.col("tolls_amount"), fare),
        "is_anomaly_candidate": F.coalesce(
            rules.is_anomaly_candidate(F.col("ratecode_id"), fare, flat, mph, cost), F.lit(False)),
    })


def score_fraud(rides: DataFrame, model: forest.Model, settings: Settings = DEFAULTS) -> DataFrame:
    """Anomaly score of each ride with the stored medians; flagged above the live threshold.

    A ride whose ratecode has no model stays, with a NULL score, not flagged, and its own candidate mark.
    """
    inputs = fraud_inputs(rides).select(
        "trip_id", "service_id", "ratecode_id", "pickup_datetime", "is_anomaly_candidate", *forest.FEATURES)
    scored = model.score(inputs)
    score = F.col("isolation") - F.col("offset")
    return scored.join(model.cuts.select("ratecode_id", "offset"), "ratecode_id", "left").select(
        "trip_id", "service_id", "ratecode_id", score.alias("anomaly_score"),
        F.coalesce(score > settings.speed.fraud_threshold, F.lit(False)).alias("is_fraud"), "is_anomaly_candidate",
        F.col("pickup_datetime").alias("timestamp"))


def cluster_inputs(rides: DataFrame) -> DataFrame:
    """Cluster features under the names and labels used in training (names, not codes)."""

    def name(column: str, table) -> Column:
        return F.coalesce(*[F.when(F.col(column) == code, F.lit(label)) for code, label in table])

    app = F.col("service_id") == "fhvhv"
    return rides.select(
        "trip_id", "service_id", F.year("pickup_datetime").alias("year"), F.month("pickup_datetime").alias("month"),
        F.col("pu_borough").alias("borough_pu"), F.col("do_borough").alias("borough_do"), "franja_horaria", "dia_categoria",
        F.when(app, F.col("hvfhs_license_num")).alias("hvfhs_license_num"),
        F.when(~app, name("payment_type_id", fv.PAYMENT_NAMES)).alias("payment_type"),
        F.when(~app, name("ratecode_id", fv.RATECODE_NAMES)).alias("ratecode"),
        F.when(~app, F.col("passenger_group")).alias("passenger_group"))


def score_clusters(rides: DataFrame, modes: dict[str, tuple]) -> DataFrame:
    """Nearest mode per ride and service; rides with a missing feature get no cluster."""
    label = F.coalesce(*[
        F.when(
            (F.col("service_id") == service) & F.concat(*kmodes.features_of(service)).isNotNull(),
            kmodes.nearest(kmodes.features_of(service), service_modes))
        for service, service_modes in modes.items()
    ])
    return cluster_inputs(rides).select("trip_id", label.alias(kmodes.LABEL), "service_id").filter(
        F.col(kmodes.LABEL).isNotNull())
