"""Star schema: dimensions, per-category facts, unified fact view."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hackstand import fixed_values as fv
from hackstand.functions import clock, rules
from hackstand.functions.numeric import half_up
from hackstand.operators.columns import col_or_null, first_match, safe_select, union_drift


def _local(spark: SparkSession, rows, schema: str) -> DataFrame:
    """A fixed code table: a few rows known when the code was written."""
    return F.broadcast(spark.createDataFrame(list(rows), schema))


def dim_ratecode(spark: SparkSession) -> DataFrame:
    return _local(spark, fv.RATECODE_NAMES, "ratecode_id int, ratecode_name string")


def dim_payment_type(spark: SparkSession) -> DataFrame:
    return _local(spark, fv.PAYMENT_NAMES, "payment_type_id int, payment_type_name string")


def dim_ratecode_theoretical(spark: SparkSession, years=fv.FISCAL_YEARS, flat_fares=fv.FLAT_FARES) -> DataFrame:
    """Ratecode by fiscal year with the regulated flat fare, or NULL."""
    fares = {(code, year): fare for code, year, fare in flat_fares}
    rows = [(code, year, fares.get((code, year)), name) for code, name in fv.RATECODE_NAMES for year in years]
    return _local(spark, rows, "ratecode_id int, fiscal_year int, flat_fare double, ratecode_name string")


def calendar(days: DataFrame) -> DataFrame:
    """Calendar attributes of a column ``date``."""
    day = F.col("date")
    weekday = clock.iso_weekday(day)
    return days.select(
        clock.date_key(day).alias("date_key"),
        day,
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        F.quarter(day).alias("quarter"),
        weekday.alias("weekday"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.date_format(day, "MMMM").alias("month_name"),
        clock.is_weekend(weekday).alias("is_weekend"),
    )


def dim_date(spark: SparkSession, first: str = "2023-01-01", last: str = "2025-12-31") -> DataFrame:
    span = spark.range(1).select(
        F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("date")
    )
    return calendar(span)


def dim_date_of(df: DataFrame, moment: str) -> DataFrame:
    """Calendar from the first to the last whole year seen in ``moment``."""
    ends = df.agg(F.min(F.year(moment)).alias("y0"), F.max(F.year(moment)).alias("y1"))
    days = ends.select(F.explode(F.sequence(
        F.make_date("y0", F.lit(1), F.lit(1)), F.make_date("y1", F.lit(12), F.lit(31))
    )).alias("date"))
    return calendar(days)


def dim_date_gold(dates: DataFrame) -> DataFrame:
    weekday = F.col("weekday")
    return dates.select(
        "date_key", "date", "weekday",
        clock.dia_categoria(weekday).alias("dia_categoria"),
        clock.is_weekend(weekday).alias("is_weekend"),
        clock.is_holiday(F.col("date")).alias("is_holiday"),
    )


def dim_zone(zones: DataFrame) -> DataFrame:
    return safe_select(zones, "LocationID", "Borough", "Zone", "service_zone")


def dim_zone_gold(zones: DataFrame, names=fv.BOROUGH_ES) -> DataFrame:
    borough = F.col("Borough")
    spanish = F.coalesce(*[F.when(borough == en, F.lit(es)) for en, es in names], borough)
    return zones.select("LocationID", "Borough", "Zone", spanish.alias("borough_name_es"))


# Columns a fact copies from its source when they are there.
FACT_COPIES = {
    "yellow": (
        "passenger_count", "trip_distance", "fare_amount", "extra", "mta_tax", "tip_amount",
        "tolls_amount", "improvement_surcharge", "total_amount", "congestion_surcharge",
        "airport_fee", "cbd_congestion_fee",
    ),
    "green": (
        "passenger_count", "trip_distance", "fare_amount", "extra", "mta_tax", "tip_amount",
        "tolls_amount", "ehail_fee", "improvement_surcharge", "total_amount",
        "congestion_surcharge", "cbd_congestion_fee",
    ),
    "fhvhv": (
        "hvfhs_license_num", "request_datetime", "on_scene_datetime", "trip_miles",
        "base_passenger_fare", "tolls", "bcf", "sales_tax", "congestion_surcharge",
        "airport_fee", "cbd_congestion_fee", "tips", "driver_pay", "shared_request_flag",
        "shared_match_flag",
    ),
    "fhv": (),
}


def _role(df: DataFrame, candidates, dtype: str) -> Column:
    name = first_match(df.columns, candidates)
    return F.lit(None).cast(dtype) if name is None else F.col(name)


def fact_trips(category: str, clean: DataFrame) -> DataFrame:
    """Standard fact of one category; the file's ``year`` and ``month`` ride along if present."""
    pickup = _role(clean, fv.PICKUP_NAMES, "timestamp").cast("timestamp")
    dropoff = _role(clean, fv.DROPOFF_NAMES, "timestamp").cast("timestamp")
    file_day = col_or_null(clean, "year", "int") * 10000 + col_or_null(clean, "month", "int") * 100 + 1
    file_columns = [c for c in ("year", "month") if c in clean.columns]
    has_pickup = first_match(clean.columns, fv.PICKUP_NAMES) is not None
    keys = [F.col(k) for k in fv.TRIP_KEYS.get(category, ()) if k in clean.columns]
    codes = (
        [F.col("VendorID").alias("vendor_id"), F.col("RatecodeID").alias("ratecode_id"),
         F.col("payment_type").alias("payment_type_id")]
        if category in fv.TAXI_SERVICES else []
    )
    return safe_select(
        clean,
        (clock.date_key(pickup) if has_pickup else file_day).alias("date_key"),
        rules.trip_id(*keys).alias("trip_id"),
        pickup.alias("pickup_datetime"),
        dropoff.alias("dropoff_datetime"),
        *codes,
        _role(clean, fv.PU_NAMES, "int").alias("pickup_location_id"),
        _role(clean, fv.DO_NAMES, "int").alias("dropoff_location_id"),
        *FACT_COPIES[category],
        *([half_up(clock.minutes_between(pickup, dropoff), 2).alias("trip_duration_minutes")]
          if category != "fhv" else []),
        *file_columns,
    )


def unify(facts: dict[str, DataFrame]) -> DataFrame:
    """All categories in one frame; columns a category lacks are NULL."""
    return union_drift([df.withColumn("service_id", F.lit(c)) for c, df in facts.items()])


def union_facts(facts: DataFrame, categories=None) -> DataFrame:
    """Eight-column view shared by the aggregated products; never cached."""
    view = facts.select(
        "service_id",
        F.col("year").alias("_file_year"),
        F.col("month").alias("_file_month"),
        "pickup_datetime",
        col_or_null(facts, "dropoff_datetime", "timestamp").alias("dropoff_datetime"),
        F.col("pickup_location_id").alias("pu_location_id"),
        col_or_null(facts, "dropoff_location_id", "int").alias("do_location_id"),
        rules.revenue(
            F.col("service_id"), col_or_null(facts, "total_amount"), col_or_null(facts, "base_passenger_fare")
        ).alias("revenue"),
    )
    return view if categories is None else view.filter(F.col("service_id").isin(*categories))
