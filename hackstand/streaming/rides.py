"""Single ride events: parse, judge, enrich. Every function runs on a batch or on a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hackstand import fixed_values as fv
from hackstand.functions import clock, rules
from hackstand.functions.numeric import half_up
from hackstand.operators.selection import top_n_per_group
from hackstand.operators.zones import with_zone
from hackstand.settings import DEFAULTS, Settings

# Fields of a ride event.
EVENT_SCHEMA = (
    "service_id string, pickup_datetime timestamp, request_datetime timestamp, dropoff_datetime timestamp, "
    "pu_location_id int, do_location_id int, dispatching_base_num string, vendor_id int, ratecode_id int, "
    "payment_type_id int, passenger_count int, trip_distance double, fare_amount double, tip_amount double, "
    "tolls_amount double, total_amount double, extra double, mta_tax double, improvement_surcharge double, "
    "congestion_surcharge double, airport_fee double, hvfhs_license_num string, base_passenger_fare double, "
    "trip_miles double, tips double, driver_pay double, shared_request_flag string, shared_match_flag string"
)
REASON = "reject_reason"


def stream_source(spark: SparkSession, path: str, glob: str = "*.json", files_per_trigger: int | None = None) -> DataFrame:
    """Lines of JSON files as they arrive; Kafka values can be used in the same way."""
    reader = spark.readStream.format("text").option("pathGlobFilter", glob)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def parse_events(lines: DataFrame, column: str = "value", keep=()) -> DataFrame:
    """One JSON object per line to typed columns; malformed lines give NULL fields."""
    ride = F.from_json(F.col(column), EVENT_SCHEMA)
    return lines.select(*keep, ride.alias("_ride")).select(*keep, "_ride.*")


def incomplete(required=fv.EVENT_REQUIRED) -> Column:
    """First missing field of the event's service; other services need two fields."""
    checks = None
    service = F.col("service_id")
    for name, fields in required.items():
        missing = F.coalesce(*[F.when(F.col(f).isNull(), F.lit(f"incomplete_{f}")) for f in fields])
        checks = F.when(service == name, missing) if checks is None else checks.when(service == name, missing)
    basic = F.coalesce(*[F.when(F.col(f).isNull(), F.lit(f"incomplete_{f}")) for f in ("service_id", "pickup_datetime")])
    return checks.otherwise(basic)


def judge(events: DataFrame, zones: DataFrame, as_of: Column | None = None, settings: Settings = DEFAULTS) -> DataFrame:
    """Add ``reject_reason`` (NULL = accepted): fields, time window, order of times, zones."""
    now = F.current_timestamp() if as_of is None else as_of
    pickup, dropoff = F.col("pickup_datetime"), F.col("dropoff_datetime")
    oldest = now - F.make_dt_interval(F.lit(settings.speed.lookback_days))
    newest = now + F.make_dt_interval(F.lit(1))
    # NULL locations match no zone and pass: only a named, unknown zone is invalid
    ids = zones.select(F.col("LocationID").alias("_id")).distinct()
    known = events
    for location, flag in (("pu_location_id", "_pu"), ("do_location_id", "_do")):
        known = known.join(ids.withColumnRenamed("_id", flag), F.col(location) == F.col(flag), "left")
    reason = F.coalesce(
        incomplete(),
        F.when((pickup < oldest) | (pickup >= newest), F.lit("timeliness_window")),
        F.when(dropoff < pickup, F.lit("datetime_inverted")),
        F.when(F.col("pu_location_id").isNotNull() & F.col("_pu").isNull(), F.lit("integrity_invalid_pu_location_id")),
        F.when(F.col("do_location_id").isNotNull() & F.col("_do").isNull(), F.lit("integrity_invalid_do_location_id")),
    )
    return known.withColumn(REASON, reason).drop("_pu", "_do")


def event_trip_id() -> Column:
    """Trip id from the category's key fields, the same hash as in the facts."""
    start, end = F.col("pickup_datetime"), F.col("dropoff_datetime")
    taxi = rules.trip_id(F.col("vendor_id"), start, end, F.col("pu_location_id"))
    return (
        F.when(rules.is_taxi(F.col("service_id")), taxi)
        .when(F.col("service_id") == "fhvhv", rules.trip_id(F.col("hvfhs_license_num"), F.col("request_datetime"), start, end))
        .when(F.col("service_id") == "fhv", rules.trip_id(F.col("dispatching_base_num"), start, end))
        # other services have no key fields: their events must not share one id
        .otherwise(rules.trip_id(F.col("service_id"), start, end, F.col("pu_location_id"), F.col("do_location_id")))
    )


def enrich(accepted: DataFrame, zones: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Zone names, blocks, duration, revenue, groups: the batch column functions on events."""
    pickup, hour = F.col("pickup_datetime"), F.hour("pickup_datetime")
    weekday = clock.iso_weekday(pickup)
    app = F.col("service_id") == "fhvhv"
    fare = F.when(app, F.col("base_passenger_fare")).otherwise(F.col("fare_amount"))
    tip = F.when(app, F.col("tips")).otherwise(F.col("tip_amount"))
    usable = rules.tip_is_recorded(F.col("service_id"), F.col("payment_type_id"), fare)
    pct = half_up(F.when(usable, tip / fare * F.lit(100.0)), 2)
    placed = with_zone(with_zone(accepted, zones, "pu_location_id", "pu_"), zones, "do_location_id", "do_")
    return placed.withColumns({
        "trip_id": event_trip_id(),
        "fecha_viaje": F.to_date(pickup),
        "pickup_hour": hour,
        "bloque_horario": clock.bloque_horario(hour),
        "franja_horaria": clock.franja_horaria(hour),
        "dia_categoria": clock.dia_categoria(weekday),
        "is_weekend": clock.is_weekend(weekday),
        "trip_duration_minutes": F.when(
            F.col("dropoff_datetime") > pickup, clock.minutes_between(pickup, F.col("dropoff_datetime"))),
        "revenue": rules.revenue(F.col("service_id"), F.col("total_amount"), F.col("base_passenger_fare")),
        "passenger_group": rules.passenger_group(F.col("passenger_count")),
        "categoria_generosidad": rules.categoria_generosidad(pct, settings.generosity),
    })


def first_delivery(rides: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """One event per trip id within the state window, on a batch as on a stream: an event within ``state_hours`` after another of its
    trip is a repeat. Of events at one time the first stays: by ``event_id`` where there is one, else by content.

    On a batch, events of one trip and time are cut to one per task before the shuffle; what is then compared per trip is one row per time.
    """
    late = f"{settings.speed.state_hours} hours"
    if rides.isStreaming:
        return rides.withWatermark("pickup_datetime", late).dropDuplicatesWithinWatermark(["trip_id"])
    first = "event_id" if "event_id" in rides.columns else F.xxhash64(*[c for c, kind in rides.dtypes if not kind.startswith("map")])
    once = top_n_per_group(rides, ["trip_id", "pickup_datetime"], [first], 1).drop("_rank")
    before = F.lag("pickup_datetime").over(Window.partitionBy("trip_id").orderBy("pickup_datetime"))
    fresh = before.isNull() | (F.col("pickup_datetime") > before + F.make_dt_interval(F.lit(0), F.lit(settings.speed.state_hours)))
    return once.withColumn("_fresh", fresh).filter("_fresh").drop("_fresh")
