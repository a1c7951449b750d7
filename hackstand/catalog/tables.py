"""The given tables shaped as trips, zones and ride events.

``lineitem`` rows become trips (joined to their order, supplier and customer), nations become
zones, and ``events`` become ride events. The library itself knows none of these tables.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hackstand import fixed_values as fv
from hackstand.functions import clock, rules
from hackstand.functions.numeric import half_up
from hackstand.operators import cleaning, star
from hackstand.plans import features, marts
from hackstand.session import materialise, scratch_path
from hackstand.streaming import rides, sinks

AS_OF = "2024-01-25 00:00:00"

TRIP_REQUIRED = (
    "order_key", "line_no", "part_key", "service_id", "vendor_id", "pickup_datetime", "dropoff_datetime",
    "pickup_location_id", "dropoff_location_id", "passenger_count", "ratecode_id", "payment_type_id",
    "trip_distance", "fare_amount", "tip_amount", "tolls_amount", "total_amount",
)
TRIP_ROLES = cleaning.TripRoles(
    required=TRIP_REQUIRED,
    pickup="pickup_datetime",
    dropoff="dropoff_datetime",
    pu="pickup_location_id",
    do="dropoff_location_id",
    keys=("order_key", "line_no"),
    prefer=("fare_amount",),
    scope=("service_id", "file_year", "file_month"),
)


_METERED = {
    "passenger_count": "passenger_count", "trip_distance": "trip_distance", "RatecodeID": "ratecode_id", "store_and_fwd_flag": "store_and_fwd_flag",
    "PULocationID": "pickup_location_id", "DOLocationID": "dropoff_location_id", "payment_type": "payment_type_id",
    **{c: c for c in ("fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge", "total_amount", "congestion_surcharge")},
}
# Column of a category's monthly file: column of the trips above.
BRONZE = {
    "yellow": {"VendorID": "vendor_id", "tpep_pickup_datetime": "pickup_datetime", "tpep_dropoff_datetime": "dropoff_datetime", **_METERED,
               "airport_fee": "airport_fee"},
    "green": {"VendorID": "vendor_id", "lpep_pickup_datetime": "pickup_datetime", "lpep_dropoff_datetime": "dropoff_datetime", **_METERED},
    "fhv": {"dispatching_base_num": "dispatching_base_num", "pickup_datetime": "pickup_datetime", "dropOff_datetime": "dropoff_datetime",
            "PUlocationID": "pickup_location_id", "DOlocationID": "dropoff_location_id"},
    "fhvhv": {**{c: c for c in ("hvfhs_license_num", "dispatching_base_num", "request_datetime", "on_scene_datetime", "pickup_datetime", "dropoff_datetime")},
              "PULocationID": "pickup_location_id", "DOLocationID": "dropoff_location_id", "trip_miles": "trip_distance",
              "base_passenger_fare": "fare_amount", "tolls": "tolls_amount", "tips": "tip_amount",
              **{c: c for c in ("bcf", "sales_tax", "congestion_surcharge", "airport_fee", "driver_pay", "shared_request_flag", "shared_match_flag")}},
}


def minutes(count: Column) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), count.cast("int"), F.lit(0).cast("decimal(18,6)"))


def taxi_only(value: Column) -> Column:
    return F.when(rules.is_taxi(F.col("service_id")), value)


def service_code() -> Column:
    return F.array_position(F.array(*[F.lit(s) for s in fv.SERVICES]), F.col("service_id")) - 1


def app_only(value: Column) -> Column:
    return F.when(F.col("service_id") == "fhvhv", value)


class Tables:
    """Lazy views over one data folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}.parquet")

    # ---- batch ----

    @cached_property
    def zones(self) -> DataFrame:
        nation, region = self.read("nation"), self.read("region")
        return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
            F.col("n_nationkey").alias("LocationID"),
            F.col("r_name").alias("Borough"),
            F.col("n_name").alias("Zone"),
        )

    @cached_property
    def trips(self) -> DataFrame:
        """Raw trips of all services, with the position of each row in its file."""
        lines = cleaning.with_position(self.read("lineitem"))
        orders, supplier, customer = self.read("orders"), self.read("supplier"), self.read("customer")
        # what is small meets first: the lines move once, by their order
        placed = orders.join(customer, orders.o_custkey == customer.c_custkey)
        joined = lines.join(supplier, lines.l_suppkey == supplier.s_suppkey).join(placed, lines.l_orderkey == placed.o_orderkey)
        line, price = F.col("l_linenumber"), F.col("l_extendedprice")
        day = F.col("o_orderdate").cast("timestamp")
        service = (
            F.when(F.col("l_returnflag") == "A", "yellow")
            .when(F.col("l_returnflag") == "R", "green")
            .when(F.col("l_linestatus") == "F", "fhv")
            .otherwise("fhvhv")
        )
        late = F.when((F.col("l_tax") == 0.08) & (line == 7), 57600).otherwise(0)
        early = F.when((F.col("l_discount") == 0.1) & (line == 1), 400).otherwise(0)
        start = joined.withColumns({
            "_service": service,
            "_pickup": day + minutes((F.col("l_orderkey") * 37 + line * 101) % 1440 + late),
            "_tip": half_up(price * F.col("l_discount"), 2),
            "_tolls": half_up(price * F.col("l_tax"), 2),
            "_early": early,
        })
        pickup = F.col("_pickup")
        requested = pickup - minutes(F.col("l_partkey") % 20 + 1)
        extra = F.lit(0.5) * (line % 3)
        surcharge = F.when(line % 2 == 0, 2.5).otherwise(0.0)
        airport = F.when(F.col("l_partkey") % 7 == 0, 1.25).otherwise(0.0)
        off = F.when(F.col("l_partkey") % 50 == 0, 1.0).otherwise(0.0)
        return start.select(
            F.col("l_orderkey").alias("order_key"),
            line.alias("line_no"),
            F.col("l_partkey").alias("part_key"),
            F.col("_service").alias("service_id"),
            (F.col("l_suppkey") % 3).cast("int").alias("vendor_id"),
            F.year(day).alias("file_year"),
            F.month(day).alias("file_month"),
            pickup.alias("pickup_datetime"),
            (pickup + minutes(F.col("l_quantity") * 3 - F.col("_early"))).alias("dropoff_datetime"),
            (F.col("s_nationkey") + 2).alias("pickup_location_id"),
            (F.col("c_nationkey") + 2).alias("dropoff_location_id"),
            (line - 1).alias("passenger_count"),
            (F.col("l_partkey") % 6 + 1).cast("int").alias("ratecode_id"),
            (line % 4 + 1).alias("payment_type_id"),
            F.when(~((F.col("l_tax") == 0.07) & (line == 2)), F.col("l_quantity")).alias("trip_distance"),
            price.alias("fare_amount"),
            F.col("_tip").alias("tip_amount"),
            F.col("_tolls").alias("tolls_amount"),
            extra.alias("extra"),
            F.lit(0.5).alias("mta_tax"),
            F.lit(1.0).alias("improvement_surcharge"),
            surcharge.alias("congestion_surcharge"),
            airport.alias("airport_fee"),
            half_up(price + F.col("_tip") + F.col("_tolls") + extra + 0.5 + 1.0 + surcharge + airport + off, 2)
            .alias("total_amount"),
            F.concat(F.lit("HV000"), (F.col("l_suppkey") % 4 + 2).cast("string")).alias("hvfhs_license_num"),
            F.concat(F.lit("B"), (F.col("l_suppkey") % 50).cast("string")).alias("dispatching_base_num"),
            requested.alias("request_datetime"),
            F.when(F.col("l_partkey") % 5 != 0, requested + minutes(F.col("l_partkey") % 9)).alias("on_scene_datetime"),
            half_up(price * 0.03, 2).alias("bcf"),
            half_up(price * 0.08875, 2).alias("sales_tax"),
            half_up(price * 0.75, 2).alias("driver_pay"),
            F.when(line % 5 == 0, "Y").otherwise("N").alias("shared_request_flag"),
            F.when(F.col("l_partkey") % 10 == 0, "Y").otherwise("N").alias("shared_match_flag"),
            F.when(line == 3, "Y").when(line < 7, "N").alias("store_and_fwd_flag"),
            cleaning.FILE, cleaning.ROW,
        )

    @cached_property
    def most_trips(self) -> int:
        """Lines of all orders, counted from the file's footer: there are no more trips."""
        return self.read("lineitem").count()

    @cached_property
    def tagged(self) -> DataFrame:
        return cleaning.tag_rejects(self.trips, self.zones, TRIP_ROLES)

    @cached_property
    def clean(self) -> DataFrame:
        return cleaning.split(self.tagged)[0]

    @cached_property
    def rejects(self) -> DataFrame:
        return cleaning.split(self.tagged)[1]

    @cached_property
    def facts(self) -> DataFrame:
        """Unified facts: each service keeps the columns its category publishes."""
        pickup = F.col("pickup_datetime")
        taxi = ("passenger_count", "trip_distance", "fare_amount", "tip_amount", "tolls_amount", "extra",
                "mta_tax", "improvement_surcharge", "total_amount", "vendor_id", "ratecode_id", "payment_type_id")
        app = ("hvfhs_license_num", "request_datetime", "on_scene_datetime", "bcf", "sales_tax", "driver_pay",
               "shared_request_flag", "shared_match_flag")
        return self.clean.select(
            ((F.col("order_key") * 10 + F.col("line_no")) * 4 + service_code()).alias("trip_id"),
            "service_id",
            F.col("file_year").alias("year"),
            F.col("file_month").alias("month"),
            clock.date_key(F.to_date(pickup)).alias("date_key"),
            pickup, "dropoff_datetime", "pickup_location_id", "dropoff_location_id",
            *[taxi_only(F.col(c)).alias(c) for c in taxi],
            *[app_only(F.col(c)).alias(c) for c in app],
            app_only(F.col("trip_distance")).alias("trip_miles"),
            app_only(F.col("fare_amount")).alias("base_passenger_fare"),
            app_only(F.col("tolls_amount")).alias("tolls"),
            app_only(F.col("tip_amount")).alias("tips"),
            F.when(F.col("service_id") != "fhv", F.col("congestion_surcharge")).alias("congestion_surcharge"),
            F.when(F.col("service_id").isin("yellow", "fhvhv"), F.col("airport_fee")).alias("airport_fee"),
            F.when(F.col("service_id") != "fhv",
                   half_up(clock.minutes_between(pickup, F.col("dropoff_datetime")), 2)).alias("trip_duration_minutes"),
        )

    def with_stored_facts(self, *columns: str) -> Tables:
        """The same tables with these columns of the facts written once, for queries that read the facts more than once."""
        other = Tables(self.spark, self.root)
        other.facts = materialise(self.facts.select("service_id", "year", "month", "pickup_datetime", "pickup_location_id", *columns), "facts")
        return other

    @cached_property
    def demand(self) -> DataFrame:
        return marts.demand_volume(self.facts, self.zones)

    @cached_property
    def financial(self) -> DataFrame:
        return marts.financial_performance(self.facts, self.zones)

    @cached_property
    def operational(self) -> DataFrame:
        return marts.operational_profile(self.facts, self.zones)

    @cached_property
    def balance(self) -> DataFrame:
        return marts.supply_demand_balance(self.facts, self.zones)

    @cached_property
    def abc_xyz(self) -> DataFrame:
        return marts.abc_xyz_zones(self.facts, self.zones)

    @cached_property
    def tipping(self) -> DataFrame:
        return marts.tipping_behavior(self.facts, self.zones)

    @cached_property
    def hourly(self) -> DataFrame:
        return marts.hourly_trips(self.facts, self.zones)

    @cached_property
    def tariffs(self) -> DataFrame:
        """Flat fares for the fiscal years of the trips at hand."""
        years = tuple(range(1990, 2031))
        return star.dim_ratecode_theoretical(
            self.spark, years, [(fv.FLAT_FARE_RATECODE, y, 70.0) for y in years]
        )

    @cached_property
    def fraud_features(self) -> DataFrame:
        return features.fraud_features(self.facts, self.tariffs)

    @cached_property
    def cluster_features(self) -> DataFrame:
        return features.cluster_features(
            self.facts, self.zones, star.dim_payment_type(self.spark), star.dim_ratecode(self.spark),
            app_fraction=1.0,
        )

    # ---- audit logs, as the three layers would have written them ----

    def _runs(self, source: DataFrame, runs: int, *measures: Column) -> DataFrame:
        """Log rows per file and run: a run takes the lines whose number leaves one remainder."""
        grouped = source.groupBy("service_id", "file_year", "file_month", (F.col("line_no") % runs).alias("run")).agg(
            F.count(F.lit(1)).alias("n"), *measures
        )
        month = F.concat("file_year", F.lit("-"), F.lpad(F.col("file_month").cast("string"), 2, "0"))
        start = F.make_timestamp("file_year", "file_month", F.col("run") + 1, F.lit(0), F.lit(0), F.lit(0)) + F.make_dt_interval(
            F.lit(0), F.lit(0), F.lit(0), (F.col("n") * 0.5).cast("decimal(18,6)"))
        end = start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.col("n") * 0.137).cast("decimal(18,6)"))
        iso = "yyyy-MM-dd'T'HH:mm:ss.SSS"
        return grouped.withColumns({
            "month": month, "start_timestamp": F.date_format(start, iso), "end_timestamp": F.date_format(end, iso),
            "_id": F.concat_ws("|", "service_id", month, F.col("run").cast("string")),
        })

    @cached_property
    def audit_bronze(self) -> DataFrame:
        return self._runs(self.trips, 3, F.sum("part_key").alias("bytecount")).select(
            F.md5(F.concat(F.lit("b"), "_id")).alias("audit_id"),
            F.concat("service_id", F.lit("_"), "month").alias("name"),
            F.concat(F.lit("data\\bronze\\"), "service_id", F.lit("\\"), "month", F.lit(".parquet")).alias("source_file"),
            "bytecount", F.col("n").alias("rowcount"), "start_timestamp", "end_timestamp",
        )

    @cached_property
    def audit_silver(self) -> DataFrame:
        rejected = F.count(cleaning.REASON).alias("rowcount_quarantined")
        return self._runs(self.tagged, 2, rejected).filter("not (file_month = 7 and service_id = 'fhv')").select(
            F.md5(F.concat(F.lit("s"), "_id")).alias("audit_id"),
            F.when(F.col("file_month") == 3, "gone").otherwise(F.md5(F.concat(F.lit("b"), "_id"))).alias("bronze_audit_id"),
            F.concat(F.lit("data/bronze/"), "service_id", F.lit("/"), "month", F.lit(".parquet")).alias("source_file"),
            F.col("n").alias("rowcount_bronze"), (F.col("n") - F.col("rowcount_quarantined")).alias("rowcount_quality"),
            "rowcount_quarantined", "start_timestamp", "end_timestamp",
        )

    @cached_property
    def audit_gold(self) -> DataFrame:
        return self._runs(self.trips, 2).select(
            F.md5(F.concat(F.lit("g"), "_id")).alias("gold_audit_id"),
            F.md5(F.concat(F.lit("s"), "_id")).alias("silver_audit_id"),
            F.concat(F.lit("mart_"), "service_id").alias("mart_name"), F.lit("marts").alias("subdir"),
            F.when(F.col("run") == 0, "full").otherwise("incremental").alias("mode"),
            F.col("n").alias("rowcount_output"), "start_timestamp", "end_timestamp",
        )

    @cached_property
    def audit_ml(self) -> DataFrame:
        return self._runs(self.trips, 2).select(
            F.md5(F.concat(F.lit("m"), "_id")).alias("ml_audit_id"), F.col("service_id").alias("pipeline"),
            F.col("n").alias("rowcount_output"), F.col("start_timestamp").alias("started_at"),
        )

    # ---- ride events ----

    @staticmethod
    def as_lines(events: DataFrame) -> DataFrame:
        """Events as JSON lines; one in five is delivered twice."""
        k = F.get_json_object("props", "$.k").cast("int")
        raw = events.withColumns({"k": k, "at": F.date_trunc("second", F.col("ts").cast("timestamp"))})
        kind, at, value = F.col("event_type"), F.col("at"), F.col("value")
        service = (
            F.when(kind == "click", "yellow").when(kind == "view", "green").when(kind == "signup", "fhv").otherwise("fhvhv")
        )
        tip, tolls = half_up(value * (F.col("k") % 30) / 100.0, 2), half_up(value * (F.col("k") % 5) / 50.0, 2)
        miles = F.when(F.col("k") % 23 != 0, half_up(value / 7.0, 2))
        ride = F.struct(
            service.alias("service_id"), at.alias("pickup_datetime"),
            (at - minutes(F.col("k") % 9 + 1)).alias("request_datetime"),
            F.when(F.col("k") % 11 != 0, at + minutes(F.col("k") % 60 - 2)).alias("dropoff_datetime"),
            F.when(F.col("k") % 17 != 0, (F.col("user_id") % 25 + 2).cast("int")).alias("pu_location_id"),
            F.when(F.col("k") % 13 != 0, (F.col("event_id") % 25 + 2).cast("int")).alias("do_location_id"),
            F.concat(F.lit("B"), F.col("user_id").cast("string")).alias("dispatching_base_num"),
            F.when(F.col("k") % 19 != 0, (F.col("user_id") % 3).cast("int")).alias("vendor_id"),
            (F.col("k") % 6 + 1).alias("ratecode_id"), (F.col("k") % 4 + 1).alias("payment_type_id"),
            (F.col("k") % 7).alias("passenger_count"), miles.alias("trip_distance"), value.alias("fare_amount"),
            tip.alias("tip_amount"), tolls.alias("tolls_amount"), half_up(value + tip + tolls, 2).alias("total_amount"),
            F.lit(0.5).alias("extra"), F.lit(0.5).alias("mta_tax"),
            F.concat(F.lit("HV000"), (F.col("user_id") % 4 + 2).cast("string")).alias("hvfhs_license_num"),
            value.alias("base_passenger_fare"), miles.alias("trip_miles"), tip.alias("tips"),
            half_up(value * 0.75, 2).alias("driver_pay"),
            F.when(F.col("k") % 5 == 0, "Y").otherwise("N").alias("shared_request_flag"),
            F.when(F.col("k") % 10 == 0, "Y").otherwise("N").alias("shared_match_flag"),
        )
        copies = F.sequence(F.lit(1), F.when(F.col("k") % 5 == 0, 2).otherwise(1))
        return raw.withColumn("_copy", F.explode(copies)).select("event_id", F.to_json(ride).alias("value"))

    @cached_property
    def lines(self) -> DataFrame:
        return self.as_lines(self.read("events"))

    @cached_property
    def stream_lines(self) -> DataFrame:
        schema = self.read("events").schema
        events = self.spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(self.root)
        return self.as_lines(events)

    def judged(self, lines: DataFrame) -> DataFrame:
        return rides.judge(rides.parse_events(lines, keep=("event_id",)), self.zones, F.lit(AS_OF).cast("timestamp"))

    def accepted(self, lines: DataFrame) -> DataFrame:
        return rides.enrich(self.judged(lines).filter(F.col(rides.REASON).isNull()).drop(rides.REASON), self.zones)

    @cached_property
    def rides(self) -> DataFrame:
        """Accepted rides, each once."""
        return rides.first_delivery(self.accepted(self.lines))

    def ride_stream(self) -> DataFrame:
        """Accepted rides as a new stream over the table that the intake stream fills."""
        intake = rides.first_delivery(self.accepted(self.stream_lines))
        path = scratch_path(self.spark, "rides")
        sinks.append_table(intake, path, f"{path}-checkpoint").awaitTermination()
        return self.spark.readStream.schema(intake.schema).parquet(path)

    @cached_property
    def ride_hours(self) -> DataFrame:
        return self.rides.groupBy(
            F.coalesce("pu_borough", F.lit("Unknown")).alias("borough"), "service_id",
            F.date_trunc("hour", "pickup_datetime").alias("pickup_hour")).agg(F.count(F.lit(1)).alias("trip_count"))

    def raw_category(self, category: str) -> DataFrame:
        """Clean trips of one category under the column names its source files use."""
        names = {
            "yellow": {"vendor_id": "VendorID", "pickup_datetime": "tpep_pickup_datetime",
                       "dropoff_datetime": "tpep_dropoff_datetime", "ratecode_id": "RatecodeID",
                       "payment_type_id": "payment_type"},
            "green": {"vendor_id": "VendorID", "pickup_datetime": "lpep_pickup_datetime",
                      "dropoff_datetime": "lpep_dropoff_datetime", "ratecode_id": "RatecodeID",
                      "payment_type_id": "payment_type"},
            "fhvhv": {"trip_distance": "trip_miles", "fare_amount": "base_passenger_fare",
                      "tolls_amount": "tolls", "tip_amount": "tips"},
            "fhv": {"dropoff_datetime": "dropOff_datetime"},
        }[category]
        zone = {"pickup_location_id": "PULocationID", "dropoff_location_id": "DOLocationID",
                "file_year": "year", "file_month": "month"}
        return self.clean.filter(F.col("service_id") == category).drop("service_id").withColumnsRenamed({**names, **zone})


    def bronze(self, category: str) -> DataFrame:
        """Uncleaned trips of one category under the names its monthly files use, with the file's period and each row's position."""
        columns = [F.col(ours).alias(theirs) for theirs, ours in BRONZE[category].items()]
        trips = self.trips.filter(F.col("service_id") == category)
        return trips.select(*columns, "file_year", "file_month", cleaning.FILE, cleaning.ROW)


def open_tables(spark: SparkSession, root: str) -> Tables:
    return Tables(spark, root)
