from datetime import datetime

import pytest
from pyspark.sql import functions as F

from hackstand.operators import cleaning as c

YELLOW = dict(
    VendorID=1, tpep_pickup_datetime=datetime(2024, 1, 5, 8), tpep_dropoff_datetime=datetime(2024, 1, 5, 9),
    passenger_count=1, trip_distance=3.0, RatecodeID=1, store_and_fwd_flag="N", PULocationID=1, DOLocationID=2,
    payment_type=1, fare_amount=10.0, total_amount=12.0, airport_fee=0.0)
FHVHV = dict(
    hvfhs_license_num="HV0003", dispatching_base_num="B1", request_datetime=datetime(2024, 1, 5, 7, 50),
    on_scene_datetime=datetime(2024, 1, 5, 7, 55), pickup_datetime=datetime(2024, 1, 5, 8),
    dropoff_datetime=datetime(2024, 1, 5, 9), PULocationID=1, DOLocationID=2, trip_miles=3.0, driver_pay=9.0)


def tag(spark, category, rows, **kwargs):
    rows = [{**r, "file_year": 2024, "file_month": 1, "_file": "f", "_row": i} for i, r in enumerate(rows)]
    columns = list(rows[0])
    kinds = {int: "int", float: "double", str: "string", datetime: "timestamp"}
    sample = {k: next((r[k] for r in rows if r[k] is not None), "") for k in columns}
    schema = ", ".join(f"`{k}` {'long' if k == '_row' else kinds[type(sample[k])]}" for k in columns)
    df = spark.createDataFrame([tuple(r[k] for k in columns) for r in rows], schema)
    zones = spark.createDataFrame([(1, "A", "a"), (2, "B", "b")], "LocationID int, Borough string, Zone string")
    return c.tag_rejects(df, zones, c.roles_for(category, df.columns), **kwargs)


def reasons(tagged):
    return sorted((r[0] or "clean") for r in tagged.select(c.REASON).collect())


@pytest.mark.parametrize("base,category,change,expected", [
    (YELLOW, "yellow", {}, "clean"),
    (YELLOW, "yellow", {"trip_distance": None}, "incomplete_trip_distance"),
    (FHVHV, "fhvhv", {"trip_miles": None}, "incomplete_trip_miles"),
    (YELLOW, "yellow", {"store_and_fwd_flag": None, "RatecodeID": None}, "clean"),
    (FHVHV, "fhvhv", {"on_scene_datetime": None, "request_datetime": None}, "clean"),
    (YELLOW, "yellow", {"tpep_pickup_datetime": datetime(2024, 2, 5), "tpep_dropoff_datetime": datetime(2024, 2, 6)}, "timeliness_off_period"),
    (YELLOW, "yellow", {"tpep_dropoff_datetime": datetime(2024, 1, 5, 7)}, "datetime_inverted"),
    (YELLOW, "yellow", {"tpep_dropoff_datetime": datetime(2024, 1, 5, 8)}, "clean"),
    (YELLOW, "yellow", {"tpep_dropoff_datetime": datetime(2024, 1, 6, 9)}, "clean"),
    (YELLOW, "yellow", {"PULocationID": 999999}, "integrity_invalid_PULocationID"),
    (YELLOW, "yellow", {"DOLocationID": 999999}, "integrity_invalid_DOLocationID"),
    # the first failing rule names the reason
    (YELLOW, "yellow", {"trip_distance": None, "PULocationID": 999999}, "incomplete_trip_distance"),
])
def test_one_changed_row(spark, base, category, change, expected):
    other = {k: (datetime(2024, 1, 9, 1, 2) if k.endswith("datetime") else v) for k, v in base.items()}
    tagged = tag(spark, category, [{**base, **change}, other])
    assert reasons(tagged) == sorted([expected, "clean"])


def test_duplicates_keep_the_larger_amount_and_conserve_rows(spark):
    tagged = tag(spark, "yellow", [YELLOW, {**YELLOW, "total_amount": 20.0}, {**YELLOW, "total_amount": None}])
    # a NULL amount is required, so that row is incomplete before it is a duplicate
    assert reasons(tagged) == ["clean", "incomplete_total_amount", "uniqueness_duplicate"]
    clean, rejected = c.split(tagged)
    assert [r.total_amount for r in clean.collect()] == [20.0]
    assert clean.count() + rejected.count() == 3
    assert not {"_file", "_row", c.REASON} & set(clean.columns)


def test_exact_copies_and_hot_key(spark):
    tagged = tag(spark, "yellow", [YELLOW] * 200)
    assert reasons(tagged) == ["clean"] + ["uniqueness_duplicate"] * 199


def test_null_keys_group_together(spark):
    rows = [{**FHVHV, "request_datetime": None}, {**FHVHV, "request_datetime": None}, FHVHV]
    assert reasons(tag(spark, "fhvhv", rows)) == ["clean", "clean", "uniqueness_duplicate"]


def test_kept_duplicate_may_fall_to_an_earlier_rule(spark):
    rows = [{**YELLOW, "total_amount": 99.0, "DOLocationID": 77}, YELLOW]
    assert reasons(tag(spark, "yellow", rows)) == ["integrity_invalid_DOLocationID", "uniqueness_duplicate"]
    assert reasons(tag(spark, "yellow", rows, dedup_after_rejects=True)) == ["clean", "integrity_invalid_DOLocationID"]


def test_nullable_names_ignore_case(spark):
    row = {("Airport_fee" if k == "airport_fee" else k): v for k, v in YELLOW.items()}
    other = {**row, "Airport_fee": None, "tpep_pickup_datetime": datetime(2024, 1, 8)}
    other["tpep_dropoff_datetime"] = datetime(2024, 1, 8, 1)
    assert reasons(tag(spark, "yellow", [row, other])) == ["clean", "clean"]


def test_same_key_in_two_files_is_not_a_duplicate(spark):
    tagged = tag(spark, "yellow", [YELLOW])
    both = tagged.drop(c.REASON).unionByName(tagged.drop(c.REASON).withColumn("file_month", F.lit(2)))
    zones = spark.createDataFrame([(1, "A", "a"), (2, "B", "b")], "LocationID int, Borough string, Zone string")
    again = c.tag_rejects(both, zones, c.only(c.roles_for("yellow", both.columns), "uniqueness"))
    assert reasons(again) == ["clean", "clean"]


def test_dedup_counts_hashes_before_it_compares(spark):
    """No aggregate sorts the trips, the plan of the tagged trips holds their source once, and a hot key meets in no task."""
    tagged = tag(spark, "yellow", [YELLOW] * 50 + [{**YELLOW, "PULocationID": 2, "total_amount": float(i)} for i in range(20)])
    plan = tagged._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "trip_keys" in plan and plan.count("Scan ExistingRDD[VendorID") == 1
    assert reasons(tagged) == ["clean"] * 2 + ["uniqueness_duplicate"] * 68


def test_equal_hash_of_unequal_keys_is_no_duplicate(spark, monkeypatch):
    monkeypatch.setattr(c, "key_hash", lambda columns: F.lit(1).cast("long"))
    rows = [YELLOW, {**YELLOW, "PULocationID": 2}, {**YELLOW, "VendorID": 2}, YELLOW]
    assert reasons(tag(spark, "yellow", rows)) == ["clean"] * 3 + ["uniqueness_duplicate"]


def test_ranking_keys_moves_no_whole_trips_again(spark):
    """Trips that lie by a part of their key are ranked where they are: the tagged trips hold one exchange and no join by position."""
    rows = [{**YELLOW, "passenger_count": i, "PULocationID": 1 + i % 2} for i in range(8)]
    tagged = tag(spark, "yellow", rows)
    plan = tagged.repartition("VendorID").drop(c.REASON)
    zones = spark.createDataFrame([(1, "A", "a"), (2, "B", "b")], "LocationID int, Borough string, Zone string")
    again = c.tag_rejects(plan, zones, c.only(c.roles_for("yellow", plan.columns), "uniqueness"))
    text = again._jdf.queryExecution().executedPlan().toString()
    assert text.count("REPARTITION_BY_COL") == 1 and "Exchange hashpartitioning(file_year" not in text and "_surplus_row" not in text
    assert reasons(again) == ["clean"] * 2 + ["uniqueness_duplicate"] * 6


def test_hot_and_other_keys_keep_the_same_trips(spark, monkeypatch):
    """A hot key is marked by position, the others are ranked; either way alone keeps the same trips."""
    rows = [{**YELLOW, "VendorID": 9, "total_amount": float(i % 7), "fare_amount": float(i)} for i in range(40)]
    rows += [{**YELLOW, "VendorID": i % 4, "total_amount": float(i)} for i in range(12)] + [{**YELLOW, "DOLocationID": 77, "total_amount": 99.0}]
    for later in (False, True):
        kept = []
        for least in (0, 16, 1000):
            monkeypatch.setattr(c, "HOT_ROWS", least)
            kept.append(sorted(tuple(r) for r in tag(spark, "yellow", rows, dedup_after_rejects=later).select("_row", F.coalesce(c.REASON, F.lit("clean"))).collect()))
        assert kept[0] == kept[1] == kept[2] and sum(reason == "clean" for _, reason in kept[0]) == (5 if later else 4)
