import pytest
from pyspark.sql import functions as F

from hackstand import fixed_values as fv
from hackstand.functions import clock, numeric, rules
from hackstand.operators import star
from hackstand.settings import DEFAULTS


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


@pytest.mark.parametrize("hour,block,part", [
    (0, "Madrugada", "Madrugada"), (5, "Madrugada", "Madrugada"), (6, "Punta Mañana", "Mañana"), (9, "Punta Mañana", "Mañana"),
    (10, "Mediodía", "Mañana"), (12, "Mediodía", "Tarde"), (16, "Punta Tarde", "Tarde"), (19, "Punta Tarde", "Noche"),
    (20, "Noche", "Noche"), (23, "Noche", "Noche"), (24, None, None), (None, None, None)])
def test_day_blocks(spark, hour, block, part):
    h = F.lit(hour).cast("int")
    assert one(spark, clock.bloque_horario(h)) == block
    assert one(spark, clock.franja_horaria(h)) == part


@pytest.mark.parametrize("count,label", [
    (None, "Desconocido"), (0, "Desconocido"), (-1, "Desconocido"), (1, "Solo"), (2, "Pareja"), (3, "Grupo pequeño"),
    (4, "Grupo pequeño"), (5, "Grupo grande")])
def test_passengers(spark, count, label):
    assert one(spark, rules.passenger_group(F.lit(count).cast("int"))) == label


@pytest.mark.parametrize("pct,label", [
    (None, None), (0.0, "Sin Propina"), (-2.0, "Sin Propina"), (9.99, "Baja"), (10.0, "Estándar"), (18.0, "Estándar"), (18.01, "Alta")])
def test_generosity(spark, pct, label):
    assert one(spark, rules.categoria_generosidad(F.lit(pct).cast("double"), DEFAULTS.generosity)) == label


@pytest.mark.parametrize("code,fare,flat,mph,cost,expected", [
    (2, 90.0, 70.0, 20.0, 3.0, True), (2, 80.0, 70.0, 20.0, 3.0, False), (1, 10.0, None, 81.0, 3.0, True),
    (1, 10.0, None, 20.0, 31.0, True), (5, 10.0, None, 20.0, 31.0, False), (1, 0.0, None, 20.0, 3.0, True),
    (1, None, None, 20.0, 3.0, None), (1, None, None, 90.0, 3.0, True)])
def test_anomaly_candidates_are_three_valued(spark, code, fare, flat, mph, cost, expected):
    lit = lambda v: F.lit(v).cast("double")
    assert one(spark, rules.is_anomaly_candidate(F.lit(code), lit(fare), lit(flat), lit(mph), lit(cost))) is expected


def test_rounding_and_sums_are_exact(spark):
    assert one(spark, numeric.half_up(F.lit(2.345), 2)) == 2.35
    df = spark.range(1, 100001).select((F.col("id") * 0 + 0.1).alias("v"))
    assert df.agg(numeric.exact_sum(F.col("v"))).first()[0] == 10000.0
    assert one(spark, numeric.guarded_ratio(F.lit(1), F.lit(0))) is None
    assert one(spark, numeric.pass_percent(F.lit(0), F.lit(0))) == 100.0


def test_trip_id_hashes_the_joined_text(spark):
    got = one(spark, rules.trip_id(F.lit(1), F.lit(None).cast("string"), F.lit("x")))
    assert got == one(spark, F.xxhash64(F.lit("1||||x")))
    assert one(spark, rules.trip_id()) is None


def test_dimensions(spark):
    dates = star.dim_date(spark)
    assert dates.count() == 1096
    row = dates.filter("date_key = 20240106").first()
    assert (row.weekday, row.day_name, row.month_name, row.is_weekend, row.quarter) == (6, "Saturday", "January", True, 1)
    gold = star.dim_date_gold(dates)
    assert gold.filter("is_holiday").count() == 33
    assert star.dim_ratecode_theoretical(spark).count() == 21
    assert star.dim_ratecode_theoretical(spark).filter("flat_fare is not null").count() == 3
    zones = spark.createDataFrame([(1, "EWR", "a"), (2, "Queens", "b"), (3, None, "c")], "LocationID int, Borough string, Zone string")
    assert [r[0] for r in star.dim_zone_gold(zones).orderBy("LocationID").select("borough_name_es").collect()] == [
        "Newark (EWR)", "Queens", None]
    assert len(fv.HOLIDAYS) == 55


def test_fact_schemas(spark):
    raw = spark.createDataFrame(
        [(1, "2024-01-05 08:00:00", "2024-01-05 08:30:00", 1, 2, 1, 1, 5.0)],
        "VendorID int, lpep_pickup_datetime string, lpep_dropoff_datetime string, PULocationID int, DOLocationID int, "
        "RatecodeID int, payment_type int, fare_amount double")
    fact = star.fact_trips("green", raw)
    row = fact.first()
    assert (row.date_key, row.trip_duration_minutes, row.fare_amount) == (20240105, 30.0, 5.0)
    assert "ehail_fee" not in fact.columns and row.trip_id is not None
    fhv = star.fact_trips("fhv", spark.createDataFrame(
        [("B1", "2024-01-05 08:00:00", "2024-01-05 09:00:00", 1, 2)],
        "dispatching_base_num string, pickup_datetime string, dropOff_datetime string, PUlocationID int, DOlocationID int"))
    assert fhv.columns == ["date_key", "trip_id", "pickup_datetime", "dropoff_datetime", "pickup_location_id", "dropoff_location_id"]
