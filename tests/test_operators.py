import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from hackstand.operators import quantiles, ranking, selection


@pytest.mark.parametrize("p", [0.0, 0.05, 0.5, 0.95, 1.0])
def test_exact_quantile_matches_sorting(spark, p):
    rng = np.random.default_rng(7)
    groups = {1: rng.lognormal(size=25_000), 2: np.where(rng.random(9000) < 0.4, 3.0, rng.normal(size=9000))}
    rows = [(k, float(v)) for k, vs in groups.items() for v in vs] + [(1, None)]
    df = spark.createDataFrame(rows, "k int, v double")
    got = {r.k: r.q for r in quantiles.exact_quantile(df, ["k"], "v", p, "q").collect()}
    for k, vs in groups.items():
        assert got[k] == pytest.approx(float(np.quantile(vs, p)), rel=1e-12)


def test_bracket_off_target_corrects_itself(spark, monkeypatch):
    """The sketch may be wrong by any amount: brackets at the far end, or of one value, still lead to the wanted ranks."""
    sketched, rows = quantiles._sketched, [(1, float(v % 977)) for v in range(9000)] + [(2, 5.0)]
    df = spark.createDataFrame(rows, "k int, v double")
    for lo, hi in ((-5.0, -4.0), (970.0, 2000.0), (3.0, 3.0), (-1e308, 1e308)):
        monkeypatch.setattr(quantiles, "_sketched", lambda *a, lo=lo, hi=hi: sketched(*a).withColumns({"_lo": F.lit(lo), "_hi": F.lit(hi)}))
        got = {r.k: (r.a, r.b) for r in quantiles.exact_quantiles(df, ["k"], "v", {"a": 0.31, "b": 0.99}).collect()}
        assert got == {1: tuple(np.quantile([v for k, v in rows if k == 1], [0.31, 0.99])), 2: (5.0, 5.0)}


def test_quantiles_of_odd_distributions(spark):
    rng = np.random.default_rng(3)
    groups = {1: 2.0 ** rng.integers(-900, 900, 3000), 2: np.array([1e-300] * 5 + [1.0] * 5 + [1e300]), 3: np.append(rng.random(2000) * 1e-12, 1e12),
              4: np.array([float("inf"), 1.0, 2.0, 3.0, 4.0]), 5: np.repeat([-1e308, 0.0, 1e308], 40)}
    df = spark.createDataFrame([(k, float(v)) for k, vs in groups.items() for v in vs], "k int, v double")
    wanted = {f"q{i}": p for i, p in enumerate((0.0, 0.25, 0.5, 0.75))}
    got = {r.k: tuple(r[a] for a in wanted) for r in quantiles.exact_quantiles(df, ["k"], "v", wanted, accuracy=50).collect()}
    for k, vs in groups.items():
        vs = np.sort(vs)
        for g, p in zip(got[k], wanted.values()):
            at = p * (len(vs) - 1)
            a, b = vs[int(at)], vs[min(int(at) + 1, len(vs) - 1)]
            assert g == pytest.approx(a if at == int(at) else a + (b - a) * (at % 1), rel=1e-9)


def test_large_group_of_distinct_values_is_spread(spark):
    """A group of a million distinct values: what meets in one task is at most a row per sub-interval and map task."""
    df = spark.range(0, 1_000_000, 1, 8).select(F.lit(1).alias("k"), (F.xxhash64("id") / 1e3).alias("v"))
    x = df.select("k", F.col("v").alias("_x"))
    brackets = quantiles._sketched(x, ["k"], {"q": 0.5}, 100)
    narrowed = quantiles._narrowed(x, brackets, ["k"], True)
    assert "_x" not in narrowed.columns and narrowed.count() == 1
    plan = narrowed._jdf.queryExecution().executedPlan().toString()
    assert "Sort [_x" not in plan and "SortAggregate" not in plan
    got = quantiles.exact_quantile(df, ["k"], "v", 0.5, "q", accuracy=100).first().q
    assert got == pytest.approx(df.agg(F.median("v")).first()[0])


def test_small_groups_and_imputation(spark):
    df = spark.createDataFrame([(1, 1.0), (1, None), (1, 4.0), (2, None)], "k int, v double")
    assert sorted(r.v for r in quantiles.impute_median(df, ["k"], ["v"]).collect()) == [0.0, 1.0, 2.5, 4.0]


def test_ordinal_equals_row_number(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 50).cast("string")).alias("k"), "id",
        F.timestamp_seconds(F.pmod(F.xxhash64("id"), F.lit(20_000_000))).alias("t"))
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy("t", "id")))
    got = ranking.ordinal(df, ["k"], "t", ["id"], "n")
    assert got.join(want.select("id", "rn"), "id").filter("n <> rn").count() == 0
    assert got.count() == 3000


def test_hot_key_is_numbered_in_many_ranges(spark):
    """A key with a third of all rows, all within one month, is dealt over many tasks of about equal size."""
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 500).cast("string")).alias("k"), F.when(F.col("id") % 7 != 0, F.col("id") % 5).alias("j"), "id",
        F.timestamp_seconds(F.pmod(F.xxhash64("id"), F.lit(86_400 * 28))).alias("t"))
    for keys, order in ((["k"], ["t", "id"]), (["k", "j"], [F.col("t").desc(), "id"])):
        got = ranking.numbered(df, keys, order, "n", parts=24)
        want = df.withColumn("rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
        assert got.columns == [*df.columns, "n"] and got.join(want.select("id", "rn"), "id").filter("n = rn").count() == 30_000
    placed = df.filter("k = 'hot'").repartitionByRange(24, "k", "t", "id").groupBy(F.spark_partition_id()).count().collect()
    assert len(placed) == 24 and max(r["count"] for r in placed) < 3 * 10_000 / 24
    cells = ranking._shifted(df.withColumn("_part", F.pmod("id", F.lit(9))), ["k"], [F.col("t")], "n")
    assert "_part" in cells.columns


def test_run_flags(spark):
    df = spark.createDataFrame([("a", "2024-01-01", 1), ("a", "2024-03-01", 2), ("b", "2024-02-01", 3)], "f string, s string, id int")
    rows = {r.id: r for r in ranking.run_flags(df.withColumn("inicio", F.to_timestamp("s")), "f", ties=("id",)).collect()}
    assert [(rows[i].n_corrida, rows[i].es_ultima_corrida, rows[i].total_corridas) for i in (1, 2, 3)] == [
        (1, False, 2), (2, True, 2), (1, True, 1)]


def test_top_n_with_rest_keeps_the_total(spark):
    df = spark.range(1, 31).select(F.lit("g").alias("g"), F.col("id").cast("string").alias("v"), F.col("id").alias("n"))
    rows = {r.v: r.n for r in selection.top_n_with_rest(df, ["g"], "v", "n", 5, "rest").collect()}
    assert rows["30"] == 30 and len(rows) == 6 and sum(rows.values()) == 465


def test_sample_cap_is_exact_and_layout_free(spark):
    df = spark.range(20_000).select("id", (F.col("id") % 3 == 0).alias("flag"))
    picks = [sorted(r.id for r in selection.sample_cap(d, ["flag"], F.col("id"), 300).collect())
             for d in (df, df.repartition(7, "flag"))]
    assert len(picks[0]) == 600 and picks[0] == picks[1]
    few = selection.sample_cap(df.filter("id < 10"), ["flag"], F.col("id"), 300)
    assert few.count() == 10


def test_filters_and_pages(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), (None, 4)], "k string, n int")
    assert selection.filter_dynamic(df, {"k": ["a", "b"], "n": None}).count() == 2
    assert selection.filter_dynamic(df, {}).count() == 4
    assert [r.n for r in selection.page(df, [("n", "desc")], 2, 1).collect()] == [3, 2]
    assert [r.n for r in selection.page(df, [("n", "asc")], None, 3).collect()] == [4]


def test_gap_fill(spark):
    df = spark.createDataFrame([("x", "2024-01-01 00:00:00", 5), ("x", "2024-01-01 03:00:00", 7)], "k string, s string, n int")
    rows = ranking.gap_fill(df.withColumn("t", F.to_timestamp("s")), ["k"], "t", "n").orderBy("t").collect()
    assert [r.n for r in rows] == [5.0, 0.0, 0.0, 7.0]


def test_a_dimension_that_cannot_run_scores_zero_and_the_others_are_measured(spark):
    from hackstand.operators import quality as q

    zones = spark.createDataFrame([(1, "Queens", "A"), (2, "Bronx", "B")], "LocationID int, Borough string, Zone string")
    trips = spark.createDataFrame(
        [(1, "2024-01-02 10:00:00", "2024-01-02 10:30:00", 1, 2, 10.0, "12.5", 2024, 1), (1, "2024-01-03 10:00:00", "2024-01-03 10:30:00", 1, 9, 10.0, "odd", 2024, 1)],
        "VendorID int, tpep_pickup_datetime string, tpep_dropoff_datetime string, PULocationID int, DOLocationID int, fare_amount double, total_amount string, file_year int, file_month int")
    p = q.profile_for("yellow", trips.columns)
    rows = {r["dimension"]: r for r in q.safe_scores(trips, zones, p).collect()}
    assert set(rows) == set(q.DIMENSIONS)
    # text amounts: the formula and the ranges cannot be measured
    for d in ("accuracy", "reasonableness"):
        assert rows[d]["score"] == 0.0 and rows[d]["passed"] is False and "total_amount" in rows[d]["error"]
    assert rows["integrity"]["score"] == 0.75 and rows["integrity"]["error"] is None
    assert rows["uniqueness"]["passed"] and rows["timeliness"]["score"] == 1.0
    # a column that the profile names and the file lacks fails what reads it
    gone = q.failing_dimensions(trips.drop("DOLocationID"), zones, p)
    assert {"integrity", "completeness"} <= set(gone) and "timeliness" not in gone
    # whichever dimensions are off, all eight have a row; off ones do not apply
    bare = p
    for d in q.DIMENSIONS:
        bare = q.without(bare, d)
    assert {(r["dimension"], r["score"], r["passed"]) for r in q.scores(trips, zones, bare).collect()} == {(d, 1.0, True) for d in q.DIMENSIONS}
