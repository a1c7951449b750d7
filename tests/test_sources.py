import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from hackstand.plans import audit
from hackstand.settings import DEFAULTS
from hackstand.sources import files, footers, sinks


def test_targets():
    assert len(files.expand_targets([2023, 2024, 2025])) == 144
    assert files.expand_targets([("green", 2024, 3)]) == [("green", 2024, 3)]
    assert len(files.expand_targets([("fhv", 2024, None)])) == 12


def test_months_drift_missing_and_unreadable(spark, tmp_path):
    root = str(tmp_path)
    spark.sql("select 1 as a").write.parquet(files.month_path(root, "green", 2024, 1))
    spark.sql("select 2 as a, 0.5D as cbd_congestion_fee").write.parquet(files.month_path(root, "green", 2025, 1))
    (tmp_path / "green" / "2025-02.parquet").mkdir()
    targets, unreadable = files.expand_targets([2024, 2025], ["green"]), []
    found = files.read_months(spark, root, targets, unreadable)
    assert [m[:3] for m in unreadable] == [("green", 2025, 2)]
    with pytest.raises(AnalysisException):
        files.read_months(spark, root, targets)
    rows = found["green"].orderBy("a").collect()
    assert [(r.a, r.cbd_congestion_fee, r.file_year, r.file_month) for r in rows] == [(1, None, 2024, 1), (2, 0.5, 2025, 1)]
    paths = [files.month_path(root, "green", y, 1) for y in (2024, 2025)]
    assert sinks.drifted_columns(spark, paths) == ["cbd_congestion_fee"]
    assert files.committed(spark, paths[0]) and not files.committed(spark, files.month_path(root, "green", 2025, 2))


def test_partitioned_incremental_and_missing(spark, tmp_path):
    path = str(tmp_path / "mart")
    df = spark.range(40).select(
        F.when(F.col("id") % 2 == 0, "green").otherwise("yellow").alias("service_id"), F.lit(2024).alias("year"),
        (F.col("id") % 4 + 1).alias("month"), F.col("id").alias("viajes"))
    sinks.write_partitioned(df.filter("month <= 2"), path)
    sinks.write_incremental(df.withColumn("viajes", F.lit(0)), path)
    stored = files.scan_mart(spark, path)
    assert stored.count() == 40
    assert stored.filter("month > 2").agg(F.sum("viajes")).first()[0] == 0
    assert stored.filter("month <= 2").agg(F.sum("viajes")).first()[0] > 0
    wanted = files.targets_frame(spark, [("green", 2024, 1), ("green", 2024, 2)])
    absent = files.missing_partitions(wanted, files.present_months(spark, path))
    assert [tuple(r) for r in absent.collect()] == [("green", 2024, 2)]
    with pytest.raises(FileNotFoundError, match="green 2024-02"):
        files.require_complete(wanted, files.present_months(spark, path))
    assert sinks.export_table(spark, path, f"{path}-export") == 1
    assert spark.read.parquet(f"{path}-export").count() == 40


def test_file_sizing():
    assert [sinks.target_files(n) for n in (0, 1, 2_000_000, 2_000_001, 10**12)] == [1, 1, 1, 2, 32]


def test_audit_append_grows_the_log(spark, tmp_path):
    path = str(tmp_path / "audit")
    audit.append_run(spark, path, {"audit_id": "a", "rowcount": 1, "start_timestamp": "2024-01-01T00:00:00"}, DEFAULTS)
    audit.append_run(spark, path, {"audit_id": "b", "rowcount": 2, "start_timestamp": "2024-01-02T00:00:00"}, DEFAULTS)
    log = spark.read.parquet(path)
    assert log.count() == 2 and log.select("config_snapshot_md5").distinct().count() == 1
    assert audit.latest_audit_id(log).first()[0] == "b"
    assert audit.latest_audit_id(log.limit(0)).first()[0] == "unknown"


def test_half_written_partition_is_rebuilt(spark, tmp_path):
    path = str(tmp_path / "mart")
    df = spark.range(30).select(F.lit("green").alias("service_id"), F.lit(2024).alias("year"), (F.col("id") % 3 + 1).alias("month"), "id")
    sinks.write_partitioned(df.filter("month = 1"), path)
    # an interrupted job: part of a month on disk and no record of it
    df.filter("month = 2 and id < 5").write.mode("append").partitionBy(*sinks.KEYS).parquet(path)
    assert sinks.committed_partitions(spark, path).collect() == [("green", "2024", "1")]
    sinks.write_incremental(df.withColumn("id", F.col("id") + 100), path)
    stored = files.scan_mart(spark, path).groupBy("month").agg(F.count("*").alias("n"), F.min("id").alias("least"))
    assert sorted((r.month, r.n, r.least) for r in stored.collect()) == [(1, 10, 0), (2, 10, 101), (3, 10, 102)]
    assert sinks.committed_partitions(spark, path).count() == 3
    sinks.write_incremental(df, path)
    assert files.scan_mart(spark, path).count() == 30


def test_incremental_finds_keys_with_escaped_names(spark, tmp_path):
    path = str(tmp_path / "mart")
    df = spark.createDataFrame([("a b/c+d%", 1), ("plain", 2), (None, 3)], "k string, n int")
    sinks.write_partitioned(df, path, ("k",))
    assert {r.k for r in sinks.committed_partitions(spark, path, ("k",)).collect()} == {"a b/c+d%", "plain", None}
    sinks.write_incremental(df.withColumn("n", F.col("n") + 10), path, ("k",))
    assert sorted(r.n for r in files.scan_mart(spark, path).collect()) == [1, 2, 3]


def test_footers_tell_rows_schemas_and_damage(spark, tmp_path):
    root = str(tmp_path)
    for year, sql in ((2023, "select 1 as a from range(3)"), (2024, "select 2L as a, 'x' as b from range(4)")):
        spark.sql(sql).coalesce(1).write.parquet(files.month_path(root, "green", year, 1))
    (tmp_path / "green" / "2024-02.parquet").write_bytes(b"PAR1 cut off")
    (tmp_path / "green" / "2024-03.parquet").mkdir()
    targets = files.expand_targets([("green", 2023, 1), *[("green", 2024, m) for m in (1, 2, 3, 4)]])
    rows = {(r.year, r.month): r for r in files.month_footers(spark, root, targets).collect()}
    assert (rows[2023, 1].rows, rows[2024, 1].rows) == (3, 4)
    assert [(c.name, c.kind) for c in rows[2024, 1].columns] == [("a", "int64"), ("b", "string")]
    assert rows[2024, 2].error and rows[2024, 2].rows is None
    assert (rows[2024, 3].error, rows[2024, 4].error) == ("no data files", "absent")
    unreadable = []
    green = files.read_months(spark, root, targets, unreadable)["green"]
    assert sorted(m[:3] for m in unreadable) == [("green", 2024, 2), ("green", 2024, 3)]
    assert sorted((r.file_year, r.a, r.b) for r in green.distinct().select("file_year", "a", "b").distinct().collect()) == [(2023, 1, None), (2024, 2, "x")]
    assert green.count() == 7 and dict(green.dtypes)["a"] == "bigint"
    groups = footers.schema_groups(files.month_footers(spark, root, targets).filter("path is not null"))
    assert sorted((r.files, r.rows, r.unreadable) for r in groups.collect() if r["columns"]) == [(1, 3, 0), (1, 4, 0)]


def test_mart_with_drifted_kinds_reads_once_per_schema(spark, tmp_path):
    path = str(tmp_path / "mart")
    kinds = ("int", "bigint", "double")
    for month in range(1, 13):
        spark.range(5).selectExpr(f"cast(id as {kinds[month % 3]}) as n", f"'{month}' as label", f"{month} as month").write.mode("append").partitionBy("month").parquet(path)
    df = files.scan_mart(spark, path)
    assert dict(df.dtypes)["n"] == "double" and df.count() == 60
    assert df._jdf.queryExecution().analyzed().toString().count("parquet") <= len(kinds)
    assert dict(files.scan_mart(spark, path, integers=("n",)).dtypes)["n"] == "bigint"
    assert {r.label for r in files.scan_mart(spark, path, months=[3, 4]).collect()} == {"3", "4"}
    assert files.scan_mart(spark, path, months=[99]).count() == 0
    with open(f"{path}/month=3/broken.parquet", "wb") as out:
        out.write(b"no parquet")
    with pytest.raises(AnalysisException, match="unreadable files"):
        files.scan_mart(spark, path)


def test_file_names_with_pattern_signs(spark, tmp_path):
    path = str(tmp_path / "mart")
    spark.createDataFrame([("a[b]*", 1), ("{c}?", 2), ("x y/%41", 3)], "k string, n int").write.partitionBy("k").parquet(path)
    assert sorted((r.k, r.n) for r in files.scan_mart(spark, path).collect()) == [("a[b]*", 1), ("x y/%41", 3), ("{c}?", 2)]
