import json

from pyspark.sql import functions as F

from hackstand.session import scratch_path
from hackstand.streaming import expiry, live, rides, sinks

def now():
    return F.lit("2024-01-10 00:00:00").cast("timestamp")



def event(**change):
    base = dict(service_id="yellow", pickup_datetime="2024-01-05T08:10:00", dropoff_datetime="2024-01-05T08:40:00",
                pu_location_id=1, do_location_id=2, vendor_id=1, payment_type_id=1, fare_amount=10.0, tip_amount=1.5,
                total_amount=12.0, trip_distance=3.0)
    return {k: v for k, v in {**base, **change}.items() if v is not None}


def zones(spark):
    return spark.createDataFrame([(1, "A", "a"), (2, "B", "b")], "LocationID int, Borough string, Zone string")


def reason_of(spark, line):
    lines = spark.createDataFrame([(line if isinstance(line, str) else json.dumps(line),)], "value string")
    return rides.judge(rides.parse_events(lines), zones(spark), now()).first()[rides.REASON]


def test_event_rules(spark):
    cases = [
        (event(), None), (event(vendor_id=None), "incomplete_vendor_id"), (event(service_id="fhv", vendor_id=None), None),
        (event(service_id="fhvhv"), "incomplete_hvfhs_license_num"), (event(service_id="limo", pu_location_id=None), None),
        (event(pickup_datetime="2023-11-01T00:00:00"), "timeliness_window"),
        (event(pickup_datetime="2024-01-12T00:00:00", dropoff_datetime=None), "timeliness_window"),
        (event(dropoff_datetime="2024-01-05T08:00:00"), "datetime_inverted"), (event(dropoff_datetime=None), None),
        (event(pu_location_id=99), "integrity_invalid_pu_location_id"), (event(do_location_id=99), "integrity_invalid_do_location_id"),
        ("not json", "incomplete_service_id"),
    ]
    assert [reason_of(spark, e) for e, _ in cases] == [r for _, r in cases]


def write_files(spark, tmp_path, batches):
    folder = tmp_path / "events"
    folder.mkdir()
    for i, batch in enumerate(batches):
        (folder / f"{i}.json").write_text("\n".join(json.dumps(e) for e in batch))
    return str(folder)


def test_stream_over_several_batches_equals_batch(spark, tmp_path):
    batches = [
        [event(), event(), event(vendor_id=2), event(pu_location_id=99)],
        [event(), event(pickup_datetime="2024-01-05T09:00:00", dropoff_datetime="2024-01-05T09:30:00")],
        [event(vendor_id=3), event(service_id="fhvhv", hvfhs_license_num="HV3", base_passenger_fare=20.0, tips=2.0, trip_miles=4.0)],
    ]
    folder = write_files(spark, tmp_path, batches)

    def accepted(lines):
        judged = rides.judge(rides.parse_events(lines), zones(spark), now())
        return rides.enrich(judged.filter(F.col(rides.REASON).isNull()).drop(rides.REASON), zones(spark))

    stored = sinks.run_append(rides.first_delivery(accepted(rides.stream_source(spark, folder, files_per_trigger=1))), "rides")
    batch = rides.first_delivery(accepted(spark.read.text(folder)))
    assert stored.count() == batch.count() == 5
    path = scratch_path(spark, "again")
    for part in stored.repartition(3).randomSplit([0.5, 0.5], 1):
        part.write.mode("append").parquet(path)
    for name, view in live.VIEWS.items():
        stream = spark.readStream.schema(stored.schema).option("maxFilesPerTrigger", 1).parquet(path)
        got = sinks.run_upsert(view(stream), live.KEYS[name], name)
        want = view(batch)
        assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect())), name


def test_batch_wins_and_keys_compare_by_type_and_null(spark):
    batch = spark.sql("select 'y' as service_id, date'2024-01-01' as fecha_viaje, 1 as pickup_hour, cast(null as int) as pu_location_id, 10L as viajes")
    rows = [("y", "2024-01-01", 1, None, 3), ("y", "2024-01-01", 2, None, 4)]
    lively = spark.createDataFrame(rows, "service_id string, fecha_viaje string, pickup_hour int, pu_location_id int, viajes long")
    merged = live.merge(batch, lively, live.KEYS["demand"]).orderBy("pickup_hour").collect()
    assert [(r.viajes, r.origen) for r in merged] == [(10, "batch"), (4, "realtime")]


def test_increments_give_each_key_once(spark, tmp_path):
    for batch, rows in enumerate([[("a", 1), ("b", 1)], [("a", 2)], [("a", 3), ("c", 1)]]):
        spark.createDataFrame(rows, "k string, n int").write.parquet(f"{tmp_path}/live/{sinks.BATCH}={batch}")
    got = sinks.increments(spark, f"{tmp_path}/live", ["k"], 0)
    assert sorted((r.k, r.n) for r in got.collect()) == [("a", 3), ("c", 1)]


def feed_and_drain(spark, tmp_path, slices, measures=None, **options):
    """Each slice arrives as a file and is one run of the stream from its checkpoint."""
    feed, out = str(tmp_path / "feed"), str(tmp_path / "out")
    for rows in slices:
        df = spark.createDataFrame([(k, t, n) for k, t, n in rows], "k string, s string, n int").select("k", "n", F.to_timestamp("s").alias("t"))
        df.write.mode("append").parquet(feed)
        stream = expiry.accumulate(spark.readStream.schema(df.schema).parquet(feed), ["k"], "t", {"sum": F.col("n"), "count": F.lit(1)})
        sinks.upsert_table(stream, out, f"{out}-checkpoint", keys=["k", expiry.FROM], **options).awaitTermination()
    return out


def test_state_expires_after_its_last_event(spark, tmp_path):
    out = feed_and_drain(spark, tmp_path, [
        [("a", "2024-01-01 00:00:00", 1), ("a", "2024-01-02 00:00:00", 2), ("b", "2024-01-02 12:00:00", 5), (None, "2024-01-02 12:00:00", 7)],
        [("a", "2024-01-03 23:59:59", 4), ("c", "2024-01-04 12:00:00", 1)],  # a lives on; the clock stands just at the end of b
        [("c", "2024-01-04 12:00:01", 1), ("b", "2024-01-03 00:00:00", 100)],  # b's event is too late and changes nothing
        [("b", "2024-01-05 00:00:00", 9), ("a", "2024-01-09 00:00:00", 1), ("a", "2024-01-20 00:00:00", 3)],  # anew from zero
    ])
    got = sorted((str(r.k), r["sum"], r["count"], str(r.desde)[:10], str(r.hasta), r.expirado) for r in sinks.latest(spark, out, ["k", "desde"]).collect())
    assert got == sorted([
        ("None", 7, 1, "2024-01-02", "2024-01-02 12:00:00", True),
        ("a", 7, 3, "2024-01-01", "2024-01-03 23:59:59", True), ("a", 1, 1, "2024-01-09", "2024-01-09 00:00:00", True), ("a", 3, 1, "2024-01-20", "2024-01-20 00:00:00", False),
        ("b", 5, 1, "2024-01-02", "2024-01-02 12:00:00", True), ("b", 9, 1, "2024-01-05", "2024-01-05 00:00:00", True),
        ("c", 2, 2, "2024-01-04", "2024-01-04 12:00:01", True)])
    left = spark.read.format("statestore").load(f"{out}-checkpoint").select("key._key").collect()
    assert [json.loads(r["_key"]) for r in left] == [{"k": "a"}]  # of seven accumulators one is still in the state


def test_expired_accumulators_leave_the_table(spark, tmp_path):
    days = [[(f"k{d}", f"2024-01-{d:02d} 00:00:00", 1)] for d in range(1, 13)]
    out = feed_and_drain(spark, tmp_path, days, compact_every=3, keep=expiry.living)
    assert {r.k for r in expiry.living(sinks.latest(spark, out, ["k", "desde"])).collect()} == {"k10", "k11", "k12"}
    bases = sinks._committed(spark, f"{out}/base", "upto")
    assert spark.read.parquet(bases[max(bases)]).count() <= 5


def write_batch(spark, path, n, rows):
    spark.createDataFrame(rows, "k string, n int").write.mode("overwrite").parquet(f"{path}/{sinks.BATCH}={n}")


def test_compaction_bounds_folders_and_keeps_increments_exact(spark, tmp_path):
    path, want, changed = str(tmp_path / "live"), {}, {}
    for n in range(50):
        rows = [(f"k{n % 7}", n), (f"x{n}" if n % 10 == 0 else "hot", n)]
        write_batch(spark, path, n, rows)
        for k, v in rows:
            want[k], changed[k] = v, n
        if n % 5 == 4:
            sinks.compact(spark, path, ["k"], n)
            assert len(sinks._committed(spark, path, sinks.BATCH)) <= 10 and len(sinks._committed(spark, f"{path}/base", "upto")) <= 2
    assert {r.k: r.n for r in sinks.latest(spark, path, ["k"]).collect()} == want
    for after in (-1, 0, 17, 30, 44, 47, 49):  # also from before the newest base
        assert {r.k: r.n for r in sinks.increments(spark, path, ["k"], after).collect()} == {k: v for k, v in want.items() if changed[k] > after}


def test_crash_during_compaction_loses_nothing(spark, tmp_path):
    import os

    path = str(tmp_path / "live")
    for n in range(4):
        write_batch(spark, path, n, [("a", n), (f"b{n}", n)])
    sinks.compact(spark, path, ["k"], 1)
    half = f"{path}/base/upto=3"  # a base without its mark: the job ended before it was committed
    spark.createDataFrame([("a", 99, 3)], "k string, n int, _batch long").write.parquet(half)
    os.remove(f"{half}/_SUCCESS")
    want = {"a": 3, "b0": 0, "b1": 1, "b2": 2, "b3": 3}
    assert {r.k: r.n for r in sinks.latest(spark, path, ["k"]).collect()} == want
    sinks.compact(spark, path, ["k"], 3)  # the batch runs again
    assert {r.k: r.n for r in sinks.latest(spark, path, ["k"]).collect()} == want
    write_batch(spark, path, 4, [("a", 4)])
    os.remove(f"{path}/{sinks.BATCH}=4/_SUCCESS")  # a batch that has not ended does not show
    assert {r.k: r.n for r in sinks.latest(spark, path, ["k"]).collect()} == want


def test_batch_dedup_has_the_window_and_the_order_of_the_stream(spark):
    rows = [("a", "2024-01-01 00:00:00", 5), ("a", "2024-01-01 00:00:00", 2), ("a", "2024-01-02 12:00:00", 1), ("a", "2024-01-04 12:00:00", 3),
            ("a", "2024-01-06 12:00:01", 4), ("b", "2024-01-01 00:00:00", 9)]
    df = spark.createDataFrame(rows, "trip_id string, s string, event_id int").select("trip_id", "event_id", F.to_timestamp("s").alias("pickup_datetime"))
    assert sorted(r.event_id for r in rides.first_delivery(df).collect()) == [2, 4, 9]
