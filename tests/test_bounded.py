"""Steps whose memory or volume must follow the input: work is dealt by its size and sources are evaluated once."""

from glob import glob

import numpy as np
import pytest

from hackstand import catalog
from hackstand.catalog.tables import open_tables
from hackstand.operators import cleaning, quality
from hackstand.operators.cleaning import TripRoles
from hackstand.plans import forest
from hackstand.session import scratch_root

ROLES = TripRoles(required=("k",), pickup=None, dropoff=None, pu=None, do=None, keys=("k",), scope=("s",))


def plan_of(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_keys_are_dealt_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(quality, "KEYS_PER_TASK", 10)
    df = spark.range(95).selectExpr("id % 2 as s", "cast(if(id < 6, 0, id) as string) as k")
    p = quality.Profile(roles=ROLES, columns=("k",))
    dealt = quality.repeated_rows(df, p, rows=95)
    assert sorted(map(tuple, dealt.collect())) == sorted(map(tuple, quality.repeated_rows(df, p).collect())) == [(0, 48, 3), (1, 47, 3)]
    assert "RepartitionByExpression [s#" in plan_of(dealt) and "], 10" in plan_of(dealt)


def test_report_computes_the_scores_once(spark):
    scored = spark.createDataFrame([("a", "x", 0.5, True), ("a", "y", 1.0, False), ("b", "x", 1.0, True), (None, "x", 1.0, True)],
                                   "s string, dimension string, score double, passed boolean")
    done = quality.report(scored, ["s"])
    assert "Join" not in plan_of(done)
    assert sorted(map(tuple, done.collect())) == [("a", "x", 0.5, True, 0.75, False), ("a", "y", 1.0, False, 0.75, False), ("b", "x", 1.0, True, 1.0, True)]


@pytest.mark.parametrize("name, label", [("mart_conservation", "facts"), ("summary_supply_demand", "facts"), ("join_supply_demand", "ends"),
                                         ("join_scores_features", "fraud"), ("impute_median", "fraud"), ("kmodes_distributions", "clusters"),
                                         ("join_labels_features", "clusters")])
def test_source_is_evaluated_once(spark, name, label):
    """What a query reads more than once comes from one stored copy."""
    before = set(glob(f"{scratch_root(spark)}/{label}-*"))
    done = catalog.load()[name].build(open_tables(spark, "/root/testdata/sf0.001"))
    assert len(set(glob(f"{scratch_root(spark)}/{label}-*")) - before) == 1
    assert "lineitem" not in done._jdf.queryExecution().executedPlan().toString()


def test_hot_buckets_count_the_raw_rows(spark, monkeypatch):
    """Counting needs the key only, and rejected rows of one key are dealt as well."""
    seen, count = [], cleaning.hot_buckets
    monkeypatch.setattr(cleaning, "hot_buckets", lambda df, roles: seen.append((df.columns, count(df, roles))) or seen[-1][1])
    rows = spark.range(4000).selectExpr("if(id < 1000, null, id) as k", "1 as s", "id as amount", "'f' as _file", "id as _row")
    zones = spark.createDataFrame([(1,)], "LocationID int")
    roles = TripRoles(required=("k",), pickup=None, dropoff=None, pu=None, do=None, keys=("k",), prefer=("amount",), scope=("s",))
    out = cleaning.tag_rejects(rows, zones, roles, dedup_after_rejects=True).groupBy(cleaning.REASON).count().collect()
    assert sorted((r[0] or "", r[1]) for r in out) == [("", 3000), ("incomplete_k", 1000)]
    assert seen[0][0] == rows.columns and len(seen[0][1]) == 1


def test_scoring_sends_features_alone_to_python(spark):
    rng = np.random.default_rng(5)
    points = np.round(rng.lognormal(size=(300, len(forest.FEATURES))), 3)
    df = spark.createDataFrame([(i, 1 + i % 3, "x" * 9, *map(float, p)) for i, p in enumerate(points)],
                               "trip_id long, ratecode_id int, note string, " + ", ".join(f"{c} double" for c in forest.FEATURES))
    trees = forest.fit(df.filter("ratecode_id < 3"), forest.ForestSettings(trees=7, min_rows=20)).localCheckpoint()
    scored = forest.raw_scores(df, trees)
    assert scored.columns == [*df.columns, "isolation"] and "MapInPandas" not in scored._jdf.queryExecution().executedPlan().toString()
    model = {k: forest.unpack(g) for k, g in trees.toPandas().groupby("ratecode_id")}
    for r in scored.collect():
        assert (r.isolation is None) == (r.ratecode_id == 3)
        if r.isolation is not None:
            paths = []
            for t in model[r.ratecode_id]:
                node = 0
                while t["feature"][node] >= 0:
                    node = t["left" if points[r.trip_id][t["feature"][node]] <= t["threshold"][node] else "right"][node]
                paths.append(t["path"][node])
            scale = np.mean([forest.mean_path(t["sampled"]) for t in model[r.ratecode_id]])
            assert r.isolation == pytest.approx(2.0 ** -(np.mean(paths) / scale), abs=2e-9)


def test_trips_stay_where_they_are_when_trees_draw(spark):
    df = spark.range(500).selectExpr("id as trip_id", "cast(id % 2 as int) as ratecode_id", *[f"cast(id as double) as {c}" for c in forest.FEATURES])
    drawn = forest.training_rows(df, forest.ForestSettings(trees=3, min_rows=20))
    assert "Exchange hashpartitioning" not in drawn._jdf.queryExecution().executedPlan().toString()
    assert drawn.select("ratecode_id", "tree").distinct().count() == 6


@pytest.mark.parametrize("name", ["join_labels_features", "kmodes_distributions"])
def test_labels_meet_features_by_shuffle(spark, name):
    """Both sides have a row per trip: neither may be sent through the driver because its file of short codes looks small."""
    done = catalog.load()[name].build(open_tables(spark, "/root/testdata/sf0.001"))
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [trip_id" not in plan and "SortMergeJoin [trip_id" in plan
