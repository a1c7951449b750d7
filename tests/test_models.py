from dataclasses import replace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from hackstand.plans import forecast, forest, kmodes
from hackstand.settings import DEFAULTS


def brute_silhouette(rows, labels):
    x = np.array(rows)
    gaps = (x[:, None, :] != x[None, :, :]).sum(axis=2).astype(float)
    out = []
    for i, own in enumerate(labels):
        same = (labels == own)
        if same.sum() == 1:
            out.append(0.0)
            continue
        a = gaps[i, same].sum() / (same.sum() - 1)
        b = min(gaps[i, labels == c].mean() for c in set(labels) - {own})
        out.append((b - a) / max(a, b) if max(a, b) > 0 else 0.0)
    return float(np.mean(out))


def test_silhouette_equals_all_pairs(spark):
    rng = np.random.default_rng(3)
    raw = [tuple(str(v) for v in r) for r in rng.integers(0, 4, size=(160, 3))]
    df = spark.createDataFrame(raw, "f1 string, f2 string, f3 string")
    combos = df.groupBy("f1", "f2", "f3").agg(F.count(F.lit(1)).alias("w"))
    names = ("f1", "f2", "f3")
    modes = kmodes.initial_modes(combos, names, 3)
    labelled = kmodes.assign(combos, names, modes)
    got = kmodes.silhouette(labelled, names, 3).first()[0]
    by = {tuple(r[:3]): r[kmodes.LABEL] for r in labelled.select(*names, kmodes.LABEL).collect()}
    assert got == pytest.approx(brute_silhouette(raw, np.array([by[r] for r in raw])), abs=1e-12)


def test_kmodes_finds_separate_groups(spark):
    rows = [("a", "a", "a")] * 30 + [("a", "a", "b")] * 5 + [("z", "z", "z")] * 20 + [("z", "y", "z")] * 4
    combos = spark.createDataFrame(rows, "f1 string, f2 string, f3 string").groupBy("f1", "f2", "f3").agg(F.count(F.lit(1)).alias("w"))
    names = ("f1", "f2", "f3")
    found = kmodes.fit(combos, names, kmodes.initial_modes(combos, names, 2))
    assert set(found.modes) == {("a", "a", "a"), ("z", "z", "z")} and found.cost == 9


def plain_kmodes(rows, seeds):
    """Modes and cost by loops over all rows, under the same rules."""
    def nearest(row, modes):
        gaps = [sum(a != b for a, b in zip(row, m)) for m in modes]
        return gaps.index(min(gaps)), min(gaps)

    modes, best = [tuple(m) for m in seeds], None
    while True:
        found = [nearest(r, modes) for r in rows]
        cost = sum(g for _, g in found)
        if best is not None and cost >= best[0]:
            return best[1], best[0]
        best, moved = (cost, modes), []
        for c, mode in enumerate(modes):
            own = [r for r, (x, _) in zip(rows, found) if x == c]
            moved.append(tuple(min(set(v), key=lambda x: (-v.count(x), x)) for v in zip(*own)) if own else mode)
        if moved == modes:
            return best[1], best[0]
        modes = moved


def test_all_services_and_k_equal_plain_kmodes(spark):
    rng = np.random.default_rng(6)
    rows = []
    for service in ("yellow", "fhvhv"):
        names = kmodes.features_of(service)
        for n in range(150):
            group = rng.integers(0, 3)
            rows.append({"service_id": service, "trip_id": len(rows), "year": 2024, "month": 1,
                         **{f: f"{f}{group if rng.random() < 0.8 else rng.integers(0, 4)}" for f in names}})
    columns = ["service_id", "trip_id", "year", "month", *dict.fromkeys([*kmodes.features_of("yellow"), *kmodes.features_of("fhvhv")])]
    df = spark.createDataFrame([tuple(r.get(c) for c in columns) for r in rows], ", ".join(f"{c} {'int' if c in ('trip_id', 'year', 'month') else 'string'}" for c in columns))
    tuned = kmodes.train_all(df, ("yellow", "fhvhv"), replace(DEFAULTS.clusters, max_k=5))
    assert set(tuned) == {"yellow", "fhvhv"}
    for service, found in tuned.items():
        names = kmodes.features_of(service)
        data = [tuple(r[f] for f in names) for r in rows if r["service_id"] == service]
        combos = kmodes.combinations(df, service)
        seeds = kmodes.initial_modes(combos, names, 5)
        assert [x.k for x in found] == [2, 3, 4, 5]
        for x in found:
            modes, cost = plain_kmodes(data, seeds[: x.k])
            assert (list(x.fit.modes), x.fit.cost) == (modes, cost)
            labels = np.array([min(range(x.k), key=lambda c: (sum(a != b for a, b in zip(r, modes[c])), c)) for r in data])
            assert x.silhouette == pytest.approx(brute_silhouette(data, labels), abs=1e-9)
            one = kmodes.fit(combos, names, seeds[: x.k])
            assert (one.modes, one.cost) == (x.fit.modes, x.fit.cost)
        assert kmodes.best_of(found).silhouette == max(x.silhouette for x in found)


def test_hand_worked_tree():
    # root splits feature 0 at 1.0; left leaf at depth 1, right leaf holds 3 points
    tree = {"feature": np.array([0, -1, -1]), "threshold": np.array([1.0, 0, 0]), "left": np.array([1, -1, -1]),
            "right": np.array([2, -1, -1]), "path": np.array([0.0, 1.0, 1.0 + float(forest.mean_path(3))]), "sampled": 4}
    got = forest.isolation(np.array([[0.5], [2.0]]), [tree])
    scale = float(forest.mean_path(4))
    assert got == pytest.approx([2 ** (-1 / scale), 2 ** (-(1 + float(forest.mean_path(3))) / scale)])
    assert float(forest.mean_path(2)) == 1.0 and float(forest.mean_path(1)) == 0.0


def trips(spark, counts):
    """Normal trips of several ratecodes with an outlier first in each."""
    rng, parts = np.random.default_rng(1), []
    for code, n in counts.items():
        pdf = pd.DataFrame(rng.normal(size=(n, len(forest.FEATURES))), columns=forest.FEATURES)
        pdf.iloc[0], pdf.iloc[1, 2] = 40.0, np.nan
        parts.append(pdf.assign(trip_id=np.arange(n) + 10_000 * len(parts), ratecode_id=float("nan") if code is None else float(code)))
    df = spark.createDataFrame(pd.concat(parts).assign(service_id="yellow", year=2024, month=1, is_anomaly_candidate=False))
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in (*forest.FEATURES, "ratecode_id")}).withColumn("ratecode_id", F.col("ratecode_id").cast("int"))


def test_forest_scores_every_trip_and_ranks_the_outlier_first(spark):
    model, scores = forest.train(trips(spark, {1: 400, 2: 50, None: 30}), replace(DEFAULTS.forest, trees=20))
    rows = scores.collect()
    by = {s: [r for r in rows if r.model_status == s] for s in (forest.OK, forest.LOW_ROWS, forest.NO_RATECODE)}
    assert [len(v) for v in by.values()] == [400, 50, 30] and len(rows) == 480
    assert {r.ratecode_id for r in model.trees.collect()} == {1} and {r.ratecode_id for r in by[forest.LOW_ROWS]} == {2}
    assert max(by[forest.OK], key=lambda r: r.anomaly_score).trip_id == 0
    assert sum(r.is_fraud for r in by[forest.OK]) == 20
    assert all(r.anomaly_score is None and r.is_fraud is None for s in (forest.LOW_ROWS, forest.NO_RATECODE) for r in by[s])


def test_draw_is_from_all_rows_and_layout_free(spark):
    settings = replace(DEFAULTS.forest, trees=12, rows_per_tree=64, min_rows=100)
    df = spark.range(40_000).select("id", (F.col("id") % 10 == 0).cast("int").alias("ratecode_id"), *[(F.col("id") + k).cast("double").alias(f) for k, f in enumerate(forest.FEATURES)]).withColumnRenamed("id", "trip_id")
    drawn = [forest.training_rows(d, settings).toPandas().sort_values(["ratecode_id", "tree", "_draw"]) for d in (df, df.repartition(7, "trip_id"))]
    assert np.array_equal(drawn[0][["trip_id", "tree"]].to_numpy(), drawn[1][["trip_id", "tree"]].to_numpy())
    sizes = drawn[0].groupby(["ratecode_id", "tree"]).size()
    assert len(sizes) == 24 and sizes.min() >= 64 and sizes.max() < 220
    own = drawn[0][drawn[0].ratecode_id == 0].groupby("tree").head(64)
    # no pool: twelve draws of 64 from 36,000 rows hardly meet, and lie all over them
    assert own.trip_id.nunique() > 750 and 15_000 < own.trip_id.mean() < 25_000


def plain_walk(trees, point):
    """Mean depth of one point, node by node."""
    depths = []
    for t in trees:
        at = 0
        while t["feature"][at] >= 0:
            at = t["left"][at] if point[t["feature"][at]] <= t["threshold"][at] else t["right"][at]
        depths.append(t["path"][at])
    scale = np.mean([float(forest.mean_path(t["sampled"])) for t in trees])
    return 2.0 ** -(np.mean(depths) / scale)


def test_stored_model_scores_as_a_plain_walk_and_by_shuffle_alike(spark, tmp_path):
    df = trips(spark, {1: 300, 2: 260, 3: 40, None: 5})
    model = forest.train(df, replace(DEFAULTS.forest, trees=8))[0].save(str(tmp_path / "version=1"))
    medians = {r.ratecode_id: r for r in model.medians.collect()}
    trees = {code: [r.asDict() for r in model.trees.collect() if r.ratecode_id == code] for code in (1, 2)}
    got = {r.trip_id: r for r in model.score(df).collect()}
    for r in df.collect():
        point = [r[f] if r[f] is not None else medians[r.ratecode_id][f] for f in forest.FEATURES]
        want = plain_walk(trees[r.ratecode_id], point) if r.ratecode_id in trees else None
        assert got[r.trip_id].isolation == (want if want is None else pytest.approx(want, abs=1e-8))
    imputed = forest.impute_median(df, ["ratecode_id"], forest.FEATURES, model.medians)
    for rows in (1_000_000, 50):
        forest.GROUP_ROWS, kept = rows, forest.GROUP_ROWS
        try:
            shuffled = {r.trip_id: r.isolation for r in forest.raw_scores(imputed, model.trees, most=0).collect()}
        finally:
            forest.GROUP_ROWS = kept
        assert shuffled == {k: r.isolation for k, r in got.items()}
    assert model.registry.count() == 2


def series(hours, level=10.0, borough="Queens"):
    t = pd.date_range("2024-01-01", periods=hours, freq="h")
    return pd.DataFrame({"borough": borough, "service_id": "yellow", "pickup_hour": t, "trip_count": level + t.hour.to_numpy() * 2.0})


def test_forecast_repeats_a_pure_season():
    done = forecast.forecast_one(series(600), replace(DEFAULTS.forecast, min_rows=200, horizon_hours=48))
    held = done[done.holdout]
    assert len(held) == 48 and set(done.model_status) == {"ok"}
    assert np.allclose(held.yhat, held.trip_count, atol=1e-6)
    assert (held.yhat_lower <= held.yhat + 1e-9).all()


def test_forecast_errors_widen_and_future_runs_to_year_end():
    pdf = series(24 * 40)
    pdf["trip_count"] += np.random.default_rng(0).normal(size=len(pdf))
    done = forecast.forecast_one(pdf, replace(DEFAULTS.forecast, min_rows=200, until_year=2024))
    future = done[done.forecast_type == "forecast"]
    assert done.pickup_hour.max() == pd.Timestamp("2024-12-31 23:00") and future.trip_count.isna().all()
    width = (future.yhat_upper - future.yhat_lower).to_numpy()
    assert (np.diff(width) >= -1e-9).all() and width[-1] > width[0]


def test_forecast_short_series_are_skipped_or_fall_back():
    assert set(forecast.forecast_one(series(100), DEFAULTS.forecast).model_status) == {"skipped_low_rows"}
    tiny = replace(DEFAULTS.forecast, min_rows=10, horizon_hours=0)
    assert set(forecast.forecast_one(series(45), tiny).model_status) == {"fallback_order"}


def simulated(n, ar, ma, seed=5, season=24):
    """A series whose first and seasonal difference follows given coefficients, with calendar regressors that matter."""
    rng = np.random.default_rng(seed)
    hours = pd.date_range("2024-01-01", periods=n, freq="h")
    x = forecast.exog(hours, "Queens")
    drift = np.zeros(n)
    drift[season + 1:] = np.diff((x[season:] - x[:-season]) @ np.array([5.0, -3.0, 2.0, 0.0]))
    e, z = rng.normal(size=n), np.zeros(n)
    for t in range(n):
        z[t] = drift[t] + e[t] + sum(v * z[t - k] for k, v in ar.items() if t >= k) + sum(v * e[t - k] for k, v in ma.items() if t >= k)
    y = np.zeros(n)
    for t in range(n):
        y[t] = z[t] + (y[t - 1] if t else 0) + (y[t - season] if t >= season else 0) - (y[t - season - 1] if t > season else 0)
    return y + 1000.0, x, e


def test_moving_average_terms_are_recovered():
    y, x, e = simulated(8000, {1: 0.5}, {1: -0.4, 24: -0.6})
    model = forecast.SeasonalModel(y, x, 24, True, (1,), (1, "season"))
    assert model.phi == pytest.approx([0.5], abs=0.08) and model.theta == pytest.approx([-0.4, -0.6], abs=0.08)
    # rush hours return every day, so the seasonal difference removes them
    assert model.slopes == pytest.approx([5.0, -3.0, 0.0, 0.0], abs=0.6) and model.sigma == pytest.approx(1.0, abs=0.08)
    assert np.corrcoef(model.errors[500:], e[-len(model.errors):][500:])[0, 1] > 0.97
    assert np.allclose(y[60:] - model.fitted(y)[60:], model.errors[60 - 25:])
    chosen, status = forecast._fit(y, x, 24)
    assert status == "ok" and set(chosen.ma) == {1, 24} and chosen.aic <= model.aic


def test_forecast_path_and_errors_equal_a_simulation():
    """The mean path is the recursion without shocks, and a unit shock spreads by the weights behind the standard errors."""
    y, x, _ = simulated(1500, {1: 0.5}, {24: -0.6})
    model = forecast.SeasonalModel(y[:1400], x[:1400], 24, True, (1, "season"), (1, "season"))
    steps = 60

    def run(shock):
        own, errors = list(y[:1400]), list(np.concatenate([np.zeros(25), model.errors]))
        slope = np.concatenate([np.zeros(25), model._difference(x) @ model.slopes])
        z = [0.0] * 25 + list(model._difference(y[:1400]))
        for h in range(steps):
            t = 1400 + h
            errors.append(shock if h == 0 else 0.0)
            z.append(slope[t] + errors[t] + sum(v * z[t - k] for k, v in zip(model.ar, model.phi)) + sum(v * errors[t - k] for k, v in zip(model.ma, model.theta)))
            own.append(z[t] + own[t - 1] + own[t - 24] - own[t - 25])
        return np.array(own[1400:])

    path, error = model.ahead(y[:1400], x[:1400 + steps], steps)
    assert np.allclose(path, run(0.0))
    psi = run(1.0) - run(0.0)
    assert np.allclose(error, model.sigma * np.sqrt(np.cumsum(psi**2)))


def test_model_without_moving_average_is_plain_least_squares():
    y, x, _ = simulated(600, {1: 0.3, 24: -0.2}, {})
    model = forecast.SeasonalModel(y, x, 24, True)
    z, dx = np.diff(y[24:] - y[:-24]), np.diff(x[24:] - x[:-24], axis=0)
    beta, *_ = np.linalg.lstsq(np.column_stack([z[23:-1], z[:-24], dx[24:]]), z[24:], rcond=None)
    assert np.allclose(np.concatenate([model.phi, model.slopes]), beta)
