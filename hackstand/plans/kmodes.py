"""K-Modes on categorical trip features.

Trips with equal features are one weighted row: the clustering of the distinct
combinations is the clustering of all trips, on a table that stays small. Every step is a
grouping of that table; the driver only holds the modes (k rows).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hackstand import fixed_values as fv
from hackstand.functions.numeric import percent
from hackstand.operators.ranking import group_share
from hackstand.operators.selection import top_n_per_group
from hackstand.session import by_shuffle, materialise
from hackstand.settings import DEFAULTS, ClusterSettings

LABEL = "cluster_id"


@dataclass(frozen=True)
class Fit:
    features: tuple[str, ...]
    modes: tuple[tuple[str, ...], ...]
    cost: int
    iterations: int


def features_of(service: str) -> tuple[str, ...]:
    return fv.APP_CLUSTER_FEATURES if service == "fhvhv" else fv.TAXI_CLUSTER_FEATURES


def combinations(store: DataFrame, service: str) -> DataFrame:
    """Distinct feature combinations of one service with their number of trips."""
    names = features_of(service)
    rows = store.filter(F.col("service_id") == service).dropna(subset=list(names))
    return rows.groupBy(*names).agg(F.count(F.lit(1)).alias("w"))


def distance(features, mode) -> Column:
    return reduce(lambda a, b: a + b, [F.when(F.col(f) == v, 0).otherwise(1) for f, v in zip(features, mode)])


def nearest(features, modes) -> Column:
    """Index of the closest mode; the first one wins ties."""
    gaps = F.array(*[distance(features, m) for m in modes])
    return (F.array_position(gaps, F.array_min(gaps)) - 1).cast("int")


def assign(df: DataFrame, features, modes) -> DataFrame:
    """Label rows without NULL features; no join, the modes are part of the expression."""
    complete = reduce(Column.__and__, [F.col(f).isNotNull() for f in features])
    return df.withColumn(LABEL, F.when(complete, nearest(features, modes)))


def with_density(combos: DataFrame, features) -> DataFrame:
    """How common the values of each combination are, as a sum of value frequencies."""
    out = combos
    for f in features:
        out = out.join(combos.groupBy(f).agg(F.sum("w").alias(f"_d_{f}")), f)
    density = reduce(lambda a, b: a + b, [F.col(f"_d_{f}") for f in features])
    return out.withColumn("_density", density).select(*features, "w", "_density")


def initial_modes(combos: DataFrame, features, k: int) -> list[tuple[str, ...]]:
    """Density-first seeds: dense combinations that lie far from the seeds so far."""
    dense = with_density(combos, features)
    seeds: list[tuple[str, ...]] = []
    while len(seeds) < k:
        gap = F.array_min(F.array(*[distance(features, s) for s in seeds])) if seeds else F.lit(1)
        best = dense.orderBy((gap * F.col("_density")).desc(), *features).limit(1).select(*features).collect()
        if not best or tuple(best[0]) in seeds:
            break
        seeds.append(tuple(best[0]))
    return seeds


def value_weights(labelled: DataFrame, features) -> DataFrame:
    """Trips per cluster, feature and value."""
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("value")) for f in features])
    return labelled.select(LABEL, "w", F.inline(pairs)).groupBy(LABEL, "feature", "value").agg(F.sum("w").alias("n"))


def step(combos: DataFrame, features, modes) -> tuple[list[tuple[str, ...]], int]:
    """Assign all combinations and take the modes of the clusters; returns the cost before."""
    old = F.coalesce(*[
        F.when((F.col(LABEL) == i) & (F.col("feature") == f), F.lit(v))
        for i, mode in enumerate(modes) for f, v in zip(features, mode)
    ])
    found = value_weights(assign(combos, features, modes), features).groupBy(LABEL, "feature").agg(
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("value"),
        F.sum(F.when(F.col("value") != old, F.col("n")).otherwise(0)).alias("missed"),
    ).collect()
    new = {(r[LABEL], r["feature"]): r["value"] for r in found}
    moved = [tuple(new.get((i, f), v) for f, v in zip(features, mode)) for i, mode in enumerate(modes)]
    return moved, sum(r["missed"] for r in found)


def fit(combos: DataFrame, features, seeds) -> Fit:
    """Alternate assignment and modes until the cost is flat; it falls with every round, so there is an end."""
    modes, best, rounds = list(seeds), None, 0
    while True:
        moved, cost = step(combos, features, modes)
        rounds += 1
        if best is None or cost < best[0]:
            best = (cost, modes)
        elif moved != modes:
            return Fit(tuple(features), tuple(best[1]), int(best[0]), rounds)
        if moved == modes:
            return Fit(tuple(features), tuple(best[1]), int(best[0]), rounds)
        modes = moved


def silhouette(labelled: DataFrame, features, k: int) -> DataFrame:
    """Exact mean silhouette over all trips, without comparing pairs.

    With matching distance, the distances from a row to a whole cluster add up per feature
    to (cluster size - members sharing the row's value), so value counts are enough.
    """
    cells = [F.sum(F.when(F.col(LABEL) == c, F.col("w")).otherwise(0)).alias(f"_n{c}") for c in range(k)]
    sizes = labelled.agg(*cells).first()
    out = labelled
    for f in features:
        out = out.join(labelled.groupBy(f).agg(*[
            F.sum(F.when(F.col(LABEL) == c, F.col("w")).otherwise(0)).alias(f"_{f}_{c}") for c in range(k)]), f)
    away = [F.lit(len(features) * sizes[c]) - reduce(lambda a, b: a + b, [F.col(f"_{f}_{c}") for f in features])
            for c in range(k)]
    own_size = F.coalesce(*[F.when(F.col(LABEL) == c, F.lit(sizes[c])) for c in range(k)])
    own = F.coalesce(*[F.when(F.col(LABEL) == c, away[c]) for c in range(k)])
    other = F.array_min(F.array(*[
        F.when(F.col(LABEL) != c, away[c] / float(sizes[c])) if sizes[c] else F.lit(None).cast("double") for c in range(k)]))
    a = F.when(own_size > 1, own / (own_size - 1).cast("double"))
    width = F.when((own_size > 1) & (F.greatest(a, other) > 0), (other - a) / F.greatest(a, other)).otherwise(0.0)
    return out.agg((F.sum(width * F.col("w")) / F.sum("w")).alias("silhouette"))


# ---- all services and numbers of clusters in one plan per round ----

@dataclass(frozen=True)
class Tuned:
    """One fitted number of clusters of one service."""

    service: str
    k: int
    fit: Fit
    silhouette: float


def all_combinations(store: DataFrame, services) -> DataFrame:
    """service_id, values (in the order of the service's features), w of every distinct combination."""
    parts = [combinations(store, s).select(F.lit(s).alias("service_id"), F.array(*features_of(s)).alias("values"), "w") for s in services]
    return reduce(DataFrame.unionByName, parts)


def _gap(values: Column, mode: Column) -> Column:
    return F.size(F.filter(F.zip_with(values, mode, lambda a, b: a != b), lambda x: x))


def all_seeds(combos: DataFrame, k: int) -> dict[str, list[tuple[str, ...]]]:
    """Density-first seeds of every service, one job per seed for all services."""
    cells = combos.select("service_id", "values", "w", F.posexplode("values").alias("pos", "value"))
    common = cells.groupBy("service_id", "pos", "value").agg(F.sum("w").alias("n"))
    dense = materialise(cells.join(common, ["service_id", "pos", "value"]).groupBy("service_id", "values").agg(F.sum("n").alias("density")), "dense")
    seeds: dict[str, list[tuple[str, ...]]] = {}
    for _ in range(k):
        known = F.coalesce(*[F.when(F.col("service_id") == s, F.array_min(F.array(*[_gap(F.col("values"), F.array(*map(F.lit, m))) for m in modes]))) for s, modes in seeds.items()],
                           F.lit(1))
        best = top_n_per_group(dense.withColumn("_far", known * F.col("density")), ["service_id"], [F.col("_far").desc(), F.col("values")], 1).collect()
        fresh = [(r["service_id"], tuple(r["values"])) for r in best if tuple(r["values"]) not in seeds.get(r["service_id"], [])]
        if not fresh:
            break
        for service, seed in fresh:
            seeds.setdefault(service, []).append(seed)
    return seeds


def _labelled(combos: DataFrame, modes: dict[tuple[str, int], list]) -> DataFrame:
    """Every combination once per model of its service, with its cluster and its distance. The models are a few rows."""
    models = combos.sparkSession.createDataFrame([(s, k, [list(m) for m in found]) for (s, k), found in modes.items()], "service_id string, k int, modes array<array<string>>")
    gaps = combos.join(F.broadcast(models), "service_id").withColumn("_gaps", F.transform("modes", lambda m: _gap(F.col("values"), m)))
    return gaps.withColumn("gap", F.array_min("_gaps")).withColumn(LABEL, (F.array_position("_gaps", F.col("gap")) - 1).cast("int")).drop("_gaps", "modes")


def _round(combos: DataFrame, modes: dict[tuple[str, int], list]) -> tuple[dict, dict]:
    """The modes of the clusters that ``modes`` make, and the cost of ``modes``, for all models."""
    cells = _labelled(combos, modes).select("service_id", "k", LABEL, "w", "gap", F.posexplode("values").alias("pos", "value"))
    counts = cells.groupBy("service_id", "k", LABEL, "pos", "value").agg(F.sum("w").alias("n"), F.sum(F.col("w") * F.col("gap")).alias("cost"))
    # models x clusters x features rows
    tops = counts.groupBy("service_id", "k", LABEL, "pos").agg(F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("value"), F.sum("cost").alias("cost")).collect()
    moved, cost = {m: [list(x) for x in found] for m, found in modes.items()}, dict.fromkeys(modes, 0)
    for r in tops:
        moved[r["service_id"], r["k"]][r[LABEL]][r["pos"]] = r["value"]
        cost[r["service_id"], r["k"]] += r["cost"] if r["pos"] == 0 else 0
    return {m: [tuple(x) for x in found] for m, found in moved.items()}, cost


def all_fits(combos: DataFrame, seeds: dict[tuple[str, int], list]) -> dict[tuple[str, int], Fit]:
    """Every model to its end; a round works on those whose cost still falls."""
    open_, best, done, rounds = dict(seeds), {}, {}, 0
    while open_:
        moved, cost = _round(combos, open_)
        rounds += 1
        for m in list(open_):
            better = m not in best or cost[m] < best[m][0]
            if better:
                best[m] = (cost[m], open_[m])
            if not better or moved[m] == open_[m]:
                done[m] = Fit(tuple(features_of(m[0])), tuple(best[m][1]), int(best[m][0]), rounds)
        open_ = {m: moved[m] for m in open_ if m not in done}
    return done


def all_silhouettes(combos: DataFrame, fits: dict[tuple[str, int], Fit]) -> dict[tuple[str, int], float]:
    """Exact mean silhouette of every model over all trips from value counts (see ``silhouette``), in one plan."""
    most = max(k for _, k in fits)
    rows = _labelled(combos, {m: list(f.modes) for m, f in fits.items()})
    model, clusters = ["service_id", "k"], range(most)
    share = lambda name: [F.sum(F.when(F.col(LABEL) == c, F.col("w")).otherwise(0)).alias(f"_{name}{c}") for c in clusters]
    cells = rows.select(*model, LABEL, "w", "values", F.posexplode("values").alias("pos", "value"))
    same = cells.join(cells.groupBy(*model, "pos", "value").agg(*share("m")), [*model, "pos", "value"]).groupBy(*model, LABEL, "w", "values").agg(
        *[F.sum(f"_m{c}").alias(f"_m{c}") for c in clusters])
    wide = same.join(rows.groupBy(*model).agg(*share("n")), model)
    width = F.size("values")
    away = [width * F.col(f"_n{c}") - F.col(f"_m{c}") for c in clusters]
    own_size, own = (F.coalesce(*[F.when(F.col(LABEL) == c, x[c]) for c in clusters]) for x in ([F.col(f"_n{c}") for c in clusters], away))
    other = F.array_min(F.array(*[F.when((F.col(LABEL) != c) & (F.col(f"_n{c}") > 0), away[c] / F.col(f"_n{c}").cast("double")) for c in clusters]))
    a = F.when(own_size > 1, own / (own_size - 1).cast("double"))
    value = F.when((own_size > 1) & (F.greatest(a, other) > 0), (other - a) / F.greatest(a, other)).otherwise(0.0)
    used = reduce(lambda x, y: x + y, [(F.max(f"_n{c}") > 0).cast("int") for c in clusters])
    found = wide.groupBy(*model).agg((F.sum(value * F.col("w")) / F.sum("w")).alias("s"), used.alias("used")).collect()
    return {(r["service_id"], r["k"]): float(r["s"]) if r["used"] > 1 else -1.0 for r in found}


def train_all(store: DataFrame, services=fv.PRICED_SERVICES, settings: ClusterSettings = DEFAULTS.clusters) -> dict[str, list[Tuned]]:
    """Every number of clusters from 2 to ``max_k`` of every service, fitted to its end; seeds for k are a prefix of the next ones."""
    combos = materialise(all_combinations(store, services), "combos")
    seeds = all_seeds(combos, settings.max_k)
    fits = all_fits(combos, {(s, k): found[:k] for s, found in seeds.items() for k in range(2, len(found) + 1)})
    scores = all_silhouettes(combos, fits) if fits else {}
    return {s: [Tuned(s, k, fits[s, k], scores[s, k]) for k in range(2, len(found) + 1)] for s, found in seeds.items()}


def best_of(tuned: list[Tuned]) -> Tuned:
    """The first strictly best silhouette."""
    return max(tuned, key=lambda x: (x.silhouette, -x.k))


def labels(store: DataFrame, service: str, modes) -> DataFrame:
    """Cluster of every trip of the service that has all features, not of a sample."""
    names = features_of(service)
    rows = assign(store.filter(F.col("service_id") == service), names, modes)
    return rows.filter(F.col(LABEL).isNotNull()).select("trip_id", "service_id", "year", "month", LABEL)


def sizes(labelled: DataFrame) -> DataFrame:
    return labelled.groupBy(LABEL).agg(F.count(F.lit(1)).alias("count"))


def centers(labelled: DataFrame, features) -> DataFrame:
    """Size and mode of each cluster of labelled, weighted combinations."""
    tops = profiles(labelled, features)
    size = labelled.groupBy(LABEL).agg(F.sum("w").alias("n_rows"))
    wide = tops.groupBy(LABEL).agg(*[F.max(F.when(F.col("feature") == f, F.col("top_value"))).alias(f) for f in features])
    return size.join(wide, LABEL)


def profiles(labelled: DataFrame, features) -> DataFrame:
    """Most frequent value, its share and the number of values per cluster and feature."""
    by = value_weights(labelled, features).groupBy(LABEL, "feature").agg(
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("top_value"),
        F.max("n").alias("_top"), F.sum("n").alias("_all"), F.count(F.lit(1)).alias("n_unique"))
    return by.select(LABEL, "feature", "top_value", percent(F.col("_top"), F.col("_all")).alias("top_pct"), "n_unique")


def with_features(labelled: DataFrame, store: DataFrame, features) -> DataFrame:
    """Labels with features of the store. Both sides have a row per trip, however small their files look, and meet by shuffle."""
    return labelled.select("trip_id", LABEL).join(by_shuffle(store.select("trip_id", *features)), "trip_id")


def distributions(labelled: DataFrame, store: DataFrame, features) -> DataFrame:
    """Value counts and shares per cluster, from labels joined to the feature store."""
    rows = with_features(labelled, store, features)
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.coalesce(F.col(f), F.lit("N/A")).alias("value")) for f in features])
    counts = rows.select(LABEL, F.inline(pairs)).groupBy(LABEL, "feature", "value").agg(F.count(F.lit(1)).alias("count"))
    return group_share(counts, [LABEL, "feature"], "count")


def counts_per_cluster(labelled: DataFrame) -> DataFrame:
    """Events per cluster for a live panel."""
    return labelled.groupBy(F.concat(F.lit("Cluster "), F.col(LABEL).cast("string")).alias("name")).agg(
        F.count(F.lit(1)).alias("count"))
