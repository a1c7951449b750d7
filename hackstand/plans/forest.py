"""Isolation forest per ratecode.

Every tree draws its rows from all trips of its ratecode and grows in a task of its own (``applyInPandas``). The model is a table:
trees, medians, cuts and a registry, written once and loaded by whoever scores. All trips are scored, against broadcast trees while
these are few, else beside the trees of their ratecode in groups of bounded size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hackstand import fixed_values as fv
from hackstand.functions.numeric import count_where, exact_avg, exact_sum, half_up, percent
from hackstand.operators.quantiles import exact_quantile, exact_quantiles, group_medians, impute_median
from hackstand.operators.selection import page, sample_cap
from hackstand.session import materialise
from hackstand.settings import DEFAULTS, ForestSettings

FEATURES = list(fv.FRAUD_FEATURES)
TREE_SCHEMA = ("ratecode_id int, tree int, sampled int, feature array<int>, threshold array<double>, left array<int>, "
               "right array<int>, path array<double>")
EULER = 0.5772156649015329
#: Nodes that are broadcast (about 28 bytes each, 112 MB); a larger forest meets its trips by a shuffle.
BROADCAST_NODES = 4_000_000
#: Trips of one ratecode that meet a larger forest in one task.
GROUP_ROWS = 1_000_000
#: Columns of a trip that its score row keeps.
SCORED = ("trip_id", "ratecode_id", "service_id", "year", "month", "is_anomaly_candidate")
OK, LOW_ROWS, NO_RATECODE = "ok", "skipped_low_rows", "skipped_no_ratecode"


def mean_path(n) -> np.ndarray:
    """Mean path length of an unsuccessful search among n points."""
    n = np.asarray(n, dtype=float)
    out = np.where(n == 2, 1.0, 0.0)
    big = n > 2
    m = np.where(big, n, 3.0)
    return np.where(big, 2.0 * (np.log(m - 1.0) + EULER) - 2.0 * (m - 1.0) / m, out)


def grow_tree(points: np.ndarray, rng: np.random.Generator, depth_limit: int) -> list[tuple]:
    """Random axis splits; leaves store their depth plus the expected depth below them."""
    nodes: list[tuple] = []
    pending = [(np.arange(len(points)), 0, None, None)]
    while pending:
        rows, depth, parent, side = pending.pop()
        at = len(nodes)
        if parent is not None:
            link = list(nodes[parent])
            link[3 if side == 0 else 4] = at
            nodes[parent] = tuple(link)
        low, high = points[rows].min(axis=0), points[rows].max(axis=0)
        usable = np.flatnonzero(high > low)
        if depth >= depth_limit or len(rows) <= 1 or len(usable) == 0:
            nodes.append((at, -1, 0.0, -1, -1, depth + float(mean_path(len(rows)))))
            continue
        feature = int(rng.choice(usable))
        cut = float(rng.uniform(low[feature], high[feature]))
        goes_left = points[rows, feature] <= cut
        nodes.append((at, feature, cut, -1, -1, 0.0))
        pending.append((rows[~goes_left], depth + 1, at, 1))
        pending.append((rows[goes_left], depth + 1, at, 0))
    return nodes


def training_rows(features: DataFrame, settings: ForestSettings) -> DataFrame:
    """Rows for every (ratecode, tree) drawn from all trips of the ratecode: those with the smallest tickets.

    A trip has one ticket per tree, by hash. Per ratecode, tickets under a bound are kept that lets through some more than a tree
    takes; the rest falls away in the task that reads the trip, so only the drawn rows move. A first look sees hash and bound alone,
    and only trips that some tree draws cross into Python whole.
    """
    counts = features.filter(F.col("ratecode_id").isNotNull()).groupBy("ratecode_id").agg(F.count(F.lit(1)).alias("_n"))
    # written first, so that Catalyst knows how few they are: else all trips would be shuffled into a task per ratecode to meet them
    sizes = materialise(counts.filter(F.col("_n") >= settings.min_rows), "sizes")
    slack = settings.rows_per_tree + 8.0 * math.sqrt(settings.rows_per_tree) + 8.0
    rows = features.join(sizes, "ratecode_id").select(
        "ratecode_id", "trip_id", *FEATURES, F.xxhash64(F.lit(settings.seed), "trip_id").alias("_hash"), (F.lit(slack) / F.col("_n")).alias("_bound"))
    trees = settings.trees

    @F.pandas_udf("boolean")
    def drawn(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for hashes, bound in batches:
            yield pd.Series((tickets(hashes.to_numpy(np.int64), trees) < bound.to_numpy()[:, None]).any(axis=1))

    def draw(batches):
        for pdf in batches:
            ticket = tickets(pdf["_hash"].to_numpy(np.int64), trees)
            row, tree = np.nonzero(ticket < pdf["_bound"].to_numpy()[:, None])
            yield pdf.iloc[row].drop(columns=["_hash", "_bound"]).assign(tree=tree.astype(np.int32), _draw=ticket[row, tree])

    schema = rows.drop("_hash", "_bound").schema.add("tree", T.IntegerType()).add("_draw", T.DoubleType())
    return rows.filter(drawn("_hash", "_bound")).mapInPandas(draw, schema)


def tickets(hashes: np.ndarray, trees: int) -> np.ndarray:
    """Uniform numbers in [0, 1), fixed by row and tree."""
    with np.errstate(over="ignore"):
        x = hashes.view(np.uint64)[:, None] + (np.arange(trees, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return (x >> np.uint64(11)).astype(np.float64) / float(1 << 53)


def fit(imputed: DataFrame, settings: ForestSettings = DEFAULTS.forest) -> DataFrame:
    """One row per tree, its nodes as arrays."""
    rows, seed = settings.rows_per_tree, settings.seed

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_draw", "trip_id"]).head(rows)
        ratecode, tree = int(pdf["ratecode_id"].iloc[0]), int(pdf["tree"].iloc[0])
        rng = np.random.default_rng([seed, ratecode & 0xFFFFFFFF, tree])
        limit = max(1, math.ceil(math.log2(max(len(pdf), 2))))
        _, feature, threshold, left, right, path = map(list, zip(*grow_tree(pdf[FEATURES].to_numpy(dtype=float), rng, limit)))
        return pd.DataFrame({"ratecode_id": [ratecode], "tree": [tree], "sampled": [len(pdf)], "feature": [feature], "threshold": [threshold],
                             "left": [left], "right": [right], "path": [path]})

    return training_rows(imputed, settings).groupBy("ratecode_id", "tree").applyInPandas(build, TREE_SCHEMA)


def unpack(frame: pd.DataFrame) -> list[dict]:
    """Rows of trees as arrays."""
    return [{**{c: np.asarray(r[c]) for c in ("feature", "threshold", "left", "right", "path")}, "sampled": int(r["sampled"])}
            for _, r in frame.sort_values("tree").iterrows()]


def prepared(tree: dict) -> dict:
    """The tree with its followers by node and side, made at its first use. Leaves follow themselves, so all points take ``steps`` steps."""
    if "follower" not in tree:
        leaf, own = tree["feature"] < 0, np.arange(len(tree["feature"]))
        sides = np.stack([np.where(leaf, own, tree["right"]), np.where(leaf, own, tree["left"])], axis=1).astype(np.int64)
        steps, level = 0, np.zeros(1, dtype=np.int64)
        while not leaf[level].all():
            steps, level = steps + 1, np.unique(sides[level])
        tree.update(split=np.where(leaf, 0, tree["feature"]).astype(np.int64), follower=sides.ravel(), steps=steps)
    return tree


def isolation(points: np.ndarray, trees: list[dict]) -> np.ndarray:
    """2 ** -(mean path / expected path): near 1 for points that separate early."""
    depth = np.zeros(len(points))
    values = np.ascontiguousarray(points.T).ravel()  # feature by feature
    at_row = np.arange(len(points))
    for tree in map(prepared, trees):
        start, node = tree["split"] * len(points), np.zeros(len(points), dtype=np.int64)
        for _ in range(tree["steps"]):
            goes_left = values.take(start.take(node) + at_row) <= tree["threshold"].take(node)
            node = tree["follower"].take(2 * node + goes_left)
        depth += tree["path"].take(node)
    scale = float(np.mean([mean_path(t["sampled"]) for t in trees]))
    return np.power(2.0, -(depth / len(trees)) / max(scale, 1e-12))


def raw_scores(imputed: DataFrame, trees: DataFrame, most: int = BROADCAST_NODES) -> DataFrame:
    """Isolation value per trip; NULL for a ratecode without a forest.

    Scoring is row by row, so a forest of up to ``most`` nodes serves a stream as well as a batch. A larger one is for batches, also those
    of ``foreachBatch``: trips of a ratecode are dealt into groups of bounded size, and each group meets the ratecode's trees.
    """
    nodes = trees.agg(F.coalesce(F.sum(F.size("feature")), F.lit(0)).alias("n")).first()["n"]
    if nodes <= most:
        # features alone cross into Python; the trip's other columns stay in the JVM
        score = _scorer(imputed.sparkSession.sparkContext.broadcast({int(k): unpack(g) for k, g in trees.toPandas().groupby("ratecode_id")}))
        out = imputed.withColumn("isolation", score("ratecode_id", *FEATURES))
    elif imputed.isStreaming:
        raise ValueError(f"{nodes} nodes are too many to broadcast to a stream: score its batches in foreachBatch")
    else:
        groups = imputed.groupBy("ratecode_id").agg(F.ceil(F.count(F.lit(1)) / GROUP_ROWS).alias("_groups"))
        groups = groups.select(F.col("ratecode_id").alias("_rc"), "_groups")
        dealt = imputed.join(groups, F.col("ratecode_id").eqNullSafe(F.col("_rc"))).withColumn("_group", F.pmod(F.xxhash64("trip_id"), F.col("_groups"))).drop("_rc", "_groups")
        copies = trees.join(groups, F.col("ratecode_id") == F.col("_rc")).withColumn("_group", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_groups") - 1))).select(
            F.col("ratecode_id").alias("_rc"), F.col("_group").alias("_of"), "tree", "sampled", "feature", "threshold", "left", "right", "path")

        def beside(trips: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
            value = isolation(trips[FEATURES].to_numpy(dtype=float), unpack(own)) if len(own) and len(trips) else np.full(len(trips), np.nan)
            return trips.drop(columns="_group").assign(isolation=np.round(value, 9))

        schema = T.StructType([*imputed.schema.fields, T.StructField("isolation", T.DoubleType())])
        out = dealt.groupBy("ratecode_id", "_group").cogroup(copies.groupBy("_rc", "_of")).applyInPandas(beside, schema)
    return out.withColumn("isolation", F.nanvl("isolation", F.lit(None).cast("double")))


def _scorer(model):
    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for ratecodes, *features in batches:
            codes, points = ratecodes.to_numpy(), np.column_stack([f.to_numpy(dtype=float) for f in features])
            value = np.full(len(points), np.nan)
            for ratecode, trees in model.value.items():
                rows = np.flatnonzero(codes == ratecode)
                if len(rows):
                    value[rows] = isolation(points[rows], trees)
            yield pd.Series(np.round(value, 9))

    return score


def thresholds(scored: DataFrame, settings: ForestSettings = DEFAULTS.forest) -> DataFrame:
    """Per ratecode: the contamination offset and the fraud quantile of the isolation value."""
    return exact_quantiles(scored.filter(F.col("isolation").isNotNull()), ["ratecode_id"], "isolation",
                           {"offset": 1.0 - settings.contamination, "cut": settings.fraud_quantile})


def flag(scored: DataFrame, cuts: DataFrame) -> DataFrame:
    """Anomaly score (isolation above the offset) and the strict fraud flag; trips without a model have neither and say why."""
    status = F.when(F.col("isolation").isNotNull(), OK).when(F.col("ratecode_id").isNull(), NO_RATECODE).otherwise(LOW_ROWS)
    return scored.join(cuts, "ratecode_id", "left").select(
        "trip_id", "ratecode_id", "service_id", "year", "month",
        (F.col("isolation") - F.col("offset")).alias("anomaly_score"),
        (F.col("isolation") > F.col("cut")).alias("is_fraud"),
        status.alias("model_status"), "is_anomaly_candidate",
    )


class Model:
    """Trees, medians, cuts and registry as tables, kept together so that serving imputes as training did."""

    PARTS = ("trees", "medians", "cuts", "registry")

    def __init__(self, trees: DataFrame, medians: DataFrame, cuts: DataFrame, registry: DataFrame):
        self.trees, self.medians, self.cuts, self.registry = trees, medians, cuts, registry

    def save(self, path: str) -> Model:
        """Write the model once under ``path``, a folder per version, and give it back as read from there."""
        for part in self.PARTS:
            getattr(self, part).write.parquet(f"{path}/{part}")
        return Model.load(self.trees.sparkSession, path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Model:
        return cls(*[spark.read.parquet(f"{path}/{part}") for part in cls.PARTS])

    def score(self, features: DataFrame) -> DataFrame:
        """Isolation value of every row, its missing features filled with the stored medians."""
        return raw_scores(impute_median(features, ["ratecode_id"], FEATURES, self.medians), self.trees)


def train(features: DataFrame, settings: ForestSettings = DEFAULTS.forest) -> tuple[Model, DataFrame]:
    """Fit, score all trips, set the cuts; returns the model and the score table, one row per trip."""
    medians = materialise(group_medians(features, ["ratecode_id"], FEATURES), "medians")
    imputed = materialise(impute_median(features, ["ratecode_id"], FEATURES, medians), "imputed")
    trees = materialise(fit(imputed, settings), "trees")
    scored = materialise(raw_scores(imputed, trees), "isolation")
    cuts = materialise(thresholds(scored, settings), "cuts")
    sizes = imputed.groupBy("ratecode_id").agg(F.count(F.lit(1)).alias("n_rows_source"))
    registry = trees.groupBy("ratecode_id").agg(F.count(F.lit(1)).cast("int").alias("n_estimators"), F.max("sampled").alias("max_samples")).join(sizes, "ratecode_id")
    registry = registry.withColumns({"contamination": F.lit(settings.contamination), "random_state": F.lit(settings.seed)})
    return Model(trees, medians, cuts, registry), flag(scored, cuts)


def ratio_scores(features: DataFrame) -> DataFrame:
    """A plain baseline: cost per mile against the ratecode's median, cut at its p95. Only the columns of the result are written."""
    usable = materialise(
        features.filter(F.col("ratecode_id").isNotNull() & F.col("costo_por_distancia").isNotNull()).select(*SCORED, "costo_por_distancia"), "usable")
    middle = exact_quantile(usable, ["ratecode_id"], "costo_por_distancia", 0.5, "_mid")
    scored = materialise(usable.join(middle, "ratecode_id").select(
        *SCORED, half_up(F.col("costo_por_distancia") / F.col("_mid"), 6).alias("isolation")), "ratio")
    cut = exact_quantile(scored, ["ratecode_id"], "isolation", 0.95, "cut").withColumn("offset", F.lit(0.0))
    return flag(scored, cut)


# ---- reads over a score table ----

def summary(scores: DataFrame, features: DataFrame) -> dict[str, DataFrame]:
    fraud = F.col("is_fraud")
    leak = scores.filter(fraud).select("trip_id").join(features.select("trip_id", "fare_amount"), "trip_id")
    rate = F.coalesce(percent(count_where(fraud), F.count(F.lit(1))), F.lit(0.0)).alias("fraud_rate")
    mean = exact_avg(F.col("anomaly_score"), 6)
    return {
        "total": scores.agg(F.count(F.lit(1)).alias("total_scored"), count_where(fraud).alias("fraud_count"), rate),
        "by_ratecode": scores.groupBy("ratecode_id").agg(
            F.count(F.lit(1)).alias("total"), count_where(fraud).alias("fraud"), rate),
        "score_stats": scores.agg(
            F.min("anomaly_score").alias("score_min"), F.max("anomaly_score").alias("score_max"),
            half_up(mean, 6).alias("score_mean"), half_up(F.stddev_samp("anomaly_score"), 4).alias("score_std")),
        "leakage": leak.agg(half_up(F.coalesce(exact_sum(F.col("fare_amount")), F.lit(0.0)), 2).alias("estimated_leakage")),
    }


PAGE_FEATURES = ("trip_distance", "fare_amount", "velocidad_promedio_calculada", "costo_por_distancia",
                 "duracion_viaje_segundos")


def scores_page(scores: DataFrame, features: DataFrame, ratecode: int, limit: int = 100, offset: int = 0) -> DataFrame:
    """Highest scores of one ratecode with their features, one row per trip.

    The page is cut first, so the feature join carries at most ``limit`` trips.
    """
    top = page(
        scores.filter(F.col("ratecode_id") == ratecode), [("anomaly_score", "desc"), ("trip_id", "asc")], limit, offset
    ).select("trip_id", "ratecode_id", "anomaly_score", "is_fraud")
    ids = top.select("trip_id")
    rows = features.join(ids, "trip_id", "left_semi").select("trip_id", *PAGE_FEATURES).dropDuplicates(["trip_id"])
    return top.join(rows, "trip_id", "left")


def scatter(scores: DataFrame, features: DataFrame, ratecode: int | None = None, limit: int = 500) -> DataFrame:
    """At most ``limit`` points per fraud flag, drawn by trip hash, with their features."""
    if ratecode is not None:
        scores = scores.filter(F.col("ratecode_id") == ratecode)
    points = sample_cap(scores, ["is_fraud"], F.col("trip_id"), limit, "scatter")
    return points.join(features.select("trip_id", *PAGE_FEATURES), "trip_id", "left").select(
        "trip_id", "ratecode_id", "is_fraud", "trip_distance", "fare_amount", "velocidad_promedio_calculada",
        "costo_por_distancia", "anomaly_score", F.lit(fv.LEGAL_FARE_PER_MILE).alias("legal_fare_per_mile"))


def panel_counts(rows: DataFrame) -> DataFrame:
    """Flagged, candidates and mean of the scores present."""
    return rows.agg(
        count_where(F.col("is_fraud")).alias("fraudes"), count_where(F.col("is_anomaly_candidate")).alias("candidatos"),
        half_up(F.coalesce(exact_avg(F.col("anomaly_score"), 6), F.lit(0.0)), 6).alias("score_medio"))


def registry_rows(model: Model) -> DataFrame:
    """One metadata row per fitted ratecode."""
    return model.registry.select(
        F.lit("isolation_forest").alias("pipeline"), F.col("ratecode_id").cast("string").alias("model"), "n_rows_source",
        F.lit(len(FEATURES)).alias("n_features"), "contamination", "n_estimators", "max_samples", "random_state")
