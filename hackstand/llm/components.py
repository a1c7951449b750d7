"""Connected components of a table of links, by repeated minimum and label jumps, each round a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hackstand.llm.common import store


def components(links: DataFrame) -> DataFrame:
    """node, label (smallest node of its component) for every node in ``links`` (a long, b long).

    A round takes the smallest label among a node's neighbours, then replaces each label by that label's own label, so chains
    shorten by half; minima combine before the shuffle, so a node with very many links is no burden.
    """
    both = store(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = store(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("label")), "labels")
    while True:
        seen = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("m"))
        lower = store(labels.join(seen, F.col("node") == F.col("a")).select("node", F.col("label").alias("old"), F.least("label", "m").alias("label")), "labels")
        of = lower.select(F.col("node").alias("n2"), F.col("label").alias("jump"))
        labels = store(lower.join(of, F.col("label") == F.col("n2")).select("node", "old", F.least("label", "jump").alias("label")), "labels")
        if not labels.where("old <> label").limit(1).count():
            return labels.select("node", "label")
