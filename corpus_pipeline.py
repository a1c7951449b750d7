"""From raw documents to packed token windows, in five stages over all documents.

Each stage takes what its predecessor kept, written as Parquet and read again, so a lost executor costs a stage's tasks and no
more. All stages but the last return the columns they got.

* Null texts: scored as empty, kept or dropped by that score; never near duplicates; no benchmark overlap; nothing to redact.
* Extra columns pass through all stages but the last. An empty table gives an empty table at every stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hackstand.llm import op3_byte_convnet, op5_boosted_pii, op8_multi_order_join, op9_nnls_packing, op10_spaced_seeds
from hackstand.llm.common import documents, store


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network, trained on this table's labels, takes for good."""
    return op3_byte_convnet.keep_good(docs, op3_byte_convnet.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked documents."""
    return op8_multi_order_join.keep_one(docs, n=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an overlap with a benchmark item."""
    return op10_spaced_seeds.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced; a column n_chars follows the text."""
    out = op5_boosted_pii.redact(docs, op5_boosted_pii.fit(docs))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of packed windows with their ids."""
    return op9_nnls_packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality), ("ngram_jaccard_join", near_duplicates), ("benchmark_decontamination", decontaminate), ("pii", personal_data), ("packing", packing)]

#: Stages 3, 5 and 9 are not SQL. Tests check columns and row counts of the stages, and the operators behind them by themselves.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), name)
    return docs
