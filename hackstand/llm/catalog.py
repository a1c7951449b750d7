"""The registered queries of this subpackage: one per operator over its whole table."""

from __future__ import annotations

from hackstand.llm import op1_fertility_rules as op1
from hackstand.llm import op2_sentence_spans as op2
from hackstand.llm import op3_byte_convnet as op3
from hackstand.llm import op4_repair_ids as op4
from hackstand.llm import op5_boosted_pii as op5
from hackstand.llm import op6_bloom_lm as op6
from hackstand.llm import op7_sampled_splitters as op7
from hackstand.llm import op8_multi_order_join as op8
from hackstand.llm import op9_nnls_packing as op9
from hackstand.llm import op10_spaced_seeds as op10
from hackstand.llm import op11_sum_of_squares as op11
from hackstand.llm import op12_identity_map as op12
from hackstand.llm import op13_partenum_variants as op13
from hackstand.llm.common import documents


def queries() -> dict:
    return {
        "op1_fertility_rules": lambda spark, sf: op1.digest(documents(spark, sf)),
        "op2_sentence_spans": lambda spark, sf: op2.drop_repeated_spans(documents(spark, sf)),
        "op3_byte_convnet": lambda spark, sf: op3.digest(documents(spark, sf), spark.read.parquet(f"{sf}/labels.parquet")),
        "op4_repair_ids": lambda spark, sf: op4.digest(documents(spark, sf)),
        "op5_boosted_pii": lambda spark, sf: op5.digest(documents(spark, sf)),
        "op6_bloom_lm": lambda spark, sf: op6.score_texts(documents(spark, sf)),
        "op7_sampled_splitters": lambda spark, sf: op7.digest(documents(spark, sf)),
        "op8_multi_order_join": lambda spark, sf: op8.near_duplicates(documents(spark, sf)),
        "op9_nnls_packing": lambda spark, sf: op9.digest(documents(spark, sf)),
        "op10_spaced_seeds": lambda spark, sf: op10.contaminated(documents(spark, sf), spark.read.parquet(f"{sf}/benchmark.parquet")),
        "op11_sum_of_squares": lambda spark, sf: op11.digest(documents(spark, sf)),
        "op12_identity_map": lambda spark, sf: op12.digest(documents(spark, sf)),
        "op13_partenum_variants": lambda spark, sf: op13.variants(documents(spark, sf)),
    }


def oracle_sql() -> dict:
    return {"op2_sentence_spans": op2.sql(), "op8_multi_order_join": op8.sql(), "op10_spaced_seeds": op10.sql(), "op13_partenum_variants": op13.sql()}
