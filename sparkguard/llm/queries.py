"""The operators' registered queries: ``name -> (spark, sf_dir) -> DataFrame`` over whole tables."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import (op1_substring_dedup, op2_token_binary, op3_ngram_join, op4_token_counts, op5_decontaminate,
               op6_quality_rules, op7_quality_classifier, op8_url_filters, op9_line_dedup, op10_mixture,
               op11_lsh_forest, op12_spelling_variants, op13_conversation_repair)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup_q(spark, d):
    return op1_substring_dedup.remove_repeats(table(spark, d, "documents")).drop("removed")


def op2_token_binary_q(spark, d):
    return op2_token_binary.token_table(table(spark, d, "documents")).select("doc_id", "start", "n_tokens", "ids_crc32")


def op3_ngram_join_q(spark, d):
    return op3_ngram_join.ngram_join(table(spark, d, "documents"))


def op4_token_counts_q(spark, d):
    return op4_token_counts.corpus_token_counts(table(spark, d, "documents"))


def op5_decontaminate_q(spark, d):
    return op5_decontaminate.contamination_report(table(spark, d, "documents"), table(spark, d, "benchmark"))


def op6_quality_rules_q(spark, d):
    return op6_quality_rules.quality_ledger(table(spark, d, "documents"))


def op6_rule_ablation_q(spark, d):
    return op6_quality_rules.ablation(op6_quality_rules.ledger(table(spark, d, "documents")))


def op7_quality_classifier_q(spark, d):
    return op7_quality_classifier.classify(table(spark, d, "documents"), table(spark, d, "labels"))


def op8_url_filters_q(spark, d):
    return op8_url_filters.judge(table(spark, d, "pages"))


def op9_line_dedup_q(spark, d):
    return op9_line_dedup.remove_boilerplate(table(spark, d, "documents"))


def op10_mixture_q(spark, d):
    return op10_mixture.mixture(table(spark, d, "documents"))


def op11_lsh_forest_q(spark, d):
    return op11_lsh_forest.near_dedup(table(spark, d, "documents"))


def op12_spelling_variants_q(spark, d):
    return op12_spelling_variants.spelling_variants(table(spark, d, "documents"), damaged=True)


def op13_conversation_repair_q(spark, d):
    return op13_conversation_repair.repair(op13_conversation_repair.damage(table(spark, d, "conversations"))).drop("n_rows")


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup_q,
    "op2_token_binary": op2_token_binary_q,
    "op3_ngram_join": op3_ngram_join_q,
    "op4_token_counts": op4_token_counts_q,
    "op5_decontaminate": op5_decontaminate_q,
    "op6_quality_rules": op6_quality_rules_q,
    "op6_rule_ablation": op6_rule_ablation_q,
    "op7_quality_classifier": op7_quality_classifier_q,
    "op8_url_filters": op8_url_filters_q,
    "op9_line_dedup": op9_line_dedup_q,
    "op10_mixture": op10_mixture_q,
    "op11_lsh_forest": op11_lsh_forest_q,
    "op12_spelling_variants": op12_spelling_variants_q,
    "op13_conversation_repair": op13_conversation_repair_q,
}
