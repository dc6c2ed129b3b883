"""From raw documents to token files: quality rules, near-duplicate removal, decontamination, mixing, token output.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
stage's docs.  All but the last return the columns of documents.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparkguard.llm import op2_token_binary, op3_ngram_join, op5_decontaminate, op6_quality_rules, op10_mixture
from sparkguard.llm.common import scratch_path

#: No document is repeated, and the budget asks for 95 % of the tokens, so that mixing trims what the weights
#: don't want.
MIX = {"max_epochs": 1, "share": 0.95}


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return op6_quality_rules.apply_rules(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near copies."""
    return op3_ngram_join.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window."""
    return op5_decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents taken for the target weights."""
    return op10_mixture.mix(docs, **MIX)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the documents, read back: (doc_id, start, n_tokens, ids_crc32)."""
    return op2_token_binary.token_table(docs).select("doc_id", "start", "n_tokens", "ids_crc32")


STAGES = [("quality rules", quality), ("near duplicates", near_duplicates), ("decontamination", decontaminate),
          ("mixture", mixture), ("token output", tokens)]

#: SQL can't express MinHash candidates and the tokenizer; tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    path = scratch_path(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return out
        out.write.parquet(f"{path}/{k}")
        docs = spark.read.schema(out.schema).parquet(f"{path}/{k}")
