"""Queries for sources, profiling and data quality."""
from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions.columns import FEATURE_COLS, LABEL
from ..operators import profile as P
from ..session import shared_dir
from ..sources import load_transactions
from .registry import dirty, query, tx


@query("load_transactions")
def load_transactions_q(spark, d):
    return tx(spark, d)


@query("load_transactions_csv")
def load_transactions_csv_q(spark, d):
    """The transactions written as CSV and read back with their key."""
    path = shared_dir(spark, f"transactions-{uuid.uuid4().hex}.csv")
    t = tx(spark, d)
    t.select("id", *FEATURE_COLS, LABEL).write.csv(path, header=True)
    return load_transactions(spark, path, key="id").select(*t.columns)


@query("dataset_shape_types")
def dataset_shape_types_q(spark, d):
    return P.dataset_shape(dirty(spark, d))


@query("null_report")
def null_report_q(spark, d):
    return P.null_report(dirty(spark, d))


@query("null_percentage")
def null_percentage_q(spark, d):
    return P.null_percentage(dirty(spark, d))


@query("duplicate_count")
def duplicate_count_q(spark, d):
    return P.duplicate_count(dirty(spark, d))


@query("infinite_count")
def infinite_count_q(spark, d):
    return P.infinite_count(dirty(spark, d))


@query("iqr_outlier_report")
def iqr_outlier_report_q(spark, d):
    return P.iqr_outlier_report(tx(spark, d))


@query("iqr_mask")
def iqr_mask_q(spark, d):
    return P.iqr_mask(tx(spark, d), "Amount").select("id", "Amount", "is_outlier", "lower_bound", "upper_bound")


@query("top_outlier_columns")
def top_outlier_columns_q(spark, d):
    return P.top_outlier_columns(tx(spark, d)).select("column", "outlier_count", "outlier_pct")


@query("class_distribution")
def class_distribution_q(spark, d):
    return P.class_distribution(tx(spark, d))


@query("class_imbalance")
def class_imbalance_q(spark, d):
    return P.class_imbalance(tx(spark, d))


@query("quality_summary")
def quality_summary_q(spark, d):
    return P.quality_summary(dirty(spark, d))


@query("describe")
def describe_q(spark, d):
    return P.describe(tx(spark, d))


@query("fraud_vs_legit")
def fraud_vs_legit_q(spark, d):
    return P.fraud_vs_legit(tx(spark, d))


@query("count_by_class")
def count_by_class_q(spark, d):
    return P.count_by_category(tx(spark, d), "Class")
