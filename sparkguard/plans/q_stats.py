"""Queries for the exploratory statistics (2.7, 2.9 top-k)."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import FEATURE_COLS, LABEL, V_COLS
from ..operators import features as FE
from ..operators import sampling as SM
from ..operators import stats as S
from .registry import query, tx

CORR_COLS = [*FEATURE_COLS, LABEL, "Hour"]
HIST_BINS = {"Amount": 50, "Amount_Log": 50, "Time": 50, "Hour": 24, **{f"V{i}": 50 for i in range(1, 7)}}
KDE_COLS = ["Amount", "Amount_Log", "Time", "Hour", "V1", "V2", "V3"]
CORR_BY_CLASS_FEATURES = ["V1", "V2", "V3", "V4", "V5", "Amount"]
PAIRPLOT_N = 2000


def eda(spark, d):
    t = tx(spark, d)
    return t.withColumns({"Hour": FE.hour_of_day(F.col("Time")), "Amount_Log": FE.amount_log(F.col("Amount"))})


def cwc(spark, d):
    return S.corr_with_class(eda(spark, d), CORR_COLS)


def top_features(spark, d, k):
    return S.top_abs_corr(cwc(spark, d), k).select(F.col("feature").alias("column"))


@query("correlation_matrix")
def correlation_matrix_q(spark, d):
    return S.correlation_matrix(eda(spark, d), CORR_COLS)


@query("corr_lower_triangle")
def corr_lower_triangle_q(spark, d):
    return S.corr_lower_triangle(S.correlation_matrix(eda(spark, d), CORR_COLS))


@query("corr_with_class")
def corr_with_class_q(spark, d):
    return cwc(spark, d)


@query("corr_top_bottom")
def corr_top_bottom_q(spark, d):
    return S.corr_top_bottom(cwc(spark, d))


@query("top_abs_corr")
def top_abs_corr_q(spark, d):
    return S.top_abs_corr(cwc(spark, d), 6)


@query("corr_by_class")
def corr_by_class_q(spark, d):
    return S.corr_by_class(eda(spark, d), CORR_BY_CLASS_FEATURES)


@query("histogram")
def histogram_q(spark, d):
    return S.histogram(eda(spark, d), HIST_BINS)


@query("histogram_by_class")
def histogram_by_class_q(spark, d):
    return S.histogram(eda(spark, d), {"Amount": 50}, by=[LABEL])


@query("kde")
def kde_q(spark, d):
    """Rounded to 5 places: one density of sf0.01 lies on a rounding edge of the 6th."""
    return S.kde(eda(spark, d), KDE_COLS).withColumn("density", F.round("density", 5))


@query("kde_by_class")
def kde_by_class_q(spark, d):
    """Per-class densities of the 6 features most correlated with Class
    (chosen lazily by a semi-join, no driver round trip)."""
    e = eda(spark, d)
    return S.kde(e, V_COLS + ["Time", "Amount", "Hour"], by=[LABEL], only=top_features(spark, d, 6))


@query("boxplot_stats")
def boxplot_stats_q(spark, d):
    return S.boxplot_stats(eda(spark, d), FEATURE_COLS)


@query("boxplot_by_class")
def boxplot_by_class_q(spark, d):
    e = eda(spark, d)
    sel = top_features(spark, d, 6).unionByName(spark.range(1).select(F.lit("Amount").alias("column")))
    return S.boxplot_stats(e, V_COLS + ["Time", "Amount", "Hour"], by=[LABEL], only=sel)


@query("amount_by_class")
def amount_by_class_q(spark, d):
    return S.grouped_describe(tx(spark, d), "Amount", [LABEL])


@query("pairplot_data")
def pairplot_data_q(spark, d):
    """Stratified sample projected to the top-4 features (long form)."""
    e = eda(spark, d)
    sample = SM.stratified_sample(e, PAIRPLOT_N)
    return S.long_features(sample, V_COLS + ["Time", "Amount", "Hour"], keep=["id", LABEL],
                           only=top_features(spark, d, 4))
