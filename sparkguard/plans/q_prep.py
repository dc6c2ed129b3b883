"""Queries for cleaning, feature engineering and hourly statistics (2.3, 2.4, 2.7)."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clean as C
from ..operators import features as FE
from ..operators import stats as S
from .registry import dirty, query, tx

PERIOD_COLS = FE.period_dummy_names()


def eng(spark, d):
    return FE.transform_features(tx(spark, d))


@query("impute_median")
def impute_median_q(spark, d):
    return C.impute_median(dirty(spark, d), ["Amount", "V3"]).select("id", "Amount", "V3")


@query("impute_mode")
def impute_mode_q(spark, d):
    return C.impute_mode(dirty(spark, d), ["channel"]).select("id", "channel")


@query("replace_infinite")
def replace_infinite_q(spark, d):
    return C.replace_infinite(dirty(spark, d), ["V4"]).select("id", "V4")


@query("handle_missing")
def handle_missing_q(spark, d):
    return C.handle_missing(dirty(spark, d)).select("id", "Amount", "V3", "V4", "channel", "Class")


@query("drop_duplicates")
def drop_duplicates_q(spark, d):
    return C.drop_duplicates(dirty(spark, d)).select("id", "Time", "Amount", "V3", "V4", "channel", "Class")


@query("cap_outliers")
def cap_outliers_q(spark, d):
    return C.cap_outliers(eng(spark, d))


@query("cap_report")
def cap_report_q(spark, d):
    return C.cap_report(eng(spark, d))


@query("amount_log")
def amount_log_q(spark, d):
    return eng(spark, d).select("id", "Amount", "Amount_Log")


@query("hour_of_day")
def hour_of_day_q(spark, d):
    return eng(spark, d).select("id", "Time", "Hour")


@query("day_period")
def day_period_q(spark, d):
    return eng(spark, d).select("id", "Hour", "Day_Period")


@query("interactions")
def interactions_q(spark, d):
    return eng(spark, d).select("id", "V1_V2", "V1_V3", "V2_V3")


@query("squares")
def squares_q(spark, d):
    return eng(spark, d).select("id", "V14_Sq", "V17_Sq")


@query("pca_distance")
def pca_distance_q(spark, d):
    return eng(spark, d).select("id", "PCA_Dist")


@query("period_dummies")
def period_dummies_q(spark, d):
    return eng(spark, d).select("id", "Day_Period", *PERIOD_COLS)


@query("transform_features")
def transform_features_q(spark, d):
    return eng(spark, d)


@query("one_hot_categoricals")
def one_hot_categoricals_q(spark, d):
    out = FE.one_hot_categoricals(eng(spark, d))
    return out.select("id", *[c for c in out.columns if c.startswith("Day_Period_")])


@query("hour_crosstab")
def hour_crosstab_q(spark, d):
    return S.hour_crosstab(eng(spark, d))


@query("fraud_ratio_by_hour")
def fraud_ratio_by_hour_q(spark, d):
    return S.fraud_ratio_by_hour(eng(spark, d))


@query("count_by_day_period")
def count_by_day_period_q(spark, d):
    return eng(spark, d).groupBy("Day_Period").agg(F.count(F.lit(1)).alias("count"))


@query("new_feature_list")
def new_feature_list_q(spark, d):
    """New engineered columns with their non-null counts."""
    t = tx(spark, d)
    e = FE.transform_features(t)
    new = FE.new_feature_list(t, e)
    one = e.agg(*[F.count(F.col(c)).alias(f"_n{i}") for i, c in enumerate(new)])
    return one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.lit(i).alias("ord"),
                                                  F.col(f"_n{i}").alias("non_null")) for i, c in enumerate(new)])))


@query("align_columns")
def align_columns_q(spark, d):
    """Test rows restricted to the columns shared with the one-hot encoded train rows."""
    from ..operators import sampling as SM
    sp = SM.stratified_split(eng(spark, d))
    train = FE.one_hot_categoricals(sp.where(F.col("split") == "train"))
    _, test = FE.align_columns(train, sp.where(F.col("split") == "test"))
    return test


@query("drop_target")
def drop_target_q(spark, d):
    return FE.drop_target(eng(spark, d))


@query("count_by_category")
def count_by_category_q(spark, d):
    """Rows per value of each categorical column (Class, Day_Period), long form."""
    e = eng(spark, d)
    parts = [e.groupBy(F.col(c).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("count"))
             .withColumn("category", F.lit(c)) for c in ("Class", "Day_Period")]
    return parts[0].unionByName(parts[1])
