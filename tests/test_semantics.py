"""Edge cases of the reference semantics (FIXTURES.md section 4) and the
golden metric table."""
import math

import pytest
from pyspark.sql import functions as F

from sparkguard.operators import clean as C
from sparkguard.operators import curves as CV
from sparkguard.operators import features as FE
from sparkguard.operators import metrics as M
from sparkguard.operators import profile as P
from sparkguard.operators import resample as RS


def test_day_period_edges(spark):
    hours = [0.0, 6.0, 12.0, 18.0, 23.99, 24.0, -0.5, 6.0000001]
    df = spark.createDataFrame([(h,) for h in hours], "h double")
    got = [r[0] for r in df.select(FE.day_period(F.col("h"))).collect()]
    assert got == ["Madrugada", "Madrugada", "Mañana", "Tarde", "Noche", "Noche", None, "Mañana"]


def test_hour_half_even_and_pmod(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (23.5,), (-3600.0 * 1,)], "x double")
    assert [r[0] for r in df.select(F.rint("x")).collect()][:3] == [0.0, 2.0, 24.0]
    assert df.select(FE.hour_of_day(F.lit(-3600.0))).first()[0] == 23.0


def test_calibration_bins_right_closed(spark):
    df = spark.createDataFrame([("m", 1, 0, p, 0) for p in (0.0, 0.1, 0.5, 1.0)],
                               "model string, id int, y_true int, y_prob double, y_pred int")
    bins = {r["bin"]: r["count"] for r in CV.calibration_curve(df).collect()}
    assert bins == {0: 2, 4: 1, 9: 1}


def test_inclusive_threshold(spark):
    df = spark.createDataFrame([("m", 1, 1, 0.5, 0)], "model string, id int, y_true int, y_prob double, y_pred int")
    assert M.apply_threshold(df, 0.5).first()["y_pred"] == 1


GOLDEN = {  # model: (tp, fp, fn), expected precision, recall, f1, f2
    "logistic_regression": ((82, 551, 13), (0.1295, 0.8632, 0.2253, 0.4047)),
    "random_forest": ((71, 5, 24), (0.9342, 0.7474, 0.8304, 0.7785)),
    "gradient_boosting": ((72, 12, 23), (0.8571, 0.7579, 0.8045, 0.7759)),
    "xgboost": ((75, 10, 20), (0.8824, 0.7895, 0.8333, 0.8065)),
    "lightgbm": ((73, 8, 22), (0.9012, 0.7684, 0.8295, 0.7918)),
}


@pytest.mark.parametrize("model", list(GOLDEN))
def test_golden_metrics(spark, model):
    (tp, fp, fn), exp = GOLDEN[model]
    total = 57_000
    df = spark.createDataFrame([(model, total - tp - fp - fn, fp, fn, tp)], "model string, tn long, fp long, fn long, tp long")
    r = M.metrics_from_counts(df).first()
    got = (r["precision"], r["recall"], r["f1"], r["f2"])
    assert all(abs(round(g, 4) - e) < 1e-9 for g, e in zip(got, exp)), got


def test_zero_denominators(spark):
    df = spark.createDataFrame([("m", 10, 0, 0, 0)], "model string, tn long, fp long, fn long, tp long")
    r = M.metrics_from_counts(df).first()
    assert r["precision"] == 0 and r["recall"] == 0 and r["f1"] == 0 and r["mcc"] == 0
    assert r["kappa"] is None


def test_cap_skips_five_percent(spark):
    # 100 rows: 5 far outliers (exactly 5 %) -> untouched; 4 -> capped
    base = [(i, float(i % 10)) for i in range(95)]
    five = spark.createDataFrame(base + [(100 + i, 1000.0) for i in range(5)], "id long, x double")
    four = spark.createDataFrame(base + [(100 + i, 1000.0) for i in range(4)] + [(200, 5.0)], "id long, x double")
    assert C.cap_outliers(five, ["x"]).agg(F.max("x")).first()[0] == 1000.0
    assert C.cap_outliers(four, ["x"]).agg(F.max("x")).first()[0] < 1000.0


def test_constant_and_null_columns(spark):
    df = spark.createDataFrame([(i, 1.0, None) for i in range(10)], "id long, c double, n double")
    rep = {r["column"]: r for r in P.iqr_outlier_report(df, ["c", "n"]).collect()}
    assert rep["c"]["outlier_count"] == 0 and rep["n"]["outlier_count"] == 0
    nulls = {r["column"]: r["null_count"] for r in P.null_percentage(df).collect()}
    assert nulls["n"] == 10 and nulls["c"] == 0


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, None), (3, 1.0)], "id long, x double")
    assert P.null_report(df).first()["null_values"] == 2
    assert C.impute_median(df, ["x"]).where("x is null or isnan(x)").count() == 0


def test_single_class_imbalance(spark):
    df = spark.createDataFrame([(i, 0) for i in range(5)], "id long, Class int")
    assert P.class_imbalance(df).first()[0] == 100.0
    assert P.class_imbalance(df.drop("Class")).first()[0] is None


def test_features_without_v14_v17(spark):
    df = spark.createDataFrame([(1, 3600.0, 1.0, 2.0, 3.0, 10.0)], "id long, Time double, V1 double, V2 double, V3 double, Amount double")
    out = FE.transform_features(df)
    assert "V14_Sq" not in out.columns and "PCA_Dist" not in out.columns and "V1_V2" in out.columns
    assert out.first()["Hour"] == 1.0


def test_empty_table(spark):
    df = spark.createDataFrame([], "id long, Time double, Amount double, Class int")
    assert P.quality_summary(df).first()["rows"] == 0
    assert FE.transform_features(df).count() == 0


def _minority(spark, n):
    rows = [(i, 0, float(i), float(i % 7)) for i in range(40)] + [(100 + i, 1, 50.0 + i, float(i)) for i in range(n)]
    return spark.createDataFrame(rows, "id long, Class int, a double, b double")


def test_smote_needs_more_than_k(spark):
    with pytest.raises(ValueError):
        RS.smote(_minority(spark, 5), ["a", "b"]).count()


def test_smote_six_minority_rows(spark):
    out = RS.smote(_minority(spark, 6), ["a", "b"])
    counts = {r["Class"]: r["count"] for r in out.groupBy("Class").count().collect()}
    assert counts == {0: 40, 1: 40}
    syn = out.where("synthetic").agg(F.min("a"), F.max("a"), F.min("b"), F.max("b")).first()
    assert 50.0 <= syn[0] and syn[1] <= 55.0 and 0.0 <= syn[2] and syn[3] <= 5.0
