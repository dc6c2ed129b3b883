"""Cutoff sampling, NULL labels, large counts, ties, tuning points, scaling order, neighbours beyond the window."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkguard.functions.columns import ID, LABEL
from sparkguard.operators import metrics as M
from sparkguard.operators import models as ML
from sparkguard.operators import resample as RS
from sparkguard.operators import sampling as SM


@pytest.mark.parametrize("n0,n1", [(3_950_000_000, 50_000_000), (10**12 - 7, 7)])
def test_quotas_of_large_tables(spark, n0, n1):
    cc = spark.createDataFrame([(0, n0), (1, n1)], f"{LABEL} int, n_c long")
    q = {r[LABEL]: r for r in SM.split_quotas(cc, 0.2, LABEL, cc).collect()}
    total = n0 + n1
    assert sum(r.train_c for r in q.values()) == total - -(-total // 5)
    assert all(abs(r.train_c - 0.8 * r.n_c) <= 1 for r in q.values())


def test_null_labels_are_a_class(spark):
    df = spark.range(2000).select(F.col("id").alias(ID), F.when(F.col("id") % 7 != 0, (F.col("id") % 5 == 0).cast("int")).alias(LABEL))
    out = SM.stratified_split(df).groupBy(LABEL, "split").count().collect()
    assert sum(r["count"] for r in out) == 2000 and sum(r["count"] for r in out if r.split == "test") == 400
    assert {(r[LABEL], r.split) for r in out} == {(c, s) for c in (None, 0, 1) for s in ("train", "test")}
    assert SM.stratified_kfold(df, 3).count() == 2000
    assert ML.with_class_weights(df).count() == 2000


def test_sampling_shuffles_no_feature(spark):
    df = spark.range(5000).select(F.col("id").alias(ID), (F.col("id") % 9 == 0).cast("int").alias(LABEL), F.rand(1).alias("wide_feature"))
    df.write.mode("overwrite").parquet(path := f"{spark.sparkContext.getCheckpointDir()}/cutoff")
    df = spark.read.parquet(path)
    for out in (SM.stratified_split(df), SM.random_sample_n(df, 100), SM.stratified_fraction(df, 0.3), SM.stratified_sample(df, 50)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        below = [line for line in plan.splitlines() if "Exchange" in line and "wide_feature" in line]
        assert not below
        assert "wide_feature" in out.columns
    assert SM.random_sample_n(df, 100).count() == 100 and SM.random_sample_n(df, 10**6).count() == 5000
    assert SM.random_sample_n(df, 0).count() == 0 and SM.stratified_fraction(df, 0.3).count() == 1500


def test_ties_go_to_the_first_model(spark):
    names = ["gradient_boosting", "random_forest", "logistic_regression", "own"]
    df = spark.createDataFrame([(m, 0.8, 0.9) for m in names], "model string, f1 double, roc_auc double")
    assert M.best_by(df, "f1").first().best_model == "logistic_regression"
    rank = [r.model for r in M.model_ranking(df).orderBy("rank").collect()]
    assert rank == ["logistic_regression", "random_forest", "gradient_boosting", "own"]


def test_neighbours_beyond_the_first_window(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(60, 3))
    pts = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], f"{ID} long, v array<double>")
    got = {(r[ID], r.k_idx): r.nb_id for r in RS.knn_minority(pts, k=20).collect()}
    for i in range(60):
        d = ((x - x[i]) ** 2).sum(axis=1)
        d[i] = np.inf
        assert [got[i, j] for j in range(1, 21)] == np.argsort(d, kind="stable")[:20].tolist()


def test_search_points_differ():
    for m in ("random_forest", "lightgbm", "xgboost", "logistic_regression", "gradient_boosting"):
        points = ML._different_points(m, 1000, 42)
        marks = [repr(sorted((k.name, str(v)) for k, v in ML.build_estimator(m, p, 1).extractParamMap().items())) + ML._weight_name(m, p)
                 for p in points]
        assert len(set(marks)) == len(marks)


@pytest.mark.parametrize("folds", [2, 5])
def test_folds_and_class_weights(spark, folds):
    rows = [(i, int(i % 6 == 0), float(i % 6 == 0) + (i * 37 % 100) / 60) for i in range(300)]
    df = spark.createDataFrame(rows, f"{ID} long, {LABEL} int, a double")
    _, params, f1 = ML.random_search_cv(df, ["a"], "logistic_regression", n_iter=2, folds=folds, subsample=1.0)
    assert params and 0 <= f1 <= 1
    est = [ML.build_estimator("xgboost", {"scale_pos_weight": w, "n_estimators": 3}, 1, weight_col=ML._weight_name("xgboost", {"scale_pos_weight": w}))
           for w in (1, 5)]
    data = ML.prepare(df, ["a"], "xgboost").withColumn("w_5_0", F.when(F.col(LABEL) == 1, 5.0).otherwise(1.0))
    plain, heavy = (e.fit(data).transform(data).agg(F.sum("prediction")).first()[0] for e in est)
    assert heavy > plain


def test_scale_first_scales_test_rows(spark, sf):
    from sparkguard.plans.preprocess import preprocess
    from sparkguard.plans.registry import tx
    out, feats, _ = preprocess(tx(spark, sf), scale_first=True, resample=False)
    r = out.groupBy("split").agg(F.avg("Time").alias("t"), F.avg("Amount").alias("a")).collect()
    assert {x.split for x in r} == {"train", "test"} and all(abs(x.t) < 0.5 and abs(x.a) < 0.5 for x in r)
