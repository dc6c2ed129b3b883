"""Fits, attribution and preprocessing read and compute their rows no more often than needed."""
import random

import numpy as np
from pyspark.sql import functions as F

from sparkguard.functions.columns import rounded
from sparkguard.operators import models as ML
from sparkguard.operators import resample as RS
from sparkguard.operators import tree_shap as TS
from sparkguard.plans import preprocess as PP
from sparkguard.session import keep_methods_small


def _rows(spark, n=400):
    r = random.Random(3)
    rows = [(i, int(i % 10 == 0), r.gauss(0, 1) + (i % 10 == 0), r.gauss(0, 1)) for i in range(n)]
    return spark.createDataFrame(rows, "id long, Class int, a double, b double")


def test_rounded_is_round(spark):
    r = random.Random(1)
    x = [0.0, -0.0, 1e-7, -1e-7, 5e-7, -5e-7, 0.1234565, 2.5e-6, 1.0000005, float("nan"), float("inf"), float("-inf"), None, 1e300, -1e18,
         99999.9999995, 123456.7890125, *((r.randrange(10**10) + 0.5) / 1e6 for _ in range(300)), *(r.uniform(-1, 1) * 10 ** r.randrange(-8, 14) for _ in range(1000))]
    df = spark.createDataFrame([(v,) for v in x], "x double").select("x", F.round("x", 6).cast("string").alias("a"), rounded(F.col("x"), 6).cast("string").alias("b"))
    assert df.where(~F.col("a").eqNullSafe(F.col("b"))).collect() == []


def test_preprocess_writes_resampled_rows_once(spark, monkeypatch):
    written, cut = [], PP.cut_lineage
    monkeypatch.setattr(PP, "cut_lineage", lambda df, name="stage": (written.append(name), cut(df, name))[1])
    out, feats, _ = PP.preprocess(_rows(spark))
    assert written.count("resampled") == 1
    n = {(r["split"], r["Class"]): r["count"] for r in out.groupBy("split", "Class").count().collect()}
    assert n["train", 0] == n["train", 1] and n["test", 0] + n["test", 1] == 80


def test_smote_steps_are_plain_columns(spark):
    df = _rows(spark)
    out = RS.smote(df, ["a", "b"], parents=True)
    assert "zip_with" not in out._jdf.queryExecution().optimizedPlan().toString().lower()
    rows = {r["id"]: r for r in out.collect()}
    made = [r for r in rows.values() if r["synthetic"]]
    assert len(made) == 320
    for r in made:
        x, y = rows[r["base_id"]], rows[r["nb_id"]]
        steps = [(r[c] - x[c]) / (y[c] - x[c]) for c in ("a", "b")]
        assert abs(steps[0] - steps[1]) < 1e-6 and -1e-9 <= steps[0] < 1 + 1e-9


def test_fits_deal_out_rows_below_a_share_per_core(spark, monkeypatch):
    monkeypatch.setattr(ML, "TASK_ROWS", 150)
    held = ML.held_rows(ML.prepare(_rows(spark).coalesce(1), ["a", "b"], "logistic_regression"), 400)
    sizes = held.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    held.unpersist()
    assert sum(sizes) == 400 and max(sizes) <= 200


def test_patterns_are_counted_as_they_are_sorted(monkeypatch):
    p = np.random.default_rng(0).integers(0, 8, 1000) & 5
    dense = TS._distinct(p, 3)
    monkeypatch.setattr(TS, "DENSE_BITS", 2)
    for a, b in zip(dense, TS._distinct(p, 3)):
        assert a.tolist() == b.tolist()


def test_deep_forests_keep_their_nodes():
    assert ML.build_estimator("random_forest").getCacheNodeIds()


def test_wide_stages_are_split_unless_set(spark):
    key = "spark.sql.codegen.hugeMethodLimit"
    old = spark.conf.get(key, None)
    try:
        spark.conf.unset(key)
        keep_methods_small(spark)
        assert spark.conf.get(key) == "8000"
        spark.conf.set(key, "9000")
        keep_methods_small(spark)
        assert spark.conf.get(key) == "9000"
    finally:
        spark.conf.unset(key)
        if old is not None:
            spark.conf.set(key, old)
