"""What fits and the flow leave on disk and shuffle, over rows made here."""
import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from sparkguard.operators import boosting as B
from sparkguard.operators import models as ML
from sparkguard.plans import preprocess as PP
from sparkguard.plans import q_models as Q
from sparkguard.session import cut_lineage, shared_dir


def _rows(spark, n=400):
    rows = [(i, int(i % 9 == 0), float(i % 9 == 0) * 2 + (i % 7) / 7.0, float(i % 5), float(i % 11)) for i in range(n)]
    return spark.createDataFrame(rows, "id long, Class int, a double, b double, c double")


def _tables(spark, *names):
    folder = shared_dir(spark, "").removeprefix("file:")
    return {x for x in (os.listdir(folder) if os.path.isdir(folder) else []) if x.rsplit("-", 1)[0] in names}


@pytest.mark.parametrize("model", ["logistic_regression", "gradient_boosting"])
def test_a_written_table_is_fitted_without_a_shuffle_or_a_copy(spark, monkeypatch, model):
    df = _rows(spark)
    plain = ML.fit_model(df.coalesce(1), ["a", "b"], model, {"n_estimators": 3} if model != "logistic_regression" else None)
    monkeypatch.setattr(ML, "TASK_ROWS", 50)
    table = cut_lineage(df.coalesce(1), "made", ML.TASK_ROWS)
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    with ML.split_by_file(spark, 400):
        held = ML.held_rows(ML.prepare(table, ["a", "b"], model), 400, source=table)
        assert not held.is_cached and held.rdd.getNumPartitions() == 8
        assert "REPARTITION" not in held._jdf.queryExecution().toString()
        assert max(held.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()) <= 50
    assert spark.conf.get("spark.sql.files.openCostInBytes") == before
    again = ML.fit_model(table, ["a", "b"], model, {"n_estimators": 3} if model != "logistic_regression" else None)
    x, y = (ML.score(m, df, ["a", "b"], model).orderBy("id").collect() for m in (plain, again))
    assert max(abs(s.y_prob - t.y_prob) for s, t in zip(x, y, strict=True)) < 1e-6


def test_passes_leave_one_table_of_margins_at_most(spark, monkeypatch):
    b = B.bin_features(_rows(spark), ["a", "b", "c"])
    monkeypatch.setattr(B, "MANY_ROWS", 0)
    old = _tables(spark, "margins")
    most, plain = [], B._advance

    def advance(*args):
        out = plain(*args)
        most.append(len(_tables(spark, "margins") - old))
        return out
    monkeypatch.setattr(B, "_advance", advance)
    model, = B.fit_many(b, [replace(B.LEAFWISE, rounds=7, leaves=4, min_rows=5)])
    assert len(model.trees) == 7 and most == [1, 2, 2]
    assert not _tables(spark, "margins") - old and b.rows.count() == 400


def test_the_flow_keeps_its_result_only(spark):
    names = ("engineered", "split", "resampled", "processed")
    old = _tables(spark, *names)
    df = _rows(spark).withColumnRenamed("a", "Amount").withColumn("Time", F.col("id").cast("double"))
    out, feats, params = PP.preprocess(df.withColumns({f"V{i}": F.col("b") * i for i in range(1, 29)}))
    assert {x.rsplit("-", 1)[0] for x in _tables(spark, *names) - old} == {"processed"}
    assert out.where("split = 'train' AND synthetic").count() > 0 and params.count() == 1 and len(feats) > 28


def test_attributions_are_not_written(spark, monkeypatch):
    df = _rows(spark).withColumn("split", F.when(F.col("id") % 5 == 0, "test").otherwise("train"))
    monkeypatch.setattr(Q, "_CACHE", {(spark.sparkContext.applicationId, "made"): (df, ["a", "b", "c"])})
    old = _tables(spark, "shap")
    checks = Q.shapley_checks_q(spark, "made").collect()
    assert len(checks) == 80 and all(r["n_features"] == 3 and r["adds_up"] for r in checks)
    assert len(Q.shap_dependence_q(spark, "made").collect()) == 240 and not _tables(spark, "shap") - old
