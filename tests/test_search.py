"""The searches and the weighted fit over rows made here."""
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkguard.operators import boosting as B
from sparkguard.operators import models as ML
from sparkguard.plans import q_models as Q

FEATS = ["a", "b", "c", "e", "g"]


@pytest.fixture()
def made(spark, monkeypatch):
    """A processed table of 600 rows under the name ``made``."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(600, 5))
    y = (x[:, 0] + x[:, 1] * x[:, 2] + rng.normal(size=600) > 1.5).astype(int)
    rows = [(i, int(y[i]), "test" if i % 5 == 0 else "train", *map(float, x[i])) for i in range(600)]
    df = spark.createDataFrame(rows, "id long, Class int, split string, " + ", ".join(f"{c} double" for c in FEATS)).cache()
    monkeypatch.setattr(Q, "_CACHE", {(spark.sparkContext.applicationId, "made"): (df, FEATS)})
    return df


def test_best_params_come_from_the_search_of_every_model(spark, made, monkeypatch):
    seen = []
    monkeypatch.setattr(ML, "random_search", lambda train, feats, model, **k: (seen.append((model, train.count())), (ML.grid_points(model)[-1], 0.5))[1])
    rows = {r["model"]: r.asDict() for r in Q.best_params_table_q(spark, "made").collect()}
    assert set(rows) == set(ML.MODEL_NAMES) and seen == [(m, 480) for m in ML.MODEL_NAMES]
    assert rows["lightgbm"]["num_leaves"] == "50" and rows["lightgbm"]["C"] is None and rows["logistic_regression"]["C"] == "1.0"


def test_search_reads_all_rows(spark, made, monkeypatch):
    """More rows than the subsample's threshold are searched whole."""
    seen, plain = [], ML.stratified_kfold
    monkeypatch.setattr(ML, "stratified_kfold", lambda df, *a: (seen.append(df.count()), plain(df, *a))[1])
    train = made.where("split = 'train'")
    ML.random_search_cv(train, FEATS, "logistic_regression", n_iter=1, min_rows=100)
    assert seen == [480]


def test_weighted_fit_has_its_weight_and_samples(spark, made):
    train = made.where("split = 'train'")
    got = {r["id"]: r["y_prob"] for r in Q.fit_gbt_weighted_q(spark, "made").collect()}
    want = B.fit(train, FEATS, replace(B.SECOND_ORDER, positive_weight=5.0, rows=0.8, columns=0.8))
    base = {r["id"]: r["y_prob"] for r in Q._fit_score(spark, "made", "xgboost").collect()}
    rows = made.where("split = 'test'").orderBy("id").collect()
    p = 1 / (1 + np.exp(-want.margin(np.array([[r[c] for c in FEATS] for r in rows]))))
    assert np.allclose([got[r["id"]] for r in rows], p, atol=1e-12)
    assert sum(got.values()) > sum(base.values())
