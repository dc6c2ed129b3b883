"""Model layer: fitting, scoring, saving / registry / loading, search sampling."""
import uuid

from pyspark.sql import functions as F

from sparkguard.operators import models as ML
from sparkguard.plans.evaluate import evaluate_pipeline
from sparkguard.session import shared_dir
from sparkguard.sources import models_io as IO
from sparkguard.sources import scored_fixture


def _data(spark):
    rows = [(i, int(i % 10 == 0), float(i % 10 == 0) * 3 + (i % 7) / 7.0, float(i % 5)) for i in range(400)]
    return spark.createDataFrame(rows, "id long, Class int, a double, b double")


def test_fit_score_save_load(spark):
    df = _data(spark)
    fitted = ML.fit_model(df, ["a", "b"], "logistic_regression")
    scored = ML.score(fitted, df, ["a", "b"], "logistic_regression")
    assert scored.where("y_true = y_pred").count() > 350
    folder = shared_dir(spark, f"models-{uuid.uuid4().hex[:8]}")
    IO.save_model(fitted, folder, "logistic_regression")
    IO.save_model(fitted, folder, "best_params_holder", timestamp=False)
    reg = IO.model_registry(spark, folder)
    assert [r["model"] for r in reg.collect()] == ["logistic_regression"]
    loaded = IO.load_models(reg)["logistic_regression"]
    again = ML.score(loaded, df, ["a", "b"], "logistic_regression")
    assert again.join(scored, ["id"]).where(F.abs(again.y_prob - scored.y_prob) > 1e-12).count() == 0


def test_param_grid_sizes_and_sampling():
    sizes = {m: len(ML.grid_points(m)) for m in ML.MODEL_NAMES}
    assert sizes == {"logistic_regression": 6, "random_forest": 24, "gradient_boosting": 16, "xgboost": 16,
                     "lightgbm": 24}
    assert len(ML.random_search_sample("logistic_regression", 10)) == 6  # all points when the grid is smaller
    pts = ML.random_search_sample("random_forest", 10)
    assert len(pts) == 10 and len({tuple(sorted(p.items(), key=str)) for p in pts}) == 10
    assert pts == ML.random_search_sample("random_forest", 10)


def test_leafwise_depth_mapping():
    est = ML.build_estimator("lightgbm", {"num_leaves": 50, "max_depth": -1})
    assert est.getMaxDepth() == 6
    est = ML.build_estimator("random_forest", {"max_depth": None})
    assert est.getMaxDepth() == 30


def test_evaluate_pipeline(spark, sf):
    out = evaluate_pipeline(scored_fixture(spark, sf))
    assert out["comparison"].count() == 3
    assert out["threshold_sweep"].count() == 18
    assert out["conclusions"].count() == 1


def test_fits_hold_few_rows_and_columns_a_task(spark, monkeypatch):
    """A fit's cached rows are dealt out by their number, and hold no column that it doesn't read."""
    df = _data(spark).coalesce(1)
    plain = ML.fit_model(df, ["a", "b"], "logistic_regression")
    monkeypatch.setattr(ML, "TASK_ROWS", 20)
    held = ML.held_rows(ML.prepare(df, ["a", "b"], "logistic_regression"), 400)
    assert held.columns == ["features", "Class", "w"] and held.count() == 400
    assert max(held.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()) <= 60
    held.unpersist()
    again = ML.fit_model(df, ["a", "b"], "logistic_regression")
    assert max(abs(plain.coefficients.toArray() - again.coefficients.toArray())) < 1e-6
