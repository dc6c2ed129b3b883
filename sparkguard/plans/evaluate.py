"""Evaluation flow over one scored table: comparison, curves, best model,
threshold and cost analyses, report rows (and attribution when a model and
test rows are given)."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import curves as CV
from ..operators import explain as X
from ..operators import metrics as M
from ..operators import tree_shap as TS
from ..operators.boosting import BoostedModel
from ..session import cut_lineage


def evaluate_pipeline(scored: DataFrame, fitted: dict | None = None, test: DataFrame | None = None,
                      features: list[str] | None = None) -> dict[str, DataFrame]:
    comp = M.model_comparison(scored)
    best = M.best_by(comp, "f1")
    best_scored = scored.join(F.broadcast(best.select(F.col("best_model").alias("model"))), ["model"], "left_semi")
    sweep = CV.threshold_sweep(best_scored)
    out = {
        "comparison": comp, "ranking": M.model_ranking(comp), "roc": CV.roc_curve(scored),
        "pr": CV.pr_curve(scored), "calibration": CV.calibration_curve(scored), "best": best,
        "threshold_sweep": sweep, "best_threshold_f1": CV.best_threshold(sweep, "f1"),
        "best_threshold_f2": CV.best_threshold(sweep, "f2"), "cost_benefit": CV.cost_benefit(best_scored),
        "cost_curve": CV.cost_curve_min(scored, comp), "report_table": M.report_table(comp),
        "conclusions": M.report_conclusions(comp),
    }
    if fitted and test is not None and features:
        name = best.first()["best_model"]
        out["permutation_importance"] = X.permutation_importance(fitted[name], test, features)
        exact = isinstance(fitted[name], BoostedModel) or type(fitted[name]).__name__ == "GBTClassificationModel"
        phi = TS.tree_shapley(fitted[name], test, features) if exact else X.shapley_values(fitted[name], test, features)
        phi = cut_lineage(phi, "shap")
        out |= {"shapley": phi, "shap_summary": X.shap_summary(phi), "shap_top3": X.shap_top(phi, 3),
                "shap_dependence": X.shap_dependence(phi, 3)}
    return out


def evaluation_summary(scored: DataFrame) -> DataFrame:
    """One row per model: F1, AUC, AP, best F1 / F2 thresholds, best net-benefit threshold."""
    comp = M.model_comparison(scored)
    sweep = CV.threshold_sweep(scored)
    t1 = CV.best_threshold(sweep, "f1").select("model", F.col("threshold").alias("best_f1_threshold"))
    t2 = CV.best_threshold(sweep, "f2").select("model", F.col("threshold").alias("best_f2_threshold"))
    tc = CV.best_threshold(CV.cost_benefit(scored), "total_cost").select(
        "model", F.col("threshold").alias("best_cost_threshold"), F.col("total_cost").alias("best_net_benefit"))
    return comp.select("model", "f1", "roc_auc", "avg_precision").join(t1, ["model"]).join(t2, ["model"]) \
        .join(tc, ["model"])
