"""Queries for metrics, curves, thresholds, costs and rankings (2.9, 2.13)."""
from __future__ import annotations

from ..operators import curves as CV
from ..operators import metrics as M
from .registry import query, scored

TREE_MODELS = ["m2", "m3"]
APPLY_THRESHOLD = 0.3


def comparison(spark, d):
    return M.model_comparison(scored(spark, d))


@query("confusion_matrix")
def confusion_matrix_q(spark, d):
    return M.confusion_counts(scored(spark, d))


@query("confusion_normalized")
def confusion_normalized_q(spark, d):
    return M.confusion_normalized(scored(spark, d))


@query("binary_metrics")
def binary_metrics_q(spark, d):
    return M.binary_metrics(scored(spark, d))


@query("rates")
def rates_q(spark, d):
    return M.rates(scored(spark, d))


@query("classification_report")
def classification_report_q(spark, d):
    return M.classification_report(scored(spark, d))


@query("roc_auc")
def roc_auc_q(spark, d):
    return M.auc_ap(scored(spark, d)).select("model", "roc_auc")


@query("average_precision")
def average_precision_q(spark, d):
    return M.auc_ap(scored(spark, d)).select("model", "avg_precision")


@query("roc_curve")
def roc_curve_q(spark, d):
    return CV.roc_curve(scored(spark, d))


@query("pr_curve")
def pr_curve_q(spark, d):
    return CV.pr_curve(scored(spark, d))


@query("calibration_curve")
def calibration_curve_q(spark, d):
    return CV.calibration_curve(scored(spark, d))


@query("threshold_sweep")
def threshold_sweep_q(spark, d):
    return CV.threshold_sweep(scored(spark, d))


@query("best_threshold_f1")
def best_threshold_f1_q(spark, d):
    return CV.best_threshold(CV.threshold_sweep(scored(spark, d)), "f1")


@query("best_threshold_f2")
def best_threshold_f2_q(spark, d):
    return CV.best_threshold(CV.threshold_sweep(scored(spark, d)), "f2")


@query("cost_benefit")
def cost_benefit_q(spark, d):
    return CV.cost_benefit(scored(spark, d))


@query("best_threshold_cost")
def best_threshold_cost_q(spark, d):
    return CV.best_threshold(CV.cost_benefit(scored(spark, d)), "total_cost", maximize=True)


@query("cost_curve_min")
def cost_curve_min_q(spark, d):
    return CV.cost_curve_min(scored(spark, d))


@query("model_comparison")
def model_comparison_q(spark, d):
    return comparison(spark, d)


@query("comparison_long")
def comparison_long_q(spark, d):
    return M.comparison_long(comparison(spark, d))


@query("report_table")
def report_table_q(spark, d):
    return M.report_table(comparison(spark, d))


@query("report_conclusions")
def report_conclusions_q(spark, d):
    return M.report_conclusions(comparison(spark, d))


@query("model_ranking")
def model_ranking_q(spark, d):
    return M.model_ranking(comparison(spark, d)).select("model", "f1", "rank")


@query("best_by_f1")
def best_by_f1_q(spark, d):
    return M.best_by(comparison(spark, d), "f1")


@query("best_by_auc")
def best_by_auc_q(spark, d):
    return M.best_by(comparison(spark, d), "roc_auc")


@query("best_tree_model")
def best_tree_model_q(spark, d):
    return M.best_tree_model(comparison(spark, d), TREE_MODELS)


@query("apply_threshold")
def apply_threshold_q(spark, d):
    return M.apply_threshold(scored(spark, d), APPLY_THRESHOLD)


@query("error_cases")
def error_cases_q(spark, d):
    return M.error_cases(scored(spark, d))


@query("evaluate_pipeline")
def evaluate_pipeline_q(spark, d):
    """Composition over the scored table: per-model summary of the evaluation flow."""
    from .evaluate import evaluation_summary
    return evaluation_summary(scored(spark, d))
