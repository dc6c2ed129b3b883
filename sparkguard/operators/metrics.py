"""Classification metrics on a scored table ``(model, id, y_true, y_prob, y_pred)``.

Every metric is a closed form over per-model counts (one partial aggregate);
AUC and AP use per-distinct-score counts with bucketed prefix sums.  Zero
denominators give 0 (sklearn's zero_division) except kappa, which gives NULL.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import safe_div
from .ranked import prefix_sums

# Model order used for ties, report bands and the production bar.
GOOD_BAND = 0.9
MEDIUM_BAND = 0.7
PRODUCTION_AUC = 0.95
COARSE, FINE = 32, 32  # ranges of distinct scores per model that prefix sums are taken in


def _z(x: Column) -> Column:
    """0 where a ratio is undefined."""
    return F.coalesce(x, F.lit(0.0))


def confusion_counts(scored: DataFrame, pred: Column | None = None, group: tuple[str, ...] = ("model",)) -> DataFrame:
    """``(model, tn, fp, fn, tp)``."""
    p = pred if pred is not None else F.col("y_pred")
    t = F.col("y_true")
    return scored.groupBy(*group).agg(
        F.count_if((t == 0) & (p == 0)).alias("tn"), F.count_if((t == 0) & (p == 1)).alias("fp"),
        F.count_if((t == 1) & (p == 0)).alias("fn"), F.count_if((t == 1) & (p == 1)).alias("tp"))


def metric_columns(tn="tn", fp="fp", fn="fn", tp="tp") -> dict[str, Column]:
    """Closed forms over the four counts."""
    tn, fp, fn, tp = (F.col(x).cast("double") for x in (tn, fp, fn, tp))
    n = tn + fp + fn + tp
    prec = _z(safe_div(tp, tp + fp))
    rec = _z(safe_div(tp, tp + fn))
    f1 = _z(safe_div(2 * tp, 2 * tp + fp + fn))
    f2 = _z(safe_div(5 * tp, 5 * tp + 4 * fn + fp))
    mcc = _z(safe_div(tp * tn - fp * fn, F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))))
    po = safe_div(tp + tn, n)
    pe = safe_div((tp + fp) * (tp + fn) + (fn + tn) * (fp + tn), n * n)
    kappa = safe_div(po - pe, 1 - pe)
    return {"accuracy": _z(safe_div(tp + tn, n)), "precision": prec, "recall": rec, "f1": f1, "f2": f2,
            "mcc": mcc, "kappa": kappa}


def binary_metrics(scored: DataFrame) -> DataFrame:
    """``(model, accuracy, precision, recall, f1, f2, mcc, kappa)``."""
    return confusion_counts(scored).select("model", *[c.alias(k) for k, c in metric_columns().items()])


def metrics_from_counts(counts: DataFrame) -> DataFrame:
    """Metrics for a table that already holds tn, fp, fn, tp (e.g. golden counts)."""
    return counts.select("*", *[c.alias(k) for k, c in metric_columns().items()])


def confusion_normalized(scored: DataFrame) -> DataFrame:
    """Row-normalised confusion matrix: ``(model, tn_rate, fp_rate, fn_rate, tp_rate)``."""
    c = confusion_counts(scored)
    neg, pos = F.col("tn") + F.col("fp"), F.col("fn") + F.col("tp")
    return c.select("model", safe_div(F.col("tn"), neg).alias("tn_rate"), safe_div(F.col("fp"), neg).alias("fp_rate"),
                    safe_div(F.col("fn"), pos).alias("fn_rate"), safe_div(F.col("tp"), pos).alias("tp_rate"))


def rates(scored: DataFrame) -> DataFrame:
    """``(model, specificity, fpr, fnr)``."""
    c = confusion_counts(scored)
    return c.select("model", _z(safe_div(F.col("tn"), F.col("tn") + F.col("fp"))).alias("specificity"),
                    _z(safe_div(F.col("fp"), F.col("fp") + F.col("tn"))).alias("fpr"),
                    _z(safe_div(F.col("fn"), F.col("fn") + F.col("tp"))).alias("fnr"))


def classification_report(scored: DataFrame) -> DataFrame:
    """Long rows ``(model, label, precision, recall, f1, support)`` for
    classes 0 and 1, accuracy (in f1), macro and weighted averages."""
    c = confusion_counts(scored)
    tn, fp, fn, tp = (F.col(x).cast("double") for x in ("tn", "fp", "fn", "tp"))
    p1, r1 = _z(safe_div(tp, tp + fp)), _z(safe_div(tp, tp + fn))
    p0, r0 = _z(safe_div(tn, tn + fn)), _z(safe_div(tn, tn + fp))
    f1_1, f1_0 = _z(safe_div(2 * tp, 2 * tp + fp + fn)), _z(safe_div(2 * tn, 2 * tn + fn + fp))
    s1, s0 = F.col("tp") + F.col("fn"), F.col("tn") + F.col("fp")
    n = s0 + s1
    w0, w1 = safe_div(s0, n), safe_div(s1, n)

    def row(label, p, r, f, s):
        return F.struct(F.lit(label).alias("label"), p.cast("double").alias("precision"),
                        r.cast("double").alias("recall"), f.cast("double").alias("f1"), s.cast("long").alias("support"))
    rows = [row("0", p0, r0, f1_0, s0), row("1", p1, r1, f1_1, s1),
            row("accuracy", F.lit(None), F.lit(None), _z(safe_div(tp + tn, n)), n),
            row("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f1_0 + f1_1) / 2, n),
            row("weighted avg", p0 * w0 + p1 * w1, r0 * w0 + r1 * w1, f1_0 * w0 + f1_1 * w1, n)]
    return c.select("model", F.inline(F.array(*rows)))


def score_ranges(distinct: DataFrame, group: str = "model", score: str = "y_prob") -> DataFrame:
    """``distinct`` with ``_range``, the place of the score among approximate quantiles of its group's distinct scores.

    The edges (``COARSE`` x ``FINE`` - 1 values per group at most) follow the data, so scores that lie close together are dealt out
    like any others.  A row looks through the coarse edges, then through the fine ones between two of them."""
    n = COARSE * FINE
    probs = F.array(*[F.lit(i / n) for i in range(1, n)])
    edges = distinct.groupBy(group).agg(F.percentile_approx(score, probs, 10 * n).alias("_fine"))
    coarse = F.transform(F.sequence(F.lit(1), F.lit(COARSE - 1)), lambda i: F.element_at("_fine", i * FINE))
    below = lambda values: F.size(F.filter(values, lambda e: e < F.col(score)))
    out = distinct.join(F.broadcast(edges.withColumn("_coarse", coarse)), group).withColumn("_c", below(F.col("_coarse")))
    fine = F.slice(F.col("_fine"), F.greatest(F.col("_c") * FINE, F.lit(1)), F.lit(FINE))
    return out.withColumn("_range", F.col("_c") * (FINE + 1) + below(fine)).drop("_fine", "_coarse", "_c")


def score_table(scored: DataFrame) -> DataFrame:
    """Per ``(model, y_prob)``: ``pos, neg``, counts strictly below
    (``pos_below, neg_below``), totals ``pos_total (P), neg_total (N)`` and
    ascending position ``_pos``."""
    agg = (scored.where(F.col("y_prob").isNotNull())
           .groupBy("model", "y_prob")
           .agg(F.count_if(F.col("y_true") == 1).alias("pos"), F.count_if(F.col("y_true") != 1).alias("neg")))
    return prefix_sums(score_ranges(agg), ["model"], "y_prob", F.col("_range"), ["pos", "neg"]).drop("_range")


def auc_ap(scored: DataFrame) -> DataFrame:
    """``(model, roc_auc, avg_precision)``: exact, ties counted half (AUC);
    AP = sum over distinct thresholds of (recall step) x precision."""
    t = score_table(scored)
    P, N = F.col("pos_total").cast("double"), F.col("neg_total").cast("double")
    tp = P - F.col("pos_below")
    fp = N - F.col("neg_below")
    auc_term = F.col("pos") * (F.col("neg_below") + F.col("neg") * 0.5)
    ap_term = F.col("pos") * safe_div(tp, tp + fp)
    return t.groupBy("model").agg(
        safe_div(F.sum(auc_term), F.first(P) * F.first(N)).alias("roc_auc"),
        safe_div(F.sum(ap_term), F.first(P)).alias("avg_precision"))


def model_comparison(scored: DataFrame, model_order: DataFrame | None = None) -> DataFrame:
    """One row per model: accuracy, precision, recall, f1, f2, mcc, kappa,
    roc_auc, avg_precision (both always computed)."""
    return binary_metrics(scored).join(auc_ap(scored), ["model"], "left")


def _order(order_col: str) -> Column:
    """Sort key of a model: its place in MODEL_NAMES, others after them by name; any other column as it is."""
    if order_col != "model":
        return F.struct(F.col(order_col))
    from .models import MODEL_NAMES
    place = F.lit(len(MODEL_NAMES))
    for i, m in enumerate(MODEL_NAMES):
        place = F.when(F.col("model") == m, i).otherwise(place)
    return F.struct(place.alias("place"), F.col("model"))


def model_ranking(comparison: DataFrame, order_col: str = "model") -> DataFrame:
    """Models by F1 descending, ties in model order; adds ``rank``."""
    w = Window.orderBy(F.desc("f1"), _order(order_col))  # one row per model
    return comparison.withColumn("rank", F.row_number().over(w))


def best_by(comparison: DataFrame, metric: str, order_col: str = "model") -> DataFrame:
    """One row ``(best_model, value)``: the first model (in ``order_col``
    order) with the largest metric; missing counts as 0."""
    return _best_first(comparison, F.coalesce(F.col(metric), F.lit(0.0)), order_col)


def _best_first(df: DataFrame, m: Column, order_col: str) -> DataFrame:
    top = df.agg(F.max(m).alias("value"))
    cand = df.crossJoin(F.broadcast(top)).where(m == F.col("value"))
    return cand.agg(F.min_by(F.col("model"), _order(order_col)).alias("best_model"), F.first("value").alias("value"))


def best_tree_model(comparison: DataFrame, tree_models: list[str], order_col: str = "model") -> DataFrame:
    """First model in F1 order among ``tree_models``."""
    return _best_first(comparison.where(F.col("model").isin(tree_models)),
                       F.coalesce(F.col("f1"), F.lit(0.0)), order_col)


def comparison_long(comparison: DataFrame, metrics: list[str] | None = None, fill: float | None = None) -> DataFrame:
    """``(model, metric, value)``; missing values stay NULL (heat map) or get ``fill`` (bars)."""
    metrics = metrics or ["accuracy", "precision", "recall", "f1", "f2", "mcc", "kappa", "roc_auc", "avg_precision"]
    long = comparison.select("model", F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])))
    return long if fill is None else long.withColumn("value", F.coalesce(F.col("value"), F.lit(float(fill))))


def report_table(comparison: DataFrame) -> DataFrame:
    """Formatted report rows: 4-decimal strings, 'N/A' when missing, and a
    quality band per metric (good > 0.9, medium > 0.7, else bad)."""
    cols = ["accuracy", "precision", "recall", "f1", "f2", "roc_auc", "avg_precision"]

    def fmt(c):
        return F.coalesce(F.format_string("%.4f", F.col(c)), F.lit("N/A")).alias(f"{c}_fmt")

    def band(c):
        return (F.when(F.col(c) > GOOD_BAND, "good").when(F.col(c) > MEDIUM_BAND, "medium")
                .when(F.col(c).isNotNull(), "bad")).alias(f"{c}_band")
    return comparison.select("model", *[fmt(c) for c in cols], *[band(c) for c in ["f1", "roc_auc"]])


def report_conclusions(comparison: DataFrame) -> DataFrame:
    """One row: best model by F1 (+ its metrics), best by AUC when different,
    and whether the F1 winner is recommended for production (AUC > 0.95)."""
    bf = best_by(comparison, "f1").select(F.col("best_model").alias("best_f1_model"))
    ba = best_by(comparison.where(F.col("roc_auc").isNotNull()), "roc_auc") \
        .select(F.col("best_model").alias("best_auc_model"))
    win = comparison.select(F.col("model").alias("best_f1_model"), F.col("f1").alias("best_f1"),
                            F.col("precision").alias("best_precision"), F.col("recall").alias("best_recall"),
                            F.col("roc_auc").alias("best_f1_auc"))
    one = bf.join(win, ["best_f1_model"]).crossJoin(ba)
    return one.select("*", F.when(F.col("best_auc_model") != F.col("best_f1_model"), F.col("best_auc_model"))
                      .alias("other_auc_model"),
                      F.coalesce(F.col("best_f1_auc") > PRODUCTION_AUC, F.lit(False)).alias("production_ready"))


def apply_threshold(scored: DataFrame, threshold: float) -> DataFrame:
    """Re-label with an inclusive threshold: ``y_pred = y_prob >= t``."""
    return scored.withColumn("y_pred", (F.col("y_prob") >= F.lit(float(threshold))).cast("int"))


def error_cases(scored: DataFrame) -> DataFrame:
    """False positives and false negatives with their kind."""
    return (scored.where(F.col("y_true") != F.col("y_pred"))
            .withColumn("error", F.when(F.col("y_pred") == 1, F.lit("FP")).otherwise(F.lit("FN"))))
