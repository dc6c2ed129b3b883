"""DuckDB twins for metrics, curves, thresholds and rankings."""
from __future__ import annotations

import numpy as np

from .oracle_sql import oracle, rounded, with_fixtures

SWEEP = [float(x) for x in np.arange(0.1, 1.0, 0.05)]
COSTGRID = [float(x) for x in np.linspace(0.01, 0.99, 20)]
EDGES = [float(x) for x in np.linspace(0.0, 1.0, 11)[1:-1]]


def dv(a: str, b: str) -> str:
    return f"(CASE WHEN ({b}) = 0 THEN NULL ELSE CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE) END)"


def counts_cte(name="cm", src="scored_p", pred="y_pred", extra_group="") -> str:
    g = f"model{extra_group}"
    return (f"{name} AS (SELECT {g}, count(*) FILTER (WHERE y_true = 0 AND {pred} = 0) AS tn, "
            f"count(*) FILTER (WHERE y_true = 0 AND {pred} = 1) AS fp, "
            f"count(*) FILTER (WHERE y_true = 1 AND {pred} = 0) AS fn, "
            f"count(*) FILTER (WHERE y_true = 1 AND {pred} = 1) AS tp FROM {src} GROUP BY {g})")


def metric_sql() -> dict[str, str]:
    tn, fp, fn, tp = "CAST(tn AS DOUBLE)", "CAST(fp AS DOUBLE)", "CAST(fn AS DOUBLE)", "CAST(tp AS DOUBLE)"
    n = f"({tn} + {fp} + {fn} + {tp})"
    po = dv(f"{tp} + {tn}", n)
    pe = dv(f"({tp} + {fp}) * ({tp} + {fn}) + ({fn} + {tn}) * ({fp} + {tn})", f"{n} * {n}")
    return {
        "accuracy": f"coalesce({dv(f'{tp} + {tn}', n)}, 0.0)",
        "precision": f"coalesce({dv(tp, f'{tp} + {fp}')}, 0.0)",
        "recall": f"coalesce({dv(tp, f'{tp} + {fn}')}, 0.0)",
        "f1": f"coalesce({dv(f'2 * {tp}', f'2 * {tp} + {fp} + {fn}')}, 0.0)",
        "f2": f"coalesce({dv(f'5 * {tp}', f'5 * {tp} + 4 * {fn} + {fp}')}, 0.0)",
        "mcc": f"coalesce({dv(f'{tp} * {tn} - {fp} * {fn}', f'sqrt(({tp} + {fp}) * ({tp} + {fn}) * ({tn} + {fp}) * ({tn} + {fn}))')}, 0.0)",
        "kappa": dv(f"{po} - {pe}", f"1 - {pe}"),
    }


METRICS = ["accuracy", "precision", "recall", "f1", "f2", "mcc", "kappa"]


def metrics_select(keys=METRICS) -> str:
    m = metric_sql()
    return ", ".join(f"{m[k]} AS {k}" for k in keys)


ST = ("st AS (SELECT model, y_prob, count(*) FILTER (WHERE y_true = 1) AS pos, "
      "count(*) FILTER (WHERE y_true <> 1) AS neg FROM scored_p WHERE y_prob IS NOT NULL GROUP BY model, y_prob)")
ST2 = ("st2 AS (SELECT *, coalesce(sum(pos) OVER w, 0) AS pos_below, coalesce(sum(neg) OVER w, 0) AS neg_below, "
       "sum(pos) OVER (PARTITION BY model) AS P, sum(neg) OVER (PARTITION BY model) AS N, "
       "row_number() OVER (PARTITION BY model ORDER BY y_prob) AS _pos FROM st "
       "WINDOW w AS (PARTITION BY model ORDER BY y_prob ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))")
AUC = ("auc AS (SELECT model, " + dv("sum(pos * (neg_below + neg * 0.5::DOUBLE))", "first(P) * first(N)")
       + " AS roc_auc, " + dv("sum(pos * " + dv("P - pos_below", "(P - pos_below) + (N - neg_below)") + ")", "first(P)")
       + " AS avg_precision FROM st2 GROUP BY model)")
COMP = [counts_cte(), ST, ST2, AUC,
        f"comp AS (SELECT cm.model, {metrics_select()}, auc.roc_auc, auc.avg_precision FROM cm LEFT JOIN auc USING (model))"]
COMP_COLS = ["model", *METRICS, "roc_auc", "avg_precision"]


@oracle("confusion_matrix")
def _():
    return with_fixtures("SELECT * FROM cm", counts_cte())


@oracle("confusion_normalized")
def _():
    body = (f"SELECT model, {dv('tn', 'tn + fp')} AS tn_rate, {dv('fp', 'tn + fp')} AS fp_rate, "
            f"{dv('fn', 'fn + tp')} AS fn_rate, {dv('tp', 'fn + tp')} AS tp_rate FROM cm")
    return with_fixtures(rounded(body, ["model", "tn_rate", "fp_rate", "fn_rate", "tp_rate"],
                                 ["tn_rate", "fp_rate", "fn_rate", "tp_rate"]), counts_cte())


@oracle("binary_metrics")
def _():
    return with_fixtures(rounded(f"SELECT model, {metrics_select()} FROM cm", ["model", *METRICS], METRICS),
                         counts_cte())


@oracle("rates")
def _():
    body = (f"SELECT model, coalesce({dv('tn', 'tn + fp')}, 0.0) AS specificity, "
            f"coalesce({dv('fp', 'fp + tn')}, 0.0) AS fpr, coalesce({dv('fn', 'fn + tp')}, 0.0) AS fnr FROM cm")
    return with_fixtures(rounded(body, ["model", "specificity", "fpr", "fnr"], ["specificity", "fpr", "fnr"]),
                         counts_cte())


@oracle("classification_report")
def _():
    p1, r1 = f"coalesce({dv('tp', 'tp + fp')}, 0.0)", f"coalesce({dv('tp', 'tp + fn')}, 0.0)"
    p0, r0 = f"coalesce({dv('tn', 'tn + fn')}, 0.0)", f"coalesce({dv('tn', 'tn + fp')}, 0.0)"
    f1_1 = f"coalesce({dv('2 * tp', '2 * tp + fp + fn')}, 0.0)"
    f1_0 = f"coalesce({dv('2 * tn', '2 * tn + fn + fp')}, 0.0)"
    n = "(tn + fp + fn + tp)"
    w0, w1 = dv("tn + fp", n), dv("tp + fn", n)
    rows = [("'0'", p0, r0, f1_0, "tn + fp"), ("'1'", p1, r1, f1_1, "tp + fn"),
            ("'accuracy'", "NULL", "NULL", f"coalesce({dv('tp + tn', n)}, 0.0)", n),
            ("'macro avg'", f"({p0} + {p1}) / 2", f"({r0} + {r1}) / 2", f"({f1_0} + {f1_1}) / 2", n),
            ("'weighted avg'", f"{p0} * {w0} + {p1} * {w1}", f"{r0} * {w0} + {r1} * {w1}",
             f"{f1_0} * {w0} + {f1_1} * {w1}", n)]
    body = " UNION ALL ".join(
        f"SELECT model, {lab} AS label, CAST({p} AS DOUBLE) AS precision, CAST({r} AS DOUBLE) AS recall, "
        f"CAST({f} AS DOUBLE) AS f1, CAST({s} AS BIGINT) AS support FROM cm" for lab, p, r, f, s in rows)
    return with_fixtures(rounded(body, ["model", "label", "precision", "recall", "f1", "support"],
                                 ["precision", "recall", "f1"]), counts_cte())


@oracle("roc_auc")
def _():
    return with_fixtures(rounded("SELECT model, roc_auc FROM auc", ["model", "roc_auc"], ["roc_auc"]), ST, ST2, AUC)


@oracle("average_precision")
def _():
    return with_fixtures(rounded("SELECT model, avg_precision FROM auc", ["model", "avg_precision"],
                                 ["avg_precision"]), ST, ST2, AUC)


@oracle("roc_curve")
def _():
    body = (f"SELECT model, y_prob AS threshold, {dv('N - neg_below', 'N')} AS fpr, {dv('P - pos_below', 'P')} AS tpr "
            "FROM (SELECT *, max(_pos) OVER (PARTITION BY model) AS _last FROM st2) p "
            "LEFT JOIN (SELECT model, _pos + 1 AS _pos, pos AS _npos, neg AS _nneg FROM st2) nx USING (model, _pos) "
            "WHERE _pos = 1 OR _pos = _last OR _npos <> pos OR _nneg <> neg "
            "UNION ALL SELECT DISTINCT model, 'Infinity'::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE FROM scored_p")
    return with_fixtures(rounded(body, ["model", "threshold", "fpr", "tpr"], ["threshold", "fpr", "tpr"]), ST, ST2)


@oracle("pr_curve")
def _():
    tp, fp = "(P - pos_below)", "(N - neg_below)"
    body = (f"SELECT model, y_prob AS threshold, coalesce({dv(tp, f'{tp} + {fp}')}, 0.0) AS precision, "
            f"CASE WHEN P = 0 THEN 1.0::DOUBLE ELSE {dv(tp, 'P')} END AS recall FROM st2 "
            "UNION ALL SELECT DISTINCT model, NULL::DOUBLE, 1.0::DOUBLE, 0.0::DOUBLE FROM scored_p")
    return with_fixtures(rounded(body, ["model", "threshold", "precision", "recall"],
                                 ["threshold", "precision", "recall"]), ST, ST2)


@oracle("calibration_curve")
def _():
    b = " + ".join(f"CAST(y_prob > {e!r}::DOUBLE AS INTEGER)" for e in EDGES)
    body = (f"SELECT model, {b} AS bin, avg(y_prob) AS prob_pred, avg(CAST(y_true AS DOUBLE)) AS prob_true, "
            "count(*) AS count FROM scored_p WHERE y_prob IS NOT NULL GROUP BY ALL")
    return with_fixtures(rounded(body, ["model", "bin", "prob_pred", "prob_true", "count"], ["prob_pred", "prob_true"]))


def grid_cte(values, name="g") -> str:
    rows = ", ".join(f"({i + 1}, {v!r}::DOUBLE)" for i, v in enumerate(values))
    return f"{name}(threshold_idx, threshold) AS (VALUES {rows})"


def grid_counts_cte(values, name="gc") -> list[str]:
    return [grid_cte(values), "sg AS (SELECT s.*, g.threshold_idx, g.threshold, CAST(s.y_prob >= g.threshold AS INTEGER) "
            "AS gp FROM scored_p s CROSS JOIN g)", counts_cte(name, "sg", "gp", ", threshold_idx, threshold")]


SWEEP_M = ["accuracy", "precision", "recall", "f1", "f2"]


@oracle("threshold_sweep")
def _():
    body = f"SELECT model, threshold, {metrics_select(SWEEP_M)} FROM gc"
    return with_fixtures(rounded(body, ["model", "threshold", *SWEEP_M], ["threshold", *SWEEP_M]),
                         *grid_counts_cte(SWEEP))


def _best(metric, src, agg="max"):
    return (f"SELECT model, min(threshold) AS threshold, first(b) AS {metric} FROM "
            f"(SELECT *, {agg}({metric}) OVER (PARTITION BY model) AS b FROM ({src})) WHERE {metric} = b GROUP BY model")


@oracle("best_threshold_f1")
def _():
    src = f"SELECT model, threshold, {metrics_select(['f1'])} FROM gc"
    return with_fixtures(rounded(_best("f1", src), ["model", "threshold", "f1"], ["threshold", "f1"]),
                         *grid_counts_cte(SWEEP))


@oracle("best_threshold_f2")
def _():
    src = f"SELECT model, threshold, {metrics_select(['f2'])} FROM gc"
    return with_fixtures(rounded(_best("f2", src), ["model", "threshold", "f2"], ["threshold", "f2"]),
                         *grid_counts_cte(SWEEP))


COST_SRC = ("SELECT model, threshold, tn, fp, fn, tp, CAST(tn * 0 + fp * (-10) + fn * (-100) + tp * 50 AS DOUBLE) "
            f"AS total_cost, {metrics_select(['accuracy', 'precision', 'recall', 'f1'])} FROM gc")


@oracle("cost_benefit")
def _():
    cols = ["model", "threshold", "tn", "fp", "fn", "tp", "total_cost", "accuracy", "precision", "recall", "f1"]
    return with_fixtures(rounded(COST_SRC, cols, ["threshold", "total_cost", "accuracy", "precision", "recall", "f1"]),
                         *grid_counts_cte(SWEEP))


@oracle("best_threshold_cost")
def _():
    return with_fixtures(rounded(_best("total_cost", COST_SRC), ["model", "threshold", "total_cost"],
                                 ["threshold", "total_cost"]), *grid_counts_cte(SWEEP))


@oracle("cost_curve_min")
def _():
    best_model = ("bm AS (SELECT min(model) AS model FROM auc WHERE coalesce(roc_auc, 0.0) = "
                  "(SELECT max(coalesce(roc_auc, 0.0)) FROM auc))")
    ctes = [ST, ST2, AUC, best_model, grid_cte(COSTGRID),
            "sg AS (SELECT s.*, g.threshold_idx, g.threshold, CAST(s.y_prob >= g.threshold AS INTEGER) AS gp "
            "FROM scored_p s JOIN bm USING (model) CROSS JOIN g)", counts_cte("gc", "sg", "gp", ", threshold_idx, threshold"),
            "cc AS (SELECT model, threshold, 10.0::DOUBLE * fp + 100.0::DOUBLE * fn - 50.0::DOUBLE * tp - 1.0::DOUBLE * tn "
            "AS total_cost FROM gc)"]
    body = (f"SELECT cc.model, cc.threshold, cc.total_cost, b.threshold AS optimal_threshold, "
            f"b.total_cost AS optimal_cost FROM cc JOIN ({_best('total_cost', 'SELECT * FROM cc', 'min')}) b USING (model)")
    cols = ["model", "threshold", "total_cost", "optimal_threshold", "optimal_cost"]
    return with_fixtures(rounded(body, cols, cols[1:]), *ctes)


@oracle("model_comparison")
def _():
    return with_fixtures(rounded("SELECT * FROM comp", COMP_COLS, COMP_COLS[1:]), *COMP)


@oracle("comparison_long")
def _():
    body = " UNION ALL ".join(f"SELECT model, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM comp"
                              for m in COMP_COLS[1:])
    return with_fixtures(rounded(body, ["model", "metric", "value"], ["value"]), *COMP)


@oracle("report_table")
def _():
    cols = ["accuracy", "precision", "recall", "f1", "f2", "roc_auc", "avg_precision"]
    fmt = ", ".join(f"coalesce(printf('%.4f', {c}), 'N/A') AS {c}_fmt" for c in cols)
    band = ", ".join(f"CASE WHEN {c} > 0.9::DOUBLE THEN 'good' WHEN {c} > 0.7::DOUBLE THEN 'medium' "
                     f"WHEN {c} IS NOT NULL THEN 'bad' END AS {c}_band" for c in ["f1", "roc_auc"])
    return with_fixtures(f"SELECT model, {fmt}, {band} FROM comp", *COMP)


def best_sql(metric, src="comp", alias="best_model"):
    return (f"SELECT min(model) AS {alias}, max(v) AS value FROM (SELECT model, coalesce({metric}, 0.0) AS v, "
            f"max(coalesce({metric}, 0.0)) OVER () AS mx FROM {src}) WHERE v = mx")


@oracle("report_conclusions")
def _():
    body = (f"SELECT bf.best_f1_model, c.f1 AS best_f1, c.precision AS best_precision, c.recall AS best_recall, "
            f"c.roc_auc AS best_f1_auc, ba.best_auc_model, "
            f"CASE WHEN ba.best_auc_model <> bf.best_f1_model THEN ba.best_auc_model END AS other_auc_model, "
            f"coalesce(c.roc_auc > 0.95::DOUBLE, false) AS production_ready "
            f"FROM ({best_sql('f1', alias='best_f1_model')}) bf JOIN comp c ON c.model = bf.best_f1_model, "
            f"({best_sql('roc_auc', '(SELECT * FROM comp WHERE roc_auc IS NOT NULL)', 'best_auc_model')}) ba")
    cols = ["best_f1_model", "best_f1", "best_precision", "best_recall", "best_f1_auc", "best_auc_model",
            "other_auc_model", "production_ready"]
    return with_fixtures(rounded(body, cols, ["best_f1", "best_precision", "best_recall", "best_f1_auc"]), *COMP)


@oracle("model_ranking")
def _():
    return with_fixtures(rounded("SELECT model, f1, row_number() OVER (ORDER BY f1 DESC, model) AS rank FROM comp",
                                 ["model", "f1", "rank"], ["f1"]), *COMP)


@oracle("best_by_f1")
def _():
    return with_fixtures(rounded(best_sql("f1"), ["best_model", "value"], ["value"]), *COMP)


@oracle("best_by_auc")
def _():
    return with_fixtures(rounded(best_sql("roc_auc"), ["best_model", "value"], ["value"]), *COMP)


@oracle("best_tree_model")
def _():
    return with_fixtures(rounded(best_sql("f1", "(SELECT * FROM comp WHERE model IN ('m2', 'm3'))"),
                                 ["best_model", "value"], ["value"]), *COMP)


@oracle("apply_threshold")
def _():
    return with_fixtures(rounded("SELECT model, id, y_true, y_prob, CAST(y_prob >= 0.3::DOUBLE AS INTEGER) AS y_pred "
                                 "FROM scored_p", ["model", "id", "y_true", "y_prob", "y_pred"], ["y_prob"]))


@oracle("error_cases")
def _():
    return with_fixtures(rounded("SELECT *, CASE WHEN y_pred = 1 THEN 'FP' ELSE 'FN' END AS error FROM scored_p "
                                 "WHERE y_true <> y_pred", ["model", "id", "y_true", "y_prob", "y_pred", "error"],
                                 ["y_prob"]))


@oracle("evaluate_pipeline")
def _():
    f1 = _best("f1", f"SELECT model, threshold, {metrics_select(['f1'])} FROM gc")
    f2 = _best("f2", f"SELECT model, threshold, {metrics_select(['f2'])} FROM gc")
    body = (f"SELECT comp.model, comp.f1, comp.roc_auc, comp.avg_precision, a.threshold AS best_f1_threshold, "
            f"b.threshold AS best_f2_threshold, c.threshold AS best_cost_threshold, c.total_cost AS best_net_benefit "
            f"FROM comp JOIN ({f1}) a USING (model) JOIN ({f2}) b USING (model) "
            f"JOIN ({_best('total_cost', COST_SRC)}) c USING (model)")
    cols = ["model", "f1", "roc_auc", "avg_precision", "best_f1_threshold", "best_f2_threshold",
            "best_cost_threshold", "best_net_benefit"]
    return with_fixtures(rounded(body, cols, cols[1:]), *COMP, *grid_counts_cte(SWEEP))
