"""DuckDB twins for scaling, SMOTE neighbours and class balance."""
from __future__ import annotations

from ..functions.columns import FEATURE_COLS
from .o_prep import CAP_COLS, MODE_SQL, cap_ctes, nn
from .o_sampling import SPLIT_CTES, quota_ctes, rank_cte
from .o_stats import hist_ctes
from .oracle_sql import PERIOD_COLS, TX_COLS, oracle, rounded, with_fixtures

MODEL_COLS = [*CAP_COLS, *PERIOD_COLS]
TR = "tr AS (SELECT * FROM sp WHERE split = 'train')"


def std_params():
    return "pm AS (SELECT " + ", ".join(
        f"avg({c}) AS {c}_c, CASE WHEN stddev_pop({c}) = 0 OR stddev_pop({c}) IS NULL THEN 1.0 ELSE stddev_pop({c}) END AS {c}_s"
        for c in FEATURE_COLS) + " FROM tr)"


def rob_params():
    return "pm AS (SELECT " + ", ".join(
        f"quantile_cont({c}, 0.5) AS {c}_c, CASE WHEN quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) = 0 THEN 1.0 "
        f"ELSE quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) END AS {c}_s" for c in FEATURE_COLS) + " FROM tr)"


def scaled_body():
    return "SELECT id, split, " + ", ".join(f"({c} - {c}_c) / {c}_s AS {c}" for c in FEATURE_COLS) + " FROM sp, pm"


@oracle("stored_scaler")
@oracle("standard_scale")
def _():
    return with_fixtures(rounded(scaled_body(), ["id", "split", *FEATURE_COLS], FEATURE_COLS), *SPLIT_CTES, TR,
                         std_params())


@oracle("robust_scale")
def _():
    return with_fixtures(rounded(scaled_body(), ["id", "split", *FEATURE_COLS], FEATURE_COLS), *SPLIT_CTES, TR,
                         rob_params())


@oracle("scaler_params")
def _():
    body = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {i} AS ord, {c}_c AS center, {c}_s AS scale FROM pm"
                              for i, c in enumerate(FEATURE_COLS))
    return with_fixtures(rounded(body, ["column", "ord", "center", "scale"], ["center", "scale"]), *SPLIT_CTES, TR,
                         std_params())


def _neighbors(src, *ctes):
    dist = " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in FEATURE_COLS)
    body = (f"SELECT id, k_idx, nb_id, sqrt(dist2) AS dist FROM (SELECT a.id, b.id AS nb_id, 0.0 + {dist} AS dist2, "
            "row_number() OVER (PARTITION BY a.id ORDER BY 0.0 + " + dist + ", b.id) AS k_idx "
            "FROM mn a JOIN mn b ON a.id <> b.id) WHERE k_idx <= 5")
    return with_fixtures(rounded(body, ["id", "k_idx", "nb_id", "dist"], ["dist"]), *SPLIT_CTES, TR,
                         *ctes, f"mn AS (SELECT * FROM {src} WHERE Class = 1)")


@oracle("smote_neighbors")
def _():
    return _neighbors("tr")


@oracle("smote_neighbors_scaled")
def _():
    scaled = ", ".join(f"({c} - {c}_c) / {c}_s AS {c}" for c in FEATURE_COLS)
    return _neighbors("sc", std_params(), f"sc AS (SELECT id, Class, {scaled} FROM tr, pm)")


@oracle("smote_checks")
def _():
    body = ("SELECT Class, max(n) OVER () AS n, max(n) OVER () AS n_ids, max(n) OVER () - n AS n_synthetic, "
            "max(n) OVER () - n AS n_between FROM (SELECT Class, count(*) AS n FROM tr GROUP BY Class)")
    return with_fixtures(body, *SPLIT_CTES, TR)


@oracle("fit_checks")
def _():
    from ..operators.models import MODEL_NAMES
    models = ", ".join(f"('{m}')" for m in MODEL_NAMES)
    body = (f"SELECT model, count(*) AS n, count(DISTINCT id) AS n_ids, count(*) AS n_in_range, "
            f"CAST(sum(Class) AS BIGINT) AS n_fraud, true AS auc_ok FROM sp CROSS JOIN (VALUES {models}) m(model) "
            "WHERE split = 'test' GROUP BY model")
    return with_fixtures(body, *SPLIT_CTES)


@oracle("shapley_checks")
def _():
    return with_fixtures(f"SELECT id, CAST({len(MODEL_COLS)} AS BIGINT) AS n_features, true AS adds_up FROM sp WHERE split = 'test'",
                         *SPLIT_CTES)


@oracle("importance_checks")
def _():
    return f"SELECT CAST({len(MODEL_COLS)} AS BIGINT) AS n_features, true AS adds_up, true AS none_negative"


# ---- the preprocessing flow on impure rows, without synthetic ones -----------------------------------------
def _flow(where: str = ""):
    filled = ", ".join("coalesce(Amount, (SELECT quantile_cont(Amount, 0.5) FROM i0)) AS Amount" if c == "Amount" else
                       "coalesce(V3, (SELECT quantile_cont(V3, 0.5) FROM i0)) AS V3" if c == "V3" else c for c in TX_COLS)
    whole = ", ".join("CASE WHEN isinf(V4) THEN (SELECT quantile_cont(V4, 0.5) FROM i1 WHERE NOT isinf(V4)) ELSE V4 END AS V4"
                      if c == "V4" else c for c in TX_COLS)
    capped = ", ".join(f"CASE WHEN {c}_cap THEN greatest({c}_lo, least({c}_hi, {c})) ELSE {c} END AS {c}" for c in CAP_COLS)
    periods = ", ".join(f'CAST("{c}" AS DOUBLE) AS "{c}"' for c in PERIOD_COLS)
    params = ", ".join(f'avg("{c}") AS "{c}_c", CASE WHEN stddev_pop("{c}") = 0 THEN 1.0 ELSE stddev_pop("{c}") END AS "{c}_s"'
                       for c in MODEL_COLS)
    scaled = ", ".join(f'("{c}" - "{c}_c") / "{c}_s" AS "{c}"' for c in MODEL_COLS)
    ctes = [f"i0 AS (SELECT * REPLACE ({nn('V3')} AS V3) FROM transactions_dirty)",
            f"i1 AS (SELECT {filled}, coalesce(channel, {MODE_SQL}) AS channel FROM i0)",
            f"i2 AS (SELECT DISTINCT {whole}, channel FROM i1)", *cap_ctes("i2"),
            f"cp AS (SELECT id, Class, {capped}, {periods} FROM eng, p)",
            *quota_ctes("cp", "_total - ceil(0.2::DOUBLE * _total)", "cq"), rank_cte("cr", "cp", "42-"),
            "cs AS (SELECT cr.*, CASE WHEN rk <= quota THEN 'train' ELSE 'test' END AS split FROM cr JOIN cq USING (Class))",
            f"pm AS (SELECT {params} FROM cs WHERE split = 'train')"]
    cols = ["id", "Class", *MODEL_COLS, "split", "synthetic"]
    body = f"SELECT id, Class, {scaled}, split, false AS synthetic FROM cs, pm{where}"
    return with_fixtures(rounded(body, cols, MODEL_COLS), *ctes)


@oracle("preprocess_no_resample")
def _():
    return _flow()


@oracle("load_processed")
def _():
    return _flow(" WHERE split = 'test'")



@oracle("before_after_balance")
def _():
    body = ("SELECT Class, count(*) AS count, 'before' AS stage, count(*) / sum(count(*)) OVER () * 100 AS pct "
            "FROM tr GROUP BY Class UNION ALL "
            "SELECT Class, (SELECT max(c) FROM (SELECT count(*) AS c FROM tr GROUP BY Class)) AS count, 'after' AS stage, "
            "50.0::DOUBLE AS pct FROM tr GROUP BY Class")
    return with_fixtures(rounded(body, ["Class", "count", "stage", "pct"], ["pct"]), *SPLIT_CTES, TR)


@oracle("processed_metadata")
def _():
    body = ("SELECT 'train' AS split, 2 * max(quota) AS rows, 42 AS features FROM q UNION ALL "
            "SELECT 'test' AS split, sum(n_c - quota) AS rows, 42 AS features FROM q")
    return with_fixtures("SELECT split, CAST(rows AS BIGINT) AS rows, features FROM (" + body + ")", *SPLIT_CTES)


@oracle("scaling_before_after")
def _():
    bins = {"Amount": 50, "V1": 50, "V2": 50, "V3": 50}
    cb, bb = hist_ctes(bins, False, "tr", "b_")
    ca, ba = hist_ctes(bins, False, "sc", "a_")
    scaled = ("sc AS (SELECT id, Class, " + ", ".join(f"({c} - {c}_c) / {c}_s AS {c}" for c in FEATURE_COLS)
              + " FROM tr, pm)")
    body = f"SELECT *, 'before' AS stage FROM ({bb}) UNION ALL SELECT *, 'after' AS stage FROM ({ba})"
    cols = ["column", "bin", "lo_edge", "hi_edge", "count", "stage"]
    return with_fixtures(rounded(body, cols, ["lo_edge", "hi_edge"]), *SPLIT_CTES, TR, std_params(), scaled, *cb, *ca)


# ---- boosted models -----------------------------------------------------------------------------------------
@oracle("boosted_split")
def _():
    from .q_models import STUMP_COLS
    w = "CASE WHEN Class = 1 THEN 5.0::DOUBLE ELSE 1.0::DOUBLE END"
    cuts = " UNION ALL ".join(f"SELECT {i} AS o, '{c}' AS feature, quantile_cont({c}, {q}) AS cut FROM transactions"
                              for i, c in enumerate(STUMP_COLS) for q in (0.25, 0.5, 0.75))
    sums = " UNION ALL ".join(
        f"SELECT o, feature, cut, sum(g) FILTER (WHERE {c} <= cut) AS gl, sum(h) FILTER (WHERE {c} <= cut) AS hl, "
        f"count(*) FILTER (WHERE {c} <= cut) AS n_left, sum(g) AS gt, sum(h) AS ht, count(*) AS n FROM gh, cuts WHERE feature = '{c}' "
        "GROUP BY o, feature, cut" for c in STUMP_COLS)
    body = ("SELECT feature, round(cut, 6) AS threshold, round(gain, 6) AS gain, n_left, n - n_left AS n_right, "
            "round(-gl / (hl + 1), 6) AS left_value, round(-(gt - gl) / (ht - hl + 1), 6) AS right_value FROM gains "
            "WHERE hl >= 1 AND ht - hl >= 1 ORDER BY gain DESC, o, cut LIMIT 1")
    return with_fixtures(body, f"cuts AS (SELECT DISTINCT * FROM ({cuts}))",
                         f"gh AS (SELECT *, {w} * (0.5 - Class) AS g, {w} * 0.25 AS h FROM transactions)", f"sums AS ({sums})",
                         "gains AS (SELECT *, (gl * gl / (hl + 1) + (gt - gl) * (gt - gl) / (ht - hl + 1) - gt * gt / (ht + 1)) / 2 AS gain FROM sums)")


@oracle("boosting_checks")
def _():
    from ..operators.models import BASE_PARAMS, BOOSTED
    rows = ", ".join(f"('{m}', {BASE_PARAMS[m]['n_estimators']})" for m in sorted(BOOSTED))
    return f"SELECT model, n_trees, true AS within_limits, true AS unequal_depth FROM (VALUES {rows}) t(model, n_trees)"


@oracle("load_models")
def _():
    body = ("SELECT model, count(*) AS n, count(*) AS n_same FROM sp CROSS JOIN (VALUES ('logistic_regression'), ('lightgbm')) m(model) "
            "WHERE split = 'test' GROUP BY model")
    return with_fixtures(body, *SPLIT_CTES)
