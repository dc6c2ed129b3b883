"""DuckDB twins for cleaning, features and hourly statistics."""
from __future__ import annotations

from ..functions.columns import FEATURE_COLS
from .oracle_sql import (ENG_COLS, ENG_DOUBLES, PERIOD_COLS, TX_COLS, eng_cte, oracle, rounded,
                         with_fixtures)

NUM_NO_ID = [*FEATURE_COLS, "Class"]


def nn(c):  # NaN -> NULL
    return f"nullif({c}, 'NaN'::DOUBLE)"


@oracle("impute_median")
def _():
    body = ("SELECT id, coalesce(Amount, (SELECT quantile_cont(Amount, 0.5) FROM b)) AS Amount, "
            "coalesce(V3, (SELECT quantile_cont(V3, 0.5) FROM b)) AS V3 FROM b")
    return with_fixtures(rounded(body, ["id", "Amount", "V3"], ["Amount", "V3"]),
                         f"b AS (SELECT id, Amount, {nn('V3')} AS V3 FROM transactions_dirty)")


MODE_SQL = ("(SELECT channel FROM transactions_dirty WHERE channel IS NOT NULL GROUP BY channel "
            "ORDER BY count(*) DESC, channel LIMIT 1)")


@oracle("impute_mode")
def _():
    return with_fixtures(f"SELECT id, coalesce(channel, {MODE_SQL}) AS channel FROM transactions_dirty")


@oracle("replace_infinite")
def _():
    body = ("SELECT id, CASE WHEN isinf(V4) THEN (SELECT quantile_cont(V4, 0.5) FROM transactions_dirty "
            "WHERE NOT isinf(V4)) ELSE V4 END AS V4 FROM transactions_dirty")
    return with_fixtures(rounded(body, ["id", "V4"], ["V4"]))


@oracle("handle_missing")
def _():
    s1 = ("SELECT id, coalesce(Amount, (SELECT quantile_cont(Amount, 0.5) FROM b)) AS Amount, "
          "coalesce(V3, (SELECT quantile_cont(V3, 0.5) FROM b)) AS V3, V4, "
          f"coalesce(channel, {MODE_SQL}) AS channel, Class FROM b")
    body = ("SELECT id, Amount, V3, CASE WHEN isinf(V4) THEN (SELECT quantile_cont(V4, 0.5) FROM s1 "
            "WHERE NOT isinf(V4)) ELSE V4 END AS V4, channel, Class FROM s1")
    return with_fixtures(rounded(body, ["id", "Amount", "V3", "V4", "channel", "Class"], ["Amount", "V3", "V4"]),
                         f"b AS (SELECT id, Amount, {nn('V3')} AS V3, V4, channel, Class FROM transactions_dirty)",
                         f"s1 AS ({s1})")


@oracle("drop_duplicates")
def _():
    cols = [c for c in TX_COLS if c != "id"] + ["channel"]
    body = f"SELECT min(id) AS id, {', '.join(cols)} FROM transactions_dirty GROUP BY ALL"
    out = ["id", "Time", "Amount", "V3", "V4", "channel", "Class"]
    return with_fixtures(rounded(body, out, ["Time", "Amount", "V3", "V4"]))


CAP_COLS = [*FEATURE_COLS, *ENG_DOUBLES]


def cap_ctes(src: str = "transactions"):
    q = ", ".join(f"quantile_cont({c}, 0.25) AS {c}_q1, quantile_cont({c}, 0.75) AS {c}_q3" for c in CAP_COLS)
    b = ", ".join(f"{c}_q1 - 1.5::DOUBLE * ({c}_q3 - {c}_q1) AS {c}_lo, {c}_q3 + 1.5::DOUBLE * ({c}_q3 - {c}_q1) AS {c}_hi"
                  for c in CAP_COLS)
    n = ", ".join(f"count(*) FILTER (WHERE {c} < {c}_lo OR {c} > {c}_hi) AS {c}_n" for c in CAP_COLS)
    p = ", ".join(f"{c}_n / n * 100 AS {c}_pct, ({c}_n > 0 AND {c}_n / n * 100 < 5.0::DOUBLE) AS {c}_cap"
                  for c in CAP_COLS)
    return [eng_cte(src), f"q AS (SELECT {q} FROM eng)", f"b AS (SELECT * , {b} FROM q)",
            f"n AS (SELECT count(*) AS n, {n} FROM eng, b)", f"p AS (SELECT *, {p} FROM n, b)"]


@oracle("cap_outliers")
def _():
    def cap(c):
        if c not in CAP_COLS:
            return f'"{c}"'
        return (f"CASE WHEN {c}_cap THEN (CASE WHEN {c} < {c}_lo THEN {c}_lo WHEN {c} > {c}_hi THEN {c}_hi "
                f"ELSE {c} END) ELSE {c} END AS {c}")
    body = f"SELECT {', '.join(cap(c) for c in ENG_COLS)} FROM eng, p"
    return with_fixtures(rounded(body, ENG_COLS, CAP_COLS), *cap_ctes())


@oracle("cap_report")
def _():
    rows = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {i} AS ord, {c}_n AS outlier_count, {c}_pct AS outlier_pct, "
        f"{c}_lo AS lower_bound, {c}_hi AS upper_bound, CASE WHEN {c}_cap THEN 'capped' WHEN {c}_n > 0 "
        f"THEN 'skipped' ELSE 'none' END AS action FROM p" for i, c in enumerate(CAP_COLS))
    cols = ["column", "ord", "outlier_count", "outlier_pct", "lower_bound", "upper_bound", "action"]
    return with_fixtures(rounded(rows, cols, ["outlier_pct", "lower_bound", "upper_bound"]), *cap_ctes())


def _eng_select(cols, doubles):
    return with_fixtures(rounded(f"SELECT * FROM eng", cols, doubles), eng_cte())


@oracle("amount_log")
def _():
    return _eng_select(["id", "Amount", "Amount_Log"], ["Amount", "Amount_Log"])


@oracle("hour_of_day")
def _():
    return _eng_select(["id", "Time", "Hour"], ["Time", "Hour"])


@oracle("day_period")
def _():
    return _eng_select(["id", "Hour", "Day_Period"], ["Hour"])


@oracle("interactions")
def _():
    return _eng_select(["id", "V1_V2", "V1_V3", "V2_V3"], ["V1_V2", "V1_V3", "V2_V3"])


@oracle("squares")
def _():
    return _eng_select(["id", "V14_Sq", "V17_Sq"], ["V14_Sq", "V17_Sq"])


@oracle("pca_distance")
def _():
    return _eng_select(["id", "PCA_Dist"], ["PCA_Dist"])


@oracle("period_dummies")
def _():
    return _eng_select(["id", "Day_Period", *PERIOD_COLS], [])


@oracle("transform_features")
def _():
    return _eng_select(ENG_COLS, [*FEATURE_COLS, *ENG_DOUBLES])


@oracle("one_hot_categoricals")
def _():
    from .oracle_sql import DAY_PERIODS
    d = ", ".join(f"coalesce(Day_Period = '{p}', false) AS \"Day_Period_{p}\"" for p in DAY_PERIODS)
    return with_fixtures(f"SELECT id, {d} FROM eng", eng_cte())


HOURLY = ("SELECT round_even(Hour, 0) AS hour, count(*) FILTER (WHERE Class = 0) AS class_0, "
          "count(*) FILTER (WHERE Class = 1) AS class_1 FROM eng GROUP BY 1")


@oracle("hour_crosstab")
def _():
    return with_fixtures(rounded(HOURLY, ["hour", "class_0", "class_1"], ["hour"]), eng_cte())


@oracle("fraud_ratio_by_hour")
def _():
    body = f"SELECT *, class_1 / (class_0 + class_1) AS fraud_ratio FROM ({HOURLY})"
    return with_fixtures(rounded(body, ["hour", "class_0", "class_1", "fraud_ratio"], ["hour", "fraud_ratio"]),
                         eng_cte())


@oracle("count_by_day_period")
def _():
    return with_fixtures("SELECT Day_Period, count(*) AS count FROM eng GROUP BY 1", eng_cte())


NEW_FEATS = [c for c in ENG_COLS if c not in TX_COLS]


@oracle("new_feature_list")
def _():
    rows = " UNION ALL ".join(f"SELECT '{c}' AS feature, {i} AS ord, count(\"{c}\") AS non_null FROM eng"
                              for i, c in enumerate(NEW_FEATS))
    return with_fixtures(rows, eng_cte())


@oracle("align_columns")
def _():
    from .o_sampling import SPLIT_CTES
    cols = [c for c in ENG_COLS if c != "Day_Period"] + ["split"]
    body = "SELECT eng.*, sp.split FROM eng JOIN sp USING (id) WHERE sp.split = 'test'"
    return with_fixtures(rounded(body, cols, [*FEATURE_COLS, *ENG_DOUBLES]), *SPLIT_CTES, eng_cte())


@oracle("drop_target")
def _():
    cols = [c for c in ENG_COLS if c != "Class"]
    return with_fixtures(rounded("SELECT * FROM eng", cols, [*FEATURE_COLS, *ENG_DOUBLES]), eng_cte())


@oracle("count_by_category")
def _():
    body = ("SELECT CAST(Class AS VARCHAR) AS value, count(*) AS count, 'Class' AS category FROM eng GROUP BY 1 "
            "UNION ALL SELECT Day_Period AS value, count(*) AS count, 'Day_Period' AS category FROM eng GROUP BY 1")
    return with_fixtures(body, eng_cte())
