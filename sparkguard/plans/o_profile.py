"""DuckDB twins for sources and profiling queries."""
from __future__ import annotations

from ..functions.columns import FEATURE_COLS, V_COLS
from .oracle_sql import TX_COLS, missing, oracle, rounded, with_fixtures

DIRTY_COLS = [*TX_COLS, "channel"]
DIRTY_DOUBLES = set(FEATURE_COLS)
NUMERIC_NO_ID = [*FEATURE_COLS, "Class"]


@oracle("load_transactions_csv")
@oracle("load_transactions")
def _():
    return with_fixtures(rounded("SELECT * FROM transactions", TX_COLS, FEATURE_COLS))


@oracle("dataset_shape_types")
def _():
    types = {c: ("double" if c in DIRTY_DOUBLES else "bigint" if c == "id" else
                 "int" if c == "Class" else "string") for c in DIRTY_COLS}
    aggs = ", ".join(f"count({c}) AS c{i}" for i, c in enumerate(DIRTY_COLS))
    rows = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {i} AS ord, '{types[c]}' AS data_type, c{i} AS non_null, n AS rows FROM a"
        for i, c in enumerate(DIRTY_COLS))
    return with_fixtures(rows, f"a AS (SELECT count(*) AS n, {aggs} FROM transactions_dirty)")


def _missing_aggs(cols):
    return ", ".join(f"count(*) FILTER (WHERE {missing(c, c in DIRTY_DOUBLES)}) AS m{i}" for i, c in enumerate(cols))


@oracle("null_report")
def _():
    tot = " + ".join(f"m{i}" for i in range(len(DIRTY_COLS)))
    names = ", ".join(f"CASE WHEN m{i} > 0 THEN '{c}' END" for i, c in enumerate(DIRTY_COLS))
    return with_fixtures(f"SELECT {tot} AS null_values, concat_ws(',', {names}) AS null_columns FROM a",
                         f"a AS (SELECT {_missing_aggs(DIRTY_COLS)} FROM transactions_dirty)")


@oracle("null_percentage")
def _():
    rows = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {i} AS ord, m{i} AS null_count, m{i} / n * 100 AS null_pct FROM a"
        for i, c in enumerate(DIRTY_COLS))
    return with_fixtures(rounded(rows, ["column", "ord", "null_count", "null_pct"], ["null_pct"]),
                         f"a AS (SELECT count(*) AS n, {_missing_aggs(DIRTY_COLS)} FROM transactions_dirty)")


@oracle("duplicate_count")
def _():
    cols = ", ".join(f"nullif({c}, 'NaN'::DOUBLE)" if c in DIRTY_DOUBLES else c
                     for c in DIRTY_COLS if c != "id")
    return with_fixtures(
        f"SELECT coalesce(sum(c - 1), 0)::BIGINT AS duplicate_rows FROM "
        f"(SELECT count(*) AS c FROM transactions_dirty GROUP BY {cols}) g")


@oracle("infinite_count")
def _():
    s = " + ".join(f"count(*) FILTER (WHERE isinf({c}))" for c in FEATURE_COLS)
    return with_fixtures(f"SELECT {s} AS infinite_values FROM transactions_dirty")


def _iqr_rows(cols, table="transactions"):
    q = ", ".join(f"quantile_cont({c}, 0.25) AS {c}_q1, quantile_cont({c}, 0.75) AS {c}_q3" for c in cols)
    b = ", ".join(f"{c}_q1, {c}_q3, {c}_q1 - 1.5::DOUBLE * ({c}_q3 - {c}_q1) AS {c}_lo, "
                  f"{c}_q3 + 1.5::DOUBLE * ({c}_q3 - {c}_q1) AS {c}_hi" for c in cols)
    cnt = ", ".join(f"count(*) FILTER (WHERE {c} < {c}_lo OR {c} > {c}_hi) AS {c}_n" for c in cols)
    rows = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {i} AS ord, {c}_q1 AS q1, {c}_q3 AS q3, {c}_lo AS lower_bound, "
        f"{c}_hi AS upper_bound, {c}_n AS outlier_count, {c}_n / n * 100 AS outlier_pct FROM cnt, b"
        for i, c in enumerate(cols))
    ctes = [f"q AS (SELECT {q} FROM {table})", f"b AS (SELECT {b} FROM q)",
            f"cnt AS (SELECT count(*) AS n, {cnt} FROM {table}, b)"]
    return rows, ctes


IQR_COLS = ["column", "ord", "q1", "q3", "lower_bound", "upper_bound", "outlier_count", "outlier_pct"]


@oracle("iqr_outlier_report")
def _():
    rows, ctes = _iqr_rows(NUMERIC_NO_ID)
    return with_fixtures(rounded(rows, IQR_COLS, IQR_COLS[2:4] + IQR_COLS[4:6] + ["outlier_pct"]), *ctes)


@oracle("iqr_mask")
def _():
    body = ("SELECT t.id, t.Amount, coalesce(t.Amount < lo OR t.Amount > hi, false) AS is_outlier, "
            "lo AS lower_bound, hi AS upper_bound FROM transactions t, "
            "(SELECT q1 - 1.5::DOUBLE * (q3 - q1) AS lo, q3 + 1.5::DOUBLE * (q3 - q1) AS hi FROM "
            "(SELECT quantile_cont(Amount, 0.25) AS q1, quantile_cont(Amount, 0.75) AS q3 FROM transactions)) b")
    return with_fixtures(rounded(body, ["id", "Amount", "is_outlier", "lower_bound", "upper_bound"],
                                 ["Amount", "lower_bound", "upper_bound"]))


@oracle("top_outlier_columns")
def _():
    rows, ctes = _iqr_rows(V_COLS)
    body = f"SELECT \"column\", outlier_count, outlier_pct FROM ({rows}) r ORDER BY outlier_pct DESC, ord LIMIT 5"
    return with_fixtures(rounded(body, ["\"column\"", "outlier_count", "outlier_pct"], ["outlier_pct"]), *ctes)


@oracle("class_distribution")
def _():
    return with_fixtures(rounded(
        "SELECT Class, count(*) AS count, count(*) / sum(count(*)) OVER () * 100 AS pct FROM transactions GROUP BY Class",
        ["Class", "count", "pct"], ["pct"]))


@oracle("class_imbalance")
def _():
    return with_fixtures(rounded(
        "SELECT abs(count(*) FILTER (WHERE Class = 0) / count(*) * 100 - count(*) FILTER (WHERE Class = 1) / count(*) * 100) AS class_imbalance "
        "FROM transactions", ["class_imbalance"], ["class_imbalance"]))


@oracle("quality_summary")
def _():
    tot = " + ".join(f"m{i}" for i in range(len(DIRTY_COLS)))
    names = ", ".join(f"CASE WHEN m{i} > 0 THEN '{c}' END" for i, c in enumerate(DIRTY_COLS))
    inf = " + ".join(f"count(*) FILTER (WHERE isinf({c}))" for c in FEATURE_COLS)
    dcols = ", ".join(f"nullif({c}, 'NaN'::DOUBLE)" if c in DIRTY_DOUBLES else c
                      for c in DIRTY_COLS if c != "id")
    body = (f"SELECT n AS rows, {len(DIRTY_COLS)} AS columns, {tot} AS null_values, "
            f"concat_ws(',', {names}) AS null_columns, d.duplicate_rows, inf AS infinite_values, "
            "c0 / n * 100 AS class_0_pct, c1 / n * 100 AS class_1_pct, abs(c0 / n * 100 - c1 / n * 100) AS class_imbalance "
            "FROM a, d")
    cols = ["rows", "columns", "null_values", "null_columns", "duplicate_rows", "infinite_values",
            "class_0_pct", "class_1_pct", "class_imbalance"]
    return with_fixtures(rounded(body, cols, cols[-3:]),
                         f"a AS (SELECT count(*) AS n, {_missing_aggs(DIRTY_COLS)}, {inf} AS inf, "
                         f"count(*) FILTER (WHERE Class = 0) AS c0, count(*) FILTER (WHERE Class = 1) AS c1 FROM transactions_dirty)",
                         f"d AS (SELECT coalesce(sum(c - 1), 0)::BIGINT AS duplicate_rows FROM "
                         f"(SELECT count(*) AS c FROM transactions_dirty GROUP BY {dcols}) g)")


@oracle("describe")
def _():
    cols = NUMERIC_NO_ID
    aggs = ", ".join(
        f"count({c}) AS {c}_n, avg({c}) AS {c}_mean, stddev_samp({c}) AS {c}_std, CAST(min({c}) AS DOUBLE) AS {c}_min, "
        f"CAST(max({c}) AS DOUBLE) AS {c}_max, quantile_cont({c}, 0.25) AS {c}_q25, quantile_cont({c}, 0.5) AS {c}_q50, "
        f"quantile_cont({c}, 0.75) AS {c}_q75" for c in cols)
    rows = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {i} AS ord, {c}_n AS count, {c}_mean AS mean, {c}_std AS std, {c}_min AS min, "
        f"{c}_q25 AS q25, {c}_q50 AS q50, {c}_q75 AS q75, {c}_max AS max FROM a" for i, c in enumerate(cols))
    out = ["\"column\"", "ord", "count", "mean", "std", "min", "q25", "q50", "q75", "max"]
    return with_fixtures(rounded(rows, out, out[3:]), f"a AS (SELECT {aggs} FROM transactions)")


@oracle("fraud_vs_legit")
def _():
    return with_fixtures("SELECT count(*) FILTER (WHERE Class = 1) AS fraud_rows, count(*) FILTER (WHERE Class = 0) AS legit_rows FROM transactions")


@oracle("count_by_class")
def _():
    return with_fixtures("SELECT Class, count(*) AS count FROM transactions GROUP BY Class")
