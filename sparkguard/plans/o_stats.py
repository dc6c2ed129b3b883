"""DuckDB twins for the exploratory statistics."""
from __future__ import annotations

import math

from ..functions.columns import FEATURE_COLS, V_COLS
from .o_sampling import rank_cte
from .oracle_sql import HOUR_SQL, oracle, rounded, with_fixtures

CORR_COLS = [*FEATURE_COLS, "Class", "Hour"]
HIST_BINS = {"Amount": 50, "Amount_Log": 50, "Time": 50, "Hour": 24, **{f"V{i}": 50 for i in range(1, 7)}}
KDE_COLS = ["Amount", "Amount_Log", "Time", "Hour", "V1", "V2", "V3"]
CBC = ["V1", "V2", "V3", "V4", "V5", "Amount"]
LONG_POOL = V_COLS + ["Time", "Amount", "Hour"]

EDA = f"eda AS (SELECT *, {HOUR_SQL} AS Hour, ln(1 + Amount) AS Amount_Log FROM transactions)"


def long_cte(name: str, cols: list[str], src: str = "eda", keep: str = "id, Class AS _cls") -> str:
    body = " UNION ALL ".join(f"SELECT {keep}, '{c}' AS \"column\", {i} AS ord, CAST({c} AS DOUBLE) AS x FROM {src}"
                              for i, c in enumerate(cols))
    return f"{name} AS (SELECT * FROM ({body}) WHERE x IS NOT NULL AND NOT isnan(x))"


FEATS = [c for c in CORR_COLS if c != "Class"]
CWC = "cwc AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {i} AS ord, corr({c}, Class) AS corr FROM eda" for i, c in enumerate(FEATS)) + ")"


def topk_cte(k: int, name: str) -> str:
    return (f"{name} AS (SELECT feature AS \"column\" FROM cwc ORDER BY abs(corr) DESC NULLS LAST, ord LIMIT {k})")


MATRIX = ("SELECT a.\"column\" AS feature_a, a.ord AS ord_a, b.\"column\" AS feature_b, b.ord AS ord_b, "
          "greatest(-1.0, least(1.0, corr(a.x, b.x))) AS corr FROM lc a JOIN lc b USING (id) GROUP BY ALL")
MCOLS = ["feature_a", "ord_a", "feature_b", "ord_b", "corr"]


@oracle("correlation_matrix")
def _():
    return with_fixtures(rounded(MATRIX, MCOLS, ["corr"]), EDA, long_cte("lc", CORR_COLS))


@oracle("corr_lower_triangle")
def _():
    return with_fixtures(rounded(f"SELECT * FROM ({MATRIX}) WHERE ord_a > ord_b", MCOLS, ["corr"]), EDA,
                         long_cte("lc", CORR_COLS))


@oracle("corr_with_class")
def _():
    return with_fixtures(rounded("SELECT * FROM cwc", ["feature", "ord", "corr"], ["corr"]), EDA, CWC)


@oracle("corr_top_bottom")
def _():
    body = ("(SELECT *, 'top' AS part FROM cwc ORDER BY corr DESC NULLS LAST, ord LIMIT 10) UNION ALL "
            "(SELECT *, 'bottom' AS part FROM cwc ORDER BY corr ASC NULLS FIRST, ord DESC LIMIT 10)")
    return with_fixtures(rounded(body, ["feature", "ord", "corr", "part"], ["corr"]), EDA, CWC)


@oracle("top_abs_corr")
def _():
    return with_fixtures(rounded("SELECT * FROM cwc ORDER BY abs(corr) DESC NULLS LAST, ord LIMIT 6",
                                 ["feature", "ord", "corr"], ["corr"]), EDA, CWC)


@oracle("corr_by_class")
def _():
    body = " UNION ALL ".join(f"SELECT Class, '{a}' AS feature_a, '{b}' AS feature_b, corr({a}, {b}) AS corr "
                              f"FROM eda GROUP BY Class" for a in CBC for b in CBC)
    return with_fixtures(rounded(body, ["Class", "feature_a", "feature_b", "corr"], ["corr"]), EDA)


def hist_ctes(bins: dict[str, int], by: bool, src: str = "eda", pre: str = "") -> tuple[list[str], str]:
    nb = ", ".join(f"('{c}', {n})" for c, n in bins.items())
    edge = "(CASE WHEN {i} >= nb THEN hi ELSE {i} * step + lo END)"
    grp = "_cls, " if by else ""
    P = pre
    ctes = [long_cte(f"{P}lh", list(bins), src), f"{P}nb(\"column\", nb) AS (VALUES {nb})",
            f"{P}rng AS (SELECT \"column\", min(x) AS _mn, max(x) AS _mx FROM {P}lh GROUP BY 1)",
            f"{P}pr AS (SELECT r.\"column\", nb, CASE WHEN _mn = _mx THEN _mn - 0.5 ELSE _mn END AS lo, "
            f"CASE WHEN _mn = _mx THEN _mx + 0.5 ELSE _mx END AS hi FROM {P}rng r JOIN {P}nb USING (\"column\"))",
            f"{P}pr2 AS (SELECT *, (hi - lo) / nb AS step FROM {P}pr)",
            f"{P}j AS (SELECT l._cls, l.\"column\", l.x, p.nb, p.lo, p.hi, p.step, "
            f"CAST(least(nb - 1, floor((x - lo) / (hi - lo) * nb)) AS INTEGER) AS g0 FROM {P}lh l JOIN {P}pr2 p USING (\"column\"))",
            f"{P}j1 AS (SELECT *, CASE WHEN x < {edge.format(i='g0')} THEN g0 - 1 ELSE g0 END AS g1 FROM {P}j)",
            f"{P}j2 AS (SELECT *, CASE WHEN x >= {edge.format(i='(g1 + 1)')} AND g1 <> nb - 1 THEN g1 + 1 ELSE g1 END "
            f"AS bin FROM {P}j1)",
            f"{P}cnt AS (SELECT {grp}\"column\", bin, count(*) AS count FROM {P}j2 GROUP BY ALL)",
            f"{P}fr0 AS (SELECT *, unnest(generate_series(0, nb - 1)) AS bin FROM {P}pr2)",
            f"{P}fr AS (SELECT {'c._cls, ' if by else ''}\"column\", bin, {edge.format(i='bin')} AS lo_edge, "
            f"{edge.format(i='(bin + 1)')} AS hi_edge FROM {P}fr0{f', (SELECT DISTINCT _cls FROM {P}lh) c' if by else ''})"]
    on = "USING (_cls, \"column\", bin)" if by else "USING (\"column\", bin)"
    body = (f"SELECT {'fr._cls AS Class, ' if by else ''}fr.\"column\", fr.bin, lo_edge, hi_edge, "
            f"coalesce(count, 0) AS count FROM {P}fr fr LEFT JOIN {P}cnt {on}")
    return ctes, body


@oracle("histogram")
def _():
    ctes, body = hist_ctes(HIST_BINS, False)
    return with_fixtures(rounded(body, ["column", "bin", "lo_edge", "hi_edge", "count"], ["lo_edge", "hi_edge"]),
                         EDA, *ctes)


@oracle("histogram_by_class")
def _():
    ctes, body = hist_ctes({"Amount": 50}, True)
    return with_fixtures(rounded(body, ["Class", "column", "bin", "lo_edge", "hi_edge", "count"],
                                 ["lo_edge", "hi_edge"]), EDA, *ctes)


def kde_ctes(cols, by: bool, only: str | None):
    """The Gaussian summed over the rows themselves, without cells."""
    grp = "_cls, " if by else ""
    sel = f" WHERE \"column\" IN (SELECT \"column\" FROM {only})" if only else ""
    ctes = [long_cte("lk0", cols), f"lk AS (SELECT * FROM lk0{sel})",
            f"st AS (SELECT {grp}\"column\", count(*) AS n, stddev_samp(x) AS sd, min(x) AS mn, max(x) AS mx "
            "FROM lk GROUP BY ALL)",
            "st2 AS (SELECT *, sd * pow(CAST(n AS DOUBLE), -0.2) AS bw FROM st)",
            "gr AS (SELECT *, unnest(generate_series(0, 199)) AS grid_idx, mn - 3.0 * bw AS _lo, mx + 3.0 * bw AS _hi "
            "FROM st2 WHERE bw > 0)",
            "gr2 AS (SELECT *, CASE WHEN grid_idx = 199 THEN _hi ELSE grid_idx * ((_hi - _lo) / 199) + _lo END AS gx FROM gr)"]
    z = "((g.gx - l.x) / g.bw)"
    body = (f"SELECT {'g._cls AS Class, ' if by else ''}g.\"column\", g.grid_idx, g.gx AS x, "
            f"sum(exp(-0.5 * {z} * {z})) / (first(g.n) * first(g.bw) * {math.sqrt(2 * math.pi)!r}) AS density "
            f"FROM gr2 g JOIN lk l USING ({grp}\"column\") GROUP BY ALL")
    return ctes, body


@oracle("kde")
def _():
    ctes, body = kde_ctes(KDE_COLS, False, None)
    body = f'SELECT "column", grid_idx, x, round(density, 5) AS density FROM ({body})'
    return with_fixtures(rounded(body, ["column", "grid_idx", "x", "density"], ["x", "density"]), EDA, *ctes)


@oracle("kde_by_class")
def _():
    ctes, body = kde_ctes(LONG_POOL, True, "top6")
    return with_fixtures(rounded(body, ["Class", "column", "grid_idx", "x", "density"], ["x", "density"]),
                         EDA, CWC, topk_cte(6, "top6"), *ctes)


def box_ctes(cols, by: bool, only: str | None):
    grp = "_cls, " if by else ""
    sel = f" WHERE \"column\" IN (SELECT \"column\" FROM {only})" if only else ""
    return [long_cte("lb0", cols), f"lb AS (SELECT * FROM lb0{sel})",
            f"q AS (SELECT {grp}\"column\", quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median, "
            "quantile_cont(x, 0.75) AS q3 FROM lb GROUP BY ALL)",
            "q2 AS (SELECT *, q1 - 1.5 * (q3 - q1) AS _lo, q3 + 1.5 * (q3 - q1) AS _hi FROM q)",
            f"w AS (SELECT {grp}\"column\", coalesce(min(x) FILTER (WHERE x >= _lo), first(q1)) AS whisker_lo, "
            f"coalesce(max(x) FILTER (WHERE x <= _hi), first(q3)) AS whisker_hi FROM lb JOIN q2 USING ({grp}\"column\") "
            "GROUP BY ALL)",
            f"f AS (SELECT {grp}\"column\", count(*) FILTER (WHERE x < whisker_lo OR x > whisker_hi) AS fliers "
            f"FROM lb JOIN w USING ({grp}\"column\") GROUP BY ALL)"]


BOX_COLS = ["column", "q1", "median", "q3", "whisker_lo", "whisker_hi", "fliers"]


@oracle("boxplot_stats")
def _():
    body = "SELECT * FROM q JOIN w USING (\"column\") JOIN f USING (\"column\")"
    return with_fixtures(rounded(body, BOX_COLS, BOX_COLS[1:6]), EDA, *box_ctes(FEATURE_COLS, False, None))


@oracle("boxplot_by_class")
def _():
    body = "SELECT _cls AS Class, * FROM q JOIN w USING (_cls, \"column\") JOIN f USING (_cls, \"column\")"
    sel = "sel AS (SELECT \"column\" FROM top6 UNION SELECT 'Amount')"
    return with_fixtures(rounded(body, ["Class", *BOX_COLS], BOX_COLS[1:6]), EDA, CWC, topk_cte(6, "top6"), sel,
                         *box_ctes(LONG_POOL, True, "sel"))


@oracle("amount_by_class")
def _():
    body = ("SELECT Class, count(Amount) AS count, avg(Amount) AS mean, stddev_samp(Amount) AS std, "
            "CAST(min(Amount) AS DOUBLE) AS min, quantile_cont(Amount, 0.25) AS q25, quantile_cont(Amount, 0.5) AS q50, "
            "quantile_cont(Amount, 0.75) AS q75, CAST(max(Amount) AS DOUBLE) AS max FROM transactions GROUP BY Class")
    cols = ["Class", "count", "mean", "std", "min", "q25", "q50", "q75", "max"]
    return with_fixtures(rounded(body, cols, cols[2:]))


@oracle("pairplot_data")
def _():
    t = ("t AS (SELECT count(*) AS _t, count(*) FILTER (WHERE Class = 1) AS _m1, "
         "count(*) FILTER (WHERE Class = 0) AS _m0 FROM eda)")
    share = "(CAST(_m1 AS DOUBLE) / CAST(_t AS DOUBLE))"
    few = f"(_m1 < 2000.0::DOUBLE * {share})"
    nmin = f"CASE WHEN {few} THEN _m1 ELSE floor(2000.0::DOUBLE * {share}) END"
    nmaj = f"CASE WHEN {few} THEN least(_m0, 2000 - _m1) ELSE 2000 - floor(2000.0::DOUBLE * {share}) END"
    samp = f"samp AS (SELECT rs.* FROM rs, t WHERE rk <= CASE WHEN Class = 1 THEN {nmin} ELSE {nmaj} END)"
    body = ("SELECT id, _cls AS Class, \"column\" AS feature, x AS value FROM lp "
            "WHERE \"column\" IN (SELECT \"column\" FROM top4)")
    return with_fixtures(rounded(body, ["id", "Class", "feature", "value"], ["value"]), EDA, CWC, topk_cte(4, "top4"),
                         t, rank_cte("rs", "eda", "42-strat-"), samp, long_cte("lp", LONG_POOL, "samp"))
