"""DuckDB twins for splitting and sampling."""
from __future__ import annotations

from .oracle_sql import oracle, rounded, with_fixtures


def rank_cte(name: str, src: str, prefix: str, part: str = "PARTITION BY Class") -> str:
    return (f"{name} AS (SELECT *, row_number() OVER ({part} ORDER BY md5('{prefix}' || CAST(id AS VARCHAR)), id) "
            f"AS rk FROM {src})")


def quota_ctes(src: str, draw: str, name: str = "q") -> list[str]:
    """Largest-remainder allocation of ``draw`` (may use _total) over classes."""
    cont = f"(CAST(_draw * n_c AS DOUBLE) / CAST(_total AS DOUBLE))"
    return [f"{name}_a AS (SELECT Class, count(*) AS n_c FROM {src} GROUP BY Class)",
            f"{name}_b AS (SELECT *, sum(n_c) OVER () AS _total FROM {name}_a)",
            f"{name}_c AS (SELECT *, {draw} AS _draw FROM {name}_b)",
            f"{name}_d AS (SELECT *, floor({cont}) AS _fl, {cont} - floor({cont}) AS _rem FROM {name}_c)",
            f"{name}_e AS (SELECT *, _draw - sum(_fl) OVER () AS _need FROM {name}_d)",
            f"{name} AS (SELECT Class, n_c, _fl + CASE WHEN row_number() OVER (ORDER BY _rem DESC, Class) <= _need "
            f"THEN 1 ELSE 0 END AS quota FROM {name}_e)"]


SPLIT_CTES = [*quota_ctes("transactions", "_total - ceil(0.2::DOUBLE * _total)"),
              rank_cte("r", "transactions", "42-"),
              "sp AS (SELECT r.*, CASE WHEN rk <= quota THEN 'train' ELSE 'test' END AS split FROM r JOIN q USING (Class))"]


@oracle("stratified_split")
def _():
    return with_fixtures("SELECT id, Class, split FROM sp", *SPLIT_CTES)


@oracle("split_class_distribution")
def _():
    body = ("SELECT split, Class, count(*) AS count, count(*) / sum(count(*)) OVER (PARTITION BY split) * 100 AS pct "
            "FROM sp GROUP BY split, Class")
    return with_fixtures(rounded(body, ["split", "Class", "count", "pct"], ["pct"]), *SPLIT_CTES)


@oracle("split_class_pivot")
def _():
    return with_fixtures("SELECT Class, count(*) FILTER (WHERE split = 'train') AS train, "
                         "count(*) FILTER (WHERE split = 'test') AS test FROM sp GROUP BY Class", *SPLIT_CTES)


@oracle("random_sample_n")
def _():
    return with_fixtures(rounded("SELECT id, Class, Amount FROM rs WHERE rk <= 2000", ["id", "Class", "Amount"],
                                 ["Amount"]), rank_cte("rs", "transactions", "42-sample-", ""))


@oracle("stratified_sample")
def _():
    t = ("t AS (SELECT count(*) AS _t, count(*) FILTER (WHERE Class = 1) AS _m1, "
         "count(*) FILTER (WHERE Class = 0) AS _m0 FROM transactions)")
    share = "(CAST(_m1 AS DOUBLE) / CAST(_t AS DOUBLE))"
    few = f"(_m1 < 2000.0::DOUBLE * {share})"
    nmin = f"CASE WHEN {few} THEN _m1 ELSE floor(2000.0::DOUBLE * {share}) END"
    nmaj = f"CASE WHEN {few} THEN least(_m0, 2000 - _m1) ELSE 2000 - floor(2000.0::DOUBLE * {share}) END"
    body = (f"SELECT id, Class FROM rs, t WHERE rk <= CASE WHEN Class = 1 THEN {nmin} ELSE {nmaj} END")
    return with_fixtures(body, t, rank_cte("rs", "transactions", "42-strat-"))


@oracle("tuning_subsample")
def _():
    ctes = [*quota_ctes("transactions_dirty", "floor(0.3::DOUBLE * _total)"),
            rank_cte("rs", "transactions_dirty", "42-frac-"),
            "n AS (SELECT count(*) AS _n FROM transactions_dirty)"]
    body = ("SELECT id, Class FROM transactions_dirty, n WHERE _n <= 10000 UNION ALL "
            "SELECT id, Class FROM rs JOIN q USING (Class), n WHERE _n > 10000 AND rk <= quota")
    return with_fixtures(body, *ctes)


@oracle("stratified_kfold")
def _():
    cut = "CAST(rk > {f} * (n // 3) + least({f}, n % 3) AS INTEGER)"
    return with_fixtures(f"SELECT id, Class, {cut.format(f=1)} + {cut.format(f=2)} AS fold "
                         "FROM (SELECT *, count(*) OVER (PARTITION BY Class) AS n FROM rs)",
                         rank_cte("rs", "transactions", "42-kfold-"))
