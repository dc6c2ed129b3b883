"""DuckDB twins of the registered queries (the correctness oracle).

Each entry is plain SQL over the shared tables; the fixture views are
written once as CTEs.  Doubles are rounded to 6 decimals on both sides.
"""
from __future__ import annotations

from ..functions.columns import FEATURE_COLS, V_COLS

TX_COLS = ["id", *FEATURE_COLS, "Class"]
ORACLES: dict[str, str] = {}


def _tx_select(extra: str = "") -> str:
    vs = ", ".join(f"CAST(m.embedding[{i + 1}] AS DOUBLE) AS {v}" for i, v in enumerate(V_COLS))
    return f"""SELECT e.event_id AS id,
         date_diff('microsecond', TIMESTAMP '2024-01-01 00:00:00', e.ts) / 1e6 AS Time,
         {vs},
         e.value AS Amount,
         CASE WHEN m.label = 0 AND e.value > 100 THEN 1 ELSE 0 END AS Class{extra}
  FROM events e CROSS JOIN (SELECT count(*) AS n FROM embeddings) c
  JOIN embeddings m ON m.vec_id = e.event_id % c.n"""


def _dirty_cols() -> str:
    out = []
    for c in TX_COLS:
        if c == "V3":
            out.append("CASE WHEN id % 89 = 0 THEN 'NaN'::DOUBLE ELSE V3 END AS V3")
        elif c == "V4":
            out.append("CASE WHEN id % 101 = 0 THEN 'Infinity'::DOUBLE "
                       "WHEN id % 103 = 0 THEN '-Infinity'::DOUBLE ELSE V4 END AS V4")
        elif c == "Amount":
            out.append("CASE WHEN id % 97 = 0 THEN NULL ELSE Amount END AS Amount")
        else:
            out.append(c)
    out.append("CASE WHEN id % 83 = 0 THEN NULL ELSE channel END AS channel")
    return ", ".join(out)


FIXTURE_CTES = f"""transactions AS ({_tx_select()}),
tx_channel AS ({_tx_select(", e.event_type AS channel")}),
dirty0 AS (SELECT {_dirty_cols()} FROM tx_channel),
transactions_dirty AS (SELECT * FROM dirty0 UNION ALL SELECT * FROM dirty0 WHERE id % 50 = 0),
scored AS (
  SELECT 'm' || CAST(k.k AS VARCHAR) AS model, t.id, t.Class AS y_true,
         CASE WHEN t.Class = 1 THEN 0.3::DOUBLE + 0.7::DOUBLE * (CAST((t.id * 7919 * k.k) % 1000 AS DOUBLE) / 1000.0::DOUBLE)
              ELSE 0.8::DOUBLE * (CAST((t.id * 7919 * k.k) % 1000 AS DOUBLE) / 1000.0::DOUBLE)
                              * (CAST((t.id * 7919 * k.k) % 1000 AS DOUBLE) / 1000.0::DOUBLE) END AS y_prob
  FROM transactions t CROSS JOIN (VALUES (1), (2), (3)) k(k)),
scored_p AS (SELECT model, id, y_true, y_prob, CAST(y_prob >= 0.5 AS INTEGER) AS y_pred FROM scored)"""


def with_fixtures(body: str, *ctes: str) -> str:
    """``WITH <fixtures>, <ctes...> <body>``."""
    extra = "".join(f",\n{c}" for c in ctes)
    return f"WITH {FIXTURE_CTES}{extra}\n{body}"


def rounded(select_sql: str, cols: list[str], doubles: list[str], order: str = "") -> str:
    """Project ``cols`` of a subquery, rounding the double ones to 6 places."""
    def q(c):
        return c if c.startswith('"') else f'"{c}"'
    dbl = {d.strip('"') for d in doubles}
    proj = ", ".join(f"round({q(c)}, 6) AS {q(c)}" if c.strip('"') in dbl else q(c) for c in cols)
    return f"SELECT {proj} FROM ({select_sql}) _r{(' ORDER BY ' + order) if order else ''}"


def cif(cond: str) -> str:
    """BIGINT conditional count (DuckDB's count_if is HUGEINT)."""
    return f"count(*) FILTER (WHERE {cond})"


def missing(c: str, is_double: bool) -> str:
    return f"({c} IS NULL OR isnan({c}))" if is_double else f"({c} IS NULL)"


def oracle(name: str):
    def deco(fn):
        ORACLES[name] = fn()
        return fn
    return deco


def load_all() -> dict[str, str]:
    from . import o_metrics, o_prep, o_profile, o_resample, o_sampling, o_stats  # noqa: F401
    return ORACLES


# Engineered transactions (feature projection) as a CTE.
DAY_PERIODS = ["Madrugada", "Mañana", "Tarde", "Noche"]
HOUR_SQL = ("(CASE WHEN (Time / 3600.0::DOUBLE) % 24.0::DOUBLE < 0 "
            "THEN ((Time / 3600.0::DOUBLE) % 24.0::DOUBLE + 24.0::DOUBLE) % 24.0::DOUBLE "
            "ELSE (Time / 3600.0::DOUBLE) % 24.0::DOUBLE END)")
ENG_DOUBLES = ["Amount_Log", "Hour", "V1_V2", "V1_V3", "V2_V3", "V14_Sq", "V17_Sq", "PCA_Dist"]
PERIOD_COLS = [f"Period_{p}" for p in DAY_PERIODS]
ENG_COLS = [*TX_COLS, "Amount_Log", "Hour", "Day_Period", "V1_V2", "V1_V3", "V2_V3", "V14_Sq",
            "V17_Sq", "PCA_Dist", *PERIOD_COLS]


def day_period_sql(h: str) -> str:
    return (f"CASE WHEN {h} >= 0 AND {h} <= 6 THEN 'Madrugada' WHEN {h} > 6 AND {h} <= 12 THEN 'Mañana' "
            f"WHEN {h} > 12 AND {h} <= 18 THEN 'Tarde' WHEN {h} > 18 AND {h} <= 24 THEN 'Noche' END")


def eng_cte(src: str = "transactions", name: str = "eng") -> str:
    dummies = ", ".join(f"coalesce(Day_Period = '{p}', false) AS \"Period_{p}\"" for p in DAY_PERIODS)
    return (f"{name}0 AS (SELECT *, ln(1 + Amount) AS Amount_Log, {HOUR_SQL} AS Hour, "
            f"{day_period_sql(HOUR_SQL)} AS Day_Period, V1 * V2 AS V1_V2, V1 * V3 AS V1_V3, V2 * V3 AS V2_V3, "
            f"V14 * V14 AS V14_Sq, V17 * V17 AS V17_Sq, "
            f"sqrt(V1 * V1 + V2 * V2 + V3 * V3 + V4 * V4 + V5 * V5) AS PCA_Dist FROM {src}),\n"
            f"{name} AS (SELECT *, {dummies} FROM {name}0)")
