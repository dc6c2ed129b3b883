"""Quartiles and outlier counts in two scans, against numpy."""
import numpy as np
import pandas as pd
import pytest

from sparkguard.operators import profile as P
from sparkguard.operators import quantiles as Q


def _columns(n=6000):
    rng = np.random.default_rng(11)
    x = pd.DataFrame({
        "normal": rng.normal(size=n), "heavy": np.exp(rng.normal(size=n) * 4),
        "hot": np.where(rng.random(n) < 0.4, 7.0, rng.normal(size=n) * 3 + 5),
        "few": rng.integers(0, 3, n).astype(float), "constant": 2.5, "int": rng.integers(-50, 60, n),
        "gaps": np.where(rng.random(n) < 0.3, np.nan, rng.normal(size=n)),
        "ends": np.where(rng.random(n) < 0.02, np.inf, np.where(rng.random(n) < 0.02, -np.inf, rng.normal(size=n))),
        "tiny": np.where(np.arange(n) < 3, np.arange(n) * 1.0, np.nan), "none": np.nan})
    return x


def _check(got, x):
    for c in x.columns:
        v = x[c].to_numpy("float64")
        v = v[~np.isnan(v)]
        r = got[c]
        if len(v) == 0:
            assert r["q1"] is None and r["outlier_count"] == 0
            continue
        q1, q3 = np.percentile(v, [25, 75])
        assert r["q1"] == pytest.approx(q1, rel=1e-12, abs=1e-12) and r["q3"] == pytest.approx(q3, rel=1e-12, abs=1e-12), c
        assert r["outlier_count"] == int(((v < r["lower_bound"]) | (v > r["upper_bound"])).sum()), c
        assert r["outlier_pct"] == pytest.approx(100.0 * r["outlier_count"] / len(x))


@pytest.mark.parametrize("small", [None, 400, 3])
def test_outliers_equal_numpy(spark, monkeypatch, small):
    """``small`` forces brackets that are cut by rank, and brackets that are cut again."""
    if small:
        monkeypatch.setattr(Q, "FINISH_ROWS", small)
        monkeypatch.setattr(Q, "SKETCH_ACCURACY", 100)
    x = _columns()
    df = spark.createDataFrame(x).repartition(7)
    _check({r["column"]: r for r in P.iqr_outlier_report(df, list(x.columns)).collect()}, x)


def test_sketch_that_misses(spark, monkeypatch):
    """Bad sketches cost scans, not exactness."""
    monkeypatch.setattr(Q, "KLL_K", 8)
    monkeypatch.setattr(Q, "MERGE_TASKS", 2)
    monkeypatch.setattr(Q, "FINISH_ROWS", 500)
    monkeypatch.setattr(Q, "SKETCH_ACCURACY", 100)
    x = _columns()[["normal", "heavy", "hot", "few"]]
    df = spark.createDataFrame(x).repartition(9)
    _check({r["column"]: r for r in P.iqr_outlier_report(df, list(x.columns)).collect()}, x)


def test_finishing_scan_runs_once(spark, monkeypatch):
    seen, real = [], Q._counts_wide
    monkeypatch.setattr(Q, "_counts_wide", lambda df, cols, spans: seen.append(len(spans)) or real(df, cols, spans))
    monkeypatch.setattr(Q, "_counts_long", lambda *a: pytest.fail("unpivoted rows"))
    x = _columns()[["normal", "heavy", "hot", "gaps", "int"]]
    df = spark.createDataFrame(x).repartition(5)
    monkeypatch.setattr(Q, "SKETCH_ACCURACY", 100)
    P.iqr_outlier_report(df, list(x.columns)).collect()
    assert len(seen) == 1


def test_empty_table(spark):
    rep = P.iqr_outlier_report(spark.createDataFrame([], "a double, b int"), ["a", "b"]).collect()
    assert [(r["q1"], r["outlier_count"], r["outlier_pct"]) for r in rep] == [(None, 0, None)] * 2
