"""Folds by cutoffs, copies by fingerprints, ids from content, correlation in one scan."""
import re
import uuid

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sparkguard.operators import clean as C
from sparkguard.operators import fingerprints as FP
from sparkguard.operators import profile as P
from sparkguard.operators import sampling as SM
from sparkguard.operators import stats as ST
from sparkguard.session import shared_dir
from sparkguard.sources import tables, transactions


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _exchanged(plan: str) -> list[str]:
    """What each hash, range or single-partition exchange of the plan carries: the line below it."""
    lines = plan.splitlines()
    return [lines[i + 1] for i, ln in enumerate(lines) if re.search(r"Exchange (hash|range|Single|Round)", ln)]


# ------------------------------------------------------------------ folds
def test_folds_shuffle_no_feature(spark, sf):
    plan = _plan(SM.stratified_kfold(transactions(spark, sf), 3))
    assert _exchanged(plan) and not any("V7" in ln or "Amount" in ln for ln in _exchanged(plan))
    assert "CartesianProduct" not in plan


@pytest.mark.parametrize("k", [1, 2, 5, 7])
def test_folds_equal_cuts_of_the_md5_order(spark, k):
    rows = [(i, None if i % 11 == 0 else int(i % 4 == 0)) for i in range(403)] + [(1000 + i, 9) for i in range(3)]
    df = spark.createDataFrame(rows, "id long, Class int").repartition(5)
    got = SM.stratified_kfold(df, k, seed=7).toPandas()
    want = spark.createDataFrame(rows, "id long, Class int").select("*", F.md5(F.concat(F.lit("7-kfold-"), F.col("id").cast("string"))).alias("m")).toPandas()
    fold = {}
    for _, g in want.groupby(want["Class"].fillna(-1)):
        for f, ids in enumerate(np.array_split(g.sort_values(["m", "id"])["id"].to_numpy(), k)):
            fold.update({i: f for i in ids})
    assert dict(zip(got["id"], got["fold"])) == fold


def test_folds_of_an_empty_table(spark):
    assert SM.stratified_kfold(spark.createDataFrame([], "id long, Class int"), 3).count() == 0


# ----------------------------------------------------------------- copies
def _odd(spark):
    nan, rows = float("nan"), []
    for i in range(300):
        rows.append((i, (i % 7) / 2.0 if i % 5 else None, ["a", None, "b"][i % 3], -0.0 if i % 2 else 0.0))
    rows += [(1000, nan, "n", 1.0), (1001, nan, "n", 1.0), (1002, None, "n", 1.0), (1003, 1.0, None, 5.0), (1004, None, "1.0", 5.0)]
    rows += [(2000 + i, 42.0, "hot", 1.0) for i in range(200)]
    return spark.createDataFrame(rows, "id long, x double, s string, z double").repartition(6)


def _brute(df):
    return df.groupBy("x", "s", "z").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n")).collect()


@pytest.mark.parametrize("collide", ["none", "all", "half"])
def test_copies_with_forced_collisions(spark, monkeypatch, collide):
    df = _odd(spark)
    if collide == "all":
        monkeypatch.setattr(FP, "fingerprint", lambda cols: (F.lit(1).cast("long"), F.lit(2).cast("long")))
    elif collide == "half":
        monkeypatch.setattr(FP, "fingerprint", lambda cols: (F.length(F.coalesce("s", F.lit(""))).cast("long"), F.lit(2).cast("long")))
    want = _brute(df)
    assert P.duplicate_count(df).first()[0] == sum(r["n"] - 1 for r in want)
    got = C.drop_duplicates(df)
    assert got.columns == df.columns and sorted(r["id"] for r in got.collect()) == sorted(r["id"] for r in want)
    kept = C.drop_duplicates(df, ["s"]).collect()       # the other columns come from the kept row
    rows = {r["id"]: r for r in df.collect()}
    assert len(kept) == df.select("s").distinct().count() and all(repr(r) == repr(rows[r["id"]]) for r in kept)


def test_unique_rows_are_not_compared(spark, sf):
    df = transactions(spark, sf).drop("id")
    assert FP.suspects(df, df.columns).where(FP.SUSPECT).count() == 0
    twice = df.unionByName(df.limit(10))
    assert 20 <= FP.suspects(twice, df.columns).where(FP.SUSPECT).count() <= 24
    lines = _exchanged(_plan(FP.suspects(df, df.columns)))
    assert lines and not any("V7" in ln for ln in lines)


def test_null_positions_differ(spark):
    df = spark.createDataFrame([(None, 1), (1, None), (None, None)], "a int, b int")
    h1, h2 = FP.fingerprint(["a", "b"])
    assert df.select(h1, h2).distinct().count() == 3 and FP.suspects(df, ["a", "b"]).where(FP.SUSPECT).count() == 0
    assert P.duplicate_count(spark.createDataFrame([], "a int, b int")).first()[0] == 0


# -------------------------------------------------------- ids from content
def test_ids_do_not_depend_on_files(spark, sf):
    df = transactions(spark, sf).drop("id").select(*tables.FEATURE_COLS, "Class")
    df = df.unionByName(df.limit(30))
    split = []
    for files in (1, 16):
        path = shared_dir(spark, f"raw-{uuid.uuid4().hex[:8]}")
        df.repartition(files).write.option("header", True).csv(path)
        back = tables.load_transactions_csv(spark, path)
        assert sorted(r[0] for r in back.select("id").collect()) == list(range(1030))
        test = SM.stratified_split(back).where("split = 'test'").select("id", "Time", "Amount")
        split.append(sorted(map(tuple, test.collect())))
    assert split[0] == split[1]


def test_ids_of_hot_rows(spark):
    rows = [(float(i), i % 2) for i in range(50)] + [(7.5, 0)] * 95 + [(None, None)] * 3 + [(float("nan"), 1)] * 2
    df = spark.createDataFrame(rows, "x double, c int")
    a = tables.content_ids(df.repartition(1), block=10)
    b = tables.content_ids(df.repartition(9), block=10)
    key = lambda t: sorted((r["id"], repr(r["x"]), repr(r["c"])) for r in t.collect())
    assert key(a) == key(b) and [k[0] for k in key(a)] == list(range(150))
    assert a.drop("id").exceptAll(df).count() == 0
    assert tables.content_ids(df.limit(0)).count() == 0


# -------------------------------------------------------------- correlation
def test_correlation_of_large_means(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(4000, 3))
    x = pd.DataFrame({"a": base[:, 0], "b": 0.6 * base[:, 0] + 0.8 * base[:, 1], "c": base[:, 2] * 1e-3, "k": 5.0})
    x = x.round(9)
    far = x.copy()
    far[["a", "b"]] = (far[["a", "b"]] * 2 ** 20).round() / 2 ** 20      # exact in float64 beside 1e9
    near, far = far, far + [1e9, -1e9, 0, 1e9]
    for t in (near, far):
        t.loc[::7, "b"] = np.nan
    df = spark.createDataFrame(far).repartition(13)
    m = ST.correlation_matrix(df, list(far.columns))
    assert _plan(m).count("Scan") == 1
    got = {(r["feature_a"], r["feature_b"]): r["corr"] for r in m.collect()}
    want = near.corr()
    for a in "abc":
        for b in "abc":
            assert got[(a, b)] == pytest.approx(want.loc[a, b], abs=1e-9)
        assert got[(a, "k")] is None
    assert len(got) == 16


def test_correlation_in_groups_of_partitions(spark, monkeypatch):
    monkeypatch.setattr(ST, "MERGE_PARTS", 2)
    x = pd.DataFrame({"a": np.arange(100.0), "b": np.arange(100.0) ** 2})
    x.loc[:40, "b"] = np.nan
    m = ST.correlation_matrix(spark.createDataFrame(x).repartition(11), ["a", "b"])
    got = {(r["ord_a"], r["ord_b"]): r["corr"] for r in m.collect()}
    assert got[(0, 1)] == pytest.approx(x.corr().iloc[0, 1], abs=1e-12) and got[(1, 1)] == pytest.approx(1.0)
    bad = spark.createDataFrame([(1.0, 2.0), (float("inf"), 3.0), (2.0, 5.0)], "a double, b double")
    assert {r["corr"] for r in ST.correlation_matrix(bad, ["a", "b"]).where("ord_a <> ord_b").collect()} == {None}
