"""Boosting against closed forms, plain re-computation and the nearest pyspark.ml model; exact Shapley values against enumeration."""
from dataclasses import replace
from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkguard.operators import boosting as B
from sparkguard.operators import models as ML
from sparkguard.operators import tree_shap as TS
from sparkguard.sources import models_io as IO

N, D = 3000, 6
FEATS = [f"f{j}" for j in range(D)]


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(0)
    x = np.round(rng.normal(size=(N, D)), 3)
    x[::50, 3] = np.nan
    y = ((x[:, 0] * x[:, 1] + x[:, 2] > 1.2) | (rng.random(N) < 0.01)).astype(int)
    return x, y


@pytest.fixture(scope="module")
def frame(spark, data):
    x, y = data
    return spark.createDataFrame([(i, int(y[i]), *map(float, x[i])) for i in range(N)],
                                 "id long, Class int, " + ", ".join(f"{c} double" for c in FEATS)).cache()


@pytest.fixture(scope="module")
def binned(frame):
    return B.bin_features(frame, FEATS, bins=16)


def codes(binned, x):
    out = np.stack([np.searchsorted(e, x[:, f]) for f, e in enumerate(binned.edges)], axis=1)
    return np.where(np.isnan(x), [len(e) for e in binned.edges], out)


def plain_tree(c, g, h, p, bins):
    """One split at a time, the best open leaf first; every sum taken anew.  {rows of a leaf: value}"""
    def best(rows):
        found = None
        for f in range(D):
            for t in range(bins - 1):
                low, high = rows[c[rows, f] <= t], rows[c[rows, f] > t]
                if min(len(low), len(high)) < p.min_rows or min(h[low].sum(), h[high].sum()) < p.min_hessian:
                    continue
                score = lambda r: g[r].sum() ** 2 / (h[r].sum() + p.reg_lambda)
                gain = (score(low) + score(high) - score(rows)) / 2 - p.gamma
                if found is None or gain > found[0] + 1e-9:
                    found = (gain, low, high)
        return found
    leaves = [(np.arange(len(c)), 0)]
    while not p.leaves or len(leaves) < p.leaves:
        found = [(best(r), i) for i, (r, depth) in enumerate(leaves) if not p.depth or depth < p.depth]
        found = [(b, i) for b, i in found if b and b[0] > 1e-12]
        if not found:
            break
        (_, low, high), i = max(found, key=lambda b: b[0][0])
        depth = leaves.pop(i)[1] + 1
        leaves += [(low, depth), (high, depth)]
    return {tuple(sorted(r)): -p.rate * g[r].sum() / (h[r].sum() + p.reg_lambda) for r, _ in leaves}


@pytest.mark.parametrize("params", [replace(B.LEAFWISE, leaves=9, rounds=2), replace(B.SECOND_ORDER, depth=3, rounds=2, positive_weight=3.0, gamma=0.5)])
def test_trees_equal_one_split_at_a_time(binned, data, params):
    x, y = data
    model, = B.fit_many(binned, [params])
    c, w = codes(binned, x), np.where(y == 1, params.positive_weight, 1.0)
    margin = np.full(N, model.start)
    for tree in model.trees:
        p = 1 / (1 + np.exp(-margin))
        want = plain_tree(c, w * (p - y), w * p * (1 - p), params, 16)
        leaf = tree.leaf_of(x)
        got = {tuple(np.flatnonzero(leaf == i)): tree.value[i] for i in np.unique(leaf)}
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-6 for k in want)
        margin += tree.value[leaf]


def test_leafwise_shape_and_quality(frame, data):
    x, y = np.nan_to_num(data[0]), data[1]
    full = frame.fillna(0.0, FEATS)                             # the pyspark.ml trees take no missing values
    model = ML.fit_model(full, FEATS, "lightgbm", {"n_estimators": 12})
    depths = [t.depths() for t in model.trees]
    assert max(map(len, depths)) <= 31 and any(d.min() < d.max() for d in depths)
    est = ML.build_estimator("lightgbm", {"n_estimators": 12}).fit(ML.prepare(full, FEATS, "lightgbm"))
    ml = [r.p for r in ML.score(est, full, FEATS, "m").orderBy("id").select(F.col("y_prob").alias("p")).collect()]

    def auc(score):
        rank = np.argsort(np.argsort(score, kind="stable"))
        return (rank[y == 1].sum() - y.sum() * (y.sum() - 1) / 2) / (y.sum() * (N - y.sum()))
    assert auc(model.margin(x)) >= auc(np.array(ml)) - 1e-9


def test_fits_side_by_side_partitions_and_samples(spark, frame, binned, monkeypatch):
    some = [replace(B.LEAFWISE, rounds=3, leaves=5), replace(B.SECOND_ORDER, rounds=11, depth=2, columns=0.5, rows=0.7)]
    together = B.fit_many(binned, some)
    monkeypatch.setattr(B, "FEW_ROWS", 0)                       # the shuffled sums
    other = B.bin_features(frame.repartition(9), FEATS, edges=binned.edges)
    alone = [B.fit_many(other, [p])[0] for p in some]
    for a, b in zip(together, alone):
        assert len(a.trees) == len(b.trees) == a.params.rounds
        for s, t in zip(a.trees, b.trees):
            assert all(np.array_equal(getattr(s, k), getattr(t, k)) for k in ("feature", "bin", "value"))
    assert {f for t in together[1].trees for f in t.feature if f >= 0} and all(len(set(t.feature) - {-1}) <= 3 for t in together[1].trees)


def test_left_out_folds(spark, frame):
    folds = frame.withColumn("fold", F.col("id") % 3)
    b = B.bin_features(folds, FEATS, fold="fold", bins=16)
    p = replace(B.LEAFWISE, rounds=5, leaves=8)
    models = B.fit_many(b, [replace(p, fold=i) for i in range(3)])
    own, = B.fit_many(B.bin_features(folds.where("fold <> 1"), FEATS, edges=b.edges), [p])
    assert all(np.allclose(s.value, t.value) for s, t in zip(models[1].trees, own.trees))
    f1 = B.fold_f1(b, models)
    pred = models[1].transform(ML.prepare(folds.where("fold = 1"), FEATS, "gradient_boosting"))
    tp, pp, pos = pred.agg(F.sum(F.col("prediction") * F.col("Class")), F.sum("prediction"), F.sum("Class")).first()
    assert abs(f1[1] - 2 * tp / (pp + pos)) < 1e-12


def test_search_over_boosted_models(frame, monkeypatch):
    monkeypatch.setitem(ML.PARAM_GRIDS, "lightgbm", {"n_estimators": [3, 5], "learning_rate": [0.1], "max_depth": [-1], "num_leaves": [4, 8], "subsample": [0.8]})
    refit, best, f1 = ML.random_search_cv(frame, FEATS, "lightgbm", n_iter=3, subsample=1.0)
    assert len(refit.trees) == best["n_estimators"] and 0 <= f1 <= 1
    assert max(len(t.depths()) for t in refit.trees) <= best["num_leaves"]


def test_one_class_constant_and_empty(spark, frame):
    one = frame.where("Class = 0").withColumn("f0", F.lit(1.0))
    m = B.fit(one, FEATS, replace(B.LEAFWISE, rounds=2))
    assert all(np.isfinite(t.value).all() for t in m.trees)
    none = B.fit(frame.limit(0), FEATS, replace(B.LEAFWISE, rounds=1))
    assert none.margin(np.zeros((1, D))).tolist() == [0.0]


def test_save_and_load(spark, frame, binned, data, tmp_path):
    model, = B.fit_many(binned, [replace(B.SECOND_ORDER, rounds=2, depth=3)])
    IO.save_model(model, str(tmp_path), "best_2000_trees")
    registry = IO.model_registry(spark, str(tmp_path))
    assert registry.first()["model"] == "best_2000_trees"
    again = IO.load_models(registry)["best_2000_trees"]
    assert np.array_equal(again.margin(data[0]), model.margin(data[0])) and again.params == model.params
    assert abs(sum(model.featureImportances.toArray()) - 1) < 1e-12


# ---- Shapley values -------------------------------------------------------------------------------------------
def enumerated(margin, x, background):
    """Shapley values of ``x`` by all subsets; the missing features come from every background row."""
    d = len(x)
    value = {}
    for size in range(d + 1):
        for s in combinations(range(d), size):
            z = background.copy()
            z[:, list(s)] = x[list(s)]
            value[s] = margin(z).mean()
    phi = np.zeros(d)
    for f in range(d):
        for s in value:
            if f not in s:
                phi[f] += factorial(len(s)) * factorial(d - len(s) - 1) / factorial(d) * (value[tuple(sorted((*s, f)))] - value[s])
    return phi


def shapley(model, df, background):
    rows = TS.tree_shapley(model, df, FEATS, background).collect()
    out = {}
    for r in rows:
        out.setdefault(r.id, {})[r.ord] = r
    for by in out.values():
        assert len(by) == D and abs(sum(r.phi for r in by.values()) - (by[0].fx - by[0].base)) < 1e-9
    return out


@pytest.mark.parametrize("params", [replace(B.LEAFWISE, rounds=4), replace(B.SECOND_ORDER, rounds=1, depth=6, min_hessian=0.0)])
def test_shapley_equals_enumeration(frame, binned, data, params):
    model, = B.fit_many(binned, [params])
    background = frame.where("id < 40")
    got = shapley(model, frame.where("id >= 45 AND id < 55"), background)           # row 50 has a missing value
    for i, by in got.items():
        want = enumerated(model.margin, data[0][i], data[0][:40])
        assert np.allclose([by[f].phi for f in range(D)], want, atol=1e-9) and abs(by[0].fx - model.margin(data[0][i:i + 1])[0]) < 1e-9


def test_shapley_of_a_library_model(frame, data):
    full = frame.fillna(0.0, FEATS)
    x = np.nan_to_num(data[0])
    fitted = ML.fit_model(full, FEATS, "gradient_boosting", {"n_estimators": 4, "max_depth": 3})
    leaves, start = TS.ensemble_leaves(fitted)

    def margin(z):
        return start + sum(leaf.value * (leaf.patterns(z) == (1 << len(leaf.features)) - 1) for leaf in leaves)
    scored = {r.id: r.y_prob for r in ML.score(fitted, full, FEATS, "m").collect()}
    assert np.allclose(1 / (1 + np.exp(-margin(x))), [scored[i] for i in range(N)], atol=1e-9)
    got = shapley(fitted, full.where("id < 5"), full.where("id < 30"))
    for i, by in got.items():
        assert np.allclose([by[f].phi for f in range(D)], enumerated(margin, x[i], x[:30]), atol=1e-9)


def test_many_rows_are_written_every_second_tree(binned, monkeypatch):
    """Passes walk one finished tree at most above MANY_ROWS; the trees stay the same."""
    p = replace(B.LEAFWISE, rounds=5, leaves=6)
    few, = B.fit_many(binned, [p])
    walked, plain = [], B._pass
    monkeypatch.setattr(B, "MANY_ROWS", 0)
    monkeypatch.setattr(B, "_pass", lambda state, fits, *rest: (walked.append(max(len(f[3]) for f in fits)), plain(state, fits, *rest))[1])
    many, = B.fit_many(binned, [p])
    assert max(walked) == 1
    for s, t in zip(few.trees, many.trees, strict=True):
        assert all(np.array_equal(getattr(s, k), getattr(t, k)) for k in ("feature", "bin", "value", "gain"))


def test_rows_that_fit_a_task_need_no_pass(spark, frame, monkeypatch):
    """The trees of one task are those of the passes, with sampled rows and columns, left-out folds and unequal rounds too."""
    b = B.bin_features(frame.withColumn("fold", F.col("id") % 3), FEATS, fold="fold", bins=16)
    some = [replace(B.LEAFWISE, rounds=4, leaves=7, fold=1), replace(B.SECOND_ORDER, rounds=3, depth=3, columns=0.5, rows=0.7, positive_weight=5.0),
            replace(B.LEAFWISE, rounds=2, rows=0.8, depth=4)]
    with monkeypatch.context() as m:
        m.setattr(B, "_pass", None)
        m.setattr(B, "BLOCK_ROWS", 1000)
        here = B.fit_many(b, some)
    monkeypatch.setattr(B, "FEW_ROWS", 0)
    for a, c in zip(here, B.fit_many(b, some), strict=True):
        assert len(a.trees) == a.params.rounds
        for s, t in zip(a.trees, c.trees, strict=True):
            assert all(np.array_equal(getattr(s, k), getattr(t, k)) for k in ("feature", "bin", "left", "value", "gain"))
