"""The custom distributed algorithms against brute force on small inputs:
exact quantile selection and the certified kNN of SMOTE."""
import numpy as np
import pytest

from sparkguard.operators import quantiles as Q
from sparkguard.operators import resample as RS


def _frame(spark, n=3000, seed=7):
    rng = np.random.default_rng(seed)
    hot = np.full(n // 3, 42.0)                               # one value on a third of the rows
    skew = np.concatenate([rng.lognormal(0, 3, n - n // 3), hot])  # values spread over many decades
    rng.shuffle(skew)
    ties = rng.integers(0, 5, n).astype(float)                # few distinct values
    rows = []
    for i in range(n):
        a = float(skew[i])
        b = float("nan") if i % 17 == 0 else (None if i % 13 == 0 else float(rng.normal()))
        rows.append((i, a, b, float(ties[i]), int(i % 2)))
    return spark.createDataFrame(rows, "id long, a double, b double, t double, g int")


def _np_q(x, p):
    x = np.array([v for v in x if v is not None and not np.isnan(v)], dtype=float)
    return np.percentile(x, [100 * q for q in p], method="linear")


PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]


@pytest.mark.parametrize("grid,finish", [(Q.GRID, Q.FINISH_ROWS), (16, 3)])
def test_exact_quantiles_match_numpy(spark, monkeypatch, grid, finish):
    monkeypatch.setattr(Q, "FINISH_ROWS", finish)  # 3 forces many brackets
    df = _frame(spark)
    pdf = df.toPandas()
    vals = Q.exact_quantile_values(df, ["a", "b", "t"], PROBS, grid=grid)
    for ci, c in enumerate(["a", "b", "t"]):
        exp = _np_q(list(pdf[c]), PROBS)
        got = [vals[(ci, j)] for j in range(len(PROBS))]
        assert np.allclose(got, exp, rtol=1e-12, atol=1e-12), (c, got, exp)


@pytest.mark.parametrize("finish", [Q.FINISH_ROWS, 50])
def test_exact_quantiles_with_infinities_and_huge_ranges(spark, monkeypatch, finish):
    monkeypatch.setattr(Q, "FINISH_ROWS", finish)
    rng = np.random.default_rng(5)
    x = rng.normal(size=1000) * 10.0 ** rng.integers(-300, 300, 1000)
    x[:50], x[50:120] = -np.inf, np.inf
    df = spark.createDataFrame([(float(v), 1.7e308 * (-1) ** i) for i, v in enumerate(x)], "x double, y double")
    probs = [0.0, 0.02, 0.25, 0.5, 0.75, 0.99, 1.0]
    vals = Q.exact_quantile_values(df, ["x", "y"], probs, grid=16)
    s = np.sort(x)
    for j, p in enumerate(probs):
        pos = (len(s) - 1) * p
        a, b = s[int(np.floor(pos))], s[int(np.ceil(pos))]
        exp = a if a == b else (np.ceil(pos) - pos) * a + (pos - np.floor(pos)) * b
        assert vals[(0, j)] == exp or np.isclose(vals[(0, j)], exp, rtol=1e-12), (p, vals[(0, j)], exp)
    assert vals[(1, 0)] == -1.7e308 and vals[(1, 6)] == 1.7e308


def test_grouped_quantiles_match_numpy(spark):
    df = _frame(spark)
    pdf = df.toPandas()
    out = {(r["g"], r["column"]): r["_q"] for r in Q.grouped_quantiles(df, ["g"], ["a", "b"], PROBS).collect()}
    for g in (0, 1):
        for c in ("a", "b"):
            exp = _np_q(list(pdf[pdf.g == g][c]), PROBS)
            assert np.allclose(out[(g, c)], exp, rtol=1e-12, atol=1e-12)


def test_exact_knn_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    pts = rng.normal(size=(300, 5)) * np.array([100.0, 1.0, 1.0, 10.0, 0.1])
    pts[10] = pts[11]  # a duplicate point (distance 0, tie broken by id)
    rows = [(i, [float(v) for v in p]) for i, p in enumerate(pts)]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    got = {(r["id"], r["k_idx"]): (r["nb_id"], r["dist2"]) for r in RS.knn_minority(df, k=5).collect()}
    d2 = ((pts[:, None, :] - pts[None, :, :]) ** 2).sum(-1)
    for i in range(len(pts)):
        order = sorted((d2[i, j], j) for j in range(len(pts)) if j != i)[:5]
        for k, (dist, j) in enumerate(order, start=1):
            nb, gd = got[(i, k)]
            assert nb == j and abs(gd - dist) <= 1e-9 * max(1.0, dist), (i, k, nb, j)


def test_knn_over_many_blocks_matches_all_pairs(spark):
    """No direction separates these rows, so every pair of blocks is compared; equal rows tie by id."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(150, 12))
    x[140:] = x[7]                                    # eleven equal rows
    df = spark.createDataFrame([(i * 3, [float(v) for v in r]) for i, r in enumerate(x)], "id long, v array<double>")
    got = {(r["id"], r["k_idx"]): (r["nb_id"], r["dist2"]) for r in RS.knn_minority(df, k=5, block=16).collect()}
    assert len(got) == 150 * 5
    for i in range(150):
        d = np.zeros(150)
        for f in range(12):
            d += np.square(x[i, f] - x[:, f])
        order = [j for j in np.lexsort((np.arange(150), d)) if j != i][:5]
        assert [got[i * 3, n + 1] for n in range(5)] == [(j * 3, d[j]) for j in order]


def test_smote_parents_are_neighbours(spark):
    rng = np.random.default_rng(4)
    rows = [(i, *[float(v) for v in rng.normal(size=3)], int(i < 12)) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, Class int")
    out = RS.smote(df, ["a", "b", "c"], parents=True).collect()
    at = {r[0]: np.array(r[1:4]) for r in rows}
    made = [r for r in out if r.synthetic]
    assert len(made) == 36 and all(r.base_id is None for r in out if not r.synthetic)
    for r in made:
        a, b, p = at[r.base_id], at[r.nb_id], np.array([r.a, r.b, r.c])
        assert (np.minimum(a, b) - 1e-12 <= p).all() and (p <= np.maximum(a, b) + 1e-12).all()
        near = sorted((np.square(a - at[j]).sum(), j) for j in range(12) if j != r.base_id)[:5]
        assert r.nb_id in [j for _, j in near]
