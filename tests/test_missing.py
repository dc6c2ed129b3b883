"""NaN, NULL keys and heavy tails in the statistics operators."""
import numpy as np

from sparkguard.operators import scale as SC
from sparkguard.operators import stats as S


def _df(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(400):
        x = float("nan") if i % 11 == 0 else (None if i % 13 == 0 else float(rng.lognormal(0, 2)))
        rows.append((i, x, float(rng.normal()), None if i % 7 == 0 else int(i % 2)))
    return spark.createDataFrame(rows, "id long, x double, y double, Class int")


def test_nan_counts_as_missing(spark):
    df = _df(spark)
    pdf = df.toPandas()
    r = {c["feature"]: c["corr"] for c in S.corr_with_class(df, ["x", "y"]).collect()}
    assert np.isclose(r["x"], pdf["x"].corr(pdf["Class"]))
    p = SC.fit_standard(df, ["x"]).first()
    assert np.isclose(p["x__center"], pdf["x"].mean()) and np.isclose(p["x__scale"], pdf["x"].std(ddof=0))
    for g in S.grouped_describe(df, "x", ["Class"]).collect():
        part = pdf[pdf.Class.isna() if g["Class"] is None else pdf.Class == g["Class"]]["x"]
        assert g["count"] == part.count() and np.isclose(g["mean"], part.mean())
        assert np.isclose(g["q50"], part.median()) and np.isclose(g["max"], part.max())


def test_null_groups_are_groups(spark):
    df = _df(spark)
    n = {r["Class"]: r["n"] for r in S._long(df, ["y"], ["Class"]).groupBy("Class").count()
         .withColumnRenamed("count", "n").collect()}
    h = S.histogram(df, {"y": 10}, by=["Class"]).groupBy("Class").sum("count").collect()
    assert {r["Class"]: r["sum(count)"] for r in h} == n and None in n
    assert {r["Class"] for r in S.boxplot_stats(df, ["y"], by=["Class"]).collect()} == set(n)
    assert {r["Class"] for r in S.kde(df, ["y"], by=["Class"]).collect()} == set(n)


def test_density_equals_the_sum_over_rows(spark):
    """A heavy tail: cells follow the bandwidth, not the range."""
    rng = np.random.default_rng(2)
    x = rng.lognormal(0, 2.5, 3000)
    got = S.kde(spark.createDataFrame([(float(v),) for v in x], "x double"), ["x"]).orderBy("grid_idx").collect()
    bw = x.std(ddof=1) * len(x) ** -0.2
    grid = np.linspace(x.min() - 3 * bw, x.max() + 3 * bw, 200)
    exp = np.exp(-0.5 * ((grid[:, None] - x) / bw) ** 2).sum(1) / (len(x) * bw * np.sqrt(2 * np.pi))
    assert np.allclose([r["x"] for r in got], grid, rtol=1e-12)
    assert np.abs(np.array([r["density"] for r in got]) - exp).max() < 1e-10 * exp.max()
