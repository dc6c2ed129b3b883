"""Statistics behind the exploratory views: cross-tabs, correlation,
histograms, densities, box-plot summaries."""
from __future__ import annotations

from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import LABEL, safe_div
from .ranked import null_safe_join


def hour_crosstab(df: DataFrame, hour: str = "Hour", label: str = LABEL) -> DataFrame:
    """Half-even rounded hour x class counts, zero-filled:
    ``(hour, class_0, class_1)``."""
    return (df.groupBy(F.rint(F.col(hour)).alias("hour"))
              .agg(F.count_if(F.col(label) == 0).alias("class_0"),
                   F.count_if(F.col(label) == 1).alias("class_1")))


def fraud_ratio_by_hour(df: DataFrame, hour: str = "Hour", label: str = LABEL) -> DataFrame:
    """``(hour, class_0, class_1, fraud_ratio)`` with ratio = c1 / (c0 + c1)."""
    ct = hour_crosstab(df, hour, label)
    return ct.withColumn("fraud_ratio", safe_div(F.col("class_1"), F.col("class_0") + F.col("class_1")))


# ---------------------------------------------------------------- correlation

# State of a pair of columns over the rows where both are present: count, means, centred sums of squares and products.
MOMENTS = ("ma", "mb", "caa", "cbb", "cab")
MOMENT_SCHEMA = "part int, a int, b int, n long, ok boolean, " + ", ".join(f"{c} double" for c in MOMENTS)
MERGE_PARTS = 1024   # partitions whose states are merged at a time


def _merge_moments(x: tuple, y: tuple) -> tuple:
    """The state ``(n, ma, mb, caa, cbb, cab)`` (d x d arrays) of two sets of rows together."""
    n = x[0] + y[0]
    share = np.divide(y[0], n, out=np.zeros_like(n), where=n > 0)
    da, db, w = y[1] - x[1], y[2] - x[2], x[0] * share
    return (n, x[1] + da * share, x[2] + db * share, x[3] + y[3] + da * da * w, x[4] + y[4] + db * db * w,
            x[5] + y[5] + da * db * w)


def _batch_moments(x: np.ndarray) -> tuple:
    """State of the rows of ``x``; they are shifted by column means (a constant column by its value) before any product is
    taken."""
    there, finite = ~np.isnan(x), np.isfinite(x)
    m = there.astype("float64")
    shift = np.where(finite, x, 0.0).sum(axis=0) / np.maximum(finite.sum(axis=0), 1)
    low, high = np.where(finite, x, np.inf).min(axis=0), np.where(finite, x, -np.inf).max(axis=0)
    shift = np.where(low == high, low, shift)
    x0 = np.where(there, x - shift, 0.0)
    n = m.T @ m
    sa = x0.T @ m                                 # sums of column a where column b is present
    safe = np.maximum(n, 1.0)
    qa = (x0 * x0).T @ m - sa * sa / safe
    return (n, np.where(n > 0, sa / safe + shift[:, None], 0.0), np.where(n > 0, sa.T / safe + shift[None, :], 0.0),
            qa, qa.T, x0.T @ x0 - sa * sa.T / safe)


def _partition_moments(d: int):
    def fn(batches):
        from pyspark import TaskContext
        state = None
        with np.errstate(invalid="ignore", over="ignore"):   # infinities make a pair NaN, in the end NULL
            for pdf in batches:
                if len(pdf):
                    one = _batch_moments(pdf.to_numpy(dtype="float64", na_value=np.nan))
                    state = one if state is None else _merge_moments(state, one)
        if state is None:
            return
        a, b = np.meshgrid(np.arange(d, dtype="int32"), np.arange(d, dtype="int32"), indexing="ij")
        yield pd.DataFrame({"part": np.int32(TaskContext.get().partitionId()), "a": a.ravel(), "b": b.ravel(),
                            "n": state[0].ravel().astype("int64"), "ok": np.isfinite(sum(state[1:])).ravel(),
                            **{c: np.nan_to_num(v.ravel()) for c, v in zip(MOMENTS, state[1:])}})
    return fn


def _merged(states: DataFrame, keys: list[str]) -> DataFrame:
    """Moment states merged inside ``keys``: means first, then each state's distance from them."""
    w = Window.partitionBy(*keys)
    total, some = F.sum("n").over(w).cast("double"), F.col("n") > 0

    def mean(c):    # from the least of the means, so that equal means stay what they are
        return F.coalesce(F.col(f"_{c}") + F.try_divide(F.sum(F.col("n") * (F.col(c) - F.col(f"_{c}"))).over(w), total), F.lit(0.0))
    at = states.withColumns({f"_{c}": F.min(F.when(some, F.col(c))).over(w) for c in ("ma", "mb")}) \
        .withColumns({f"_{c}": mean(c) for c in ("ma", "mb")})
    da, db = F.col("ma") - F.col("_ma"), F.col("mb") - F.col("_mb")
    return at.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.bool_and("ok").alias("ok"), F.first("_ma").alias("ma"), F.first("_mb").alias("mb"),
        F.sum(F.col("caa") + F.col("n") * da * da).alias("caa"), F.sum(F.col("cbb") + F.col("n") * db * db).alias("cbb"),
        F.sum(F.col("cab") + F.col("n") * da * db).alias("cab"))


def correlation_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson correlation, pairwise complete: ``(feature_a, ord_a, feature_b,
    ord_b, corr)`` for all ordered pairs.

    One scan: each partition folds its batches into one mergeable co-moment
    state per pair (d x d rows, numpy), and states are merged in two levels of
    at most ``MERGE_PARTS`` partitions a group.  Products are taken of centred
    values only, so large means cost no digits.  NULL/NaN cells drop out pair by
    pair; a constant column, or one with an infinite cell, gives NULL."""
    x = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(f"x{i}")
                    for i, c in enumerate(cols)])
    states = x.mapInPandas(_partition_moments(len(cols)), MOMENT_SCHEMA)
    states = states.withColumn("part", F.expr(f"part div {MERGE_PARTS}"))
    g = _merged(_merged(states, ["a", "b", "part"]), ["a", "b"])
    r = F.try_divide(F.col("cab"), F.sqrt("caa") * F.sqrt("cbb"))
    defined = F.col("ok") & (F.col("n") > 0) & (F.col("caa") > 0) & (F.col("cbb") > 0)
    names = F.array(*[F.lit(c) for c in cols])
    return g.select(F.element_at(names, F.col("a") + 1).alias("feature_a"), F.col("a").alias("ord_a"),
                    F.element_at(names, F.col("b") + 1).alias("feature_b"), F.col("b").alias("ord_b"),
                    F.when(defined, F.least(F.lit(1.0), F.greatest(F.lit(-1.0), r))).alias("corr"))


def corr_lower_triangle(matrix: DataFrame) -> DataFrame:
    """Pairs strictly below the diagonal (the half drawn in the heat map)."""
    return matrix.where(F.col("ord_a") > F.col("ord_b"))


def _present(c: str) -> Column:
    """The column as double, NaN as NULL."""
    return F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))


def _pair_corr(x: str, y: str) -> Column:
    """Pairwise-complete Pearson correlation; NULL when a variance is 0."""
    xv, yv = _present(x), _present(y)
    a, b = F.when(yv.isNotNull(), xv), F.when(xv.isNotNull(), yv)
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


def corr_with_class(df: DataFrame, cols: list[str], label: str = LABEL) -> DataFrame:
    """``(feature, ord, corr)``: correlation of each column with the label
    (label itself excluded); n aggregates, no full matrix."""
    feats = [c for c in cols if c != label]
    one = df.agg(*[_pair_corr(c, label).alias(f"_r{i}") for i, c in enumerate(feats)])
    return one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.lit(i).alias("ord"),
                                                  F.col(f"_r{i}").alias("corr")) for i, c in enumerate(feats)])))


def corr_top_bottom(cwc: DataFrame, k: int = 10) -> DataFrame:
    """Head and tail (k each) of the correlations sorted descending."""
    top = cwc.orderBy(F.desc_nulls_last("corr"), "ord").limit(k).withColumn("part", F.lit("top"))
    bottom = cwc.orderBy(F.asc_nulls_first("corr"), F.desc("ord")).limit(k).withColumn("part", F.lit("bottom"))
    return top.unionByName(bottom)


def top_abs_corr(cwc: DataFrame, k: int) -> DataFrame:
    """The ``k`` features with the largest |corr| (ties in column order)."""
    return cwc.orderBy(F.desc_nulls_last(F.abs(F.col("corr"))), "ord").limit(k)


def corr_by_class(df: DataFrame, features: list[str], label: str = LABEL) -> DataFrame:
    """Correlation matrix of ``features`` inside each class:
    ``(Class, feature_a, feature_b, corr)`` (grouped aggregate)."""
    pairs = [(a, b) for a in features for b in features]
    g = df.groupBy(label).agg(*[_pair_corr(a, b).alias(f"_r{i}") for i, (a, b) in enumerate(pairs)])
    return g.select(label, F.inline(F.array(*[
        F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), F.col(f"_r{i}").alias("corr"))
        for i, (a, b) in enumerate(pairs)])))


# ------------------------------------------------------------ distributions
def _long(df: DataFrame, cols: list[str], keep: list[str] = (), only: DataFrame | None = None) -> DataFrame:
    """(keep..., column, x) rows: one per cell, non-missing only.  ``only``
    (a small frame with a ``column`` column) keeps just those columns, by a
    broadcast semi-join, so column choices computed by Spark stay lazy."""
    out = df.select(*keep, F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias("x"))
        for c in cols]))).where(F.col("x").isNotNull())
    if only is not None:
        out = out.join(F.broadcast(only.select("column").distinct()), ["column"], "left_semi")
    return out


def long_features(df: DataFrame, cols: list[str], keep: list[str] = (), only: DataFrame | None = None) -> DataFrame:
    """Long form ``(keep..., column, x)`` of selected feature columns."""
    return _long(df, cols, list(keep), only).select(*keep, F.col("column").alias("feature"), F.col("x").alias("value"))


def histogram(df: DataFrame, bins: dict[str, int], by: list[str] | None = None) -> DataFrame:
    """Equal-width histograms (numpy rules: edges linspace(min, max, n+1),
    bins closed left, last bin closed): ``(by..., column, bin, lo, hi, count)``
    with empty bins filled with 0.  Edges span all rows (common to groups)."""
    by = list(by or [])
    cols = list(bins)
    spark = df.sparkSession
    nb = spark.createDataFrame([(c, int(n)) for c, n in bins.items()], "column string, nb int")
    long = _long(df, cols, by)
    rng = long.groupBy("column").agg(F.min("x").alias("_mn"), F.max("x").alias("_mx"))
    params = rng.join(nb, ["column"]).select(
        "column", "nb",
        F.when(F.col("_mn") == F.col("_mx"), F.col("_mn") - 0.5).otherwise(F.col("_mn")).alias("lo"),
        F.when(F.col("_mn") == F.col("_mx"), F.col("_mx") + 0.5).otherwise(F.col("_mx")).alias("hi"))
    params = params.withColumn("step", (F.col("hi") - F.col("lo")) / F.col("nb"))

    def edge(i: Column) -> Column:
        return F.when(i >= F.col("nb"), F.col("hi")).otherwise(i * F.col("step") + F.col("lo"))

    j = long.join(F.broadcast(params), ["column"])
    guess = F.least(F.col("nb") - 1, F.floor((F.col("x") - F.col("lo")) / (F.col("hi") - F.col("lo")) * F.col("nb")))
    j = j.withColumn("_g", guess.cast("int"))
    j = j.withColumn("_g", F.when(F.col("x") < edge(F.col("_g")), F.col("_g") - 1).otherwise(F.col("_g")))
    j = j.withColumn("bin", F.when((F.col("x") >= edge(F.col("_g") + 1)) & (F.col("_g") != F.col("nb") - 1),
                                   F.col("_g") + 1).otherwise(F.col("_g")))
    counts = j.groupBy(*by, "column", "bin").agg(F.count(F.lit(1)).alias("count"))
    frame = params.withColumn("bin", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    if by:  # the groups, from the counts (bins x groups rows)
        frame = frame.crossJoin(F.broadcast(counts.select(*by).distinct()))
    frame = frame.select(*by, "column", "bin", edge(F.col("bin")).alias("lo_edge"),
                         edge(F.col("bin") + 1).alias("hi_edge"))
    return null_safe_join(frame, counts, [*by, "column", "bin"], "left").fillna(0, subset=["count"])


# Fixed values of the density view: Scott's rule, cut 3, 200 grid points.
KDE_GRID = 200
KDE_CUT = 3.0
KDE_ORDER = 8       # moments kept per cell of a quarter bandwidth
KDE_REACH = 8.0     # bandwidths beyond which exp(-z^2 / 2) < 1.3e-14 is left out


def _hermite(z: Column, order: int) -> list[Column]:
    """Probabilists' Hermite polynomials He_0..He_order of ``z`` (three-term recurrence)."""
    h = [F.lit(1.0), z]
    for k in range(1, order):
        h.append(z * h[k] - F.lit(float(k)) * h[k - 1])
    return h


def kde(df: DataFrame, cols: list[str], by: list[str] | None = None, gridsize: int = KDE_GRID,
        cut: float = KDE_CUT, only: DataFrame | None = None) -> DataFrame:
    """Gaussian density ``(by..., column, grid_idx, x, density)``.

    Bandwidth = sample std x n^(-1/5) (Scott), grid = linspace(min - cut*bw,
    max + cut*bw, gridsize).  Rows are summed up in cells a quarter of the
    bandwidth wide, as moments of their offset from the cell's centre; the
    kernel's Taylor series in these moments gives each grid point the sum over
    the rows to about 1e-11 of the kernel's peak, whatever their number.  A cell serves only the grid
    points within ``KDE_REACH`` bandwidths.  Infinite values are left out."""
    by = list(by or [])
    long = _long(df, cols, by, only).where(F.abs("x") < np.inf)
    keys = [*by, "column"]
    st = long.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.stddev_samp("x").alias("sd"),
                                 F.min("x").alias("mn"), F.max("x").alias("mx"))
    st = st.withColumn("bw", F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2))).where(F.col("bw") > 0)
    st = st.withColumns({"g_lo": F.col("mn") - cut * F.col("bw"), "g_hi": F.col("mx") + cut * F.col("bw")}) \
           .withColumn("step", (F.col("g_hi") - F.col("g_lo")) / (gridsize - 1))
    offset = (F.col("x") - F.col("mn")) / F.col("bw")          # in bandwidths
    cell = F.floor(offset * 4)
    j = null_safe_join(long, st.select(*keys, "mn", "bw"), keys).select(
        *keys, cell.alias("cell"), (offset - (cell + 0.5) / 4).alias("t"))
    powers = [F.lit(1.0)]
    for _ in range(KDE_ORDER):
        powers.append(powers[-1] * F.col("t"))
    cells = j.groupBy(*keys, "cell").agg(*[F.sum(p).alias(f"m{k}") for k, p in enumerate(powers)])
    cells = null_safe_join(cells, st, keys)
    centre = F.col("mn") + (F.col("cell") + 0.5) / 4 * F.col("bw")
    first = F.greatest(F.lit(0), F.floor((centre - KDE_REACH * F.col("bw") - F.col("g_lo")) / F.col("step")))
    last = F.least(F.lit(gridsize - 1), F.ceil((centre + KDE_REACH * F.col("bw") - F.col("g_lo")) / F.col("step")))
    near = cells.withColumn("grid_idx", F.explode(F.sequence(first.cast("int"), last.cast("int"))))

    def grid_x(i: Column) -> Column:
        return F.when(i == gridsize - 1, F.col("g_hi")).otherwise(i * F.col("step") + F.col("g_lo"))

    near = near.withColumn("z", (grid_x(F.col("grid_idx")) - centre) / F.col("bw"))
    he = _hermite(F.col("z"), KDE_ORDER)
    series = F.lit(0.0)
    for k in range(KDE_ORDER + 1):
        series = series + F.col(f"m{k}") * he[k] * F.lit(1.0 / factorial(k))
    dens = near.groupBy(*keys, "grid_idx").agg(F.sum(F.exp(-0.5 * F.col("z") * F.col("z")) * series).alias("s"))
    grid = st.withColumn("grid_idx", F.explode(F.sequence(F.lit(0), F.lit(gridsize - 1))))
    out = null_safe_join(grid, dens, [*keys, "grid_idx"], "left")
    norm = F.col("n") * F.col("bw") * F.lit(float(np.sqrt(2 * np.pi)))
    return out.select(*keys, "grid_idx", grid_x(F.col("grid_idx")).alias("x"),
                      (F.greatest(F.lit(0.0), F.coalesce("s", F.lit(0.0))) / norm).alias("density"))


def boxplot_stats(df: DataFrame, cols: list[str], by: list[str] | None = None, method: str = "exact",
                  only: DataFrame | None = None) -> DataFrame:
    """``(by..., column, q1, median, q3, whisker_lo, whisker_hi, fliers)``:
    whiskers are the extreme data within 1.5 IQR of the quartiles.  Quartiles
    per (group, column) come from the bounded exact selection."""
    from .quantiles import grouped_quantiles
    by = list(by or [])
    long = _long(df, cols, by, only)
    keys = [*by, "column"]
    if only is not None:
        # restrict to the chosen columns before the quartile fit (the choice is a tiny frame)
        chosen = [r["column"] for r in only.select("column").distinct().collect()]
        cols = [c for c in cols if c in chosen]
    q = grouped_quantiles(df, by, cols, [0.25, 0.5, 0.75], method)
    q = q.select(*keys, F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("median"), F.col("_q")[2].alias("q3"))
    q = q.withColumn("_lo", F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))) \
         .withColumn("_hi", F.col("q3") + 1.5 * (F.col("q3") - F.col("q1")))
    agg = null_safe_join(long, q, keys).groupBy(*keys).agg(
        F.min(F.when(F.col("x") >= F.col("_lo"), F.col("x"))).alias("_wl"),
        F.max(F.when(F.col("x") <= F.col("_hi"), F.col("x"))).alias("_wh"),
        F.count_if((F.col("x") < F.col("_lo")) | (F.col("x") > F.col("_hi"))).alias("fliers"),
        F.first("q1").alias("q1"), F.first("median").alias("median"), F.first("q3").alias("q3"))
    return agg.select(*keys, "q1", "median", "q3", F.coalesce("_wl", "q1").alias("whisker_lo"),
                      F.coalesce("_wh", "q3").alias("whisker_hi"), "fliers")


def grouped_describe(df: DataFrame, col: str, by: list[str], method: str = "exact") -> DataFrame:
    """count, mean, std (n-1), min, quartiles, max of ``col`` per group."""
    from .quantiles import grouped_quantiles
    x = _present(col)
    g = df.groupBy(*by).agg(F.count(x).alias("count"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"),
                            F.min(x).alias("min"), F.max(x).alias("max"))
    q = grouped_quantiles(df, by, [col], [0.25, 0.5, 0.75], method).drop("column")
    return null_safe_join(g, q, by, "left").select(
        *by, "count", "mean", "std", "min", F.col("_q")[0].alias("q25"), F.col("_q")[1].alias("q50"),
        F.col("_q")[2].alias("q75"), "max")


def covariance_matrix_np(df: DataFrame, cols: list[str]) -> np.ndarray:
    """Population covariance (pairwise complete) of ``cols`` as a d x d numpy
    array, from the same per-partition Gram sums as ``correlation_matrix``
    (the d x d result is fetched; it does not grow with the rows)."""
    d = len(cols)
    mu = df.agg(*[F.avg(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))).alias(f"_mu{i}")
                  for i, c in enumerate(cols)])
    centred = df.select(*cols).crossJoin(F.broadcast(mu)).select(
        *[(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) - F.col(f"_mu{i}")).alias(f"x{i}")
          for i, c in enumerate(cols)])
    g = centred.mapInPandas(_gram_partition(d), GRAM_SCHEMA).groupBy("a", "b").agg(
        *[F.sum(c).alias(c) for c in ("n", "sa", "sb", "p")])
    cov = np.zeros((d, d))
    for r in g.collect():  # d x d rows
        n = float(r["n"]) or 1.0
        cov[r["a"], r["b"]] = r["p"] / n - (r["sa"] / n) * (r["sb"] / n)
    return cov
