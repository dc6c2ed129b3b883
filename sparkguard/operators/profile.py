"""Profiling and data-quality operators (one fused aggregate each)."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import ID, INF, LABEL, V_COLS, numeric_columns, safe_div
from .fingerprints import SUSPECT, suspects
from .quantiles import iqr_outliers, long_values, quantiles

# Fixed value: IQR multiplier for outlier bounds.
OUTLIER_FACTOR = 1.5


def _is_missing(df: DataFrame, c: str) -> Column:
    """NULL, or NaN for floating columns (pandas' notion of missing)."""
    dt = df.schema[c].dataType.simpleString()
    if dt in ("double", "float"):
        return F.col(c).isNull() | F.isnan(F.col(c))
    return F.col(c).isNull()


def _rows(items: list[Column]) -> Column:
    """Turn a list of same-typed structs into rows (one-row frame -> n rows)."""
    return F.inline(F.array(*items))


def null_percentage(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """``(column, ord, null_count, null_pct)`` for every column."""
    cols = cols or df.columns
    agg = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.count_if(_is_missing(df, c)).alias(f"_m{i}") for i, c in enumerate(cols)])
    return agg.select(_rows([
        F.struct(F.lit(c).alias("column"), F.lit(i).alias("ord"),
                 F.col(f"_m{i}").alias("null_count"),
                 (safe_div(F.col(f"_m{i}"), F.col("_n")) * 100).alias("null_pct"))
        for i, c in enumerate(cols)]))


def null_report(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """One row: total missing cells and the comma list of columns with any."""
    cols = cols or df.columns
    agg = df.agg(*[F.count_if(_is_missing(df, c)).alias(f"_m{i}") for i, c in enumerate(cols)])
    return agg.select(
        sum((F.col(f"_m{i}") for i in range(len(cols))), F.lit(0).cast("bigint")).alias("null_values"),
        F.concat_ws(",", *[F.when(F.col(f"_m{i}") > 0, F.lit(c)) for i, c in enumerate(cols)])
        .alias("null_columns"))


def duplicate_count(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """One row: rows equal (on ``cols``, default all but ``id``) to an earlier row.

    Only rows whose fingerprint may repeat (``fingerprints.suspects``) are compared on all columns; rows of one
    fingerprint that differ are groups of their own, so the count doesn't rest on the hash."""
    cols = cols or [c for c in df.columns if c != ID]
    groups = suspects(df.select(*cols), cols).where(SUSPECT).groupBy(*cols).agg(F.count(F.lit(1)).alias("_c"))
    return groups.agg(F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).cast("bigint").alias("duplicate_rows"))


def infinite_count(df: DataFrame) -> DataFrame:
    """One row: number of +/-inf cells over numeric columns."""
    cols = [c for c in numeric_columns(df) if df.schema[c].dataType.simpleString() in ("double", "float")]
    exprs = [F.count_if(F.abs(F.col(c)) == F.lit(INF)) for c in cols]
    total = sum(exprs, F.lit(0).cast("bigint")) if exprs else F.lit(0).cast("bigint")
    return df.agg(total.alias("infinite_values"))


def iqr_bounds(df: DataFrame, cols: list[str], factor: float = OUTLIER_FACTOR,
               method: str = "exact") -> DataFrame:
    """One row with ``{c}__q1, {c}__q3, {c}__lo, {c}__hi`` for each column."""
    q = quantiles(df, cols, [0.25, 0.75], method=method)
    sel = []
    for c in cols:
        q1, q3 = F.col(c)[0], F.col(c)[1]
        iqr = q3 - q1
        sel += [q1.alias(f"{c}__q1"), q3.alias(f"{c}__q3"),
                (q1 - F.lit(factor) * iqr).alias(f"{c}__lo"),
                (q3 + F.lit(factor) * iqr).alias(f"{c}__hi")]
    return q.select(*sel)


def _outside(c: str) -> Column:
    return (F.col(c) < F.col(f"{c}__lo")) | (F.col(c) > F.col(f"{c}__hi"))


def _bounds_and_counts(df: DataFrame, cols: list[str], factor: float, method: str) -> DataFrame:
    """One row: bounds and strict-outlier counts per column, plus the row count.

    Fit-like (eager): the exact method takes two scans (``quantiles.iqr_outliers``); the others fetch the bounds and
    count in long form ``(column, value)`` against them.  The few numbers come back as one literal row."""
    spark = df.sparkSession
    if method == "exact":
        n_rows, found = iqr_outliers(df, cols, factor)
        b = {f"{c}__{s}": v for i, c in enumerate(cols)
             for s, v in zip(("q1", "q3", "lo", "hi"), found.get(i, (None,) * 4))}
        out_cnt = {i: f[4] for i, f in found.items()}
    else:
        b = iqr_bounds(df, cols, factor, method).first()
        bl = spark.createDataFrame([(i, b[f"{c}__lo"], b[f"{c}__hi"]) for i, c in enumerate(cols)],
                                   "_c int, lo double, hi double")
        out_cnt = {r["_c"]: r["n"] for r in long_values(df, cols).join(F.broadcast(bl), ["_c"]).groupBy("_c")
                   .agg(F.count_if((F.col("_x") < F.col("lo")) | (F.col("_x") > F.col("hi"))).alias("n")).collect()}
        n_rows = df.count()
    names, values = ["_n"], [n_rows]
    for i, c in enumerate(cols):
        for sfx in ("q1", "q3", "lo", "hi"):
            names.append(f"{c}__{sfx}")
            values.append(b[f"{c}__{sfx}"])
        names.append(f"{c}__n")
        values.append(int(out_cnt.get(i, 0)))
    schema = ", ".join(f"`{n}` {'bigint' if n == '_n' or n.endswith('__n') else 'double'}" for n in names)
    return spark.createDataFrame([tuple(values)], schema)


def iqr_outlier_report(df: DataFrame, cols: list[str] | None = None,
                       factor: float = OUTLIER_FACTOR, method: str = "exact") -> DataFrame:
    """``(column, ord, q1, q3, lower_bound, upper_bound, outlier_count, outlier_pct)``.

    The exact method reads the rows twice, for quartiles and outlier counts together."""
    cols = cols or numeric_columns(df, exclude=(ID,))
    one = _bounds_and_counts(df, cols, factor, method)
    return one.select(_rows([
        F.struct(F.lit(c).alias("column"), F.lit(i).alias("ord"),
                 F.col(f"{c}__q1").alias("q1"), F.col(f"{c}__q3").alias("q3"),
                 F.col(f"{c}__lo").alias("lower_bound"), F.col(f"{c}__hi").alias("upper_bound"),
                 F.col(f"{c}__n").alias("outlier_count"),
                 (safe_div(F.col(f"{c}__n"), F.col("_n")) * 100).alias("outlier_pct"))
        for i, c in enumerate(cols)]))


def iqr_mask(df: DataFrame, col: str, factor: float = OUTLIER_FACTOR,
             method: str = "exact") -> DataFrame:
    """Rows of ``df`` plus ``is_outlier`` for one column and its bounds.

    As with pandas, a missing value in the column makes every bound missing,
    so no row is flagged."""
    b = iqr_bounds(df, [col], factor, method)
    miss = df.agg(F.count_if(_is_missing(df, col)).alias("_nm"))
    b = b.crossJoin(miss)
    out = df.crossJoin(F.broadcast(b))
    flag = F.when(F.col("_nm") > 0, F.lit(False)).otherwise(F.coalesce(_outside(col), F.lit(False)))
    return out.select(*df.columns, flag.alias("is_outlier"),
                      F.col(f"{col}__lo").alias("lower_bound"),
                      F.col(f"{col}__hi").alias("upper_bound"))


def top_outlier_columns(df: DataFrame, cols: list[str] | None = None, k: int = 5,
                        method: str = "exact") -> DataFrame:
    """The ``k`` columns (default V1..V28) with the largest outlier share."""
    cols = cols or [c for c in V_COLS if c in df.columns]
    rep = iqr_outlier_report(df, cols, method=method)
    return rep.orderBy(F.desc("outlier_pct"), F.asc("ord")).limit(k)


def class_distribution(df: DataFrame, label: str = LABEL) -> DataFrame:
    """``(Class, count, pct)``; the total comes from a window over the
    per-class rows (a handful), never over data rows."""
    g = df.groupBy(label).agg(F.count(F.lit(1)).alias("count"))
    total = F.sum("count").over(Window.partitionBy())
    return g.withColumn("pct", safe_div(F.col("count"), total) * 100)


def class_imbalance(df: DataFrame, label: str = LABEL) -> DataFrame:
    """One row: |pct(class 0) - pct(class 1)|, NULL when there is no label."""
    if label not in df.columns:
        return df.sparkSession.range(1).select(F.lit(None).cast("double").alias("class_imbalance"))
    agg = df.agg(F.count(F.lit(1)).alias("n"),
                 F.count_if(F.col(label) == 0).alias("c0"),
                 F.count_if(F.col(label) == 1).alias("c1"))
    return agg.select(F.abs(safe_div(F.col("c0"), F.col("n")) * 100
                            - safe_div(F.col("c1"), F.col("n")) * 100).alias("class_imbalance"))


def quality_summary(df: DataFrame, label: str = LABEL) -> DataFrame:
    """The data-quality report as one row (nulls, duplicates, infinities,
    class shares); the per-column outlier part is ``iqr_outlier_report``."""
    cols = df.columns
    dbl = [c for c in numeric_columns(df) if df.schema[c].dataType.simpleString() in ("double", "float")]
    has_label = label in cols
    exprs = [F.count(F.lit(1)).alias("rows")]
    exprs += [F.count_if(_is_missing(df, c)).alias(f"_m{i}") for i, c in enumerate(cols)]
    exprs += [F.count_if(F.abs(F.col(c)) == F.lit(INF)).alias(f"_f{i}") for i, c in enumerate(dbl)]
    if has_label:
        exprs += [F.count_if(F.col(label) == 0).alias("_c0"), F.count_if(F.col(label) == 1).alias("_c1")]
    one = df.agg(*exprs).crossJoin(duplicate_count(df))
    zero = F.lit(0).cast("bigint")
    sel = [F.col("rows"), F.lit(len(cols)).alias("columns"),
           sum((F.col(f"_m{i}") for i in range(len(cols))), zero).alias("null_values"),
           F.concat_ws(",", *[F.when(F.col(f"_m{i}") > 0, F.lit(c)) for i, c in enumerate(cols)])
           .alias("null_columns"),
           F.col("duplicate_rows"),
           sum((F.col(f"_f{i}") for i in range(len(dbl))), zero).alias("infinite_values")]
    if has_label:
        p0 = safe_div(F.col("_c0"), F.col("rows")) * 100
        p1 = safe_div(F.col("_c1"), F.col("rows")) * 100
        sel += [p0.alias("class_0_pct"), p1.alias("class_1_pct"), F.abs(p0 - p1).alias("class_imbalance")]
    else:
        sel += [F.lit(None).cast("double").alias(n) for n in ("class_0_pct", "class_1_pct", "class_imbalance")]
    return one.select(*sel)


def describe(df: DataFrame, cols: list[str] | None = None, method: str = "exact") -> DataFrame:
    """Transposed ``describe``: ``(column, ord, count, mean, std, min, q25, q50,
    q75, max)``; std is the sample (n-1) deviation; quartiles are exact.
    Moments come from a long-form ``groupBy(column)`` (one reduce task per
    column); the quartiles from the quantile fit, joined on the column index."""
    cols = cols or numeric_columns(df, exclude=(ID,))
    spark = df.sparkSession
    mom = long_values(df, cols).groupBy("_c").agg(
        F.count(F.lit(1)).alias("count"), F.avg("_x").alias("mean"), F.stddev_samp("_x").alias("std"),
        F.min("_x").alias("min"), F.max("_x").alias("max"))
    q = quantiles(df, cols, [0.25, 0.5, 0.75], method=method).select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("_c"), F.col(c).alias("_q")) for i, c in enumerate(cols)])))
    names = spark.createDataFrame([(i, c) for i, c in enumerate(cols)], "_c int, column string")
    out = names.join(mom, ["_c"], "left").join(q, ["_c"], "left")
    return out.select("column", F.col("_c").alias("ord"), F.coalesce("count", F.lit(0)).alias("count"),
                      "mean", "std", "min", F.col("_q")[0].alias("q25"), F.col("_q")[1].alias("q50"),
                      F.col("_q")[2].alias("q75"), "max")


def dataset_shape(df: DataFrame) -> DataFrame:
    """``(column, ord, data_type, non_null, rows)``: shape, dtypes and info."""
    cols = df.columns
    agg = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.count(F.col(c)).alias(f"_c{i}") for i, c in enumerate(cols)])
    return agg.select(_rows([
        F.struct(F.lit(c).alias("column"), F.lit(i).alias("ord"),
                 F.lit(df.schema[c].dataType.simpleString()).alias("data_type"),
                 F.col(f"_c{i}").alias("non_null"), F.col("_n").alias("rows"))
        for i, c in enumerate(cols)]))


def split_class_distribution(df: DataFrame, split_col: str = "split", label: str = LABEL) -> DataFrame:
    """``(split, Class, count, pct)`` with pct inside each split."""
    g = df.groupBy(split_col, label).agg(F.count(F.lit(1)).alias("count"))
    total = F.sum("count").over(Window.partitionBy(split_col))
    return g.withColumn("pct", safe_div(F.col("count"), total) * 100)


def split_class_pivot(df: DataFrame, split_col: str = "split", label: str = LABEL,
                      splits: tuple[str, ...] = ("train", "test")) -> DataFrame:
    """Counts table Class x split (zero-filled)."""
    return (df.groupBy(label).pivot(split_col, list(splits)).agg(F.count(F.lit(1)))
              .fillna(0, subset=list(splits)))


def count_by_category(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))


def fraud_vs_legit(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Sizes of the fraud and legitimate subsets (``filter(Class = k)``)."""
    return df.agg(F.count_if(F.col(label) == 1).alias("fraud_rows"),
                  F.count_if(F.col(label) == 0).alias("legit_rows"))
