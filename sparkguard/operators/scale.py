"""Feature scaling: fit one-row parameter frames on the training rows,
apply with one projection (broadcast one row)."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import nan_to_null
from .quantiles import quantiles


def fit_standard(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row ``{c}__center`` (mean), ``{c}__scale`` (population std; 0 -> 1)."""
    df = nan_to_null(df, cols)
    agg = df.agg(*[e for c in cols for e in (F.avg(c).alias(f"{c}__center"), F.stddev_pop(c).alias(f"_{c}_sd"))])
    return agg.select(*[e for c in cols for e in (
        F.col(f"{c}__center"),
        F.when((F.col(f"_{c}_sd") == 0) | F.col(f"_{c}_sd").isNull(), F.lit(1.0)).otherwise(F.col(f"_{c}_sd"))
        .alias(f"{c}__scale"))])


def fit_robust(df: DataFrame, cols: list[str], method: str = "exact") -> DataFrame:
    """One row ``{c}__center`` (median), ``{c}__scale`` (q75 - q25; 0 -> 1)."""
    q = quantiles(df, cols, [0.25, 0.5, 0.75], method=method)
    return q.select(*[e for c in cols for e in (
        F.col(c)[1].alias(f"{c}__center"),
        F.when((F.col(c)[2] - F.col(c)[0]) == 0, F.lit(1.0)).otherwise(F.col(c)[2] - F.col(c)[0])
        .alias(f"{c}__scale"))])


def fit_scaler(df: DataFrame, cols: list[str], kind: str = "standard") -> DataFrame:
    if kind == "standard":
        return fit_standard(df, cols)
    if kind == "robust":
        return fit_robust(df, cols)
    raise ValueError("scaler must be 'standard' or 'robust'")


def apply_scaler(df: DataFrame, params: DataFrame, cols: list[str]) -> DataFrame:
    j = df.crossJoin(F.broadcast(params))
    return j.select(*[((F.col(c).cast("double") - F.col(f"{c}__center")) / F.col(f"{c}__scale")).alias(c)
                      if c in cols else F.col(c) for c in df.columns])


def scaler_params(params: DataFrame, cols: list[str]) -> DataFrame:
    """Unpivoted fit: ``(column, ord, center, scale)``."""
    return params.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(i).alias("ord"), F.col(f"{c}__center").alias("center"),
                 F.col(f"{c}__scale").alias("scale")) for i, c in enumerate(cols)])))


def save_params(params: DataFrame, path: str) -> str:
    """Write a fitted parameter frame (one row) as Parquet."""
    params.write.mode("overwrite").parquet(path)
    return path


def load_params(spark: SparkSession, path: str) -> DataFrame:
    """A stored fit, for ``apply_scaler`` in a later batch or stream."""
    return spark.read.parquet(path)


def scale_split(df: DataFrame, cols: list[str], kind: str = "standard", split_col: str = "split",
                fit_split: str = "train") -> tuple[DataFrame, DataFrame]:
    """Fit on the ``fit_split`` rows, apply to every row.  Returns (scaled, params)."""
    params = fit_scaler(df.where(F.col(split_col) == fit_split), cols, kind)
    return apply_scaler(df, params, cols), params
