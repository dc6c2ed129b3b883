"""The preprocessing flow as one lazy DataFrame composition.

impute -> de-duplicate -> engineer features -> cap outliers -> stratified
split -> one-hot (train) -> SMOTE (train) -> align columns -> scale (fit on
train) -> one table with a ``split`` column.  The split result and the final
table are checkpointed (lineage cut, shared folder) so a lost executor only
recomputes from there.
"""
from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import ID, LABEL
from ..operators import clean as C
from ..operators import features as FE
from ..operators import resample as RS
from ..operators import sampling as SM
from ..operators import scale as SC
from ..operators.models import TASK_ROWS
from ..session import cut_in_files, cut_lineage, drop_table, ensure_checkpoint_dir, shared_dir


def model_features(df: DataFrame, exclude=(ID, LABEL, "split", "synthetic")) -> list[str]:
    """Numeric and boolean columns used as model inputs, in source order."""
    return [f.name for f in df.schema.fields if f.name not in exclude
            and f.dataType.simpleString() in ("double", "float", "int", "bigint", "boolean", "smallint")]


def clean_and_engineer(df: DataFrame, dedup: bool = True) -> DataFrame:
    out = C.handle_missing(df)
    if dedup:
        out = C.drop_duplicates(out)
    return FE.transform_features(out)


def preprocess(df: DataFrame, test_size: float = 0.2, seed: int = 42, scaler: str = "standard",
               dedup: bool = True, fit_on: str = "all", resample: bool = True, scale_first: bool = False,
               max_levels: int = 1000) -> tuple[DataFrame, list[str], DataFrame]:
    """Returns (processed table with ``split``, feature names, scaler params).  ``max_levels`` bounds the levels of a categorical
    column (one output column each); a column with more raises."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    eng = cut_lineage(clean_and_engineer(df, dedup), "engineered")  # several fits read it
    if fit_on == "all":
        capped = C.cap_outliers(eng)
        split = SM.stratified_split(capped, test_size, seed)
    else:
        split0 = SM.stratified_split(eng, test_size, seed)
        num = [c for c in C._numeric(eng, exclude=(ID, LABEL))]
        params = C.fit_caps(split0.where(F.col("split") == "train"), num)
        split = C.cap_outliers(split0, num, params=params)
    split = cut_lineage(split, "split")
    drop_table(eng)                                    # the split table holds all that is read of it
    train = FE.one_hot_categoricals(split.where(F.col("split") == "train"), max_levels=max_levels)
    test = split.where(F.col("split") == "test")
    feats = model_features(train)
    train = train.withColumns({c: F.col(c).cast("double") for c in feats})
    if scale_first:
        params = SC.fit_scaler(train, feats, scaler)
        train = SC.apply_scaler(train, params, feats)
    if resample:
        train = resampled = cut_lineage(RS.smote(train, feats, seed=seed).withColumn("split", F.lit("train")), "resampled")  # fitted, then scaled
    else:
        train = train.withColumn("synthetic", F.lit(False))
    test = test.withColumn("synthetic", F.lit(False))
    train, test = _align(train, test)
    feats = model_features(train)
    test = test.withColumns({c: F.col(c).cast("double") for c in feats})
    if scale_first:
        test = SC.apply_scaler(test, params, feats)   # the parameters fitted on train
    else:
        params = SC.fit_scaler(train, feats, scaler)
        train = SC.apply_scaler(train, params, feats)
        test = SC.apply_scaler(test, params, feats)
    params = cut_lineage(params, "scaler")             # one row
    out = cut_in_files(train.unionByName(test), "processed", TASK_ROWS)
    if resample:
        drop_table(resampled)
    drop_table(split)
    return out, feats, params


def _align(train: DataFrame, test: DataFrame) -> tuple[DataFrame, DataFrame]:
    return FE.align_columns(train, test)


def save_processed(df: DataFrame, path: str) -> str:
    """One Parquet table partitioned by ``split`` (train/test pruned on read)."""
    df.write.mode("overwrite").partitionBy("split").parquet(path)
    return path


def load_processed(spark, path: str, split: str | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.where(F.col("split") == split) if split else df


def processed_metadata(df: DataFrame, features: list[str]) -> DataFrame:
    """``(split, rows, features)``."""
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("rows")).withColumn("features", F.lit(len(features)))


def processed_path(spark, name: str = "processed") -> str:
    return os.path.join(shared_dir(spark, name))
