"""Scans: parquet test tables and the raw transactions CSV."""
from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import FEATURE_COLS, ID, LABEL
from ..operators.fingerprints import fingerprint
from ..operators.ranked import prefix_sums

COPY_BLOCK = 10_000   # copies of one row made by one task at a time

# Explicit schema of the raw transactions file (no inference pass).
TRANSACTIONS_SCHEMA = T.StructType(
    [T.StructField(c, T.DoubleType(), True) for c in FEATURE_COLS]
    + [T.StructField(LABEL, T.IntegerType(), True)]
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def load_transactions_csv(spark: SparkSession, path: str, key: str | None = None) -> DataFrame:
    """Raw CSV with header (Time, V1..V28, Amount, Class) read with an explicit
    schema.  ``key`` names a first column that holds a unique long; it becomes
    ``id``, and seeded splits and samples then don't depend on the cluster.
    Without one ``id`` comes from the rows' content (``content_ids``)."""
    first = [] if key is None else [T.StructField(key, T.LongType(), False)]
    schema = T.StructType(first + TRANSACTIONS_SCHEMA.fields)
    df = spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)
    if key is not None:
        return df.withColumnRenamed(key, ID)
    return content_ids(df)


def content_ids(df: DataFrame, id_col: str = ID, block: int = COPY_BLOCK) -> DataFrame:
    """``df`` with a unique long ``id_col`` (0-based) that depends on the rows' values alone, not on files or splits.

    Different rows are ordered by a 128-bit hash of their values and get as many consecutive ids as the row has copies.
    Copies are counted before anything is ranked and dealt out again in blocks, so a row that makes up a third of
    the table is no hot task.  Infinite, NaN and NULL cells are values like others; -0.0 counts as 0.0.  The rows are
    shuffled, so write the result once if it is read more than once."""
    cols = df.columns
    rows = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    h1, h2 = fingerprint(cols)
    rows = rows.withColumn("_key", F.concat(*[F.lpad(F.hex(h), 16, "0") for h in (h1, h2)]))
    ids = prefix_sums(rows, [], "_key", F.substring("_key", 1, 4), ["_n"])
    some, many = ids.where(F.col("_n") <= block), ids.where(F.col("_n") > block)
    some = some.withColumn("_at", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)))
    many = many.withColumn("_from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1, F.lit(block).cast("long")))) \
        .repartition("_key", "_from")
    many = many.withColumn("_at", F.explode(F.sequence("_from", F.least(F.col("_from") + block, F.col("_n")) - 1))).drop("_from")
    return some.unionByName(many).select((F.col("_n_below") + F.col("_at")).cast("long").alias(id_col), *cols)


def load_transactions(spark: SparkSession, path: str, key: str | None = None) -> DataFrame:
    """Load a transactions table (parquet directory/file or CSV), lazily.

    The path may be on any Hadoop file system; Spark raises if it isn't there.
    The row count is not taken (a count is one more job; ``dataset_shape``
    reports it on demand)."""
    if path.rstrip("/").endswith(".csv"):
        return load_transactions_csv(spark, path, key)
    return spark.read.parquet(path)
