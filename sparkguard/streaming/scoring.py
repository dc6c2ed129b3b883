"""Stateless scoring on a streaming DataFrame.

The reference has no streaming.  Feature engineering, scaling with fitted
parameters and ``model.transform`` are row-local, so the batch operators run
unchanged on a ``readStream`` source; the fitted one-row parameter frame joins
as a static side.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import features as FE
from ..operators import scale as SC


def read_transactions_stream(spark: SparkSession, path: str, schema, max_files_per_trigger: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(path)


def score_stream(stream: DataFrame, params: DataFrame, features: list[str], fitted=None) -> DataFrame:
    """Engineer features, scale with ``params`` (static one-row frame) and,
    if a model is given, add its probability of class 1."""
    out = FE.transform_features(stream)
    out = out.withColumns({f"Period_{p}": out[f"Period_{p}"].cast("double") for p in FE.DAY_PERIODS})
    cols = [c for c in features if c in out.columns]
    out = SC.apply_scaler(out, params, cols)
    if fitted is None:
        return out
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array
    from pyspark.sql import functions as F
    a = VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="keep").transform(out)
    return fitted.transform(a).withColumn("y_prob", vector_to_array("probability")[1]).drop(
        "features", "rawPrediction", "probability")
