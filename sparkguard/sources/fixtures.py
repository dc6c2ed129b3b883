"""The transaction views derived from the shared test tables.

``transactions``: one row per event, with 28 vector components taken from the
``embeddings`` row ``event_id % n``; ``transactions_dirty`` adds missing, NaN,
infinite and duplicated cells; ``scored`` holds deterministic model scores.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import ID, LABEL, V_COLS
from .tables import read_table

# Fixed values of the fixture definition.
EPOCH = "2024-01-01 00:00:00"
FRAUD_LABEL = 0
FRAUD_MIN_AMOUNT = 100
SCORE_MULTIPLIER = 7919
SCORED_MODELS = ["m1", "m2", "m3"]


def _base(spark: SparkSession, sf_dir: str, extra_event_cols: tuple[str, ...] = ()) -> DataFrame:
    events = read_table(spark, sf_dir, "events")
    want = spark.sparkContext.defaultParallelism
    if events.rdd.getNumPartitions() < want:     # a plain scan: planned, not run
        events = events.repartition(want, "event_id")    # small inputs arrive as one file: every core works
    vectors = read_table(spark, sf_dir, "embeddings")
    n = vectors.count()  # metadata-only count: the modulus
    if n == 0:
        raise ValueError("embeddings table is empty")
    vec = vectors.select(F.col("vec_id"), F.col("embedding"), F.col("label"))
    ev = events.select(
        F.col("event_id").alias(ID), "ts", "value", *extra_event_cols,
        (F.col("event_id") % F.lit(n)).alias("_vec_key"))
    joined = ev.join(vec, ev["_vec_key"] == vec["vec_id"], "inner")
    # wall-clock microseconds since EPOCH from the timestamp_ntz fields: exact
    # integers and independent of the session time zone (no DST shifts)
    days = F.datediff(F.to_date("ts"), F.lit(EPOCH[:10]).cast("date")).cast("long")
    whole = ((days * 24 + F.hour("ts")) * 60 + F.minute("ts")) * 60
    micros = whole * 1_000_000 + (F.date_part(F.lit("SECOND"), F.col("ts")) * 1_000_000).cast("long")
    time_s = micros / F.lit(1e6)
    cols = [F.col(ID), time_s.alias("Time")]
    cols += [F.col("embedding")[i].cast("double").alias(v) for i, v in enumerate(V_COLS)]
    cols += [F.col("value").alias("Amount"),
             F.when((F.col("label") == FRAUD_LABEL) & (F.col("value") > FRAUD_MIN_AMOUNT), 1)
             .otherwise(0).alias(LABEL)]
    cols += [F.col(c) for c in extra_event_cols]
    return joined.select(*cols)


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``transactions(id, Time, V1..V28, Amount, Class)``."""
    return _base(spark, sf_dir)


def transactions_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``transactions`` + ``channel``, with NULL/NaN/±inf cells and exact
    duplicates of every row whose ``id % 50 = 0``."""
    base = _base(spark, sf_dir, ("event_type",)).withColumnRenamed("event_type", "channel")
    idc = F.col(ID)
    dirty = base.withColumns({
        "Amount": F.when(idc % 97 == 0, F.lit(None).cast("double")).otherwise(F.col("Amount")),
        "V3": F.when(idc % 89 == 0, F.lit(float("nan"))).otherwise(F.col("V3")),
        "V4": F.when(idc % 101 == 0, F.lit(float("inf")))
               .when(idc % 103 == 0, F.lit(float("-inf"))).otherwise(F.col("V4")),
        "channel": F.when(idc % 83 == 0, F.lit(None).cast("string")).otherwise(F.col("channel")),
    })
    return dirty.unionByName(dirty.filter(idc % 50 == 0))


def scored_fixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``scored(model, id, y_true, y_prob, y_pred)`` for three score rules."""
    tx = transactions(spark, sf_dir).select(ID, LABEL)
    k = F.col("_k")
    u = ((F.col(ID) * F.lit(SCORE_MULTIPLIER) * k) % 1000).cast("double") / F.lit(1000.0)
    prob = F.when(F.col(LABEL) == 1, F.lit(0.3) + F.lit(0.7) * u).otherwise(F.lit(0.8) * u * u)
    return (tx.withColumn("_k", F.explode(F.array(*[F.lit(i + 1) for i in range(len(SCORED_MODELS))])))
              .select(F.concat(F.lit("m"), k.cast("string")).alias("model"), F.col(ID),
                      F.col(LABEL).alias("y_true"), prob.alias("y_prob"))
              .withColumn("y_pred", (F.col("y_prob") >= 0.5).cast("int")))
