"""SMOTE oversampling as Spark jobs.

k nearest neighbours among the minority rows are found exactly (``knn.py``:
Voronoi cells, no pair becomes a row).

Synthetic rows are x + s (x_nn - x), base rows assigned round-robin and
neighbour / step drawn from hashes of (seed, id, copy): deterministic and
restart-safe.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import ID, LABEL
from .knn import BLOCK, nearest_neighbours

K_NEIGHBORS = 5
SEED = 42
COPY_BLOCK = 10_000     # synthetic rows made from one base row in one task


def knn_minority(points: DataFrame, k: int = K_NEIGHBORS, seed: int = SEED, block: int = BLOCK) -> DataFrame:
    """Exact k nearest neighbours: ``(id, k_idx, nb_id, dist2)`` with k_idx
    1..k ordered by (squared distance, neighbour id).  ``points`` has ``id``
    and ``v`` (array<double>)."""
    return nearest_neighbours(points, k, seed, block=block)


def smote(df: DataFrame, features: list[str], label: str = LABEL, key: str = ID, k: int = K_NEIGHBORS,
          seed: int = SEED, parents: bool = False) -> DataFrame:
    """Balance the minority class up to the majority count (binary label).

    Returns the input rows plus synthetic minority rows, with ``synthetic``
    (boolean); synthetic rows get negative ids below every given one.  With
    ``parents`` also ``base_id`` and ``nb_id``, the rows that a synthetic row
    lies between (NULL for given rows)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    cc = counts.orderBy("_n").collect()  # two rows: the class sizes decide the plan
    base = df.withColumn("synthetic", F.lit(False))
    if parents:
        base = base.withColumns({"base_id": F.lit(None).cast("long"), "nb_id": F.lit(None).cast("long")})
    if len(cc) < 2:
        return base
    minority, n_min, n_maj = cc[0][label], cc[0]["_n"], cc[-1]["_n"]
    n_new = n_maj - n_min
    if n_new == 0:
        return base
    mino = df.where(F.col(label) == minority).select(
        key, F.array(*[F.col(c).cast("double") for c in features]).alias("v"))
    nn = knn_minority(mino, k, seed)
    # round-robin copies: rows ranked by a hash key, the first n_new % n_min get one extra
    from .ranked import md5_key, ranked
    r = ranked(mino, md5_key(key, seed, "smote"), key, [])
    per, extra = n_new // n_min, n_new % n_min
    copies = F.lit(per) + (F.col("_rank") <= F.lit(extra)).cast("long")
    # each base row's k neighbours, then its copies in blocks over the cluster: a few base rows may make most rows
    nbs = (nn.select(key, "k_idx", "nb_id").join(mino.select(F.col(key).alias("nb_id"), F.col("v").alias("nv")), ["nb_id"])
           .groupBy(key).agg(F.array_sort(F.collect_list(F.struct("k_idx", "nv", "nb_id"))).alias("nbs")))  # k per row
    gen = (r.join(nbs, [key]).withColumn("copies", copies).where(F.col("copies") > 0)
           .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1,
                                                     F.lit(COPY_BLOCK).cast("long")))))
    if n_new > COPY_BLOCK:
        gen = gen.repartition(key, "block")
    gen = (gen.withColumn("j", F.explode(F.sequence("block", F.least(F.col("block") + COPY_BLOCK, F.col("copies")) - 1)))
            .withColumn("k_idx", (F.pmod(F.xxhash64(F.lit(seed), F.col(key), F.col("j"), F.lit("nn")), F.lit(k)) + 1)
                        .cast("int"))
            .withColumn("step", F.pmod(F.xxhash64(F.lit(seed), F.col(key), F.col("j"), F.lit("step")),
                                       F.lit(1 << 53)).cast("double") / float(1 << 53)))
    # new ids count down from the least id (or 0), so they meet neither each other nor a given id
    low = df.agg(F.least(F.lit(0).cast("long"), F.min(key)).alias("_low"))
    syn = gen.crossJoin(F.broadcast(low)).select(
        (F.col("_low") - 1 - (F.col("_rank") - 1) * F.lit(per + 1) - F.col("j")).alias(key), F.col(key).alias("base_id"), "v", "step",
        F.element_at("nbs", F.col("k_idx")).alias("_nb"))
    syn = syn.select(key, "base_id", F.col("_nb.nb_id").alias("nb_id"), *[
        (F.col("v")[i] + F.col("step") * (F.col("_nb.nv")[i] - F.col("v")[i])).cast(df.schema[c].dataType).alias(c)
        for i, c in enumerate(features)])
    fill = {c: F.lit(None).cast(df.schema[c].dataType) for c in df.columns if c not in features and c not in (key, label)}
    syn = syn.withColumns({label: F.lit(minority).cast(df.schema[label].dataType), **fill,
                           "synthetic": F.lit(True)})
    return base.unionByName(syn.select(*base.columns))


def class_balance(before: DataFrame, after: DataFrame, label: str = LABEL) -> DataFrame:
    """``(stage, Class, count, pct)`` before and after resampling."""
    def dist(df, stage):
        g = df.groupBy(label).agg(F.count(F.lit(1)).alias("count")).withColumn("stage", F.lit(stage))
        return g.withColumn("pct", F.col("count") / F.sum("count").over(Window.partitionBy("stage")) * 100)
    return dist(before, "before").unionByName(dist(after, "after"))
