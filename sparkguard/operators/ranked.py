"""Exact ranks over a global order without a single-partition window.

The order key has a deterministic *bucket* that is monotone in the key (the
first hex digits of an md5 key, or a fixed score grid).  Per-bucket counts form
a small table (buckets x strata); its exclusive prefix sums are broadcast back,
and ``row_number`` runs inside each (stratum, bucket) only.  A stratum holding
a third of all rows is still spread over all its buckets.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# 16**4 = 65 536 buckets per stratum: about 15 M rows per window group at 1e12 rows.
DEFAULT_BUCKET_HEX = 4


def md5_key(id_col: str, seed: int, salt: str = "") -> Column:
    """Deterministic pseudo-random order key: md5('<seed>-[<salt>-]<id>')."""
    prefix = f"{seed}-{salt}-" if salt else f"{seed}-"
    return F.md5(F.concat(F.lit(prefix), F.col(id_col).cast("string")))


def ranked(df: DataFrame, key: Column, tiebreak: str, partition_cols: list[str] | None = None,
           bucket: Column | None = None, bucket_hex: int = DEFAULT_BUCKET_HEX,
           rank_col: str = "_rank", size_col: str = "_stratum_n", return_counts: bool = False):
    """Add the 1-based rank of each row inside its stratum, ordered by
    ``(key, tiebreak)``, and the stratum size.  With ``return_counts`` also
    return the per-(stratum, bucket) count table ``(*strata, _b, _bn)``, so
    callers derive stratum totals from it instead of scanning again."""
    parts = list(partition_cols or [])
    keyed = df.withColumn("_key", key)
    keyed = keyed.withColumn("_b", bucket if bucket is not None else F.substring(F.col("_key"), 1, bucket_hex))
    counts = keyed.groupBy(*parts, "_b").agg(F.count(F.lit(1)).alias("_bn"))
    w = Window.partitionBy(*parts).orderBy("_b")
    offs = counts.select(
        *parts, "_b",
        F.coalesce(F.sum("_bn").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"),
        F.sum("_bn").over(Window.partitionBy(*parts)).alias(size_col))
    within = F.row_number().over(Window.partitionBy(*parts, "_b").orderBy("_key", tiebreak))
    out = null_safe_join(keyed.withColumn("_rn", within), offs, [*parts, "_b"])
    out = out.withColumn(rank_col, F.col("_off") + F.col("_rn")).drop("_key", "_b", "_rn", "_off")
    return (out, counts) if return_counts else out


def null_safe_join(df: DataFrame, small: DataFrame, cols: list[str], how: str = "inner") -> DataFrame:
    """Join a small per-stratum table on ``cols`` with NULL equal to NULL."""
    right = small.select(*[F.col(c).alias(f"_j_{c}") for c in cols], *[c for c in small.columns if c not in cols])
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).eqNullSafe(F.col(f"_j_{c}"))
    return df.join(F.broadcast(right), cond, how).drop(*[f"_j_{c}" for c in cols])


def bucket_counts(df: DataFrame, key: Column, partition_cols: list[str], bucket_hex: int = DEFAULT_BUCKET_HEX) -> DataFrame:
    """``(*strata, _b, _bn)``: rows per stratum and key bucket."""
    return df.select(*partition_cols, F.substring(key, 1, bucket_hex).alias("_b")) \
        .groupBy(*partition_cols, "_b").agg(F.count(F.lit(1)).alias("_bn"))


def first_in_order(df: DataFrame, key: Column, tiebreak: str, partition_cols: list[str], counts: DataFrame,
                   quotas: DataFrame) -> DataFrame:
    """A table of one row per stratum ``(*strata, _cut)``: the ``(key, tiebreak)`` of the ``quota``-th row.

    Only the one bucket per stratum that the quota falls in is ranked, on key and tiebreak alone; no other row is
    shuffled.  Compare ``struct(key, tiebreak) <= _cut`` to tell the first ``quota`` rows; ``_cut`` is NULL for quota 0.
    """
    parts = list(partition_cols)
    cut = order_statistics(df, key, tiebreak, parts, counts, quotas).select(*parts, "_cut")
    keep = quotas.select(*parts)
    return null_safe_join(keep, cut, parts, "left") if parts else keep.join(F.broadcast(cut), F.lit(True), "left")


def order_statistics(df: DataFrame, key: Column, tiebreak: str, partition_cols: list[str], counts: DataFrame,
                     quotas: DataFrame) -> DataFrame:
    """``(*strata, quota, _cut)``: the ``(key, tiebreak)`` of the ``quota``-th row for each row of ``quotas``, of which
    a stratum may have several (different ones).  Quotas below 1 have no row; those above the stratum's size name its last."""
    parts = list(partition_cols)
    w = Window.partitionBy(*parts).orderBy("_b")
    offs = counts.select(*parts, "_b", "_bn", F.sum("_bn").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("_upto"))
    offs = null_safe_join(offs, quotas, parts) if parts else offs.crossJoin(F.broadcast(quotas))
    total = F.sum("_bn").over(Window.partitionBy(*parts))
    offs = offs.withColumn("_want", F.least("quota", total)) \
        .where((F.col("_want") > F.col("_upto") - F.col("_bn")) & (F.col("_want") <= F.col("_upto"))) \
        .select(*parts, "_b", "quota", (F.col("_want") - F.col("_upto") + F.col("_bn")).alias("_nth"))
    rows = df.select(*parts, key.alias("_key"), F.col(tiebreak).alias("_id")) \
        .withColumn("_b", F.substring("_key", 1, DEFAULT_BUCKET_HEX))
    edge = null_safe_join(rows, offs, [*parts, "_b"])
    nth = F.row_number().over(Window.partitionBy(*parts, "quota", "_b").orderBy("_key", "_id"))   # one bucket per quota
    return edge.withColumn("_rn", nth).where("_rn = _nth").select(*parts, "quota", F.struct("_key", "_id").alias("_cut"))


def mark_first(df: DataFrame, key: Column, tiebreak: str, partition_cols: list[str], counts: DataFrame,
               quotas: DataFrame, name: str = "_in") -> DataFrame:
    """``df`` with the boolean ``name``: whether the row is among the first ``quota`` of its stratum."""
    cut = first_in_order(df, key, tiebreak, partition_cols, counts, quotas)
    out = null_safe_join(df, cut, list(partition_cols), "left") if partition_cols else df.join(F.broadcast(cut), F.lit(True), "left")
    inside = F.struct(key.alias("_key"), F.col(tiebreak).alias("_id")) <= F.col("_cut")
    return out.withColumn(name, F.coalesce(inside, F.lit(False))).drop("_cut")


def approximate_mode(class_counts: DataFrame, label: str, count_col: str, draw: Column) -> DataFrame:
    """Largest-remainder allocation of ``draw`` rows over classes in
    proportion to their counts (ties to the lower class).  ``draw`` may use
    the total as ``_total``.  Runs on the per-class table only."""
    w_all = Window.partitionBy()
    t = class_counts.withColumn("_total", F.sum(count_col).over(w_all)).withColumn("_draw", draw)
    big = "decimal(19,0)"    # a BIGINT product overflows above 3e9 rows
    cont = (F.col("_draw").cast(big) * F.col(count_col).cast(big)).cast("double") / F.col("_total").cast("double")
    t = t.withColumn("_fl", F.floor(cont)).withColumn("_rem", cont - F.floor(cont))
    t = t.withColumn("_need", F.col("_draw") - F.sum("_fl").over(w_all))
    rk = F.row_number().over(Window.orderBy(F.desc("_rem"), F.asc(label)))
    return t.withColumn("quota", (F.col("_fl") + (rk <= F.col("_need")).cast("long")).cast("long")) \
            .select(label, count_col, "_total", "quota")


def prefix_sums(df: DataFrame, partition_cols: list[str], order_col: str, bucket: Column,
                values: list[str]) -> DataFrame:
    """Exclusive running sums of ``values`` in ``order_col`` order inside each
    partition (``{v}_below``), partition totals (``{v}_total``) and the
    1-based position ``_pos`` -- bucketed like ``ranked`` (``order_col`` must
    be unique inside a partition, e.g. after aggregating to distinct scores)."""
    parts = list(partition_cols)
    b = df.withColumn("_b", bucket)
    tot = b.groupBy(*parts, "_b").agg(*[F.sum(v).alias(f"_bt_{v}") for v in values],
                                      F.count(F.lit(1)).alias("_bn"))
    w = Window.partitionBy(*parts).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    wp = Window.partitionBy(*parts)
    offs = tot.select(*parts, "_b",
                      *[F.coalesce(F.sum(f"_bt_{v}").over(w), F.lit(0)).alias(f"_bo_{v}") for v in values],
                      F.coalesce(F.sum("_bn").over(w), F.lit(0)).alias("_bo_n"),
                      *[F.sum(f"_bt_{v}").over(wp).alias(f"{v}_total") for v in values])
    wi = Window.partitionBy(*parts, "_b").orderBy(order_col)
    inner = b.withColumns({**{f"_in_{v}": F.coalesce(F.sum(v).over(wi.rowsBetween(Window.unboundedPreceding, -1)),
                                                     F.lit(0)) for v in values},
                           "_in_rn": F.row_number().over(wi)})
    out = inner.join(F.broadcast(offs), [*parts, "_b"])
    return out.select(*df.columns, *[(F.col(f"_bo_{v}") + F.col(f"_in_{v}")).alias(f"{v}_below") for v in values],
                      *[F.col(f"{v}_total") for v in values], (F.col("_bo_n") + F.col("_in_rn")).alias("_pos"))
