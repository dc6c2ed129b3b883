"""Exact, deterministic, restart-safe splitting and sampling.

Every selection ranks rows by an md5 key of (seed, id) inside each class with
``ranked`` and keeps the first ``quota`` rows; quotas come from the per-class
count table.  Re-running a lost task recomputes the same keys, so results do
not depend on scheduling (unlike ``rand()``-based sampling).
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import ID, LABEL
from .ranked import approximate_mode, bucket_counts, mark_first, md5_key, null_safe_join, order_statistics

# Split fraction and seed, tuning subsample, sample caps.
TEST_SIZE = 0.2
SEED = 42
TUNING_FRACTION = 0.3
TUNING_MIN_ROWS = 10_000


def _class_counts(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))


def split_quotas(df: DataFrame, test_size: float = TEST_SIZE, label: str = LABEL,
                 class_counts: DataFrame | None = None) -> DataFrame:
    """Per class: ``n_c``, ``train_c``, ``test_c`` (n_test = ceil(test_size * n),
    train allocated by largest remainder, test = the rest)."""
    draw = F.col("_total") - F.ceil(F.lit(float(test_size)) * F.col("_total"))
    cc = class_counts if class_counts is not None else _class_counts(df, label)
    q = approximate_mode(cc, label, "n_c", draw)
    return q.select(label, "n_c", F.col("quota").alias("train_c"), (F.col("n_c") - F.col("quota")).alias("test_c"))


def stratified_split(df: DataFrame, test_size: float = TEST_SIZE, seed: int = SEED,
                     label: str = LABEL, key: str = ID, split_col: str = "split") -> DataFrame:
    """Add ``split`` in {'train', 'test'}: exact sizes, class shares kept."""
    order = md5_key(key, seed)
    counts = bucket_counts(df, order, [label])
    cc = counts.groupBy(label).agg(F.sum("_bn").alias("n_c"))  # class totals from bucket totals
    quotas = split_quotas(df, test_size, label, cc).select(label, F.col("train_c").alias("quota"))
    out = mark_first(df, order, key, [label], counts, quotas)
    return out.select(*df.columns, F.when(F.col("_in"), F.lit("train")).otherwise(F.lit("test")).alias(split_col))


def random_sample_n(df: DataFrame, n: int, seed: int = SEED, key: str = ID, salt: str = "sample") -> DataFrame:
    """Exactly ``min(n, rows)`` rows without replacement."""
    order = md5_key(key, seed, salt)
    counts = bucket_counts(df, order, [])
    quotas = counts.agg(F.lit(int(n)).cast("long").alias("quota"))
    return mark_first(df, order, key, [], counts, quotas).where("_in").select(*df.columns)


def stratified_sample(df: DataFrame, n: int, seed: int = SEED, label: str = LABEL, key: str = ID,
                      salt: str = "strat") -> DataFrame:
    """``n`` rows keeping the fraud share: minority quota int(n * mean(label)),
    the rest from the majority (all minority if it is smaller)."""
    cc = _class_counts(df, label)
    tot = cc.agg(F.sum("n_c").alias("_t"), F.sum(F.when(F.col(label) == 1, F.col("n_c")).otherwise(0)).alias("_m1"),
                 F.sum(F.when(F.col(label) == 0, F.col("n_c")).otherwise(0)).alias("_m0"))
    share = F.col("_m1").cast("double") / F.col("_t").cast("double")  # mean of the label
    want_min = F.floor(F.lit(float(n)) * share)
    few = F.col("_m1") < F.lit(float(n)) * share
    n_min = F.when(few, F.col("_m1")).otherwise(want_min)
    n_maj = F.when(few, F.least(F.col("_m0"), F.lit(n) - F.col("_m1"))).otherwise(F.lit(n) - want_min)
    quotas = cc.crossJoin(tot).select(label, F.when(F.col(label) == 1, n_min).otherwise(n_maj).alias("quota"))
    order = md5_key(key, seed, salt)
    counts = bucket_counts(df, order, [label])
    return mark_first(df, order, key, [label], counts, quotas).where("_in").select(*df.columns)


def stratified_fraction(df: DataFrame, fraction: float, seed: int = SEED, label: str = LABEL,
                        key: str = ID, salt: str = "frac") -> DataFrame:
    """Keep floor(fraction * n) rows, allocated to classes by largest remainder."""
    draw = F.floor(F.lit(float(fraction)) * F.col("_total"))
    order = md5_key(key, seed, salt)
    counts = bucket_counts(df, order, [label])
    cc = counts.groupBy(label).agg(F.sum("_bn").alias("n_c"))
    q = approximate_mode(cc, label, "n_c", draw).select(label, "quota")
    return mark_first(df, order, key, [label], counts, q).where("_in").select(*df.columns)


def tuning_subsample(df: DataFrame, fraction: float = TUNING_FRACTION, min_rows: int = TUNING_MIN_ROWS,
                     seed: int = SEED, label: str = LABEL, key: str = ID) -> DataFrame:
    """Stratified ``fraction`` of the rows when there are more than
    ``min_rows``; otherwise all rows.  One count decides the branch, so only
    the chosen plan runs."""
    if fraction >= 1.0 or df.count() <= min_rows:
        return df
    return stratified_fraction(df, fraction, seed, label, key)


def stratified_kfold(df: DataFrame, k: int = 3, seed: int = SEED, label: str = LABEL, key: str = ID,
                     fold_col: str = "fold", salt: str = "kfold") -> DataFrame:
    """Add ``fold`` in [0, k): shuffled, class shares equal across folds (+/-1).

    The rows of a class in md5 order are cut into ``k`` runs, the first ``n % k`` of them one row longer.  The ``k - 1``
    cuts of every class are selected together; each row then counts the cuts before it, so no row is shuffled."""
    order = md5_key(key, seed, salt)
    counts = bucket_counts(df, order, [label])
    n, f = F.col("n_c"), F.col("_f")
    ends = (counts.groupBy(label).agg(F.sum("_bn").alias("n_c"))
            .withColumn("_f", F.explode(F.sequence(F.lit(1), F.lit(k - 1)) if k > 1 else F.array().cast("array<int>")))
            .select(label, (f * F.floor(n / F.lit(k)).cast("long") + F.least(f, n % k)).cast("long").alias("quota")).distinct())
    cuts = order_statistics(df, order, key, [label], counts, ends).groupBy(label).agg(F.collect_list("_cut").alias("_cuts"))
    mine = F.struct(order.alias("_key"), F.col(key).alias("_id"))
    before = F.coalesce(F.size(F.filter("_cuts", lambda c: c < mine)), F.lit(0))
    return null_safe_join(df, cuts, [label], "left").select(*df.columns, before.cast("int").alias(fold_col))
