"""Properties of sampling, resampling, scaling, curves and attribution."""
import pytest
from pyspark.sql import functions as F

from sparkguard.functions.columns import FEATURE_COLS
from sparkguard.operators import metrics as M
from sparkguard.operators import sampling as SM
from sparkguard.operators import scale as SC
from sparkguard.sources import scored_fixture, transactions


@pytest.fixture(scope="module")
def tx(spark, sf):
    return transactions(spark, sf).cache()


def test_split_is_exact_partition(tx):
    sp = SM.stratified_split(tx).cache()
    n = tx.count()
    assert sp.count() == n and sp.select("id").distinct().count() == n
    n_test = sp.where("split = 'test'").count()
    assert n_test == -(-n * 2 // 10)  # ceil(0.2 n)
    by = {(r["split"], r["Class"]): r["count"] for r in sp.groupBy("split", "Class").count().collect()}
    pos = sum(v for (s, c), v in by.items() if c == 1)
    assert abs(by.get(("test", 1), 0) - 0.2 * pos) <= 1


def test_split_is_deterministic(tx):
    a = SM.stratified_split(tx).where("split = 'test'").select("id")
    b = SM.stratified_split(tx).where("split = 'test'").select("id")
    assert a.subtract(b).count() == 0


def test_folds_balanced(tx):
    f = SM.stratified_kfold(tx, 3)
    counts = [r["count"] for r in f.groupBy("fold", "Class").count().collect()]
    per = f.groupBy("Class", "fold").count().groupBy("Class").agg((F.max("count") - F.min("count")).alias("d"))
    assert all(r["d"] <= 1 for r in per.collect()) and len(counts) == 6


def test_scaled_train_moments(tx):
    sp = SM.stratified_split(tx)
    out, _ = SC.scale_split(sp, ["Amount", "V1"], "standard")
    r = out.where("split = 'train'").agg(F.avg("Amount"), F.stddev_pop("Amount"), F.avg("V1")).first()
    assert abs(r[0]) < 1e-9 and abs(r[1] - 1) < 1e-9 and abs(r[2]) < 1e-9


def test_auc_complement(spark, sf):
    s = scored_fixture(spark, sf)
    a = {r["model"]: r["roc_auc"] for r in M.auc_ap(s).collect()}
    b = {r["model"]: r["roc_auc"] for r in M.auc_ap(s.withColumn("y_prob", 1 - F.col("y_prob"))).collect()}
    assert all(abs(a[m] + b[m] - 1) < 1e-12 for m in a)


def test_auc_fixture_values(spark):
    s = scored_fixture(spark, "/root/testdata/sf0.01")
    a = {r["model"]: round(r["roc_auc"], 6) for r in M.auc_ap(s).collect()}
    assert a == {"m1": 0.87955, "m2": 0.884368, "m3": 0.872113}


def test_fixture_sizes(spark):
    from sparkguard.sources import transactions_dirty
    d = transactions_dirty(spark, "/root/testdata/sf0.01")
    r = d.agg(F.count(F.lit(1)), F.count("Amount"), F.count_if(F.isnan("V3")), F.count("channel")).first()
    assert tuple(r) == (10200, 10093, 116, 10076)


def test_time_independent_of_session_timezone(spark, sf):
    from pyspark.sql import functions as F
    base = transactions(spark, sf).select("id", "Time")
    ref = {r["id"]: r["Time"] for r in base.collect()}
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        other = {r["id"]: r["Time"] for r in transactions(spark, sf).select("id", "Time").collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert other == ref


def test_sample_sizes_exact(tx):
    n = tx.count()
    assert SM.random_sample_n(tx, 137).count() == 137
    assert SM.random_sample_n(tx, n + 50).count() == n  # all rows when n exceeds the table
    s = SM.stratified_sample(tx, 200)
    by = {r["Class"]: r["count"] for r in s.groupBy("Class").count().collect()}
    assert sum(by.values()) == 200
    share = tx.where("Class = 1").count() / n
    assert by.get(1, 0) == int(200 * share)


def test_tuning_subsample_threshold(tx):
    n = tx.count()
    assert SM.tuning_subsample(tx, 0.3, min_rows=n).count() == n          # not above the limit: all rows
    assert SM.tuning_subsample(tx, 0.3, min_rows=n - 1).count() == int(0.3 * n)
