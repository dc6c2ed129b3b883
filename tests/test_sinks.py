"""Sinks: processed table partitioned by split (pruned on read), result tables."""
import uuid

from sparkguard.operators import metrics as M
from sparkguard.plans import preprocess as PP
from sparkguard.session import shared_dir
from sparkguard.sources import scored_fixture, transactions
from sparkguard.sources import models_io as IO


def test_processed_sink_prunes_partitions(spark, sf):
    from pyspark.sql import functions as F
    df = transactions(spark, sf).withColumn("split", F.when(F.col("id") % 5 == 0, "test").otherwise("train"))
    path = shared_dir(spark, f"processed-{uuid.uuid4().hex[:8]}")
    PP.save_processed(df, path)
    test = PP.load_processed(spark, path, "test")
    plan = test._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan and "(split#" in plan
    assert test.count() == df.where("split = 'test'").count()


def test_result_table_written_as_one_csv(spark, sf):
    comp = M.model_comparison(scored_fixture(spark, sf))
    path = shared_dir(spark, f"model_comparison-{uuid.uuid4().hex[:8]}")
    IO.write_result(comp, path, "csv")
    back = spark.read.option("header", True).csv(path)
    assert back.count() == 3 and back.rdd.getNumPartitions() == 1
    assert set(back.columns) == set(comp.columns)
