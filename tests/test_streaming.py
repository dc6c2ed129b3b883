"""The stateless scoring path runs unchanged on a streaming source."""
import os
import uuid

from pyspark.sql import functions as F

from sparkguard.functions.columns import FEATURE_COLS
from sparkguard.operators import scale as SC
from sparkguard.session import shared_dir
from sparkguard.sources import transactions
from sparkguard.streaming.scoring import read_transactions_stream, score_stream


def test_stream_scaling_matches_batch(spark, sf):
    tx = transactions(spark, sf)
    path = shared_dir(spark, f"stream-src-{uuid.uuid4().hex[:8]}")
    tx.write.parquet(path)
    params = SC.fit_standard(tx, ["Amount", "V1"])
    stream = read_transactions_stream(spark, path, spark.read.parquet(path).schema)
    name = f"scored_{uuid.uuid4().hex[:8]}"
    q = (score_stream(stream, params, ["Amount", "V1"]).select("id", "Amount", "V1", "Hour")
         .writeStream.format("memory").queryName(name).trigger(availableNow=True).start())
    q.awaitTermination(120)
    got = spark.sql(f"select * from {name}")
    batch = SC.apply_scaler(tx, params, ["Amount", "V1"]).select("id", "Amount", "V1")
    assert got.count() == tx.count()
    diff = got.join(batch, "id").where(F.abs(got.Amount - batch.Amount) > 1e-12).count()
    assert diff == 0
