"""Plan inspection: pruning/pushdown at the scan, no single-partition
exchange over data rows, broadcasts only of bounded sides."""
from pyspark.sql import functions as F

from sparkguard.operators import metrics as M
from sparkguard.operators import sampling as SM
from sparkguard.sources import read_table, scored_fixture, transactions


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_prunes_and_pushes(spark, sf):
    df = read_table(spark, sf, "events").where(F.col("value") > 100).select("event_id")
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(value), GreaterThan(value,100.0)]" in p
    assert "ReadSchema: struct<event_id:bigint,value:double>" in p


def _single_partition_only_over_aggregates(p: str) -> bool:
    """Every SinglePartition exchange gathers rows that were aggregated just
    below it (class or bucket totals), never raw data rows."""
    lines = p.splitlines()
    for i, ln in enumerate(lines):
        if "Exchange SinglePartition" in ln:
            if not any("HashAggregate" in x or "ObjectHashAggregate" in x for x in lines[i + 1:i + 4]):
                return False
    return True


def test_split_has_no_single_partition_over_rows(spark, sf):
    p = _plan(SM.stratified_split(transactions(spark, sf)))
    assert _single_partition_only_over_aggregates(p), p
    assert "CartesianProduct" not in p


def test_sample_has_no_single_partition_over_rows(spark, sf):
    p = _plan(SM.random_sample_n(transactions(spark, sf), 100))
    assert _single_partition_only_over_aggregates(p), p


def test_roc_has_no_global_window(spark, sf):
    from sparkguard.operators import curves as CV
    p = _plan(M.auc_ap(scored_fixture(spark, sf)))
    assert _single_partition_only_over_aggregates(p), p
    assert "CartesianProduct" not in p
