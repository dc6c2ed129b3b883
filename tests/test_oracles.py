"""Registered queries against their DuckDB twins (sf0.001).  The default run
checks a cross-section; SPARKGUARD_ALL_ORACLES=1 checks every S query."""
import os

import pytest

from oracle_compare import compare, duck

SUBSET = ["load_transactions", "null_report", "duplicate_count", "iqr_outlier_report", "quality_summary",
          "handle_missing", "cap_outliers", "transform_features", "fraud_ratio_by_hour", "stratified_split",
          "stratified_kfold", "tuning_subsample", "model_comparison", "roc_curve", "pr_curve", "threshold_sweep",
          "cost_curve_min", "correlation_matrix", "histogram", "kde", "boxplot_stats", "standard_scale",
          "smote_neighbors", "smote_neighbors_scaled", "load_processed", "before_after_balance", "stored_scaler", "load_transactions_csv", "evaluate_pipeline"]


def _names():
    import __spark_entry__ as E
    if os.environ.get("SPARKGUARD_ALL_ORACLES"):
        return sorted(E.oracle_sql())
    return SUBSET


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, sf, con, name):
    r = compare(spark, name, sf, con)
    assert r.get("hash_match"), r


def test_every_oracle_has_a_query():
    import __spark_entry__ as E
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["hour", "class_0", "class_1", "fraud_ratio"]
