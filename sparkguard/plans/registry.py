"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each query builds its input from the shared tables (the fixture views of
``sparkguard.sources``), runs one operator and rounds doubles to 6 places so
results compare across engines.  The DuckDB twin of each S-checked query is in
``oracle_sql``.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..functions.columns import round_doubles
from ..session import keep_methods_small, materialize
from ..sources import scored_fixture, transactions, transactions_dirty

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            keep_methods_small(spark)
            return round_doubles(fn(spark, sf_dir), 6)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn
    return deco


def tx(spark, d):
    """The transactions table, written once per application (see README)."""
    return materialize(spark, f"transactions:{d}", lambda: transactions(spark, d))


def dirty(spark, d):
    return materialize(spark, f"transactions_dirty:{d}", lambda: transactions_dirty(spark, d))


def scored(spark, d):
    return materialize(spark, f"scored:{d}", lambda: scored_fixture(spark, d))


# Modules below register their queries on import.
from . import q_metrics, q_models, q_prep, q_profile, q_resample, q_sampling, q_stats  # noqa: E402,F401
