"""Queries for splitting and sampling (2.11) and split statistics (2.2)."""
from __future__ import annotations

from ..operators import profile as P
from ..operators import sampling as SM
from .registry import dirty, query, tx

# Sample sizes of the registered sampling queries (parameters of the feature).
SAMPLE_N = 2000


def split_tx(spark, d):
    return SM.stratified_split(tx(spark, d))


@query("stratified_split")
def stratified_split_q(spark, d):
    return split_tx(spark, d).select("id", "Class", "split")


@query("split_class_distribution")
def split_class_distribution_q(spark, d):
    return P.split_class_distribution(split_tx(spark, d))


@query("split_class_pivot")
def split_class_pivot_q(spark, d):
    return P.split_class_pivot(split_tx(spark, d))


@query("random_sample_n")
def random_sample_n_q(spark, d):
    return SM.random_sample_n(tx(spark, d), SAMPLE_N).select("id", "Class", "Amount")


@query("stratified_sample")
def stratified_sample_q(spark, d):
    return SM.stratified_sample(tx(spark, d), SAMPLE_N).select("id", "Class")


@query("tuning_subsample")
def tuning_subsample_q(spark, d):
    return SM.tuning_subsample(dirty(spark, d)).select("id", "Class")


@query("stratified_kfold")
def stratified_kfold_q(spark, d):
    return SM.stratified_kfold(tx(spark, d)).select("id", "Class", "fold")
