"""Line deduplication by distinct-site spread.

Lines (``\\n``-split, trimmed, with a visible character) are hashed to 128 bits.  One HyperLogLog sketch of the sites (the
``source`` column) per line hash is merged by aggregation, map side first, so a line of a third of all rows is one
small sketch per task.  Lines whose estimate is within ``MARGIN`` standard errors of the threshold are counted exactly;
farther ones are decided by the estimate.  Lines on at least ``MIN_SITES`` distinct sites are boilerplate, and all their
occurrences are removed.

A null source counts as no site.  Null texts stay null, empty texts empty.  Rows equal in doc_id and text get the same
result.  Columns other than doc_id, text and source are ignored.  An empty table gives an empty result.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_key, same_doc, written

MIN_SITES = 10
LG_K = 10
MARGIN = 4.0
#: Relative standard error of a sketch with 2^LG_K registers.
ERROR = 1.04 / (1 << LG_K) ** 0.5


def lines(docs: DataFrame) -> DataFrame:
    """``(doc_id, k, site, h1, h2)``: one row per line hash of a document, repeats in it once."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                    F.col("source").cast("string").alias("site"))
    trimmed = F.transform(F.split("text", "\n"), lambda x: F.trim(x))
    each = F.array_distinct(F.filter(trimmed, lambda x: x != ""))
    pairs = F.transform(each, lambda x: F.struct(F.xxhash64(x).alias("h1"), F.xxhash64(F.lit(7), x).alias("h2")))
    return d.select("doc_id", doc_key(), "site", F.inline(pairs))


def line_spread(docs: DataFrame, lg_k: int = LG_K) -> DataFrame:
    """``(h1, h2, n_docs, sites)``: documents and estimated distinct sites of each line."""
    return lines(docs).groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_docs"), F.hll_sketch_estimate(
        F.hll_sketch_agg("site", F.lit(lg_k))).alias("sites"))


def boilerplate(docs: DataFrame, min_sites: int = MIN_SITES, margin: float = MARGIN) -> DataFrame:
    """``(h1, h2)`` of the lines on at least ``min_sites`` distinct sites."""
    # a line in fewer documents than min_sites can't be on as many sites
    spread = written(line_spread(docs).filter((F.col("n_docs") >= min_sites)
                     & (F.col("sites") >= min_sites * (1 - margin * ERROR) - 1)), "spread")
    sure = spread.filter(F.col("sites") > min_sites * (1 + margin * ERROR) + 1).select("h1", "h2")
    near = spread.filter(F.col("sites") <= min_sites * (1 + margin * ERROR) + 1).select("h1", "h2")
    sites = lines(docs).select("h1", "h2", "site").join(near, ["h1", "h2"]).distinct()
    exact = sites.groupBy("h1", "h2").agg(F.count("site").alias("n")).filter(F.col("n") >= min_sites).select("h1", "h2")
    return sure.union(exact)


def remove_boilerplate(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """``(doc_id, text, n_lines, n_removed)`` per row of ``docs``; ``n_lines`` counts lines with a visible character."""
    bad = written(boilerplate(docs, min_sites), "boilerplate")
    cut = lines(docs).join(bad, ["h1", "h2"]).groupBy("doc_id", "k").agg(F.collect_list(F.struct("h1", "h2")).alias("cut"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.select("doc_id", "text", doc_key())
    both = rows.join(cut, same_doc(rows, cut), "left").select(rows["doc_id"], rows["text"], cut["cut"])
    parts = F.split("text", "\n")
    mark = lambda x: F.struct(F.xxhash64(F.trim(x)).alias("h1"), F.xxhash64(F.lit(7), F.trim(x)).alias("h2"))
    both = both.select("doc_id", "text", "cut", parts.alias("parts"))
    both = both.withColumn("kept", F.when(F.col("cut").isNull(), F.col("parts")).otherwise(
        F.filter("parts", lambda x: ~F.array_contains("cut", mark(x)))))
    zero = F.lit(0)
    return both.select("doc_id", F.when(F.col("cut").isNull(), F.col("text")).otherwise(F.array_join("kept", "\n")).alias("text"),
                       F.coalesce(F.size(F.filter("parts", lambda x: F.trim(x) != "")), zero).cast("long").alias("n_lines"),
                       F.when(F.col("cut").isNull(), zero).otherwise(F.size("parts") - F.size("kept")).cast("long").alias("n_removed"))
