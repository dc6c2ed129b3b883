"""Connected components of an edge table, by minimum labels with pointer jumping."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(edges: DataFrame) -> DataFrame:
    """``(node, label)`` for every node of ``edges(a, b)``: the least node of its component.

    Nodes may be of any orderable type without nulls at the top level (structs may hold nulls).  Each round takes the
    least label among a node's neighbours (map-side combined, so hubs are cheap) and then the label's label; on graphs
    of stars it ends after a few rounds.  Every round is written to the shared folder.
    """
    both = written(edges.filter("a != b").select("a", "b").union(edges.filter("a != b").select("b", "a")).distinct(),
                   "edges")
    labels = written(both.groupBy("a").agg(F.min("b").alias("m"))
                     .select(F.col("a").alias("node"), F.least("a", "m").alias("label")), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("m"))
        step = written(labels.join(near, labels["node"] == near["a"])
                       .select("node", F.col("label").alias("old"), F.least("label", "m").alias("label")), "step")
        up = step.select(F.col("node").alias("up"), F.col("label").alias("up_label"))
        new = written(step.join(up, step["label"] == up["up"])
                      .select("node", "old", F.least("label", "up_label").alias("label")), "labels")
        labels = new.select("node", "label")
        if new.filter("label != old").isEmpty():
            return labels
