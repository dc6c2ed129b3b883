"""Ranges of scores follow the data."""
import numpy as np
from pyspark.sql import functions as F

from sparkguard.operators import metrics as M


def test_close_scores_are_dealt_out(spark):
    rng = np.random.default_rng(1)
    p = np.concatenate([0.5 + rng.random(4000) * 1e-3, np.full(300, 0.5002)])
    y = (rng.random(len(p)) < 0.2).astype(int)
    rows = [(m, i, int(y[i]), float(p[i] if m == "a" else p[i] ** 40)) for m in "ab" for i in range(len(p))]
    scored = spark.createDataFrame(rows, "model string, id long, y_true int, y_prob double")
    distinct = scored.select("model", "y_prob").distinct()
    sizes = M.score_ranges(distinct).groupBy("model", "_range").count().groupBy("model").agg(F.max("count").alias("most"), F.sum("count").alias("n"))
    assert all(r.most < 0.05 * r.n for r in sizes.collect())
    # ranges are in the order of the scores
    ordered = M.score_ranges(distinct).orderBy("model", "y_prob").collect()
    assert all(a.model != b.model or a._range <= b._range for a, b in zip(ordered, ordered[1:]))
    got = {r.model: r for r in M.auc_ap(scored).collect()}
    for m, s in (("a", p), ("b", p ** 40)):
        pos, neg = s[y == 1], s[y == 0]
        auc = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
        assert abs(got[m].roc_auc - auc) < 1e-12


def test_few_scores(spark):
    scored = spark.createDataFrame([("m", 0, 1, 0.5), ("m", 1, 0, 0.5), ("n", 0, 1, 0.0), ("n", 1, 0, 1.0)],
                                   "model string, id long, y_true int, y_prob double")
    assert {r.model: r.roc_auc for r in M.auc_ap(scored).collect()} == {"m": 0.5, "n": 0.0}
