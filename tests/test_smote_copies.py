"""Synthetic rows: counts, ids, and every one on the segment between its parents."""
import numpy as np

from sparkguard.operators import resample as RS


def test_few_base_rows_make_most_rows(spark, monkeypatch):
    monkeypatch.setattr(RS, "COPY_BLOCK", 7)
    rng = np.random.default_rng(4)
    big = 2**62
    pts = [(big + i if i % 2 else -big - i, 1, *map(float, rng.normal(size=2))) for i in range(8)]
    rest = [(i, 0, *map(float, rng.normal(size=2))) for i in range(301)]
    df = spark.createDataFrame(pts + rest, "id long, Class int, a double, b double")
    out = RS.smote(df, ["a", "b"], k=3).toPandas()
    syn = out[out.synthetic]
    assert len(syn) == 293 and out.id.is_unique and (syn.id < -big - 6).all() and (syn.Class == 1).all()
    x = np.array([p[2:] for p in pts])
    for row in syn[["a", "b"]].to_numpy():
        d = [abs(np.linalg.norm(row - p) + np.linalg.norm(q - row) - np.linalg.norm(q - p))
             for i, p in enumerate(x) for j, q in enumerate(x) if i != j]
        assert min(d) < 1e-9
    again = RS.smote(df.repartition(5), ["a", "b"], k=3).toPandas()
    assert out.sort_values("id").reset_index(drop=True).equals(again.sort_values("id").reset_index(drop=True))
