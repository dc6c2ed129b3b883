"""Neighbours by Voronoi cells: equal to all pairs, few pairs compared on clustered rows, copies of one row."""
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sparkguard.operators import knn


def _all_pairs(x, ids, k):
    out = {}
    for i in range(len(x)):
        d = np.zeros(len(x))
        for f in range(x.shape[1]):
            d += np.square(x[i, f] - x[:, f])
        order = [j for j in np.lexsort((ids, d)) if j != i][:k]
        out |= {(int(ids[i]), n + 1): (int(ids[j]), d[j]) for n, j in enumerate(order)}
    return out


def _frame(spark, x, ids):
    return spark.createDataFrame([(int(i), [float(v) for v in r]) for i, r in zip(ids, x)], "id long, v array<double>")


def _got(spark, x, ids, k, **options):
    rows = knn.nearest_neighbours(_frame(spark, x, ids), k, **options).collect()
    assert len(rows) == len(x) * k
    return {(r.id, r.k_idx): (r.nb_id, r.dist2) for r in rows}


@pytest.mark.parametrize("k", [5, 20])
def test_few_pairs_on_clustered_rows(spark, monkeypatch, k):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 30)) * 10
    x = centres[rng.integers(0, 12, 1500)] + rng.normal(size=(1500, 30))
    ids = rng.permutation(1500) * 7 - 300
    compared, plain = [], knn.compare

    def counting(tasks, d, n):
        compared.append(tasks.agg(F.sum(F.size("q_ids") * F.size("c_ids"))).first()[0] or 0)
        return plain(tasks, d, n)
    monkeypatch.setattr(knn, "compare", counting)
    assert _got(spark, x, ids, k) == _all_pairs(x, ids, k)
    assert len(compared) == 2 and sum(compared) <= 0.2 * 1500 ** 2, compared


@pytest.mark.parametrize("cell,block", [(4, 3), (1, 1024), (10_000, 64)])
def test_small_cells_blocks_and_outliers(spark, cell, block):
    rng = np.random.default_rng(2)
    x = np.round(rng.normal(size=(120, 3)), 1)
    x[:4] *= 1e6                                      # alone in their cells
    assert _got(spark, x, np.arange(120), 7, cell=cell, block=block) == _all_pairs(x, np.arange(120), 7)


def test_copies_of_one_row(spark):
    """A third of the rows are one point: its neighbours are the least ids, and its copies don't meet each other."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 4))
    x[100:200] = x[100]
    ids = rng.permutation(300)
    frame = _frame(spark, x, ids)
    assert _got(spark, x, ids, 5, cell=8) == _all_pairs(x, ids, 5)
    assert knn.nearest_neighbours(frame.repartition(7), 5).count() == 1500


def test_all_rows_equal(spark):
    x = np.ones((9, 2))
    assert _got(spark, x, np.arange(9), 8) == _all_pairs(x, np.arange(9), 8)
    with pytest.raises(ValueError):
        knn.nearest_neighbours(_frame(spark, x, np.arange(9)), 9)


def test_bounds_are_below_every_distance():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 6))
    cells = knn.Cells(x[rng.choice(400, 20, replace=False)])
    far = cells.to_pivots(x)
    cell = far.argmin(axis=1)
    for c in range(20):
        cells.sizes[c], cells.radius[c] = (cell == c).sum(), far[cell == c, c].max()
    low, true = cells.bounds(far), np.sqrt(knn.squared_distances(x, x))
    for c in range(20):
        assert (low[:, c] <= true[:, cell == c].min(axis=1) + 1e-12).all()


def test_a_batch_of_packs_stays_small(spark, monkeypatch):
    """Rows without structure go to every cell: what a task holds at a time must not be queries x cells."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(3000, 20))
    cells = knn.Cells(x[:300])
    cells.sizes[:] = 10
    cells.radius[:] = 9.0
    sizes, plain = [], pa.RecordBatch.from_arrays

    class Seen:
        @staticmethod
        def from_arrays(arrays, names):
            sizes.append(sum(a.nbytes for a in arrays))
            return plain(arrays, names)
    frame = spark.createDataFrame([(i, [float(v) for v in r], 1e9) for i, r in enumerate(x)], "id long, v array<double>, bound double")
    runs = []
    monkeypatch.setattr(type(frame), "mapInArrow", lambda self, run, schema: runs.append(run))
    knn.route(frame, cells, 20, 5, False)
    batch = pa.table({"id": np.arange(3000), "v": pa.array(list(x), pa.list_(pa.float64())), "bound": np.full(3000, 1e9)}).to_batches()[0]
    monkeypatch.setattr(knn.pa, "RecordBatch", Seen)
    sent = sum(sum(len(q) for q in b.column("q_ids").to_pylist()) for b in runs[0](iter([batch])))
    assert sent > 800_000 and max(sizes) <= 12 * knn.SENT, (sent, max(sizes))


def test_proposed_pairs_keep_the_nearest():
    rng = np.random.default_rng(7)
    for far in (0.0, 1e6, 1e160):
        q, c = rng.normal(size=(40, 5)) + far, np.repeat(rng.normal(size=(60, 5)) + far, 2, axis=0)
        r, j, dist = knn.near_pairs(q, c, np.full(40, np.inf), 7)
        full = knn.squared_distances(q, c)
        assert (dist == full[r, j]).all()
        for i in range(40):
            assert sorted(dist[r == i])[:7] == sorted(full[i])[:7]


def test_a_row_given_twice_asks_once(spark):
    """The same id and values twice: the point is one query, and no neighbour is listed twice for it."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(40, 3))
    frame = _frame(spark, np.vstack([x, x[:10]]), [*range(40), *range(10)])
    got = [(r.id, r.k_idx) for r in knn.nearest_neighbours(frame, 4).where("id >= 10").collect()]
    assert len(got) == len(set(got)) == 30 * 4
    rows = knn.nearest_neighbours(frame, 4).where("id < 10").groupBy("id", "k_idx").agg(F.count_distinct("nb_id").alias("n")).collect()
    assert rows and all(r.n == 1 for r in rows)
