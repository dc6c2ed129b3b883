"""Exact k nearest neighbours of the rows of one table, by Voronoi cells around sampled pivots.

Equal points are one point for the search; of its rows only the k + 1 least ids can be neighbours, so copies never meet each
other.  Pivots are a hash sample of the points (dense regions get more of them), at most ``MAX_PIVOTS``, and every
candidate belongs to the cell of its nearest pivot.  Only pivots, cell sizes and radii are shared with all tasks: a
bounded table.  Two passes over the points follow:

1. each point meets the nearest cells that hold k + 1 candidates together, which bounds its k-th distance;
2. each point goes to those other cells that can hold something nearer: by the triangle inequality a row of cell c is at
   least |x - p_c| - radius_c away, and as it lies nearer to p_c than to the point's own pivot p, at least
   (|x - p_c|^2 - |x - p|^2) / (2 |p_c - p|).

So no pair becomes a row: tasks join packs of queries with blocks of a cell (``BLOCK`` rows of similar distance to the pivot) and
compare them in numpy.  Distances are summed in the order of the columns, ties go to the lesser id, so results are exact and
deterministic.  A lost task is computed again from written tables.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import ID
from ..session import cut_lineage, ensure_checkpoint_dir

BLOCK = 1024            # candidates of a block
CELL = 64               # candidates of a cell on average, while MAX_PIVOTS allows it
MAX_PIVOTS = 4096
PACK = 256              # queries that meet a block at once
FAR_CELLS = 2_000_000   # distances from queries to pivots held at a time
SENT = 1 << 20          # numbers of a batch of packs, about
TASK_ROWS = 4096        # queries of one routing task
SLACK = 1e-9            # relative allowance for the rounding of bounds


def squared_distances(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """(rows of q, rows of c), each summed in the order of the columns."""
    out = np.zeros((len(q), len(c)))
    for f in range(q.shape[1]):
        out += np.square(q[:, f, None] - c[None, :, f])
    return out


def near_pairs(q: np.ndarray, c: np.ndarray, bound: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of q, row of c, squared distance) of all pairs that may be among a query's ``n`` nearest within its squared ``bound``.

    |q|^2 + |c|^2 - 2 qc proposes pairs, with an allowance for its rounding; distances are then summed in the order of the columns."""
    with np.errstate(over="ignore", invalid="ignore"):             # then all pairs are summed
        qq, cc = (q * q).sum(axis=1), (c * c).sum(axis=1)
        about = qq[:, None] + cc - 2 * (q @ c.T)
    m = min(n, len(c))
    if np.isfinite(about).all():
        slack = 1e-12 * q.shape[1] * (qq + cc.max())
        limit = np.minimum(np.partition(about, m - 1, axis=1)[:, m - 1] + 2 * slack, bound + slack)
        r, j = np.nonzero(about <= limit[:, None])
        dist = np.zeros(len(r))
        for f in range(q.shape[1]):
            dist += np.square(q[r, f] - c[j, f])
    else:
        full = squared_distances(q, c)
        r, j = np.nonzero(full <= np.partition(full, m - 1, axis=1)[:, m - 1, None])
        dist = full[r, j]
    inside = dist <= bound[r]
    return r[inside], j[inside], dist[inside]


class Cells:
    """What every task knows of the cells: pivots, candidates per cell and radius."""

    def __init__(self, pivots: np.ndarray) -> None:
        self.pivots = pivots
        self.sizes = np.zeros(len(pivots), np.int64)
        self.radius = np.zeros(len(pivots))
        self.between = np.sqrt(squared_distances(pivots, pivots))

    def to_pivots(self, x: np.ndarray) -> np.ndarray:
        return np.sqrt(squared_distances(x, self.pivots))

    def nearest_with(self, far: np.ndarray, n: int) -> np.ndarray:
        """Per row of distances, which cells are the nearest ones that hold ``n`` candidates together."""
        order = np.argsort(far, axis=1, kind="stable")
        before = np.cumsum(self.sizes[order], axis=1) - self.sizes[order]
        out = np.zeros(far.shape, bool)
        np.put_along_axis(out, order, before < n, axis=1)
        return out

    def bounds(self, far: np.ndarray) -> np.ndarray:
        """Least possible distance of a cell's candidates to each row."""
        own = far.argmin(axis=1)
        near = far[np.arange(len(far)), own]
        gap = self.between[own]
        with np.errstate(divide="ignore", invalid="ignore"):
            plane = np.where(gap > 0, (far ** 2 - near[:, None] ** 2) / (2 * gap), 0.0)
        ball = far - self.radius
        out = np.maximum(np.maximum(plane, ball), 0.0)
        return out - SLACK * (far + near[:, None] + self.radius)


def _vectors(col: pa.Array | pa.ChunkedArray, d: int) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def assign(points: DataFrame, cells: Cells, d: int) -> DataFrame:
    """``(id, v, copy, cell, far)``: each row's nearest pivot (ties: the first) and its distance."""
    shared = points.sparkSession.sparkContext.broadcast(cells)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                far = shared.value.to_pivots(_vectors(batch.column(1), d))
                cell = far.argmin(axis=1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int32()), pa.array(far[np.arange(len(far)), cell])],
                                                 ["id", "v", "copy", "cell", "far"])
    return points.select(F.col(ID).alias("id"), "v", "copy").mapInArrow(run, "id long, v array<double>, copy int, cell int, far double")


def route(queries: DataFrame, cells: Cells, d: int, n: int, first: bool) -> DataFrame:
    """Packs ``(cell, q_ids, q_v, q_bound)`` of the queries ``(id, v, bound)`` that go to each cell.

    The first pass takes the nearest cells with ``n`` candidates; the second one every other cell whose bound is within the
    query's ``bound`` (a distance)."""
    shared = queries.sparkSession.sparkContext.broadcast(cells)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            ids, v, bound = batch.column(0).to_numpy(), _vectors(batch.column(1), d), batch.column(2).to_numpy()
            chunk = max(PACK, FAR_CELLS // len(shared.value.sizes))
            for at in range(0, len(ids), chunk):                 # a table of so many rows by all pivots at a time
                some = slice(at, at + chunk)
                far = shared.value.to_pivots(v[some])
                near = shared.value.nearest_with(far, n)
                go = near if first else ~near & (shared.value.bounds(far) <= bound[some, None]) & (shared.value.sizes > 0)
                c, r = np.nonzero(go.T)                          # by cell
                r += at
                starts = np.flatnonzero(np.r_[True, c[1:] != c[:-1]]) if len(c) else []
                packs = [slice(x, min(x + PACK, end)) for a, end in zip(starts, [*starts[1:], len(c)]) for x in range(a, end, PACK)]
                while packs:                                     # so many packs that a batch stays small
                    size = np.cumsum([(x.stop - x.start) * (d + 2) for x in packs])
                    now = max(1, int(np.searchsorted(size, SENT, "right")))
                    out, packs = packs[:now], packs[now:]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([c[x.start] for x in out], pa.int32()), pa.array([ids[r[x]] for x in out], pa.list_(pa.int64())),
                         pa.array([v[r[x]].ravel() for x in out], pa.list_(pa.float64())),
                         pa.array([bound[r[x]] for x in out], pa.list_(pa.float64()))], ["cell", "q_ids", "q_v", "q_bound"])
    return queries.select("id", "v", "bound").mapInArrow(run, "cell int, q_ids array<long>, q_v array<double>, q_bound array<double>")


def compare(tasks: DataFrame, d: int, n: int) -> DataFrame:
    """``(q_id, nb_id, dist2)``: per query and block the ``n`` nearest candidates by (distance, id) within the query's bound."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                q_ids, q_v, bound, c_ids, c_v = (batch.column(c)[i].values.to_numpy(zero_copy_only=False)
                                                 for c in ("q_ids", "q_v", "q_bound", "c_ids", "c_v"))
                r, j, dist = near_pairs(q_v.reshape(-1, d), c_v.reshape(-1, d), (bound * (1 + SLACK)) ** 2, n)
                order = np.lexsort((c_ids[j], dist, r))
                r, j, dist = r[order], j[order], dist[order]
                first = np.searchsorted(r, np.arange(len(q_ids)))
                kept = np.arange(len(r)) - first[r] < n
                r, j, dist = r[kept], j[kept], dist[kept]
                yield pa.RecordBatch.from_arrays([pa.array(q_ids[r]), pa.array(c_ids[j]), pa.array(dist)], ["q_id", "nb_id", "dist2"])
    return tasks.select("q_ids", "q_v", "q_bound", "c_ids", "c_v").mapInArrow(run, "q_id long, nb_id long, dist2 double")


def _top(found: DataFrame, n: int) -> DataFrame:
    """The ``n`` nearest per query."""
    w = Window.partitionBy("q_id").orderBy("dist2", "nb_id")
    return found.withColumn("place", F.row_number().over(w)).where(F.col("place") <= n)


def _pivots(rows: DataFrame, n: int, d: int, seed: int, cell: int) -> np.ndarray:
    count = int(min(MAX_PIVOTS, max(1, n // cell)))
    picked = rows.orderBy(F.xxhash64(F.lit(seed), "id"), "id").limit(count).select("v").collect()      # MAX_PIVOTS rows at most
    return np.array([r["v"] for r in picked], float).reshape(-1, d)


def nearest_neighbours(points: DataFrame, k: int, seed: int = 42, cell: int = CELL, block: int = BLOCK) -> DataFrame:
    """``(id, k_idx, nb_id, dist2)``: the k nearest other rows of every row of ``points(id, v)``, ordered by (squared distance, id)."""
    ensure_checkpoint_dir(points.sparkSession)
    pts = cut_lineage(points.select(F.col(ID).alias("id"), "v"), "knn-points")
    head = pts.first()
    m = pts.count()                                              # from the file footers
    if m <= k:
        raise ValueError(f"nearest neighbours need more than k={k} rows, got {m}")
    d, n = len(head["v"]), k + 1
    # the limit runs in the map tasks before the shuffle, so a point with many copies is k + 1 rows per task
    copies = Window.partitionBy("v").orderBy("id")
    cand = cut_lineage(pts.withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= n), "knn-candidates")
    single = cand.where("copy = 1")
    n_points = single.count()
    cells = Cells(_pivots(single, n_points, d, seed, cell))
    held = cut_lineage(assign(cand, cells, d), "knn-cells")
    for r in held.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("radius")).collect():     # one row per cell
        cells.sizes[r["cell"]], cells.radius[r["cell"]] = r["n"], r["radius"]
    place = F.row_number().over(Window.partitionBy("cell").orderBy("far", "id")) - 1
    pack = F.array_sort(F.collect_list(F.struct("id", "v")))
    blocks = held.withColumn("b", F.floor(place / block)).groupBy("cell", "b").agg(pack.alias("p"))     # ``block`` rows at most
    blocks = cut_lineage(blocks.select("cell", F.col("p.id").alias("c_ids"), F.flatten("p.v").alias("c_v")), "knn-blocks")
    # queries side by side in their cells' order: a pack then holds many that go to the same cell
    place_of = held.where("copy = 1").drop("copy")
    tasks = 1 + n_points // TASK_ROWS

    def by_cell(queries: DataFrame) -> DataFrame:
        return queries.repartitionByRange(tasks, "cell", "far", "id").sortWithinPartitions("cell", "far", "id")
    one = by_cell(place_of.withColumn("bound", F.lit(float("inf"))))
    near = cut_lineage(_top(compare(route(one, cells, d, n, True).join(blocks, "cell"), d, n), n), "knn-near")
    bound = near.groupBy("q_id").agg(F.sqrt(F.max(F.when(F.col("place") == n, F.col("dist2")))).alias("bound"))
    again = by_cell(place_of.join(bound, place_of["id"] == bound["q_id"])
                    .select("id", "v", "cell", "far", F.coalesce("bound", F.lit(float("inf"))).alias("bound")))
    more = compare(route(again, cells, d, n, False).join(blocks, "cell"), d, n)
    best = cut_lineage(_top(near.select("q_id", "nb_id", "dist2").unionByName(more), n), "knn-best")
    # every row takes its point's list without itself
    lists = best.groupBy("q_id").agg(F.array_sort(F.collect_list(F.struct("dist2", "nb_id"))).alias("near"))       # k + 1 entries
    named = single.select(F.col("id").alias("s_id"), F.col("v").alias("s_v")).join(lists, F.col("s_id") == F.col("q_id")).select("s_v", "near")
    own = pts.join(named, pts["v"] == named["s_v"]).select("id", F.slice(F.filter("near", lambda x: x["nb_id"] != F.col("id")), 1, k).alias("near"))
    return own.select(F.col("id").alias(ID), F.posexplode("near").alias("p", "x")) \
        .select(ID, (F.col("p") + 1).alias("k_idx"), F.col("x.nb_id").alias("nb_id"), F.col("x.dist2").alias("dist2"))
