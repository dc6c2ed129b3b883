"""Second-order gradient boosting over binned rows: leaf-wise or depth-wise trees from cluster-wide histograms.

``bin_features`` writes the training rows once, every feature as a one-byte code between approximate quantiles; all fits read that
table.  ``fit_many`` grows the trees of several fits (parameter sets, left-out folds) side by side: one pass over the rows
computes the gradient, hessian and row sums per (fit, leaf, feature, bin) for all of them.  Map tasks sum their rows, a shuffle
by (fit, leaf) sums the tasks, and what reaches the driver is a few leaves of ``features x bins`` sums, whatever the table's
size.

A tree grows best-first: of all open leaves the one with the largest gain is split next, until ``leaves`` is reached (no limit: the
tree fills up to ``depth``).  A pass looks ahead for every open leaf that the limit may still let split; it sums the smaller
child only, the sibling is its parent less that.  So a tree takes about as many passes as it is deep, and the order of splits is
that of one split at a time.

Rows that fit one task need no pass at all: ``_fit_here`` deals the fits out to tasks that hold the binned rows and grow all their trees
there, one split at a time over the rows of the leaf, with the same sums and hence the same trees.

With gradients g, hessians h, and sums G, H over a leaf the leaf's value is -G / (H + reg_lambda), and a split gains
(G_l^2 / (H_l + reg_lambda) + G_r^2 / (H_r + reg_lambda) - G^2 / (H + reg_lambda)) / 2 - gamma.  The positive weight multiplies g and h
of the positive rows.  Columns are sampled once per tree, rows by a hash of (id, tree).  Sums are taken in whole numbers
(gradients scaled by a power of two), so a fit doesn't depend on the number or order of tasks.

NaN and NULL features go to the right child everywhere.
"""
from __future__ import annotations

import json
import math
import pickle
from collections.abc import Iterator
from dataclasses import asdict, dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import ID, LABEL
from ..session import cut_lineage, drop_table, ensure_checkpoint_dir

BINS = 64
SKETCH_ACCURACY = 2_000
#: Trees whose margins a pass computes anew; then the margins are written with the rows.
SNAPSHOT = 10
#: Above so many rows they are written every second tree: walking trees again in each pass costs more than a write then.
MANY_ROWS = 200_000
#: Up to so many rows a pass runs in ``FEW_TASKS`` tasks at most, whose sums the driver adds up without a shuffle.
FEW_ROWS, FEW_TASKS = 2_000_000, 16
#: Rows that a task sums up at once when it holds a fit's rows; whole-number sums of so many stay below 2^53.
BLOCK_ROWS = 8_192


@dataclass(frozen=True)
class Boosting:
    """Parameters of a fit; ``leaves`` and ``depth`` of 0 set no limit; ``fold`` is the fold left out (-1: none)."""
    rounds: int = 100
    rate: float = 0.1
    leaves: int = 31
    depth: int = 0
    reg_lambda: float = 0.0
    gamma: float = 0.0
    min_rows: int = 20
    min_hessian: float = 1e-3
    columns: float = 1.0
    rows: float = 1.0
    positive_weight: float = 1.0
    start_at_mean: bool = True
    fold: int = -1
    seed: int = 42


#: The defaults that the two libraries' names stand for.
LEAFWISE = Boosting()
SECOND_ORDER = Boosting(rate=0.3, leaves=0, depth=6, reg_lambda=1.0, min_rows=1, min_hessian=1.0, start_at_mean=False)


@dataclass
class Tree:
    """A tree as flat arrays; leaves have feature -1.  ``x <= threshold`` (``code <= bin``) goes left."""
    feature: np.ndarray
    bin: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    gain: np.ndarray

    def leaf_of(self, x: np.ndarray, codes: bool = False) -> np.ndarray:
        own, inner = np.arange(len(self.feature)), self.feature >= 0
        cut, f = self.bin if codes else self.threshold, np.where(inner, self.feature, 0)
        left, right = np.where(inner, self.left, own), np.where(inner, self.right, own)        # leaves lead to themselves
        flat = np.ascontiguousarray(x).ravel()
        first = np.arange(len(x)) * x.shape[1] if x.ndim == 2 else 0
        node, kids = np.zeros(len(x), np.int64), np.concatenate([right, left])
        while inner.take(node).any():
            go_left = flat.take(first + f.take(node)) <= cut.take(node)
            node = kids.take(node + go_left * len(own))
        return node

    def depths(self) -> np.ndarray:
        """Depth of each leaf."""
        depth = np.zeros(len(self.feature), np.int64)
        for i in np.flatnonzero(self.feature >= 0):            # children come after their parent
            depth[self.left[i]] = depth[self.right[i]] = depth[i] + 1
        return depth[self.feature < 0]


class BoostedModel:
    """A fitted ensemble; ``transform`` adds ``probability`` and ``prediction`` to rows with a ``features`` vector."""

    def __init__(self, trees: list[Tree], start: float, n_features: int, params: Boosting) -> None:
        self.trees, self.start, self.n_features, self.params = trees, start, n_features, params

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        for t in self.trees:
            out += t.value[t.leaf_of(x)]
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        model = self

        @F.pandas_udf("double")
        def p1(features):                                      # an Arrow batch of feature arrays
            x = np.array(features.tolist(), float).reshape(len(features), model.n_features)
            import pandas as pd
            return pd.Series(1 / (1 + np.exp(-model.margin(x))))
        p = df.withColumn("_p1", p1(vector_to_array("features")))
        return p.withColumns({"probability": array_to_vector(F.array(1 - F.col("_p1"), F.col("_p1"))),
                              "prediction": (F.col("_p1") > 0.5).cast("double")}).drop("_p1")

    @property
    def featureImportances(self) -> DenseVector:               # the name that pyspark.ml's tree models use
        gains = np.zeros(self.n_features)
        for t in self.trees:
            np.add.at(gains, t.feature[t.feature >= 0], t.gain[t.feature >= 0])
        return DenseVector(gains / gains.sum() if gains.sum() else gains)

    def save(self, spark: SparkSession, path: str) -> None:
        """``metadata`` as JSON lines beside ``trees`` as Parquet, one row per node."""
        head = {"class": f"{type(self).__module__}.{type(self).__name__}", "start": self.start, "n_features": self.n_features,
                "params": asdict(self.params)}
        spark.createDataFrame([(json.dumps(head),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/metadata")
        rows = [(k, i, *(a[i].item() for a in (t.feature, t.bin, t.threshold, t.left, t.right, t.value, t.gain)))
                for k, t in enumerate(self.trees) for i in range(len(t.feature))]
        schema = "tree int, node int, feature long, bin long, threshold double, left long, right long, value double, gain double"
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/trees")

    @classmethod
    def load(cls, path: str) -> BoostedModel:
        spark = SparkSession.getActiveSession()
        head = json.loads(spark.read.text(f"{path}/metadata").first()["value"])
        nodes = spark.read.parquet(f"{path}/trees").toPandas().sort_values(["tree", "node"])
        trees = [Tree(*(g[c].to_numpy() for c in ("feature", "bin", "threshold", "left", "right", "value", "gain")))
                 for _, g in nodes.groupby("tree")]
        return cls(trees, head["start"], head["n_features"], Boosting(**head["params"]))


# ---- binned rows ------------------------------------------------------------------------------------------------
@dataclass
class Binned:
    """The written training rows ``(id, y, fold, codes)`` and the features' edges."""
    rows: DataFrame
    edges: list[np.ndarray]
    features: list[str]


def feature_edges(df: DataFrame, features: list[str], bins: int = BINS) -> list[np.ndarray]:
    """Distinct approximate quantiles of each feature, ``bins - 1`` at most; one scan."""
    probs = [i / bins for i in range(1, bins)]
    clean = [F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in features]
    row = df.agg(*[F.percentile_approx(c, probs, SKETCH_ACCURACY).alias(f"q{i}") for i, c in enumerate(clean)]).first()
    return [np.unique(np.array(row[f"q{i}"] or [], float)) for i in range(len(features))]


def bin_features(df: DataFrame, features: list[str], label: str = LABEL, key: str = ID, bins: int = BINS,
                 fold: str | None = None, edges: list[np.ndarray] | None = None) -> Binned:
    """Write ``df`` as byte codes; code c of a feature means that c edges are below the value (missing: above all)."""
    if bins > 256:
        raise ValueError("codes are bytes: at most 256 bins")
    ensure_checkpoint_dir(df.sparkSession)
    edges = edges or feature_edges(df, features, bins)
    d = len(features)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.empty((len(batch), d), np.uint8)
            for f in range(d):
                x = batch.column(3 + f).to_numpy(zero_copy_only=False).astype(float)      # nulls become NaN, which sorts last
                codes[:, f] = np.searchsorted(edges[f], x)
                codes[np.isnan(x), f] = len(edges[f])
            packed = pa.Array.from_buffers(pa.binary(d), len(batch), [None, pa.py_buffer(codes.tobytes())]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], packed], ["id", "y", "fold", "codes"])
    cols = [F.col(key).cast("long").alias("id"), F.col(label).cast("int").alias("y"),
            (F.col(fold) if fold else F.lit(-2)).cast("int").alias("fold")]
    vals = [F.col(c).cast("double").alias(f"f{i}") for i, c in enumerate(features)]
    rows = df.where(F.col(label).isNotNull()).select(*cols, *vals).mapInArrow(run, "id long, y int, fold int, codes binary")
    return Binned(cut_lineage(rows, "binned"), edges, features)


def _fixed(col: pa.Array, dtype: type) -> np.ndarray:
    """The values of a binary column of equal lengths without NULL, one row each; a view of Arrow's buffer."""
    ends = np.frombuffer(col.buffers()[1], np.int32)[col.offset:col.offset + len(col) + 1]
    return np.frombuffer(col.buffers()[2], np.uint8)[ends[0]:ends[-1]].view(dtype).reshape(len(col), -1)


def _uniform(ids: np.ndarray, seed: int) -> np.ndarray:
    """A hash of each id in [0, 1)."""
    with np.errstate(over="ignore"):
        x = ids.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
        for shift, mult in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(mult)
        return (x ^ (x >> np.uint64(31))) / 2.0 ** 64


# ---- one fit's growing tree --------------------------------------------------------------------------------------
class Growth:
    """The tree that a fit grows at present: open leaves with their sums and best splits."""

    def __init__(self, params: Boosting, number: int, n_features: int, bins: int, look_ahead: bool = True) -> None:
        self.p, self.number, self.look_ahead = params, number, look_ahead
        self.nodes = [[-1, 0, -1, -1, 0.0]]                       # feature, bin, left, right, gain
        self.depth, self.sums, self.best, self.ahead = [0], {}, {}, {}
        n = max(1, round(params.columns * n_features))
        some = np.random.default_rng((params.seed, number)).choice(n_features, n, replace=False)
        self.used = np.zeros((n_features, bins), bool)
        self.used[some] = True
        self.used[:, -1] = False                                  # nothing lies above the last bin
        self.wanted: list[tuple[int, bool]] = [(0, True)]         # (leaf, whether its left child is the smaller one)

    def split_of(self, sums: np.ndarray) -> tuple[float, int, int, bool] | None:
        """(gain, feature, bin, left is smaller) of the best split of a leaf; ties: first feature, first bin."""
        p, low = self.p, np.cumsum(sums, axis=1)
        total = low[0, -1]
        high = total - low
        with np.errstate(divide="ignore", invalid="ignore"):
            score = lambda s: s[..., 0] ** 2 / (s[..., 1] + p.reg_lambda)     # noqa: E731
            gain = 0.5 * (score(low) + score(high) - score(total)) - p.gamma
        ok = self.used & (low[..., 2] >= p.min_rows) & (high[..., 2] >= p.min_rows) & (low[..., 1] >= p.min_hessian) & (high[..., 1] >= p.min_hessian)
        gain = np.where(ok & np.isfinite(gain), gain, -np.inf)
        f, t = np.unravel_index(gain.argmax(), gain.shape)
        return (float(gain[f, t]), int(f), int(t), bool(low[f, t, 2] <= high[f, t, 2])) if gain[f, t] > 1e-12 else None

    def open(self, leaf: int, sums: np.ndarray) -> None:
        self.sums[leaf] = sums
        found = self.split_of(sums) if not self.p.depth or self.depth[leaf] < self.p.depth else None
        if found:
            self.best[leaf] = found

    def take(self, got: dict[int, np.ndarray], empty: np.ndarray) -> None:
        """Sums of the wanted children (of the root: its own); then split as far as they tell."""
        if not self.sums:
            self.open(0, got.get(0, empty))
        else:
            for slot, (leaf, left_small) in enumerate(self.wanted):
                small = got.get(slot, empty)
                other = self.sums[leaf] - small
                self.ahead[leaf] = (small, other) if left_small else (other, small)
        self.wanted = []
        while self.best:
            room = (self.p.leaves or 1 << 30) - (len(self.nodes) + 1) // 2
            if room <= 0:
                return
            order = sorted(self.best, key=lambda leaf: (-self.best[leaf][0], leaf))
            leaf = order[0]
            if leaf not in self.ahead:
                self.wanted = [(x, self.best[x][3]) for x in order[:room if self.look_ahead else 1] if x not in self.ahead]
                return
            gain, f, t, _ = self.best.pop(leaf)
            kids = len(self.nodes), len(self.nodes) + 1
            self.nodes[leaf] = [f, t, *kids, gain]
            for kid, sums in zip(kids, self.ahead.pop(leaf)):
                self.nodes.append([-1, 0, -1, -1, 0.0])
                self.depth.append(self.depth[leaf] + 1)
                self.open(kid, sums)
            del self.sums[leaf]

    def tree(self, edges: list[np.ndarray]) -> Tree:
        f, t, left, right, gain = (np.array(c) for c in zip(*self.nodes))
        value = np.zeros(len(f))
        for leaf, sums in self.sums.items():
            g, h, _ = sums[0].sum(axis=0)
            value[leaf] = -self.p.rate * g / (h + self.p.reg_lambda) if h + self.p.reg_lambda > 0 else 0.0
        cuts = np.array([edges[a][b] if a >= 0 and b < len(edges[a]) else np.inf for a, b in zip(f, t)])
        return Tree(f, t, cuts, left, right, value, gain)


def _route_arrays(g: Growth) -> tuple:
    """(current tree by codes, slot of each wanted leaf, its split) for the tasks."""
    f, t, left, right, _ = (np.array(c) for c in zip(*g.nodes))
    flat = Tree(f, t, t.astype(float), left, right, np.zeros(len(f)), np.zeros(len(f)))
    slot, by, at, low = np.full(len(f), -1), np.zeros(len(f), np.int64), np.zeros(len(f), np.int64), np.zeros(len(f), bool)
    root = not g.sums
    for i, (leaf, left_small) in enumerate(g.wanted):
        slot[leaf] = i
        if not root:
            by[leaf], at[leaf], low[leaf] = g.best[leaf][1], g.best[leaf][2], left_small
    return flat, slot, by, at, low, root


def _pass(state: DataFrame, fits: list[tuple], d: int, bins: int, scale: float, parts: int) -> dict[int, dict[int, np.ndarray]]:
    """One scan: {fit: {slot: sums (features, bins, 3)}} of the wanted children of all ``fits``
    (fit index, params, tree number, trees since the snapshot, route arrays)."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            if not len(batch):
                continue
            ids, y, fold = (batch.column(i).to_numpy() for i in range(3))
            codes = _fixed(batch.column(3), np.uint8)
            margins = _fixed(batch.column(4), np.float64)
            by_feature = np.ascontiguousarray(codes.T)
            for fit, p, number, trees, (flat, slot, by, at, low, root) in fits:
                use = fold != p.fold
                if p.rows < 1:
                    use &= _uniform(ids, p.seed * 100_003 + number) < p.rows
                rows = np.flatnonzero(use)
                node = flat.leaf_of(codes[rows], codes=True)
                s = slot[node]
                keep = s >= 0
                if not root:
                    keep &= (codes[rows, by[node]] <= at[node]) == low[node]
                rows, s = rows[keep], s[keep]
                if not len(rows):
                    continue
                x = codes[rows]
                m = margins[rows, fit].copy()
                for t in trees:
                    m += t.value[t.leaf_of(x, codes=True)]
                prob = 1 / (1 + np.exp(-m))
                w = np.where(y[rows] == 1, p.positive_weight, 1.0)
                g, h = np.rint(scale * w * (prob - y[rows])), np.rint(scale * w * prob * (1 - prob))
                slots = int(s.max()) + 1
                found, first, n = np.empty((slots, d, bins, 3), np.int64), s * bins, slots * bins
                for f in range(d):                                 # a feature's sums of all slots fit the cache
                    cells = first + by_feature[f].take(rows)
                    for j, v in enumerate((g, h, None)):
                        found[:, f, :, j] = np.bincount(cells, v, n).reshape(slots, bins)
                for i in np.unique(s):
                    key = (fit, int(i))
                    total[key] = total[key] + found[i] if key in total else found[i]
        if total:
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in total], pa.int32()), pa.array([k[1] for k in total], pa.int32()),
                                              pa.array([v.tobytes() for v in total.values()], pa.binary())], ["fit", "slot", "sums"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for fit, slot, raw in zip(*(c.to_pylist() for c in batch.columns)):
                v = np.frombuffer(raw, np.int64)
                total[fit, slot] = total[fit, slot] + v if (fit, slot) in total else v
        if total:
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in total], pa.int32()), pa.array([k[1] for k in total], pa.int32()),
                                              pa.array([v.tobytes() for v in total.values()], pa.binary())], ["fit", "slot", "sums"])
    schema = "fit int, slot int, sums binary"
    rows = state.select("id", "y", "fold", "codes", "margins")
    found = rows.mapInArrow(sums, schema).repartition(parts, "fit", "slot").mapInArrow(merge, schema) if parts else \
        rows.coalesce(FEW_TASKS).mapInArrow(sums, schema)
    out: dict[int, dict[int, np.ndarray]] = {}
    for r in found.collect():                                      # a few leaves per fit
        v = np.frombuffer(r["sums"], np.int64).reshape(d, bins, 3)
        slots = out.setdefault(r["fit"], {})
        slots[r["slot"]] = slots[r["slot"]] + v if r["slot"] in slots else v
    return {fit: {i: v / np.array([scale, scale, 1.0]) for i, v in slots.items()} for fit, slots in out.items()}


def _with_margins(rows: DataFrame, starts: list[float]) -> DataFrame:
    return rows.select("id", "y", "fold", "codes", F.lit(bytearray(np.array(starts, np.float64).tobytes())).alias("margins"))


def _advance(state: DataFrame, trees: list[list[Tree]], d: int) -> DataFrame:
    """``state`` with the margins of the given trees added, written."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            codes = _fixed(batch.column(3), np.uint8)
            margins = _fixed(batch.column(4), np.float64).copy()
            for fit, some in enumerate(trees):
                for t in some:
                    margins[:, fit] += t.value[t.leaf_of(codes, codes=True)]
            ends = np.arange(len(batch) + 1, dtype=np.int32) * margins.shape[1] * 8
            packed = pa.Array.from_buffers(pa.binary(), len(batch), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(margins))])
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], packed], batch.schema.names)
    return cut_lineage(state.mapInArrow(run, state.schema), "margins")


class HeldRows:
    """Binned rows that one task holds: about 45 bytes a row, and 40 more while a fit runs."""

    def __init__(self, batches: Iterator[pa.RecordBatch], d: int, bins: int, edges: list[np.ndarray]) -> None:
        parts = [(*(b.column(i).to_numpy() for i in range(3)), _fixed(b.column(3), np.uint8)) for b in batches if len(b)]
        none = (np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros((0, d), np.uint8))
        self.ids, self.y, self.fold, self.codes = (np.concatenate(c) for c in zip(*(parts or [none])))
        self.d, self.bins, self.edges = d, bins, edges

    def sums(self, rows: np.ndarray, g: np.ndarray, h: np.ndarray, scale: float) -> np.ndarray:
        """The sums (features, bins, 3) of the given rows, added up in whole numbers."""
        out = np.zeros((self.d, 3, self.bins), np.int64)
        for at in range(0, len(rows), BLOCK_ROWS):
            some = rows[at:at + BLOCK_ROWS]
            x, gs, hs = self.codes[some].T.astype(np.intp), g[some], h[some]
            for f in range(self.d):
                for j, v in enumerate((gs, hs, None)):
                    out[f, j] += np.bincount(x[f], v, self.bins).astype(np.int64)
        return np.ascontiguousarray(out.transpose(0, 2, 1)) / np.array([scale, scale, 1.0])

    def trees(self, p: Boosting, start: float, scale: float) -> list[Tree]:
        """All trees of a fit."""
        done: list[Tree] = []
        margin, weight = np.full(len(self.y), start), np.where(self.y == 1, p.positive_weight, 1.0)
        in_fold, empty = self.fold != p.fold, np.zeros((self.d, self.bins, 3))
        for number in range(p.rounds):
            use = in_fold & (_uniform(self.ids, p.seed * 100_003 + number) < p.rows) if p.rows < 1 else in_fold
            prob = 1 / (1 + np.exp(-margin))
            g, h = np.rint(scale * weight * (prob - self.y)), np.rint(scale * weight * prob * (1 - prob))
            tree = Growth(p, number, self.d, self.bins, look_ahead=False)
            held, halves = {0: np.flatnonzero(use)}, {}            # open leaves' rows; those of the children of leaves looked ahead
            while tree.wanted:
                got = {}
                for slot, (leaf, left_small) in enumerate(tree.wanted):
                    rows = held[leaf]
                    if tree.sums:
                        low = self.codes[rows, tree.best[leaf][1]] <= tree.best[leaf][2]
                        halves[leaf] = rows[low], rows[~low]
                        rows = halves[leaf][0 if left_small else 1]
                    got[slot] = self.sums(rows, g, h, scale)
                tree.take(got, empty)
                for leaf in [x for x in halves if tree.nodes[x][0] >= 0]:
                    held[tree.nodes[leaf][2]], held[tree.nodes[leaf][3]] = halves.pop(leaf)
                    del held[leaf]
            done.append(tree.tree(self.edges))
            for leaf, rows in held.items():
                margin[rows] += done[-1].value[leaf]
            if p.rows < 1:                                         # rows that the tree didn't see
                rest = np.flatnonzero(in_fold & ~use)
                margin[rest] += done[-1].value[done[-1].leaf_of(self.codes[rest], codes=True)]
        return done


def _fit_here(binned: Binned, fits: list[Boosting], starts: list[float], scale: float, d: int, bins: int) -> list[list[Tree]]:
    """The trees of each fit; every task holds all rows and grows its share of the fits."""
    rows, edges = binned.rows.select("id", "y", "fold", "codes"), binned.edges
    groups = max(1, min(len(fits), rows.sparkSession.sparkContext.defaultParallelism))
    order = sorted(range(len(fits)), key=lambda i: -fits[i].rounds)          # long fits are spread

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        held = HeldRows(batches, d, bins, edges)
        for i in order[TaskContext.get().partitionId()::groups]:
            found = [tuple(vars(t).values()) for t in held.trees(fits[i], starts[i], scale)]
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([pickle.dumps(found)], pa.binary())], ["fit", "trees"])
    every = rows.withColumn("_group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    dealt = every.repartitionById(groups, "_group").select("id", "y", "fold", "codes")
    by = {r["fit"]: pickle.loads(r["trees"]) for r in dealt.mapInArrow(run, "fit int, trees binary").collect()}       # models, not rows
    none = HeldRows(iter(()), d, bins, edges)                      # no task runs without rows
    return [[Tree(*t) for t in by[i]] if i in by else none.trees(p, starts[i], scale) for i, p in enumerate(fits)]


def fit_many(binned: Binned, fits: list[Boosting]) -> list[BoostedModel]:
    """The models of several parameter sets over the same binned rows, grown side by side."""
    d, bins = len(binned.features), max(len(e) for e in binned.edges) + 1
    counts = binned.rows.groupBy("fold", "y").agg(F.count(F.lit(1)).alias("n")).collect()        # folds x classes
    n = sum(r["n"] for r in counts)
    heavy = max([1.0, *(p.positive_weight for p in fits)])
    # sums of all rows stay below 2^62, those of one Arrow batch below 2^53
    scale = 2.0 ** min(36, 62 - math.ceil(math.log2(max(n, 2) * heavy)))
    starts = []
    for p in fits:
        pos = sum(r["n"] * p.positive_weight for r in counts if r["y"] == 1 and r["fold"] != p.fold)
        neg = sum(r["n"] for r in counts if r["y"] != 1 and r["fold"] != p.fold)
        starts.append(math.log(pos / neg) if p.start_at_mean and pos and neg else 0.0)
    if n <= min(FEW_ROWS, 10 * MANY_ROWS):
        return [BoostedModel(t, s, d, p) for t, s, p in zip(_fit_here(binned, fits, starts, scale, d, bins), starts, fits)]
    empty = np.zeros((d, bins, 3))
    state, done = _with_margins(binned.rows, starts), [[] for _ in fits]
    since: list[list[Tree]] = [[] for _ in fits]
    spark = binned.rows.sparkSession
    parts = 0 if n <= FEW_ROWS else max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * len(fits)))
    every = SNAPSHOT if n <= MANY_ROWS else min(SNAPSHOT, 2)
    for number in range(max(p.rounds for p in fits)):
        growing = {i: Growth(p, number, d, bins) for i, p in enumerate(fits) if number < p.rounds}
        while waiting := {i: g for i, g in growing.items() if g.wanted}:
            sent = [(i, g.p, number, since[i], _route_arrays(g)) for i, g in waiting.items()]
            got = _pass(state, sent, d, bins, scale, parts)
            for i, g in waiting.items():
                g.take(got.get(i, {}), empty)
        for i, g in growing.items():
            tree = g.tree(binned.edges)
            done[i].append(tree)
            since[i].append(tree)
        if (number + 1) % every == 0:
            old, state, since = state, _advance(state, since, d), [[] for _ in fits]
            if number >= every:                                    # the first state reads the caller's table
                drop_table(old)
    if max(p.rounds for p in fits) >= every:
        drop_table(state)
    return [BoostedModel(t, s, d, p) for t, s, p in zip(done, starts, fits)]


def fold_f1(binned: Binned, models: list[BoostedModel]) -> list[float]:
    """F1 of class 1 of each model on the fold that its fit left out (all folds if none was); 0 without a positive."""
    d = len(binned.features)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(models), 3), np.int64)              # true positives, predicted, positives
        for batch in batches:
            if not len(batch):
                continue
            y, fold = batch.column(1).to_numpy() == 1, batch.column(2).to_numpy()
            codes = _fixed(batch.column(3), np.uint8)
            for i, m in enumerate(models):
                rows = np.flatnonzero((fold == m.params.fold) | (m.params.fold < 0))
                margin = np.full(len(rows), m.start)
                for t in m.trees:
                    margin += t.value[t.leaf_of(codes[rows], codes=True)]
                counts[i] += [(y[rows] & (margin > 0)).sum(), (margin > 0).sum(), y[rows].sum()]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(models), dtype=np.int32)), *map(pa.array, counts.T)], ["i", "tp", "pp", "p"])
    found = binned.rows.mapInArrow(run, "i int, tp long, pp long, p long").groupBy("i").agg(*[F.sum(c).alias(c) for c in ("tp", "pp", "p")])
    by = {r["i"]: r for r in found.collect()}                      # one row per model
    return [2 * by[i]["tp"] / (by[i]["pp"] + by[i]["p"]) if i in by and by[i]["pp"] + by[i]["p"] else 0.0 for i in range(len(models))]


def fit(df: DataFrame, features: list[str], params: Boosting, label: str = LABEL, key: str = ID, bins: int = BINS) -> BoostedModel:
    """One model of ``params`` on the rows of ``df``."""
    return fit_many(bin_features(df, features, label, key, bins), [params])[0]


def stump(df: DataFrame, features: list[str], edges: list[np.ndarray], params: Boosting = SECOND_ORDER, label: str = LABEL,
          key: str = ID) -> BoostedModel:
    """One tree of one split between the given edges."""
    binned = bin_features(df, features, label, key, edges=edges)
    return fit_many(binned, [replace(params, rounds=1, depth=1, rate=1.0)])[0]
