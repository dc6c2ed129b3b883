"""N-gram Jaccard self-join by MinHash banding.

Texts are sets of 5-word shingles (words as in ``common.byte_words``; a shorter text is one shingle).  Documents with
equal sets are first merged to one node with a count of copies.  ``bands_for`` picks the band and row counts for the
target recall at the threshold.  Band hashes are shuffled; a bucket's nodes are linked to its least node only, never
to each other, and the connected groups of these stars hold every candidate pair.  Inside a group the full shingle
sets decide:

* up to ``BLOCK`` nodes: all pairs at once, as one blocked incidence-matrix product in numpy;
* more: each node's exact distance to the group's least node (the pivot) is computed.  Jaccard distance is a metric,
  so two nodes with distances d and e to the pivot are surely linked if d + e <= 1 - t and surely not if |d - e| > 1 - t.
  Nodes are put in bins of distance; sure bin pairs are counted from a histogram, and only the others are verified, in
  blocks of at most about ``BLOCK`` nodes on either side.

So a large group of near copies neither meets in one task nor makes rows for its pairs, and no candidate is dropped.
Verified links give the classes (connected components) and each document's number of linked documents.

Null and empty texts have no shingles, no links and a class of their own.  Rows equal in doc_id and text are copies of
each other.  Classes are named by their least doc_id (null first).  Other columns are ignored (``keep_one`` carries them).
"""
from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_words, doc_key, id_and_text, mix64, same_doc, shingle_set, whole_row, written
from .components import components

NGRAM, THRESHOLD, RECALL = 5, 0.8, 0.999
MAX_HASHES = 128
BLOCK = 256
BIN = 0.005


def bands_for(threshold: float = THRESHOLD, recall: float = RECALL, max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows per band (fewest false candidates) that reach ``recall`` at ``threshold`` within
    ``max_hashes`` hash functions."""
    best = (1, 1)
    for rows in range(1, max_hashes + 1):
        hit = threshold ** rows
        bands = 1 if hit >= recall else math.ceil(math.log(1 - recall) / math.log(1 - hit))
        if bands * rows <= max_hashes:
            best = (bands, rows)
    return best


def band_hashes(shingles: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit hash per band of the MinHash signature."""
    mult = mix64(np.arange(1, bands * rows + 1, dtype=np.uint64)) | np.uint64(1)
    low = np.full(bands * rows, np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(shingles), 4096):
            low = np.minimum(low, (shingles[at:at + 4096, None] * mult).min(axis=0))
        out = np.arange(bands, dtype=np.uint64)
        for r in range(rows):
            out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + low.reshape(bands, rows)[:, r])
    return out


def signatures(docs: DataFrame, bands: int, rows: int, ngram: int = NGRAM) -> DataFrame:
    """``(doc_id, k, n, s1, s2, bands)``: set size, 128-bit digest of the set and its band hashes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        for batch in batches:
            n, s1, s2, bs = [], [], [], []
            for text in batch.column(2).cast(pa.binary()).to_pylist():
                s = shingle_set(byte_words(text), ngram)
                d = np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64)
                n.append(len(s))
                s1.append(int(d[0]))
                s2.append(int(d[1]))
                bs.append(band_hashes(s, bands, rows).view(np.int64) if len(s) else [])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64()),
                                              pa.array(s1, pa.int64()), pa.array(s2, pa.int64()),
                                              pa.array(bs, pa.list_(pa.int64()))],
                                             ["doc_id", "k", "n", "s1", "s2", "bands"])
    return id_and_text(docs).select("doc_id", doc_key(), "text").mapInArrow(
        run, "doc_id long, k long, n long, s1 long, s2 long, bands array<long>")


def _shingles(docs: DataFrame, members: DataFrame, ngram: int) -> DataFrame:
    """``members`` with ``sh``, the sorted shingle hashes of their documents as bytes."""
    texts = id_and_text(docs).withColumn("k", doc_key())
    wanted = members.select(F.col("node.doc_id").alias("doc_id"), F.col("node.k").alias("k"), "node", "pivot", "size",
                            "n", "copies")
    rows = texts.join(wanted, same_doc(texts, wanted)).select("node", "pivot", "size", "n", "copies", "text")

    def run(batches):
        for batch in batches:
            sh = [shingle_set(byte_words(t), ngram).tobytes() for t in batch.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sh, pa.binary())], [*batch.schema.names[:5], "sh"])
    node = "struct<doc_id: long, k: long>"
    out = rows.mapInArrow(run, f"node {node}, pivot {node}, size long, n long, copies long, sh binary")
    return out.dropDuplicates(["node"])      # a node's document may stand in several equal rows


def common_counts(sets: list[np.ndarray], chunk: int = 1 << 14) -> np.ndarray:
    """Matrix of intersection sizes; works on ``chunk`` shingles at a time, those of one set only left out."""
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, cols, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = counts > 1
    new = np.cumsum(shared) - 1
    keep = shared[cols]
    rows, cols = rows[keep], new[cols[keep]]
    out = np.zeros((len(sets), len(sets)), np.float64)
    order = np.argsort(cols, kind="stable")
    rows, cols = rows[order], cols[order]
    for at in range(0, int(shared.sum()), chunk):
        a, b = np.searchsorted(cols, [at, at + chunk])
        x = np.zeros((len(sets), chunk), np.float32)
        x[rows[a:b], cols[a:b] - at] = 1
        out += x @ x.T
    return out


def _verify(threshold: float):
    """Rows sorted by block pair -> (node, links, to): documents linked to the node in this block pair, and the least
    node that it is connected with there."""
    schema = pa.schema([("doc_id", pa.int64()), ("k", pa.int64()), ("links", pa.int64()), ("to_doc_id", pa.int64()),
                        ("to_k", pa.int64())])

    def group(rows: list[dict]) -> pa.RecordBatch:
        sets = [np.frombuffer(r["sh"], np.uint64) for r in rows]
        n = np.array([len(s) for s in sets])
        inter = common_counts(sets)
        link = inter >= threshold * (n[:, None] + n - inter) - 1e-9
        np.fill_diagonal(link, False)
        side = np.array([r["side"] for r in rows])
        if side.any():                                   # two blocks: only pairs across them
            link &= side[:, None] != side
        links = link @ np.array([r["copies"] for r in rows], np.int64)
        order = sorted(range(len(rows)), key=lambda i: ((d := rows[i]["doc_id"]) is not None, d or 0, rows[i]["k"]))
        place = np.empty(len(rows), np.int64)
        place[order] = np.arange(len(rows))
        while True:                                      # least place among the linked, until nothing moves
            new = np.minimum(place, np.where(link, place, len(rows)).min(axis=1))
            if (new == place).all():
                break
            place = new
        to = [rows[order[p]] for p in place]
        return pa.RecordBatch.from_arrays(
            [pa.array([r["doc_id"] for r in rows], pa.int64()), pa.array([r["k"] for r in rows], pa.int64()),
             pa.array(links, pa.int64()), pa.array([r["doc_id"] for r in to], pa.int64()),
             pa.array([r["k"] for r in to], pa.int64())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if held and row["pair"] != held[0]["pair"]:
                    yield group(held)
                    held = []
                held.append(row)
        if held:
            yield group(held)
    return run


def _pivot_distance(members: DataFrame) -> DataFrame:
    """``members`` with ``d``, the exact Jaccard distance to their pivot."""
    pivots = members.filter("node = pivot").select(F.col("pivot").alias("p"), F.col("sh").alias("p_sh"))
    both = members.join(pivots, members["pivot"] == pivots["p"]).select("node", "pivot", "copies", "sh", "p_sh")

    def run(batches):
        for batch in batches:
            d = []
            for a, b in zip(batch.column("sh").to_pylist(), batch.column("p_sh").to_pylist()):
                a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                both = len(np.intersect1d(a, b, assume_unique=True))
                d.append(1 - both / (len(a) + len(b) - both))
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(d, pa.float64())],
                                             [*batch.schema.names[:4], "d"])
    node = "struct<doc_id: long, k: long>"
    return both.mapInArrow(run, f"node {node}, pivot {node}, copies long, sh binary, d double")


def _large_groups(members: DataFrame, threshold: float, block: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """For groups of over ``block`` nodes: (rows of uncertain block pairs, sure links per node, star edges)."""
    far = 1 - threshold
    dist = written(_pivot_distance(members), "distance") \
        .withColumn("bin", F.floor(F.col("d") / BIN).cast("long"))
    hist = written(dist.groupBy("pivot", "bin").agg(F.count(F.lit(1)).alias("nodes"), F.sum("copies").alias("copies")), "bins")
    a, b = hist.alias("a"), hist.alias("b")
    pairs = a.join(b, F.col("a.pivot") == F.col("b.pivot")).select(
        F.col("a.pivot").alias("pivot"), F.col("a.bin").alias("bin"), F.col("b.bin").alias("other"),
        F.col("a.nodes").alias("nodes"), F.col("b.nodes").alias("other_nodes"), F.col("b.copies").alias("copies"))
    sure = (F.col("bin") + F.col("other") + 2) * BIN <= far - 1e-9
    never = (F.abs(F.col("bin") - F.col("other")) - 1) * BIN > far + 1e-9
    # a node's own copies stand in the sum only if its bin is sure with itself
    sums = pairs.filter(sure).groupBy("pivot", "bin").agg(F.sum("copies").alias("sure"), F.max(F.col("bin") == F.col("other")).alias("own"))
    own = F.when(F.col("own"), F.col("copies")).otherwise(0)
    certain = dist.join(sums, ["pivot", "bin"]).select("node", (F.col("sure") - own).alias("links"))
    stars = dist.filter(F.col("d") <= far + 1e-12).select(F.col("node").alias("a"), F.col("pivot").alias("b"))
    # blocks of a bin: by a hash of the node, about `block` nodes each
    subs = lambda n: F.ceil(F.col(n) / block).cast("int")
    open_pairs = pairs.filter(~sure & ~never & (F.col("bin") <= F.col("other")))
    tasks = open_pairs.select("pivot", "bin", "other", F.explode(F.sequence(F.lit(0), subs("nodes") - 1)).alias("i"),
                              subs("nodes").alias("ni"), subs("other_nodes").alias("nj")) \
        .select("*", F.explode(F.sequence(F.lit(0), F.col("nj") - 1)).alias("j")) \
        .filter((F.col("bin") < F.col("other")) | (F.col("i") <= F.col("j")))
    pair = F.struct("pivot", "bin", "other", "i", "j").alias("pair")
    left = tasks.select(pair, "pivot", "bin", F.col("i").alias("sub"), F.col("ni").alias("subs"), F.lit(0).alias("side"))
    right = tasks.filter((F.col("bin") != F.col("other")) | (F.col("i") != F.col("j"))).select(
        pair, "pivot", F.col("other").alias("bin"), F.col("j").alias("sub"), F.col("nj").alias("subs"), F.lit(1).alias("side"))
    roles = left.union(right)
    sub = F.pmod(F.xxhash64("node"), F.col("nodes_subs")).cast("int")
    placed = dist.join(hist.select("pivot", "bin", subs("nodes").alias("nodes_subs")), ["pivot", "bin"]) \
        .select("node", "pivot", "bin", "copies", "sh", sub.alias("sub"))
    rows = placed.join(roles, ["pivot", "bin", "sub"]).select("pair", "side", "node", "copies", "sh")
    return rows, certain, stars


def ngram_classes(docs: DataFrame, threshold: float = THRESHOLD, ngram: int = NGRAM, recall: float = RECALL,
                  block: int = BLOCK) -> DataFrame:
    """``(doc_id, k, class, rep, n_links)`` per row of ``docs``: ``class`` and ``rep`` are structs (doc_id, k), the first
    document of the class and of the documents with the same shingle set; ``n_links`` counts the other documents with
    similarity >= ``threshold``."""
    bands, rows = bands_for(threshold, recall)
    sigs = written(signatures(docs, bands, rows, ngram), "signatures")
    name = F.struct("doc_id", "k")
    nodes = written(sigs.filter("n > 0").groupBy("s1", "s2").agg(
        F.min(name).alias("node"), F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"),
        F.first("bands").alias("bands")), "nodes")

    members = nodes.select("node", F.explode("bands").alias("h"))
    buckets = written(members.groupBy("h").agg(F.min("node").alias("least"), F.count(F.lit(1)).alias("c"))
                      .filter("c > 1").select("h", "least"), "buckets")
    groups = components(members.join(buckets, "h").filter("node != least").select(F.col("node").alias("a"), F.col("least").alias("b")))
    sizes = groups.groupBy("label").agg(F.count(F.lit(1)).alias("size"))
    placed = groups.join(sizes, "label").join(nodes.select("node", "n", "copies"), "node") \
        .select("node", F.col("label").alias("pivot"), "size", "n", "copies")
    sets = written(_shingles(docs, placed, ngram), "shingles")

    small = sets.filter(F.col("size") <= block).select(
        F.struct("pivot", F.lit(0).cast("long").alias("bin"), F.lit(0).cast("long").alias("other"), F.lit(0).alias("i"), F.lit(0).alias("j"))
        .alias("pair"), F.lit(0).alias("side"), "node", "copies", "sh")
    large, certain, stars = _large_groups(sets.filter(F.col("size") > block), threshold, block)
    work = small.unionByName(large).select("pair", F.xxhash64("pair").alias("p"), "side", "node.doc_id", "node.k", "copies", "sh")
    found = written(work.repartition("p").sortWithinPartitions("p", "pair").select("pair", "side", "doc_id", "k", "copies", "sh")
                    .mapInArrow(_verify(threshold), "doc_id long, k long, links long, to_doc_id long, to_k long"), "links")
    edges = found.select(name.alias("a"), F.struct(F.col("to_doc_id").alias("doc_id"), F.col("to_k").alias("k")).alias("b"))
    classes = components(edges.union(stars))
    links = found.select(name.alias("node"), "links").union(certain).groupBy("node").agg(F.sum("links").alias("links"))
    named = nodes.select("s1", "s2", "node", "copies").join(classes.withColumnRenamed("label", "class"), "node", "left") \
        .join(links, "node", "left")
    named = written(named.select("s1", "s2", "node", F.coalesce("class", "node").alias("class"),
                                 (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "classes")
    full = sigs.filter("n > 0").join(named, ["s1", "s2"]).select("doc_id", "k", "class", F.col("node").alias("rep"), "n_links")
    alone = sigs.filter("n = 0").select("doc_id", "k", name.alias("class"), name.alias("rep"), F.lit(0).cast("long").alias("n_links"))
    return full.union(alone)


def ngram_join(docs: DataFrame, **options) -> DataFrame:
    """``(doc_id, class_id, rep_id, n_links)`` per row of ``docs``."""
    return ngram_classes(docs, **options).select("doc_id", F.col("class.doc_id").alias("class_id"),
                                                 F.col("rep.doc_id").alias("rep_id"), "n_links")


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The first document of each class, all columns unchanged; documents without words all stay."""
    first = ngram_classes(docs, **options).filter(F.struct("doc_id", "k") == F.col("class")).select("doc_id", "k").distinct()
    rows = docs.select(whole_row(docs), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.select("row", "doc_id", doc_key())
    return rows.join(first, same_doc(rows, first)).select(rows["row"], rows["doc_id"], rows["k"]) \
        .dropDuplicates(["doc_id", "k"]).select("row.*")
