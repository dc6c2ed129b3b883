"""MinHash near-dedup with an LSH forest.

Texts are sets of distinct 2-word shingles (words ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased; a shorter text is its one shingle).
Documents with equal sets are merged to one node.  Each of ``TREES`` trees orders the nodes by a label, a sequence of
``DEPTH`` MinHash values of the node's set; Spark range-partitions and sorts (tree, label, node), so equal labels split over
tasks like any others.  Neighbours with the longest common prefix stand next to each other.

A region is a run of nodes with a common prefix of ``least`` values (5 in 18 trees find a pair of similarity 0.8 with
probability 0.999).  A region of more than ``REGION`` nodes is cut into the regions of its longer prefixes, as deep as its
density asks for; where even whole labels are equal, into runs of ``REGION``.  Candidates are verified on the full sets, in
three rounds, each of which leaves out what the rounds before it have already connected:

1. the first node of a region with each of the others, and the first nodes of neighbouring regions with a common prefix;
2. all pairs of the regions that hold several components, as one incidence-matrix product;
3. the pairs that the cuts parted, for cut runs (too dense, or lying on a partition's edge) that hold several components:
   the rows outside the run's largest component meet each other and that component, in blocks.  Where these strays are many
   (texts of one template), an exact prefix-filter join takes the run's nodes instead: two sets of similarity t share one of
   the n - ceil(t n) + 1 shingles that come first in any fixed order; taken by rarity, texts of one template share few of
   them.  Its buckets go through the same two steps.

So no candidate is capped: regions only decide which pairs are tried first.  Components are the verified links' ones.

Null and empty texts and texts without words have no shingles, no links and a component of their own.  Rows equal in doc_id and
text are copies of each other; components are named by their least doc_id (null first), and ``kept`` compares with it
null-safely.  Empty tables give no rows.  Other columns are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import doc_key, hash_words, id_and_text, mix64, same_doc, written
from .components import components

NGRAM, PERCENT = 2, 80
TREES, LEAST, DEPTH = 18, 5, 8
REGION = 32
#: Nodes of a run that a task looks at together; a longer run counts as cut.
HELD = 1 << 16
#: ASCII letters lower-cased, ASCII white space to a space; other bytes kept.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else 32 if 9 <= b <= 13 else b for b in range(256))
#: Rows of a side of a matrix product; a cut run with more rows than STRAYS outside its major component goes to the prefix filter.
BLOCK, STRAYS = 256, 1024
NODE = "struct<doc_id: long, k: long>"
#: Set sizes that a matrix product handles at once.
CHUNK = 1 << 13


def shingle_set(text: bytes | None, ngram: int = NGRAM) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles."""
    words = [w for w in text.translate(WORD_BYTES).split(b" ") if w] if text else []
    if not words:
        return np.empty(0, np.uint64)
    h = hash_words(words)
    n = min(ngram, len(h))
    out = np.full(len(h) - n + 1, n, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(n):
            out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + h[i:len(h) - n + 1 + i])
    return np.unique(out)


def linked(both: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Whether sets of sizes ``n`` and ``m`` with ``both`` common elements are similar enough."""
    return (both > 0) & (100 * both >= PERCENT * (n + m - both))


def labels(shingles: np.ndarray, trees: int, depth: int) -> np.ndarray:
    """MinHash values (trees, depth), 16 bits of each."""
    mult = mix64(np.arange(1, trees * depth + 1, dtype=np.uint64)) | np.uint64(1)
    low = np.full(trees * depth, np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(shingles), 2048):
            low = np.minimum(low, (shingles[at:at + 2048, None] * mult).min(axis=0))
    return (mix64(low) >> np.uint64(48)).astype(">u2").reshape(trees, depth)


def signatures(docs: DataFrame, trees: int, depth: int) -> DataFrame:
    """``(doc_id, k, n, s1, s2, labels)``: set size, 128-bit digest of the set and one label per tree."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        for batch in batches:
            n, s1, s2, ls = [], [], [], []
            for text in batch.column(2).cast(pa.binary()).to_pylist():
                s = shingle_set(text)
                d = np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64)
                n.append(len(s))
                s1.append(int(d[0]))
                s2.append(int(d[1]))
                ls.append([row.tobytes() for row in labels(s, trees, depth)] if len(s) else [])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(s1, pa.int64()),
                                              pa.array(s2, pa.int64()), pa.array(ls, pa.list_(pa.binary()))],
                                             ["doc_id", "k", "n", "s1", "s2", "labels"])
    return id_and_text(docs).select("doc_id", doc_key(), "text").mapInArrow(
        run, "doc_id long, k long, n long, s1 long, s2 long, labels array<binary>")


# ---- the forest -------------------------------------------------------------------------------------------------
def cut(run: list[bytes], least: int, region: int) -> list[int]:
    """Where the regions of a sorted run of labels end: each has at most ``region`` labels, and those of a region share as
    short a prefix as that allows."""
    ends: list[int] = []
    stack = [(0, len(run), least)]
    while stack:
        a, b, depth = stack.pop()
        if b - a <= region:
            ends.append(b)
            continue
        if 2 * depth >= len(run[a]):                             # equal labels
            ends += [*range(a + region, b, region), b]
            continue
        parts, at = [], a
        for i in range(a + 1, b + 1):
            if i == b or run[i][:2 * depth + 2] != run[at][:2 * depth + 2]:
                parts.append((at, i, depth + 1))
                at = i
        small: list[tuple[int, int, int]] = []                   # small neighbours stay together
        for p in parts:
            if small and p[1] - small[-1][0] <= region:
                small[-1] = (small[-1][0], p[1], depth + 1)
            else:
                small.append(p)
        stack += reversed(small)
    return ends


def _regions(least: int, region: int):
    """Sorted (tree, label, node) -> one row per node of a region: (run, node, gid, first, before, edge, size)."""
    schema = pa.schema([("run", pa.int64()), ("doc_id", pa.int64()), ("k", pa.int64()), ("gid", pa.int64()), ("first_id", pa.int64()),
                        ("first_k", pa.int64()), ("before_id", pa.int64()), ("before_k", pa.int64()), ("edge", pa.int64()),
                        ("cut", pa.bool_()), ("size", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        import xxhash
        edge = uuid.uuid4().int >> 66                            # names this partition's pieces; only equality counts
        order = lambda x: (x[0] is not None, x[0] or 0, x[1])     # noqa: E731

        def emit(name: bytes, held: list[tuple], at_edge: bool) -> pa.RecordBatch | None:
            if len(held) < 2 and not at_edge:
                return None
            ends = cut([x[0] for x in held], least, region)
            rows, a, before = [], 0, None
            rid = xxhash.xxh64_intdigest(name) - (1 << 63)
            for b in ends:
                part = sorted((x[1:] for x in held[a:b]), key=order)
                gid = xxhash.xxh64_intdigest(repr(part).encode()) - (1 << 63)
                for node in part:
                    link = before if node == part[0] and before else part[0]
                    rows.append((rid, *node, gid, *part[0], *link, edge if at_edge else None, len(ends) > 1, b - a))
                a, before = b, part[0]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

        name, held, at_edge = None, [], True
        for batch in batches:
            for tree, label, doc_id, k in zip(*(c.to_pylist() for c in batch.columns)):
                here = bytes([tree]) + label[:2 * least]
                if here != name or len(held) == HELD:
                    if name is not None and (out := emit(name, held, at_edge or here == name)) is not None:
                        yield out
                    at_edge = name is None or here == name
                    edge += 1
                    name, held = here, []
                held.append((label, doc_id, k))
        if name is not None:
            yield emit(name, held, True)
    return run, "run long, doc_id long, k long, gid long, first_id long, first_k long, before_id long, before_k long, edge long, cut boolean, size long"


def forest(nodes: DataFrame, least: int = LEAST, region: int = REGION) -> DataFrame:
    """``(run, node, gid, first, before, edge, cut, size)`` of the nodes that share a run with others, written."""
    rows = nodes.select(F.posexplode("labels").alias("tree", "label"), "node.doc_id", "node.k")
    keys = ["tree", "label", "doc_id", "k"]
    runner, schema = _regions(least, region)
    found = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(runner, schema)
    struct = lambda a, b: F.struct(F.col(a).alias("doc_id"), F.col(b).alias("k"))     # noqa: E731
    found = written(found.select("run", struct("doc_id", "k").alias("node"), "gid", struct("first_id", "first_k").alias("first"),
                                 struct("before_id", "before_k").alias("before"), "edge", "cut", "size"), "forest")
    # a run on a partition's edge counts as cut only if it goes on in another partition
    many = found.filter("edge IS NOT NULL").groupBy("run").agg(F.min("edge").alias("lo"), F.max("edge").alias("hi"), F.min("node").alias("least")) \
        .filter("lo < hi").select(F.col("run").alias("many_run"), "least")
    both = found.join(many, found["run"] == many["many_run"], "left")
    return both.filter("size > 1 OR least IS NOT NULL OR before != node").select(
        "run", "node", "gid", "first", "before", F.col("least"),
        (F.col("cut") | F.col("least").isNotNull()).alias("cut"), "size")


# ---- verification ----------------------------------------------------------------------------------------------
def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(node, n, sh)``: sorted shingle hashes as bytes of the nodes ``wanted``, written."""
    texts = id_and_text(docs).withColumn("k", doc_key())
    names = wanted.select(F.col("node.doc_id").alias("doc_id"), F.col("node.k").alias("k"))
    rows = texts.join(names, same_doc(texts, names), "left_semi").select("doc_id", "k", "text")

    def run(batches):
        for batch in batches:
            sh = [shingle_set(t).tobytes() for t in batch.column(2).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sh, pa.binary())], ["doc_id", "k", "sh"])
    out = rows.mapInArrow(run, "doc_id long, k long, sh binary").select(F.struct("doc_id", "k").alias("node"), "sh")
    return written(out.dropDuplicates(["node"]), "sets")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The ``(a, b)`` of ``pairs`` that are linked, by their full sets; written."""
    sided = pairs.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    left = sets.select(F.col("node").alias("a"), F.col("sh").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("sh").alias("y"))
    near = F.least(F.length("x"), F.length("y")) * 100 >= F.greatest(F.length("x"), F.length("y")) * PERCENT
    rows = sided.join(left, "a").join(right, "b").filter(near).select("a", "b", "x", "y")

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                keep.append(bool(linked(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y))))
            yield pa.RecordBatch.from_arrays(batch.columns[:2], batch.schema.names[:2]).filter(pa.array(keep, pa.bool_()))
    return written(rows.mapInArrow(run, f"a {NODE}, b {NODE}"), "links")


def common_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Matrix of intersection sizes; shingles of one set only are left out, the others taken ``CHUNK`` at a time."""
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, cols, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    kept = counts[cols] > 1
    cols = (np.cumsum(counts > 1) - 1)[cols[kept]]
    order = np.argsort(cols, kind="stable")
    rows, cols = rows[kept][order], cols[order]
    out = np.zeros((len(sets), len(sets)), np.float64)
    for at in range(0, int((counts > 1).sum()), CHUNK):
        a, b = np.searchsorted(cols, [at, at + CHUNK])
        x = np.zeros((len(sets), CHUNK), np.float32)
        x[rows[a:b], cols[a:b] - at] = 1
        out += x @ x.T
    return out


def _group_links(rows: list[dict]) -> list[tuple[dict, dict]]:
    """Links between the rows of one group that connect different components: a spanning set of them."""
    sets = [np.frombuffer(r["sh"], np.uint64) for r in rows]
    n = np.array([len(s) for s in sets])
    label = [(r["label"]["doc_id"], r["label"]["k"]) for r in rows]
    name = {x: i for i, x in enumerate(dict.fromkeys(label))}
    comp = np.array([name[x] for x in label])
    link = linked(common_counts(sets), n[:, None], n[None, :]) & (comp[:, None] != comp)
    out = []
    for i, j in zip(*np.nonzero(np.triu(link))):
        if comp[i] != comp[j]:
            out.append((rows[i]["node"], rows[j]["node"]))
            comp[comp == comp[j]] = comp[i]
    return out


def _block_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (g, node, label, sh) sorted by group -> links."""
    def out(rows: list[dict]) -> pa.RecordBatch:
        pairs = _group_links(rows)
        node = pa.struct([("doc_id", pa.int64()), ("k", pa.int64())])
        return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], node) for i in (0, 1)], ["a", "b"])
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and row["g"] != held[0]["g"]:
                yield out(held)
                held = []
            held.append(row)
    if held:
        yield out(held)


def _labelled(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """``rows`` with ``label``, the component of their node so far."""
    return rows.join(classes, "node", "left").withColumn("label", F.coalesce("label", "node"))


def _joined(known: DataFrame, links: DataFrame) -> DataFrame:
    """``known(node, label)`` after further ``links(a, b)``, written: only the links' labels make the graph, not the nodes."""
    if links.isEmpty():
        return known
    ends = links
    for side in ("a", "b"):
        named = known.select(F.col("node").alias(side), F.col("label").alias(f"of_{side}"))
        ends = ends.join(named, side, "left").withColumn(f"of_{side}", F.coalesce(f"of_{side}", side))
    ends = written(ends, "ends")
    top = components(ends.select(F.col("of_a").alias("a"), F.col("of_b").alias("b"))).toDF("old", "new")
    single = ends.select(F.col("a").alias("node")).union(ends.select("b")).distinct().join(known, "node", "left_anti") \
        .select("node", F.col("node").alias("label"))
    both = known.union(single)
    return written(both.join(top, both["label"] == top["old"], "left").select("node", F.coalesce("new", "label").alias("label")), "known")


def _open(rows: DataFrame, key: str) -> DataFrame:
    """The rows of groups (``key``) that hold several components."""
    groups = rows.groupBy(key).agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("members")) \
        .filter("lo < hi").select(key, "members")
    return rows.join(groups, key)


def _majors(rows: DataFrame, key: str) -> DataFrame:
    """Per group of several components: its component of most rows, their number and that of the other rows, the strays."""
    parts = rows.groupBy(key, "label").agg(F.count(F.lit(1)).alias("c"))
    most = parts.groupBy(key).agg(F.sum("c").alias("total"), F.max(F.struct("c", "label")).alias("m"))
    return most.filter("m.c < total").select(key, F.col("m.label").alias("major"), F.col("m.c").alias("n_major"),
                                             (F.col("total") - F.col("m.c")).alias("n_stray"))


def group_links(rows: DataFrame, sets: DataFrame, key: str, block: int, majors: DataFrame | None = None) -> DataFrame:
    """Links between the components of each group of ``rows(key, node, label)``; written.  A group of over ``block`` rows is
    dealt out in blocks: the strays meet each other and the rows of the major component, which don't meet among themselves."""
    opened = rows.join(_majors(rows, key) if majors is None else majors, key)
    blocks = lambda n: F.ceil(F.col(n) / block).cast("int")                # noqa: E731
    own = lambda n: F.pmod(F.xxhash64("node", F.lit(1)), blocks(n)).cast("int")
    upto = lambda n: F.sequence(F.lit(0), blocks(n) - 1)                   # noqa: E731
    group = lambda kind, i, j: F.struct(F.lit(kind).alias("kind"), i.cast("int").alias("i"), j.cast("int").alias("j"))
    whole = F.array(group("whole", F.lit(0), F.lit(0)))
    stray = F.concat(F.transform(upto("n_major"), lambda j: group("major", own("n_stray"), j)),
                     F.transform(upto("n_stray"), lambda o: group("stray", F.least(own("n_stray"), o), F.greatest(own("n_stray"), o))))
    major = F.transform(upto("n_stray"), lambda i: group("major", i, own("n_major")))
    places = F.when(F.col("n_major") + F.col("n_stray") <= block, whole).when(F.col("label") == F.col("major"), major).otherwise(stray)
    dealt = opened.select(key, "node", "label", F.explode(places).alias("place")).select(F.struct(key, "place").alias("g"), "node", "label")
    work = dealt.join(sets, "node").select(F.xxhash64("g").alias("p"), "g", "node", "label", "sh")
    spread = work.repartition("p").sortWithinPartitions("p", "g").select("g", "node", "label", "sh")
    return written(spread.mapInArrow(_block_links, f"a {NODE}, b {NODE}"), "links")


def prefix_rows(sets: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(sh, node)``: the shingles of each node's prefix by rarity among ``wanted`` that another node also has."""
    def run(batches):
        for batch in batches:
            for node, sh in zip(batch.column(0), batch.column(1).to_pylist()):
                s = np.frombuffer(sh, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([node.as_py()] * len(s), node.type), pa.array(np.full(len(s), len(s))), pa.array(s)],
                                                 ["node", "n", "sh"])
    each = written(sets.join(wanted, "node", "left_semi").select("node", "sh").mapInArrow(run, f"node {NODE}, n long, sh long"), "shingles")
    df = each.groupBy("sh").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    shared = each.join(df, "sh").select("node", "n", "sh", "df")
    per_node = Window.partitionBy("node")
    # shingles of one node only are the rarest: they come first and make no bucket
    ranked = shared.select("*", F.row_number().over(per_node.orderBy("df", "sh")).alias("r"), F.count(F.lit(1)).over(per_node).alias("c"))
    size = F.col("n") - F.ceil(F.col("n") * PERCENT / 100) + 1
    found = ranked.filter(F.col("r") + F.col("n") - F.col("c") <= size).select("sh", "node")
    # many shingles are shared by the same nodes: one bucket of each node set does
    same = found.groupBy("sh").agg(F.count(F.lit(1)).alias("c"), F.sum(F.shiftright(F.xxhash64("node"), 24)).alias("x"),
                                   F.bit_xor(F.xxhash64("node", F.lit(2))).alias("y")) \
        .filter("c > 1").groupBy("c", "x", "y").agg(F.min("sh").alias("sh")).select("sh")
    return found.join(same, "sh")


def near_classes(docs: DataFrame, trees: int = TREES, least: int = LEAST, depth: int = DEPTH, region: int = REGION, strays: int = STRAYS) -> DataFrame:
    """``(doc_id, k, n, class)`` per row of ``docs``; ``class`` is a struct (doc_id, k), the first document of the component."""
    sigs = written(signatures(docs, trees, depth), "signatures")
    name = F.struct("doc_id", "k")
    nodes = written(sigs.filter("n > 0").groupBy("s1", "s2").agg(F.min(name).alias("node"), F.first("labels").alias("labels")), "nodes")
    tree = written(forest(nodes, least, region), "regions")
    sets = _sets(docs, tree.select("node").distinct())
    # round 1: region heads
    heads = tree.select(F.col("node").alias("a"), F.col("first").alias("b")) \
        .union(tree.filter("before != first").select("first", "before")) \
        .union(tree.filter("least IS NOT NULL AND node = first").select("first", "least"))
    known = written(components(verified(heads, sets)), "known")
    # round 2: regions of several components
    members = tree.filter("size > 2").dropDuplicates(["gid", "node"]).select("gid", "node")
    known = _joined(known, group_links(_labelled(members, known), sets, "gid", region))
    # round 3: cut regions of several components
    parted = _labelled(tree.filter("cut").select("run", "node").distinct(), known)
    majors = written(_majors(parted, "run"), "majors")
    if not majors.isEmpty():
        few = F.col("n_stray") <= strays
        parted = written(parted.join(majors.select("run", few.alias("few")), "run"), "parted")
        wanted = written(parted.filter("NOT few").select("node").distinct(), "wanted")
        known = _joined(known, group_links(parted.filter("few").drop("few"), sets, "run", BLOCK, majors.filter(few)))
        if not wanted.isEmpty():
            buckets = written(prefix_rows(sets, wanted), "prefixes")
            opened = written(_open(_labelled(buckets, known), "sh"), "buckets")
            first = opened.groupBy("sh").agg(F.min("node").alias("least"))
            known = _joined(known, verified(opened.join(first, "sh").select(F.col("node").alias("a"), F.col("least").alias("b")), sets))
            rest = opened.filter("members > 2").select("sh", "node")
            known = _joined(known, group_links(_labelled(rest, known), sets, "sh", BLOCK))
    named = nodes.select("s1", "s2", "node").join(known.withColumnRenamed("label", "class"), "node", "left") \
        .select("s1", "s2", F.coalesce("class", "node").alias("class"))
    full = sigs.filter("n > 0").join(named, ["s1", "s2"]).select("doc_id", "k", "n", "class")
    return full.union(sigs.filter("n = 0").select("doc_id", "k", "n", name.alias("class")))


def near_dedup(docs: DataFrame, **options) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` per row of ``docs``."""
    return near_classes(docs, **options).select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("class.doc_id").alias("component_id"),
        F.col("doc_id").eqNullSafe(F.col("class.doc_id")).alias("kept"))
