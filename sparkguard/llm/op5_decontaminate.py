"""Benchmark decontamination: Wu-Manber multi-pattern search over words.

Patterns are the 10-word windows of the benchmark items (an item of 1 to 9 words is one window).  Symbols are words and
a block is two of them (one for one-word patterns).  Patterns of one length L share the tables of Wu and Manber:

* ``shift``: how far the window may move for the block at its end; unknown blocks allow L - 1 words at once;
* ``buckets``: for blocks with shift 0 (some pattern ends in them), its patterns by their first word; only these are
  compared, word by word.

The tables are broadcast only while the benchmark's text is at most ``shard_bytes``, which is checked; a larger one
is split by item into shards of that size, and the documents pass through one shard after the other, with the hit
spans and items so far carried along and the table written in between.  So every item is searched whatever its number.

Null and empty texts have no words.  Equal rows get equal results.  Items with a null id count as the id ``null``.
An empty benchmark hits nothing.  Other columns are carried, whatever their names are.
"""
from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import byte_words, whole_row, written

WINDOW = 10
SHARD_BYTES = 16 << 20


class WuManber:
    """Search for word patterns of one length."""

    def __init__(self, length: int):
        self.length = length
        self.shift: dict[tuple, int] = {}
        self.buckets: dict[tuple, dict[bytes, dict[tuple, set]]] = {}

    def add(self, pattern: tuple, item: str) -> None:
        n = self.length
        block = 2 if n > 1 else 1
        for end in range(block, n + 1):
            key = pattern[end - block:end]
            self.shift[key] = min(n - end, self.shift.get(key, n))
        ends = self.buckets.setdefault(pattern[n - block:], {})
        ends.setdefault(pattern[0], {}).setdefault(pattern, set()).add(item)

    def find(self, words: list[bytes]) -> Iterator[tuple[int, set]]:
        """(first word, items) of each occurrence."""
        n, total = self.length, len(words)
        if total < n:
            return
        shift, buckets = self.shift.get, self.buckets
        if n == 1:
            for i, w in enumerate(words):
                if (w,) in self.shift:
                    yield i, buckets[(w,)][w][(w,)]
            return
        far, i = n - 1, n - 1
        while i < total:
            key = (words[i - 1], words[i])
            step = shift(key, far)
            if step:
                i += step
                continue
            first = i - n + 1
            for pattern, items in buckets[key].get(words[first], {}).items():
                if tuple(words[first:i + 1]) == pattern:
                    yield first, items
            i += 1


def searchers(items: list[tuple], window: int = WINDOW) -> list[WuManber]:
    """One search table per pattern length for ``(item id, text bytes)``."""
    by_length: dict[int, WuManber] = {}
    for item, text in items:
        words = byte_words(text)
        if words:
            n = min(window, len(words))
            table = by_length.setdefault(n, WuManber(n))
            for i in range(len(words) - n + 1):
                table.add(tuple(words[i:i + n]), "null" if item is None else str(item))
    return list(by_length.values())


def _merge(spans: list[tuple[int, int]]) -> list[int]:
    """Disjoint [start, end) spans, flattened."""
    out: list[int] = []
    for a, b in sorted(spans):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


def _search(tables, schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ts = tables.value
        for batch in batches:
            n_words, all_spans, all_items = [], [], []
            old = zip(batch.column("_spans").to_pylist(), batch.column("_items").to_pylist())
            for text, (spans, items) in zip(batch.column("_text").cast(pa.binary()).to_pylist(), old):
                words = byte_words(text)
                found, names = list(zip(spans[::2], spans[1::2])), set(items)
                for t in ts:
                    for first, hit in t.find(words):
                        found.append((first, first + t.length))
                        names |= hit
                n_words.append(len(words))
                all_spans.append(_merge(found) if found else [])
                all_items.append(sorted(names))
            new = {"_n_words": pa.array(n_words, pa.int64()), "_spans": pa.array(all_spans, pa.list_(pa.int64())),
                   "_items": pa.array(all_items, pa.list_(pa.string()))}
            yield pa.RecordBatch.from_arrays([new.get(c, batch.column(c)) for c in schema.names if c in new or c in
                                              batch.schema.names], list(schema.names))
    return run


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                       shard_bytes: int = SHARD_BYTES, carry: Column | None = None) -> DataFrame:
    """``(row, text, n_words, spans, items)`` per row of ``docs``: ``row`` holds all its columns (or ``carry``), ``spans``
    the hit words as flat disjoint [start, end) pairs, ``items`` the sorted ids of the items with occurring windows."""
    sc = docs.sparkSession.sparkContext
    bench = benchmark.select(F.col("item_id").alias("item"), F.col("text").cast("binary").alias("text"))
    total = bench.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    shards = max(1, -(-total // shard_bytes))
    out = docs.select(carry.alias("row") if carry is not None else whole_row(docs),
                      F.col("text").cast("string").alias("_text"),
                      F.lit(0).cast("long").alias("_n_words"), F.array().cast("array<long>").alias("_spans"),
                      F.array().cast("array<string>").alias("_items"))
    schema = out.schema
    for k in range(shards):
        part = bench.filter(F.pmod(F.xxhash64("item", "text"), F.lit(shards)) == k) if shards > 1 else bench
        tables = sc.broadcast(searchers(part.collect(), window))     # at most about shard_bytes of text
        if k:
            out = written(out, "decontam")
        out = out.mapInArrow(_search(tables, schema), schema)
    return out.select("row", F.col("_text").alias("text"), F.col("_n_words").alias("n_words"),
                      F.col("_spans").alias("spans"), F.col("_items").alias("items"))


def contamination_report(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Counts per document: n_words, n_hit, n_items, items_sha256 and contaminated."""
    found = find_contamination(docs, benchmark, carry=F.struct(F.col("doc_id")), **options)
    n_hit = F.expr("aggregate(spans, 0L, (s, x) -> x - s)")    # ends minus starts, as the signs alternate
    return found.select("row.doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256")) \
        .withColumn("contaminated", F.col("n_hit") > 0)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents in which a window occurs, all columns kept."""
    return find_contamination(docs, benchmark, **options).filter(F.size("spans") == 0).select("row.*")
