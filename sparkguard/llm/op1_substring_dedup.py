"""Substring deduplication over sliding sentence spans.

A sentence ends after ``.``, ``!`` or ``?`` with white space behind it, or at a line feed; pieces keep their white space, so
a text is its pieces joined.  A span is a run of several consecutive sentences: from each sentence forward, and to each
sentence backward, the shortest run of at least ``SENTENCES`` sentences and ``WORDS`` words, or of ``LONG`` words in fewer
sentences.  (Backward runs make sure that a repeated passage is covered up to its last sentence.)  Every span is
hashed (128 bits of its sentences, lower-cased and stripped) and joined globally; its first occurrence by (doc_id, start)
stays, and sentences that any other occurrence covers are removed.

Each input partition first keeps only its own first occurrence of a span; the others can't be first and are
removed at once.  So a span that a third of all documents hold reaches its reducer once per map task.

Null texts are returned as null with no sentences; empty texts are empty.  Null doc_ids come first.  Rows equal in doc_id
and text are the same document and get the same result, so none of them counts as a repeat of the other.  Other
columns are ignored.  An empty table gives an empty result.
"""
from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import doc_key, id_and_text, same_doc

SENTENCES, WORDS, LONG = 3, 12, 40
#: Spans a task remembers to find its own repeats; beyond it the memory starts anew (more rows are shuffled then).
TASK_SPANS = 400_000
END = re.compile(r"[.!?]+\s+|\n\s*")


def sentences(text: str) -> list[str]:
    """The text in pieces that end with their sentence and the white space after it."""
    out, at = [], 0
    for m in END.finditer(text):
        out.append(text[at:m.end()])
        at = m.end()
    if at < len(text):
        out.append(text[at:])
    return out


def runs(words: list[int]) -> list[tuple[int, int]]:
    """The spans [start, end) of a text whose sentences have these numbers of words."""
    total = [0]
    for w in words:
        total.append(total[-1] + w)
    n, out, end, start = len(words), set(), 0, 0

    def enough(i: int, j: int) -> bool:
        size = total[j] - total[i]
        return j > i and (size >= LONG or (j - i >= SENTENCES and size >= WORDS))
    for i in range(n):
        end = max(end, i)
        while end < n and not enough(i, end):
            end += 1
        if not enough(i, end):
            break
        out.add((i, end))
    for j in range(1, n + 1):
        while enough(start + 1, j):
            start += 1
        if enough(start, j):
            out.add((start, j))
    return sorted(out)


def spans(docs: DataFrame, task_spans: int = TASK_SPANS) -> DataFrame:
    """``(doc_id, k, start, stop, h1, h2, first)`` per span; ``first`` is false if the task has already seen the span."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        digest, seen = xxhash.xxh3_128_digest, {}
        for whole in batches:
            for at in range(0, len(whole), 512):
                batch = whole.slice(at, 512)
                ids, keys, start, stop, hashes, known = [], [], [], [], [], []
                for doc, k, text in zip(*(c.to_pylist() for c in batch.columns)):
                    pieces = [p.strip().lower().encode() for p in sentences(text or "")]
                    marks = [digest(p) for p in pieces]
                    for i, j in runs([p.count(b" ") + 1 if p else 0 for p in pieces]):
                        h = digest(b"".join(marks[i:j]))
                        place = (doc is not None, doc or 0, k, i)
                        low = seen.get(h)
                        if low is None:
                            if len(seen) >= task_spans:
                                seen = {}
                            seen[h] = place
                        # spans come in scan order, not in doc_id order: only an earlier one makes this a repeat
                        first = low is None or place < low
                        if low is not None and first:
                            seen[h] = place
                        ids.append(doc)
                        keys.append(k)
                        start.append(i)
                        stop.append(j)
                        hashes.append(h)
                        known.append(first or place == low)
                h = np.frombuffer(b"".join(hashes), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(keys, pa.int64()), pa.array(start, pa.int32()),
                     pa.array(stop, pa.int32()), pa.array(h[:, 0]), pa.array(h[:, 1]), pa.array(known, pa.bool_())],
                    ["doc_id", "k", "start", "stop", "h1", "h2", "first"])
    return id_and_text(docs).select("doc_id", doc_key(), "text").mapInArrow(
        run, "doc_id long, k long, start int, stop int, h1 long, h2 long, first boolean")


def repeated_spans(docs: DataFrame, task_spans: int = TASK_SPANS) -> DataFrame:
    """``(doc_id, k, start, stop)`` of every occurrence of a span but its first."""
    all_spans = spans(docs, task_spans)
    by_span = Window.partitionBy("h1", "h2").orderBy("doc_id", "k", "start")     # one row per span and task at most
    ranked = all_spans.filter("first").withColumn("place", F.dense_rank().over(by_span))
    return ranked.filter("place > 1").select("doc_id", "k", "start", "stop").union(
        all_spans.filter("not first").select("doc_id", "k", "start", "stop"))


def remove_repeats(docs: DataFrame, task_spans: int = TASK_SPANS) -> DataFrame:
    """``(doc_id, text, n_sentences, n_removed, removed)`` per row of ``docs``: the text without repeated sentences and the
    removed sentences as flat disjoint [start, end) pairs."""
    cover = repeated_spans(docs, task_spans).groupBy("doc_id", "k").agg(F.collect_set(F.struct("start", "stop")).alias("cut"))
    rows = id_and_text(docs).withColumn("k", doc_key())
    both = rows.join(cover, same_doc(rows, cover), "left").select(rows["doc_id"], rows["text"], cover["cut"])

    def run(batches):
        for whole in batches:
            for at in range(0, len(whole), 512):
                batch = whole.slice(at, 512)
                texts, total, gone, where = [], [], [], []
                for text, cut in zip(batch.column("text").to_pylist(), batch.column("cut").to_pylist()):
                    pieces = sentences(text or "")
                    merged: list[int] = []
                    for a, b in sorted((c["start"], c["stop"]) for c in cut or ()):
                        if merged and a <= merged[-1]:
                            merged[-1] = max(merged[-1], b)
                        else:
                            merged += [a, b]
                    keep = [True] * len(pieces)
                    for a, b in zip(merged[::2], merged[1::2]):
                        keep[a:b] = [False] * (b - a)
                    texts.append(text if text is None else "".join(p for p, k in zip(pieces, keep) if k))
                    total.append(len(pieces))
                    gone.append(keep.count(False))
                    where.append(merged)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(texts, pa.string()), pa.array(total, pa.int64()),
                     pa.array(gone, pa.int64()), pa.array(where, pa.list_(pa.int64()))],
                    ["doc_id", "text", "n_sentences", "n_removed", "removed"])
    return both.mapInArrow(run, "doc_id long, text string, n_sentences long, n_removed long, removed array<long>")
