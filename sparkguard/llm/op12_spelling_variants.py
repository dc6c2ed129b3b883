"""Spelling variant grouping by Bloom-guided neighbourhoods.

Words are maximal runs of ``[A-Za-z\\u00C0-\\u00FF]`` with A-Z lower-cased.  With ``damaged`` a run loses one code point when 199
divides the crc32 of ``<doc_id>:<run>``.  The vocabulary is every result of at least ``MIN_CHARS`` code points and ``MIN_COUNT``
occurrences; counts are combined in the map tasks, so a frequent word is a few rows.

Two words are near if they differ by exactly one inserted, deleted or replaced code point.  The vocabulary is put into blocked
Bloom filters, one shard per word length (the lengths from ``LAST_SHARD`` on share one), each block 256 bits of which a word
sets one in each of eight lanes.  Filters are built in the tasks, OR-ed by an aggregate over blocks and broadcast; all
shards together take at most ``FILTER_BYTES`` whatever the vocabulary's size (with more words the blocks fill up, more edits are
positive, and the result stays the same).  Every word probes its deletions and its replacements by a greater code point (the
relation is symmetric, so the other edits are found from the other word); the hash of an edit comes from prefix and suffix
hashes of the word, in numpy.  Only positives are written out as strings and shuffled to an exact join with the vocabulary.

``form`` is the near word of largest count (ties: least in code-point order) if that is at least ``RATIO`` times the word's count.
Counts grow along forms, so the chains end; ``root`` follows them by pointer doubling.

Null and empty texts have no words; a null doc_id is named ``null``.  Repeated rows count as they come.  Empty tables give no
rows.  Other columns are ignored.
"""
from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, mix64, written

MIN_CHARS, MIN_COUNT, RATIO = 6, 5, 5
#: Fixed value: of the runs whose hash it divides, one code point is deleted.
DAMAGE = 199
RUN = re.compile("[a-zÀ-ÿ]+")
#: Code points that a word may hold.
ALPHABET = np.array([*range(0x61, 0x7B), *range(0xC0, 0x100)], np.uint64)
LOWER = {c: c + 32 for c in range(65, 91)}
LAST_SHARD = 40
BITS_PER_WORD = 16
FILTER_BYTES = 64 << 20
HELD_WORDS = 100_000
BASE = np.uint64(0x9E3779B97F4A7C15)
#: Edits hashed at once by a task.
EDITS = 1 << 18


# ---- the vocabulary -----------------------------------------------------------------------------------------
def word_counts(docs: DataFrame, damaged: bool = True) -> DataFrame:
    """``(word, n)`` of all words, short and rare ones included."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts = Counter(RUN.findall(text.translate(LOWER))) if text else {}
                if damaged:
                    name = zlib.crc32(f"{'null' if doc_id is None else doc_id}:".encode())
                    for word, n in counts.items():
                        h = zlib.crc32(word.encode(), name)
                        if h % DAMAGE == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1:]
                        held[word] += n
                else:
                    held.update(counts)
                if len(held) > HELD_WORDS:
                    yield out()
                    held.clear()
        if held:
            yield out()
    return id_and_text(docs).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(docs: DataFrame, damaged: bool = True, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """``(word, n)`` of the words long and frequent enough."""
    return word_counts(docs, damaged).filter((F.length("word") >= min_chars) & (F.col("n") >= min_count))


# ---- Bloom filters --------------------------------------------------------------------------------------------
def code_points(words: list[str]) -> np.ndarray:
    """One row of code points per word; all words have the same length."""
    return np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), -1).astype(np.uint64)


def word_hash(points: np.ndarray) -> np.ndarray:
    """Polynomial hash of each row, the highest power at the first code point."""
    h = np.zeros(len(points), np.uint64)
    with np.errstate(over="ignore"):
        for c in points.T:
            h = h * BASE + c
    return h


def slots(h: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """(block, bits): a hash's block and its eight 5-bit positions, one in each 32-bit lane, in 40 bits."""
    h = mix64(h)
    return (h >> np.uint64(40)) % np.uint64(blocks), h & np.uint64((1 << 40) - 1)


def filter_sizes(words: DataFrame, filter_bytes: int = FILTER_BYTES) -> dict[int, int]:
    """Blocks of each shard, in proportion to its words and within ``filter_bytes`` in all."""
    counts = words.groupBy(F.least(F.length("word"), F.lit(LAST_SHARD)).alias("shard")).count().collect()   # LAST_SHARD rows at most
    total = sum(r["count"] for r in counts)
    blocks = min(total * BITS_PER_WORD / 256, filter_bytes / 32 - len(counts))
    return {r["shard"]: 1 + int(blocks * r["count"] / total) for r in counts}


def by_length(batch: pa.RecordBatch) -> dict[int, list[str]]:
    groups: dict[int, list[str]] = {}
    for w in batch.column("word").to_pylist():
        groups.setdefault(len(w), []).append(w)
    return groups


def bloom_filters(words: DataFrame, sizes: dict[int, int]) -> dict[int, np.ndarray]:
    """Each shard's filter: an array (blocks, 8) of 32-bit lanes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, group in by_length(batch).items():
                shard = min(length, LAST_SHARD)
                block, bits = slots(word_hash(code_points(group)), sizes[shard])
                lanes = [np.left_shift(np.uint64(1), bits >> np.uint64(5 * i) & np.uint64(31)) for i in range(8)]
                masks = [(lanes[2 * i] | lanes[2 * i + 1] << np.uint64(32)).view(np.int64) for i in range(4)]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(group), shard)), pa.array(block.astype(np.int64)), *map(pa.array, masks)],
                                                 ["shard", "block", "m0", "m1", "m2", "m3"])
    rows = words.select("word").mapInArrow(run, "shard long, block long, m0 long, m1 long, m2 long, m3 long")
    merged = rows.groupBy("shard", "block").agg(*[F.bit_or(f"m{i}").alias(f"m{i}") for i in range(4)])
    out = {shard: np.zeros((blocks, 4), np.int64) for shard, blocks in sizes.items()}
    table = merged.toArrow()                                   # at most FILTER_BYTES of blocks
    shard, block = (table.column(c).to_numpy() for c in ("shard", "block"))
    masks = np.stack([table.column(f"m{i}").to_numpy() for i in range(4)], axis=1) if table.num_rows else np.zeros((0, 4), np.int64)
    for s in out:
        out[s][block[shard == s]] = masks[shard == s]
    return {s: a.view(np.uint32) for s, a in out.items()}


def may_hold(filters: dict[int, np.ndarray], length: int, h: np.ndarray) -> np.ndarray:
    """Whether words of ``length`` with these hashes may be in the vocabulary."""
    lanes = filters.get(min(length, LAST_SHARD))
    if lanes is None:
        return np.zeros(len(h), bool)
    block, bits = slots(h, len(lanes))
    at = np.arange(len(h))
    for i in range(8):                                          # few hashes outlive the first lanes
        hit = lanes[block[at], i] >> (bits[at] >> np.uint64(5 * i) & np.uint64(31)).astype(np.uint32) & np.uint32(1)
        at = at[hit.astype(bool)]
    out = np.zeros(len(h), bool)
    out[at] = True
    return out


# ---- probing --------------------------------------------------------------------------------------------------
def positive_edits(words: list[str], filters: dict[int, np.ndarray]) -> Iterator[tuple[str, str]]:
    """(word, edit) of the deletions and upward replacements that the filters let pass; all words have the same length."""
    points = code_points(words)
    n, length = points.shape
    with np.errstate(over="ignore"):
        power = np.ones(length + 1, np.uint64)
        for i in range(length):
            power[i + 1] = power[i] * BASE
        whole = word_hash(points)
        prefix, suffix = np.zeros(n, np.uint64), whole          # of the code points before i, and from i on
        for i in range(length):
            c = points[:, i]
            suffix = suffix - c * power[length - 1 - i]
            # a run of equal code points gives the same deletion: its first place only
            first = np.ones(n, bool) if i == 0 else c != points[:, i - 1]
            gone = np.flatnonzero(first)
            h = prefix[gone] * power[length - 1 - i] + suffix[gone]
            for k in gone[may_hold(filters, length - 1, h)]:
                yield words[k], words[k][:i] + words[k][i + 1:]
            up = ALPHABET[None, :] > c[:, None]
            k, a = np.nonzero(up)
            h = whole[k] + (ALPHABET[a] - c[k]) * power[length - 1 - i]
            hit = may_hold(filters, length, h)
            for k, a in zip(k[hit], a[hit]):
                yield words[k], words[k][:i] + chr(int(ALPHABET[a])) + words[k][i + 1:]
            prefix = prefix * BASE + c


def near_pairs(words: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """``(word, near, n)``: each pair of near words both ways, with the count of ``near``."""
    spark = words.sparkSession
    shared = spark.sparkContext.broadcast(bloom_filters(words, filter_sizes(words, filter_bytes)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, group in by_length(batch).items():
                # a long word alone may have more edits than EDITS; only one place's are hashed at once
                step = max(1, EDITS // len(ALPHABET))
                for at in range(0, len(group), step):
                    found = list(positive_edits(group[at:at + step], shared.value))
                    if found:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*found)], ["word", "edit"])
    # few bytes per word and much work: an explicit number of partitions, which adaptive execution doesn't merge
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
    spread = words.repartition(parts, "word")
    edits = spread.select("word").mapInArrow(run, "word string, edit string")
    pairs = edits.join(words.withColumnsRenamed({"word": "edit", "n": "edit_n"}), "edit").join(words, "word")
    ways = F.array(F.struct(F.col("word"), F.col("edit").alias("near"), F.col("edit_n").alias("n")),
                   F.struct(F.col("edit").alias("word"), F.col("word").alias("near"), F.col("n")))
    return pairs.select(F.inline(ways))


def follow(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of ``(word, form)`` rows: the last word of each chain, by pointer doubling."""
    step = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = step.select(F.col("word").alias("at"), F.col("root").alias("next"))
        new = written(step.join(ahead, step["root"] == ahead["at"], "left")
                      .select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        step = new.select("word", "root")
        if new.filter("moved").isEmpty():
            return step


def spelling_variants(docs: DataFrame, damaged: bool = False, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT,
                      ratio: int = RATIO, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """``(word, n, n_near, form, form_n, root)`` per word of the vocabulary."""
    words = written(vocabulary(docs, damaged, min_chars, min_count), "vocabulary")
    best = near_pairs(words, filter_bytes).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct(-F.col("n"), "near")).alias("b")) \
        .select(F.col("word").alias("w"), "n_near", -F.col("b.col1"), "b.near").toDF("w", "n_near", "near_n", "near")
    judged = words.join(best, words["word"] == best["w"], "left")
    taken = F.col("near_n") >= ratio * F.col("n")
    judged = written(judged.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                   F.when(taken, F.col("near")).alias("form"), F.when(taken, F.col("near_n")).alias("form_n")), "forms")
    roots = follow(judged.filter("form IS NOT NULL"))
    return judged.join(roots, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
