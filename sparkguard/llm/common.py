"""Helpers shared by the training-data operators."""
from __future__ import annotations

import os
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder (``spark.checkpoint.dir``)."""
    return os.path.join(ensure_checkpoint_dir(spark), "llm", f"{name}-{uuid.uuid4().hex[:12]}")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and return a scan of it (cuts lineage; a lost executor
    re-reads files)."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_and_text(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)`` only, so extra columns of any name cannot clash with an operator's own."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def doc_key(text: str = "text") -> Column:
    """A 64-bit hash of (doc_id, text), never null.  ``(doc_id, k)`` names a document: rows equal in both are the same
    document everywhere, rows that share only the doc_id are different ones."""
    d, t = F.col("doc_id"), F.col(text)
    return F.xxhash64(d, d.isNull(), t, t.isNull()).alias("k")


def same_doc(a: DataFrame, b: DataFrame) -> Column:
    """Join condition on the names ``(doc_id, k)``, null ids included."""
    return (a["k"] == b["k"]) & a["doc_id"].eqNullSafe(b["doc_id"])


def whole_row(docs: DataFrame) -> Column:
    """All columns of ``docs`` as one struct, to carry them through an operator whatever their names are."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")


# ---- words as bytes -------------------------------------------------------------------------------------------
#: ASCII letters lower-cased, digits kept, every other ASCII byte a space; bytes of non-ASCII characters kept.
WORD_BYTES = bytes(b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32
                   for b in range(256))


def byte_words(text: bytes | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the UTF-8 text with A-Z lower-cased."""
    return text.translate(WORD_BYTES).split() if text else []


def hash_words(words: list[bytes]) -> np.ndarray:
    """64-bit hash of each word."""
    import xxhash
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer (xor-shift-multiply), element by element."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def shingle_set(words: list[bytes], n: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-word shingles; a shorter text is one shingle, no words none."""
    if not words:
        return np.empty(0, np.uint64)
    h = hash_words(words)
    n = min(n, len(h))
    out = np.full(len(h) - n + 1, n, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(n):
            out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + h[i:len(h) - n + 1 + i])
    return np.unique(out)
