"""Which rows may be copies, from 128-bit fingerprints, without a shuffle of the rows.

Fingerprints are counted in one map-side combined aggregate (16 bytes a row).  Those that repeat set one bit each in a
table of at most ``WORDS`` 64-bit words, which is broadcast whatever the size of the data.  A row whose bit isn't set is
certainly unique.  The others (all copies, and about repeated fingerprints / (64 ``WORDS``) of the unique rows) have to be
compared on their columns by the caller.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS = 1 << 18   # a power of two: 2 MiB of bits, at most 2**18 broadcast rows
SUSPECT = "_suspect"


def fingerprint(cols: list[str]) -> tuple[Column, Column]:
    """Two 64-bit hashes of a row; NULL cells count by position (the hash itself skips them)."""
    nulls = F.array(*[F.col(c).isNull() for c in cols])
    return F.xxhash64(nulls, *cols), F.xxhash64(F.lit(1), *cols, nulls)


def suspects(df: DataFrame, cols: list[str], words: int = WORDS) -> DataFrame:
    """``df`` with the boolean ``_suspect``: false only for rows that no other row equals on ``cols``."""
    h1, h2 = fingerprint(cols)
    # never NULL by type: an inferred IS NOT NULL over the whole hash would be rewritten once per subset of projected columns
    word, bit = F.col("_h1").bitwiseAND(F.lit(words - 1)), F.col("_h2").bitwiseAND(F.lit(63)).cast("int")
    mask = F.expr("shiftleft(1L, _bit)")
    repeated = (df.select(h1.alias("_h1"), h2.alias("_h2")).groupBy("_h1", "_h2").agg(F.count(F.lit(1)).alias("_n"))
                .where("_n > 1").select(word.alias("_word"), bit.alias("_bit"))
                .groupBy("_word").agg(F.bit_or(mask).alias("_bits")))
    rows = df.withColumns({"_h1": h1, "_h2": h2}).withColumns({"_word": word, "_bit": bit})
    hit = F.coalesce(F.col("_bits").bitwiseAND(mask) != 0, F.lit(False))
    return rows.join(F.broadcast(repeated), ["_word"], "left").select(*df.columns, hit.alias(SUSPECT))
