"""Token ids in segments with Elias-Fano document boundaries.

Layout of a dataset folder (Parquet is the container, so Spark's committer makes it safe against lost tasks and any
Hadoop store can hold it):

* ``data``: one row per segment of about 64 Ki ids: ``part`` (range partition of doc_id), ``seg``, ``doc0`` and
  ``token0`` (documents and ids before it in its part), ``n_docs``, ``n_tokens``, ``width`` (bytes an id takes, 2 or 4),
  ``ids`` (the concatenated little-endian ids), ``ends`` (Elias-Fano of the documents' end offsets in the segment)
  and ``doc_ids`` (Elias-Fano of doc_id - ``id0``; the first ``n_null`` documents have a null doc_id).
* ``index``: one row per part: ``first_doc`` and ``first_token`` in the whole dataset.

No 64-bit offset per document is stored: boundaries and doc_ids take about 2 + log2(mean gap) bits each.
Offsets come from ``EliasFano.select`` / ``select_range`` plus the two sums.

Documents stand in ascending doc_id order, null ids first; rows with equal doc_id stand side by side, ordered by text.
A null or empty text is the end id alone.  An empty table gives an empty dataset.  Other columns are ignored.
A segment ends after the document that fills it, so one very long document is one segment.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import id_and_text, scratch_path
from .eliasfano import SELECT_EVERY, EliasFano
from .tokens import default_tokenizer, encoder

SEGMENT_TOKENS = 1 << 16
#: Documents whose boundaries are read at once: a few select samples.
READ_RUN = 4 * SELECT_EVERY
#: Characters of the text that, after the doc_id, part rows of equal or null doc_ids over tasks.
SPLIT_CHARS = 32
EF = "struct<n: long, l: int, low: binary, high: binary, samples: binary>"
DATA_SCHEMA = ("part int, seg int, doc0 long, token0 long, n_docs long, n_tokens long, width int, ids binary, "
               f"ends {EF}, id0 long, n_null long, doc_ids {EF}")


def _segment(part: int, seg: int, doc0: int, token0: int, ids: list, docs: list) -> dict:
    ends = np.cumsum([len(x) for x in ids])
    known = [d for d in docs if d is not None]
    id0 = known[0] if known else 0
    gaps = np.array(known, np.int64).view(np.uint64) - np.array(id0, np.int64).view(np.uint64)
    flat = np.concatenate(ids)
    return {"part": part, "seg": seg, "doc0": doc0, "token0": token0, "n_docs": len(ids), "n_tokens": len(flat),
            "width": flat.dtype.itemsize, "ids": flat.tobytes(), "ends": vars(EliasFano.encode(ends)), "id0": id0,
            "n_null": len(docs) - len(known), "doc_ids": vars(EliasFano.encode(gaps))}


def _encode_partition(path: str, end_id: int, segment_tokens: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, enc = TaskContext.get().partitionId(), encoder(path)
        end = np.array([end_id], enc.dtype)
        seg = doc0 = token0 = held = 0
        ids, docs = [], []

        def close():
            nonlocal seg, doc0, token0, held, ids, docs
            row = _segment(part, seg, doc0, token0, ids, docs)
            seg, doc0, token0, held, ids, docs = seg + 1, doc0 + len(docs), token0 + row["n_tokens"], 0, [], []
            return pa.RecordBatch.from_pylist([row], schema)

        for batch in batches:
            for at in range(0, len(batch), 1024):
                some = batch.slice(at, 1024)
                for doc, one in zip(some.column(0).to_pylist(), enc.encode(some.column(1).to_pylist())):
                    ids.append(np.concatenate([one, end]))
                    docs.append(doc)
                    held += len(one) + 1
                    if held >= segment_tokens:
                        yield close()
        if docs:
            yield close()
    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = 1,
                 segment_tokens: int = SEGMENT_TOKENS) -> None:
    """Encode every text, append ``end_id`` and write the dataset folder ``path``.

    One shuffle: rows are range-partitioned on doc_id and the beginning of the text (so many rows of one doc_id, or of none,
    are several partitions in the same order), sorted inside the partition (external sort) and encoded there.
    The index is written last; a folder without one is incomplete.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    spark = docs.sparkSession
    schema = spark.createDataFrame([], DATA_SCHEMA).schema
    run = _encode_partition(tokenizer or default_tokenizer(), end_id, segment_tokens, to_arrow_schema(schema))
    (id_and_text(docs).repartitionByRange("doc_id", F.substring("text", 1, SPLIT_CHARS)).sortWithinPartitions("doc_id", "text")
     .mapInArrow(run, schema).write.option("compression", "zstd").parquet(f"{path}/data"))
    parts = (spark.read.schema(schema).parquet(f"{path}/data").groupBy("part")
             .agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)   # one row per task, not per document
    (parts.select("part", F.coalesce(F.sum("n_docs").over(before), F.lit(0)).alias("first_doc"),
                  F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("first_token"), "n_docs", "n_tokens")
     .coalesce(1).write.parquet(f"{path}/index"))


def segments(spark: SparkSession, path: str) -> DataFrame:
    """The segments with their global ``first_doc`` and ``first_token``."""
    data = spark.read.schema(DATA_SCHEMA).parquet(f"{path}/data")
    index = spark.read.schema("part int, first_doc long, first_token long").parquet(f"{path}/index")
    return (data.join(index, "part").withColumn("first_doc", F.col("first_doc") + F.col("doc0"))
            .withColumn("first_token", F.col("first_token") + F.col("token0")).drop("part", "doc0", "token0"))


def _each_document(row: dict) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """(doc_id, start, ids) of a segment's documents; boundaries and doc_ids come from the select structures, a run of samples
    at a time."""
    ids = np.frombuffer(row["ids"], f"<u{row['width']}")
    ends, gaps, nulls = EliasFano(**row["ends"]), EliasFano(**row["doc_ids"]), row["n_null"]
    id0, at = np.array(row["id0"], np.int64).view(np.uint64), 0
    for first in range(0, ends.n, READ_RUN):
        last = min(first + READ_RUN, ends.n)
        known = (gaps.select_range(max(0, first - nulls), max(0, last - nulls)) + id0).view(np.int64).tolist()
        for doc, end in zip([None] * (last - first - len(known)) + known, ends.select_range(first, last).tolist()):
            yield doc, row["first_token"] + at, ids[at:end]
            at = end


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, doc_no, start, n_tokens, ids_crc32)`` of every document, from the files alone."""
    def run(batches):
        import zlib
        for batch in batches:
            for i in range(len(batch)):
                row = batch.slice(i, 1).to_pylist()[0]
                rows = [(d, row["first_doc"] + k, s, len(x), zlib.crc32(x.astype("<u4").tobytes()))
                        for k, (d, s, x) in enumerate(_each_document(row))]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)],
                                                 ["doc_id", "doc_no", "start", "n_tokens", "ids_crc32"])
    return segments(spark, path).mapInArrow(run, "doc_id long, doc_no long, start long, n_tokens long, ids_crc32 long")


def read_ids(spark: SparkSession, path: str, doc_nos: list[int]) -> DataFrame:
    """``(doc_no, start, ids)`` of the documents with these numbers: only their segments are read, and each offset is
    one ``select`` on the Elias-Fano bits."""
    wanted = sorted(set(doc_nos))
    hit = F.exists(F.lit(wanted).cast("array<long>"),
                   lambda d: (d >= F.col("first_doc")) & (d < F.col("first_doc") + F.col("n_docs")))

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ends, ids = EliasFano(**row["ends"]), np.frombuffer(row["ids"], f"<u{row['width']}")
                for d in wanted:
                    if 0 <= (k := d - row["first_doc"]) < row["n_docs"]:
                        at = ends.select(k - 1) if k else 0
                        yield pa.RecordBatch.from_pydict({"doc_no": [d], "start": [row["first_token"] + at],
                                                          "ids": [ids[at:ends.select(k)].astype(np.int64).tolist()]})
    return segments(spark, path).filter(hit).mapInArrow(run, "doc_no long, start long, ids array<long>")


def token_table(docs: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Write ``docs`` to ``path`` (default: a new folder in the shared scratch folder) and read the documents back."""
    path = path or scratch_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, **options)
    return read_documents(docs.sparkSession, path)
