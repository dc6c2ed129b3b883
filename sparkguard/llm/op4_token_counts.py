"""Token counts from flat, unindexed token files by a separator scan.

A flat file is a run of ids with an end-of-document id after each document and nothing else.  It is kept as fixed-size
blocks ``(file, block, data)`` (Parquet is the container): a block may start and end anywhere in a document.
``count_tokens`` never decodes text and has no index:

1. every block is searched once with numpy for the separator, and the positions are written as a table;
2. a block is summed up as (separators, end of its last separator);
3. a two-level prefix scan per file (inside groups of 4 096 blocks, then over the groups) gives each block the number of
   documents before it and where the document that it continues began;
4. a document's length is the distance to the separator before it, across any number of blocks.

A file that doesn't end in a separator has one more document, marked ``closed = false``.  Blocks of zero ids, empty
documents (two separators in a row) and empty tables are fine; lengths don't count the separator.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import id_and_text, scratch_path, written
from .tokens import default_tokenizer, encoder

BLOCK_TOKENS = 1 << 16
GROUP_BLOCKS = 4096


def write_flat(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = 49407,
               block_tokens: int = BLOCK_TOKENS) -> None:
    """Write one flat file per input partition below ``path/blocks`` and its documents' ids, in order, below
    ``path/docs`` (file, ordinal, doc_id): the files themselves hold ids only.

    Null texts are empty documents.  Special-token strings inside a text are ordinary text, so a text can't forge a
    separator.  Nothing is shuffled.  A file's name is drawn from its partition's number, so a rerun task writes
    the same rows.
    """
    spark, tokenizer = docs.sparkSession, tokenizer or default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        file, enc = TaskContext.get().partitionId(), encoder(tokenizer, True)
        end, size = np.array([end_id], enc.dtype).tobytes(), block_tokens * enc.dtype.itemsize
        held, block, ordinal = bytearray(), 0, 0

        def row(block=None, data=None, docs=None, width=enc.dtype.itemsize):
            return pa.RecordBatch.from_arrays(
                [pa.array([file], pa.int32()), pa.array([width], pa.int32()), pa.array([block], pa.int64()),
                 pa.array([data], pa.binary()), pa.array([ordinal], pa.int64()),
                 pa.array([docs], pa.list_(pa.int64()))], ["file", "width", "block", "data", "ordinal", "docs"])
        for batch in batches:
            for at in range(0, len(batch), 1024):
                some = batch.slice(at, 1024)
                for one in enc.encode(some.column(1).to_pylist()):
                    held += one.tobytes() + end
                    while len(held) >= size:
                        yield row(block, bytes(held[:size]))
                        block, held = block + 1, held[size:]
                yield row(docs=some.column(0).to_pylist())
                ordinal += len(some)
        if held:
            yield row(block, bytes(held))
    schema = "file int, width int, block long, data binary, ordinal long, docs array<long>"
    (id_and_text(docs).mapInArrow(run, schema).withColumn("kind", F.when(F.col("data").isNull(), "docs").otherwise("blocks"))
     .write.option("compression", "zstd").partitionBy("kind").parquet(path))


def count_tokens(blocks: DataFrame, end_id: int = 49407) -> DataFrame:
    """``(file, ordinal, start, n_tokens, closed)`` per document of flat files given as ``(file, width, block, data)``.

    All blocks of a file but its last hold the same number of ids.
    """
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = {c: batch.column(c).to_pylist() for c in ("file", "width", "block")}
            for i, (file, width, block) in enumerate(zip(*cols.values())):
                ids = np.frombuffer(batch.column("data")[i].as_buffer() or b"", f"<u{width}")
                at = np.flatnonzero(ids == end_id).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([file], pa.int32()), pa.array([block], pa.int64()), pa.array([len(ids)], pa.int64()),
                     pa.array([at], pa.list_(pa.int64()))], ["file", "block", "n", "seps"])
    # both the sums and the stitching read this table, so that no block is searched twice
    found = written(blocks.select("file", "width", "block", "data").mapInArrow(
        scan, "file int, block long, n long, seps array<long>"), "seps")
    # what a block adds to the scan; block 0 tells the block length of its file
    found = found.withColumn("n_sep", F.size("seps")).withColumn("grp", F.expr(f"block div {GROUP_BLOCKS}"))
    in_grp = Window.partitionBy("file", "grp").orderBy("block")
    before = in_grp.rowsBetween(Window.unboundedPreceding, -1)
    length = blocks.select("file", "block", (F.length("data") / F.col("width")).cast("long").alias("step")) \
        .filter("block = 0").select("file", "step")
    found = found.join(length, "file").withColumn("base", F.col("block") * F.col("step"))
    found = found.withColumn("last", F.when(F.col("n_sep") > 0, F.col("base") + F.element_at("seps", -1) + 1))
    groups = found.groupBy("file", "grp").agg(F.sum("n_sep").alias("g_sep"), F.max("last").alias("g_last"),
                                              F.max(F.col("base") + F.col("n")).alias("g_end"))
    up = Window.partitionBy("file").orderBy("grp").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select("file", "grp", F.sum("g_sep").over(up).alias("g_sep"), F.max("g_last").over(up).alias("g_last"),
                           F.max("g_end").over(Window.partitionBy("file")).alias("file_end"))
    zero = F.lit(0).cast("long")
    stitched = (found.withColumn("b_sep", F.sum("n_sep").over(before)).withColumn("b_last", F.max("last").over(before))
                .join(groups, ["file", "grp"])
                .withColumn("doc0", F.coalesce("b_sep", zero) + F.coalesce("g_sep", zero))
                .withColumn("from0", F.greatest(F.coalesce("b_last", zero), F.coalesce("g_last", zero))))
    tail_from = F.coalesce("last", "from0")
    has_tail = (F.col("base") + F.col("n") == F.col("file_end")) & (tail_from < F.col("file_end")) & (F.col("n") > 0)
    ends = F.concat(F.transform("seps", lambda s: F.struct((s + F.col("base")).alias("end"), F.lit(True).alias("closed"))),
                    F.when(has_tail, F.array(F.struct(F.col("file_end").alias("end"), F.lit(False).alias("closed"))))
                    .otherwise(F.array().cast("array<struct<end: long, closed: boolean>>")))
    docs = stitched.select("file", "doc0", "from0", "base", "seps", ends.alias("ends")).select(
        "file", "doc0", F.posexplode("ends").alias("k", "e"), "from0", "base", "seps")
    start = F.when(F.col("k") == 0, F.col("from0")).otherwise(F.col("base") + F.try_element_at("seps", F.col("k")) + 1)
    return docs.select("file", (F.col("doc0") + F.col("k")).alias("ordinal"), start.alias("start"),
                       (F.col("e.end") - start).alias("n_tokens"), F.col("e.closed").alias("closed"))


def corpus_token_counts(docs: DataFrame, path: str | None = None, tokenizer: str | None = None,
                        end_id: int = 49407) -> DataFrame:
    """Write ``docs`` as flat files and count each document's tokens from them: ``(doc_id, n_tokens)`` per row of
    ``docs`` (a null or empty text has 0)."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "flat")
    write_flat(docs, path, tokenizer, end_id)
    blocks = spark.read.schema("file int, width int, block long, data binary").parquet(f"{path}/kind=blocks") \
        if _exists(spark, f"{path}/kind=blocks") else spark.createDataFrame([], "file int, width int, block long, data binary")
    names = spark.read.schema("file int, ordinal long, docs array<long>").parquet(f"{path}/kind=docs") \
        if _exists(spark, f"{path}/kind=docs") else spark.createDataFrame([], "file int, ordinal long, docs array<long>")
    names = names.select("file", "ordinal", F.posexplode("docs").alias("k", "doc_id")) \
        .select("file", (F.col("ordinal") + F.col("k")).alias("ordinal"), "doc_id")
    return names.join(count_tokens(blocks, end_id), ["file", "ordinal"]).select("doc_id", "n_tokens")


def _exists(spark, path: str) -> bool:
    """Whether the store that Spark uses has this folder."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)
