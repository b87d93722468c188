"""Token counts of flat, unindexed token files by a vectorised scan for the end-of-document id.

A flat file is 16-bit little-endian numbers and nothing else: 0 ends a document, every other number is a
token's id plus one, so no id of the vocabulary can be taken for an end. A set of files, in the order of
their names, is one stream. Files are scanned in blocks of a fixed number of ids: each block yields the
places of its ends. A document that goes on in the next block or file is stitched by a prefix scan over
blocks: a block's base is the ids before it, its first document's number the ends before it, and its first
document begins behind the last end before it. The scan has two levels, within a file and over files,
so no task sees more than one row for each file, or each block of a file.

Texts are encoded and written where they are read, without an exchange. The same job writes, beside the
tokens, which documents a task met, in their order; so the n-th document of the stream has the n-th id.
Only ids and counts are put in the order of ids.

Ids after the last end are a document that did not end: it is returned with ``ended`` false. Empty
files have no block. Null texts are empty documents of one id, the end. ``doc_id`` is read as an integer;
what is none counts as null, and rows without ``doc_id`` come first. Rows of one id are ordered by their
counts, so repeated rows have starts of their own. Other columns are ignored."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from buyerlens.llm.encoding import encoder, vocabulary_path
from buyerlens.llm.words import buffers
from buyerlens.session import checkpointed, file_names, scratch_path

SEPARATOR = 0
BLOCK = 1 << 20
#: Pieces of about a megabyte that go to one file; Spark reads a file whole.
PIECES = 4
#: Folders of a flat table: the tokens, and the ids of the documents in the order of the tokens.
TOKENS, DOCUMENTS = "kind=0", "kind=1"


def _flat(path: str):
    def run(batches):
        enc = encoder(path, True)
        # one past the largest number is 0 again: the end
        end = (1 << 32) - 1
        for batch in batches:
            data, offsets = buffers(batch.column(1))
            for low, high, ids, _ in enc.slices(data, offsets, end):
                numbers = ids + np.uint32(1)
                if numbers.max(initial=0) >= 1 << 16:
                    raise ValueError("ids beyond 16 bits")
                names = batch.column(0)[low:high].cast(pa.string()).fill_null("").to_pylist()
                # both end in a zero byte, which Spark's writer adds as the end of the record
                yield pa.RecordBatch.from_pydict({
                    "kind": pa.array([0, 1], pa.int32()),
                    "value": pa.array([numbers.astype("<u2").tobytes()[:-1], "\0".join(names).encode()], pa.binary())})
    return run


def write_flat(docs: DataFrame, path: str, vocabulary: str | None = None) -> None:
    """Encode ``docs`` to flat files, an end after each document; the ids of the documents lie beside them."""
    rows = docs.select(F.expr("try_cast(doc_id AS bigint)").alias("doc_id"), F.col("text").cast("string"))
    flat = rows.mapInArrow(_flat(vocabulary or vocabulary_path()), "kind int, value binary")
    conf, both = docs.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
    before = conf.get(both)
    # a task keeps both folders' files open and writes pieces as they come; otherwise it would sort them by folder
    conf.set(both, "2")
    try:
        flat.select("kind", F.col("value").cast("string")).write.partitionBy("kind").option("lineSep", "\u0000").option(
            "compression", "none").option("maxRecordsPerFile", PIECES).text(path)
    finally:
        conf.set(both, before)


def _files(spark: SparkSession, folder: str) -> DataFrame:
    """``file, content`` of a folder; files by the numbers of the task and of the file in it."""
    if file_names(spark, folder) is None:
        return spark.createDataFrame([], "file string, content binary")
    part = F.lpad(F.regexp_extract("path", r"part-(\d+)-[^/]*$", 1), 12, "0")
    # the name of the job before it can hold such a group as well
    turn = F.lpad(F.regexp_extract("path", r"[.-]c(\d+)\.[^/0-9]+$", 1), 12, "0")
    return spark.read.format("binaryFile").load(folder).select(F.concat_ws("-", part, turn).alias("file"), "content")


def _scan(end: int, block: int):
    def run(batches):
        # a worker that encoded before gives back what it knows of words
        encoder.cache_clear()
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.frombuffer(content.as_buffer(), "<u2")
                for i, low in enumerate(range(0, len(ids), block)):
                    part = ids[low : low + block]
                    ends = np.flatnonzero(part == end)
                    yield pa.RecordBatch.from_pydict({
                        "file": pa.array([file], pa.string()), "block": pa.array([i], pa.int32()), "n": pa.array([len(part)], pa.int64()),
                        "ends": pa.array([ends], pa.list_(pa.int64())),
                    })
    return run


def scan_blocks(spark: SparkSession, path: str, end: int = SEPARATOR, block: int = BLOCK) -> DataFrame:
    """``file, block, n, ends``: ids of each block of ``path`` and the places of ends in it."""
    files = _files(spark, f"{path}/{TOKENS}")
    return files.mapInArrow(_scan(end, block), "file string, block int, n long, ends array<long>")


def stitched(blocks: DataFrame) -> DataFrame:
    """Per document of the stream: its number, start, n_tokens (with the end id) and whether it ended."""
    before = (Window.unboundedPreceding, -1)
    in_file, over_files = Window.partitionBy("file").orderBy("block"), Window.orderBy("file")
    own = blocks.select("file", "block", "n", F.size("ends").cast("long").alias("k"), F.get("ends", F.size("ends") - 1).alias("last"))
    inner = own.select(
        "file", "block", "n", "k", "last", F.coalesce(F.sum("n").over(in_file.rowsBetween(*before)), F.lit(0)).alias("base"),
        F.coalesce(F.sum("k").over(in_file.rowsBetween(*before)), F.lit(0)).alias("number"))
    inner = inner.withColumn("open", F.max(F.col("base") + F.col("last") + 1).over(in_file.rowsBetween(*before)))
    files = inner.groupBy("file").agg(F.sum("n").alias("fn"), F.sum("k").alias("fk"), F.max(F.col("base") + F.col("last") + 1).alias("fl"))
    outer = files.select(
        "file", F.coalesce(F.sum("fn").over(over_files.rowsBetween(*before)), F.lit(0)).alias("fbase"),
        F.coalesce(F.sum("fk").over(over_files.rowsBetween(*before)), F.lit(0)).alias("fnumber"), "fl", "fn", "fk")
    outer = outer.withColumn("fopen", F.coalesce(F.max(F.col("fbase") + F.col("fl")).over(over_files.rowsBetween(*before)), F.lit(0)))
    bases = inner.join(outer, "file").select(
        "file", "block", (F.col("fbase") + F.col("base")).alias("base"), (F.col("fnumber") + F.col("number")).alias("number"),
        F.coalesce(F.col("fbase") + F.col("open"), F.col("fopen")).alias("open"))
    placed = blocks.join(bases, ["file", "block"]).select("base", "number", "open", "ends", F.posexplode("ends").alias("i", "end"))
    start = F.when(F.col("i") == 0, F.col("open")).otherwise(F.col("base") + F.get("ends", F.col("i") - 1) + 1)
    documents = placed.select(
        (F.col("number") + F.col("i")).alias("number"), start.alias("start"),
        (F.col("base") + F.col("end") + 1 - start).alias("n_tokens"), F.lit(True).alias("ended"))
    rest = outer.agg(
        F.sum("fn").alias("all"), F.sum("fk").alias("k"), F.coalesce(F.max(F.col("fbase") + F.col("fl")), F.lit(0)).alias("open"))
    return documents.unionAll(rest.where(F.col("all") > F.col("open")).select(
        F.col("k").alias("number"), F.col("open").alias("start"), (F.col("all") - F.col("open")).alias("n_tokens"), F.lit(False).alias("ended")))


def _named(batches):
    for batch in batches:
        for file, content in zip(batch.column(0).to_pylist(), batch.column(1)):
            names = content.as_py().split(b"\0")[:-1]
            yield pa.RecordBatch.from_pydict({
                "file": pa.array([file] * len(names), pa.string()), "i": pa.array(np.arange(len(names))),
                "doc_id": pa.array([int(name) if name else None for name in names], pa.int64())})


def document_numbers(spark: SparkSession, path: str) -> DataFrame:
    """``number, doc_id``: the document of each place in the stream of ``path``."""
    rows = _files(spark, f"{path}/{DOCUMENTS}").mapInArrow(_named, "file string, i long, doc_id long")
    sizes = rows.groupBy("file").agg(F.count("*").alias("n"))
    bases = sizes.select("file", F.coalesce(F.sum("n").over(
        Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    return rows.join(bases, "file").select((F.col("base") + F.col("i")).alias("number"), "doc_id")


def _running(batches):
    part, before = TaskContext.get().partitionId(), 0
    for batch in batches:
        n = batch.column(1).to_numpy()
        after = before + np.cumsum(n)
        yield pa.RecordBatch.from_pydict({
            "part": pa.array(np.full(len(n), part), pa.int32()), "doc_id": batch.column(0), "n_tokens": batch.column(1),
            "inner": pa.array(after - n, pa.int64())})
        before = int(after[-1]) if len(n) else before


def placed(counts: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens`` of rows ``doc_id, n_tokens``: the ids of all documents before, in ascending order."""
    ordered = counts.select("doc_id", "n_tokens").repartitionByRange("doc_id", "n_tokens").sortWithinPartitions("doc_id", "n_tokens")
    rows = checkpointed(ordered.mapInArrow(_running, "part int, doc_id long, n_tokens long, inner long"))
    sizes = rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    bases = sizes.select("part", F.coalesce(F.sum("n").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    return rows.join(bases, "part").select("doc_id", (F.col("base") + F.col("inner")).alias("start"), "n_tokens")


def token_counts(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Write ``docs`` to flat files, scan these, and return doc_id, start and n_tokens per row."""
    spark = docs.sparkSession
    path = f"{scratch_path(spark)}/flat"
    write_flat(docs, path, vocabulary)
    found = stitched(checkpointed(scan_blocks(spark, path)))
    return placed(document_numbers(spark, path).join(found, "number"))
