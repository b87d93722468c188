"""Token-ID output in Simple-8b word-aligned coding.

A 64-bit word holds a selector in its upper 4 bits and as many ids of equal width as fit in the other
60. The escape selector stands for one id of up to 64 bits, which follows as a word of its own. Ids are
coded in blocks of ``BLOCK`` ids; the offset of each block's first word is stored, and a block's last
word may have room left. Coding takes all blocks of a chunk in lockstep, decoding all words at once.

A file is a Parquet table in the shared folder, written by Spark, so a lost task leaves nothing behind
and any store that Spark writes to will do. A row is a chunk of whole documents with ascending ids:
``part, chunk, doc_ids, lengths, n_ids, blocks`` (offsets as 32-bit integers) and ``payload``. Parts
follow the order of ids, so a document's place in the corpus is a sum over parts and chunks before it.

Null texts are empty and leave the end id alone. A null id sorts first, repeated rows stay, ties are
ordered by the text's hash. An empty table writes a table without rows."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from buyerlens.llm.encoding import encoder, vocabulary_path
from buyerlens.llm.words import buffers
from buyerlens.session import scratch_path

BLOCK = 1024
ESCAPE = 15
#: Fixed by the coding: ids in a word and their bits, by selector.
COUNTS = np.array([60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], dtype=np.int64)
BITS = 60 // COUNTS
BROADCAST_ROWS = 200_000

FILE = "part int, chunk int, doc_ids array<long>, lengths array<long>, n_ids long, blocks binary, payload binary"


def _choices(ids: np.ndarray, size: int) -> np.ndarray:
    """For each position, the selector that packs most of the ids from here to the end of its block."""
    bits = np.zeros(len(ids), dtype=np.uint8)
    for b in range(64):
        if not (over := ids >= np.uint64(1 << b)).any():
            break
        bits[over] = b + 1
    widest = {1: bits}
    p = 1
    while p < 32:
        m = widest[p].copy()
        m[:-p] = np.maximum(m[:-p], widest[p][p:])
        widest[2 * p] = m
        p *= 2
    choice = np.full(len(ids), ESCAPE, dtype=np.uint8)
    left = np.minimum(size - np.arange(len(ids)) % size, len(ids) - np.arange(len(ids)))
    for s in range(len(COUNTS) - 1, -1, -1):
        n = int(COUNTS[s])
        p = 1 << (n.bit_length() - 1)
        m = widest[p]
        if n > p:
            m = m.copy()
            m[: p - n] = np.maximum(m[: p - n], widest[p][n - p :])
        ok = (m <= BITS[s]) & (left >= n)
        choice[ok] = s
    return choice


def pack(ids: np.ndarray, size: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """``ids`` as 64-bit words and the offset of each block's first word."""
    ids = ids.astype(np.uint64)
    if not len(ids):
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.uint32)
    choice = _choices(ids, size)
    blocks = -(-len(ids) // size)
    at = np.arange(blocks, dtype=np.int64) * size
    end = np.minimum(at + size, len(ids))
    heads = []
    while len(at):
        heads.append(at)
        at = at + np.where(choice[at] == ESCAPE, 1, COUNTS[np.minimum(choice[at], len(COUNTS) - 1)])
        go = at < end
        at, end = at[go], end[go]
    heads = np.sort(np.concatenate(heads))
    chosen = choice[heads]
    width = 1 + (chosen == ESCAPE)
    place = np.cumsum(width) - width
    out = np.zeros(int(width.sum()), dtype=np.uint64)
    out[place] = chosen.astype(np.uint64) << np.uint64(60)
    for s in range(len(COUNTS)):
        mine = np.flatnonzero(chosen == s)
        for j in range(int(COUNTS[s]) if len(mine) else 0):
            out[place[mine]] |= ids[heads[mine] + j] << np.uint64(j * BITS[s])
    mine = chosen == ESCAPE
    out[place[mine] + 1] = ids[heads[mine]]
    first = np.searchsorted(heads, np.arange(blocks, dtype=np.int64) * size)
    return out, place[first].astype(np.uint32)


def unpack(payload: np.ndarray, blocks: np.ndarray, n: int, size: int = BLOCK) -> np.ndarray:
    """The ``n`` ids that ``pack`` coded."""
    out = np.zeros(n, dtype=np.uint64)
    if not n:
        return out
    selector = (payload >> np.uint64(60)).astype(np.int64)
    head = np.ones(len(payload), dtype=bool)
    if (selector == ESCAPE).any():
        # a word after an escape is an id, whatever its upper bits; a block begins with a head
        for lo, hi in zip(blocks, np.append(blocks[1:], len(payload))):
            i = int(lo)
            while i < hi:
                if selector[i] == ESCAPE:
                    head[i + 1] = False
                    i += 1
                i += 1
    heads = np.flatnonzero(head)
    chosen = selector[heads]
    count = np.where(chosen == ESCAPE, 1, COUNTS[np.minimum(chosen, len(COUNTS) - 1)])
    first = np.searchsorted(heads, blocks)
    before = np.cumsum(count) - count
    block = np.searchsorted(first, np.arange(len(heads)), side="right") - 1
    start = before - before[first][block] + block * size
    for s in range(len(COUNTS)):
        mine = np.flatnonzero(chosen == s)
        if len(mine):
            word, at, mask = payload[heads[mine]], start[mine], np.uint64((1 << int(BITS[s])) - 1)
            for j in range(int(COUNTS[s])):
                out[at + j] = (word >> np.uint64(j * BITS[s])) & mask
    mine = chosen == ESCAPE
    out[start[mine]] = payload[heads[mine] + 1]
    return out


def _writer(path: str):
    def run(batches):
        part, chunk, enc = TaskContext.get().partitionId(), 0, encoder(path, True)
        for batch in batches:
            data, offsets = buffers(batch.column(1))
            for low, high, ids, begin in enc.slices(data, offsets):
                payload, blocks = pack(ids)
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array([part], pa.int32()), "chunk": pa.array([chunk], pa.int32()),
                    "doc_ids": pa.array([batch.column(0).slice(low, high - low).to_pylist()], pa.list_(pa.int64())),
                    "lengths": pa.array([np.diff(begin)], pa.list_(pa.int64())),
                    "n_ids": pa.array([len(ids)], pa.int64()),
                    "blocks": pa.array([blocks.astype("<u4").tobytes()], pa.binary()),
                    "payload": pa.array([payload.astype("<u8").tobytes()], pa.binary()),
                })
                chunk += 1
    return run


def write_ids(docs: DataFrame, path: str, vocabulary: str | None = None) -> None:
    """Encode ``docs(doc_id, text)`` and write them to ``path`` in ascending order of ids."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    tie = F.xxhash64("text")
    ordered = rows.repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie)
    ordered.mapInArrow(_writer(vocabulary or vocabulary_path()), FILE).write.option("compression", "none").parquet(path)


def _reader(batches):
    for batch in batches:
        for row in range(batch.num_rows):
            part, chunk, doc_ids, lengths, n, blocks, payload = (batch.column(i)[row] for i in range(7))
            ids = unpack(np.frombuffer(payload.as_buffer(), "<u8"), np.frombuffer(blocks.as_buffer(), "<u4"), n.as_py())
            lengths = lengths.values.to_numpy()
            ends = np.cumsum(lengths)
            raw = memoryview(ids.astype("<u4").tobytes())
            crc = [zlib.crc32(raw[4 * (e - k) : 4 * e]) for e, k in zip(ends.tolist(), lengths.tolist())]
            yield pa.RecordBatch.from_pydict({
                "part": pa.array(np.full(len(ends), part.as_py()), pa.int32()),
                "chunk": pa.array(np.full(len(ends), chunk.as_py()), pa.int32()), "doc_id": doc_ids.values,
                "offset": pa.array(ends - lengths), "n_tokens": pa.array(lengths), "ids_crc32": pa.array(crc, pa.int64()),
            })


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """The chunks of a file written by ``write_ids``; ``unpack`` gives a chunk's ids."""
    return spark.read.schema(FILE).parquet(path)


def index(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the file, from its decoded ids: doc_id, start, n_tokens, ids_crc32."""
    chunks = read_ids(spark, path)
    sizes = chunks.select("part", "chunk", "n_ids")
    up_to = (Window.unboundedPreceding, -1)
    of_part = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    # one row per part of the file here, one per chunk of a part there
    parts = of_part.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(*up_to)), F.lit(0)).alias("p"))
    inside = sizes.select("part", "chunk", F.coalesce(
        F.sum("n_ids").over(Window.partitionBy("part").orderBy("chunk").rowsBetween(*up_to)), F.lit(0)).alias("c"))
    bases = inside.join(parts, "part").select("part", "chunk", (F.col("p") + F.col("c")).alias("base"))
    if chunks.select("part").limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        bases = F.broadcast(bases)
    decoded = chunks.mapInArrow(_reader, "part int, chunk int, doc_id long, offset long, n_tokens long, ids_crc32 long")
    return decoded.join(bases, ["part", "chunk"]).select(
        "doc_id", (F.col("base") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")


def encoded(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Write ``docs`` to a new file in the shared folder and return its index."""
    spark = docs.sparkSession
    path = f"{scratch_path(spark)}/ids"
    write_ids(docs, path, vocabulary)
    return index(spark, path)
