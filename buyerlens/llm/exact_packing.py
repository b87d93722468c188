"""Packing documents into sequences: exact complements by hashed length sums, then best fit.

A document is its ids and an end id; one that is longer than a sequence is cut into pieces of full length and
a rest. How pieces share sequences depends on their lengths alone, of which there are at most as many as a
sequence has tokens. So the packing is planned on the counts by length, with a work that does not grow
with the corpus: for the longest length that is left, the gap it leaves is looked up among the lengths,
the sums of two and the sums of three, and the combination that fills it exactly is used as often as all
its lengths last. Where no sum fits, the longest length that fits goes in (best fit) and the smaller gap
is looked up again.

A pattern of the plan asks for a run of each of its lengths. Pieces are numbered within their length: by
their place in their task, and a prefix sum over tasks. A piece finds its pattern by its number, with a
binary search in the plan; no group of equal lengths is ever gathered.

Null and empty texts are the end id alone. Rows with null or equal ids are documents of their own; an
empty table gives no pieces. Only ``doc_id`` and ``text`` are read."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from buyerlens.llm.encoding import encoder, vocabulary_path
from buyerlens.llm.words import buffers
from buyerlens.session import checkpointed

MOST = 4096
#: Rows (task and length) up to which the tasks' first numbers are broadcast.
BROADCAST_ROWS = 200_000


def _cut(path: str, most: int):
    def run(batches):
        part, seen, enc = TaskContext.get().partitionId(), np.zeros(most + 1, dtype=np.int64), encoder(path, True)
        for batch in batches:
            data, offsets = buffers(batch.column(1))
            for low, high, ids, begin in enc.slices(data, offsets):
                size = np.diff(begin)
                many = -(-size // most)
                of = np.repeat(np.arange(len(size)), many)
                piece = np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)
                start = piece * most
                length = np.minimum(most, size[of] - start)
                raw, at = memoryview(np.ascontiguousarray(ids, dtype="<u4").tobytes()), begin[of] + start
                crc = [zlib.crc32(raw[4 * a : 4 * (a + n)]) for a, n in zip(at.tolist(), length.tolist())]
                order = np.argsort(length, kind="stable")
                first = np.searchsorted(length[order], length[order])
                nth = np.empty(len(of), dtype=np.int64)
                nth[order] = seen[length[order]] + np.arange(len(of)) - first
                seen += np.bincount(length, minlength=most + 1)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column(0).slice(low, high - low).take(pa.array(of)), "piece": pa.array(piece, pa.int32()),
                    "start": pa.array(start), "length": pa.array(length), "ids_crc32": pa.array(crc, pa.int64()),
                    "part": pa.array(np.full(len(of), part), pa.int32()), "nth": pa.array(nth),
                })
    return run


def pieces(docs: DataFrame, most: int = MOST, vocabulary: str | None = None) -> DataFrame:
    """Pieces of all documents, numbered within their task and length; texts are not shuffled."""
    rows = docs.select("doc_id", F.col("text").cast("string"))
    return rows.mapInArrow(
        _cut(vocabulary or vocabulary_path(), most),
        f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long, part int, nth long")


class Sums:
    """Available lengths by single, pair and triple sum."""

    def __init__(self, counts: np.ndarray):
        self.left, self.most = counts.copy(), len(counts) - 1
        self.pairs = np.zeros(self.most + 1, dtype=np.int64)  # unordered pairs by their sum
        there = np.flatnonzero(counts)
        for a in there:
            self._pair(int(a), there[there > a], 1)
            if counts[a] > 1:
                self._pair(int(a), np.array([a]), 1)

    def _pair(self, a: int, others: np.ndarray, change: int) -> None:
        sums = a + others
        self.pairs[sums[sums <= self.most]] += change

    def take(self, length: int, n: int) -> None:
        before = int(self.left[length])
        self.left[length] -= n
        if before > 1 >= before - n:
            self._pair(length, np.array([length]), -1)
        if before > 0 == before - n:
            self._pair(length, np.flatnonzero(self.left), -1)

    def _two(self, total: int) -> tuple[int, ...] | None:
        if total < 2 or not self.pairs[total]:
            return None
        a = np.arange(total - 1, (total - 1) // 2, -1)  # the longer one, longest first
        fits = np.flatnonzero((self.left[a] > 0) & (self.left[total - a] > (a * 2 == total)))
        return (int(a[fits[0]]), int(total - a[fits[0]])) if len(fits) else None

    def _three(self, total: int) -> tuple[int, ...] | None:
        if total < 3:
            return None
        c = np.arange(total - 2, (total - 1) // 3, -1)
        for longest in c[(self.left[c] > 0) & (self.pairs[total - c] > 0)]:
            self.left[longest] -= 1
            two = self._two(int(total - longest))
            self.left[longest] += 1
            if two:
                return (int(longest), *two)
        return None

    def filling(self, gap: int, used: Counter) -> tuple[int, ...] | None:
        """Lengths left beside the ``used`` ones whose sum is ``gap``: one, else two, else three."""
        for length, n in used.items():
            self.left[length] -= n
        found = (gap,) if self.left[gap] > 0 else self._two(gap) or self._three(gap)
        for length, n in used.items():
            self.left[length] += n
        return found

    def longest(self, gap: int, used: Counter) -> int:
        """The longest length left that fits, or 0."""
        there = np.flatnonzero(self.left[1 : gap + 1])[::-1] + 1
        return next((int(x) for x in there if self.left[x] > used[int(x)]), 0)


def plan(counts: np.ndarray) -> list[tuple[int, list[tuple[int, int]]]]:
    """Patterns ``(sequences, [(length, pieces in each), …])`` that use up ``counts[length]`` pieces.

    A pattern is used until one of its lengths runs short, so there are a few patterns per length at most."""
    sums, most, patterns = Sums(counts), len(counts) - 1, []
    for start in range(most, 0, -1):
        while sums.left[start]:
            used, gap = Counter({start: 1}), most - start
            while gap:
                more = sums.filling(gap, used)
                if more is None:
                    # nothing sums up to the gap
                    longest = sums.longest(gap, used)
                    if not longest:
                        break
                    more = (longest,)
                used.update(more)
                gap -= sum(more)
            n = min(int(sums.left[x]) // k for x, k in used.items())
            for x, k in used.items():
                sums.take(x, n * k)
            patterns.append((n, sorted(used.items(), reverse=True)))
    return patterns


def slots(patterns: list[tuple[int, list[tuple[int, int]]]], counts: np.ndarray) -> dict[str, np.ndarray]:
    """The plan as runs of piece numbers, ascending: pieces of a length follow those of smaller lengths.

    A run holds the pieces of one length in one pattern, ``each`` in a sequence."""
    rows, sequence = [], 0
    for n, parts in patterns:
        offset = 0
        for length, each in parts:
            rows.append((length, n * each, sequence, each, offset))
            offset += length * each
        sequence += n
    runs = np.array(rows, dtype=np.int64).reshape(-1, 5)
    runs = runs[np.argsort(runs[:, 0], kind="stable")]
    return {
        "run": np.cumsum(runs[:, 1]) - runs[:, 1], "sequence": runs[:, 2], "each": runs[:, 3], "offset": runs[:, 4],
        "first": np.cumsum(counts) - counts,
    }


def _assigned(found: dict[str, np.ndarray]):
    def run(batches):
        for batch in batches:
            length, number = (batch.column(name).to_numpy() for name in ("length", "number"))
            number = number + found["first"][length]
            at = np.searchsorted(found["run"], number, side="right") - 1
            inside = number - found["run"][at]
            sequence = found["sequence"][at] + inside // found["each"][at]
            offset = found["offset"][at] + inside % found["each"][at] * length
            rest = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*rest, pa.array(sequence), pa.array(offset)], names=[*batch.schema.names[:-1], "sequence_id", "offset"])
    return run


def packed(docs: DataFrame, most: int = MOST, vocabulary: str | None = None) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    cut = checkpointed(pieces(docs, most, vocabulary))
    by_task = cut.groupBy("part", "length").agg(F.count("*").alias("n"))
    counts = np.zeros(most + 1, dtype=np.int64)
    for row in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect():  # a row per length at most
        counts[row["length"]] = row["n"]
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = by_task.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    if by_task.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        before = F.broadcast(before)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    numbered = cut.join(before, ["part", "length"]).select(*columns, (F.col("before") + F.col("nth")).alias("number"))
    schema = numbered.select(*columns).schema.add("sequence_id", "long").add("offset", "long")
    return numbered.mapInArrow(_assigned(slots(plan(counts), counts)), schema)
