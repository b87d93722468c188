"""Exact ranks without a single-task sort.

Every rank-based score here is a step function of the row's position in a total
order. It is enough to find the few rows at which the step changes; scoring is
then a comparison with constants. The rows are found with one range-partitioned
sort of narrow (metric, value, id) rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from itertools import accumulate

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from buyerlens.functions.scalars import HASH_POSITIONS, hash_position

QUINTILES = 5


@dataclass(frozen=True)
class MetricOrder:
    """Size, bounds and requested rows ``rank -> (value, id)`` of one metric."""

    n: int
    low: float | None
    high: float | None
    rows: dict[int, tuple[float, str | None]]

    @property
    def constant(self) -> bool:
        return self.n == 0 or self.low == self.high


def order_statistics(
    df: DataFrame,
    metrics: dict[str, Column],
    ranks: Callable[[int], Sequence[int]],
    id_column: str | None = None,
) -> dict[str, MetricOrder]:
    """Rows at the 1-based ``ranks(n)`` of each metric, ordered by (value, id).

    Nulls are left out. Only the sizes of the range partitions and the requested
    rows reach the driver. The id is part of the range key, so a value shared by
    most rows does not end up in one partition."""
    names = list(metrics)
    identifier = F.col(id_column).cast("string") if id_column else F.lit(None).cast("string")
    entries = F.array(*[
        F.struct(F.lit(i).alias("metric"), metrics[name].cast("double").alias("value"))
        for i, name in enumerate(names)
    ])
    placed = (
        df.select(identifier.alias("id"), F.explode(entries).alias("e"))
        .select("e.metric", "e.value", "id")
        .where("value IS NOT NULL")
        .repartitionByRange("metric", "value", "id")
        .sortWithinPartitions("metric", "value", "id")
        # partition number in the high bits, position inside it in the low 33
        .withColumn("place", F.monotonically_increasing_id())
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    try:
        blocks = (
            placed.groupBy(F.shiftright("place", 33).alias("part"), "metric")
            .agg(
                F.count(F.lit(1)).alias("n"), F.min("place").alias("start"),
                F.min("value").alias("low"), F.max("value").alias("high"),
            )
            .orderBy("metric", "part")
            .collect()
        )
        wanted: dict[int, list[tuple[str, int]]] = {}
        result: dict[str, MetricOrder] = {}
        for i, name in enumerate(names):
            own = [b for b in blocks if b["metric"] == i]
            n = sum(b["n"] for b in own)
            result[name] = MetricOrder(
                n, own[0]["low"] if own else None, own[-1]["high"] if own else None, {}
            )
            before = [0, *accumulate(b["n"] for b in own)]
            for rank in {r for r in ranks(n) if 1 <= r <= n}:
                k = max(j for j in range(len(own)) if before[j] < rank)
                place = own[k]["start"] + rank - before[k] - 1
                wanted.setdefault(place, []).append((name, rank))
        if wanted:
            for row in placed.where(F.col("place").isin(list(wanted))).collect():
                for name, rank in wanted[row["place"]]:
                    result[name].rows[rank] = (row["value"], row["id"])
        return result
    finally:
        placed.unpersist()


def value_ranks(df: DataFrame, metrics: dict[str, Column],
                ranks: Callable[[int], Sequence[int]]) -> dict[str, dict[int, float]]:
    """The values at the 1-based ``ranks(n)`` of each metric, nulls left out.

    Equal values are counted before they are sorted, so a value that most rows share is one row."""
    names = list(metrics)
    entries = F.array(*[
        F.struct(F.lit(i).alias("metric"), metrics[name].cast("double").alias("value")) for i, name in enumerate(names)
    ])
    counts = (
        df.select(F.explode(entries).alias("e")).select("e.metric", "e.value").where("value IS NOT NULL")
        .groupBy("metric", "value").count()
    )
    placed = (
        counts.repartitionByRange("metric", "value").withColumn("part", F.spark_partition_id())
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    try:
        blocks = placed.groupBy("metric", "part").agg(F.sum("count").alias("n")).orderBy("metric", "part").collect()
        found: dict[str, dict[int, float]] = {name: {} for name in names}
        wanted = []
        for i, name in enumerate(names):
            own = [b for b in blocks if b["metric"] == i]
            before = [0, *accumulate(b["n"] for b in own)]
            for rank in {r for r in ranks(before[-1]) if 1 <= r <= before[-1]}:
                k = max(j for j in range(len(own)) if before[j] < rank)
                wanted.append((i, own[k]["part"], rank - before[k], rank))
        if wanted:
            last = F.sum("count").over(
                Window.partitionBy("metric", "part").orderBy("value").rowsBetween(Window.unboundedPreceding, 0))
            asked = df.sparkSession.createDataFrame(wanted, "metric int, part int, inside bigint, rank bigint")
            hits = placed.withColumn("last", last).join(asked, ["metric", "part"]).where(
                (F.col("inside") <= F.col("last")) & (F.col("inside") > F.col("last") - F.col("count")))
            for row in hits.select("metric", "rank", "value").collect():
                found[names[row["metric"]]][row["rank"]] = row["value"]
        return found
    finally:
        placed.unpersist()


def _after(value: Column, identifier: Column, cut: tuple[float, str | None]) -> Column:
    cut_value, cut_id = F.lit(cut[0]), F.lit(cut[1])
    return (value > cut_value) | ((value == cut_value) & (identifier > cut_id))


def quintile_cuts(n: int) -> list[int]:
    """Last rank of scores 1 to 4 when ranks 1..n are cut into equal widths."""
    return [k * (n - 1) // QUINTILES + 1 for k in range(1, QUINTILES)] if n > 1 else []


def add_quintile_scores(
    df: DataFrame, id_column: str, scores: dict[str, tuple[str, bool]]
) -> DataFrame:
    """Add scores 1-5 by equal-width cuts of the rank; ties are ranked by id.

    ``scores`` maps the new column to (value column, ascending). A column with a
    single value scores 1 everywhere; a null value has no score. ``df`` is read
    twice: materialise it first when it is expensive."""
    signed = {
        name: F.col(column).cast("double") if ascending else -F.col(column).cast("double")
        for name, (column, ascending) in scores.items()
    }
    found = order_statistics(df, signed, quintile_cuts, id_column)
    identifier = F.col(id_column).cast("string")
    added = {}
    for name, value in signed.items():
        score = F.lit(1)
        if not found[name].constant:
            # with few rows several cuts fall on the same row; each counts
            for rank in quintile_cuts(found[name].n):
                after = _after(value, identifier, found[name].rows[rank])
                score = score + F.when(after, 1).otherwise(0)
        added[name] = F.when(value.isNotNull(), score).cast("int")
    return df.withColumns(added)


def add_percent_rank_quintiles(df: DataFrame, scores: dict[str, tuple[str, bool]]) -> DataFrame:
    """Add scores 1-5 by the average-rank percentile; equal values score alike.

    The percentile depends on the value alone, so the values are counted first
    and only distinct values are sorted."""
    added = {}
    for name, (column, ascending) in scores.items():
        value = F.col(column).cast("double") if ascending else -F.col(column).cast("double")
        cuts = _percent_rank_cuts(df, value)
        score = F.lit(1)
        for cut in cuts:
            above = F.lit(True) if cut is None else value > F.lit(cut)
            score = score + F.when(above, 1).otherwise(0)
        added[name] = F.when(value.isNotNull(), score).cast("int")
    return df.withColumns(added)


def _percent_rank_cuts(df: DataFrame, value: Column) -> list[float | None]:
    """Largest value whose average-rank percentile is at most k/5, for k = 1..4."""
    counts = df.select(value.alias("value")).where("value IS NOT NULL").groupBy("value").count()
    placed = (
        counts.repartitionByRange("value")
        .withColumn("part", F.spark_partition_id())
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    try:
        blocks = placed.groupBy("part").agg(F.sum("count").alias("n")).orderBy("part").collect()
        if not blocks:
            return []
        n = sum(b["n"] for b in blocks)
        starts = df.sparkSession.createDataFrame(
            list(zip((b["part"] for b in blocks), accumulate((b["n"] for b in blocks), initial=0))),
            "part int, before bigint",
        )
        inside = F.sum("count").over(
            Window.partitionBy("part").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
        )
        # twice the average rank of a run of equal values is 2 * last - count + 1
        doubled = 2 * (F.col("before") + inside) - F.col("count") + 1
        cuts = placed.join(starts, "part").select("value", doubled.alias("doubled")).agg(*[
            F.max(F.when(F.col("doubled") * QUINTILES <= F.lit(2 * k * n), F.col("value"))).alias(f"c{k}")
            for k in range(1, QUINTILES)
        ]).first()
        return list(cuts)
    finally:
        placed.unpersist()


def sample_exact(df: DataFrame, id_column: str, size: int, seed: int) -> DataFrame:
    """``size`` rows without replacement: the first in a seeded hash order of the id.

    The rows are chosen by one threshold, so a large sample needs no global sort
    of whole rows."""
    position = hash_position(F.col(id_column), seed).cast("double")
    return _first_in_order(df, id_column, position, lambda n: min(size, n))


def sample_fraction(df: DataFrame, id_column: str, fraction: float, seed: int) -> DataFrame:
    """``max(int(n * fraction), 2)`` rows without replacement, see :func:`sample_exact`."""
    position = hash_position(F.col(id_column), seed).cast("double")
    return _first_in_order(df, id_column, position, lambda n: min(max(int(n * fraction), 2), n))


def in_samples(df: DataFrame, id_column: str, fraction: float, seeds: list[int]) -> list[Column]:
    """Per seed, whether a row is among those that ``sample_fraction`` takes; all cuts are found in one pass."""
    size = lambda n: min(max(int(n * fraction), 2), n)
    positions = {f"p{i}": hash_position(F.col(id_column), seed).cast("double") for i, seed in enumerate(seeds)}
    found = order_statistics(df, positions, lambda n: [size(n)], id_column)
    return [
        F.lit(True) if found[name].n == size(found[name].n)
        else ~_after(position, F.col(id_column).cast("string"), found[name].rows[size(found[name].n)])
        for name, position in positions.items()]


def first_by_hash(df: DataFrame, id_column: str, rows: int, seed: int) -> DataFrame:
    """The first ``rows`` rows in the seeded hash order of the id, for small ``rows``.

    On a large table a threshold on the hash first leaves slightly more than
    ``rows`` candidates in all, so that no task hands over its own top rows. Should
    the candidates not suffice, the whole table is ordered instead."""
    position = hash_position(F.col(id_column), seed)
    total = df.count()
    candidates = df
    expected = rows + 10 * math.isqrt(rows) + 100
    if total > 2 * expected:
        below = df.where(position < HASH_POSITIONS * expected // total)
        if below.count() >= rows:
            candidates = below
    return candidates.orderBy(position, F.col(id_column).cast("string")).limit(rows)


def _first_in_order(df: DataFrame, id_column: str, value: Column, size: Callable[[int], int]) -> DataFrame:
    found = order_statistics(df, {"p": value}, lambda n: [size(n)], id_column)["p"]
    if found.n == size(found.n):
        return df
    cut = found.rows[size(found.n)]
    return df.where(~_after(value, F.col(id_column).cast("string"), cut))


def last_per_key(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """The last row of every key in ``order_by``, then in all other columns."""
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    window = Window.partitionBy(*keys).orderBy(
        *[F.col(c).desc_nulls_last() for c in [*order_by, *rest]]
    )
    return df.withColumn("_row", F.row_number().over(window)).where("_row = 1").drop("_row")


def disambiguate_labels(df: DataFrame, base: str, order_by: str, out: str, by: list[str] | None = None) -> DataFrame:
    """Second and later uses of a base label get ``_2``, ``_3`` … in order, among rows that agree in ``by``."""
    nth = F.row_number().over(Window.partitionBy(*(by or []), base).orderBy(order_by))
    suffix = F.when(nth > 1, F.concat(F.lit("_"), nth.cast("string"))).otherwise("")
    return df.withColumn(out, F.concat(F.col(base), suffix))
