"""Mixing sources to target weights by fitting each source's word budget as a subset sum.

A source's target is met with whole passes over its documents and a rest. For the rest, documents are
counted by their exact length; each length gives its share, rounded down, and a bounded knapsack fills
what rounding left. Which documents of a length are taken follows a seeded hash of their id.

The only tables of unusual shape are small: one row per source, and one per source and length. A hot
source or length is cut into buckets of some thousand documents by the hash, so no task holds a group.

Null texts have size 0, a null source is a source of its own, repeated rows are documents of their own;
ties are broken by id, and rows that tie there as well are alike. An empty table gives an empty mix."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from buyerlens.session import checkpointed

WEIGHTS = (1, 2, 3)
MOST_COPIES = 3
SEED = 20_240
BUCKET = 4096
BROADCAST_ROWS = 200_000
#: Steps that one knapsack may take, and the words it is left with where a source needs more.
KNAPSACK_STEPS = 100_000_000
KNAPSACK_WORDS = 1 << 16
_WORD = r"[^\x20\x09-\x0D]+"

# names that an input is unlikely to have
_KEY, _SIZE, _HASH, _BUCKET, _RANK = "__mix_key", "__mix_size", "__mix_hash", "__mix_bucket", "__mix_rank"


def sized(docs: DataFrame) -> DataFrame:
    """``docs`` with its size and its source as a key that is never null."""
    source = F.col("source").cast("string")
    return docs.withColumns({
        _SIZE: F.regexp_count(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(_WORD)).cast("long"),
        _KEY: F.when(source.isNull(), F.lit("null")).otherwise(F.concat(F.lit("="), source)),
    })


def targets(by_length: DataFrame, weights: tuple = WEIGHTS) -> DataFrame:
    """Per source: key, source_size, target. The windows run over one row per source.

    Targets share the size of all by weight and stop at three times the source's size. With the sources
    in order of cap by weight, the level ``(all - caps before) / weights from here`` is the one at which
    nothing is left to share out again, at the first source that it doesn't reach the cap of."""
    sources = by_length.groupBy(_KEY).agg(F.sum(F.col(_SIZE) * F.col("n")).cast("long").alias("source_size"))
    last = (F.col(_KEY) == "null").cast("int")
    turn = F.pmod(F.row_number().over(Window.orderBy(last, _KEY)) - 1, F.lit(len(weights)))
    weighed = sources.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")).cast("double"))
    capped = weighed.withColumn("cap", (MOST_COPIES * F.col("source_size")).cast("double")).withColumn("ratio", F.col("cap") / F.col("w"))
    order = Window.orderBy("ratio", _KEY)
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    after = F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing))
    everything = F.sum("source_size").over(Window.partitionBy())
    levels = capped.withColumn("level", (everything - before) / after)
    level = F.first(F.when(F.col("level") <= F.col("ratio"), F.col("level")), ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    # sums of doubles can leave the last level a hair above its cap
    level = F.coalesce(level, F.max("ratio").over(Window.partitionBy()))
    return levels.withColumn("target", F.least("cap", level * F.col("w"))).select(_KEY, "source_size", "target")


def fit_lengths(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length to take for a sum near ``budget``; never more than there are."""
    take = np.zeros(len(lengths), dtype=np.int64)
    useful = np.flatnonzero(lengths > 0)
    total = int((lengths * counts).sum())
    if not len(useful) or budget <= 0:
        return take
    if budget >= total:
        return np.where(lengths > 0, counts, 0)
    take[useful] = [int(c) * budget // total for c in counts[useful]]
    rest = budget - int((take * lengths).sum())
    left = counts - take
    if rest * len(useful) > KNAPSACK_STEPS:
        for i in useful[np.argsort(-lengths[useful])]:
            # one more of a length is what rounding down can have cost it
            if rest <= KNAPSACK_WORDS:
                break
            if left[i] and lengths[i] <= rest:
                take[i], left[i], rest = take[i] + 1, left[i] - 1, rest - int(lengths[i])
    for i, n in _knapsack(lengths, left, useful, rest).items():
        take[i] += n
    return take


def _knapsack(lengths, left, useful, rest: int) -> dict[int, int]:
    """Bounded knapsack: the documents whose sum is nearest to ``rest``."""
    open_ = [i for i in useful if left[i]]
    if not open_ or rest <= 0:
        return {}
    room = rest + int(min(lengths[i] for i in open_))
    reached = np.zeros(room + 1, dtype=bool)
    reached[0] = True
    owner = np.full(room + 1, -1, dtype=np.int32)
    items: list[tuple[int, int]] = []
    # the middle lengths first: their sums are dense, and what is taken stays usual
    for i in sorted(open_, key=lambda i: (abs(int(lengths[i]) - int(np.median(lengths[open_]))), i)):
        many, power = int(min(left[i], room // int(lengths[i]))), 1
        while many > 0:
            n = min(power, many)
            many, power, step = many - n, power * 2, n * int(lengths[i])
            new = reached[: room + 1 - step] & ~reached[step:]
            owner[step:][new] = len(items)
            items.append((int(i), n))
            reached[step:] |= new
        if reached[rest]:
            break
    sums = np.flatnonzero(reached)
    at = int(sums[np.argmin(np.abs(sums - rest))])
    taken: dict[int, int] = {}
    while at:
        i, n = items[owner[at]]
        taken[i] = taken.get(i, 0) + n
        at -= n * int(lengths[i])
    return taken


def _plan(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values(_SIZE, ignore_index=True)
    size, target = int(group["source_size"].iloc[0]), float(group["target"].iloc[0])
    passes = min(MOST_COPIES, int(target // size)) if size else 0
    rest = round(target - passes * size) if passes < MOST_COPIES else 0
    lengths, counts = group[_SIZE].to_numpy(np.int64), group["n"].to_numpy(np.int64)
    return group[[_KEY, _SIZE, "source_size", "target"]].assign(
        passes=passes, take=fit_lengths(lengths, counts, rest), buckets=-(-counts // BUCKET))


def plan(by_length: DataFrame, weights: tuple = WEIGHTS) -> DataFrame:
    """Per source and length: whole passes, documents taken once more, and buckets.

    A task gets the lengths of one source: as many rows as its documents have different lengths."""
    rows = by_length.join(targets(by_length, weights), _KEY)
    return rows.groupBy(_KEY).applyInPandas(
        _plan, f"{_KEY} string, {_SIZE} long, source_size long, target double, passes int, take long, buckets long")


def mixed(docs: DataFrame, weights: tuple = WEIGHTS, seed: int = SEED) -> DataFrame:
    """``docs`` with ``__mix_size``, ``__mix_source_size``, ``__mix_target`` and ``__mix_copies``."""
    rows = sized(docs)
    by_length = checkpointed(rows.groupBy(_KEY, _SIZE).agg(F.count("*").alias("n")))
    planned = checkpointed(plan(by_length, weights))
    small = planned.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    names = {"source_size": "__mix_source_size", "target": "__mix_target", "passes": "__mix_passes", "take": "__mix_take",
             "buckets": "__mix_buckets"}
    side = planned.withColumnsRenamed(names)
    dealt = rows.join(F.broadcast(side) if small else side, [_KEY, _SIZE]).withColumn(
        _HASH, F.xxhash64(F.lit(seed), "doc_id")).withColumn(_BUCKET, F.pmod(_HASH, "__mix_buckets"))
    group = [_KEY, _SIZE, _BUCKET]
    counts = dealt.groupBy(*group).agg(F.count("*").alias("__mix_n"))
    earlier = Window.partitionBy(_KEY, _SIZE).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(*group, F.coalesce(F.sum("__mix_n").over(earlier), F.lit(0)).alias("__mix_before"))
    ranked = dealt.join(before, group).withColumn(
        _RANK, F.row_number().over(Window.partitionBy(*group).orderBy(_HASH, "doc_id")))
    once_more = (F.col("__mix_before") + F.col(_RANK) <= F.col("__mix_take")).cast("int")
    return ranked.withColumn("__mix_copies", F.col("__mix_passes") + once_more).select(
        *docs.columns, _SIZE, "__mix_source_size", "__mix_target", "__mix_copies")


def mix_report(docs: DataFrame, weights: tuple = WEIGHTS, seed: int = SEED) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target, taken."""
    return mixed(docs.select("doc_id", "text", "source"), weights, seed).select(
        "doc_id", F.col(_SIZE).alias("size"), F.col("__mix_source_size").alias("source_size"),
        F.col("__mix_target").alias("target"), (F.col(_SIZE) * F.col("__mix_copies")).alias("taken"))


def mix(docs: DataFrame, weights: tuple = WEIGHTS, seed: int = SEED) -> DataFrame:
    """The mix itself: rows of ``docs``, as often as they are taken."""
    copies = mixed(docs, weights, seed).where("__mix_copies > 0")
    return copies.withColumn("__mix_copy", F.explode(F.sequence(F.lit(1), "__mix_copies"))).select(*docs.columns)
