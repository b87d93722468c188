"""Near-duplicates by MinHash signatures and a multi-index Hamming join.

A document's set of shingles becomes a signature of 64 lanes of 16 bits. Two sets of similarity ``s``
differ in a lane with probability ``1 - s``, so at 0.85 more than 25 lanes differ once in a million
pairs. The signature is split into 13 chunks: of two signatures that differ in at most 25 lanes, some
chunk has at most one differing lane. Enumerating that one error, each chunk is indexed with each of
its lanes masked, 64 keys a document, and any such pair meets under a key: the index loses none.

Exact copies are one node from the start. Pairs are never expanded within a bucket. Instead

1. each member of a bucket is compared with the bucket's least member, links are confirmed on the full
   sets, and linked documents become one component;
2. buckets that still hold several components are tried again with another member, drawn by hash;
3. what is left is compared exactly, across components only, in tiles of a bounded number of rows. Rows
   bring the least values of their set along, so only pairs leave the tile, under the first key that
   they share, whose sets are similar enough: exactly so for sets that are whole there, by the share
   among the least values of the union for larger ones.

A link skipped in step 3 would join documents that are already in one component.

Null and empty texts have no shingle and are linked with nothing. Rows with the same ``doc_id`` are one
node. A row without ``doc_id`` is linked with nothing, its component is null, and it is kept."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from buyerlens.llm.components import components
from buyerlens.llm.words import buffers, mix, numbers, shingles, slices, words
from buyerlens.session import checkpointed

SHINGLE = 5
PERCENT = 85
LANES = 64
CHUNKS = 13
MAX_DISTANCE = 2 * CHUNKS - 1
TILE = 2048
BROADCAST_IDS = 1 << 20
#: Different members that the buckets of one group try in the second round.
PIVOTS = 4
PAIRS_AT_ONCE = 1 << 16
#: Values of a set that a tile sees, and how many of the union's least two similar sets share: five
#: deviations below the mean.
SKETCH = 1024
SKETCH_SHARED = int(SKETCH * PERCENT / 100 - 5 * (SKETCH * PERCENT * (100 - PERCENT) / 10**4) ** 0.5)

_LANE = numbers(LANES, 101) | np.uint64(1)
_CHUNK_OF = np.arange(LANES) * CHUNKS // LANES
_CHUNK_LANES = [np.flatnonzero(_CHUNK_OF == c) for c in range(CHUNKS)]
_LANE_SALT = numbers(LANES, 103)


def _signatures(value: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Lanes of each row, zero for rows without shingles."""
    out = np.zeros((len(first) - 1, LANES), dtype=np.uint16)
    filled = np.flatnonzero(np.diff(first) > 0)
    if len(filled):
        starts = first[filled]
        for lane in range(LANES):
            low = np.minimum.reduceat(value * _LANE[lane], starts)
            out[filled, lane] = (mix(low) >> np.uint64(24)).astype(np.uint16)
    return out


def _fingerprints(batches):
    for batch in batches:
        data, offsets = buffers(batch.column(1))
        for low, high in slices(offsets):
            w = words(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
            value, first = shingles(w, SHINGLE)
            zero = np.zeros(1, dtype=np.uint64)
            one, two = (np.concatenate([zero, np.cumsum(mix(value ^ salt))]) for salt in numbers(2, 107))
            lanes = _signatures(value, first)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0).slice(low, high - low),
                "n": pa.array(np.diff(first), pa.int64()),
                "f1": pa.array((one[first[1:]] - one[first[:-1]]).view(np.int64)),
                "f2": pa.array((two[first[1:]] - two[first[:-1]]).view(np.int64)),
                "lanes": pa.array([row.tobytes() for row in lanes], pa.binary()),
            })


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id``, set size ``n``, the set's 128-bit fingerprint ``f1, f2`` and its signature ``lanes``."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _fingerprints, "doc_id long, n long, f1 long, f2 long, lanes binary",
    )


def _lane_matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint16).reshape(-1, LANES)


def _masked_keys(lanes: np.ndarray) -> np.ndarray:
    """The 64 keys of each signature: a chunk's lanes without one of them, for each lane."""
    spread = mix(lanes.astype(np.uint64) + _LANE_SALT)
    total = np.stack([spread[:, ids].sum(axis=1, dtype=np.uint64) for ids in _CHUNK_LANES], axis=1)
    return mix(total[:, _CHUNK_OF] - spread + _LANE_SALT)


def _masked_key(lanes: np.ndarray, lane: np.ndarray) -> np.ndarray:
    """Of the 64 keys of each signature the one that masks the given lane."""
    spread = mix(lanes.astype(np.uint64) + _LANE_SALT)
    chunk = np.where(_CHUNK_OF[None, :] == _CHUNK_OF[lane][:, None], spread, np.uint64(0)).sum(axis=1, dtype=np.uint64)
    return mix(chunk - spread[np.arange(len(lane)), lane] + _LANE_SALT[lane])


def _keys(batches):
    for batch in batches:
        for low in range(0, batch.num_rows, 4096):
            part = batch.slice(low, 4096)
            keys = _masked_keys(_lane_matrix(part.column(1))).view(np.int64)
            yield pa.RecordBatch.from_pydict({
                "key": pa.array(keys.ravel()), "id": pa.array(np.repeat(part.column(0).to_numpy(), LANES))})


def _distance(a: pa.Array, b: pa.Array) -> pa.Array:
    return pa.array((_lane_matrix(a) != _lane_matrix(b)).sum(axis=1), pa.int32())


def _shared(a: pa.Array, b: pa.Array) -> pa.Array:
    """Size of the intersection of two sorted sets."""
    out = np.empty(len(a), dtype=np.int64)
    for i, (x, y) in enumerate(zip(a, b)):
        x, y = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
        at = np.minimum(np.searchsorted(y, x), len(y) - 1)
        out[i] = np.count_nonzero(y[at] == x)
    return pa.array(out)


def _sets(cut):
    def run(batches):
        for batch in batches:
            data, offsets = buffers(batch.column(1))
            for low, high in slices(offsets):
                value, first = shingles(words(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]), SHINGLE)
                yield pa.RecordBatch.from_pydict({
                    "id": batch.column(0).slice(low, high - low),
                    "set": pa.array([cut(value[i:j]).tobytes() for i, j in zip(first, first[1:])], pa.binary()),
                })
    return run


def _least(values: np.ndarray) -> np.ndarray:
    """The upper halves of the least values, in order and not made distinct, so that two sets share at
    least as many of them as they share values."""
    return (values[:SKETCH] >> np.uint64(32)).astype(np.uint32)


def _sets_of(docs: DataFrame, wanted: DataFrame, cut=lambda values: values) -> DataFrame:
    """``id, set``: what ``cut`` leaves of the sorted sets of the distinct ids in ``wanted(doc_id)``."""
    if wanted.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)  # else the texts of all documents would be shuffled for a few
    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(wanted, "doc_id", "left_semi")
    return source.mapInArrow(_sets(cut), "id long, set binary")


def _near(nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """Pairs whose set sizes allow the similarity and whose signatures are near enough."""
    a, b = (nodes.select(F.col("id").alias(x), F.col("n").alias(f"n{x}"), F.col("lanes").alias(f"l{x}")) for x in "ab")
    sized = pairs.join(a, "a").join(b, "b").where(f"100 * least(na, nb) >= {PERCENT} * greatest(na, nb)")
    distance = F.arrow_udf(_distance, "int")
    return sized.where(distance("la", "lb") <= MAX_DISTANCE).select("a", "b")


def confirm(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """Pairs ``(a, b)`` whose full sets are similar enough."""
    sets = _sets_of(docs, pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct())
    shared = F.arrow_udf(_shared, "long")
    both = (
        pairs.join(sets.select(F.col("id").alias("a"), F.col("set").alias("sa")), "a")
        .join(sets.select(F.col("id").alias("b"), F.col("set").alias("sb")), "b")
        .withColumn("k", shared("sa", "sb"))
    )
    union = (F.length("sa") + F.length("sb")).cast("long") / 8 - F.col("k")
    return both.where(100 * F.col("k") >= PERCENT * union).select("a", "b").distinct()


def _group_bounds(*columns: np.ndarray) -> np.ndarray:
    new = np.zeros(len(columns[0]), dtype=bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.append(np.flatnonzero(new), len(new))


def _pairs_of(sizes: np.ndarray, starts: np.ndarray):
    """Index pairs within groups, in pieces of a bounded number."""
    total = sizes.astype(np.int64) ** 2
    low = 0
    while low < len(sizes):
        high = max(low + 1, int(np.searchsorted(np.cumsum(total[low:]), PAIRS_AT_ONCE, side="right")) + low)
        n = sizes[low:high]
        if total[low] > PAIRS_AT_ONCE:
            rows, step = int(n[0]), max(1, PAIRS_AT_ONCE // int(n[0]))
            for top in range(0, rows, step):
                i, j = np.divmod(np.arange(top * rows, min(top + step, rows) * rows), rows)
                yield starts[low] + i[i < j], starts[low] + j[i < j]
            low = high
            continue
        member = np.repeat(np.arange(high - low), n)
        left = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        times = n[member]
        i = np.repeat(starts[low:high][member] + left, times)
        j = np.repeat(starts[low:high][member], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        yield i[i < j], j[i < j]
        low = high


def _first_lane(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The first lane whose masking makes the two signatures' chunks equal."""
    differs = x != y
    errors = np.stack([differs[:, ids].sum(axis=1) for ids in _CHUNK_LANES], axis=1)
    meets = (errors[:, _CHUNK_OF] - differs) == 0
    return np.argmax(meets, axis=1)


def _may_link(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two sets, given by their least values in order, can be similar enough."""
    same = x[y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x]
    if max(len(x), len(y)) < SKETCH:
        return 100 * len(same) >= PERCENT * (len(x) + len(y) - len(same))
    last = np.union1d(x, y)[SKETCH - 1]
    return np.searchsorted(same, last, side="right") >= SKETCH_SHARED


def _compare(key, tile_a, tile_b, id_, component, n, tile, lanes, sets):
    starts = _group_bounds(key, tile_a, tile_b)
    for i, j in _pairs_of(np.diff(starts), starts[:-1]):
        ok = (component[i] != component[j]) & (100 * np.minimum(n[i], n[j]) >= PERCENT * np.maximum(n[i], n[j]))
        # in a group of two tiles, pairs within one tile are compared elsewhere
        ok &= (tile_a[i] == tile_b[i]) | (tile[i] != tile[j])
        i, j = i[ok], j[ok]
        ok = (lanes[i] != lanes[j]).sum(axis=1) <= MAX_DISTANCE
        i, j = i[ok], j[ok]
        if len(i):
            first = _masked_key(lanes[i], _first_lane(lanes[i], lanes[j]))
            ok = first.view(np.int64) == key[i]
            i, j = i[ok], j[ok]
            known = {r: np.frombuffer(sets[r].as_buffer(), dtype=np.uint32) for r in np.unique(np.append(i, j)).tolist()}
            ok = np.fromiter((_may_link(known[x], known[y]) for x, y in zip(i.tolist(), j.tolist())), dtype=bool, count=len(i))
            i, j = i[ok], j[ok]
        yield pa.RecordBatch.from_pydict({
            "a": pa.array(np.minimum(id_[i], id_[j])), "b": pa.array(np.maximum(id_[i], id_[j])),
        })


def _tiles(batches):
    """Rows sorted by (key, tile_a, tile_b); a group that goes on in the next batch is carried there."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table])
        columns = [table.column(i).to_numpy() for i in range(7)]
        bounds = _group_bounds(*columns[:3])
        cut = int(bounds[-2]) if len(bounds) > 1 else 0
        if cut:
            yield from _compare(*(c[:cut] for c in columns), _lane_matrix(table.column(7).slice(0, cut)), table.column(8))
        rest = table.slice(cut).combine_chunks()
    if rest is not None and rest.num_rows:
        yield from _compare(*(rest.column(i).to_numpy() for i in range(7)), _lane_matrix(rest.column(7)), rest.column(8))


def _left_over(busy: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Key rows with their component, and the buckets that hold more than one, with their size."""
    rows = busy.join(labels, "id", "left").select("key", "id", F.coalesce("component", "id").alias("component"))
    buckets = rows.groupBy("key").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("size"),
        F.min(F.struct(F.xxhash64("id", F.pmod("key", F.lit(PIVOTS))).alias("h"), "id", "component")).alias("pivot"),
    ).where("low <> high").drop("low", "high")
    return rows, buckets


def _links(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Confirmed links between nodes, or a component's star, enough to connect all that any links connect."""
    keys = nodes.select("id", "lanes").mapInArrow(_keys, "key long, id long")
    shared = keys.groupBy("key").agg(F.min("id").alias("a"), F.count("*").alias("size")).where("size > 1").drop("size")
    # most keys are one document's alone; only the others are looked at again
    busy = checkpointed(keys.join(shared, "key").select("key", "id", "a"))
    pairs = busy.where("id <> a").select("a", F.col("id").alias("b")).distinct()
    labels = checkpointed(components(confirm(docs, checkpointed(_near(nodes, pairs)))))

    rows, buckets = _left_over(busy, labels)
    again = (
        rows.join(buckets.select("key", "pivot"), "key").where("component <> pivot.component")
        .select(F.least("id", "pivot.id").alias("a"), F.greatest("id", "pivot.id").alias("b")).distinct()
    )
    # what is connected by now is passed on as one link for each document to its component
    stars = labels.select(F.col("id").alias("a"), F.col("component").alias("b"))
    labels = checkpointed(components(stars.unionAll(confirm(docs, checkpointed(_near(nodes, again))))))

    rows, buckets = _left_over(busy, labels)
    # two rows of a bucket were both tried already: one of them is the pivot of the round before
    buckets = buckets.where("size > 2").select("key", F.ceil(F.col("size") / TILE).cast("int").alias("tiles"))
    dealt = rows.join(buckets, "key").withColumn("tile", F.pmod(F.xxhash64("id"), "tiles").cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).select(
        "key", F.least("tile", "other").alias("tile_a"), F.greatest("tile", "other").alias("tile_b"), "id", "component", "tile")
    order = ["key", "tile_a", "tile_b"]
    dealt = checkpointed(dealt)
    sets = _sets_of(docs, dealt.select(F.col("id").alias("doc_id")).distinct(), _least)
    full = dealt.join(nodes.join(sets, "id"), "id").select(*order, "id", "component", "n", "tile", "lanes", "set")
    last = full.repartition(*order).sortWithinPartitions(*order).mapInArrow(_tiles, "a long, b long")
    stars = labels.select(F.col("id").alias("a"), F.col("component").alias("b"))
    return stars.unionAll(confirm(docs, checkpointed(last)))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept."""
    prints = checkpointed(fingerprints(docs))
    filled = prints.where("n > 0 and doc_id is not null")
    nodes = checkpointed(
        filled.groupBy("f1", "f2", "n").agg(F.min("doc_id").alias("id"), F.first("lanes").alias("lanes"))
    )
    # an id with several texts connects their nodes
    same = prints.where("doc_id is not null").groupBy("doc_id").agg(
        F.count_distinct("f1", "f2", "n").alias("texts")).where("texts > 1").select("doc_id")
    member = filled.select("doc_id", "f1", "f2", "n").join(nodes.drop("lanes"), ["f1", "f2", "n"])
    joined = member.join(same, "doc_id").select(F.col("doc_id").alias("a"), F.col("id").alias("b"))
    labels = checkpointed(components(_links(docs, nodes).unionAll(joined)))
    # ids that are not their node's least one reach it through the node
    of_doc = member.select("doc_id", "id").distinct().join(labels, "id", "left").groupBy("doc_id").agg(
        F.min(F.coalesce("component", "id")).alias("component_id"))
    return (
        prints.select("doc_id", F.col("n").alias("n_shingles")).join(of_doc, "doc_id", "left")
        .withColumn("component_id", F.when(F.col("n_shingles") > 0, F.coalesce("component_id", "doc_id")).otherwise(F.col("doc_id")))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def keep_representatives(docs: DataFrame) -> DataFrame:
    """Rows of ``docs``, with all their columns, whose document stays. Repeated rows of an id that stays
    are the same document and stay together."""
    dropped = near_duplicates(docs).where("not kept").select("doc_id").distinct()
    return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)
