"""A Merkle manifest of documents: a tree per source, a tree over the sources, and a proof per document.

A node has up to three children. Nodes of a source lie in the order of their ids, and a window over 81 of
them climbs four levels at once: a node of level ``k`` sits on the row of its first leaf, so its siblings
are found ``3 ** k`` and ``2 * 3 ** k`` rows behind and ahead by lag and lead of fixed offsets, masked by the node's slot
and the length of its level, and the row of a first child hashes the parent. The rows that head a block
are the nodes of the next pass, 81 times fewer. A source of any size is cut into blocks of 81 rows, so no
task holds a group. On the way back the steps above a block join its rows, which already lie by block.

The place of a row within its source comes from one range exchange of narrow rows: runs of a source
within a partition are counted, and a prefix sum over the runs gives each run its first place.

Null ids come first, rows of one id follow their digest, and rows alike in all fields are alike in all
results but their place. A null field is ``-``, a null source a source of its own, before all others. A
document with null id is never tampered with. Only the five columns are read. An empty table has no row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from buyerlens.operators.sizing import broadcast_if_small
from buyerlens.session import checkpointed

ARITY = 3
#: Levels that one window climbs, and the nodes under it.
LEVELS = 4
BLOCK = ARITY**LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
STEPS = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A field with its length in bytes, so that no two rows spell the same input."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaves(docs: DataFrame) -> DataFrame:
    """``key, doc_id, h, tampered``: the digest of each row, and of what became of it."""
    fields = {name: F.col(name) for name in FIELDS}
    altered = fields | {"text": F.replace(F.col("text").cast("string"), F.lit("\n"), F.lit(""))}
    own = digest(*map(field, fields.values()))
    hit = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    return docs.select(
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("key"), "doc_id", own.alias("h"),
        F.when(hit, digest(*map(field, altered.values()))).otherwise(own).alias("tampered"))


def placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with their place ``pos`` among the ``n`` rows of their key."""
    ordered = rows.repartitionByRange("key", *order).sortWithinPartitions("key", *order)
    laid = checkpointed(ordered.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("row")))
    # one row per partition, and per key that begins in it
    runs = laid.groupBy("key", "part").agg(F.min("row").alias("first"), F.count("*").alias("rows"))
    by_key = Window.partitionBy("key")
    earlier = by_key.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        "key", "part", (F.coalesce(F.sum("rows").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("rows").over(by_key).alias("n"))
    return laid.join(broadcast_if_small(runs), ["key", "part"]).select(
        *rows.columns, (F.col("row") + F.col("shift")).alias("pos"), "n")


def _whole(value: Column, by: int) -> Column:
    """Integer quotient; a multiple of ``by`` divides exactly as a double below 2 ** 53."""
    return value if by == 1 else ((value - value % by) / by).cast("long")


def in_blocks(nodes: DataFrame) -> DataFrame:
    """``nodes`` with their ``block``, the ``steps`` that lead to the block's node, and on the block's
    first row that node as ``top``. A step holds the digests left and right of the way up."""
    block = Window.partitionBy("key", "block").orderBy("pos")
    down = block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = nodes.withColumn("block", _whole(F.col("pos"), BLOCK)).withColumn("top", F.col("h"))
    pos, n = F.col("pos"), F.col("n")
    for level in range(LEVELS):
        span = ARITY**level
        length = _whole(n + (span - 1), span)
        at = _whole(pos, span)
        slot, head, more = at % ARITY, pos % span == 0, length > 1
        near = {
            -k: F.when(slot >= k, F.lag("top", k * span).over(block)) for k in range(1, ARITY)
        } | {
            k: F.when((slot + k < ARITY) & (at + k < length), F.lead("top", k * span).over(block)) for k in range(1, ARITY)
        }
        rows = rows.select("*", *[value.alias(f"near{k}") for k, value in near.items()])
        left, right = (
            F.concat(*[F.coalesce(F.col(f"`near{k}`"), F.lit("")) for k in ks])
            for ks in (range(1 - ARITY, 0), range(1, ARITY)))
        first = pos % (span * ARITY) == 0
        rows = rows.withColumns({
            f"step{level}": F.when(head & more, F.struct(left.alias("left"), right.alias("right"))),
            "top": F.when(first, F.when(more, digest(F.col("top"), right)).otherwise(F.col("top"))),
        }).drop(*[f"near{k}" for k in near])
    # a node's step holds for all rows up to the next node of its level
    steps = F.array(*[F.last(f"step{level}", ignorenulls=True).over(down) for level in range(LEVELS)])
    return rows.select(*nodes.columns, "block", "top", F.array_compact(steps).alias("steps"))


def passes(nodes: DataFrame) -> list[DataFrame]:
    """The nodes in blocks, then the blocks' nodes in blocks, until each key is a single block."""
    most = nodes.agg(F.max("n")).first()[0] or 0
    found = [in_blocks(nodes)]
    while most > BLOCK:
        most = -(-most // BLOCK)
        found.append(in_blocks(heads(found[-1]).select(
            "key", F.col("block").alias("pos"), _whole(F.col("n") + (BLOCK - 1), BLOCK).alias("n"), F.col("top").alias("h"))))
    return found


def heads(blocks: DataFrame) -> DataFrame:
    return blocks.where(F.col("pos") == F.col("block") * BLOCK)


def proven(climbed: list[DataFrame], above: DataFrame) -> DataFrame:
    """The rows of the first pass with all their steps to the root. ``above`` has a row per key:
    ``key, steps, root, subroot``."""
    over = above.withColumn("block", F.lit(0).cast("long"))
    for blocks in reversed(climbed):
        upper = over.select("key", "block", F.col("steps").alias("more"), "root", "subroot")
        rows = blocks.join(upper, ["key", "block"]).withColumn("steps", F.concat("steps", "more")).drop("more", "top")
        over = rows.select("key", F.col("pos").alias("block"), "steps", "root", "subroot")
    return rows


def manifest(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, source key, leaf, what became of it, subroot, root and ``steps``."""
    climbed = passes(placed(leaves(docs), ["doc_id", "h"]))
    subroots = heads(climbed[-1]).select("key", F.col("top").alias("h"))
    sources = placed(subroots.select(F.lit("").alias("key"), F.col("key").alias("source_key"), "h"), ["source_key"])
    over_sources = passes(sources)
    root = heads(over_sources[-1]).select(
        "key", F.array().cast(STEPS).alias("steps"), F.col("top").alias("root"), F.lit(None).cast("string").alias("subroot"))
    above = proven(over_sources, root).select(F.col("source_key").alias("key"), "steps", "root", F.col("h").alias("subroot"))
    return proven(climbed, above)


def folded(start: Column, steps: Column) -> Column:
    """The root that a leaf leads to along its siblings."""
    return F.aggregate(steps, start, lambda node, step: digest(step["left"], node, step["right"]))


def manifest_report(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified."""
    siblings = F.array_join(F.transform("steps", lambda step: F.concat(step["left"], step["right"])), "")
    return manifest(docs).select(
        "doc_id", F.col("h").alias("leaf"), "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"),
        folded(F.col("tampered"), F.col("steps")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def _sql_field(name: str, text: str | None = None) -> str:
    text = text or f"CAST({name} AS VARCHAR)"
    return f"coalesce(strlen({text}) || ':' || {text}, '-')"


def _sql_leaf(text: str | None = None) -> str:
    return f"sha256({' || '.join(_sql_field(f, text if f == 'text' else None) for f in FIELDS)})"


def _sql_tree(name: str, base: str) -> str:
    """A recursive table of all nodes over ``base(key, pos, n, h)``."""
    return f"""{name}(key, level, pos, n, h) AS (
  SELECT key, 0, pos, n, h FROM {base}
  UNION ALL SELECT key, level + 1, pos // {ARITY}, (n + {ARITY - 1}) // {ARITY}, sha256(string_agg(h, '' ORDER BY pos))
  FROM {name} WHERE n > 1 GROUP BY key, level, pos // {ARITY}, n)"""


# crc-32 by bits: a number is xored in, -1 is a shift
_SQL_CRC = """xor(4294967295, list_reduce(list_concat([4294967295], flatten(list_transform(
  string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda c, e: CASE WHEN e >= 0 THEN xor(c, e) ELSE xor(c >> 1, 3988292384 * (c & 1)) END))"""

ORACLE = f"""WITH RECURSIVE
leaf AS (
  SELECT doc_id, coalesce('=' || source, '') AS key, {_sql_leaf()} AS h,
    CASE WHEN {_SQL_CRC} % 2 = 0 THEN {_sql_leaf("replace(text, chr(10), '')")} ELSE {_sql_leaf()} END AS tampered
  FROM documents),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, h) - 1 AS pos, count(*) OVER (PARTITION BY key) AS n
  FROM leaf),
{_sql_tree("node", "placed")},
subroot AS (
  SELECT '' AS key, key AS source_key, row_number() OVER (ORDER BY key) - 1 AS pos, count(*) OVER () AS n, h FROM node WHERE n = 1),
{_sql_tree("top", "subroot")},
way AS (
  SELECT p.doc_id, p.h AS leaf, p.tampered, s.h AS subroot, p.key, p.pos, s.pos AS source_pos, (SELECT h FROM top WHERE n = 1) AS root
  FROM placed p JOIN subroot s ON p.key = s.source_key),
seen AS (
  SELECT w.key AS k, w.pos AS p, 0 AS part, t.level, t.pos, t.h, w.pos // (3 ** t.level)::BIGINT AS own
  FROM way w JOIN node t ON t.key = w.key AND t.n > 1 AND t.pos // 3 = w.pos // (3 ** (t.level + 1))::BIGINT
  UNION ALL SELECT w.key, w.pos, 1, t.level, t.pos, t.h, w.source_pos // (3 ** t.level)::BIGINT
  FROM way w JOIN top t ON t.n > 1 AND t.pos // 3 = w.source_pos // (3 ** (t.level + 1))::BIGINT),
step AS (
  SELECT k, p, part, level, coalesce(string_agg(h, '' ORDER BY pos) FILTER (WHERE pos < own), '') AS l,
    coalesce(string_agg(h, '' ORDER BY pos) FILTER (WHERE pos > own), '') AS r FROM seen GROUP BY k, p, part, level),
steps AS (SELECT k, p, string_agg(l || r, '' ORDER BY part, level) AS proof, list(l || '|' || r ORDER BY part, level) AS s FROM step GROUP BY k, p),
done AS (
  SELECT w.*, sha256(coalesce(proof, '')) AS proof_sha256, list_reduce(list_concat([tampered], coalesce(s, [])),
    lambda x, e: sha256(split_part(e, '|', 1) || x || split_part(e, '|', 2))) AS folded_root
  FROM way w LEFT JOIN steps ON w.key = k AND w.pos = p)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM done"""

