"""Divergence of sources within a language, from exact term counts over factored chunks.

A document is counted by its chunks, the runs of bytes between ASCII white space, in which all terms lie.
A block of documents becomes one row: its distinct chunks, and for each document the numbers and counts
of its own. Only the blocks' dictionaries are shuffled: each globally distinct chunk is split into terms
once, and its terms come back to the blocks that its places name, which then know for each term in
how many of its documents it is and how often, per (language, source). These counts add up.

A term is in no more documents than its chunks together. Terms that this bound shows to be too rare in any
language never come back to the blocks, which is most of them; the others are counted in full.

A frequent chunk is one place per block, however often it stands there. Sums over the kept terms of a language are
taken for all its sources at once, on tables of at most ``CELLS`` terms by sources; a term that a
source lacks has the same share as all others that it lacks.

Null texts, languages and sources are empty ones; a row is a document whatever its id, so repeated rows
count as often as they stand there. Shares are integers, all arithmetic is exact. An empty table has no row."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from buyerlens.llm.words import buffers, slices
from buyerlens.operators.sizing import broadcast_if_small
from buyerlens.session import checkpointed, scratch_path

LEAST_DOCUMENTS = 30
SMOOTHING = 5
SCALE = 1_000_000_000
TOP = 50
#: Bytes of text that are split at a time, and that share a dictionary; a longer document is taken alone.
SLICE_BYTES = 4 << 20
BLOCK_BYTES = 64 << 20
#: Bytes of terms up to which they are broadcast.
BROADCAST_BYTES = 32 << 20
#: Cells of a table of shares that one task holds.
CELLS = 1 << 18
_TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER = "".join(map(chr, range(65, 91)))

BLOCK = "block long, lang array<string>, source array<string>, chunks array<string>, held array<int>, counted binary"


def _squeezed(*columns: np.ndarray) -> bytes:
    """Integer columns as compressed byte planes."""
    planes = [np.ascontiguousarray(c, dtype="<u4").view(np.uint8).reshape(-1, 4).T.tobytes() for c in columns]
    raw = b"".join([len(c).to_bytes(8, "little") for c in columns] + planes)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def _unsqueezed(data: bytes, n: int) -> list[np.ndarray]:
    raw = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)
    sizes, at, out = [int.from_bytes(raw[8 * i : 8 * i + 8], "little") for i in range(n)], 8 * n, []
    for size in sizes:
        planes = np.frombuffer(raw, np.uint8, 4 * size, at).reshape(4, size)
        out.append(np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64))
        at += 4 * size
    return out


def _slice_counted(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct chunks of a slice of texts, and the distinct (row, chunk) pairs with their counts, by row."""
    split = pc.ascii_split_whitespace(texts.cast(pa.large_string()).fill_null(""))
    coded = split.flatten().dictionary_encode()
    row, many = np.repeat(np.arange(len(texts)), pc.list_value_length(split).to_numpy()), max(len(coded.dictionary), 1)
    pair, times = np.unique(row * many + coded.indices.to_numpy(), return_counts=True)
    return coded.dictionary, pair // many, pair % many, times


def _block(number: int, parts: list[tuple]) -> pa.RecordBatch:
    """One row for the counted slices of a block."""
    coded = pa.chunked_array([p[0] for p in parts]).combine_chunks().dictionary_encode()
    base = np.cumsum([0, *[len(p[0]) for p in parts]])
    rows = np.cumsum([0, *[len(p[4]) for p in parts]])
    renamed = coded.indices.to_numpy().astype(np.int64)
    code = np.concatenate([renamed[b + p[2]] for p, b in zip(parts, base)])
    row = np.concatenate([p[1] + r for p, r in zip(parts, rows)])
    # codes of a row ascend again under their new numbers
    order = np.lexsort((code, row))
    code, row, times = code[order], row[order], np.concatenate([p[3] for p in parts])[order]
    lang, source = (pa.chunked_array([p[k] for p in parts], pa.string()) for k in (4, 5))
    groups = pa.table({"lang": lang, "source": source, "i": np.arange(rows[-1])}).group_by(["lang", "source"]).aggregate([("i", "list")])
    of = np.empty(rows[-1], dtype=np.int64)
    for g, members in enumerate(groups["i_list"]):
        of[members.values.to_numpy()] = g
    counted = _squeezed(of, np.bincount(row, minlength=rows[-1]), np.diff(code, prepend=0) % (1 << 32), times)
    return pa.RecordBatch.from_pydict({
        "block": pa.array([number]), "lang": pa.array([groups["lang"].to_pylist()], pa.list_(pa.string())),
        "source": pa.array([groups["source"].to_pylist()], pa.list_(pa.string())),
        "chunks": _single(coded.dictionary.cast(pa.string())),
        "held": _single(pa.array(np.bincount(code, minlength=len(coded.dictionary)), pa.int32())),
        "counted": pa.array([counted], pa.binary()),
    })


def _single(values: pa.Array) -> pa.Array:
    """``values`` as the one list of a list column."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _count_chunks(batches):
    """Blocks of documents: distinct chunks with the number of documents that hold each, and per document its chunks.

    ``counted`` holds the group of each document, its number of different chunks, and of these the steps from one
    number to the next and how often each stands there. A slice's texts are given up once they are counted."""
    number, parts, size = TaskContext.get().partitionId() << 32, [], 0
    for batch in batches:
        _, offsets = buffers(batch.column(0))
        for low, high in slices(offsets, SLICE_BYTES):
            text, lang, source = (batch.column(i).slice(low, high - low) for i in range(3))
            parts.append((*_slice_counted(text), *[c.cast(pa.string()).fill_null("") for c in (lang, source)]))
            size += int(offsets[high] - offsets[low])
            if size >= BLOCK_BYTES:
                yield _block(number, parts)
                number, parts, size = number + 1, [], 0
    if parts:
        yield _block(number, parts)


def stored(df: DataFrame) -> DataFrame:
    """``df`` as a compressed table in the shared folder: chunks and terms take far less than in a checkpoint."""
    path = scratch_path(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def chunk_counts(docs: DataFrame) -> DataFrame:
    rows = docs.select(*[F.col(c).cast("string") for c in ("text", "lang", "source")])
    return rows.mapInArrow(_count_chunks, BLOCK)


def chunk_terms(blocks: DataFrame) -> DataFrame:
    """``held, at, terms``: each distinct chunk that has terms, the documents that hold it, its places in the blocks'
    dictionaries, and its terms, found once."""
    entries = blocks.select("block", F.posexplode(F.arrays_zip("chunks", "held")).alias("i", "e")).select(
        F.col("e.chunks").alias("chunk"), F.col("e.held").alias("held"), F.struct("block", "i").alias("at"))
    # a chunk has a row per block here, so a frequent one is no larger than the list of blocks
    distinct = entries.where("chunk <> ''").repartition("chunk").groupBy("chunk").agg(
        F.sum("held").alias("held"), F.collect_list("at").alias("at"))
    found = F.regexp_extract_all(F.translate("chunk", _UPPER, _UPPER.lower()), F.lit(_TERM), F.lit(0))
    split = distinct.select("held", "at", found.alias("found")).where(F.size("found") > 0)
    terms = F.transform(F.array_distinct("found"), lambda t: F.struct(
        t.alias("term"), F.size(F.filter("found", lambda x: x == t)).alias("times")))
    return split.select("held", "at", terms.alias("terms"))


def _block_terms(blocks: pa.Table, terms: pa.Table) -> pa.Table:
    """Documents and occurrences per language and term of one block, by source."""
    lang, source = (blocks[c].combine_chunks()[0].values for c in ("lang", "source"))
    of, many, step, times = _unsqueezed(blocks["counted"][0].as_py(), 4)
    code = np.cumsum(step.astype(np.uint32), dtype=np.uint32).astype(np.int64)
    row = np.repeat(np.arange(len(of)), many)
    # the terms of each chunk lie together
    where = terms["i"].to_numpy().astype(np.int64)
    order = np.argsort(where, kind="stable")
    coded = terms["term"].combine_chunks().dictionary_encode()
    number, each, where = coded.indices.to_numpy().astype(np.int64)[order], terms["times"].to_numpy()[order], where[order]
    names = max(len(coded.dictionary), 1)
    first, last = np.searchsorted(where, code), np.searchsorted(where, code, side="right")
    size = last - first
    at = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    # a term that stands in several chunks of a document counts that document once
    pair, inverse = np.unique(np.repeat(row, size) * names + number[at], return_inverse=True)
    occurs = np.bincount(inverse, weights=np.repeat(times, size) * each[at], minlength=len(pair))
    langs = lang.dictionary_encode()
    # cells by language, term and group
    group = of[pair // names]
    key = (langs.indices.to_numpy().astype(np.int64)[group] * names + pair % names) * len(lang) + group
    cell, inverse = np.unique(key, return_inverse=True)
    whole, begin = np.unique(cell // len(lang), return_index=True)
    offsets = pa.array(np.append(begin, len(cell)), pa.int32())

    def listed(values: pa.Array) -> pa.Array:
        return pa.ListArray.from_arrays(offsets, values)

    return pa.table({
        "lang": langs.dictionary.take(pa.array(whole // names)).cast(pa.string()),
        "term": coded.dictionary.take(pa.array(whole % names)).cast(pa.string()),
        "source": listed(source.take(pa.array(cell % len(lang))).cast(pa.string())),
        "docs": listed(pa.array(np.bincount(inverse, minlength=len(cell)), pa.int64())),
        "n": listed(pa.array(np.bincount(inverse, weights=occurs, minlength=len(cell)).astype(np.int64))),
    })


def term_counts(blocks: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """``lang, source, term, n``: occurrences of the kept terms, those in at least ``least`` documents of the language."""
    split = stored(chunk_terms(blocks))
    single = split.select("held", "at", F.explode("terms").alias("t")).select("held", "at", "t.*")
    likely = stored(single.groupBy("term").agg(F.sum("held").alias("held")).where(F.col("held") >= least).select("term"))
    size = likely.agg(F.sum(F.octet_length("term") + 16)).first()[0] or 0
    wanted = single.join(F.broadcast(likely) if size <= BROADCAST_BYTES else likely, "term", "left_semi")
    terms = wanted.select("term", "times", F.explode("at").alias("a")).select("a.block", "a.i", "term", "times")
    counted = blocks.select(F.col("block").alias("of"), "lang", "source", "counted")
    found = counted.groupBy("of").cogroup(terms.groupBy("block")).applyInArrow(
        _block_terms, "lang string, term string, source array<string>, docs array<long>, n array<long>")
    # one exchange: sums by source and over the sources of a language meet in the same tasks
    by_source = found.repartition("lang", "term").select(
        "lang", "term", F.explode(F.arrays_zip("source", "docs", "n")).alias("s")).groupBy("lang", "term", "s.source").agg(
        F.sum("s.docs").alias("docs"), F.sum("s.n").alias("n"))
    in_lang = F.sum("docs").over(Window.partitionBy("lang", "term"))
    return by_source.withColumn("in_lang", in_lang).where(F.col("in_lang") >= least).select("lang", "source", "term", "n")


def share(n: str, total: str, terms: str) -> Column:
    """The exact share of a term, in billionths and at least one. Decimals hold the product."""
    product = f"CAST({SCALE} AS DECIMAL(12,0)) * CAST({n} + {SMOOTHING} AS DECIMAL(20,0))"
    return F.expr(f"1 + ({product}) DIV CAST({total} + {SMOOTHING} * {terms} AS DECIMAL(20,0))").cast("long")


def group_facts(blocks: DataFrame, kept: DataFrame) -> DataFrame:
    """Per (language, source): its number ``g`` and its occurrences of kept terms ``total``; of its language the
    number of sources and kept terms and their occurrences; and ``rest``, the share of a term it lacks."""
    pairs = blocks.select(F.explode(F.arrays_zip("lang", "source")).alias("p")).select("p.*").distinct()
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    of_lang = kept.groupBy("lang", "term").agg(F.sum("n").alias("n")).groupBy("lang").agg(
        F.count("*").alias("terms"), F.sum("n").alias("lang_total"))
    every = pairs.join(own, ["lang", "source"], "left").join(of_lang, "lang", "left").fillna(0, ["total", "terms", "lang_total"])
    # a row per source of the language
    per_lang = Window.partitionBy("lang")
    return every.select(
        "*", (F.row_number().over(per_lang.orderBy("source")) - 1).cast("long").alias("g"), F.count("*").over(per_lang).alias("sources"),
        F.when(F.col("terms") > 0, share("0", "total", "terms")).otherwise(F.lit(0)).alias("rest"))


def _distances(key: tuple, rows: pd.DataFrame, groups: pd.DataFrame) -> pd.DataFrame:
    """Sums of absolute differences between all sources of a language, over the terms of one bucket."""
    number, names = pd.factorize(rows["term"])
    groups = groups.sort_values("number")
    table = np.repeat(groups["rest"].to_numpy(np.int64)[:, None], len(names), axis=1)
    table[rows["g"].to_numpy(np.int64), number] = rows["p"].to_numpy(np.int64)
    low, high = np.triu_indices(len(table), 1)
    value = [np.abs(table[i + 1 :] - table[i]).sum(axis=1) for i in range(len(table) - 1)]
    return pd.DataFrame({"lang": key[0], "a": low, "b": high, "value": np.concatenate([np.zeros(0, dtype=np.int64), *value])})


def source_distances(shares: DataFrame, facts: DataFrame) -> DataFrame:
    """``lang, a, b, value``: for each two sources of a language, by number, the sum over all its kept terms."""
    buckets = F.greatest(F.lit(1), F.ceil(F.col("terms") * F.col("sources") / CELLS))
    rows = shares.select("lang", F.pmod(F.xxhash64("term"), buckets).alias("bucket"), "term", "g", "p")
    groups = facts.where("sources > 1").select(
        F.col("lang").alias("of"), F.explode(F.sequence(F.lit(0).cast("long"), buckets - 1)).alias("in"), F.col("g").alias("number"), "rest")
    found = rows.where("sources > 1").groupBy("lang", "bucket").cogroup(groups.groupBy("of", "in")).applyInPandas(
        _distances, "lang string, a long, b long, value long")
    return found.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def divergence(docs: DataFrame, least: int = LEAST_DOCUMENTS, top: int = TOP) -> DataFrame:
    """``lang, source, part, item, value, rank``: parts ``pair`` (all other sources of the language) and ``term``
    (terms with a greater share than in the language as a whole, the ``top`` first)."""
    blocks = stored(chunk_counts(docs))
    kept = stored(term_counts(blocks, least))
    facts = checkpointed(group_facts(blocks, kept))
    side = broadcast_if_small(facts)
    # a row per source in each window
    whole = F.sum("n").over(Window.partitionBy("lang", "term"))
    shares = kept.withColumn("all", whole).join(side, ["lang", "source"]).select(
        "lang", "source", "g", "term", "terms", "sources", share("n", "total", "terms").alias("p"), share("all", "lang_total", "terms").alias("q"))
    pairs = source_distances(shares, facts)
    both = pairs.unionByName(pairs.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    names = broadcast_if_small(facts.select("lang", "g", "source"))
    found = both.join(names.withColumnRenamed("g", "a"), ["lang", "a"]).join(
        names.select("lang", F.col("g").alias("b"), F.col("source").alias("item")), ["lang", "b"])
    over = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = F.row_number().over(over).alias("rank")
    distances = found.select("lang", "source", F.lit("pair").alias("part"), "item", "value").select("*", ranked)
    above = shares.where("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    return distances.unionByName(above.select("*", ranked).where(F.col("rank") <= top))


ORACLE = f"""WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '{_TERM}') AS found FROM documents),
occurs AS (SELECT d, lang, source, unnest(found) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS n FROM occurs GROUP BY ALL HAVING count(DISTINCT d) >= {LEAST_DOCUMENTS}),
of_lang AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
own AS (SELECT lang, source, term, count(*) AS n FROM occurs JOIN kept USING (lang, term) GROUP BY ALL),
grp AS (
  SELECT lang, source, coalesce(v, 0) AS v, coalesce((SELECT sum(n) FROM own o WHERE o.lang = g.lang AND o.source = g.source), 0) AS total, l.total AS lang_total
  FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN of_lang l USING (lang)),
cell AS (
  SELECT g.lang, g.source, k.term, coalesce(o.n, 0) AS n,
    1 + ({SCALE}::HUGEINT * (coalesce(o.n, 0) + {SMOOTHING})) // (g.total + {SMOOTHING} * g.v) AS p,
    1 + ({SCALE}::HUGEINT * (k.n + {SMOOTHING})) // (g.lang_total + {SMOOTHING} * g.v) AS q
  FROM grp g JOIN kept k USING (lang) LEFT JOIN own o ON o.lang = g.lang AND o.source = g.source AND o.term = k.term),
apart AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS f FROM cell a JOIN cell b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
every AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f, 0) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN apart p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM cell WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM every)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= {TOP}"""
