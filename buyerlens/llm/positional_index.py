"""Benchmark decontamination by a positional inverted index. DataFrame functions only.

Every window of ten consecutive words of a benchmark item is a phrase; an item of fewer words is one
phrase. Corpus counts of the benchmark's words tell each phrase's two rarest words. The index stores
the postings (word, document, position) of these words, and the rarest also with the words around.
A phrase is found by intersecting its two lists, shifted by the words' places in the phrase; what is
left is compared word by word. A list is never longer than its word is frequent, and common words are
read only where a phrase has nothing rarer.

Words are runs of ``0-9a-z`` and characters beyond ASCII, after lower-casing A-Z. Null texts have no
words; items without ``item_id`` are not items. Results are per row of ``docs``: rows that share an id
but not a text are told apart, repeated rows have the same result each. A text's words stay one array
while its postings are made, which holds for any text that fits a row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from buyerlens.session import checkpointed

WINDOW = 10
#: Phrases or words that are broadcast at most; beyond, the joins shuffle.
BROADCAST_ROWS = 200_000
_BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NOTHING = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"  # sha256 of the empty string


def _lower(word: Column) -> Column:
    """A-Z only; the quick function is right where all characters are ASCII."""
    return F.when(F.octet_length(word) == F.length(word), F.lower(word)).otherwise(F.translate(word, _UPPER, _LOWER))


def _pieces(text: Column) -> Column:
    """Words in their order; the first and the last piece may be empty."""
    return F.split(F.coalesce(text.cast("string"), F.lit("")), _BREAK, -1)


def _count(pieces: str) -> Column:
    size, first, last = F.size(pieces), F.element_at(pieces, 1) == "", F.element_at(pieces, -1) == ""
    return (size - first.cast("int") - (last & (size > 1)).cast("int")).cast("long")


def _small(df: DataFrame) -> DataFrame:
    """``df`` as a broadcast side if its counted rows are few enough."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def phrases(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``item_id, phrase, terms``: all windows of all items; equal windows have the same ``phrase``."""
    words = F.filter(_pieces(F.col("text")), lambda w: w != "")
    items = benchmark.where("item_id is not null").select(
        F.col("item_id").cast("string"), F.transform(words, _lower).alias("w")).where("size(w) > 0")
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - window + 1))
    windows = items.select("item_id", "w", F.explode(starts).alias("s"))
    terms = F.slice("w", F.col("s"), F.least(F.lit(window), F.size("w")))
    return windows.select("item_id", terms.alias("terms")).withColumn(
        "phrase", F.sha2(F.concat_ws(" ", "terms"), 256)).distinct()


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64(F.col("text").cast("string")).alias("text_hash"), _pieces(F.col("text")).alias("p"))


def term_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Occurrences in the corpus of each of the distinct ``terms(term)``, where there are any."""
    words = _rows(docs).select(F.explode("p").alias("w")).select(_lower(F.col("w")).alias("term"))
    return words.join(_small(terms), "term").groupBy("term").agg(F.count("*").alias("n"))


def anchors(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """``phrase, terms`` with the rarest word and its place and, if any, the next one's.

    Phrases with a word that the corpus lacks occur nowhere and are left out."""
    distinct = windows.select("phrase", "terms").distinct()
    places = distinct.select("phrase", F.posexplode("terms").alias("place", "term"))
    counted = places.join(_small(counts), "term")
    rarest = F.array_sort(F.collect_list(F.struct("n", "term", "place")))
    ordered = counted.groupBy("phrase").agg(rarest.alias("r"))
    return distinct.join(ordered, "phrase").where("size(r) = size(terms)").select(
        "phrase", "terms", F.col("r")[0]["term"].alias("term"), F.col("r")[0]["place"].alias("place"),
        F.get("r", F.lit(1))["term"].alias("term2"), F.get("r", F.lit(1))["place"].alias("place2"),
    )


def postings(docs: DataFrame, found: DataFrame, window: int = WINDOW) -> DataFrame:
    """The index: ``term, doc_id, text_hash, position`` and, for words that are some phrase's rarest,
    the words before and after as ``around``, of which ``ahead`` stand before."""
    wanted = (
        found.select("term", F.lit(True).alias("rarest")).unionAll(
            found.where("term2 is not null").select(F.col("term2").alias("term"), F.lit(False).alias("rarest")))
        .groupBy("term").agg(F.max("rarest").alias("rarest"))
    )
    places = _rows(docs).select("doc_id", "text_hash", "p", F.posexplode("p").alias("position", "w"))
    listed = places.withColumn("term", _lower(F.col("w"))).join(_small(wanted), "term")
    ahead = F.least(F.col("position"), F.lit(window - 1))
    around = F.when(F.col("rarest"), F.slice("p", F.col("position") - ahead + 1, ahead + window))
    return listed.select("term", "doc_id", "text_hash", "position", around.alias("around"), ahead.alias("ahead"))


def _starts(index: DataFrame, found: DataFrame, term: str, place: str, *more: str) -> DataFrame:
    """Where each phrase would begin for its word to stand at its posting."""
    lists = found.where(F.col(term).isNotNull()).select("phrase", "terms", F.col(term).alias("term"), F.col(place).alias("place"))
    return index.join(_small(lists), "term").select(
        "phrase", "terms", "doc_id", "text_hash", (F.col("position") - F.col("place")).alias("start"), "place", *more)


def exact_matches(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """``doc_id, text_hash, phrase, start, length`` of each occurrence of a phrase."""
    found, index = _indexed(docs, windows)
    first = _starts(index.where("around is not null"), found, "term", "place", "around", "ahead").where("start >= 0")
    # the next rarest word must stand at its place too
    second = _starts(index, found, "term2", "place2").select("phrase", "doc_id", "text_hash", "start").distinct()
    on = (
        (F.col("x.phrase") == F.col("y.phrase")) & F.col("x.doc_id").eqNullSafe(F.col("y.doc_id"))
        & (F.col("x.text_hash") == F.col("y.text_hash")) & (F.col("x.start") == F.col("y.start"))
    )
    both = first.where("size(terms) > 1").alias("x").join(second.alias("y"), on, "left_semi")
    candidates = both.unionAll(first.where("size(terms) = 1"))
    here = F.slice("around", F.col("ahead") - F.col("place") + 1, F.size("terms"))
    return candidates.where((F.col("ahead") >= F.col("place")) & (F.transform(here, _lower) == F.col("terms"))).select(
        "doc_id", "text_hash", "phrase", "start", F.size("terms").alias("length")).distinct()


def proximity_matches(docs: DataFrame, windows: DataFrame, within: int = 3) -> DataFrame:
    """``doc_id, text_hash, phrase``: the two rarest words of the phrase stand at most ``within`` words
    away from their places to each other, whether or not the rest is there."""
    found, index = _indexed(docs, windows)
    first = _starts(index, found, "term", "place").select("phrase", "doc_id", "text_hash", "start")
    second = _starts(index, found, "term2", "place2").select("phrase", "doc_id", "text_hash", "start")
    # starts that are near share one of two neighbouring cells
    cell = (F.col("start") / F.lit(within + 1)).cast("double")
    cells = F.explode(F.sequence(F.floor(cell) - 1, F.floor(cell) + 1))
    left = first.withColumn("cell", F.floor(cell)).alias("x")
    right = second.withColumn("cell", cells).alias("y")
    on = (
        (F.col("x.phrase") == F.col("y.phrase")) & F.col("x.doc_id").eqNullSafe(F.col("y.doc_id"))
        & (F.col("x.text_hash") == F.col("y.text_hash")) & (F.col("x.cell") == F.col("y.cell"))
        & (F.abs(F.col("x.start") - F.col("y.start")) <= within)
    )
    return left.join(right, on, "left_semi").select("doc_id", "text_hash", "phrase").distinct()


def _indexed(docs: DataFrame, windows: DataFrame) -> tuple[DataFrame, DataFrame]:
    terms = windows.select(F.explode("terms").alias("term")).distinct()
    found = checkpointed(anchors(windows, checkpointed(term_counts(docs, terms))))
    return found, checkpointed(postings(docs, found))


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    per_row = _per_row(docs, benchmark)
    rows = _rows(docs).select("doc_id", "text_hash", _count("p").alias("n_words"))
    on = F.col("doc_id").eqNullSafe(F.col("__phrase_doc")) & (F.col("text_hash") == F.col("__phrase_text"))
    return rows.join(per_row, on, "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items_sha256", F.lit(NOTHING)).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def _per_row(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Hits and items of each row with any, by id and hash of the text as ``__phrase_doc, __phrase_text``."""
    windows = checkpointed(phrases(benchmark))
    matches = checkpointed(exact_matches(docs, windows))
    row = ["doc_id", "text_hash"]
    spans = matches.select(*row, "start", (F.col("start") + F.col("length")).alias("end")).distinct()
    before = Window.partitionBy(*row).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    covered = F.greatest(F.lit(0), F.col("end") - F.greatest("start", F.coalesce(F.max("end").over(before), F.lit(0))))
    hit = spans.select(*row, covered.alias("c")).groupBy(*row).agg(F.sum("c").alias("n_hit"))
    items = matches.select(*row, "phrase").distinct().join(_small(windows.select("phrase", "item_id")), "phrase").select(
        *row, "item_id").distinct().groupBy(*row).agg(
        F.count("*").alias("n_items"), F.sha2(F.concat_ws(",", F.array_sort(F.collect_list("item_id"))), 256).alias("items_sha256"))
    hit = hit.withColumnsRenamed({"doc_id": "__phrase_doc", "text_hash": "__phrase_text"})
    on = F.col("doc_id").eqNullSafe(F.col("__phrase_doc")) & (F.col("text_hash") == F.col("__phrase_text"))
    return hit.join(items, on).select("__phrase_doc", "__phrase_text", "n_hit", "n_items", "items_sha256")


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of ``docs``, with all their columns, that hold no phrase of the benchmark."""
    bad = _per_row(docs, benchmark).select("__phrase_doc", "__phrase_text")
    on = F.col("doc_id").eqNullSafe(F.col("__phrase_doc")) & (F.xxhash64(F.col("text").cast("string")) == F.col("__phrase_text"))
    return docs.join(bad, on, "left_anti")


ORACLE = r"""
with pieces as (
  select item_id::varchar as item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark where item_id is not null
), windows as (
  select distinct item_id, array_to_string(list_slice(w, s, s + least(10, len(w)) - 1), ' ') as phrase, least(10, len(w)) as size
  from (select item_id, w, unnest(generate_series(1, greatest(1, len(w) - 9))) as s from pieces where len(w) > 0)
), docs as (
  select doc_id, text,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents
), sizes as (select distinct size from windows), grams as (
  select doc_id, text, s, size, array_to_string(list_slice(w, s, s + size - 1), ' ') as phrase
  from (select doc_id, text, w, size, unnest(generate_series(1, len(w) - size + 1)) as s from docs, sizes where len(w) >= size)
), matches as (
  select g.doc_id, g.text, g.s, g.size, b.item_id from grams g join windows b on g.phrase = b.phrase and g.size = b.size
), hits as (
  select doc_id, text, count(distinct p) as n_hit
  from (select doc_id, text, unnest(generate_series(s, s + size - 1)) as p from (select distinct doc_id, text, s, size from matches))
  group by all
), items as (
  select doc_id, text, count(*) as n_items, sha256(string_agg(item_id, ',' order by item_id)) as items_sha256
  from (select distinct doc_id, text, item_id from matches) group by all
)
select d.doc_id, len(d.w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  coalesce(items_sha256, sha256('')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from docs d
left join hits h on d.doc_id is not distinct from h.doc_id and d.text is not distinct from h.text
left join items i on d.doc_id is not distinct from i.doc_id and d.text is not distinct from i.text
"""
