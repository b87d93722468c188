"""Quality rules by distribution divergence.

A document is held against the language it claims: the histogram of its character classes and that of
its common words are compared with the language's own by the Jensen-Shannon distance. The references
are counted over all documents of the language, in two passes:

1. Each batch names the words that hold at least ``common_share`` of its words of a language. A word
   that holds this share of the whole language holds it in some batch, so none is missed.
2. Character classes and these words are counted exactly; words below the share drop out.

Both passes return a bounded number of rows for each batch and language, whatever the documents hold.
Missing languages are the language ``""``. Documents below ``min_chars`` or ``min_words`` are too short
to compare, and a language below ``min_reference_words`` words has no reference: there the verdict is
"keep" unless a base rule failed. A null or empty text has no words and fails the base rule."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from buyerlens.llm.words import (
    IS_SPACE, LINE_VALUE, buffers, mix, rows_of, runs, runs_hashed, slices, sums, windows_hashed, words,
)

WINDOW = 5
SYMBOLS = "[#*$%&|<>]"
_IS_SYMBOL = np.zeros(256, dtype=bool)
_IS_SYMBOL[[ord(c) for c in SYMBOLS[1:-1]]] = True

# Character classes of the histogram: 0 lower-case letters and all beyond ASCII, 1 capitals, 2 digits,
# 3 white space, 4 punctuation of prose, 5 other characters; 6 marks the later bytes of a character.
N_CLASSES = 6
_CLASS = np.full(256, 5, dtype=np.int64)
_CLASS[ord("a") : ord("z") + 1] = 0
_CLASS[0x80:] = 0
_CLASS[ord("A") : ord("Z") + 1] = 1
_CLASS[ord("0") : ord("9") + 1] = 2
_CLASS[IS_SPACE] = 3
_CLASS[[ord(c) for c in ".,;:'\"!?()-"]] = 4
_CLASS[0x80:0xC0] = 6

RESULT = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "kept boolean, class_distance double, word_distance double"
)


@dataclass(frozen=True)
class Rules:
    """Thresholds of the verdict. Distances lie between 0 and 1. The histogram of a short text scatters
    more, so a limit is ``max + slack / sqrt(n)`` for ``n`` characters or words."""

    min_words: int = 40
    min_chars: int = 120
    max_class_distance: float = 0.28
    class_slack: float = 1.0
    max_word_distance: float = 0.22
    word_slack: float = 0.7
    common_share: float = 0.001
    single_words: int = 8
    min_reference_words: int = 2000
    max_languages: int = 1000


@dataclass
class Reference:
    """A language: its class histogram, its common words by hash with their bin, its word histogram."""

    classes: np.ndarray
    hashes: np.ndarray
    bins: np.ndarray
    shares: np.ndarray = field(default_factory=lambda: np.zeros(0))


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Square root of the Jensen-Shannon divergence in bits between the rows of ``p`` and ``q``."""
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / m), 0).sum(axis=-1)
        right = np.where(q > 0, q * np.log2(q / m), 0).sum(axis=-1)
    return np.sqrt(np.maximum(0, (left + right) / 2))


def _class_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    rows = len(offsets) - 1
    key = np.repeat(np.arange(rows), np.diff(offsets)) * (N_CLASSES + 1) + _CLASS[data]
    return np.bincount(key, minlength=rows * (N_CLASSES + 1)).reshape(rows, -1)[:, :N_CLASSES]


def _languages(column) -> tuple[list[str], np.ndarray]:
    encoded = column.cast(pa.string()).fill_null("").dictionary_encode()
    return encoded.dictionary.to_pylist(), encoded.indices.to_numpy()


def _parts(batches) -> Iterator[tuple[list[str], np.ndarray, np.ndarray, np.ndarray]]:
    """Slices of batches of (text, lang): languages, index of each row's, bytes, offsets."""
    for batch in batches:
        names, index = _languages(batch.column(1))
        data, offsets = buffers(batch.column(0))
        for low, high in slices(offsets):
            yield names, index[low:high], data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]


def _candidates(share: float):
    """Per batch and language: words with at least this share of the batch's words of the language."""
    def run(batches):
        for batch in batches:
            found: dict[str, list] = {}
            for names, index, data, offsets in _parts([batch]):
                w = words(data, offsets)
                h, of = w.hashes(), index[w.row]
                for i in np.unique(of):
                    found.setdefault(names[i], []).append(np.unique(h[of == i], return_counts=True))
            for name, parts in found.items():
                h, inverse = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
                n = np.bincount(inverse, weights=np.concatenate([p[1] for p in parts]))
                keep = h[n >= share * n.sum()]
                yield pa.RecordBatch.from_pydict({
                    "lang": pa.array([name] * len(keep), pa.string()), "word": pa.array(keep.view(np.int64)),
                })
    return run


def _histograms(candidates: dict[str, np.ndarray]):
    """Per batch and language: counts of classes (kind 0), all words (1) and candidates (2)."""
    def run(batches):
        for batch in batches:
            total: dict[str, tuple] = {}
            for names, index, data, offsets in _parts([batch]):
                w = words(data, offsets)
                h, of, classes = w.hashes(), index[w.row], _class_counts(data, offsets)
                for i in np.unique(index):
                    known = candidates.get(names[i], np.zeros(0, dtype=np.uint64))
                    mine = h[of == i]
                    at = np.minimum(np.searchsorted(known, mine), max(0, len(known) - 1))
                    hit = at[known[at] == mine] if len(known) else at[:0]
                    c, n, k = total.get(names[i], (0, 0, 0))
                    total[names[i]] = (
                        c + classes[index == i].sum(axis=0), n + len(mine), k + np.bincount(hit, minlength=len(known)),
                    )
            for name, (classes, n, counts) in total.items():
                known = candidates.get(name, np.zeros(0, dtype=np.uint64))
                key = np.concatenate([np.arange(N_CLASSES), [0], known.view(np.int64)])
                kind = np.repeat([0, 1, 2], [N_CLASSES, 1, len(known)])
                yield pa.RecordBatch.from_pydict({
                    "lang": pa.array([name] * len(key), pa.string()), "kind": pa.array(kind, pa.int32()),
                    "key": pa.array(key, pa.int64()), "n": pa.array(np.concatenate([classes, [n], counts]), pa.int64()),
                })
    return run


def fit_references(docs: DataFrame, rules: Rules = Rules()) -> dict[str, Reference]:
    """Histograms of each language over all documents.

    The driver receives at most ``1 / common_share`` words for each language and batch that named
    them, distinct; more than ``max_languages`` languages are an error."""
    source = docs.select(F.col("text").cast("string"), F.col("lang").cast("string"))
    languages = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang")).distinct()
    if languages.limit(rules.max_languages + 1).count() > rules.max_languages:
        raise ValueError(f"more than {rules.max_languages} languages; is the column a language?")
    named: dict[str, list[int]] = {}
    for row in source.mapInArrow(_candidates(rules.common_share), "lang string, word long").distinct().collect():
        named.setdefault(row.lang, []).append(row.word)
    candidates = {k: np.sort(np.array(v, dtype=np.int64).view(np.uint64)) for k, v in named.items()}
    counts = (
        source.mapInArrow(_histograms(candidates), "lang string, kind int, key long, n long")
        .groupBy("lang", "kind", "key").agg(F.sum("n").alias("n"))
    )
    tables: dict[str, dict] = {}
    for row in counts.collect():
        tables.setdefault(row.lang, {})[row.kind, row.key] = row.n
    references = {}
    for name, table in tables.items():
        total = table[1, 0]
        if total < rules.min_reference_words:
            continue
        classes = np.array([table.get((0, i), 0) for i in range(N_CLASSES)], dtype=float)
        common = sorted(((n, k) for (kind, k), n in table.items() if kind == 2 and n >= rules.common_share * total),
                        key=lambda x: (-x[0], x[1]))
        # the most frequent words have a bin each, the other common words one, all other words one
        bins = np.minimum(np.arange(len(common)), rules.single_words)
        shares = np.bincount(bins, weights=[n for n, _ in common], minlength=rules.single_words + 2) if common \
            else np.zeros(rules.single_words + 2)
        shares[-1] = total - shares.sum()
        hashes = np.array([k for _, k in common], dtype=np.int64).view(np.uint64)
        order = np.argsort(hashes)
        references[name] = Reference(classes / max(1, classes.sum()), hashes[order], bins[order], shares / total)
    return references


def repeated_words(w, window: int = WINDOW) -> np.ndarray:
    """Per row: words inside a window that the row holds twice or more."""
    value, at = windows_hashed(w.hashes(), w.row, window)
    counts = np.zeros(len(w.first) - 1, dtype=np.int64)
    if not len(value):
        return counts
    row = w.row[at]
    # rows are told apart by another multiplier each, so that one sort finds what repeats within a row
    key = mix(value ^ mix(row.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    same = ordered[1:] == ordered[:-1]
    twice = np.zeros(len(key), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(len(w.row) + 1, dtype=np.int64)
    edge[at[twice]] += 1
    np.subtract.at(edge, at[twice] + window, 1)
    return sums((np.cumsum(edge)[:-1] > 0).astype(np.int64), w.first)


def duplicate_lines(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Per row: lines with a word that equal an earlier line of the row."""
    counts = np.zeros(len(offsets) - 1, dtype=np.int64)
    starts, ends = runs(data != 0x0A, offsets)
    if not len(starts):
        return counts
    filled = np.add.reduceat(~IS_SPACE[data], starts) > 0
    row = rows_of(offsets, starts)
    key = mix(runs_hashed(data, starts, LINE_VALUE) ^ mix(row.astype(np.uint64) + np.uint64(1)))[filled]
    _, first = np.unique(key, return_index=True)
    later = np.ones(len(key), dtype=bool)
    later[first] = False
    return np.bincount(row[filled][later], minlength=len(counts)).astype(np.int64)



def measured(references: dict[str, Reference], rules: Rules = Rules()):
    """Arrow function over (text, lang) columns that returns ``RESULT`` as a struct."""
    def of_slice(names, index, data, offsets):
        w = words(data, offsets)
        lead = ((data & 0xC0) != 0x80) & ~IS_SPACE[data]
        n_words, repeats = w.counts, repeated_words(w)
        failed = (n_words < 10) | (100 * repeats > 20 * n_words)
        classes = _class_counts(data, offsets)
        chars = classes.sum(axis=1)
        class_distance = np.full(len(n_words), np.nan)
        word_distance = np.full(len(n_words), np.nan)
        hashes = w.hashes()
        for i in np.unique(index):
            ref = references.get(names[i])
            if ref is None:
                continue
            mine = index == i
            enough = mine & (chars >= rules.min_chars)
            class_distance[enough] = js_distance(classes[enough] / chars[enough, None], ref.classes[None])
            enough = mine & (n_words >= rules.min_words)
            if not len(ref.hashes) or not enough.any():
                continue
            inside = enough[w.row]
            h = hashes[inside]
            at = np.minimum(np.searchsorted(ref.hashes, h), len(ref.hashes) - 1)
            bins = len(ref.shares)
            column = np.where(ref.hashes[at] == h, ref.bins[at], bins - 1)
            histogram = np.bincount(w.row[inside] * bins + column, minlength=len(n_words) * bins).reshape(-1, bins)
            word_distance[enough] = js_distance(histogram[enough] / n_words[enough, None], ref.shares[None])
        far = (
            np.nan_to_num(class_distance) > rules.max_class_distance + rules.class_slack / np.sqrt(np.maximum(1, chars))
        ) | (np.nan_to_num(word_distance) > rules.max_word_distance + rules.word_slack / np.sqrt(np.maximum(1, n_words)))
        return [
            n_words, sums(lead, offsets), sums(_IS_SYMBOL[data], offsets), duplicate_lines(data, offsets), repeats,
            failed, ~failed & ~far, class_distance, word_distance,
        ]

    def run(text: pa.Array, lang: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([text, lang], names=["text", "lang"])
        parts = [of_slice(*p) for p in _parts([batch])]
        names = [x.split()[0] for x in RESULT.split(", ")]
        kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] * 2
        columns = [
            pa.array(np.concatenate([p[i] for p in parts]) if parts else [], type=kind, from_pandas=kind == pa.float64())
            for i, kind in enumerate(kinds)
        ]
        return pa.StructArray.from_arrays(columns, names=names)

    return run


def quality(references: dict[str, Reference], rules: Rules = Rules()) -> Column:
    """The measures and the verdict of each row of a table with ``text`` and ``lang``, as a struct."""
    measure = measured(references, rules)

    def judge(text: pa.Array, lang: pa.Array) -> pa.Array:
        return measure(text, lang)

    return F.arrow_udf(judge, RESULT)(F.col("text").cast("string"), F.col("lang").cast("string"))


def divergence_report(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """``doc_id`` with all measures; repeated rows are judged each, other columns are ignored."""
    judged = docs.select("doc_id", quality(fit_references(docs, rules), rules).alias("_judged"))
    return judged.select("doc_id", "_judged.*")


def keep_good(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Rows of ``docs``, with all their columns, that pass."""
    return docs.where(quality(fit_references(docs, rules), rules)["kept"])
