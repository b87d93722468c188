"""Personal data by weak supervision: labelers vote on candidate spans, EM weighs the labelers, and a
classifier trained on the weighed votes decides about spans that no base rule covers.

1. Candidates are the base rules' spans and looser ones: matches that fail a base rule's check, and
   numbers grouped like phone, card or identity numbers. They are searched in lines whose bytes allow
   one only, on whole texts.
2. Pattern, gazetteer and context labelers vote for (1), against (-1) or abstain (0).
3. Votes and features are counted over all documents: a row for each combination, of which there are
   ``len(KINDS) * 3 ** labelers * 2 ** features`` at most, however large the corpus.
4. EM over the counted votes estimates each labeler's reliability and the probability of each vote
   pattern; a logistic regression on the features is trained with these probabilities.

Base spans always stay. Others are added, as kind ``number``, where a context word stands just before, the
classifier says at least one half and no base span overlaps. Null and empty texts have no spans. Spans are ``kind:start:end`` in code
points, the end exclusive, by kind and then by start."""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from buyerlens.llm.words import buffers, code_points_before, rows_of, runs, slices

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "number")
RESULT = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"

_EMAIL = re.compile(rb"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(rb"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(rb"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(rb"\+[0-9][\x20().0-9-]+[0-9]")
_LOOSE = re.compile(rb"(?<![0-9A-Za-z])\(?[0-9]{2,4}\)?(?:[\x20.-][0-9]{2,5}){2,4}(?![0-9A-Za-z])")

# ---- gazetteers: fixed values of public registries ----
_TOP_DOMAINS = {b"com", b"org", b"net", b"edu", b"gov", b"io", b"de", b"fr", b"es", b"uk", b"it", b"nl", b"eu", b"us"}
_CARD_PREFIXES = (b"34", b"37", b"4", b"51", b"52", b"53", b"54", b"55", b"6011", b"65", b"22", b"23", b"24", b"25", b"26", b"27")
_COUNTRY_CODES = (b"1", b"7", b"20", b"27", b"30", b"31", b"32", b"33", b"34", b"36", b"39", b"40", b"41", b"43", b"44", b"45",
                  b"46", b"47", b"48", b"49", b"52", b"55", b"61", b"81", b"86", b"91")
_PRIVATE_NETS = (b"10.", b"127.", b"192.168.", b"0.", b"169.254.")
_NEAR = re.compile(rb"mail|phone|tel|call|mobile|contact|card|visa|pay|ip|host|address|ssn|passport|account|iban|name", re.I)
_FAR = re.compile(rb"version|page|isbn|issue|vol|order|item|figure|table|section|ref|price|total|score|id\b", re.I)

LABELERS = ("pattern", "gazetteer", "near_words", "far_words", "grouping")
FEATURES = ("separators", "plus", "many_digits", "near", "far", "line_mostly_digits")


def luhn(digits: bytes) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = d - 48
        if i % 2:
            n = n * 2 - 9 * (n > 4)
        total += n
    return total % 10 == 0


def _digits(piece: bytes) -> bytes:
    return re.sub(rb"[^0-9]", b"", piece)


def base_ok(kind: int, piece: bytes) -> bool:
    if kind == 0:
        return True
    if kind == 1:
        # thousands of leading zeros are more than a number may be read from
        return all(len(p) <= 3 and int(p or b"0") <= 255 for p in (p.lstrip(b"0") for p in piece.split(b".")))
    digits = _digits(piece)
    return (16 <= len(digits) <= 19 and luhn(digits)) if kind == 2 else 8 <= len(digits) <= 15


def _votes(kind: int, piece: bytes, ahead: bytes, ok: bool) -> tuple[int, ...]:
    digits = _digits(piece)
    if kind == 0:
        gazetteer = 1 if piece.rsplit(b".", 1)[-1].lower() in _TOP_DOMAINS else 0
    elif kind == 1:
        gazetteer = -1 if piece.startswith(_PRIVATE_NETS) else 0
    elif kind == 2:
        gazetteer = 1 if digits.startswith(_CARD_PREFIXES) and 13 <= len(digits) <= 19 else -1
    else:
        gazetteer = 1 if piece.startswith(b"+") and digits.startswith(_COUNTRY_CODES) else 0
    groups = [len(g) for g in re.split(rb"[^0-9]+", piece) if g]
    grouping = 1 if len(groups) > 1 and all(2 <= g <= 5 for g in groups) else -1 if len(groups) == 1 and kind == 4 else 0
    return (1 if ok else -1, gazetteer, 1 if _NEAR.search(ahead) else 0, -1 if _FAR.search(ahead) else 0, grouping)


def _features(piece: bytes, ahead: bytes, line: bytes) -> tuple[int, ...]:
    return (
        int(bool(re.search(rb"[0-9][ .()-]+[0-9]", piece))), int(piece.startswith(b"+")), int(len(_digits(piece)) >= 9),
        int(bool(_NEAR.search(ahead))), int(bool(_FAR.search(ahead))), int(2 * len(_digits(line)) > len(line)),
    )


def candidates(data: np.ndarray, offsets: np.ndarray):
    """``(row, kind, start, end, ok, votes, features)`` of a slice's candidates, in bytes of the slice."""
    starts, ends = runs(data != 0x0A, offsets)
    if not len(starts):
        return
    digit = np.add.reduceat((data >= 48) & (data <= 57), starts, dtype=np.int64)
    at, plus = (np.add.reduceat(data == b, starts, dtype=np.int64) for b in (0x40, 0x2B))
    for i in np.flatnonzero((at > 0) | (digit >= 4)).tolist():
        s, e = int(starts[i]), int(ends[i])
        line, row = data[s:e].tobytes(), int(rows_of(offsets, starts[i : i + 1])[0])
        found, taken = [], []
        searches = ((_EMAIL, at[i]), (_IP, digit[i] >= 4), (_CARD, digit[i] >= 16), (_PHONE, plus[i] and digit[i] >= 2))
        for kind, (pattern, may) in enumerate(searches):
            for m in pattern.finditer(line) if may else ():
                ok = base_ok(kind, m[0])
                if ok:
                    taken.append(m.span())
                found.append((kind, *m.span(), ok))
        if digit[i] >= 6:
            found += [(4, *m.span(), False) for m in _LOOSE.finditer(line)]
        for kind, a, b, ok in found:
            if not ok and any(a < y and x < b for x, y in taken):
                continue
            piece, ahead = line[a:b], line[max(0, a - 24) : a]
            yield row, kind, s + a, s + b, ok, _votes(kind, piece, ahead, ok), _features(piece, ahead, line)


def _by_slice(column):
    data, offsets = buffers(column)
    for low, high in slices(offsets):
        yield low, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]


def _counted(batches):
    for batch in batches:
        table: dict = {}
        for _, data, offsets in _by_slice(batch.column(0)):
            for _, kind, _, _, _, votes, features in candidates(data, offsets):
                key = (kind, votes, features)
                table[key] = table.get(key, 0) + 1
        yield pa.RecordBatch.from_pydict({
            "kind": pa.array([k for k, _, _ in table], pa.int32()), "votes": pa.array([list(v) for _, v, _ in table], pa.list_(pa.int32())),
            "features": pa.array([list(f) for _, _, f in table], pa.list_(pa.int32())), "n": pa.array(table.values(), pa.int64()),
        })


def vote_counts(docs: DataFrame) -> DataFrame:
    """``kind, votes, features, n``: how often labelers voted so on candidates with these features."""
    return docs.select(F.col("text").cast("string")).mapInArrow(
        _counted, "kind int, votes array<int>, features array<int>, n long").groupBy("kind", "votes", "features").agg(F.sum("n").alias("n"))


@dataclass
class Votes:
    """``reliability[y, labeler, vote + 1]`` for not personal and personal, the prior, and weights."""

    reliability: np.ndarray
    prior: float
    weights: np.ndarray


def expectation_maximisation(votes: np.ndarray, n: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, float, np.ndarray]:
    """Reliabilities, prior and the probability of each vote pattern. Starts from the majority."""
    p = np.clip(0.5 + 0.2 * votes.sum(axis=1), 0.05, 0.95)
    for _ in range(rounds):
        weight = np.stack([(1 - p) * n, p * n])
        prior = (weight[1].sum() + 1) / (n.sum() + 2)
        reliability = np.stack([
            np.stack([np.stack([(w * (votes[:, j] == v)).sum() + 1 for v in (-1, 0, 1)]) for j in range(votes.shape[1])]) for w in weight
        ])
        reliability /= reliability.sum(axis=2, keepdims=True)
        log = sum(np.log(reliability[:, j, votes[:, j] + 1]) for j in range(votes.shape[1]))
        odds = log[1] - log[0] + np.log(prior / (1 - prior))
        p = 1 / (1 + np.exp(-np.clip(odds, -40, 40)))
    return reliability, float(prior), p


def _design(kind: np.ndarray, features: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones(len(kind)), np.eye(len(KINDS))[kind], features])


def train(docs: DataFrame) -> Votes:
    """The driver receives the counted combinations, never spans."""
    rows = vote_counts(docs).collect()
    if not rows:
        return Votes(np.full((2, len(LABELERS), 3), 1 / 3), 0.5, np.zeros(1 + len(KINDS) + len(FEATURES)))
    # rows come in any order; sums of doubles shall not
    rows = sorted(rows, key=lambda r: (r.kind, r.votes, r.features))
    kind, votes, features, n = (np.array([r[i] for r in rows]) for i in range(4))
    reliability, prior, p = expectation_maximisation(votes, n.astype(float))
    x, w = _design(kind, features), np.zeros(1 + len(KINDS) + len(FEATURES))
    # Newton steps of the weighed logistic regression, with a small ridge
    for _ in range(25):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (n * (p - q)) - 0.1 * w
        hessian = (x * (n * q * (1 - q))[:, None]).T @ x + 0.1 * np.eye(len(w))
        w = w + np.clip(np.linalg.solve(hessian, gradient), -2, 2)
    return Votes(reliability, prior, w)


def probability(model: Votes, kind: int, features: tuple[int, ...]) -> float:
    x = _design(np.array([kind]), np.array([features]))[0]
    return float(1 / (1 + np.exp(-np.clip(x @ model.weights, -30, 30))))


def found_by(model: Votes):
    """Arrow function from a text column to ``RESULT`` as a struct."""
    nothing = hashlib.sha256(b"").hexdigest()

    def run(column: pa.Array) -> pa.Array:
        n = len(column)
        counts, sha, spans = np.zeros((len(BASE), n), dtype=np.int64), [nothing] * n, [""] * n
        for low, data, offsets in _by_slice(column):
            points, per_row, known = None, {}, {}
            for row, kind, start, end, ok, _, features in candidates(data, offsets):
                if not ok:
                    # digits alone say nothing: without a word of context a candidate is not added
                    if not features[FEATURES.index("near")]:
                        continue
                    if (kind, features) not in known:
                        known[kind, features] = probability(model, kind, features) >= 0.5
                    if not known[kind, features]:
                        continue
                points = code_points_before(data) if points is None else points
                base = points[offsets[row]]
                per_row.setdefault(low + row, set()).add((kind if ok else 4, int(points[start] - base), int(points[end] - base)))
            for row, found in per_row.items():
                said = [(k, f"{KINDS[k]}:{s}:{e}") for k, s, e in sorted(found)]
                spans[row] = ",".join(x for _, x in said)
                sha[row] = hashlib.sha256(",".join(x for k, x in said if k < 4).encode()).hexdigest()
                for k, _ in said:
                    if k < 4:
                        counts[k, row] += 1
        return pa.StructArray.from_arrays(
            [*map(pa.array, counts), pa.array(sha, pa.string()), pa.array(spans, pa.string())],
            names=[x.split()[0] for x in RESULT.split(", ")])

    return run


def personal_data(model: Votes, text: Column | str = "text") -> Column:
    """The spans of a text column, as a struct."""
    find = found_by(model)

    def apply(column: pa.Array) -> pa.Array:
        return find(column)

    return F.arrow_udf(apply, RESULT)((F.col(text) if isinstance(text, str) else text).cast("string"))


def personal_report(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id and its spans."""
    return docs.select("doc_id", personal_data(train(docs)).alias("_found")).select("doc_id", "_found.*")
