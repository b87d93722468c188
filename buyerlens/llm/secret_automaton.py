"""Secret scans by one combined deterministic automaton.

All rules are one nondeterministic automaton, made deterministic by subset construction over byte
classes and minimised by refining partitions, and stored as one array of transitions and one of the
rules that each state accepts. A pass over the bytes runs it on many segments of text in lockstep and
says which rules match in which segment. In these few, each of the named rules' own pattern gives the
spans: leftmost, not overlapping, per kind.

A segment ends at a line break or at a blank that no rule can match across: a blank inside a match
touches another blank, a quote, ``:`` or ``=``, or stands between capitals. The lockstep takes as many
steps as the longest segment is long, so a document's length costs nothing but its own bytes.

Rules beyond the base kinds add spans and never replace one. Null and empty texts have no spans. Spans
are ``kind:start:end`` in code points, the end exclusive, by start and then in the order of kinds."""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from buyerlens.llm.words import buffers, code_points_before, rows_of, slices

BASE = ("assign", "access", "hex")
RESULT = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string"

# ---- rules as small automata: a node is ("chars", bytes) or a combination ----


def chars(members: str | bytes):
    return "chars", frozenset(members.encode() if isinstance(members, str) else members)


def seq(*parts):
    return "seq", parts


def alt(*parts):
    return "alt", parts


def many(part):
    return "many", part


def maybe(part):
    return alt(seq(), part)


def times(part, n: int):
    return seq(*[part] * n)


def text(literal: str):
    return seq(*(chars(c) for c in literal))


def either_case(literal: str):
    return seq(*(chars(c.lower() + c.upper()) for c in literal))


_DIGIT, _UP, _LOW = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ALNUM = chars(_DIGIT + _UP + _LOW)
_QUOTE, _BLANK = maybe(chars("\"'")), many(chars(" "))

#: Kinds in their order: what the automaton looks for, the exact pattern, and what a match must satisfy.
#: The automaton stops at the first character of a value: counting on there would need a state for each
#: set of lengths that nested prefixes can have reached. The condition counts.
RULES = {
    "assign": (
        seq(alt(*map(either_case, ("password", "passwd", "secret", "token", "apikey", "api_key"))), _QUOTE, _BLANK,
            chars(":="), _BLANK, _QUOTE, chars(_DIGIT + _UP + _LOW + "+/_.=-")),
        rb"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        lambda m: len(m[1]) >= 12,
    ),
    "access": (seq(text("AKIA"), chars(_UP + _DIGIT)), rb"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 18),
    "hex": (times(chars(_DIGIT + "abcdef"), 16), rb"[0-9a-f]+", lambda m: len(m[0]) >= 16),
    "forge": (
        seq(text("gh"), chars("pousr"), text("_"), _ALNUM), rb"gh[pousr]_[A-Za-z0-9]+", lambda m: len(m[0]) >= 34,
    ),
    "chat": (
        seq(text("xox"), chars("abprs"), text("-"), chars(_DIGIT + _UP + _LOW + "-")),
        rb"xox[abprs]-[A-Za-z0-9-]+", lambda m: len(m[0]) >= 15,
    ),
    "maps": (
        seq(text("AIza"), chars(_DIGIT + _UP + _LOW + "_-")), rb"AIza[A-Za-z0-9_-]+", lambda m: len(m[0]) >= 39,
    ),
    "payment": (seq(text("sk_live_"), _ALNUM), rb"sk_live_[A-Za-z0-9]+", lambda m: len(m[0]) >= 24),
    "signed": (
        seq(text("eyJ"), chars(_DIGIT + _UP + _LOW + "_-")),
        rb"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]+(?:\.[A-Za-z0-9_-]+)?", lambda m: True,
    ),
    "private": (
        seq(text("-----BEGIN "), chars(_UP)),
        rb"-----BEGIN [A-Z ]*PRIVATE KEY-----", lambda m: True,
    ),
}
KINDS = tuple(RULES)
_EXACT = {kind: (re.compile(pattern), good) for kind, (_, pattern, good) in RULES.items()}


class _Nfa:
    def __init__(self):
        self.empty: list[list[int]] = []
        self.moves: list[list[tuple[frozenset, int]]] = []

    def state(self) -> int:
        self.empty.append([])
        self.moves.append([])
        return len(self.empty) - 1

    def add(self, node, start: int) -> int:
        """Build ``node`` from ``start`` on; the state where it ends."""
        kind, body = node
        if kind == "chars":
            end = self.state()
            self.moves[start].append((body, end))
            return end
        if kind == "seq":
            for part in body:
                start = self.add(part, start)
            return start
        if kind == "alt":
            end = self.state()
            for part in body:
                inner = self.state()
                self.empty[start].append(inner)
                self.empty[self.add(part, inner)].append(end)
            return end
        loop = self.state()
        self.empty[start].append(loop)
        self.empty[self.add(body, loop)].append(loop)
        return loop

    def closure(self, states) -> frozenset:
        seen, todo = set(states), list(states)
        while todo:
            for t in self.empty[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(seen)


def _determinised(nfa: _Nfa, start: int, accepts: dict[int, int]):
    """Subset construction: byte classes, transitions by state and class, accepted rules by state."""
    sets = {s for moves in nfa.moves for s, _ in moves}
    signature = {b: frozenset(i for i, s in enumerate(sets) if b in s) for b in range(256)}
    class_of_signature: dict = {}
    byte_class = np.array([class_of_signature.setdefault(signature[b], len(class_of_signature)) for b in range(256)])
    sample = [int(np.flatnonzero(byte_class == c)[0]) for c in range(len(class_of_signature))]
    first = nfa.closure([start])
    index, todo, rows, masks = {first: 0}, [first], [], []
    for states in todo:
        masks.append(sum({1 << accepts[s] for s in states if s in accepts}))
        moves = [m for s in states for m in nfa.moves[s]]
        row = []
        for b in sample:
            # a match may begin anywhere, so the start is in every set
            goal = nfa.closure({t for members, t in moves if b in members} | {start})
            if goal not in index:
                index[goal] = len(index)
                todo.append(goal)
            row.append(index[goal])
        rows.append(row)
    return byte_class, np.array(rows), np.array(masks)


def _minimised(rows: np.ndarray, masks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge states that no continuation tells apart; state 0 stays the start."""
    _, part = np.unique(masks, return_inverse=True)
    while True:
        signature = np.column_stack([part, part[rows]])
        _, first, finer = np.unique(signature, axis=0, return_index=True, return_inverse=True)
        finer = finer.ravel()
        if len(first) == part.max() + 1:
            break
        part = finer
    order = np.argsort(first)
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order))
    state = rank[finer]
    return state[rows[first[order]]], masks[first[order]]


@lru_cache(maxsize=1)
def automaton() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte classes, flat transitions (state times classes + class), accepted rules as bits."""
    nfa = _Nfa()
    start = nfa.state()
    accepts = {}
    for i, (node, _, _) in enumerate(RULES.values()):
        inner = nfa.state()
        nfa.empty[start].append(inner)
        accepts[nfa.add(node, inner)] = i
    byte_class, rows, masks = _determinised(nfa, start, accepts)
    rows, masks = _minimised(rows, masks)
    width = rows.shape[1]
    # transitions lead to where the next state's row begins
    return byte_class.astype(np.int32), (rows * width).astype(np.int32).ravel(), np.repeat(masks, width).astype(np.int32)


_TOUCH = np.zeros(256, dtype=bool)
_TOUCH[[ord(c) for c in " :=\"'"]] = True
_CAPITAL = np.zeros(256, dtype=bool)
_CAPITAL[65:91] = True


def segments(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the segments that no match leaves."""
    n = len(data)
    before, after = np.zeros(n, dtype=np.uint8), np.zeros(n, dtype=np.uint8)
    before[1:], after[:-1] = data[:-1], data[1:]
    blank = (data == 0x20) & ~_TOUCH[before] & ~_TOUCH[after] & ~(_CAPITAL[before] & _CAPITAL[after])
    cut = np.flatnonzero((data == 0x0A) | blank)
    # a segment ends before its cut, the next one begins behind it; rows end as well
    starts = np.unique(np.concatenate([offsets[:-1], cut + 1]))
    starts = starts[starts < n]
    ends = np.append(starts[1:], n)
    ends -= np.isin(ends - 1, cut, assume_unique=True) if len(cut) else 0
    keep = ends > starts
    return starts[keep], ends[keep]


def scan(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Bits of the rules that match in each segment: one pass over the bytes, segments in lockstep."""
    byte_class, goto, accepted = automaton()
    length = ends - starts
    order = np.argsort(-length, kind="stable")
    begin, length = starts[order], length[order]
    state, found = np.zeros(len(order), dtype=np.int32), np.zeros(len(order), dtype=np.int32)
    live = np.searchsorted(-length, -np.arange(int(length[0]) if len(length) else 0), side="left")
    for step, n in enumerate(live):
        state[:n] = goto[state[:n] + byte_class[data[begin[:n] + step]]]
        found[:n] |= accepted[state[:n]]
    out = np.empty(len(order), dtype=np.int32)
    out[order] = found
    return out


def find(data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, int]]:
    """``(row, start, kind, end)`` of all spans of a slice, sorted; in code points of the row."""
    starts, ends = segments(data, offsets)
    bits = scan(data, starts, ends)
    hit = np.flatnonzero(bits)
    if not len(hit):
        return []
    points = code_points_before(data)
    rows = rows_of(offsets, starts[hit])
    out = []
    for row, s, e, mask in zip(rows.tolist(), starts[hit].tolist(), ends[hit].tolist(), bits[hit].tolist()):
        piece, base = data[s:e].tobytes(), points[offsets[row]]
        for k, kind in enumerate(KINDS):
            if mask >> k & 1:
                pattern, good = _EXACT[kind]
                out += [(row, int(points[s + m.start()] - base), k, int(points[s + m.end()] - base))
                        for m in pattern.finditer(piece) if good(m)]
    return sorted(out)


def scanned():
    """Arrow function from a text column to ``RESULT`` as a struct."""
    automaton()
    nothing = hashlib.sha256(b"").hexdigest()

    def run(column: pa.Array) -> pa.Array:
        data, offsets = buffers(column)
        n = len(offsets) - 1
        counts, sha, spans = np.zeros((len(BASE), n), dtype=np.int64), [nothing] * n, [""] * n
        for low, high in slices(offsets):
            per_row: dict[int, list] = {}
            for row, start, kind, end in find(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]):
                per_row.setdefault(low + row, []).append((start, kind, end))
            for row, found in per_row.items():
                said = [(k, f"{KINDS[k]}:{s}:{e}") for s, k, e in found]
                spans[row] = ",".join(x for _, x in said)
                sha[row] = hashlib.sha256(",".join(x for k, x in said if k < len(BASE)).encode()).hexdigest()
                for k, _ in said:
                    if k < len(BASE):
                        counts[k, row] += 1
        return pa.StructArray.from_arrays(
            [*map(pa.array, counts), pa.array(sha, pa.string()), pa.array(spans, pa.string())],
            names=[x.split()[0] for x in RESULT.split(", ")])

    return run


def secrets(text: Column | str = "text") -> Column:
    """The scan of a text column, as a struct."""
    scan_column = scanned()

    def apply(column: pa.Array) -> pa.Array:
        return scan_column(column)

    return F.arrow_udf(apply, RESULT)((F.col(text) if isinstance(text, str) else text).cast("string"))


def secret_report(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id and the scan."""
    return docs.select("doc_id", secrets().alias("_found")).select("doc_id", "_found.*")
