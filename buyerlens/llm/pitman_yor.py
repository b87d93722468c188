"""A hierarchical Pitman-Yor language model, sampled over a cluster, and texts scored with it.

Each word that occurs opens a context restaurant; the words that follow it are its customers. All context
restaurants share one parent: each of their tables is a customer there. The parent's base measure gives
unknown words half of its mass and shares the rest among the known words.

Counts (word, context) are dealt by word, so one task has a word's tables in all restaurants and in the
parent. A sweep seats all customers of each dish anew, first in the contexts, then in the parent: ``t``
tables for ``c`` customers have the probability ``~ S(c, t) * new ** t`` (generalised Stirling numbers),
where a new table has the odds ``new = (strength + discount * tables) * P(word | parent)``. It is what
single moves tend to, exact up to ``EXACT`` customers and by the saddle point above (`Seating`).
Totals of whole restaurants are those of the pass before. Predictive probabilities are averaged over
the samples after burn-in.

What moves between tasks are packed columns, not rows of pairs:

* A chunk of texts sends each shard of words its different pairs, once, as *asks*. The shard adds them up
  to its part of the model and keeps, per chunk, where each ask stands in it.
* Shards exchange the totals of restaurants with *desks* that hold a range of words: a shard names its
  different words once a pass, and is told their totals in the same order.
* A chunk is told the scores of its asks in their own order, without keys, and adds them up by text.

A shard holds about ``shard_tokens`` tokens; a word of more than ``chunk_rows`` tokens has shards of its
own. They are seated together unless it follows more than ``chunk_rows`` words; then each takes the
word's customers in the parent from the pass before. Only these words, at most one in ``chunk_rows``
tokens, and sums over the whole model pass the driver.

Random numbers are hashes of what they are for: reruns agree, whatever the partitions. A null text is
empty and has the end token alone; a null id counts as empty text for the split; repeated rows are rows
of their own. Without training tokens every token is unknown."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from buyerlens.llm.words import buffers, mix, numbers, slices, words
from buyerlens.session import releasing_shuffles, remove_path, scratch_path

END_HASH = numbers(1, 211)[0]
_PAIR = numbers(2, 223) | np.uint64(1)
_DRAW = numbers(3, 227) | np.uint64(1)
STIRLING = 64
EXACT = 1024


#: Bytes of text whose pairs are counted together; a longer text is taken alone.
CHUNK_BYTES = 8 << 20


@dataclass(frozen=True)
class Settings:
    burn_in: int = 3
    samples: int = 3
    passes: int = 2
    strength: float = 1.0
    parent_strength: float = 10.0
    chunk_rows: int = 200_000
    shard_tokens: int = 1_000_000


@dataclass
class Model:
    """What it learns from, ``texts(text)``. Fitting and scoring are one job, as the texts to score ask
    for their pairs while those of the training texts are counted."""

    texts: DataFrame
    settings: Settings


def held_out(doc_id: Column) -> Column:
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 5 == 1


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of each row, the end after each, and where each row begins."""
    w = words(data, offsets)
    begin = np.concatenate([np.zeros(1, dtype=np.int64), np.cumsum(w.counts + 1)])
    out = np.full(int(begin[-1]), END_HASH, dtype=np.uint64)
    out[np.arange(len(w.row)) + w.row] = w.hashes(lower=True)
    return out, begin


def _place(known: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Index of each wanted hash in the sorted ``known``, or -1."""
    if not len(known):
        return np.full(len(wanted), -1, dtype=np.int64)
    at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
    return np.where(known[at] == wanted, at, -1)


def _pair_key(word: np.ndarray, context: np.ndarray) -> np.ndarray:
    return mix(word * _PAIR[0] + mix(context) * _PAIR[1])


def _packed(*columns: np.ndarray) -> bytes:
    """Columns of numbers, whole ones as narrow as their greatest, byte plane by byte plane, compressed."""
    body, head = [], []
    for x in columns:
        if x.dtype.kind in "iu":
            x = x.astype(np.min_scalar_type(x.max())) if len(x) else x.astype(np.uint8)
        head.append(f"{x.dtype.str}:{len(x)}")
        body.append(np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.itemsize).T.tobytes())
    return ",".join(head).encode() + b"\n" + pa.compress(b"".join(body), codec="zstd", asbytes=True)


def _unpacked(data: bytes) -> list[np.ndarray]:
    """The columns, whole numbers as int64 and hashes as uint64."""
    head, body = data.split(b"\n", 1)
    kinds = [(np.dtype(kind), int(n)) for kind, n in (x.split(":") for x in head.decode().split(","))]
    raw = np.frombuffer(pa.decompress(body, sum(k.itemsize * n for k, n in kinds), codec="zstd"), dtype=np.uint8)
    out, at = [], 0
    for kind, n in kinds:
        x = np.ascontiguousarray(raw[at : at + kind.itemsize * n].reshape(kind.itemsize, n).T).view(kind).ravel()
        out.append(x.astype(np.int64) if kind.kind in "iu" and kind.itemsize < 8 else x)
        at += kind.itemsize * n
    return out


def _steps(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Differences of runs that ascend, with the first of each run whole."""
    out = np.diff(x, prepend=0)
    out[first] = x[first]
    return out


def _walked(steps: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """What `_steps` were taken of; ``sizes`` are those of the runs, none of them empty."""
    at = np.cumsum(steps)
    first = np.cumsum(sizes) - sizes
    return at - np.repeat(at[first] - steps[first], sizes)


def _rows(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(columns)


def _chunks(batches, column: int):
    """Up to ``CHUNK_BYTES`` of text: its rows, its different tokens, which of them each token is, and how
    many tokens each row has."""
    for batch in batches:
        data, offsets = buffers(batch.column(column))
        for low, high in slices(offsets, CHUNK_BYTES):
            at = offsets[low : high + 1]
            found = [_tokens(data[at[a] : at[b]], at[a : b + 1] - at[a]) for a, b in slices(at)]
            counts = np.concatenate([np.diff(begin) for _, begin in found])
            found = np.concatenate([tokens for tokens, _ in found])
            yield batch.slice(low, high - low), *np.unique(found, return_inverse=True), counts


def _word_counts(batches):
    for _, h, w, _ in _chunks(batches, 1):
        yield _rows(h=h.view(np.int64), n=np.bincount(w))


@dataclass
class Deal:
    """Which shard has which pairs. Words of ``hot``, sorted, have ``parts`` shards of their own each, from
    ``start`` on; all others are dealt to ``shards`` by their hash."""

    shards: int
    hot: np.ndarray
    parts: np.ndarray

    @property
    def start(self) -> np.ndarray:
        return self.shards + np.cumsum(self.parts) - self.parts

    def of_words(self, h: np.ndarray) -> np.ndarray:
        return ((h >> np.uint64(32)) * np.uint64(self.shards) >> np.uint64(32)).astype(np.int64)

    def of_pairs(self, vocabulary: np.ndarray, h: np.ndarray, u: np.ndarray) -> np.ndarray:
        shard, hot = self.of_words(vocabulary)[h], _place(self.hot, vocabulary)[h]
        at = np.flatnonzero(hot >= 0)
        part = mix(vocabulary[u[at]]) % self.parts[hot[at]].astype(np.uint64)
        shard[at] = self.start[hot[at]] + part.astype(np.int64)
        return shard


def _asked(deal):
    """Per chunk: its texts, with the number of the ask of each token, and its asks by shard. A shard's asks
    are sorted by word and context; ``c`` of them is how often they occur in training texts."""
    def run(batches):
        hot = deal.value
        number = TaskContext.get().partitionId() << 33
        for batch, vocabulary, w, counts in _chunks(batches, 1):
            code = w * len(vocabulary)
            code[0] += np.searchsorted(vocabulary, END_HASH)
            code[1:] += w[:-1]
            del w
            code, ask = np.unique(code, return_inverse=True)
            h, u = np.divmod(code, len(vocabulary))
            shard = hot.of_pairs(vocabulary, h, u)
            order = np.argsort(shard, kind="stable")
            rank = np.empty_like(order)
            rank[order] = np.arange(len(order))
            ask, h, u, shard = rank[ask], h[order], u[order], shard[order]
            del code, order, rank
            train = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            c = np.bincount(ask[np.repeat(train, counts)], minlength=len(h))
            ids, asked = batch.column(0), batch.column(3).to_numpy(zero_copy_only=False).astype(np.uint8)
            known = ids.is_valid().to_numpy(zero_copy_only=False).astype(np.uint8)
            ids = ids.fill_null(0).to_numpy(zero_copy_only=False).view(np.uint64)
            before = np.repeat(np.arange(len(counts)) * len(h), counts)
            ask += before
            ask.sort()
            ask -= before
            ask = _steps(ask, np.cumsum(counts) - counts)
            del before
            to, data = [-1 - number], [_packed(ids, known, asked, counts, ask)]
            edges = np.flatnonzero(np.diff(shard, prepend=-1, append=-1))
            for low, high in zip(edges[:-1], edges[1:]):
                dish = np.flatnonzero(np.diff(h[low:high], prepend=-1))
                contexts, at = np.unique(u[low:high], return_inverse=True)
                to.append(int(shard[low]))
                data.append(_packed(
                    vocabulary[h[low:high][dish]], np.diff(dish, append=high - low), vocabulary[contexts], _steps(at, dish), c[low:high]))
            yield _rows(shard=pa.array(to, pa.int64()), m=pa.array([number] * len(to), pa.int64()), data=pa.array(data, pa.binary()))
            number += 1
    return run


_TEXTS, _SHARD, _PLACES = 2, 0, 1


def _merged(deal, table: pa.Table) -> pa.Table:
    """A shard from the asks of all chunks, and per chunk the places of its asks. Pairs that no training text
    has are left out, and so are words without any; but a word with other shards, which may have some, keeps
    one pair of count 0. Rows of texts are passed on."""
    shard, m, data = (table.column(name).to_pylist() for name in ("shard", "m", "data"))
    if shard[0] < 0:
        return table.append_column("kind", pa.array([_TEXTS] * len(m), pa.int32())).select(["shard", "m", "data", "kind"])
    asks = [_unpacked(x) for x in data]
    names = np.unique(np.concatenate([x[i] for x in asks for i in (0, 2)]))
    codes, counts, dishes = [], [], []
    for h, sizes, contexts, at, c in asks:
        dish = np.searchsorted(names, h)
        codes.append(np.repeat(dish, sizes) * len(names) + np.searchsorted(names, contexts)[_walked(at, sizes)])
        counts.append(c)
        dishes.append(dish)
    code, where = np.unique(np.concatenate(codes), return_inverse=True)
    c = np.bincount(where, weights=np.concatenate(counts)).astype(np.int64)
    kept = c > 0
    if shard[0] >= deal.value.shards:
        own = np.flatnonzero(np.diff(code // len(names), prepend=-1))
        kept[own[np.add.reduceat(c, own) == 0]] = True
    place = np.cumsum(kept) - 1
    h, u = np.divmod(code[kept], len(names))
    used = np.unique(np.concatenate([h, u]))
    first = np.flatnonzero(np.diff(h, prepend=-1))
    dish = h[first]
    at = np.searchsorted(used, u)
    out = [_packed(names[used], np.searchsorted(used, dish), np.diff(first, append=len(h)), _steps(at, first), c[kept])]
    end = 0
    for x, own in zip(asks, dishes):
        begin, end = end, end + len(x[4])
        mine = where[begin:end]
        seen, known = kept[mine], np.isin(own, dish)
        out.append(_packed(
            np.packbits(seen), np.diff(place[mine[seen]], prepend=0), np.packbits(known), np.diff(np.searchsorted(dish, own[known]), prepend=0), x[1]))
    n = len(out)
    return pa.table({
        "shard": pa.array([shard[0]] * n, pa.int64()), "m": pa.array([-1, *m], pa.int64()), "data": pa.array(out, pa.binary()),
        "kind": pa.array([_SHARD] + [_PLACES] * (n - 1), pa.int32())})


def _uniform(key: np.ndarray, *steps: int) -> np.ndarray:
    x = key.copy()
    for s, step in zip(_DRAW, steps):
        x = x + np.uint64(int(s) * (step + 1) & 0xFFFFFFFFFFFFFFFF)
    return (mix(x) >> np.uint64(11)).astype(np.float64) * 2.0**-53


def log_stirling(discount: float, most: int = STIRLING) -> np.ndarray:
    """Logarithms of the generalised Stirling numbers ``S(c, t)`` for up to ``most`` customers."""
    log = np.full((most + 1, most + 1), -np.inf)
    log[1, 1] = 0
    t = np.arange(1, most + 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        for c in range(2, most + 1):
            log[c, 1:] = np.logaddexp(log[c - 1, :-1], np.log(np.maximum(0, c - 1 - discount * t)) + log[c - 1, 1:])
    return log


def alone_odds(discount: float, most: int = STIRLING) -> np.ndarray:
    """``S(c-1, t-1) / S(c, t)`` for up to ``most`` customers: how likely one of ``c`` at ``t`` tables
    sits alone."""
    log = log_stirling(discount, most)
    ratio = np.zeros_like(log)
    ratio[1, 1] = 1
    held = np.isfinite(log[2:, 1:])
    with np.errstate(invalid="ignore"):
        ratio[2:, 1:] = np.where(held, np.exp(log[1:-1, :-1] - log[2:, 1:]), 0)
    return ratio


class Seating:
    """Draws the tables of dishes with ``c`` customers from ``P(t) ~ S(c, t) * new ** t``, where ``new``
    are the odds of a new table: all customers of a dish are seated anew at once.

    Up to ``EXACT`` customers the numbers are exact. Above, ``S(c, t) / S(c, t - 1)`` comes from how
    likely a customer sits alone, by the saddle point: tables have sizes of the law with the generating
    function ``1 - (1 - z) ** discount``, tilted to the mean ``c / t``, corrected as at ``EXACT`` customers."""

    def __init__(self, discount: float):
        self.discount, self.log = discount, log_stirling(discount, EXACT)
        rest = np.concatenate([-np.log1p(-np.geomspace(1e-7, 0.5, 4000)), np.linspace(np.log(2), 690, 8000)[1:]])
        z, some = -np.expm1(-rest), -np.expm1(-discount * rest)
        self.size = np.log(discount * z / some) + (1 - discount) * rest
        self.single = discount * z / some
        # where one table holds nearly all, which depends on t / c ** discount, the saddle point is corrected
        t = np.arange(2, EXACT + 1)
        self.spread = np.log(t) - discount * np.log(EXACT)
        self.factor = np.ones(len(t))
        self.factor = np.exp(self.log[EXACT - 1, t - 1] - self.log[EXACT, t]) / self._alone(float(EXACT), t)

    def _alone(self, c, t):
        odds = (t - 1) / c * np.interp(np.log(c / t), self.size, self.single)
        return np.minimum(odds * np.interp(np.log(t) - self.discount * np.log(c), self.spread, self.factor), 1 - 1e-9)

    def _ratio(self, c, t, log_new):
        """``log(P(t) / P(t - 1))`` for ``t`` of at least 2."""
        if c.max() <= EXACT:
            n, at = c.astype(np.int64), np.clip(t, 2, c).astype(np.int64)
            return log_new + self.log[n, at] - self.log[n, at - 1]
        return log_new + np.log1p(-self._alone(c, t - 1)) - np.log(self._alone(c, t)) - np.log(c - 1 - self.discount * (t - 1))

    def _many(self, c, log_new, u):
        low, high = np.ones(len(c)), c.copy()
        for _ in range(int(np.log2(c.max())) + 2):
            at = np.ceil((low + high) / 2)
            up = (at > 1) & (self._ratio(c, np.maximum(at, 2), log_new) >= 0)
            low, high = np.where(up, at, low), np.where(up, high, np.maximum(low, at - 1))
        near = np.clip(low, 2, c - 1)
        far = np.minimum(near + np.maximum(1, near // 8), c)
        fall = self._ratio(c, near, log_new) - self._ratio(c, far, log_new)
        width = np.sqrt(np.maximum(1, far - near) / np.maximum(fall, 1e-9))
        # 128 places, eight deviations to each side of the mode
        stride = np.maximum(1, np.ceil(width / 8))
        place = np.maximum(1, low - 64 * stride)[:, None] + stride[:, None] * np.arange(128)
        middle = np.minimum(place[:, :-1] + (stride[:, None] + 1) / 2, c[:, None])
        weight = np.zeros(place.shape)
        np.cumsum(stride[:, None] * self._ratio(c[:, None], middle, log_new[:, None]), axis=1, out=weight[:, 1:])
        weight[place > c[:, None]] = -np.inf
        total = np.cumsum(np.exp(weight - weight.max(axis=1, keepdims=True)), axis=1)
        wanted = u * total[:, -1]
        i = np.minimum((total <= wanted[:, None]).sum(axis=1), place.shape[1] - 1)
        row = np.arange(len(c))
        under = np.where(i > 0, total[row, np.maximum(i - 1, 0)], 0)
        inside = (wanted - under) / np.maximum(total[row, i] - under, 1e-300)
        return np.clip(place[row, i] + np.floor(np.clip(inside, 0, 1) * stride) - stride // 2, 1, c)

    def draw(self, c, new, key, *steps: int):
        t = np.minimum(c, 1).astype(np.float64)
        few = np.flatnonzero((c > 1) & (c <= STIRLING))
        few = few[np.argsort(c[few], kind="stable")]
        u, log_new = _uniform(key, *steps), np.log(new)
        for n in range(2, STIRLING + 1):
            rows = few[np.searchsorted(c[few], n) : np.searchsorted(c[few], n, side="right")]
            if len(rows):
                w = self.log[n, 1 : n + 1] + log_new[rows, None] * np.arange(1, n + 1)
                total = np.cumsum(np.exp(w - w.max(axis=1, keepdims=True)), axis=1)
                t[rows] = 1 + np.minimum((total <= (u[rows] * total[:, -1])[:, None]).sum(axis=1), n - 1)
        for many in (np.flatnonzero((c > STIRLING) & (c <= EXACT)), np.flatnonzero(c > EXACT)):
            for at in range(0, len(many), 4096):
                rows = many[at : at + 4096]
                t[rows] = self._many(c[rows].astype(np.float64), log_new[rows], u[rows])
        return t


@lru_cache(maxsize=4)
def seating(discount: float) -> Seating:
    return Seating(discount)


@dataclass
class Totals:
    """The whole parent restaurant: its customers and tables."""

    customers: float
    tables: float


_MERGED = "shard long, m long, data binary, kind int"
_REQUEST = "desk long, shard long, data binary, n1 long, n2 long"
_SUMS = ("types", "tokens", "above", "t0", "w1", "w2", "n1", "n2")
_REPLY = "shard long, desk long, data binary, split array<long>, " + ", ".join(f"{name} long" for name in _SUMS)


def _shard(data: bytes):
    """Words of a shard, its dishes among them, where each dish begins and how many pairs it has, and per
    pair its context among the words and its count."""
    names, dish, sizes, at, c = _unpacked(data)
    return names.astype(np.uint64), dish, np.cumsum(sizes) - sizes, sizes, _walked(at, sizes), c


def _requests(deal, shard: int, names, *columns, n1: int = 0, n2: int = 0) -> pa.RecordBatch:
    """One row for each desk: words of its range and numbers of them."""
    desk = deal.value.of_words(names)
    edges = np.flatnonzero(np.diff(desk, prepend=-1, append=-1))
    data = [_packed(names[a:b], *(x[a:b].astype(np.int64) for x in columns)) for a, b in zip(edges[:-1], edges[1:])]
    n = len(data)
    return _rows(
        desk=pa.array(desk[edges[:-1]]), shard=pa.array([shard] * n, pa.int64()), data=pa.array(data, pa.binary()),
        n1=pa.array(([n1] + [0] * n)[:n], pa.int64()), n2=pa.array(([n2] + [0] * n)[:n], pa.int64()))


def _totals_of(names, dish, begin, at, c, t, t0):
    """Per word of a shard: tables as a context, and as a dish customers of the parent, tables there and count."""
    n = len(names)
    above, own, count = np.zeros(n), np.zeros(n), np.zeros(n)
    if len(dish):
        above[dish], own[dish], count[dish] = np.add.reduceat(t, begin), t0, np.add.reduceat(c, begin)
    return np.bincount(at, weights=t, minlength=n), above, own, count


def _first_requests(deal):
    """Requests with one table for each pair, and one in the parent for each word."""
    def run(batches):
        for batch in batches:
            for shard, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                names, dish, begin, _, at, c = _shard(data)
                totals = _totals_of(names, dish, begin, at, c, np.minimum(c, 1), np.ones(len(dish)))
                yield _requests(deal, shard, names, *totals, n1=int((c == 1).sum()), n2=int((c == 2).sum()))
    return run


def _served(rows: int):
    """A desk adds up what shards say of its words and tells each the totals of those it named."""
    def run(table: pa.Table) -> pa.Table:
        asks = [_unpacked(x) for x in table.column("data").to_pylist()]
        names, where = np.unique(np.concatenate([x[0] for x in asks]).astype(np.uint64), return_inverse=True)
        tables, above, _, c = (np.bincount(where, weights=np.concatenate([x[i] for x in asks])).astype(np.int64) for i in (1, 2, 3, 4))
        t0 = np.zeros(len(names), dtype=np.int64)  # the parts of a word have the same, as one dish
        np.maximum.at(t0, where, np.concatenate([x[3] for x in asks]))
        t0[c == 0] = 0
        n, end, data = len(asks), 0, []
        for x in asks:
            begin, end = end, end + len(x[0])
            at = where[begin:end]
            data.append(_packed(c[at], tables[at], above[at]))
        sums = [(c > 0).sum(), c.sum(), above.sum(), t0.sum(), (above == 1).sum(), (above == 2).sum()]
        split = names[above > rows].view(np.int64).tolist()
        out = {"shard": table.column("shard"), "desk": table.column("desk"), "data": pa.array(data, pa.binary()),
               "split": pa.array([split] + [[]] * (n - 1), pa.list_(pa.int64()))}
        out |= {name: pa.array([int(x)] + [0] * (n - 1), pa.int64()) for name, x in zip(_SUMS, sums)}
        return pa.table(out | {name: table.column(name) for name in ("n1", "n2")})
    return run


def _sample(chunk, totals: Totals, types: int, discounts, s: Settings, keep: bool):
    """Sample the tables of whole dishes, or parts of them; rows are sorted by ``h`` and ``u``. Of a part,
    ``known_above`` are the customers of its whole dish in the parent; of others it is -1. Returns per row
    the tables and those of its dish in the parent; or averaged, the probability of its dish in the
    parent, its own, and the weight of the parent."""
    h, u, c, customers, tables, known_above = chunk
    d, d0 = discounts
    key = _pair_key(h, u)
    new_dish = np.ones(len(h), dtype=bool)
    new_dish[1:] = h[1:] != h[:-1]
    first = np.flatnonzero(new_dish)
    dish = np.cumsum(new_dish) - 1
    dish_key = mix(h[first])
    c = c.astype(np.float64)
    seats, seats0 = seating(d), seating(d0)
    base = 0.5 / max(1, types)
    parent_new = np.full(len(first), (s.parent_strength + d0 * totals.tables) * base)
    scale = s.strength + d * tables
    room = s.strength + customers
    total = s.parent_strength + totals.customers

    def above_of(t):
        return np.where(known_above[first] >= 0, known_above[first], np.add.reduceat(t, first))

    t = np.minimum(c, 1)
    above = above_of(t)
    t0 = seats0.draw(above, parent_new, dish_key, 0, 1)
    p = (above - d0 * t0 + parent_new) / total
    mean, mean_pair = np.zeros(len(first)), np.zeros(len(h))
    for sweep in range(s.burn_in + s.samples):
        t = seats.draw(c, scale * p[dish], key, sweep, 0)
        above = above_of(t)
        t0 = seats0.draw(above, parent_new, dish_key, 1 + sweep, 1)
        p = (above - d0 * t0 + parent_new) / total
        if sweep >= s.burn_in:
            mean += p
            mean_pair += (c - d * t + scale * p[dish]) / room
    if not keep:
        return t, t0[dish]
    return mean[dish] / s.samples, mean_pair / s.samples, scale / room


def _sampled(left: pa.Table, right: pa.Table, totals: Totals, types: int, discounts, s: Settings, keep: bool):
    """Sample the shards of a group: per shard its number, arrays, totals of its words and what `_sample`
    returns. Only shards of one word are together, so its pairs are sorted anew."""
    replies: dict = {}
    for shard, desk, data in zip(*(right.column(name).to_pylist() for name in ("shard", "desk", "data"))):
        replies.setdefault(shard, []).append((desk, data))
    shards, columns = [], []
    for shard, kind, data in zip(*(left.column(name).to_pylist() for name in ("shard", "kind", "data"))):
        if kind != _SHARD:
            continue
        x = names, dish, begin, sizes, at, c = _shard(data)
        if not len(c):
            continue
        told = [_unpacked(d) for _, d in sorted(replies[shard])]
        customers, tables, above = (np.concatenate([r[i] for r in told]).astype(np.float64) for i in range(3))
        shards.append((shard, x, customers, tables))
        known = above[dish] if left.column("split")[0].as_py() else np.full(len(dish), -1.0)
        columns.append((np.repeat(names[dish], sizes), names[at], c, customers[at], tables[at], np.repeat(known, sizes)))
    if not shards:
        return
    rows = [np.concatenate(x) for x in zip(*columns)]
    order = np.lexsort((rows[1], rows[0])) if len(shards) > 1 else np.arange(len(rows[0]))
    rows = [x[order] for x in rows] if len(shards) > 1 else rows
    dishes = np.append(np.flatnonzero(np.diff(rows[0].view(np.int64), prepend=~rows[0][:1].view(np.int64))), len(order))
    found, low = [], 0
    while low < len(order):  # whole dishes, of ``chunk_rows`` pairs together or one
        high = int(dishes[max(np.searchsorted(dishes, low + s.chunk_rows, side="right") - 1, np.searchsorted(dishes, low) + 1)])
        found.append(_sample([x[low:high] for x in rows], totals, types, discounts, s, keep))
        low = high
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    found = [np.concatenate(x)[back] for x in zip(*found)]
    end = 0
    for shard, x, customers, tables in shards:
        begin, end = end, end + len(x[5])
        yield shard, x, customers, tables, [f[begin:end] for f in found]


def _totals_again(deal, *state):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for shard, (names, dish, begin, _, at, c), _, _, (t, t0) in _sampled(left, right, *state, keep=False):
            out.append(_requests(deal, shard, names, *_totals_of(names, dish, begin, at, c, t, t0[begin])))
        return pa.Table.from_batches(out, _requests(deal, 0, np.zeros(0, dtype=np.uint64)).schema)
    return run


def _answers(unknown: float, totals, types, discounts, s):
    """Per chunk and shard, in the order of its asks: what each adds to the score of a text in which all
    words and contexts are new, and how often each word occurs. A word's score holds what it adds as
    the context of the next: each text has every token, its end too, once as a context."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        values = {}
        for shard, (names, dish, begin, sizes, _, _), customers, tables, (p, pair, parent) in _sampled(left, right, totals, types, discounts, s, keep=True):
            as_context = np.log10((s.strength + discounts[0] * tables[dish]) / (s.strength + customers[dish]))
            word = np.where(customers[dish] > 0, np.log10(p[begin] / unknown) + as_context, 0.0)
            both = np.repeat(word, sizes) + np.log10(pair) - np.log10(parent * p)
            values[shard] = both, np.append(word, 0.0), np.append(customers[dish], 0)
        none = np.zeros(0), np.zeros(1), np.zeros(1)
        out: dict = {"m": [], "shard": [], "data": []}
        for shard, m, kind, data in zip(*(left.column(name).to_pylist() for name in ("shard", "m", "kind", "data"))):
            if kind == _PLACES:
                both, word, count = values.get(shard, none)
                seen, place, known, dish, sizes = _unpacked(data)
                own = np.full(len(sizes), len(word) - 1)
                own[np.flatnonzero(np.unpackbits(known.astype(np.uint8), count=len(sizes)))] = np.cumsum(dish)
                value = np.repeat(word[own], sizes)
                value[np.flatnonzero(np.unpackbits(seen.astype(np.uint8), count=len(value)))] = both[np.cumsum(place)]
                out["m"].append(m)
                out["shard"].append(shard)
                out["data"].append(_packed(value, sizes, count[own].astype(np.int64)))
        return pa.table({"m": pa.array(out["m"], pa.int64()), "shard": pa.array(out["shard"], pa.int64()), "data": pa.array(out["data"], pa.binary())})
    return run


_SCORED = "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _summed(tokens: int, types: int, unknown: float):
    """A chunk's texts with the answers to its asks added up."""
    def run(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table.column("shard").to_pylist(), table.column("data").to_pylist()))
        ids, known, asked, counts, steps = _unpacked(rows[0][1])
        answers = [_unpacked(data) for _, data in rows[1:]]
        ask = _walked(steps, counts)
        begin = np.cumsum(counts) - counts
        value = np.concatenate([x[0] for x in answers])
        count = np.concatenate([np.repeat(x[2], x[1]) for x in answers])

        def added(x):
            return np.add.reduceat(x[ask], begin)

        log_total = math.log10(tokens + 0.5 * (types + 1))
        out = {
            "doc_id": pa.array(ids.astype(np.uint64).view(np.int64), pa.int64(), mask=known == 0), "n_tokens": pa.array(counts, pa.int64()),
            "n_known": pa.array(added((count > 0).astype(np.int64)), pa.int64()), "train_tokens": pa.array(np.full(len(counts), tokens), pa.int64()),
            "base_score": pa.array(added(np.log10(count + 0.5)) - counts * log_total), "score": pa.array(added(value) + counts * math.log10(unknown)),
        }
        return pa.table(out).filter(pa.array(asked == 1))
    return run


def _scores(texts: DataFrame, s: Settings) -> DataFrame:
    """Scores of the rows of ``texts(doc_id, text, train, asked)`` that are ``asked``, learnt from those of ``train``."""
    spark = texts.sparkSession
    work = scratch_path(spark)

    def stored(df: DataFrame, name: str, *by: str) -> DataFrame:
        df.write.partitionBy(*by).option("compression", "none").parquet(f"{work}/{name}")  # packed columns are compressed
        return spark.read.schema(df.schema).parquet(f"{work}/{name}")

    with releasing_shuffles(spark):
        counted = texts.mapInArrow(_word_counts, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
        row = counted.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.collect_list(F.when(F.col("n") > s.chunk_rows, F.struct("h", "n"))).alias("hot")).first()
        hot = sorted((h & 0xFFFFFFFFFFFFFFFF, math.ceil(n / s.chunk_rows)) for h, n in row.hot)
        deal = Deal(max(1, math.ceil(row.n / s.shard_tokens)), np.array([h for h, _ in hot], dtype=np.uint64), np.array([n for _, n in hot], dtype=np.int64))
        sent = spark.sparkContext.broadcast(deal)
        asks = texts.mapInArrow(_asked(sent), "shard long, m long, data binary")
        kept = stored(asks.groupBy("shard").applyInArrow(lambda table: _merged(sent, table), _MERGED), "kept", "kind")

        def served(requests: DataFrame, name: str):
            replies = stored(requests.groupBy("desk").applyInArrow(_served(s.chunk_rows), _REPLY), name)
            sums = replies.agg(*[F.coalesce(F.sum(x), F.lit(0)).alias(x) for x in _SUMS], F.flatten(F.collect_list("split")).alias("split")).first()
            return replies, sums

        replies, sums = served(kept.where(F.col("kind") == _SHARD).select("shard", "data").mapInArrow(_first_requests(sent), _REQUEST), "replies-0")
        tokens, types = sums.tokens, sums.types
        totals = Totals(float(sums.above), float(sums.t0))

        def discount(n1: int, n2: int) -> float:
            return min(0.95, max(0.1, n1 / (n1 + 2 * n2))) if n1 + n2 else 0.5

        discounts = (discount(sums.n1, sums.n2), discount(sums.w1, sums.w2))
        # shards of a word that fits are seated as one group; the others, each by itself
        split = {h & 0xFFFFFFFFFFFFFFFF for h in sums.split}
        groups = [(int(a) + i, int(a) + (i if h in split else 0), h in split) for (h, n), a in zip(hot, deal.start) for i in range(n)]
        own = spark.createDataFrame(groups, "shard long, own long, alone boolean")

        def grouped(df: DataFrame) -> DataFrame:
            return df.join(F.broadcast(own), "shard", "left").select(
                *df.columns, F.coalesce("own", "shard").alias("group"), F.coalesce("alone", F.lit(False)).alias("split"))

        def cogrouped(kinds: Column, run, schema: str) -> DataFrame:
            left = grouped(kept.where(kinds)).groupBy("group")
            return left.cogroup(grouped(replies.select("shard", "desk", "data")).groupBy("group")).applyInArrow(run, schema)

        for i in range(1, s.passes):
            requests = cogrouped(F.col("kind") == _SHARD, _totals_again(sent, totals, types, discounts, s), _REQUEST)
            replies, sums = served(requests, f"replies-{i}")
            totals = Totals(float(sums.above), float(sums.t0))
            remove_path(spark, f"{work}/replies-{i - 1}")
        unknown = 0.5 * (s.parent_strength + discounts[1] * totals.tables) / (s.parent_strength + totals.customers)
        answers = stored(cogrouped(
            F.col("kind") != _TEXTS, _answers(unknown, totals, types, discounts, s), "m long, shard long, data binary"), "answers")
        for name in (f"replies-{s.passes - 1}", f"kept/kind={_SHARD}", f"kept/kind={_PLACES}"):
            remove_path(spark, f"{work}/{name}")
        rows = kept.where(F.col("kind") == _TEXTS).select("m", "shard", "data").unionAll(answers)
        return rows.groupBy("m").applyInArrow(_summed(tokens, types, unknown), _SCORED)


def fit(docs: DataFrame, settings: Settings = Settings()) -> Model:
    """The model of all rows of ``docs(text)``."""
    return Model(docs.select(F.col("text").cast("string")), settings)


def _with_split(scores: DataFrame) -> DataFrame:
    return scores.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def score(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    train = model.texts.select(F.lit(None).cast("long").alias("doc_id"), "text", F.lit(True).alias("train"), F.lit(False).alias("asked"))
    asked = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.lit(False).alias("train"), F.lit(True).alias("asked"))
    return _with_split(_scores(train.unionAll(asked), model.settings))


def scored(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Fit on the rows that are not held out, score all."""
    return _with_split(_scores(docs.select(
        F.col("doc_id").cast("long"), F.col("text").cast("string"), (~held_out(F.col("doc_id"))).alias("train"), F.lit(True).alias("asked")), settings))


def perplexity(scores: DataFrame) -> DataFrame:
    """Per split: tokens and perplexity of the model and of the unigram baseline."""
    def of(name: str) -> Column:
        return F.pow(F.lit(10.0), -F.sum(name) / F.sum("n_tokens"))
    return scores.groupBy("held_out").agg(F.sum("n_tokens").alias("n_tokens"), of("score").alias("perplexity"), of("base_score").alias("base_perplexity"))
