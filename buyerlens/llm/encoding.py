"""Texts to token ids with a public tokenizer, many parts of words at a time.

The vocabulary drops white space, so words between ASCII white space can be encoded apart. Words of ASCII
and plain Latin letters, which the normaliser leaves alone but for their case, are cut here, all at once,
into the parts that the tokenizer would cut them into: letters, single digits, signs and contractions.
A worker keeps the ids of parts it has met in a hash table of bounded size, by a 64-bit hash of bytes and
length, and asks the tokenizer's bare model for the others only. All other words go through the whole
tokenizer as one part, as do words that hold the string of a special token, which is that token's id, or
ordinary text if ``special`` is false. Rows are encoded in pieces of some hundred kilobytes that end at
white space, whatever the size of a batch or a text; so a worker's memory does not grow with either."""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np

from buyerlens.llm.words import BYTE_VALUE, IS_SPACE, LOWER, LOWER_VALUE, mix, powers, runs, slices

END = 1
VOCABULARY = "word_bpe_49k.json"
#: Bytes that are encoded at a time.
PIECE_BYTES = 1 << 18
#: Places of the table; it is emptied when half of them are taken, and grows only for a piece that needs more.
PLACES = 1 << 20

_SPACE, _LETTER, _SIGN, _DIGIT, _WHOLE = range(5)
_CLASS = np.full(256, _SIGN, dtype=np.uint8)
_CLASS[IS_SPACE] = _SPACE
_CLASS[ord("0") : ord("9") + 1] = _DIGIT
_CLASS[ord("a") : ord("z") + 1] = _CLASS[ord("A") : ord("Z") + 1] = _CLASS[0x80:] = _LETTER
# control signs and all but the lead bytes of U+00C0 to U+017F: letters that mostly have one lower-case letter each
# and no decomposition to compose again
_ODD = np.zeros(256, dtype=bool)
_ODD[:0x20] = _ODD[0x7F] = _ODD[0xC0:] = True
_ODD[IS_SPACE] = _ODD[0xC3:0xC6] = False
#: Those that are none: multiplication and division sign, dotted capital I, long s.
_ODD_PAIRS = ((0xC3, 0x97), (0xC3, 0xB7), (0xC4, 0xB0), (0xC5, 0xBF))
_WHOLE_STEP = np.uint64(0xA24BAED4963EE407)
_LENGTH_STEP = np.uint64(0x9FB21C651E98DF25)


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if printable, else the next free one from U+0100."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one range after the other."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


class Encoder:
    def __init__(self, path: str, special: bool = False):
        # Spark's tasks share out the cores; threads of the library would come on top
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = not special
        self.names = [t.content.encode() for t in self.whole.get_added_tokens_decoder().values()] if special else []
        self.bare = Tokenizer(self.whole.model)
        self.letters = dict(enumerate(_byte_letters()))
        self.clear()

    def clear(self, places: int = 0) -> None:
        """Empty the table: by place a hash, where its ids begin, and how many they are."""
        places = places or PLACES
        self.hashes = np.zeros(places, dtype=np.uint64)
        self.first, self.size = np.zeros(places, dtype=np.int32), np.zeros(places, dtype=np.int32)
        self.ids, self.n_ids, self.taken = np.zeros(1 << 16, dtype=np.uint32), 0, 0

    def _whole_words(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the words that are not cut here."""
        at = [np.flatnonzero(_ODD[data])]
        lead = np.flatnonzero((data[:-1] >= 0xC3) & (data[:-1] <= 0xC5))
        for a, b in _ODD_PAIRS if len(lead) else ():
            at.append(lead[(data[lead] == a) & (data[lead + 1] == b)])
        raw = data.tobytes() if self.names else b""
        for name in self.names:
            found = raw.find(name)
            while found >= 0:
                at.append(np.array([found]))
                found = raw.find(name, found + 1)
        at = np.concatenate(at)
        if not len(at):
            return at, at
        starts, ends = runs(~IS_SPACE[data], offsets)
        mine = np.unique(np.searchsorted(starts, at, side="right") - 1)
        return starts[mine], ends[mine]

    def _parts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
        """Starts, lengths and hashes of all parts, and which of them are whole words."""
        n, kind, value = len(data), _CLASS[data], LOWER_VALUE[data]
        starts, ends = self._whole_words(data, offsets)
        if len(starts):
            inside = _ranges(starts, ends - starts)
            kind[inside], value[inside] = _WHOLE, BYTE_VALUE[data[inside]] * _WHOLE_STEP
        row = np.zeros(n + 3, dtype=bool)
        row[offsets] = True
        begins = row[:n].copy()
        begins[1:] |= (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
        # an apostrophe that is all of a run of signs takes the letters of a contraction
        quote = np.flatnonzero((data == ord("'")) & (kind == _SIGN) & begins)
        if len(quote):
            letter = np.zeros(n + 3, dtype=np.uint8)
            letter[:n] = np.where(kind == _LETTER, LOWER[data], 0)
            a = np.where(row[quote + 1], 0, letter[quote + 1])
            b = np.where(row[quote + 2], 0, letter[quote + 2])
            one = (a == ord("s")) | (a == ord("t")) | (a == ord("m")) | (a == ord("d"))
            two = ((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
            begins[quote[one | two] + 1] = False
            after = np.concatenate([quote[one] + 2, quote[two] + 3])
            begins[after[after < n]] = True
        at = np.flatnonzero(begins)
        if not len(at):
            return at, at, np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=bool)
        length = np.diff(at, append=n)
        up, down = powers(n)
        hashes = np.add.reduceat(value * up, at)
        there = kind[at] != _SPACE
        at, length, hashes = at[there], length[there], hashes[there]
        # a free place holds 0
        hashes = mix(hashes * down[at] + length.astype(np.uint64) * _LENGTH_STEP) | np.uint64(1)
        return at, length, hashes, kind[at] == _WHOLE

    def _places(self, hashes: np.ndarray) -> np.ndarray:
        """The place of each hash, or the free one where the search for it ended."""
        last = len(self.hashes) - 1
        place = (hashes >> np.uint64(24)).astype(np.int64) & last
        there = self.hashes[place]
        on = np.flatnonzero((there != hashes) & (there != 0))
        while len(on):
            place[on] = (place[on] + 1) & last
            there = self.hashes[place[on]]
            on = on[(there != hashes[on]) & (there != 0)]
        return place

    def _learn(self, texts: list[str], hashes: np.ndarray, whole: bool) -> None:
        """Enter distinct parts that are not in the table, with the ids that the tokenizer gives."""
        if not whole:
            texts = [p if p.isascii() else p.encode().decode("latin-1").translate(self.letters) for p in map(str.lower, texts)]
        got = [x.ids for x in (self.whole if whole else self.bare).encode_batch_fast(texts, add_special_tokens=False)]
        size = np.fromiter(map(len, got), dtype=np.int64, count=len(got))
        first, total = self.n_ids + np.cumsum(size) - size, self.n_ids + int(size.sum())
        if total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(total, dtype=np.uint32)])
        self.ids[self.n_ids : total] = np.fromiter((x for y in got for x in y), dtype=np.uint32, count=total - self.n_ids)
        self.n_ids, self.taken = total, self.taken + len(hashes)
        while len(hashes):
            place = self._places(hashes)
            self.hashes[place] = hashes
            # of two that met on a place the last one has it
            won = self.hashes[place] == hashes
            self.first[place[won]], self.size[place[won]] = first[won], size[won]
            hashes, first, size = hashes[~won], first[~won], size[~won]

    def _known(self, data: np.ndarray, at: np.ndarray, length: np.ndarray, hashes: np.ndarray, whole: np.ndarray) -> np.ndarray:
        """The places of all parts, once the table has them."""
        if len(self.hashes) > PLACES:
            self.clear()
        place = self._places(hashes)
        missing = np.flatnonzero(self.hashes[place] != hashes)
        if not len(missing):
            return place
        new = missing[np.unique(hashes[missing], return_index=True)[1]]
        if 2 * (self.taken + len(new)) > len(self.hashes):
            new, places = np.unique(hashes, return_index=True)[1], PLACES
            while places < 2 * len(new):
                places *= 2
            self.clear(places)
            missing = np.arange(len(hashes))
        for kind in (False, True):
            mine = new[whole[new] == kind]
            if len(mine):
                texts = [data[s : s + k].tobytes().decode() for s, k in zip(at[mine].tolist(), length[mine].tolist())]
                self._learn(texts, hashes[mine], kind)
        place[missing] = self._places(hashes[missing])
        return place

    def encode(self, data: np.ndarray, offsets: np.ndarray, end: int = END) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows of a piece, the end id after each, and where each row begins."""
        at, length, hashes, whole = self._parts(data, offsets)
        place = self._known(data, at, length, hashes, whole)
        size = self.size[place].astype(np.int64)
        before = np.concatenate([np.zeros(1, dtype=np.int64), np.cumsum(size)])
        begin = before[np.searchsorted(at, offsets)] + np.arange(len(offsets))
        out, inside = np.full(int(begin[-1]), end, dtype=np.uint32), np.ones(int(begin[-1]), dtype=bool)
        inside[begin[1:] - 1] = False
        out[inside] = self.ids[_ranges(self.first[place], size)]
        return out, begin

    def long_text(self, data: np.ndarray, end: int = END) -> np.ndarray:
        """Ids of one text, piece by piece, and the end id."""
        out, low = [], 0
        while low < len(data):
            high = min(len(data), low + PIECE_BYTES)
            if high < len(data):
                spaces = np.flatnonzero(IS_SPACE[data[low:high]])
                if len(spaces):
                    high = low + int(spaces[-1]) + 1
                else:  # one word goes on
                    spaces = np.flatnonzero(IS_SPACE[data[high:]])
                    high += int(spaces[0]) + 1 if len(spaces) else len(data) - high
            out.append(self.encode(data[low:high], np.array([0, high - low]), end)[0][:-1])
            low = high
        return np.concatenate([*out, np.array([end], dtype=np.uint32)])

    def slices(self, data: np.ndarray, offsets: np.ndarray, end: int = END) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """Ranges of rows with their ids and where each row begins; a long row is a range of its own."""
        for low, high in slices(offsets):
            out, begins, n = [], [np.zeros(1, dtype=np.int64)], 0
            for a, b in slices(offsets[low : high + 1], PIECE_BYTES):
                own = offsets[low + a : low + b + 1]
                part = data[own[0] : own[-1]]
                if len(part) > PIECE_BYTES:
                    ids = self.long_text(part, end)
                    begin = np.array([0, len(ids)])
                else:
                    ids, begin = self.encode(part, own - own[0], end)
                out.append(ids)
                begins.append(begin[1:] + n)
                n += len(ids)
            yield low, high, np.concatenate(out), np.concatenate(begins)


@lru_cache(maxsize=2)
def encoder(path: str, special: bool = False) -> Encoder:
    """One encoder for all tasks of a worker."""
    return Encoder(path, special)
