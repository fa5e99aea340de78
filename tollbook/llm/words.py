"""Words of many texts at once, as arrays: where they are and 64-bit hashes of them."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

#: Multiplier of the rolling hash, odd so that it has an inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
#: Texts are handled in pieces of about so many bytes, cut between words.
PIECE = 2 << 20

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True

_UP, _DOWN = np.ones(1, np.uint64), np.ones(1, np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of BASE and of its inverse; multiplication wraps."""
    global _UP, _DOWN
    if len(_UP) < n:
        size = max(n, 2 * len(_UP))
        up, down = np.full(size, BASE, np.uint64), np.full(size, INVERSE, np.uint64)
        up[0] = down[0] = 1
        _UP, _DOWN = np.cumprod(up), np.cumprod(down)
    return _UP[:n], _DOWN[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads a value over all 64 bits, one to one."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each ``values[start:end]``, from prefix sums: the same for the same
    values wherever they stand."""
    up, down = powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    lengths = (ends - starts).astype(np.uint64)
    return mix((sums[ends] - sums[starts]) * down[starts] + lengths * np.uint64(0xD6E8FEB86659FD93))


def window_hashes(values: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all ``size`` values in a row."""
    starts = np.arange(max(0, len(values) - size + 1))
    return span_hashes(values, starts, starts + size)


def cut(text: bytes, piece: int = PIECE) -> Iterator[bytes]:
    """The text in pieces of about ``piece`` bytes, each but the first beginning with
    a single space between two words; a longer word stays whole."""
    begin = 0
    while len(text) - begin > piece:
        at = text.find(b" ", begin + piece)
        while at >= 0 and (at + 1 >= len(text) or IS_SPACE[text[at - 1]] or IS_SPACE[text[at + 1]]):
            at = text.find(b" ", at + 1)
        if at < 0:
            break
        yield text[begin:at]
        begin = at
    yield text[begin:]


def bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in texts that lie one after the other."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    space = IS_SPACE[data]
    before, after = np.empty_like(space), np.empty_like(space)
    before[0], before[1:] = True, space[:-1]
    after[-1], after[:-1] = True, space[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    before[inner] = True
    after[inner - 1] = True
    return np.flatnonzero(~space & before), np.flatnonzero(~space & after) + 1


def spaced_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same for words that take the one space before them; what other white
    space there is lies between them: of a run, all but the last character together,
    the last alone unless it is a word's space."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    space = IS_SPACE[data]
    cuts = np.zeros(len(data) + 1, bool)
    cuts[offsets] = True
    change = np.flatnonzero(space[1:] != space[:-1]) + 1
    change = change[~cuts[change]]
    words, runs = change[~space[change]], change[space[change]]
    cuts[runs] = True
    cuts[words - 1] = True
    cuts[words[data[words - 1] != 0x20]] = True
    cuts[-1] = False
    starts = np.flatnonzero(cuts[:-1])
    return starts, np.append(starts[1:], len(data))


def read(arrow: Iterable[pa.RecordBatch], size: int = PIECE) -> Iterator[tuple[list, list[bytes]]]:
    """Keys and texts (null as empty) of two-column batches, in runs of about
    ``size`` bytes of text."""
    keys, texts, total = [], [], 0
    for batch in arrow:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary()), strict=True):
            keys.append(key)
            texts.append(text.as_py() or b"")
            total += len(texts[-1])
            if total >= size:
                yield keys, texts
                keys, texts, total = [], [], 0
    if keys:
        yield keys, texts


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All bytes, and where each text begins, with the end of the last."""
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=offsets[1:])
    return np.frombuffer(b"".join(texts), np.uint8), offsets


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z as a-z, other bytes as they are."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data).astype(np.uint8)


def hashed_words(texts: list[bytes], lower: bool = False, stem: int = 0) -> list[np.ndarray]:
    """Of each text, the hashes of its words in order; with ``stem``, of the first so
    many bytes of the words that have more."""
    pieces = [(k, p) for k, t in enumerate(texts) for p in (cut(t) if len(t) > PIECE else (t,))]
    out: list[list[np.ndarray]] = [[] for _ in texts]
    begin = 0
    while begin < len(pieces):
        end, total = begin, 0
        while end < len(pieces) and (end == begin or total + len(pieces[end][1]) <= 2 * PIECE):
            total += len(pieces[end][1])
            end += 1
        data, offsets = joined([p for _, p in pieces[begin:end]])
        if lower:
            data = lowered(data)
        starts, ends = bounds(data, offsets)
        if stem:
            starts = starts[ends - starts > stem]
            ends = starts + stem
        hashes = span_hashes(data, starts, ends)
        for (k, _), part in zip(pieces[begin:end], np.split(hashes, np.searchsorted(starts, offsets[1:-1])), strict=True):
            out[k].append(part)
        begin = end
    return [p[0] if len(p) == 1 else np.concatenate(p) for p in out]


class IntTable:
    """A hash table from non-negative integers to integers, looked up by arrays."""

    def __init__(self, size: int = 1 << 12):
        self._clear(size)

    def _clear(self, size: int) -> None:
        self.keys, self.values, self.used = np.full(size, -1, np.int64), np.zeros(size, np.int64), 0

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (mix(keys.astype(np.uint64)) & np.uint64(len(self.keys) - 1)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """Values, -1 where there is none."""
        slots = self._slots(keys)
        there = self.keys[slots]
        out = np.where(there == keys, self.values[slots], -1)
        open_ = np.flatnonzero((there != keys) & (there != -1))
        while len(open_):
            slots[open_] = (slots[open_] + 1) & (len(self.keys) - 1)
            there = self.keys[slots[open_]]
            hit = there == keys[open_]
            out[open_[hit]] = self.values[slots[open_[hit]]]
            open_ = open_[~hit & (there != -1)]
        return out

    def put(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Distinct keys that are not there yet."""
        if 3 * (self.used + len(keys)) > len(self.keys):
            old = self.keys >= 0
            held, kept = self.keys[old], self.values[old]
            size = len(self.keys)
            while 3 * (self.used + len(keys)) > size:
                size *= 2
            self._clear(size)
            self.put(held, kept)
        self.used += len(keys)
        slots = self._slots(keys)
        left = np.arange(len(keys))
        while len(left):
            free = left[self.keys[slots[left]] == -1]
            # Of several keys that want one slot the last written has it.
            self.keys[slots[free]] = keys[free]
            placed = free[self.keys[slots[free]] == keys[free]]
            self.values[slots[placed]] = values[placed]
            left = left[self.keys[slots[left]] != keys[left]]
            slots[left] = (slots[left] + 1) & (len(self.keys) - 1)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of all ranges one after the other."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total)


class Memory:
    """Remembers the ids of words. ``encode`` takes a list of new words (bytes) and
    gives their ids one after the other, and how many each has.

    Words are told apart by a 64-bit hash within one call and by their bytes from
    call to call. Two generations of half the limit each: a full young one takes
    the place of the old one, from which what is asked for again comes back.
    """

    def __init__(self, encode, limit: int, spaced: bool):
        self.encode, self.half = encode, max(1, limit // 2)
        self.bounds = spaced_bounds if spaced else bounds
        self._start()
        self.old, self.old_starts, self.old_lengths, self.old_ids = self.known, self.starts, self.lengths, self.ids

    def _start(self) -> None:
        self.known: dict[bytes, int] = {}
        self.starts, self.lengths = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.ids, self.end = np.zeros(4096, np.int32), 0

    def _add(self, words: list[bytes], ids: np.ndarray, lengths: np.ndarray) -> None:
        first = len(self.known)
        self.known.update(zip(words, range(first, first + len(words)), strict=True))
        while len(self.starts) < first + len(words):
            self.starts, self.lengths = np.resize(self.starts, 2 * len(self.starts)), np.resize(self.lengths, 2 * len(self.lengths))
        while len(self.ids) < self.end + len(ids):
            self.ids = np.resize(self.ids, 2 * len(self.ids))
        self.lengths[first : first + len(words)] = lengths
        self.starts[first : first + len(words)] = self.end + np.cumsum(lengths) - lengths
        self.ids[self.end : self.end + len(ids)] = ids
        self.end += len(ids)

    def _numbers(self, words: list[bytes]) -> np.ndarray:
        missing = [w for w in words if w not in self.known]
        if missing:
            if len(self.known) + len(missing) > self.half and self.known:
                self.old, self.old_starts, self.old_lengths, self.old_ids = self.known, self.starts, self.lengths, self.ids
                self._start()
                missing = words
            again = [w for w in missing if w in self.old]
            if again:
                k = np.array([self.old[w] for w in again])
                self._add(again, self.old_ids[ranges(self.old_starts[k], self.old_lengths[k])], self.old_lengths[k])
            new = [w for w in missing if w not in self.old] if again else missing
            if new:
                self._add(new, *self.encode(new))
        return np.array([self.known[w] for w in words], np.int64)

    def ids_of(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and how many each text has."""
        data, offsets = joined(texts)
        starts, ends = self.bounds(data, offsets)
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        _, first, which = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        raw = data.tobytes()
        words = [raw[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
        numbers = self._numbers(words)[which]
        lengths = self.lengths[numbers]
        ids = self.ids[ranges(self.starts[numbers], lengths)]
        before = np.append(0, np.cumsum(lengths))
        return ids, np.diff(before[np.searchsorted(starts, offsets)])
