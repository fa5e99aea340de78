"""Removal of passages that occur more than once in a corpus, by suffix automata over
shards of the corpus.

The reference is the corpus itself, so it grows with the input: an automaton of all
of it could not be broadcast, and streaming every document past every shard would
take quadratic work. Shards are therefore formed by content. Of every window of
``size`` words the eight words in a row with the least hash are its anchor; equal
windows have equal anchors. The windows of one occurrence of an anchor make up a
segment, and the segments with an anchor in common, reduced to distinct ones with
their numbers, go to one shard. There an automaton of the shard's segments is
built, the segments are streamed through it, and wherever the matching statistic
reaches the window size the state tells how often the window occurs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollbook.llm.common import stored, with_row
from tollbook.llm.words import hashed_words, mix, read, span_hashes, window_hashes

WINDOW, ANCHOR = 35, 8
#: Words of an automaton, and distinct segments of one anchor in a shard; an anchor
#: with more is dealt to several shards, whose findings are added up afterwards.
AUTOMATON, SEGMENTS = 100_000, 1_000


class Automaton:
    """Suffix automaton of several sequences, each with a weight; a state's weight is
    that of all places where its strings end."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.weight = [-1], [0], [0]

    def add(self, sequence: list[int], weight: int) -> None:
        last = 0
        for symbol in sequence:
            last = self._extend(last, symbol)
            self.weight[last] += weight

    def _state(self, length: int, moves: dict[int, int], link: int) -> int:
        self.next.append(moves)
        self.length.append(length)
        self.link.append(link)
        self.weight.append(0)
        return len(self.next) - 1

    def _extend(self, last: int, symbol: int) -> int:
        moves, length, link = self.next, self.length, self.link
        there = moves[last].get(symbol)
        if there is not None:
            return there if length[there] == length[last] + 1 else self._clone(last, symbol, there)
        new = self._state(length[last] + 1, {}, 0)
        at = last
        while at >= 0 and symbol not in moves[at]:
            moves[at][symbol] = new
            at = link[at]
        if at >= 0:
            there = moves[at][symbol]
            link[new] = there if length[there] == length[at] + 1 else self._clone(at, symbol, there)
        return new

    def _clone(self, at: int, symbol: int, there: int) -> int:
        clone = self._state(self.length[at] + 1, dict(self.next[there]), self.link[there])
        self.link[there] = clone
        while at >= 0 and self.next[at].get(symbol) == there:
            self.next[at][symbol] = clone
            at = self.link[at]
        return clone

    def finish(self) -> None:
        """Places where a string ends are places where its suffixes end."""
        for state in np.argsort(-np.array(self.length), kind="stable").tolist():
            if self.link[state] > 0:
                self.weight[self.link[state]] += self.weight[state]

    def windows(self, sequence: list[int], size: int) -> list[int]:
        """Of each window of ``size`` symbols the state it belongs to; 0 where the
        matching statistic does not reach the size."""
        state = matched = 0
        out = []
        moves, link, length = self.next, self.link, self.length
        for k, symbol in enumerate(sequence):
            while state and symbol not in moves[state]:
                state = link[state]
                matched = length[state]
            if symbol in moves[state]:
                state, matched = moves[state][symbol], matched + 1
            while link[state] >= 0 and length[link[state]] >= size:
                state = link[state]
                matched = length[state]
            if k + 1 >= size:
                out.append(state if matched >= size else 0)
        return out


def anchored(words: np.ndarray, size: int = WINDOW, anchor: int = ANCHOR) -> tuple[np.ndarray, ...]:
    """The segments of a text's word hashes: anchor hash, segment hash, first window,
    number of windows."""
    grams = window_hashes(words, anchor)
    width = size - anchor + 1
    views = np.lib.stride_tricks.sliding_window_view(grams, width)
    # The first of equal ones, so that equal windows choose alike.
    chosen = np.concatenate([views[k : k + 50_000].argmin(axis=1) for k in range(0, len(views), 50_000)])
    chosen += np.arange(len(views))
    first = np.flatnonzero(np.append(True, chosen[1:] != chosen[:-1]))
    count = np.diff(np.append(first, len(chosen)))
    place = (chosen[first] - first).astype(np.uint64)
    segment = mix(span_hashes(words, first, first + count + size - 1) + place * np.uint64(0x9FB21C651E98DF25))
    return grams[chosen[first]], segment, first, count


def _segments(rows: DataFrame, size: int) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in read(batches):
            parts = [
                (key, *anchored(words, size))
                for key, words in zip(keys, hashed_words(texts), strict=True)
                if len(words) >= size
            ]
            if parts:
                counts = [len(p[1]) for p in parts]
                columns = [np.concatenate([p[k] for p in parts]) for k in range(1, 5)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(columns[0].view(np.int64)),
                        pa.array(columns[1].view(np.int64)),
                        pa.array(np.repeat(np.array([p[0] for p in parts], np.int64), counts)),
                        pa.array(columns[2].astype(np.int32)),
                        pa.array(columns[3].astype(np.int32)),
                    ],
                    names=["h", "seg", "_row", "first", "windows"],
                )

    return rows.select("_row", "text").mapInArrow(run, "h long, seg long, _row long, first int, windows int")


def _worded(rows: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """The word hashes of the wanted segments, cut anew from the texts that have them."""
    per_row = wanted.groupBy("_row").agg(
        F.collect_list(F.struct("h", "seg", "n", "part", "parts", "first", "windows")).alias("wanted")
    )
    both = rows.select("_row", "text").join(per_row, "_row").select("wanted", "text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in read(batches):
            found = []
            for segments, words in zip(keys, hashed_words(texts), strict=True):
                for s in segments:
                    s["words"] = words[s.pop("first") :][: s.pop("windows") + size - 1].tobytes()
                    found.append(s)
            yield pa.RecordBatch.from_pylist(found, WORDED)

    return both.mapInArrow(run, "h long, seg long, n long, part int, parts int, words binary")


WORDED = pa.schema(
    [("h", pa.int64()), ("seg", pa.int64()), ("n", pa.int64()), ("part", pa.int32()), ("parts", pa.int32()), ("words", pa.binary())]
)
FOUND = "h long, seg long, lo int, hi int, w1 long, w2 long, alone boolean"


def _shard(segments: list[dict], size: int) -> Iterator[tuple]:
    """Rows of FOUND: windows ``lo`` to ``hi`` of a segment occur again in this shard; or,
    for an anchor that several shards share, a window's hashes, with its place if it is
    alone here."""
    words = [np.frombuffer(s["words"], np.uint64) for s in segments]
    _, symbols = np.unique(np.concatenate(words), return_inverse=True)
    sequences = np.split(symbols, np.cumsum([len(w) for w in words])[:-1])
    automaton = Automaton()
    lists = [s.tolist() for s in sequences]
    for segment, sequence in zip(segments, lists, strict=True):
        automaton.add(sequence, segment["n"])
    automaton.finish()
    told: set[int] = set()
    for segment, sequence, hashes in zip(segments, lists, words, strict=True):
        states = automaton.windows(sequence, size)
        again = np.array([automaton.weight[s] > 1 for s in states])
        edges = np.flatnonzero(np.diff(np.concatenate([[0], again, [0]])))
        for lo, hi in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            yield segment["h"], segment["seg"], lo, hi, None, None, None
        if segment["parts"] > 1:
            one, two = window_hashes(hashes, size), window_hashes(mix(hashes), size)
            for k, state in enumerate(states):
                if state not in told:
                    told.add(state)
                    names = int(one[k].view(np.int64)), int(two[k].view(np.int64))
                    yield segment["h"], segment["seg"], k, k + 1, *names, not again[k]


def _streamed(worded: DataFrame, size: int) -> DataFrame:
    names = [c.split()[0] for c in FOUND.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.bool_()]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        total, last = 0, None

        def out() -> pa.RecordBatch:
            columns = list(zip(*_shard(held, size), strict=True)) or [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

        for batch in batches:
            for row in batch.to_pylist():
                if (row["h"], row["part"]) != last and total >= AUTOMATON:
                    yield out()
                    held, total = [], 0
                last = row["h"], row["part"]
                held.append(row)
                total += len(row["words"]) // 8
        if held:
            yield out()

    shards = worded.repartition("h", "part").sortWithinPartitions("h", "part")
    return shards.mapInArrow(run, FOUND)


def repeated_spans(rows: DataFrame, size: int = WINDOW) -> DataFrame:
    """``_row`` and ``spans``: words from ``s`` to before ``e`` that a repeated window
    covers, for the rows (``_row``, ``text``) that have any."""
    # Occurrences of anchors that occur again; the others are in no repeated window.
    segments = _segments(rows, size)
    # Stored, so that the joins below can be split where one anchor has very many rows.
    again = segments.groupBy("h").agg(F.count("*").alias("in_all")).filter("in_all > 1")
    again = stored(again.select("h"), "anchors")
    occurrences = stored(segments.join(again, "h", "left_semi"), "occurrences")
    distinct = occurrences.groupBy("h", "seg").agg(
        F.count("*").alias("n"), F.min(F.struct("_row", "first", "windows")).alias("one")
    )
    distinct = stored(distinct, "segments")
    variety = stored(distinct.groupBy("h").agg(F.count("*").alias("variants")), "variety")
    distinct = distinct.join(variety, "h")
    # An anchor whose occurrences all have the same segment needs no automaton.
    same = distinct.filter("variants = 1").select("h", "seg", F.lit(0).alias("lo"), F.col("one.windows").alias("hi"))
    parts = F.ceil(F.col("variants") / SEGMENTS).cast("int")
    wanted = distinct.filter("variants > 1").select(
        "h", "seg", "n", "one.*", parts.alias("parts"), F.pmod(F.col("seg"), parts).cast("int").alias("part")
    )
    found = stored(_streamed(_worded(rows, wanted, size), size), "found")
    # A window that is alone in its shard, or repeated there, and is in another one.
    shared = found.filter("w1 IS NOT NULL")
    twice = shared.groupBy("w1", "w2").agg(F.count("*").alias("shards")).filter("shards > 1")
    late = shared.filter("alone").join(twice, ["w1", "w2"], "left_semi").select("h", "seg", "lo", "hi")
    decided = same.union(found.filter("w1 IS NULL").select("h", "seg", "lo", "hi")).union(late)
    spans = occurrences.join(decided, ["h", "seg"]).select(
        "_row", (F.col("first") + F.col("lo")).alias("s"), (F.col("first") + F.col("hi") + size - 1).alias("e")
    )
    return spans.groupBy("_row").agg(F.collect_list(F.struct("s", "e")).alias("spans"))


def remove_repeats(
    docs: DataFrame, key: str = "doc_id", size: int = WINDOW, untouched: bool = False
) -> DataFrame:
    """The key, ``_row``, ``n_words``, ``n_removed`` and ``kept_text`` (the words left,
    joined by a space) of every row: without each word covered by a window of ``size``
    words that starts anywhere else too, in the same text or another. With
    ``untouched`` a text that loses nothing is given as it is.

    All windows are judged on the input. Null and empty texts have no words; texts of
    fewer than ``size`` words keep all; rows with equal or null keys are rows of their
    own, so that equal texts of ``size`` words or more lose everything.
    """
    rows = with_row(docs, key, F.col("text").cast("string").alias("text"))
    both = rows.join(repeated_spans(rows, size), "_row", "left")
    both = both.select(F.struct(F.col(key).alias("key"), "_row", "spans").alias("at"), "text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in read(batches):
            counts, removed, kept = [], [], []
            for at, text in zip(keys, texts, strict=True):
                words = text.split()
                counts.append(len(words))
                if at["spans"]:
                    steps = np.zeros(len(words) + 1, np.int64)
                    np.add.at(steps, [x["s"] for x in at["spans"]], 1)
                    np.add.at(steps, [x["e"] for x in at["spans"]], -1)
                    stay = np.cumsum(steps[:-1]) == 0
                    words = [w for w, s in zip(words, stay.tolist(), strict=True) if s]
                removed.append(counts[-1] - len(words))
                whole = untouched and len(words) == counts[-1]
                kept.append((text if whole else b" ".join(words)).decode())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k["key"] for k in keys], pa.int64()), pa.array([k["_row"] for k in keys], pa.int64()),
                    pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string()),
                ],
                names=[key, "_row", "n_words", "n_removed", "kept_text"],
            )

    schema = f"`{key}` long, _row long, n_words long, n_removed long, kept_text string"
    return both.mapInArrow(run, schema)
