"""Byte pair encoding by segment trees over the ranks of adjacent pairs, and decoding.

A word's tree has a leaf for each symbol: the rank of the pair that it forms with the
next one, or NONE; an inner node has the least of its two. As a leaf's value is the rank
times the tree's width plus the position, the root names the leftmost pair of lowest
rank. A merge changes three leaves, so it costs a logarithm of the word's length.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollbook.llm.tokens import OTHER_SPACE
from tollbook.llm.words import PIECE, IntTable, Memory, cut, ranges, read

#: Words remembered in a Python worker at most.
REMEMBERED = 500_000
#: Symbols of the words whose trees are worked on together, about.
TOGETHER = 1 << 18
#: A word of more symbols has a tree of its own.
LONG = 256
#: Greater than every leaf that holds a pair.
NONE = np.iinfo(np.int64).max

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class PairRanks:
    """Ranks and results of pairs of ids, for arrays and for single pairs."""

    def __init__(self, vocabulary: dict[str, int], merges: list, prefix: str):
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        self.size = max(vocabulary.values()) + 1
        self.result = np.array([vocabulary[a + b.removeprefix(prefix)] for a, b in pairs], np.int64)
        self.single: dict[int, int] = {}
        for rank, (a, b) in enumerate(pairs):
            # Of a pair that is listed twice the last entry counts.
            self.single[vocabulary[a] * self.size + vocabulary[b]] = rank
        self.table = IntTable()
        self.table.put(np.fromiter(self.single, np.int64, len(self.single)), np.fromiter(self.single.values(), np.int64, len(self.single)))

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """-1 where the two form no pair; a negative id forms none."""
        there = (left >= 0) & (right >= 0)
        return np.where(there, self.table.get(np.where(there, left * self.size + right, 0)), -1)


def merged_together(ranks: PairRanks, words: list[np.ndarray], width: int) -> list[np.ndarray]:
    """Ids of words with at most ``width`` (a power of two) symbols: their trees are
    rows of one array, and each round makes one merge in every word that has any left."""
    count = len(words)
    lengths = np.array([len(w) for w in words])
    symbols = np.full((count, width + 1), -1, np.int64)
    symbols[np.repeat(np.arange(count), lengths), ranges(np.zeros(count, np.int64), lengths)] = np.concatenate(words)
    # The symbols after and before each one; ``width`` stands for none and is never merged.
    after = np.tile(np.minimum(np.arange(1, width + 2), width), (count, 1))
    before = np.tile(np.maximum(np.arange(-1, width), 0), (count, 1))
    trees = np.full((count, 2 * width), NONE)
    found = ranks.of(symbols[:, :-1].ravel(), symbols[:, 1:].ravel()).reshape(count, width)
    trees[:, width:] = np.where(found >= 0, found * width + np.arange(width), NONE)
    level = width // 2
    while level:
        trees[:, level : 2 * level] = np.minimum(trees[:, 2 * level : 4 * level : 2], trees[:, 2 * level + 1 : 4 * level : 2])
        level //= 2

    def update(rows: np.ndarray, leaves: np.ndarray, values: np.ndarray) -> None:
        node = leaves + width
        trees[rows, node] = values
        while node[0] > 1:
            node = node >> 1
            trees[rows, node] = np.minimum(trees[rows, 2 * node], trees[rows, 2 * node + 1])

    def leaf(rows: np.ndarray, at: np.ndarray) -> np.ndarray:
        rank = ranks.of(symbols[rows, at], symbols[rows, after[rows, at]])
        return np.where(rank >= 0, rank * width + at, NONE)

    rows = np.flatnonzero(trees[:, 1] != NONE)
    while len(rows):
        rank, at = np.divmod(trees[rows, 1], width)
        right = after[rows, at]
        then = after[rows, right]
        symbols[rows, at] = ranks.result[rank]
        symbols[rows, right] = -1
        after[rows, at] = then
        before[rows, then] = at
        update(rows, right, np.full(len(rows), NONE))
        update(rows, at, leaf(rows, at))
        some = at > 0
        if some.any():
            update(rows[some], before[rows[some], at[some]], leaf(rows[some], before[rows[some], at[some]]))
        rows = rows[trees[rows, 1] != NONE]
    return [row[row >= 0] for row in symbols]


def merged_alone(ranks: PairRanks, word: np.ndarray) -> np.ndarray:
    """Ids of one long word, by a tree in plain lists."""
    count = len(word)
    width = 1 << (count - 1).bit_length()
    none, size, single, result = int(NONE), ranks.size, ranks.single, ranks.result.tolist()
    symbols = word.tolist()
    after, before = list(range(1, count + 1)), list(range(-1, count - 1))
    tree = [none] * (2 * width)

    def leaf(at: int) -> int:
        if at < 0 or after[at] >= count:
            return none
        rank = single.get(symbols[at] * size + symbols[after[at]])
        return none if rank is None else rank * width + at

    def update(at: int, value: int) -> None:
        node = at + width
        tree[node] = value
        node >>= 1
        while node:
            left, right = tree[2 * node], tree[2 * node + 1]
            low = left if left < right else right
            if tree[node] == low:
                break
            tree[node] = low
            node >>= 1

    tree[width : width + count] = map(leaf, range(count))
    for node in range(width - 1, 0, -1):
        tree[node] = min(tree[2 * node], tree[2 * node + 1])
    while tree[1] != none:
        rank, at = divmod(tree[1], width)
        right = after[at]
        symbols[at], symbols[right] = result[rank], -1
        after[at] = after[right]
        if after[at] < count:
            before[after[at]] = at
        update(right, none)
        update(at, leaf(at))
        if before[at] >= 0:
            update(before[at], leaf(before[at]))
    return np.array([s for s in symbols if s >= 0], np.int64)


class TreeBpe:
    """Encodes and decodes as the tokenizers library does with a file of word ends and
    without a decoder: decoding joins the tokens by spaces.

    The library's normalizer and pre-tokenizer say what the words are; their ids come
    from the trees. Texts are split at ASCII white space and words remembered; those
    with other white space or a special token's string are split as a whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        os.environ.setdefault("RAYON_NUM_THREADS", "1")
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as text:
            written = json.load(text)
        model, self.added = written["model"], {t["content"]: t["id"] for t in written["added_tokens"]}
        if written["decoder"] is not None or any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in written["added_tokens"]):
            raise ValueError("a file without a decoder and with plain special tokens is needed")
        library = Tokenizer.from_file(path)
        self.normalize, self.split = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        # Where special tokens overlap, the leftmost is taken, and of those the longest.
        longest = sorted(self.added, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if longest else re.compile("(?!)")
        self.vocabulary, self.end = model["vocab"], model.get("end_of_word_suffix") or ""
        self.ranks = PairRanks(self.vocabulary, model["merges"], model.get("continuing_subword_prefix") or "")
        self.memory = Memory(self._remembered, REMEMBERED, spaced=False)
        names = {i: t for t, i in self.vocabulary.items()} | {i: t for t, i in self.added.items()}
        every = range(max(names) + 1)
        self.tokens = Written([names.get(i, "") + " " for i in every])
        self.digits = Written([f"{i} " for i in every])

    def _merge(self, pieces: list[str]) -> list[np.ndarray]:
        """Ids of pieces, each given in the letters that stand for its bytes."""
        known, end = self.vocabulary, self.end
        words = [np.array([*map(known.__getitem__, p[:-1]), known[p[-1] + end]], np.int64) for p in pieces]
        lengths = np.array([len(w) for w in words], np.int64)
        out: list[np.ndarray] = list(words)
        for k in np.flatnonzero(lengths > LONG).tolist():
            out[k] = merged_alone(self.ranks, words[k])
        width = 2
        while width <= LONG:
            group = np.flatnonzero((lengths <= width) & (lengths > max(1, width // 2))).tolist()
            step = max(1, TOGETHER // width)
            for begin in range(0, len(group), step):
                some = group[begin : begin + step]
                for k, ids in zip(some, merged_together(self.ranks, [words[k] for k in some], width), strict=True):
                    out[k] = ids
            width *= 2
        return out

    def _remembered(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words without white space one after the other, and how many each has."""
        known: dict[str, int] = {}
        which, numbers = [], []
        for word in words:
            parts = [p for p, _ in self.split(self.normalize(word.decode()))]
            which += [known.setdefault(p, len(known)) for p in parts]
            numbers.append(len(parts))
        ids = self._merge(list(known))
        if not which:
            return np.zeros(0, np.int32), np.zeros(len(words), np.int64)
        lengths = np.array([len(x) for x in ids], np.int64)[which]
        ends = np.append(0, np.cumsum(lengths))[np.append(0, np.cumsum(numbers))]
        return np.concatenate([ids[k] for k in which]).astype(np.int32), np.diff(ends)

    def _whole(self, text: str) -> np.ndarray:
        """Ids of a text with special tokens or other white space."""
        out = [np.zeros(0, np.int64)]
        for part in self.special.split(text):
            if part in self.added:
                out.append(np.array([self.added[part]], np.int64))
            elif part:
                out += self._merge([p for p, _ in self.split(self.normalize(part))])
        return np.concatenate(out).astype(np.int32)

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """Of each text (UTF-8); none for an empty one."""
        decoded = [t.decode() for t in texts]
        odd = [bool(OTHER_SPACE.search(t) or self.special.search(t)) for t in decoded]
        pieces = [(k, p) for k, t in enumerate(texts) if not odd[k] for p in (cut(t) if len(t) > PIECE else (t,))]
        ids, counts = self.memory.ids_of([p for _, p in pieces])
        out: list[list[np.ndarray]] = [[] for _ in texts]
        for (k, _), part in zip(pieces, np.split(ids, np.cumsum(counts)[:-1]), strict=bool(pieces)):
            out[k].append(part)
        for k, is_odd in enumerate(odd):
            if is_odd:
                out[k].append(self._whole(decoded[k]))
        return [x[0] if len(x) == 1 else np.concatenate(x) for x in out]

    def decode(self, ids: np.ndarray) -> str:
        """The tokens of the ids, special ones too, joined by spaces."""
        return self.tokens.of(ids).decode()


class Written:
    """A text for each id, with a space at its end, put together by arrays."""

    def __init__(self, texts: list[str]):
        raw = [t.encode() for t in texts]
        self.data = np.frombuffer(b"".join(raw), np.uint8)
        self.lengths = np.array([len(t) for t in raw], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths

    def of(self, ids: np.ndarray) -> bytes:
        """The texts of the ids, joined by one space."""
        return self.data[ranges(self.starts[ids], self.lengths[ids])].tobytes()[:-1]


_CODECS: dict[str, TreeBpe] = {}


def codec(path: str) -> TreeBpe:
    """The worker's codec for a file; the words it remembers outlive a task."""
    if path not in _CODECS:
        _CODECS[path] = TreeBpe(path)
    return _CODECS[path]


def encode_documents(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id``, ``ids`` (array of int) and ``text`` decoded from them.

    One narrow pass: each text is encoded and decoded whole in the task that reads it.
    Null and empty texts have no ids and decode to the empty text. Rows are independent,
    so null or repeated ``doc_id``, repeated texts and other columns do not matter; an
    empty table gives an empty one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = codec(tokenizer)
        for doc_ids, texts in read(batches):
            ids = both.encode(texts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_ids, pa.int64()), pa.array(ids, pa.list_(pa.int32())), pa.array([both.decode(x) for x in ids], pa.string())],
                names=["doc_id", "ids", "text"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, ids array<int>, text string")


def digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Per document the number of ids and digests of the ids, as decimals joined by a
    space, and of the decoded text, taken in the task that makes them; rows as in
    ``encode_documents``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = codec(tokenizer)
        for doc_ids, texts in read(batches):
            ids = both.encode(texts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(doc_ids, pa.int64()),
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(both.digits.of(x)).hexdigest() for x in ids], pa.string()),
                    pa.array([hashlib.sha256(both.tokens.of(x)).hexdigest() for x in ids], pa.string()),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, SCHEMA)
