"""Encoding with the public tokenizer files, word by word and remembered.

Both JSON tokenizers split at ASCII white space before they merge, so the ids
of a text are those of its words one after the other, and a word that comes
again need not be encoded again. Texts in which that does not hold (a special
token's string, other white space) go to the library whole, and so do words
with characters on which libraries might differ.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np
import regex

from tollbook.llm.words import PIECE, IntTable, Memory, cut, ranges

#: Words remembered in a Python worker at most.
REMEMBERED = 700_000
#: Words up to this many bytes are merged together, longer ones by the library.
SHORT = 40
#: Code points that are, or were once, white space beyond the six ASCII ones;
#: libraries differ on some of them.
OTHER_SPACES = (
    *range(0x1C, 0x20), 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200E),
    0x2028, 0x2029, 0x202F, 0x205F, 0x2060, 0x3000, 0xFEFF,
)
OTHER_SPACE = re.compile("[" + "".join(map(chr, OTHER_SPACES)) + "]")
#: Below this there are no combining characters, and case and class of a
#: character are the same in every library.
PLAIN = "ƀ"


def byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable Latin-1
    characters stand for themselves, the other bytes for those from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(0x100 + k): b for k, b in enumerate(hidden)}


class Merges:
    """Byte pair merging of many short words at once: each round merges in every word
    its first pair of lowest rank, as merging one word would."""

    def __init__(self, model: dict):
        vocabulary, end = model["vocab"], model.get("end_of_word_suffix") or ""
        letters = {b: c for c, b in byte_letters().items()}
        self.inner = np.array([vocabulary[letters[b]] for b in range(256)], np.int32)
        self.last = np.array([vocabulary[letters[b] + end] for b in range(256)], np.int32)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.size = max(vocabulary.values()) + 1
        suffix = model.get("continuing_subword_prefix") or ""
        self.result = np.array([vocabulary[a + b.removeprefix(suffix)] for a, b in pairs], np.int32)
        keys = np.array([vocabulary[a] * self.size + vocabulary[b] for a, b in pairs], np.int64)
        _, first = np.unique(keys[::-1], return_index=True)
        ranks = np.sort(len(keys) - 1 - first)
        self.ranks = IntTable()
        self.ranks.put(keys[ranks], ranks)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Of the pairs; without one, or at a word's end, past all ranks."""
        rank = self.ranks.get(np.where((left < 0) | (right < 0), 0, left.astype(np.int64) * self.size + right))
        return np.where((rank < 0) | (left < 0) | (right < 0), len(self.result), rank)

    def __call__(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids one after the other and their numbers, of words of 1 to SHORT bytes."""
        lengths = np.array([len(w) for w in words], np.int64)
        order = np.argsort(lengths, kind="stable")
        found, numbers = [np.zeros(0, np.int32)], np.zeros(len(words), np.int64)
        for low, high in ((1, 5), (5, 9), (9, 13), (13, 21), (21, SHORT + 1)):
            group = order[np.searchsorted(lengths[order], low) : np.searchsorted(lengths[order], high)]
            for begin in range(0, len(group), 20_000):
                some = group[begin : begin + 20_000]
                ids, numbers[some] = self._group([words[k] for k in some.tolist()], high - 1)
                found.append(ids)
        # They were found in the order of length.
        starts = np.zeros(len(words), np.int64)
        starts[order] = np.cumsum(numbers[order]) - numbers[order]
        return np.concatenate(found)[ranges(starts, numbers)], numbers

    def _group(self, words: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
        raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(len(words), width)
        lengths = np.array([len(w) for w in words])
        at = np.arange(width)
        symbols = np.where(at < lengths[:, None] - 1, self.inner[raw], self.last[raw])
        symbols = np.where(at < lengths[:, None], symbols, -1)
        symbols = np.column_stack([symbols, np.full((len(words), 2), -1, np.int32)])
        ranks = self._rank(symbols[:, :-1].ravel(), symbols[:, 1:].ravel()).reshape(len(words), -1)
        done = np.full((len(words), width), -1, np.int32)
        live = np.arange(len(words))
        while len(live):
            best = ranks.argmin(axis=1)
            rank = ranks[np.arange(len(live)), best]
            ended = rank == len(self.result)
            if ended.any():
                done[live[ended]] = symbols[ended, :width]
                keep = ~ended
                live, symbols, ranks, best, rank = live[keep], symbols[keep], ranks[keep], best[keep], rank[keep]
                if not len(live):
                    break
            rows = np.arange(len(live))
            symbols[rows, best] = self.result[rank]
            # The right one of the pair goes, and all behind it move up.
            gone = best[:, None] + 1
            take = np.arange(symbols.shape[1] - 1)
            symbols = np.column_stack([np.take_along_axis(symbols, take + (take >= gone), 1), np.full(len(live), -1, np.int32)])
            take = np.arange(ranks.shape[1] - 1)
            ranks = np.column_stack([np.take_along_axis(ranks, take + (take >= gone), 1), np.full(len(live), len(self.result))])
            ranks[rows, best] = self._rank(symbols[rows, best], symbols[rows, best + 1])
            left = np.flatnonzero(best > 0)
            ranks[left, best[left] - 1] = self._rank(symbols[left, best[left] - 1], symbols[left, best[left]])
        return done[done >= 0], (done >= 0).sum(axis=1)


class Encoder:
    """Ids of texts as the tokenizers library gives them, without added tokens."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        os.environ.setdefault("RAYON_NUM_THREADS", "1")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as text:
            written = json.load(text)
        self.special = [t["content"] for t in written["added_tokens"]]
        # One of two layouts: a normalizer that lowers case and a pattern of its
        # own, or a byte-level tokenizer with the pattern below.
        self.lower = written["normalizer"] is not None
        steps = written["pre_tokenizer"].get("pretokenizers", [])
        own = [s["pattern"]["Regex"] for s in steps if s["type"] == "Split"]
        self.split = regex.compile(own[0] if own else BYTE_LEVEL)
        self.merges = Merges(written["model"])
        self.memory = Memory(self._encode, REMEMBERED, spaced=not self.lower)

    def _library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Words are split by the tokenizer's pattern and their parts merged together."""
        parts: dict[bytes, int] = {}
        which: list[int] = []
        numbers: list[int] = []
        whole: list[str] = []
        find, lower = self.split.findall, self.lower
        for word in words:
            text = word.decode()
            found = find(text.lower() if lower else text) if max(text) < PLAIN else None
            if found is None or len(word) > SHORT:
                # Numbered from -1 down, in the order in which the library gets them.
                whole.append(text)
                which.append(-len(whole))
                numbers.append(1)
            elif len(found) == 1:
                which.append(parts.setdefault(found[0].encode(), len(parts)))
                numbers.append(1)
            else:
                which += [parts.setdefault(p.encode(), len(parts)) for p in found]
                numbers.append(len(found))
        ids, counts = self.merges(list(parts))
        from_library = self._library(whole)
        ids = np.concatenate([ids, *[np.array(x, np.int32) for x in from_library]])
        counts = np.append(counts, [len(x) for x in from_library]).astype(np.int64)
        at = np.array(which, np.int64)
        at = np.where(at < 0, len(parts) - at - 1, at)
        starts = (np.cumsum(counts) - counts)[at]
        ends = np.append(0, np.cumsum(counts[at]))[np.append(0, np.cumsum(numbers))]
        return ids[ranges(starts, counts[at])], np.diff(ends)

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """Of each text; no ids for an empty one."""
        decoded = [t.decode() for t in texts]
        odd = [bool(OTHER_SPACE.search(t)) or any(s in t for s in self.special) for t in decoded]
        # Very long texts go in pieces, so that memory does not grow with them.
        pieces = [
            (k, p)
            for k, t in enumerate(texts)
            if not odd[k]
            for p in (cut(t) if len(t) > PIECE else (t,))
        ]
        ids, counts = self.memory.ids_of([p for _, p in pieces])
        out: list[list[np.ndarray]] = [[] for _ in texts]
        for (k, _), part in zip(pieces, np.split(ids, np.cumsum(counts)[:-1]), strict=bool(pieces)):
            out[k].append(part)
        for k, is_odd in enumerate(odd):
            if is_odd:
                out[k].append(np.array(self.tokenizer.encode(decoded[k], add_special_tokens=False).ids, np.int32))
        return [x[0] if len(x) == 1 else np.concatenate(x) for x in out]


#: How byte-level tokenizers split a text unless their file says otherwise (fixed value).
BYTE_LEVEL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a file; what it remembers outlives a task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
