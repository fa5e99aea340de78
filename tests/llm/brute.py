"""The operators' results by definition, for small inputs."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def without_repeats(texts, size=35):
    """Words, words removed and the text left, of each text."""
    words = [WORD.findall(t or "") for t in texts]
    counts = Counter(tuple(w[k : k + size]) for w in words for k in range(len(w) - size + 1))
    out = []
    for w in words:
        gone = [False] * len(w)
        for k in range(len(w) - size + 1):
            if counts[tuple(w[k : k + size])] > 1:
                gone[k : k + size] = [True] * size
        out.append((len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return out


def shingles(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4))


def components(count, edges):
    """The smallest member of each one's component."""
    root = list(range(count))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(x) for x in range(count)]


def near_duplicates(texts):
    """Set sizes and the first member of each text's component."""
    sets = [shingles(t) for t in texts]
    edges = [
        (a, b)
        for a in range(len(sets))
        for b in range(a + 1, len(sets))
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    return [len(s) for s in sets], components(len(sets), edges)


def near_vectors(vectors, cosine=0.95):
    """Links and the first member of each vector's component; None is linked with nothing."""
    count = len(vectors)
    units = [v if v is None else np.array(v, float) / np.linalg.norm(v) for v in vectors]
    edges = [
        (a, b)
        for a in range(count)
        for b in range(a + 1, count)
        if units[a] is not None and units[b] is not None and float(units[a] @ units[b]) >= cosine
    ]
    links = Counter(x for e in edges for x in e)
    return [links[k] for k in range(count)], components(count, edges)


def base(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    words = WORD.findall(text)
    lines, seen, dup = [x for x in text.split("\n") if WORD.search(x)], set(), 0
    for line in lines:
        dup += line in seen
        seen.add(line)
    windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    counts = Counter(windows)
    covered = {k + j for k, w in enumerate(windows) if counts[w] > 1 for j in range(5)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def prose(rng, count, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(count))


def edited(rng, text, edits):
    words = text.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return " ".join(words)


def rng(seed=0):
    return random.Random(seed)
