import hashlib
import random
import zlib
from collections import defaultdict

import pytest

import compare
from tollbook.llm import prefix_trie, queries

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def by_definition(rows):
    """From (conv_id, turn, role, text) to the result's rows, by rebuilding all texts."""
    own = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            own[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(lot)] for c, lot in own.items()}
    rebuilt = {}
    for c, lot in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = tuple(own.get(c - c % 5, [])[:h] + lot[h:])
    members, children = defaultdict(list), defaultdict(set)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
            if d:
                children[turns[: d - 1]].add(turns[:d])
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, lot in members.items():
        size = len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(lot) - 1) * size
    out = []
    for node, lot in members.items():
        ends = ",".join(str(c) for c in sorted(lot) if len(rebuilt[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(lot), len(node), parent, len(lot), len(children[node]), leaves[node], saved[node], digest))
    return sorted(out, key=str)


def table_of(spark, rows):
    schema = "conv_id long, turn long, role string, text string, node string, place int, parent string, block int"
    return spark.createDataFrame([(*r, "x", 1, "x", 1) for r in rows], schema)


def result(frame):
    assert frame.columns == COLUMNS
    return sorted(map(tuple, frame.collect()), key=str)


def random_rows(rng, conversations, turns, texts):
    return [
        (rng.choice([*range(conversations), None]), rng.choice([*range(turns), None]), rng.choice(("user", "assistant", None)),
         rng.choice(texts))
        for _ in range(conversations * turns)
    ]


@pytest.mark.parametrize("seed", [1, 2])
def test_any_table(spark, seed):
    rng = random.Random(seed)
    rows = random_rows(rng, 60, 12, ("a", "b", "é", "", None, "long " * 3000))
    # The same conversation many times, one that is alone in its block, one with a long tail.
    rows += [(100 + 5 * k, t, "user", "same") for k in range(200) for t in range(3)]
    rows += [(5003, t, "user", f"{t % 3}") for t in range(300)] + [(5007, 0, "user", "x"), (-7, 1, "user", "y"), (-10, 1, "user", "z")]
    assert result(prefix_trie.prefix_trie(table_of(spark, rows))) == by_definition(rows)


def test_empty_table(spark):
    assert result(prefix_trie.prefix_trie(table_of(spark, []))) == []


def test_long_runs_of_numbers_and_many_rows_a_task(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "RUN", 50)
    rows = [(c, t, "user", "same") for c in range(2000) for t in range(9)]
    assert result(prefix_trie.prefix_trie(table_of(spark, rows))) == by_definition(rows)


def test_fingerprints_compose():
    rng = random.Random(3)
    turns = [prefix_trie.Fingerprint(rng.getrandbits(126), prefix_trie.BASES[0]) for _ in range(6)]
    a, b, c = turns[0].then(turns[1]), turns[2], turns[3].then(turns[4])
    assert a.then(b).then(c) == a.then(b.then(c))
    assert a.then(prefix_trie.EMPTY) == a == prefix_trie.EMPTY.then(a)
    assert turns[0].then(turns[1]) != turns[1].then(turns[0])


def test_equal_fingerprints_of_different_prefixes_are_found(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PRIME", 11)
    rows = [(c, t, "user", f"{c} {t}") for c in range(0, 200, 5) for t in range(3)]
    with pytest.raises(ValueError, match="fingerprints"):
        prefix_trie.prefix_trie(table_of(spark, rows))


def test_the_next_base_is_taken(spark, monkeypatch):
    # With base 0 a prefix's fingerprint is its last turn's digest.
    monkeypatch.setattr(prefix_trie, "BASES", (0, prefix_trie.BASES[0]))
    rows = [(c, t, "user", "last" if t else f"{c}") for c in range(0, 50, 5) for t in range(2)]
    assert result(prefix_trie.prefix_trie(table_of(spark, rows))) == by_definition(rows)


def test_query_over_a_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = compare.connect(folder).execute("select conv_id, turn, role, text from conversations").fetchall()
    assert result(queries.QUERIES["op13_prefix_trie"](spark, folder)) == by_definition(rows)
