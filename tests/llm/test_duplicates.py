import itertools
import random

import numpy as np
import pytest

import llm.brute as brute
from tollbook.llm import common, ngram_join, substring_dedup, vector_join


def corpus(seed, count=60):
    """Copies, near copies, shared passages, repetition, short and empty texts."""
    rng = brute.rng(seed)
    passage, texts = brute.prose(rng, 60), [None, "", " \n ", "one two", "one two", "One TWO", "a b c d e", "A b c d e"]
    texts += ["again " * 120, "again " * 90, "x y " * 80, brute.prose(rng, 34), brute.prose(rng, 35)]
    for _ in range(count):
        texts.append(brute.prose(rng, rng.choice([20, 60, 150, 300])))
        if rng.random() < 0.4:
            texts.append(texts[-1])
        for _ in range(rng.choice([0, 0, 1, 4])):
            texts.append(brute.edited(rng, texts[-1], rng.choice([1, 2, 6])))
        if rng.random() < 0.3:
            texts.append(f"{brute.prose(rng, rng.randrange(40))} {passage} {brute.prose(rng, rng.randrange(40))}")
    return texts


def removed(documents, texts, **options):
    rows = substring_dedup.remove_repeats(documents(*enumerate(texts)), **options).collect()
    return [(r.n_words, r.n_removed, r.kept_text) for r in sorted(rows, key=lambda r: r.doc_id)]


@pytest.mark.parametrize("seed", [1, 2])
def test_repeated_passages_go(documents, seed):
    texts = corpus(seed)
    assert removed(documents, texts) == brute.without_repeats(texts)


def test_anchors_shared_by_several_shards(documents, monkeypatch):
    """So few segments a shard that the common passage's are dealt to many."""
    monkeypatch.setattr(substring_dedup, "SEGMENTS", 3)
    texts = corpus(3)
    assert removed(documents, texts) == brute.without_repeats(texts)


def test_a_long_text_against_itself(documents):
    rng = brute.rng(4)
    part = brute.prose(rng, 50)
    long = f"{part} {brute.prose(rng, 20_000, 10**6)} {part}"
    (found,) = removed(documents, [long])
    assert found[:2] == (20_100, 100)


def test_rows_without_a_key_of_their_own(documents):
    text = brute.prose(brute.rng(5), 50)
    rows = [(1, text), (1, text), (None, "other words"), (None, None), (2, brute.prose(brute.rng(6), 40))]
    found = substring_dedup.remove_repeats(documents(*rows), untouched=True).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed) for r in found) == [
        ("1", 50, 50), ("1", 50, 50), ("2", 40, 0), ("None", 0, 0), ("None", 2, 0),
    ]
    assert substring_dedup.remove_repeats(documents()).count() == 0


def test_automaton_counts_every_window():
    rng = brute.rng(7)
    sequences = [[rng.randrange(3) for _ in range(rng.randrange(4, 60))] for _ in range(12)]
    weights = [rng.randrange(1, 4) for _ in sequences]
    automaton = substring_dedup.Automaton()
    for sequence, weight in zip(sequences, weights):
        automaton.add(sequence, weight)
    automaton.finish()
    for size in (3, 5):
        for sequence in sequences:
            for k, state in enumerate(automaton.windows(sequence, size)):
                window = sequence[k : k + size]
                times = sum(
                    w * sum(s[j : j + size] == window for j in range(len(s) - size + 1))
                    for s, w in zip(sequences, weights)
                )
                assert automaton.weight[state] == times
    assert automaton.windows([9, 9, 9, 9], 3) == [0, 0]


def joined(documents, texts):
    rows = sorted(ngram_join.near_duplicates(documents(*enumerate(texts))).collect(), key=lambda r: r.doc_id)
    return [r.n_shingles for r in rows], [r.component_id for r in rows], [r.first for r in rows]


@pytest.mark.parametrize(("seed", "frequent"), [(1, 16), (2, 2)])
def test_near_duplicates_equal_all_pairs(documents, monkeypatch, seed, frequent):
    """With two documents making a shingle frequent, most entries are pairs."""
    monkeypatch.setattr(ngram_join, "FREQUENT", frequent)
    monkeypatch.setattr(ngram_join, "REPORTED", 2)
    texts = corpus(seed, 40)
    sizes, components, first = joined(documents, texts)
    assert (sizes, components) == brute.near_duplicates(texts)
    assert [k for k, f in enumerate(first) if f] == sorted(set(components))


def test_strangers_in_one_entry_make_no_rows(documents, monkeypatch):
    """Copies edited so much that few are similar share entries; only pairs that marks
    allow become rows, not each two of them."""
    monkeypatch.setattr(ngram_join, "FREQUENT", 2)
    monkeypatch.setattr(ngram_join, "REPORTED", 2)
    monkeypatch.setattr(ngram_join, "DEALT", 16)
    verified, counts = ngram_join._verified, []

    def counting(pairs, rows, bits):
        counts.append(pairs.count())
        return verified(pairs, rows, bits)

    monkeypatch.setattr(ngram_join, "_verified", counting)
    rng = brute.rng(8)
    base = brute.prose(rng, 150)
    texts = [base] + [brute.edited(rng, base, rng.choice([2, 9, 10])) for _ in range(70)]
    sizes, components, _ = joined(documents, texts)
    assert (sizes, components) == brute.near_duplicates(texts)
    assert len(set(components)) > 20 and sum(counts) < len(texts)


@pytest.mark.parametrize("words", [150, 1500])
def test_two_texts_meet_in_few_entries(documents, monkeypatch, words):
    """Texts that have a part in common share an entry for each two of its shingles;
    rows must not grow with these, nor with pairs of long texts that are not similar."""
    monkeypatch.setattr(ngram_join, "FREQUENT", 2)
    monkeypatch.setattr(ngram_join, "REPORTED", 2)
    met, counts = ngram_join._met, []

    def counting(dealt):
        found = met(dealt)
        counts.append(found.count())
        return found

    monkeypatch.setattr(ngram_join, "_met", counting)
    rng = brute.rng(9)
    texts = []
    for _ in range(4):
        base = brute.prose(rng, words)
        texts += [brute.edited(rng, base, rng.choice([1, words // 40, words // 12])) for _ in range(20)]
    sizes, components, _ = joined(documents, texts)
    assert (sizes, components) == brute.near_duplicates(texts)
    assert sum(counts) < 5 * len(texts)


@pytest.mark.parametrize("seed", range(3))
def test_differences_of_many_pairs(monkeypatch, seed):
    """The same as one by one, for parities of different lengths and a few at a time."""
    monkeypatch.setattr(ngram_join, "TOGETHER", 100)
    rng = np.random.default_rng(seed)
    left, right = ([ngram_join.wide_parities(rng.integers(1, 2**63, int(n), dtype=np.uint64)) for n in rng.choice([1, 900, 1500, 5000], 12)] for _ in range(2))
    x, y = rng.integers(0, 12, (2, 200))
    assert ngram_join.least_differences(left, right, x, y).tolist() == [ngram_join.least_difference(left[i], right[j]) for i, j in zip(x, y)]


@pytest.mark.parametrize("seed", range(2))
def test_marks_never_show_more_difference_than_there_is(seed):
    rng = np.random.default_rng(seed)
    for _ in range(50):
        tokens = np.unique(rng.integers(1, 2**63, int(rng.choice([1, 40, 900, 5000])), dtype=np.uint64))
        other = np.unique(np.append(tokens[rng.random(len(tokens)) > 0.1], rng.integers(1, 2**63, 9, dtype=np.uint64)))
        one, two = (ngram_join.mark(ngram_join.wide_parities(x)) for x in (tokens, other))
        assert len(one) == len(two) == ngram_join.MARK
        assert int(np.bitwise_count(one ^ two).sum()) <= len(np.setxor1d(tokens, other))


@pytest.mark.parametrize("seed", range(3))
def test_similar_sets_always_share_an_entry(seed):
    rng = np.random.default_rng(seed)
    for _ in range(400):
        n = int(rng.choice([1, 2, 3, 5, 7, 8, 9, 11, 31, 32, 40, 127, 130, 600]))
        tokens = np.unique(rng.integers(1, 2**63, n, dtype=np.uint64))
        other = tokens[rng.random(len(tokens)) > rng.choice([0.05, 0.12, 0.25])]
        other = np.unique(np.append(other, rng.integers(1, 2**63, int(rng.integers(0, 1 + n // 8)), dtype=np.uint64)))
        often = np.sort(tokens[rng.random(len(tokens)) < rng.choice([0.0, 0.5, 0.9, 1.0])])
        if len(other) and ngram_join.similar(tokens, other):
            one, two = ngram_join.entries(tokens, often), ngram_join.entries(other, often)
            assert any(len(np.intersect1d(a, b)) for a, b in zip(one, two))


@pytest.mark.parametrize("seed", range(3))
def test_parities_differ_in_no_more_than_the_sets(seed):
    rng = np.random.default_rng(seed)
    for _ in range(300):
        one = np.unique(rng.integers(1, 2**63, int(rng.integers(1, 3000)), dtype=np.uint64))
        two = np.unique(np.append(one[rng.random(len(one)) > 0.3], rng.integers(1, 2**63, 50, dtype=np.uint64)))
        a, b = ngram_join.parities(one), ngram_join.parities(two)
        apart = len(np.setxor1d(one, two))
        assert len(a) == 16 and sum(int(x).bit_count() for x in (a ^ b).view(np.uint64)) <= apart


def test_components_without_a_key_of_their_own(documents):
    text = brute.prose(brute.rng(8), 50)
    rows = [(5, text), (5, text), (None, text), (None, "quite other words in here"), (7, None)]
    found = ngram_join.near_duplicates(documents(*rows)).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in found) == [
        ("5", 46, "5"), ("5", 46, "5"), ("7", 0, "7"), ("None", 1, "None"), ("None", 46, "5"),
    ]
    assert sum(r.first for r in found) == 3
    assert ngram_join.near_duplicates(documents()).count() == 0


@pytest.mark.parametrize("shape", ["ascending", "shuffled", "star"])
def test_contractions_grow_with_the_logarithm(spark, monkeypatch, shape):
    """2,000 links in a chain or from one node, which is not the smallest."""
    numbers = list(range(2001))
    if shape == "shuffled":
        random.Random(1).shuffle(numbers)
    edges = [(1000, k) for k in numbers if k != 1000] if shape == "star" else list(itertools.pairwise(numbers))
    made = []

    def counted(*arguments, real=common._contracted):
        made.append(1)
        return real(*arguments)

    monkeypatch.setattr(common, "_contracted", counted)
    found = common.clusters(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {tuple(r) for r in found} == {(k, 0) for k in range(2001)}
    assert len(made) <= 15


def test_clusters_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(0, 40)] + [(100, 100 + k) for k in range(1, 30)] + [(300, 299), (299, 300), (7, 7)]
    found = common.clusters(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.component for r in found} == {
        **dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 130), 100), 299: 299, 300: 299,
    }


def test_lookup_spreads_heavy_keys(spark):
    rows = spark.range(20_000).selectExpr("id", "if(id % 3 = 0, -1, id % 50) AS k")
    table = rows.groupBy("k").count().selectExpr("k", "k * 10 AS v", "count AS n").filter("k != 7")
    found = common.lookup(rows, table, ["k"], "n").collect()
    assert len(found) == 20_000 and all(r.v == (None if r.k == 7 else r.k * 10) for r in found)


def vectors(seed, size=12, count=120):
    rng = np.random.default_rng(seed)
    out = [None, [], [0.0] * size, [float("nan")] + [1.0] * (size - 1), [float("inf")] * size, [None] + [1.0] * (size - 1)]
    for _ in range(count):
        one = rng.standard_normal(size)
        out.append(one.tolist())
        for _ in range(int(rng.choice([0, 0, 1, 4]))):
            out.append((one + rng.choice([0.0, 0.05, 0.2]) * rng.standard_normal(size)).tolist())
        if rng.random() < 0.1:
            out.append((one * rng.choice([1e-200, 3.0, 1e200])).tolist())
    return out


def usable(vector):
    known = vector and all(x is not None for x in vector) and np.isfinite(np.array(vector, float)).all() and any(vector)
    return [x / max(map(abs, vector)) for x in vector] if known else None


@pytest.mark.parametrize(("seed", "tile"), [(1, 1500), (2, 20)])
def test_near_vectors_equal_all_pairs(spark, monkeypatch, seed, tile):
    """Also with tiles so small that every cell is cut."""
    monkeypatch.setattr(vector_join, "TILE", tile)
    lot = vectors(seed)
    frame = spark.createDataFrame(list(enumerate(lot)), "vec_id long, embedding array<double>")
    for name in ("n", "node", "tile", "key", "vector", "_row"):
        frame = frame.selectExpr("*", f"'x' AS `{name}`")
    rows = sorted(vector_join.near_vectors(frame).collect(), key=lambda r: r.vec_id)
    links, components = brute.near_vectors([usable(v) for v in lot])
    assert [r.n_links for r in rows] == links and [r.component_id for r in rows] == components
    assert [r.kept for r in rows] == [k == c for k, c in enumerate(components)]


def test_vectors_are_sent_a_few_times_in_all_however_many_tiles(spark, monkeypatch):
    """Without structure, so that each is near to most cells; 400 bytes of each are in the table."""
    rng, held, store = np.random.default_rng(7), [], vector_join.stored
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    on_disk = lambda: sum(disk.getAllFiles().apply(k).length() for k in range(disk.getAllFiles().size()))

    def measured(rows, label):
        table = store(rows, label)
        held.append(on_disk())
        return table

    frame = spark.createDataFrame(
        [(k, v.tolist()) for k, v in enumerate(rng.standard_normal((3000, 64)))], "vec_id long, embedding array<float>"
    )
    common.released(spark)
    before = on_disk()
    monkeypatch.setattr(vector_join, "stored", measured)
    monkeypatch.setattr(vector_join, "TILE", 300)
    assert vector_join.near_vectors(frame).agg({"n_links": "sum"}).first()[0] == 0
    assert max(held) - before < 8 * 400 * 3000


def test_dense_groups_of_vectors_equal_all_pairs(spark):
    """Groups so close that whole strips are near, over a border of cells, some of them copies."""
    rng = np.random.default_rng(8)
    middles = rng.standard_normal((3, 16))
    lot = [(middles[k % 3] + rng.standard_normal(16) * (0.02, 0.15, 0.3)[k % 3]).tolist() for k in range(900)]
    lot += lot[:40]
    rows = vector_join.near_vectors(spark.createDataFrame(list(enumerate(lot)), "vec_id long, embedding array<double>"))
    rows = sorted(rows.collect(), key=lambda r: r.vec_id)
    links, components = brute.near_vectors(lot)
    assert [r.n_links for r in rows] == links and [r.component_id for r in rows] == components


def test_each_pair_of_vectors_is_taken_once(monkeypatch):
    """Of two vectors one is the guest, in one block, whether pairs are verified one by one or together."""
    rng = np.random.default_rng(9)
    middles = rng.standard_normal((40, 24))
    raw = np.concatenate([m + rng.standard_normal((30, 24)) * s for m, s in zip(middles, np.linspace(0.01, 0.4, 40))])
    units, _ = vector_join.units_of(raw)
    for leaf in (4, 32, 256):
        monkeypatch.setattr(vector_join, "LEAF", leaf)
        links = np.zeros(len(raw), np.int64)
        for number, part in enumerate(vector_join.blocks_of(24)):
            own = vector_join.turned(units)[:, part].astype(np.float32)
            signs = vector_join.signs_of(len(raw), own.shape[1])
            code = (own[:, :signs] > 0) @ (1 << np.arange(signs, dtype=np.int64)[::-1])
            tiles = [
                vector_join.Tile(code[at], at, np.ones(len(at), np.int64), own[at], signs, lambda at=at: raw[at])
                for at in np.array_split(rng.permutation(len(raw)), 3)
            ]
            for home, guest in itertools.product(tiles, tiles):
                found = vector_join.Links(home, guest, 24, number, 0.95)
                vector_join.compared(home, guest, found)
                rows = found.rows()
                np.add.at(links, rows.column(0).to_numpy(), rows.column(1).to_numpy())
        assert (links == (units @ units.T >= 0.95).sum(axis=1) - 1).all()


def test_vectors_without_a_key_of_their_own(spark):
    schema = "vec_id long, embedding array<float>"
    rows = [(3, [1.0, 0.0]), (3, [1.0, 0.0]), (None, [2.0, 0.0]), (None, [0.0, 1.0]), (4, [0.0, 1.0, 0.0]), (5, None)]
    found = vector_join.near_vectors(spark.createDataFrame(rows, schema)).collect()
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in found) == [
        ("3", 2, "3"), ("3", 2, "3"), ("4", 0, "4"), ("5", 0, "5"), ("None", 0, "None"), ("None", 2, "3"),
    ]
    assert vector_join.near_vectors(spark.createDataFrame([], schema)).count() == 0


def test_parities_never_overstate_a_difference():
    """Of sets of any sizes, long ones too, and they show that long ones are far apart."""
    rng = np.random.default_rng(4)
    for size in (1, 5, 700, 1024, 1500, 20_000):
        one = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64))
        for share in (0.0, 0.1, 0.9, 1.0):
            other = np.unique(np.append(one[rng.random(len(one)) >= share], rng.integers(0, 1 << 63, int(size * share * 1.3)).astype(np.uint64)))
            differ = len(np.setxor1d(one, other))
            least = ngram_join.least_difference(ngram_join.wide_parities(one), ngram_join.wide_parities(other))
            assert least <= differ and (share > 0 or least == 0)
            if share == 1.0 and size >= 700:
                assert 7 * least > len(one) + len(other)
