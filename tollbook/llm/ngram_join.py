"""Near-duplicate documents by an exact Jaccard join of word shingles, with prefixes
of rare shingles alone and of frequent ones in pairs.

Two sets of n and m shingles with a similarity of t or more differ so little that
either lacks at most n - ceil(t n) of its own shingles in the other. All shingles
have one order, rare ones first and by hash within. A set is indexed under the
beginning of its shingles in that order, long enough that no choice of so many
lacking shingles can destroy all that it is indexed under: a rare shingle is one
entry, and frequent shingles are entries in pairs. Pairs are taken within classes
of the frequent shingles, so that there are few, at the price of one more shingle a
class. Classes depend on the size of a set; one that could be similar to smaller
sets with other classes is indexed under theirs too. Similar sets thus share an
entry. Texts that share a passage share an entry for each of its combinations, so
entries are put together by one of their members: two sets then meet once or a few
times and not in every combination. Sets that share entries are verified, each
against some of those it shares an entry with, until every two of an entry are
connected or were compared.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tollbook.llm.common import clusters, discard, lookup, released, stored, text_of, with_row
from tollbook.llm.words import hashed_words, mix, read, span_hashes, window_hashes

SHINGLE = 5
#: Similarity of 3 / 4 or more, in whole numbers.
ABOVE, BELOW = 3, 4
#: Sets with fewer shingles are indexed under single ones whether frequent or not.
SMALL = 8
#: Shingles of a block of documents that are counted together; in how many of its
#: documents a shingle must be to be reported, and in how many of the reporting blocks'
#: documents to be frequent; and how many are held frequent at most. Which ones are
#: has no bearing on the result, only on the number of comparisons.
BLOCK, REPORTED, FREQUENT, MOST_FREQUENT = 2_000_000, 4, 16, 300_000
#: Sets that the members of an entry are compared with in the first round, and in any.
HUBS, MOST_HUBS = 1, 1024
#: Members of an entry that are laid beside its hubs at a time.
DEALT = 512
#: Longs of parities that are compared at a time.
TOGETHER = 1 << 19
#: Shares that the pairs of one node are dealt to.
SHARES = 16
#: Places of a set's parities at least, and how many sets' numbers may be broadcast.
LEAST_PLACES, MOST_NEEDED = 1024, 1_000_000
#: Longs of a set's mark, which are its parities folded to 512 places, and of those
#: that go with it to its entries at most.
MARK, CARRIED = 8, 512


def shingles(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """The distinct shingles' hashes in order; of fewer words all as one, of none none."""
    if len(words) < size:
        return span_hashes(words, np.array([0]), np.array([len(words)])) if len(words) else words
    return np.unique(window_hashes(words, size))


def sets_of(texts: list[bytes]) -> list[np.ndarray]:
    return [shingles(w) for w in hashed_words(texts, lower=True)]


def frequent_shingles(rows: DataFrame) -> np.ndarray:
    """Frequent shingles in order, of bounded number, counted over all rows: a shingle
    that a given share of all documents has is had by that share of some block."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = [], 0

        def out() -> pa.RecordBatch:
            found, counts = np.unique(np.concatenate(held), return_counts=True)
            many = counts >= REPORTED
            return pa.RecordBatch.from_arrays(
                [pa.array(found[many].view(np.int64)), pa.array(counts[many])], names=["shingle", "n"]
            )

        for _, texts in read(batches):
            for one in sets_of(texts):
                held.append(one)
                total += len(one)
                if total >= BLOCK:
                    yield out()
                    held, total = [], 0
        if held:
            yield out()

    counted = rows.select("_row", "text").mapInArrow(run, "shingle long, n long").groupBy("shingle")
    counted = counted.agg(F.sum("n").alias("n")).filter(F.col("n") >= FREQUENT)
    top = counted.orderBy(F.desc("n"), "shingle").limit(MOST_FREQUENT).select("shingle").toPandas()
    return np.sort(top["shingle"].to_numpy(np.int64).view(np.uint64))


def scheme(n: int) -> int:
    """The group of sizes that share classes: below SMALL, then by factors of four."""
    group = 0
    while n >= SMALL * 4**group:
        group += 1
    return group


def entries(tokens: np.ndarray, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What a set is indexed under, as hashes: rare shingles, and pairs of frequent ones
    (in small sets frequent ones alone)."""
    n = len(tokens)
    lacking = n - -(-ABOVE * n // BELOW)
    often = np.zeros(n, bool)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)
        often = frequent[at] == tokens
    rare, common = tokens[~often], tokens[often]
    own = scheme(n)
    groups = {own, scheme(-(-ABOVE * n // BELOW))}
    pairs = []
    for group in sorted(groups) if len(rare) <= lacking else ():
        if group == 0:
            pairs.append(common[: lacking + 1 - len(rare)])
            continue
        classes = 2 * 4 ** (group - 1)
        kind = (mix(common + np.uint64(group)) % np.uint64(classes)).astype(np.int64)
        # The first of each class adds nothing to what cannot be destroyed.
        order = np.argsort(kind, kind="stable")
        first = np.zeros(len(common), bool)
        first[order[np.flatnonzero(np.append(True, kind[order][1:] != kind[order][:-1]))]] = True
        enough = np.searchsorted(np.cumsum(~first), lacking + 1 - len(rare)) + 1
        chosen, kind = common[:enough], kind[:enough]
        order = np.argsort(kind, kind="stable")
        for same in np.split(chosen[order], np.flatnonzero(np.diff(kind[order])) + 1):
            left, right = np.triu_indices(len(same), 1)
            pairs.append(mix(mix(same[left] + np.uint64(group)) + same[right]))
    return rare[: lacking + 1], np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.uint64)


def _indexed(texts: DataFrame, frequent) -> DataFrame:
    """``sig``, ``node``, ``n`` of every entry and whether it is a pair, from one pass
    over the texts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = frequent.value
        for nodes, raw in read(batches):
            sets = sets_of(raw)
            for paired, found in enumerate(zip(*(entries(s, often) for s in sets), strict=True)):
                counts = [len(x) for x in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(found).view(np.int64)),
                        pa.array(np.repeat(np.array(nodes, np.int64), counts)),
                        pa.array(np.repeat(np.array([len(s) for s in sets], np.int32), counts)),
                        pa.array(np.full(sum(counts), bool(paired))),
                    ],
                    names=["sig", "node", "n", "paired"],
                )

    return texts.select("node", "text").mapInArrow(run, "sig long, node long, n int, paired boolean")


def parities(tokens: np.ndarray, places: int = LEAST_PLACES) -> np.ndarray:
    """Of the shingles that fall to each of some places, whether they are odd in number,
    as bits in longs. Places are a power of two."""
    place = (mix(tokens + np.uint64(0x5851F42D4C957F2D)) & np.uint64(places - 1)).astype(np.int64)
    odd = (np.bincount(place, minlength=places) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.uint64)


def wide_parities(tokens: np.ndarray) -> np.ndarray:
    """Parities with as many places as shingles at least: fewer could not show that two
    large sets differ in a seventh of their shingles."""
    return parities(tokens, max(LEAST_PLACES, 1 << (max(1, len(tokens)) - 1).bit_length()))


def folded(bits: np.ndarray, longs: int) -> np.ndarray:
    """Parities, of one set or of one a row, with so many longs at most."""
    while bits.shape[-1] > longs:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] ^ bits[..., half:]
    return bits


def mark(bits: np.ndarray) -> np.ndarray:
    return folded(bits, MARK)


def least_difference(left: np.ndarray, right: np.ndarray) -> int:
    """In how many shingles two sets differ at least, by their parities: the one with
    more places is folded until both have the same."""
    longs = min(len(left), len(right))
    return int(np.bitwise_count(folded(left, longs) ^ folded(right, longs)).sum())


def least_differences(left: list[np.ndarray], right: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The same for ``left[i]`` and ``right[j]`` of each ``i`` and ``j`` in ``x`` and ``y``,
    for many pairs at a time."""
    out = np.zeros(len(x), np.int64)
    wide = np.stack([np.array([len(b) for b in of], np.int64)[at] for of, at in ((left, x), (right, y))])
    for widths in np.unique(wide, axis=1).T:
        these = np.flatnonzero((wide == widths[:, None]).all(0))
        longs, sides = widths.min(), []
        for of, at in ((left, x[these]), (right, y[these])):
            own, which = np.unique(at, return_inverse=True)
            sides.append((folded(np.stack([of[k] for k in own]), longs), which))
        (one, i), (two, j) = sides
        step = max(1, TOGETHER // int(longs))
        for k in range(0, len(these), step):
            differ = np.bitwise_count(one[i[k : k + step]] ^ two[j[k : k + step]])
            out[these[k : k + step]] = differ.sum(1, dtype=np.int64)
    return out


def _texts_of(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """``_row`` and text of the given nodes, from the rows that stand for them. Few nodes
    are broadcast as numbers, so that the texts of others are not shuffled to find them."""
    wanted = nodes.select(F.col("node").alias("_row"))
    if wanted.limit(MOST_NEEDED + 1).count() <= MOST_NEEDED:
        wanted = F.broadcast(wanted)
    return rows.select("_row", "text").join(wanted, "_row", "left_semi")


def _parities(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, raw in read(batches):
            bits = [wide_parities(s) for s in sets_of(raw)]
            carried = [folded(b, CARRIED) for b in bits]
            both = (pa.array([x.tobytes() for x in of], pa.binary()) for of in (bits, carried))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), *both], names=["node", "bits", "carried"])

    return stored(_texts_of(rows, nodes).mapInArrow(run, "node long, bits binary, carried binary"), "parities")


def _sets(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, raw in read(batches):
            found = pa.array([s.tobytes() for s in sets_of(raw)], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), found], names=["node", "set"])

    return stored(_texts_of(rows, nodes).mapInArrow(run, "node long, set binary"), "sets")


def similar(left: np.ndarray, right: np.ndarray) -> bool:
    common = len(np.intersect1d(left, right, assume_unique=True))
    return BELOW * common >= ABOVE * (len(left) + len(right) - common)


def _possible(pairs: DataFrame, bits: DataFrame) -> DataFrame:
    """The pairs (``a``, ``b``, their sizes' sum ``n``) that parities allow: sets differ
    in at least as many shingles as parities differ, and similar ones in at most a
    seventh of their sizes' sum."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = ([np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column(k)] for k in (3, 4))
            differ = np.array([least_difference(x, y) for x, y in zip(*both, strict=True)], np.int64)
            allowed = (BELOW + ABOVE) * differ <= (BELOW - ABOVE) * batch.column(2).to_numpy()
            yield batch.select([0, 1]).filter(pa.array(allowed))

    left = bits.select(F.col("node").alias("a"), F.col("bits").alias("left"))
    right = bits.select(F.col("node").alias("b"), F.col("bits").alias("right"))
    both = pairs.select("a", "b", F.col("n").cast("long").alias("n")).join(left, "a").join(right, "b")
    return both.select("a", "b", "n", "left", "right").mapInArrow(run, "a long, b long")


def _met(dealt: DataFrame) -> DataFrame:
    """The pairs (``a``, ``b``, their sizes' sum ``n``) of ``members`` and ``hubs`` of the
    same row that are of different components and that sizes, marks and, of the pairs left
    by these, parities allow."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = []
            for lists in (batch.column("members"), batch.column("hubs")):
                flat = lists.values
                bits = [np.frombuffer(x, np.uint64) for x in flat.field("carried").to_pylist()]
                marks = np.array([mark(x) for x in bits]).reshape(-1, MARK)
                numbers = (flat.field(k).to_numpy(zero_copy_only=False) for k in ("node", "n", "component"))
                sides.append((lists.offsets.to_numpy(), bits, marks, *numbers))
            found = []
            for k in range(batch.num_rows):
                (bits, marks, node, n, of), (hub_bits, hub_marks, hub, m, hub_of) = (
                    [x[at[k] : at[k + 1]] for x in side] for at, *side in sides
                )
                n, m = n.astype(np.int64), m.astype(np.int64)
                close = BELOW * np.minimum.outer(n, m) >= ABOVE * np.maximum.outer(n, m)
                x, y = np.nonzero(close & np.not_equal.outer(of, hub_of))
                differ = np.bitwise_count(marks[x] ^ hub_marks[y]).sum(1, dtype=np.int64)
                allowed = (BELOW + ABOVE) * differ <= (BELOW - ABOVE) * (n[x] + m[y])
                x, y = x[allowed], y[allowed]
                if len(x):
                    allowed = (BELOW + ABOVE) * least_differences(bits, hub_bits, x, y) <= (BELOW - ABOVE) * (n[x] + m[y])
                    x, y = x[allowed], y[allowed]
                if len(x):
                    found.append((np.maximum(node[x], hub[y]), np.minimum(node[x], hub[y]), n[x] + m[y]))
            if found:
                columns = [pa.array(np.concatenate(c)) for c in zip(*found, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "n"])

    return dealt.select("members", "hubs").mapInArrow(run, "a long, b long, n long")


def _verified(pairs: DataFrame, rows: DataFrame, bits: DataFrame) -> DataFrame:
    """The pairs (``a``, ``b``) whose sets are similar.

    Pairs meet at their smaller node, which is the hub of most: its set is sent once for a
    share of its pairs and only the other node's with each pair. The pairs of one node are
    dealt to so many shares, and a task holds two sets at a time, however many there are.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, own, held = None, None, [[], []]
        for batch in batches:
            hubs, shares, others = (batch.column(k).to_pylist() for k in range(3))
            for k, (hub, share, other) in enumerate(zip(hubs, shares, others, strict=True)):
                tokens = np.frombuffer(batch.column(3)[k].as_buffer(), np.uint64)
                if other is None:
                    at, own = (hub, share), tokens
                elif (hub, share) == at and similar(own, tokens):
                    held[0].append(max(hub, other))
                    held[1].append(min(hub, other))
            if len(held[0]) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in held], names=["a", "b"])
                held = [[], []]
        if held[0]:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in held], names=["a", "b"])

    possible = stored(_possible(pairs, bits), "pairs")
    sets = _sets(rows, possible.select(F.col("a").alias("node")).union(possible.select("b")).distinct())
    share = F.pmod(F.xxhash64("a"), F.lit(SHARES))
    met = possible.select(F.col("b").alias("hub"), F.col("a").alias("other"), share.alias("share"))
    each = met.select("hub", "share").distinct().join(sets, F.col("hub") == F.col("node"))
    others = met.join(sets, F.col("other") == F.col("node"))
    null = F.lit(None).cast("long")
    laid = each.select("hub", "share", null.alias("other"), "set").union(others.select("hub", "share", "other", "set"))
    laid = laid.repartition("hub", "share").sortWithinPartitions("hub", "share", F.col("other").asc_nulls_first())
    found = stored(laid.mapInArrow(run, "a long, b long"), "links")
    discard(possible, sets)
    return found


def _links(members: DataFrame, rows: DataFrame, bits: DataFrame) -> DataFrame:
    """Enough links for the components of all similar pairs that share an entry.

    In each round the members of an entry are compared with some of them, its hubs,
    unless they are connected already; the hubs are then done with there, and so is an
    entry whose members are all connected. Copies of one text settle in the first
    round, however many they are. An entry's members are dealt to as many places as a
    round takes hubs, and each place gives one, of the component with the fewest members
    there, so that a few strangers among many copies are soon through. Each round takes
    up to sixteen times as many as the one before. Components grow by each
    round's links alone, and a round's tables go when it ends.
    """
    spark = rows.sparkSession
    found, hubs = None, HUBS
    while True:
        if found is None:
            placed = members.withColumn("component", F.col("node"))
        else:
            placed = members.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
        # Counted per component and then per place, so no entry's members meet in one task.
        # Places are those of nodes: a component that none of the others is similar to
        # gives many hubs a round.
        place = F.pmod(F.xxhash64("node"), F.lit(hubs))
        parts = placed.groupBy("sig", "component", place.alias("place")).agg(
            F.count("*").alias("m"), F.min("node").alias("hub")
        )
        least = parts.groupBy("sig", "place").agg(
            F.min("component").alias("low"),
            F.max("component").alias("high"),
            F.sum("m").alias("members"),
            F.min(F.struct("m", "hub")).alias("least"),
        )
        chosen = least.groupBy("sig").agg(
            F.min("low").alias("low"),
            F.max("high").alias("high"),
            F.sum("members").alias("members"),
            F.collect_list("least.hub").alias("hubs"),
        )
        shares = F.ceil(F.col("members") / DEALT).alias("shares")
        chosen = stored(chosen.filter("low < high").select("sig", shares, "hubs"), "hubs")
        # Members meet the hubs many at a time: only pairs that may be similar become rows.
        # Parities join them at last, and then go the one way to where they are compared.
        met = placed.join(chosen, "sig").select("sig", "shares", "node", "n", "component", F.array_contains("hubs", F.col("node")).alias("hub"))
        met = met.join(bits.select("node", "carried"), "node")
        share = F.pmod(F.xxhash64(F.lit(1), "node"), F.col("shares")).alias("share")
        one = F.collect_list(F.struct("node", "n", "component", "carried"))
        ahead = met.filter("hub").groupBy("sig", "shares").agg(one.alias("hubs"))
        ahead = ahead.select("sig", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares") - 1)).alias("share"), "hubs")
        dealt = met.groupBy("sig", share).agg(one.alias("members")).join(ahead, ["sig", "share"])
        pairs = _met(dealt).distinct()
        new = _verified(pairs, rows, bits)
        done = chosen.select("sig", F.col("hubs").alias("done"))
        waiting = members.join(done, "sig").filter(~F.array_contains("done", F.col("node")))
        left = stored(waiting.select("sig", "node", "n"), "left")
        rest = stored(_different(left), "members")
        grown = _grown(found, new)
        discard(chosen, left, members, new, *([found] if found is not None and grown is not found else []))
        members, found, hubs = rest, grown, min(16 * hubs, MOST_HUBS)
        del placed, parts, least, met, ahead, dealt, pairs, done, waiting
        released(spark)
        if members.limit(1).count() == 0:
            discard(members)
            return found


def _merged(members: DataFrame) -> DataFrame:
    """One entry of all those with the same first member, by a hash, and in it the members
    of all. Every two that shared an entry share one, and all of one shared an entry with
    its first member. Two that share many entries, which are much alike, share few."""
    rank = F.struct(F.xxhash64(F.lit(2), "node").alias("rank"), "node")
    first = members.groupBy("sig").agg(F.min(rank).alias("first")).select("sig", F.col("first.node").alias("first"))
    return members.join(first, "sig").select(F.col("first").alias("sig"), "node", "n").distinct()


def _different(members: DataFrame) -> DataFrame:
    """Without entries that have one member, and one entry of those that have the same
    members: a passage that documents share is an entry for each of its combinations,
    all with the same pairs. Entries are told apart by 128 bits of their members."""
    of_nodes = [F.bit_xor(F.xxhash64(F.lit(k), "node")).alias(f"x{k}") for k in range(2)]
    entry = members.groupBy("sig").agg(F.count("*").alias("c"), *of_nodes).filter("c > 1")
    kept = entry.groupBy("c", "x0", "x1").agg(F.min("sig").alias("sig")).select("sig")
    return members.join(kept, "sig", "left_semi")


def _grown(found: DataFrame | None, new: DataFrame) -> DataFrame:
    """Components (``node``, ``component``) by those found so far and new links: only
    the components that new links meet are put together, and without new links they
    stay as they are."""
    if found is None:
        return clusters(new)
    if new.limit(1).count() == 0:
        return found
    at = found.select(F.col("node").alias("at"), F.col("component").alias("of"))
    left = new.join(at, F.col("a") == F.col("at"), "left").select(F.coalesce("of", "a").alias("a"), "b")
    both = left.join(at, F.col("b") == F.col("at"), "left").select("a", F.coalesce("of", "b").alias("b"))
    met = clusters(both)
    moved = met.select(F.col("node").alias("component"), F.col("component").alias("now"))
    older = found.join(moved, "component", "left").select("node", F.coalesce("now", "component").alias("component"))
    # Nodes that were in no component; those that name one are among its nodes already.
    newer = met.join(found.select("node"), "node", "left_anti").select("node", "component")
    grown = stored(older.union(newer), "components")
    discard(met)
    return grown


def near_duplicates(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """The key, ``_row``, ``n_shingles``, ``component_id`` (smallest key that links
    reach, its own included) and ``first`` (whether the row stands for its component).

    Texts are compared by A-Z as a-z. Documents without words are linked with nothing,
    not even with each other; a null text has none. Equal texts are reduced to one
    before anything is compared, however many there are, and get its component back at
    the end. Rows with null or equal keys are rows of their own; where a component has
    null keys only, its id is null.
    """
    spark = docs.sparkSession
    rows = with_row(docs, key, text_of("text").alias("text"))
    same = (F.xxhash64("text").alias("k1"), F.xxhash64(F.lit(7), "text").alias("k2"))
    copies = rows.select("_row", key, *same).groupBy("k1", "k2")
    copies = stored(copies.agg(F.min("_row").alias("node"), F.min(key).alias("low"), F.count("*").alias("rows")), "texts")
    texts = rows.select("_row", "text", *same).groupBy("k1", "k2")
    texts = texts.agg(F.min("_row").alias("node"), F.first("text").alias("text"))
    frequent = spark.sparkContext.broadcast(frequent_shingles(rows))
    # Rare shingles are those that few documents have, so each may go to one task. Others
    # may be had by very many: they are counted, and reduced, before they are shuffled.
    of_entry = F.count("*").over(Window.partitionBy("sig"))
    indexed = stored(_indexed(texts, frequent), "indexed")
    del texts
    released(spark)
    single = indexed.filter("not paired").drop("paired").withColumn("c", of_entry).filter("c > 1").drop("c")
    paired = indexed.filter("paired").drop("paired")
    counted = paired.groupBy("sig").agg(F.count("*").alias("c")).filter("c > 1").select("sig")
    shared = stored(single.union(paired.join(counted, "sig", "left_semi")), "shared")
    del single, paired, counted
    discard(indexed)
    released(spark)
    members = stored(_merged(shared), "members")
    discard(shared)
    bits = _parities(rows, members.select("node").distinct())
    found = _links(members, rows, bits)
    discard(bits)
    labelled = copies.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    lows = labelled.groupBy("component").agg(F.min("low").alias("component_id"), F.min("node").alias("stands"))
    labelled = labelled.join(lows, "component").select("k1", "k2", "component_id", "stands", "rows")
    placed = lookup(_measured(rows.select("_row", key, *same, "text"), key), labelled, ["k1", "k2"], "rows")
    linked = F.col("n_shingles") > 0
    return placed.select(
        key,
        "_row",
        "n_shingles",
        F.when(linked, F.col("component_id")).otherwise(F.col(key)).alias("component_id"),
        (~linked | (F.col("stands") == F.col("_row"))).alias("first"),
    )


def _measured(rows: DataFrame, key: str) -> DataFrame:
    """The rows with the size of their sets instead of their texts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in read(batches):
            columns = [[k[name] for k in keys] for name in names[:-1]]
            columns.append([len(s) for s in sets_of(texts)])
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    names = ["_row", key, "k1", "k2", "n_shingles"]
    at = F.struct("_row", key, "k1", "k2").alias("at")
    return rows.select(at, "text").mapInArrow(run, ", ".join(f"`{n}` long" for n in names))
