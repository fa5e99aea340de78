"""The trie of shared beginnings of conversations that are rebuilt from the head of another
one and their own later turns.

A sequence of turns has a fingerprint from a monoid: the pair of a product (a polynomial
of the turns' digests modulo a prime) and the power by which a product before it is
multiplied. A rebuilt prefix's fingerprint is the base head's composed with the own
suffix's, so rebuilt texts are never put together; a path's rows hold references to the
stored turns instead.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tollbook.llm.common import lookup, stored

#: Conversations of a block share the head of its first one; a head has 0 to 8 turns.
BLOCK, HEADS = 5, 9
#: Fingerprints are computed modulo this prime, in one of these bases: the next one is
#: taken when two different prefixes are found to have one fingerprint.
PRIME = (1 << 127) - 1
BASES = (0x2545F4914F6CDD1D27D4EB2F165667C5, 0x369DEA0F31A53F85FF51AFD7ED558CCD, 0x5851F42D4C957F2D14057B7EF767814F)
#: Characters of a run of conversation numbers that is handed on as one row.
RUN = 1 << 20

PATHS = (
    "conv_id long, depth long, node binary, parent binary, source long, place long, n_bytes long, ends boolean"
)
NODE = ["depth", "node"]


class Fingerprint(NamedTuple):
    product: int
    power: int

    def then(self, other: Fingerprint) -> Fingerprint:
        """Of this sequence followed by the other; associative, with EMPTY as the unit."""
        return Fingerprint((self.product * other.power + other.product) % PRIME, self.power * other.power % PRIME)

    def key(self) -> bytes:
        return self.product.to_bytes(16, "big")


EMPTY = Fingerprint(0, 1)


def head_length(conv_id: int) -> int:
    return zlib.crc32(str(conv_id).encode()) % HEADS


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """``block``, ``conv_id``, ``place`` (from 0), ``role``, ``text`` and a digest of both."""
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    turns = turns.withColumn("block", F.col("conv_id") - F.pmod("conv_id", F.lit(BLOCK))).repartition("block")
    order = Window.partitionBy("block", "conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    digest = F.unhex(F.substring(F.sha2(F.concat_ws(":", F.length("role").cast("string"), F.concat("role", "text")), 256), 1, 32))
    return turns.select(
        "block", "conv_id", (F.row_number().over(order) - 1).cast("long").alias("place"), "role", "text", digest.alias("digest")
    )


def rebuilt_paths(turns: DataFrame, base: int) -> DataFrame:
    """A row for each rebuilt prefix of each conversation: its node's fingerprint and its
    parent's, and which stored turn (``source``, ``place``) is its last.

    A task streams through its blocks and holds the first head's fingerprints, eight at
    most, and the running product of the turns that follow a conversation's own head.
    """
    slim = turns.select("block", "conv_id", "place", "digest", F.octet_length("text").cast("long").alias("n_bytes"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = current = None
        head: list[tuple[Fingerprint, int]] = []
        length = depth = 0
        joined = parent = EMPTY
        suffix = EMPTY
        rows: list[list] = []
        for batch in batches:
            for in_block, conv_id, place, digest, n_bytes in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if in_block != block:
                    block, head = in_block, []
                if conv_id != current:
                    if rows:
                        rows[-1][-1] = True
                    if len(rows) > 10_000:
                        yield _batch(rows)
                        rows = []
                    current, length, depth = conv_id, head_length(conv_id), 0
                    joined, suffix = EMPTY, EMPTY
                    rows.append([conv_id, 0, EMPTY.key(), None, None, None, 0, False])
                    if conv_id != block:
                        for k, (product, size) in enumerate(head[:length]):
                            depth += 1
                            rows.append([conv_id, depth, product.key(), joined.key(), block, k, size, False])
                            joined = product
                    parent = joined
                turn = Fingerprint(int.from_bytes(digest, "big") % PRIME, base)
                if conv_id == block and place < HEADS - 1:
                    head.append(((head[-1][0] if head else EMPTY).then(turn), n_bytes))
                if place < length:
                    if conv_id != block:
                        continue
                    # The first conversation's head is its own.
                    joined = whole = head[place][0]
                else:
                    suffix = suffix.then(turn)
                    whole = joined.then(suffix)
                depth += 1
                if len(rows) > 20_000:
                    yield _batch(rows[:-1])
                    rows = rows[-1:]
                rows.append([conv_id, depth, whole.key(), parent.key(), conv_id, place, n_bytes, False])
                parent = whole
        if rows:
            rows[-1][-1] = True
            yield _batch(rows)

    return slim.repartition("block").sortWithinPartitions("block", "conv_id", "place").mapInArrow(run, PATHS)


def _batch(rows: list[list]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
    names = [field.split()[0] for field in PATHS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def nodes_of(paths: DataFrame) -> DataFrame:
    """A row per node, with what its rows must agree on as a least and a greatest value."""
    return paths.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"),
        F.count("*").alias("n_convs"),
        F.min("parent").alias("parent"),
        F.max("parent").alias("other_parent"),
        F.max("n_bytes").alias("n_bytes"),
        F.min(F.struct("source", "place")).alias("first"),
        F.max(F.struct("source", "place")).alias("last"),
    )


def unequal(paths: DataFrame, nodes: DataFrame, turns: DataFrame) -> DataFrame:
    """Nodes whose rows differ in the parent, or in the role or text of the turn that
    they refer to. With none of them, equal fingerprints are equal sequences, as follows
    from depth to depth. Nodes with a single reference need no look at the text.
    """
    shared = nodes.filter("first != last").select(*NODE, F.col("n_convs").alias("_weight"), F.lit(True).alias("shared"))
    refer = paths.filter("depth > 0").groupBy(*NODE, "source", "place").agg(F.lit(1).alias("one")).drop("one")
    refer = lookup(refer, shared, NODE, "_weight").filter("shared").drop("shared")
    said = turns.select(F.col("conv_id").alias("source"), "place", F.struct("role", "text").alias("said"))
    texts = refer.join(said, ["source", "place"]).groupBy(*NODE).agg(F.min("said").alias("least"), F.max("said").alias("most"))
    return texts.filter("least != most").select(*NODE).union(nodes.filter("parent != other_parent").select(*NODE))


def end_digests(paths: DataFrame) -> DataFrame:
    """Per node at which conversations end: SHA-256 of their numbers, joined by commas.

    The numbers are sorted over all tasks, so that a node with very many is shared by
    them, and joined to runs; the digest, which chains them, reads only the runs.
    """
    ends = paths.filter("ends").select(*NODE, "conv_id")
    spread = ends.repartitionByRange(*NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id")
    runs = spread.mapInArrow(_runs, "depth long, node binary, first long, run string")
    placed = runs.repartition(*NODE).sortWithinPartitions(*NODE, "first")
    return placed.mapInArrow(_hashed, "depth long, node binary, ends_sha256 string")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, numbers, size, done = None, [], 0, []
    names = ["depth", "node", "first", "run"]

    def out() -> pa.RecordBatch:
        columns = list(zip(*done, strict=True))
        done.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.binary(), pa.int64(), pa.string()), strict=True)], names=names
        )

    for batch in batches:
        for depth, node, conv_id in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if numbers and ((depth, node) != key or size > RUN):
                done.append((*key, int(numbers[0]), ",".join(numbers)))
                numbers, size = [], 0
                if len(done) >= 1000 or len(done[-1][-1]) > RUN // 2:
                    yield out()
            key = depth, node
            numbers.append(str(conv_id))
            size += len(numbers[-1]) + 1
    if numbers:
        done.append((*key, int(numbers[0]), ",".join(numbers)))
    if done:
        yield out()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, digest, done = None, None, []

    def out() -> pa.RecordBatch:
        columns = list(zip(*done, strict=True))
        done.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.binary(), pa.string()), strict=True)],
            names=["depth", "node", "ends_sha256"],
        )

    for batch in batches:
        for depth, node, run in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3), strict=True):
            if (depth, node) != key:
                if digest:
                    done.append((*key, digest.hexdigest()))
                key, digest = (depth, node), hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(run.as_py().encode())
        if len(done) >= 10_000:
            yield out()
    if digest:
        done.append((*key, digest.hexdigest()))
    if done:
        yield out()


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``,
    ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``.

    What a subtree adds up to is found without going from depth to depth: a node belongs
    to its smallest member, whose path holds all nodes above it, so running sums along
    each conversation's path, added up by node, are the sums of the subtrees.

    Rows without ``conv_id`` belong to no conversation and are left out; a null role or
    text is empty. Turns of equal number are in the order of role and text, and repeated
    rows are turns of their own. Blocks of negative numbers go down to the next multiple
    of five. An empty table gives an empty one; other columns do not matter.
    """
    turns = stored(numbered_turns(conversations), "turns")
    for base in BASES:
        paths = stored(rebuilt_paths(turns, base), "paths")
        nodes = stored(nodes_of(paths), "nodes")
        if unequal(paths, nodes, turns).limit(1).count() == 0:
            break
    else:
        raise ValueError("different prefixes have equal fingerprints in all bases")

    children = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("node")).agg(
        F.count("*").alias("n_children")
    )
    nodes = stored(
        nodes.select(*NODE, "conv_id", "n_convs", "parent", ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved"))
        .join(children, NODE, "left")
        .withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long")),
        "trie",
    )
    own = nodes.select(
        "conv_id", "depth", F.lit(None).cast("binary").alias("node"), (F.col("n_children") == 0).cast("long").alias("leaf"), "saved"
    )
    zero = F.lit(0).cast("long")
    along = Window.partitionBy("conv_id").orderBy(F.col("depth").desc()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    sums = (
        paths.select("conv_id", *NODE, zero.alias("leaf"), zero.alias("saved"))
        .unionByName(own)
        .select("node", "depth", F.sum("leaf").over(along).alias("leaf"), F.sum("saved").over(along).alias("saved"))
        .filter("node is not null")
        .groupBy(*NODE)
        .agg(F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    )
    above = nodes.filter("n_children > 0").select(
        (F.col("depth") + 1).alias("depth"), F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"), "n_children"
    )
    named = lookup(nodes.drop("saved"), above, ["depth", "parent"], "n_children")
    nothing = hashlib.sha256(b"").hexdigest()
    return (
        named.join(sums, NODE)
        .join(end_digests(paths), NODE, "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
        )
    )
