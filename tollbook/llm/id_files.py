"""Token ids in binary shards with a minimal perfect hash index for keyed access.

A shard is: MAGIC; the ids of its documents one after the other; the arrays of
the index; a JSON footer that says where each array lies; the footer's length as
eight bytes; MAGIC again.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tollbook.llm.common import stored
from tollbook.llm.tokens import encoder
from tollbook.llm.words import mix, ranges, read

MAGIC = b"TBIDS\x00\x00\x01"
MANIFEST = "shard long, path string, n_docs long, n_tokens long, first_key long, last_key long"
#: Characters of a text by which documents of one key are put in order.
ORDERED_BY = 64
END_ID = 1


class PerfectHash:
    """Distinct 64-bit keys to 0..n-1, each number once.

    On each level a key hashes to one of about GAMMA slots a key left; keys alone in
    their slot stay, the others go on to the next level. A key's number is that of
    the taken slots before its own. Levels shrink geometrically, so building takes
    linear and a look-up constant time on average.
    """

    GAMMA = 2.0

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        taken = np.cumsum([0, *(int(x.sum()) for x in levels)])
        self.before = [t + np.cumsum(x) - x for t, x in zip(taken, levels, strict=False)]
        self.size = int(taken[-1])

    @staticmethod
    def slots(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(keys + np.uint64((0x9E3779B97F4A7C15 * (level + 1)) % 2**64)) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels, left = [], keys
        while len(left):
            size = int(len(left) * cls.GAMMA) + 1
            slots = cls.slots(left, len(levels), size)
            alone = np.bincount(slots, minlength=size) == 1
            levels.append(alone)
            left = left[~alone[slots]]
        return cls(levels)

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """Of keys that were built in; of others -1 or anything."""
        out = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for level, (taken, before) in enumerate(zip(self.levels, self.before, strict=True)):
            slots = self.slots(keys[open_], level, len(taken))
            hit = taken[slots]
            out[open_[hit]] = before[slots[hit]]
            open_ = open_[~hit]
        return out


def fingerprints(keys: np.ndarray) -> np.ndarray:
    """32 bits of a key, by which most strangers are told."""
    return (mix(keys ^ np.uint64(0xA5A5A5A5A5A5A5A5)) >> np.uint64(32)).astype(np.uint32)


class ShardWriter:
    """Documents in key order to one file, under a name of its own until it is whole,
    so that a task that fails or runs twice leaves one whole shard or none. Ids go
    to the file as they come; only 16 bytes a document are held for the index."""

    def __init__(self, folder: str, shard: int, kind: np.dtype):
        self.files, base = pa.fs.FileSystem.from_uri(folder)
        self.files.create_dir(base, recursive=True)
        self.path = f"{base}/shard-{shard:08d}.ids"
        self.part = f"{base}/_part-{shard:08d}-{uuid.uuid4().hex}"
        self.out = self.files.open_output_stream(self.part)
        self.out.write(MAGIC)
        self.kind, self.keys, self.lengths = np.dtype(kind), [], []

    def add(self, key: int | None, ids: np.ndarray) -> None:
        self.out.write(ids.astype(self.kind.newbyteorder("<")).tobytes())
        self.keys.append(key)
        self.lengths.append(len(ids))

    def close(self) -> tuple[int, int]:
        """Documents and ids written."""
        nulls = sum(k is None for k in self.keys)
        keys = np.array([k for k in self.keys if k is not None], np.int64).view(np.uint64)
        starts = np.append(0, np.cumsum(self.lengths)).astype(np.uint64)
        # Equal keys follow each other; the index leads to the first.
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
        index = PerfectHash.build(keys[first])
        numbers = index.numbers(keys[first])
        documents, prints = np.zeros(len(first), np.uint32), np.zeros(len(first), np.uint32)
        documents[numbers] = nulls + first
        prints[numbers] = fingerprints(keys[first])
        arrays = {
            "keys": keys, "starts": starts, "documents": documents, "fingerprints": prints,
            "levels": np.packbits(np.concatenate(index.levels)) if index.levels else np.zeros(0, np.uint8),
        }
        at = len(MAGIC) + int(starts[-1]) * self.kind.itemsize
        footer: dict = {"kind": self.kind.str, "nulls": nulls, "levels_of": [len(x) for x in index.levels], "arrays": {}}
        for name, values in arrays.items():
            raw = values.tobytes()
            footer["arrays"][name] = [values.dtype.str, at, len(raw)]
            self.out.write(raw)
            at += len(raw)
        text = json.dumps(footer).encode()
        self.out.write(text + len(text).to_bytes(8, "little") + MAGIC)
        self.out.close()
        self.files.move(self.part, self.path)
        return len(self.keys), int(starts[-1])


class ShardReader:
    def __init__(self, files: pa.fs.FileSystem, path: str):
        self.file = files.open_input_file(path)
        size = self.file.size()
        tail = self._bytes(size - len(MAGIC) - 8, len(MAGIC) + 8)
        if tail[8:] != MAGIC or self._bytes(0, len(MAGIC)) != MAGIC:
            raise ValueError(f"{path} is not a whole shard")
        length = int.from_bytes(tail[:8], "little")
        footer = json.loads(self._bytes(size - len(MAGIC) - 8 - length, length))
        self.kind, self.nulls = np.dtype(footer["kind"]), footer["nulls"]
        array = {n: np.frombuffer(self._bytes(at, k), kind) for n, (kind, at, k) in footer["arrays"].items()}
        self.keys, self.starts = array["keys"], array["starts"].astype(np.int64)
        self.documents, self.prints = array["documents"].astype(np.int64), array["fingerprints"]
        bits = np.unpackbits(array["levels"])[: sum(footer["levels_of"])].astype(bool)
        self.index = PerfectHash(np.split(bits, np.cumsum(footer["levels_of"])[:-1]) if len(bits) else [])

    def _bytes(self, at: int, length: int) -> bytes:
        return self.file.read_at(length, at)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The first document of each key (unsigned view), -1 if the shard has none."""
        numbers = self.index.numbers(keys)
        known = numbers >= 0
        known[known] = self.prints[numbers[known]] == fingerprints(keys[known])
        out = np.where(known, self.documents[np.where(known, numbers, 0)] if len(self.documents) else -1, -1)
        # The fingerprint sorts out all but one in 2**32 strangers, the key the rest.
        own = out >= 0
        own[own] = self.keys[out[own] - self.nulls] == keys[own]
        return np.where(own, out, -1)

    def ids(self, document: int) -> np.ndarray:
        begin, end = self.starts[document], self.starts[document + 1]
        raw = self._bytes(len(MAGIC) + int(begin) * self.kind.itemsize, int(end - begin) * self.kind.itemsize)
        return np.frombuffer(raw, self.kind)

    def close(self) -> None:
        self.file.close()


def write_shards(docs: DataFrame, tokenizer: str, folder: str) -> DataFrame:
    """Shards in ascending ``doc_id`` order, and their manifest: ``shard``, ``path``,
    ``n_docs``, ``n_tokens``, ``first_key`` and ``last_key`` (null if all are).

    Texts are shuffled once, by ranges, and encoded where they are written, as the
    tokenizers library would encode them (short plain words are merged here, all else
    by the library itself); each range is one shard and each task holds only its index.
    Documents with a null ``doc_id`` come first. Those with equal ones follow each other
    by the beginning and then by a hash of their texts, and may go on in the next shard,
    so that a key with very many is shared by tasks; only copies of one document, key and
    text, stay together. Null and empty texts are the end id alone; an empty table has no
    shards.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, shard, out = encoder(tokenizer), TaskContext.get().partitionId(), None
        first = last = None
        kind = np.uint16 if of.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        for keys, texts in read(batches):
            out = out or ShardWriter(folder, shard, kind)
            for key, ids in zip(keys, of.encode(texts), strict=True):
                out.add(key, np.append(ids, END_ID))
                first, last = (key if first is None else first), key
        if out:
            n_docs, n_tokens = out.close()
            row = [[shard], [out.path], [n_docs], [n_tokens], [first], [last]]
            kinds = [pa.int64(), pa.string(), *[pa.int64()] * 4]
            names = [column.split()[0] for column in MANIFEST.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, kinds, strict=True)], names=names)

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    order = (F.col("doc_id"), F.substring("text", 1, ORDERED_BY), F.xxhash64("text"))
    ordered = slim.repartitionByRange(*order).sortWithinPartitions(*order, "text")
    return stored(ordered.mapInArrow(run, MANIFEST), "manifest")


def read_documents(manifest: DataFrame, folder: str) -> DataFrame:
    """Every document of the shards: ``doc_id``, ``start`` (ids of all documents
    before it), ``n_tokens``, ``ids_crc32`` (of the ids as little-endian unsigned
    32-bit integers), each found by its key through its shard's index.

    The running sum goes over the shards, a row each, not over documents.
    """
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    based = manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, _ = pa.fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                shard = ShardReader(files, path)
                keys = [None] * shard.nulls + shard.keys.view(np.int64).tolist()
                # Documents with a null key have no entry and are taken by position;
                # of equal keys the index gives the first, the others come after it.
                at = np.append(np.arange(shard.nulls), shard.find(shard.keys))
                later = np.append(np.zeros(shard.nulls, np.int64), repeats(shard.keys))
                for begin in range(0, len(keys), 10_000):
                    some = (at + later)[begin : begin + 10_000].tolist()
                    ids = [shard.ids(k) for k in some]
                    columns = [
                        keys[begin : begin + 10_000],
                        [base + int(shard.starts[k]) for k in some],
                        [len(x) for x in ids],
                        [zlib.crc32(x.astype("<u4").tobytes()) for x in ids],
                    ]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=NAMES)
                shard.close()

    shards = max(1, manifest.count())
    spread = based.select("path", "base").repartition(shards)
    return spread.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


NAMES = ["doc_id", "start", "n_tokens", "ids_crc32"]


def repeats(keys: np.ndarray) -> np.ndarray:
    """How many equal keys stand directly before each."""
    if not len(keys):
        return np.zeros(0, np.int64)
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return ranges(np.zeros(len(first), np.int64), np.diff(np.append(first, len(keys))))


def fetch(folder: str, path: str, keys: list[int]) -> dict[int, list[np.ndarray]]:
    """The ids of the documents with the given keys in one shard, by key; keys the
    shard lacks are left out."""
    files, _ = pa.fs.FileSystem.from_uri(folder)
    shard = ShardReader(files, path)
    wanted = np.array(keys, np.int64).view(np.uint64)
    found: dict[int, list[np.ndarray]] = {}
    for key, document in zip(keys, shard.find(wanted).tolist(), strict=True):
        own = np.uint64(np.int64(key).view(np.uint64))
        while document >= 0 and document - shard.nulls < len(shard.keys) and shard.keys[document - shard.nulls] == own:
            found.setdefault(key, []).append(shard.ids(document))
            document += 1
    shard.close()
    return found


def lookup_documents(manifest: DataFrame, folder: str, keys: DataFrame, key: str = "doc_id") -> DataFrame:
    """``doc_id`` and ``ids`` of all documents with the given keys, wherever they are; a
    key that no document has, and a null one, gives no row, a repeated key counts once.

    The shards' first and last keys, two numbers a shard, say which shards a key can be
    in. Keys are dealt to them, and a task reads of its shards the index and the ids it
    was asked for.
    """
    bounds = manifest.filter("last_key IS NOT NULL").select("first_key", "last_key", "path").orderBy("first_key", "shard").collect()
    first = np.array([b["first_key"] for b in bounds], np.int64)
    last = np.array([b["last_key"] for b in bounds], np.int64)
    paths = np.array([b["path"] for b in bounds], object)

    def dealt(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column(0).to_numpy()
            # Shards are in order, so those that can hold a key follow each other.
            begin, end = np.searchsorted(last, wanted, "left"), np.searchsorted(first, wanted, "right")
            lengths = np.maximum(0, end - begin)
            chosen = paths[ranges(begin, lengths)] if len(paths) else []
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(wanted, lengths), pa.int64()), pa.array(list(chosen), pa.string())], names=["doc_id", "path"]
            )

    def read_(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [x.to_pylist() for x in batch.columns]
            at = np.flatnonzero([True, *(a != b for a, b in zip(columns[1], columns[1][1:], strict=False))]) if columns[1] else []
            for begin, end in zip(at, [*at[1:], len(columns[1])], strict=True):
                found = fetch(folder, columns[1][begin], columns[0][begin:end])
                pairs = [(k, ids) for k, several in found.items() for ids in several]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k for k, _ in pairs], pa.int64()), pa.array([i.astype(np.int64) for _, i in pairs], pa.list_(pa.int64()))],
                    names=["doc_id", "ids"],
                )

    asked = keys.select(F.col(key).cast("long").alias("doc_id")).dropna().distinct()
    placed = asked.mapInArrow(dealt, "doc_id long, path string").repartition("path").sortWithinPartitions("path", "doc_id")
    return placed.mapInArrow(read_, "doc_id long, ids array<long>")
