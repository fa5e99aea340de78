"""Cost-balanced packing of token ids into sequences of bounded length."""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollbook.llm.tokens import encoder
from tollbook.llm.words import read

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, sequence_length long"
)
END_ID = 1
#: Attention cost of a piece of p tokens: LINEAR * p + QUADRATIC * p * p.
LINEAR, QUADRATIC = 1.0, 1.0 / 1024


def cost(tokens: int, linear: float = LINEAR, quadratic: float = QUADRATIC) -> float:
    """Feed-forward work grows with a piece's tokens, attention with their square."""
    return linear * tokens + quadratic * tokens * tokens


def assign(
    lengths: list[int], capacity: int, linear: float = LINEAR, quadratic: float = QUADRATIC
) -> list[tuple[int, int, int, int, int]]:
    """Pieces ``(document, start, length, sequence, offset)`` of the documents.

    Whole runs of ``capacity`` tokens are sequences of their own. What is left of
    the documents goes, by descending cost, each to the sequence of lowest cost
    that has room; a document that finds too little room is cut and its rest goes
    to the next such sequence. There are as many sequences as the tokens fill; the
    rest, less than ``capacity`` and made of the shortest documents, goes to
    sequences as long as the powers of two it consists of, so nothing is padded.
    """
    pieces, rests, sequence = [], [], 0
    for document, length in enumerate(lengths):
        full = length // capacity
        for k in range(full):
            pieces.append((document, k * capacity, capacity, sequence, 0))
            sequence += 1
        if length > full * capacity:
            rests.append((document, full * capacity, length - full * capacity))
    total = sum(r[2] for r in rests)
    whole, tail = divmod(total, capacity)
    rooms = [capacity] * whole
    tails = [1 << k for k in reversed(range(tail.bit_length())) if tail >> k & 1]
    heap = [(0.0, sequence + k) for k in range(whole)]
    used = [0] * (whole + len(tails))
    rooms += tails
    at_tail = whole
    for document, start, length in sorted(rests, key=lambda r: (-cost(r[2], linear, quadratic), r[0])):
        while length:
            if heap:
                so_far, target = heapq.heappop(heap)
            else:
                so_far, target = 0.0, sequence + at_tail
            k = target - sequence
            taken = min(length, rooms[k] - used[k])
            pieces.append((document, start, taken, target, used[k]))
            used[k] += taken
            start, length = start + taken, length - taken
            if k < whole:
                if used[k] < rooms[k]:
                    heapq.heappush(heap, (so_far + cost(taken, linear, quadratic), target))
            elif used[k] == rooms[k]:
                at_tail += 1
    return pieces


def pack(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = 2048,
    tokens_at_once: int = 2_000_000,
    linear: float = LINEAR,
    quadratic: float = QUADRATIC,
) -> DataFrame:
    """Every document's ids, with an end id, in sequences of at most ``capacity``.

    A task packs its own documents, ``tokens_at_once`` at a time (at least one
    document), so nothing is shuffled, memory is bounded and a repeated task gives
    the same rows; each such group holds about a thousand sequences to balance.
    ``sequence_id`` holds the partition in its upper bits; ``sequence_length`` is a
    sequence's tokens. A null or empty text is the end id alone; documents are
    taken as they come, so equal or null ``doc_id`` are packed one by one; other
    columns are ignored; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer_ = encoder(tokenizer)
        first = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 40
        held: list[tuple[int | None, np.ndarray]] = []
        tokens = 0

        def packed() -> pa.RecordBatch:
            nonlocal first, held, tokens
            pieces = assign([len(ids) for _, ids in held], capacity, linear, quadratic)
            sizes: dict[int, int] = {}
            for _, _, length, sequence, _ in pieces:
                sizes[sequence] = sizes.get(sequence, 0) + length
            rows = [
                (
                    held[d][0], start, length, zlib.crc32(held[d][1][start : start + length].tobytes()),
                    len(held[d][1]), first + sequence, offset, sizes[sequence],
                )
                for d, start, length, sequence, offset in pieces
            ]
            first += len(sizes)
            held, tokens = [], 0
            columns = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=NAMES)

        for doc_ids, texts in read(batches):
            for doc_id, ids in zip(doc_ids, tokenizer_.encode(texts), strict=True):
                held.append((doc_id, np.append(ids, END_ID).astype("<u4")))
                tokens += len(ids) + 1
                if tokens >= tokens_at_once:
                    yield packed()
        if held:
            yield packed()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, SCHEMA)


NAMES = [c.split()[0] for c in SCHEMA.split(", ")]
