"""Byte-level BPE by a lazily determinised transducer, and streaming UTF-8 decoding."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollbook.llm.tokens import OTHER_SPACE
from tollbook.llm.words import PIECE, Memory, cut, read

#: Above all ranks.
NEVER = 1 << 60
#: Words remembered in a Python worker at most, besides the transducer's states.
REMEMBERED = 500_000
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Transducer:
    """Bytes in, token ids out, as merging by rank would give them.

    A prefix of the input has one encoding, and it extends the encoding of some
    shorter prefix by one token that may follow that prefix's last token. A
    configuration is a place where the next token may begin: the bytes since
    then, the last token before it, and the tokens not yet emitted. A state is
    the set of configurations whose bytes may still grow into a token; what all of
    them agree on is emitted, so a token waits for no more bytes than the longest
    token has. States and transitions are made when first met; past
    ``max_states`` they are dropped and made anew.
    """

    START = (b"", ((0, -1, ()),))

    def __init__(self, ranks: dict[bytes, int], max_states: int = 200_000):
        self.ranks, self.max_states = ranks, max_states
        self.bytes_of = {r: t for t, r in ranks.items()}
        self.prefixes = {t[:k] for t in ranks for k in range(1, len(t))}
        self.follows: dict[int, bool] = {}
        self.spines: dict[tuple[int, int], list[tuple[bytes, int]]] = {}
        self._reset()

    def _reset(self) -> None:
        self.numbers = {self.START: 0}
        self.states = [self.START]
        self.moves: list[dict[int, tuple[int, tuple[int, ...]]]] = [{}]

    def _spine(self, token: int, side: int) -> list[tuple[bytes, int]]:
        """The parts that make up a token's left (0) or right (1) edge while it is
        merged, each with the rank at which it goes up into the next, the token
        itself last; empty if merging its bytes gives something else."""
        key = (token, side)
        if key not in self.spines:
            whole = self.bytes_of[token]
            parts = [whole[k : k + 1] for k in range(len(whole))]
            edge = [parts[-side]]
            ranks: list[int] = []
            while len(parts) > 1:
                best = min(range(len(parts) - 1), key=lambda k: self.ranks.get(parts[k] + parts[k + 1], NEVER))
                rank = self.ranks.get(parts[best] + parts[best + 1], NEVER)
                if rank == NEVER:
                    break
                parts[best : best + 2] = [parts[best] + parts[best + 1]]
                if parts[-side] != edge[-1]:
                    edge.append(parts[-side])
                    ranks.append(rank)
            ranks.append(NEVER)
            self.spines[key] = list(zip(edge, ranks, strict=True)) if len(parts) == 1 else []
        return self.spines[key]

    def may_follow(self, left: int, right: int) -> bool:
        """Whether merging leaves these two tokens, side by side, as they are: while
        both are built, no part at the one's end may merge with the part then at the
        other's beginning before one of them has gone up. Of equal ranks the merge
        further left comes first."""
        if left < 0:
            return bool(self._spine(right, 0))
        key = left << 32 | right
        known = self.follows.get(key)
        if known is None:
            if len(self.follows) > 1_000_000:
                self.follows.clear()
            known = self.follows[key] = self._apart(self._spine(left, 1), self._spine(right, 0))
        return known

    def _apart(self, ends: list[tuple[bytes, int]], begins: list[tuple[bytes, int]]) -> bool:
        if not ends or not begins:
            return False
        a = b = 0
        while True:
            (end, end_up), (begin, begin_up) = ends[a], begins[b]
            across = self.ranks.get(end + begin, NEVER)
            if across < end_up and across <= begin_up and across != NEVER:
                return False
            if end_up == begin_up == NEVER:
                return True
            if end_up <= begin_up:
                a += 1
            else:
                b += 1

    def _move(self, number: int, byte: int) -> tuple[int, tuple[int, ...]]:
        tail, places = self.states[number]
        tail += bytes((byte,))
        for begin, last, waiting in places:
            token = self.ranks.get(tail[begin:])
            if token is not None and self.may_follow(last, token):
                here = (len(tail), token, (*waiting, token))
                break
        else:
            raise ValueError(f"byte {byte} has no token")
        alive = [p for p in places if tail[p[0] :] in self.prefixes]
        alive.append(here)
        sure = alive[0][2]
        for _, _, waiting in alive[1:]:
            same = 0
            while same < min(len(sure), len(waiting)) and sure[same] == waiting[same]:
                same += 1
            sure = sure[:same]
        base = min(p[0] for p in alive)
        state = (tail[base:], tuple((b - base, last, waiting[len(sure) :]) for b, last, waiting in alive))
        target = self.numbers.get(state)
        if target is None:
            target = self.numbers[state] = len(self.states)
            self.states.append(state)
            self.moves.append({})
        self.moves[number][byte] = (target, sure)
        return target, sure

    def encode(self, piece: bytes) -> list[int]:
        """The ids of one match of the splitting pattern; a match that is a token
        itself is that token, reachable by merges or not."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(self.states) > self.max_states:
            self._reset()
        out, number, moves = [], 0, self.moves
        for byte in piece:
            number, sure = moves[number].get(byte) or self._move(number, byte)
            if sure:
                out += sure
        out += self.states[number][1][-1][2]
        return out


class Utf8Machine:
    """Incremental UTF-8: takes bytes as they come, gives the characters complete so
    far; a sequence that cannot be completed gives U+FFFD and starts anew."""

    def __init__(self):
        self.need, self.low, self.high, self.held = 0, 0x80, 0xBF, bytearray()

    def push(self, data: bytes) -> str:
        out = []
        for byte in data:
            if self.need:
                if self.low <= byte <= self.high:
                    self.held.append(byte)
                    self.need, self.low, self.high = self.need - 1, 0x80, 0xBF
                    if not self.need:
                        out.append(chr(self._point()))
                        self.held.clear()
                    continue
                out.append("\ufffd")
                self.need, self.low, self.high = 0, 0x80, 0xBF
                self.held.clear()
            if byte < 0x80:
                out.append(chr(byte))
            elif 0xC2 <= byte <= 0xF4:
                self.need = 1 + (byte >= 0xE0) + (byte >= 0xF0)
                # No overlong forms, no surrogates, nothing past U+10FFFF.
                self.low = {0xE0: 0xA0, 0xF0: 0x90}.get(byte, 0x80)
                self.high = {0xED: 0x9F, 0xF4: 0x8F}.get(byte, 0xBF)
                self.held.append(byte)
            else:
                out.append("\ufffd")
        return "".join(out)

    def _point(self) -> int:
        point = self.held[0] & (0x1F, 0x0F, 0x07)[len(self.held) - 2]
        for byte in self.held[1:]:
            point = point << 6 | byte & 0x3F
        return point

    def finish(self) -> str:
        cut, self.need = bool(self.need), 0
        self.held.clear()
        return "\ufffd" * cut

    @property
    def between(self) -> bool:
        """Between two characters."""
        return not self.need


class Decoder:
    """Ids to text. A token that is whole characters is looked up; only others, and
    what follows them up to the next character's end, step through the machine."""

    def __init__(self, ranks: dict[bytes, int]):
        size = max(ranks.values(), default=-1) + 1
        self.bytes_of: list[bytes] = [b""] * size
        self.text_of: list[str] = [""] * size
        self.whole = np.zeros(size, bool)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
            machine = Utf8Machine()
            text = machine.push(token)
            if machine.between and "\ufffd" not in text:
                self.text_of[rank], self.whole[rank] = text, True

    def decode(self, ids: np.ndarray) -> str:
        whole, text_of = self.whole[ids], self.text_of
        if whole.all():
            return "".join(map(text_of.__getitem__, ids.tolist()))
        out, machine = [], Utf8Machine()
        for token, is_whole in zip(ids.tolist(), whole.tolist(), strict=True):
            out.append(text_of[token] if is_whole and machine.between else machine.push(self.bytes_of[token]))
        return "".join(out) + machine.finish()


class Codec:
    """Both directions for one rank file and splitting pattern.

    Words repeat, so the ids of a word with its space are remembered; that needs
    white space that the pattern cuts at, texts with other white space go whole.
    """

    def __init__(self, path: str, pattern: str):
        self.ranks = read_ranks(path)
        self.transducer, self.decoder = Transducer(self.ranks), Decoder(self.ranks)
        self.split = regex.compile(pattern)
        self.digits = [str(k) for k in range(max(self.ranks.values(), default=0) + 1)]
        self.memory = Memory(self._encode, REMEMBERED, spaced=True)

    def _ids(self, text: str) -> list[int]:
        ids: list[int] = []
        for piece in self.split.findall(text):
            ids += self.transducer.encode(piece.encode())
        return ids

    def _encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        ids, counts = [], []
        for word in words:
            found = self._ids(word.decode())
            ids += found
            counts.append(len(found))
        return np.array(ids, np.int32), np.array(counts, np.int64)

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """Of each text; very long ones go in pieces cut between words."""
        decoded = [t.decode() for t in texts]
        odd = [bool(OTHER_SPACE.search(t)) for t in decoded]
        pieces = [
            (k, p) for k, t in enumerate(texts) if not odd[k] for p in (cut(t) if len(t) > PIECE else (t,))
        ]
        ids, counts = self.memory.ids_of([p for _, p in pieces])
        out: list[list[np.ndarray]] = [[] for _ in texts]
        for (k, _), part in zip(pieces, np.split(ids, np.cumsum(counts)[:-1]), strict=bool(pieces)):
            out[k].append(part)
        for k, is_odd in enumerate(odd):
            if is_odd:
                out[k].append(np.array(self._ids(decoded[k]), np.int32))
        return [x[0] if len(x) == 1 else np.concatenate(x) for x in out]


_CODECS: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = Codec(path, pattern)
    return _CODECS[path, pattern]


def encode_documents(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """``doc_id``, ``ids`` (array of int) and ``text`` decoded from them.

    One narrow pass: each text is encoded and decoded whole in the task that reads
    it. Null and empty texts have no ids and decode to the empty text. Rows are
    independent, so null or repeated ``doc_id`` and other columns do not matter.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = codec(ranks, pattern)
        for doc_ids, texts in read(batches):
            ids = both.encode(texts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(doc_ids, pa.int64()),
                    pa.array(ids, pa.list_(pa.int32())),
                    pa.array([both.decoder.decode(x) for x in ids], pa.string()),
                ],
                names=["doc_id", "ids", "text"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, ids array<int>, text string"
    )


def digests(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """Per document the number of ids and digests of the ids and of the decoded
    bytes, taken where the ids are made so that they need not leave the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = codec(ranks, pattern)
        for doc_ids, texts in read(batches):
            counts, of_ids, of_text = [], [], []
            for ids in both.encode(texts):
                counts.append(len(ids))
                of_ids.append(sha256(",".join(map(both.digits.__getitem__, ids.tolist())).encode()))
                of_text.append(sha256(both.decoder.decode(ids).encode()))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(doc_ids, pa.int64()), pa.array(counts, pa.int64()),
                    pa.array(of_ids, pa.string()), pa.array(of_text, pa.string()),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, SCHEMA)


def sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
