"""Repair of conversations whose turns were lost, emptied, cut, repeated or given to the
wrong role: the cheapest edits to an alternating form, by bidirectional Dijkstra.

The lattice has a node for each (rows read, state), where the state says what the roles
kept so far end with. Keep, Rerole and Delete read a row, Insert reads none; as the form
leaves one choice of role in each state, an audit (the edits' initials) names its path.
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Costs of the edits, and what a truncated row costs that is not deleted.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: States: nothing kept yet, and the last role kept. A conversation may end in two.
START, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (START, ASSISTANT)
#: Which state a user or assistant leads to, and the role's initial.
TURN = {START: (USER, "u"), SYSTEM: (USER, "u"), USER: (ASSISTANT, "a"), ASSISTANT: (USER, "u")}
ROLE = {USER: "user", ASSISTANT: "assistant"}
LEGAL = frozenset({"su", "ua", "au"})
#: Rows of a lattice that is searched at once; longer conversations are joined from such.
BLOCK = 512
#: Bytes of a conversation's rows held in memory; more go to the task's scratch file.
HELD = 16 << 20

SCHEMA = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, "
    "cost long, audit string, repaired_sha256 string"
)


class Lattice:
    """Rows, each an initial ("" for an empty role) and a fault ("", "blank",
    "duplicate" or "truncated")."""

    def __init__(self, rows: list[tuple[str, str]]):
        self.size = len(rows)
        self.onward: list[list[list[tuple[int, str, int, int]]]] = []
        self.back: list[list[list[tuple[int, str, int, int]]]] = [[[], [], [], []] for _ in range(self.size + 1)]
        for i in range(self.size + 1):
            at: list[list[tuple[int, str, int, int]]] = []
            for state in range(4):
                edges = [(INSERT, "I", i, TURN[state][0])]
                if i < self.size:
                    initial, fault = rows[i]
                    edges.append((DELETE, "D", i + 1, state))
                    if fault not in ("blank", "duplicate"):
                        more = TRUNCATED if fault == "truncated" else 0
                        then, wanted = TURN[state]
                        edges.append((REROLE + more, "R", i + 1, then))
                        if initial == wanted:
                            edges.append((KEEP + more, "K", i + 1, then))
                        if state == START and initial == "s":
                            edges.append((KEEP + more, "K", i + 1, SYSTEM))
                at.append(edges)
                for cost, letter, j, then in edges:
                    self.back[j][then].append((cost, letter, i, state))
            self.onward.append(at)

    def cheapest(self, state: int, ends: tuple[int, ...]) -> tuple[int, str] | None:
        """Least cost and, among the audits of that cost, the ASCII-least, from a state
        before the first row to one of ``ends`` after the last.

        The two heaps are worked off until their least costs add up to more than the
        best meeting, so all crossings of that cost are complete: every cheapest path
        has an edge from a node settled forward to one settled backward. Of one node's
        audits of equal cost none begins another, as that would return to the node at
        no cost; so a crossing's least audit is its least halves put together.
        """
        # Nodes of one cost are settled along the rows: only Keep is free, and it reads one.
        forward: list[tuple[int, int, int]] = [(0, 0, state)]
        backward: list[tuple[int, int, int]] = [(0, -self.size, end) for end in ends]
        before: dict[tuple[int, int], tuple[int, str]] = {(0, state): (0, "")}
        behind: dict[tuple[int, int], tuple[int, str]] = {(self.size, end): (0, "") for end in ends}
        settled: set[tuple[int, int]] = set()
        returned: set[tuple[int, int]] = set()
        best = 0 if (0, state) in behind else None
        while forward and backward and (best is None or forward[0][0] + backward[0][0] <= best):
            if forward[0][0] <= backward[0][0]:
                cost, i, here = heapq.heappop(forward)
                if (i, here) in settled:
                    continue
                settled.add((i, here))
                audit = before[i, here][1]
                for more, letter, j, then in self.onward[i][here]:
                    label = (cost + more, audit + letter)
                    node = (j, then)
                    if node not in before or label < before[node]:
                        before[node] = label
                        heapq.heappush(forward, (label[0], j, then))
                    if node in behind and (best is None or label[0] + behind[node][0] < best):
                        best = label[0] + behind[node][0]
            else:
                cost, minus, here = heapq.heappop(backward)
                node_here = (-minus, here)
                if node_here in returned:
                    continue
                returned.add(node_here)
                audit = behind[node_here][1]
                for more, letter, j, then in self.back[-minus][here]:
                    label = (cost + more, letter + audit)
                    node = (j, then)
                    if node not in behind or label < behind[node]:
                        behind[node] = label
                        heapq.heappush(backward, (label[0], -j, then))
                    if node in before and (best is None or label[0] + before[node][0] < best):
                        best = label[0] + before[node][0]
        found: str | None = None
        for i, here in settled:
            cost, audit = before[i, here]
            meetings = [(0, "", i, here), *self.onward[i][here]]
            for more, letter, j, then in meetings:
                final = (j, then) in returned or j == self.size and then in ends
                if final and cost + more + behind[j, then][0] == best:
                    whole = audit + letter + behind[j, then][1]
                    if found is None or whole < found:
                        found = whole
        return None if best is None or found is None else (best, found)


def repair(rows: list[tuple[str, str]]) -> tuple[int, str]:
    """Cost and audit of a conversation: of one lattice, or of the least joins of blocks
    from each state to each other one."""
    if len(rows) <= BLOCK:
        return Lattice(rows).cheapest(START, ENDS)
    reached: dict[int, tuple[int, str]] = {START: (0, "")}
    for begin in range(0, len(rows), BLOCK):
        lattice = Lattice(rows[begin : begin + BLOCK])
        ends = range(4) if begin + BLOCK < len(rows) else ENDS
        then: dict[int, tuple[int, str]] = {}
        for state, (cost, audit) in reached.items():
            for end in ends:
                part = lattice.cheapest(state, (end,))
                if part is not None:
                    label = (cost + part[0], audit + part[1])
                    then[end] = min(label, then.get(end, label))
        reached = then
    return min(reached.values())


class Spool:
    """Rows in order: in memory up to HELD bytes, the others in a scratch file."""

    def __init__(self) -> None:
        self.rows: list[tuple[str, str]] = []
        self.bytes, self.file = 0, None

    def add(self, role: str, text: str) -> None:
        self.rows.append((role, text))
        self.bytes += len(role) + len(text)
        if self.bytes > HELD:
            self.file = self.file or tempfile.TemporaryFile()
            pickle.dump(self.rows, self.file)
            self.rows, self.bytes = [], 0

    def __iter__(self) -> Iterator[tuple[str, str]]:
        if self.file:
            end = self.file.tell()
            self.file.seek(0)
            while self.file.tell() < end:
                yield from pickle.load(self.file)
        yield from self.rows


def repaired(rows: Iterator[tuple[str, str]], audit: str) -> Iterator[tuple[str, str]]:
    """Roles and texts after the edits."""
    state = START
    rows = iter(rows)
    for letter in audit:
        if letter == "D":
            next(rows)
            continue
        role, text = ("", "") if letter == "I" else next(rows)
        state = SYSTEM if letter == "K" and state == START and role[:1] == "s" else TURN[state][0]
        yield (role if letter == "K" else ROLE[state]), text


def damaged(rows: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``role`` and ``text`` after the damage, with ``gone`` for
    dropped rows, which stay so that their conversations do. Nulls are one space in the
    damage's key, as a role and as a text."""
    space = F.lit(" ")
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), space), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.crc32(key.cast("binary")) % 20
    slim = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), space).alias("role"),
        F.coalesce(F.col("text").cast("string"), space).alias("text"),
    ).withColumn("kind", kind)
    text = F.when(F.col("kind").isin(0, 1), "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    changed = slim.select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        (F.col("kind") == 0).alias("gone"),
        "kind",
    )
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return changed.select("*", copies.alias("copy")).drop("kind", "copy")


def fault_of(earlier: Column) -> Column:
    """The first fault of a row, of which ``earlier`` says that it repeats an earlier one."""
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    return (
        F.when(last == "", "blank").when(earlier, "duplicate").when(~last.isin(".", "!", "?"), "truncated").otherwise("")
    )


def repair_conversations(conversations: DataFrame) -> DataFrame:
    """One row per ``conv_id``: what was wrong after the damage, the cheapest repair's
    cost and audit, and a digest of the repaired turns.

    One shuffle by ``conv_id``. Sorting and the search for repeats spill; a task then
    streams through its conversations and holds a code for each row of one of them, with
    the texts beyond 16 MiB in a scratch file, since the digest chains a conversation's
    texts in order and can only be taken by one task. Other conversations of its
    partition are not held.

    Rows of equal turn are in the order of role and text. A null ``conv_id`` is a
    conversation of its own with a null key; a role's initial is its first character. An
    empty table gives an empty one; other columns do not matter.
    """
    rows = damaged(conversations).repartition("conv_id")
    # The shuffle by conv_id serves this window too; it only sorts.
    same = Window.partitionBy("conv_id", "gone", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    coded = rows.withColumn("fault", fault_of(F.row_number().over(same) > 1))
    placed = coded.select("conv_id", "turn", "role", "text", "gone", "fault").sortWithinPartitions(
        F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text"
    )
    return placed.mapInArrow(_run, SCHEMA)


class _Conversation:
    """Counts and rows of the conversation that a task is reading."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.spool = conv_id, Spool()
        self.codes: list[tuple[str, str]] = []
        self.low = self.last = None
        self.turns = self.illegal = 0

    def add(self, turn: int | None, role: str, text: str, fault: str) -> None:
        if turn is not None and turn != self.last:
            self.low = turn if self.low is None else self.low
            self.last = turn
            self.turns += 1
        initial = role[:1]
        if self.codes and self.codes[-1][0] + initial not in LEGAL:
            self.illegal += 1
        self.codes.append(_code(initial, fault))
        self.spool.add(role, text)

    def row(self) -> tuple:
        faults = [fault for _, fault in self.codes]
        cost, audit = repair(self.codes)
        digest = hashlib.sha256()
        mark = ""
        for role, text in repaired(self.spool, audit):
            digest.update(f"{mark}{role}:{text}".encode())
            mark = "\n"
        gaps = 0 if self.low is None else self.last - self.low + 1 - self.turns
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        return self.conv_id, gaps, *counts, self.illegal, cost, audit, digest.hexdigest()


_CODES: dict[tuple[str, str], tuple[str, str]] = {}


def _code(initial: str, fault: str) -> tuple[str, str]:
    """One shared pair, so that a row of a conversation costs a reference."""
    initial = initial if initial in ("s", "u", "a") else "" if not initial else "?"
    return _CODES.setdefault((initial, fault), (initial, fault))


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    current: _Conversation | None = None
    done: list[tuple] = []

    def out() -> pa.RecordBatch:
        columns = list(zip(*done, strict=True)) or [[]] * 9
        done.clear()
        kinds = [pa.int64()] * 7 + [pa.string()] * 2
        names = [field.split()[0] for field in SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    for batch in batches:
        for conv_id, turn, role, text, gone, fault in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if current is None or current.conv_id != conv_id:
                if current is not None:
                    done.append(current.row())
                current = _Conversation(conv_id)
            if not gone:
                current.add(turn, role, text, fault)
        if len(done) >= 1000:
            yield out()
    if current is not None:
        done.append(current.row())
    if done:
        yield out()
