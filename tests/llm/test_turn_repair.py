import hashlib
import itertools
import random
import re
import zlib

import pytest

import compare
from tollbook.llm import queries, turn_repair

FORM = re.compile("(s?(ua)+)?")
FAULTS = ("", "", "", "blank", "duplicate", "truncated")


def by_trying(rows):
    """Every string of edits with at most two inserts between rows."""
    inserts = [x for n in range(3) for x in itertools.product("ua", repeat=n)]
    best = None
    for edits in itertools.product("KRD", repeat=len(rows)):
        if any(f in ("blank", "duplicate") and e != "D" for e, (_, f) in zip(edits, rows, strict=True)):
            continue
        cost = sum({"K": 0, "R": 1, "D": 2}[e] + 5 * (f == "truncated" and e != "D") for e, (_, f) in zip(edits, rows, strict=True))
        if best and cost > best[0]:
            continue
        for put in itertools.product(inserts, repeat=len(rows) + 1):
            whole = cost + 5 * sum(map(len, put))
            if best and whole > best[0]:
                continue
            for roles in itertools.product("ua", repeat=edits.count("R")):
                roles, form, audit = iter(roles), "", ""
                for k in range(len(rows) + 1):
                    form, audit = form + "".join(put[k]), audit + "I" * len(put[k])
                    if k < len(rows):
                        audit += edits[k]
                        form += {"K": rows[k][0] or "?", "D": ""}[edits[k]] if edits[k] != "R" else next(roles)
                if FORM.fullmatch(form):
                    best = min(best or (whole, audit), (whole, audit))
    return best


def by_table(rows):
    """The least (cost, audit) of every state, row by row."""
    steps = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    best = {"": (0, "")}

    def inserted(labels):
        for _ in range(3):
            for state, (cost, audit) in list(labels.items()):
                for role, then in steps[state].items():
                    if role in "ua":
                        label = (cost + 5, audit + "I")
                        labels[then] = min(label, labels.get(then, label))
        return labels

    for initial, fault in rows:
        found = {}
        for state, (cost, audit) in inserted(best).items():
            moves = [(cost + 2, audit + "D", state)]
            if fault not in ("blank", "duplicate"):
                more = 5 * (fault == "truncated")
                moves += [(cost + more + 1, audit + "R", then) for role, then in steps[state].items() if role in "ua"]
                moves += [(cost + more, audit + "K", then) for role, then in steps[state].items() if role == initial]
            for c, a, then in moves:
                found[then] = min((c, a), found.get(then, (c, a)))
        best = found
    return min(label for state, label in inserted(best).items() if state in ("", "a"))


def random_rows(rng, count):
    return [(rng.choice("ssuuuaaa?") if rng.random() < 0.95 else "", rng.choice(FAULTS)) for _ in range(count)]


def test_repair_by_trying_all_edits():
    rng = random.Random(1)
    for size in (0, 1, 2, 2, 3, 3, 3):
        for _ in range(6):
            rows = random_rows(rng, size)
            assert turn_repair.repair(rows) == by_trying(rows) == by_table(rows), rows


@pytest.mark.parametrize("block", [1, 3, 512])
def test_repair_of_any_length_and_in_blocks(monkeypatch, block):
    monkeypatch.setattr(turn_repair, "BLOCK", block)
    rng = random.Random(block)
    for _ in range(150):
        rows = random_rows(rng, rng.randint(0, 30))
        assert turn_repair.repair(rows) == by_table(rows), rows


def test_a_long_conversation():
    rows = random_rows(random.Random(7), 3000)
    assert turn_repair.repair(rows) == by_table(rows)


def by_definition(rows):
    """From (conv_id, turn, role, text) to the result's rows."""
    found = {}
    for conv_id, turn, role, text in rows:
        lot = found.setdefault(conv_id, [])
        key = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(key.encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        lot += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = []
    for conv_id, lot in found.items():
        lot.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        coded, seen = [], set()
        for _, role, text in lot:
            bare = re.sub(r"[\x20\x09-\x0D]", "", text)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated"
            seen.add((role, text))
            coded.append((role[:1], fault))
        cost, audit = by_table([(i if i in ("s", "u", "a") else "?", f) for i, f in coded])
        kept, state, at = [], "", iter(lot)
        for letter in audit:
            role, text = ("", "") if letter == "I" else next(at)[1:]
            if letter != "D":
                state = "s" if letter == "K" and role[:1] == "s" else "a" if state == "u" else "u"
                kept.append(f"{role if letter == 'K' else {'u': 'user', 'a': 'assistant'}[state]}:{text}")
        turns = [t for t, _, _ in lot if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in itertools.pairwise(coded))
        faults = [f for _, f in coded]
        out.append(
            (conv_id, gaps, *map(faults.count, ("blank", "duplicate", "truncated")), illegal, cost, audit,
             hashlib.sha256("\n".join(kept).encode()).hexdigest())
        )
    return sorted(out, key=str)


def table_of(spark, rows):
    schema = "conv_id long, turn long, role string, text string, gone string, fault string, kind int, copy int"
    return spark.createDataFrame([(*r, "x", "x", 1, 1) for r in rows], schema)


def test_any_table(spark, monkeypatch):
    rng = random.Random(3)
    roles = ("user", "assistant", "system", "s", "tool", "", None)
    said = ("Yes.", "No!", "cut off", "", " \n", None, "ends. ", "é?", "\xa0", "a.b", "...")
    rows = [
        (rng.choice([*range(12), None]), rng.choice([*range(9), None]), rng.choice(roles), rng.choice(said)) for _ in range(400)
    ]
    rows += [(50, k, ("user", "assistant")[k % 2], "word " * 2000 + ".") for k in range(700)]
    monkeypatch.setattr(turn_repair, "HELD", 1 << 16)
    found = turn_repair.repair_conversations(table_of(spark, rows))
    assert sorted(map(tuple, found.collect()), key=str) == by_definition(rows)
    assert turn_repair.repair_conversations(table_of(spark, [])).count() == 0


def test_dropped_conversations_stay(spark):
    dropped = [(c, 0, "user", "Hi.") for c in range(400) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    found = turn_repair.repair_conversations(table_of(spark, dropped)).collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert dropped and sorted(map(tuple, found)) == [(c, 0, 0, 0, 0, 0, 0, "", empty) for c, *_ in dropped]


def test_rows_beyond_memory_are_read_back_in_order(monkeypatch):
    monkeypatch.setattr(turn_repair, "HELD", 100)
    spool = turn_repair.Spool()
    rows = [("user", str(k) * (k % 50)) for k in range(500)]
    for row in rows:
        spool.add(*row)
    assert list(spool) == rows


def test_query_over_a_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = compare.connect(folder).execute("select conv_id, turn, role, text from conversations").fetchall()
    found = queries.QUERIES["op11_turn_repair"](spark, folder)
    assert sorted(map(tuple, found.collect()), key=str) == by_definition(rows)


def test_one_shuffle(spark):
    plan = turn_repair.repair_conversations(table_of(spark, [(1, 1, "user", "x")]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
