"""Conversation repair against all edits, tried one by one."""

import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shiftloom.llm import turns

COLUMNS = "conv_id long, turn long, role string, text string"
GOOD = re.compile(r"(s?(ua)+)?")
BEGUN = re.compile(r"s?(ua)*u?")
SOLID = re.compile(r"[^\x20\x09-\x0D]")


def cheapest(rows):
    """(cost, audit, rows) of (role, text, fault) rows: all edits in the order of (cost, audit)."""
    heap = [(0, "", 0, "", ())]
    seen = set()
    while heap:
        cost, audit, i, shape, kept = heapq.heappop(heap)
        if i == len(rows) and GOOD.fullmatch(shape):
            return cost, audit, list(kept)
        if (i, shape) in seen or not BEGUN.fullmatch(shape):
            continue
        seen.add((i, shape))
        if len(shape) < len(rows) + 3:
            for role in ("user", "assistant"):
                heapq.heappush(heap, (cost + 5, audit + "I", i, shape + role[0], (*kept, (role, ""))))
        if i == len(rows):
            continue
        role, text, fault = rows[i]
        heapq.heappush(heap, (cost + 2, audit + "D", i + 1, shape, kept))
        if fault in ("blank", "duplicate"):
            continue
        more = 5 * (fault == "truncated")
        heapq.heappush(heap, (cost + more, audit + "K", i + 1, shape + (role[:1] or " "), (*kept, (role, text))))
        for new in ("user", "assistant"):
            heapq.heappush(heap, (cost + 1 + more, audit + "R", i + 1, shape + new[0], (*kept, (new, text))))


def plain(rows):
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        groups[conv] += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    out = []
    for conv, held in groups.items():
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, rows, faults = set(), [], []
        for _, role, text in held:
            solid = SOLID.findall(text)
            fault = "blank" if not solid else "duplicate" if (role, text) in seen else "" if solid[-1] in ".!?" else "truncated"
            seen.add((role, text))
            faults.append(fault)
            rows.append((role, text, fault))
        known = [t for t, _, _ in held if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(held, held[1:]))
        cost, audit, kept = cheapest(rows)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()
        out.append((conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest))
    return sorted(out, key=repr)


def found(spark, rows, schema=COLUMNS):
    conversations = spark.createDataFrame(rows, schema)
    out = turns.digests(turns.repaired(turns.damaged(conversations)))
    return sorted((tuple(r) for r in out.collect()), key=repr)


ROLE = ["user", "user", "assistant", "assistant", "system", "tool", "", None, "u", "summary"]
TEXT = ["a.", "b!", "c?", "e.", "f.", "no end", " ", "", None, "é. \n", "x ", "d.\t"]


def test_any_rows(spark):
    pick = random.Random(3)
    rows = []
    for conv in [None, *range(120)]:
        turn = [None, 0, 1, 2, 3, 5, 9] if conv is None or conv % 3 else range(9)
        rows += [(conv, pick.choice(turn), pick.choice(ROLE), pick.choice(TEXT)) for _ in range(pick.randrange(9))]
    assert found(spark, rows) == plain(rows)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("usat "), st.integers(0, 3)), max_size=9))
def test_survivors_give_the_cheapest_and_first_edits(rows):
    names = ["", "blank", "duplicate", "truncated"]
    one = turns.Survivors()
    for initial, fault in rows:
        one.row(initial, fault)
    cost = one.end()
    assert (cost, one.final.decode()) == cheapest([(i, "", names[f]) for i, f in rows])[:2]
    assert one.nodes == 0


def test_settling_early_changes_nothing(monkeypatch):
    rows = [("usat"[k * k % 7 % 4], (k * 5) % 4 if k % 3 == 0 else 0) for k in range(3000)]

    def run():
        one = turns.Survivors()
        most = 0
        for initial, fault in rows:
            one.row(initial, fault)
            most = max(most, one.nodes)
        return one.end(), one.final.decode(), most

    monkeypatch.setattr(turns.Survivors, "EASY", 10**9)
    cost, audit, _ = run()
    monkeypatch.setattr(turns.Survivors, "EASY", 1)
    assert run()[:2] == (cost, audit)
    assert run()[2] < 100


def test_edge_rows(spark):
    assert found(spark, []) == []
    rows = [(7, k, "user" if k % 2 == 0 else "assistant", f"t{k}.") for k in range(40)]
    rows += [(None, None, None, None), (8, None, "user", "a."), (8, None, "user", "a."), (9, 3, "assistant", "x " * 100_000)]
    rows += [(k, 0, "user", "hello.") for k in range(100, 160)]  # some are dropped whole
    assert found(spark, rows) == plain_long(rows)


def plain_long(rows):
    return sorted((r for conv in {r[0] for r in rows} for r in plain([x for x in rows if x[0] == conv])), key=repr)


@pytest.mark.parametrize("kind", ["string", "int"])
def test_clashing_columns_and_other_types(spark, kind):
    rows = [(1, 0, "user", "a."), (1, 1, "assistant", "b."), (2, 0, "assistant", "b")]
    df = spark.createDataFrame(rows, COLUMNS).selectExpr(
        f"cast(conv_id as {kind}) AS conv_id", "turn", "role", "text", "1 AS pos", "2 AS dropped", "3 AS fault", "4 AS hash", "5 AS texts", "6 AS number"
    )
    out = [tuple(r)[1:] for r in turns.digests(turns.repaired(turns.damaged(df))).orderBy("conv_id").collect()]
    assert out == [r[1:] for r in plain(rows)]


def test_repaired_rows_are_the_conversation(spark):
    rows = [(5, k, "user", f"q{k}.") for k in range(6)]
    df = spark.createDataFrame(rows, COLUMNS).withColumn("dropped", turns.F.lit(False))
    kept = [r.role[0] for r in turns.repaired(df).orderBy("number").collect() if r.edit and r.edit != "D"]
    assert GOOD.fullmatch("".join(kept)) and kept
