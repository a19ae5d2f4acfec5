"""Operator 13: the bidirectional search against an exhaustive one, and whole conversations."""

import hashlib
import heapq
import random
import re

import pytest

from noteflow.llm import repair as R

SCHEMA = "conv_id long, turn long, role string, text string, _c int, audit int"


def exhaustive(codes):
    """Least (cost, audit) over all edits, in order of cost and letters; no search tree is cut."""
    heap = [(0, "", 0, 0)]
    while heap:
        cost, audit, i, q = heapq.heappop(heap)
        if i == len(codes) and q in (0, 3):
            return cost, audit
        heapq.heappush(heap, (cost + 3, audit + "I", i, {0: 2, 1: 2, 2: 3, 3: 2}[q]))
        if i < len(codes):
            initial, fault = "?sua"[codes[i] // 3], codes[i] % 3
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, q))
            if fault != R.GONE:
                extra = 3 * (fault == R.CUT)
                to = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}.get((q, initial))
                if to is not None:
                    heapq.heappush(heap, (cost + extra, audit + "K", i + 1, to))
                heapq.heappush(heap, (cost + extra + 3, audit + "R", i + 1, {0: 2, 1: 2, 2: 3, 3: 2}[q]))


def test_search_equals_exhaustive_search():
    rng = random.Random(1)
    for _ in range(1500):
        codes = bytes(rng.choice([3, 6, 9, 6, 9, 6, 9, 7, 10, 0, 8, 11, 4, 2]) for _ in range(rng.randint(0, 6)))
        assert R.cheapest(codes) == exhaustive(codes)


def test_long_conversation():
    n = 20_000
    cost, audit = R.cheapest(bytes([6, 9] * n))
    assert (cost, audit) == (0, "K" * 2 * n)
    cost, audit = R.cheapest(bytes([6] * n))                      # users only: an answer after each, or every second rewritten
    assert cost == 3 * n // 2 and audit.count("R") == n // 2


def repaired(rows):
    """(cost, audit, lines) of turns (role, text) in order."""
    seen, codes = set(), bytearray()
    for role, text in rows:
        last = text.strip(" \t\n\x0b\x0c\r")[-1:]
        fault = R.GONE if not last or (role, text) in seen else R.FINE if last in ".!?" else R.CUT
        seen.add((role, text))
        codes.append(3 * max(0, "?sua".find(role[:1])) + fault)
    cost, audit = exhaustive(bytes(codes))
    lines, q, i = [], 0, 0
    step = {0: "u", 1: "u", 2: "a", 3: "u"}
    for a in audit:
        if a == "I":
            initial, role, text = step[q], None, ""
        else:
            role, text = rows[i]
            initial, i = role[:1], i + 1
            if a == "D":
                continue
            if a == "R":
                initial, role = step[q], None
        lines.append((role or {"u": "user", "a": "assistant"}[initial], text))
        q = {"s": 1, "u": 2, "a": 3}[initial]
    return cost, audit, lines


TALKS = {
    1: [(0, "user", "Hi."), (1, "assistant", "Yes!")],
    2: [(0, "assistant", "Hi."), (1, "user", "cut off"), (1, "user", "cut off"), (5, "tool", "x."), (None, "system", "Be kind.")],
    3: [(0, None, None), (1, "user", " \n"), (2, "", "odd?")],
    4: [(t, "user" if t % 2 else "system", f"turn {t}." + "é" * 500) for t in range(7)],
    None: [(0, "user", "Nobody's."), (None, None, "Null turn.")],
}


@pytest.fixture(scope="module")
def talks(spark):
    rows = [(c, t, r, x, 1, 2) for c, turns in TALKS.items() for t, r, x in turns]
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def in_order(turns):
    own = [((t is not None, t or 0), " " if r is None else r, " " if x is None else x) for t, r, x in turns]
    return [(r, x) for _, r, x in sorted(own)]


def test_repaired_turns(talks):
    got = {}
    for r in sorted(R.repair(talks).collect(), key=lambda r: (str(r["conv_id"]), r["place"])):
        got.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    for c, turns in TALKS.items():
        assert got.get(c, []) == repaired(in_order(turns))[2]
        assert re.fullmatch("(s?(ua)+)?", "".join(role[0] for role, _ in got.get(c, [])))


def test_report(spark, talks):
    rows = talks.selectExpr("conv_id AS _c", "turn AS _t", "coalesce(role, ' ') AS _role", "coalesce(text, ' ') AS _text")
    ids = spark.createDataFrame([(c,) for c in [*TALKS, 99]], "_id long")
    got = {r["_id"]: r for r in R.repair_report(rows, ids).collect()}
    assert got.keys() == {*TALKS, 99}
    for c, turns in TALKS.items():
        cost, audit, lines = repaired(in_order(turns))
        assert (got[c]["cost"], got[c]["audit"]) == (cost, audit)
        assert got[c]["repaired_sha256"] == hashlib.sha256("\n".join(f"{r}:{x}" for r, x in lines).encode()).hexdigest()
    assert [got[2][k] for k in ("gaps", "blank", "duplicate", "truncated", "illegal")] == [3, 0, 1, 1, 3]
    assert [got[3][k] for k in ("gaps", "blank", "duplicate", "truncated", "illegal")] == [0, 2, 0, 0, 2]
    empty = got[99]
    assert (empty["cost"], empty["audit"], empty["repaired_sha256"]) == (0, "", hashlib.sha256(b"").hexdigest())


def test_damage(spark):
    from zlib import crc32
    rows = [(c, t, "assistant", "One. Two! Three? four", 0, 0) for c in range(60) for t in range(5)]
    got = {}
    for r in R.damage(spark.createDataFrame(rows, SCHEMA)).collect():
        got.setdefault((r["_c"], r["_t"]), []).append((r["_role"], r["_text"]))
    for c, t, role, text, *_ in rows:
        f = crc32(f"{c}:{t}".encode()) % 20
        want = {0: None, 1: [(role, "")], 2: [(role, "One Two Three four")], 3: [(role, text)] * 2, 4: [("user", text)]}.get(f, [(role, text)])
        assert got.get((c, t)) == want


def test_no_conversations(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert R.repair(none).collect() == []
    assert R.repair_report(R.damage(none), none.selectExpr("conv_id AS _id").distinct()).collect() == []
