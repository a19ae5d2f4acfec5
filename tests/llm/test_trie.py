"""Operator 11 against tries built in plain Python."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from noteflow.llm import trie

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "conv_id long, turn long, role string, text string, _c int, depth int"


def naive(rows):
    """Nodes of the rebuilt conversations by definition."""
    own = {}
    for c, t, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            key = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own.setdefault(c, []).append(((t is not None, t or 0), role, key, text))
    own = {c: [(r, x) for _, r, _, x in sorted(v)] for c, v in own.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = own.get(c - c % 20, [])[:h] + own[c][h:]
    members = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = set()
    for path, cs in members.items():
        below = [p for p in members if p[:len(path)] == path]
        kids = [p for p in below if len(p) == len(path) + 1]
        leaf = [p for p in below if not any(q[:len(p)] == p and len(q) == len(p) + 1 for q in below)]
        saved = sum((len(members[p]) - 1) * (len(WORDS.findall(p[-1][1])) if p else 0) for p in below)
        ends = ",".join(str(c) for c in sorted(cs) if len(built[c]) == len(path))
        out.add((min(cs), len(path), min(members[path[:-1]]) if path else None, len(cs), len(kids), len(leaf), saved,
                 hashlib.sha256(ends.encode()).hexdigest()))
    return out


def talks(n, seed):
    """Conversations that share openings, whole copies, nulls, empty texts, repeated turns, a long one."""
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rng.randint(1, 5)):
            role = rng.choice(["user", "assistant"]) if t else "user"
            rows.append((c, t, role, rng.choice(["a b", "c", "", "d e f", "a b "]) if t else rng.choice(["hot first turn", "x"])))
    rows += [(n, t, "user", "hot first turn" if t == 0 else f"w{t} y") for t in range(300)]
    rows += [(n + 1, None, None, None), (n + 1, None, "user", None), (n + 1, 3, None, "tail"), (n + 1, 3, None, "tail"), (None, 0, "user", "lost")]
    return [(*r, 7, 9) for r in rows]


@pytest.mark.parametrize("shard_turns", [3, 20, 10_000])
def test_nodes_equal_the_naive_trie(spark, shard_turns):
    rows = talks(130, 5)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = trie.prefix_trie(trie.rebuilt(trie.turns_of(frame)), shard_turns).collect()
    want = naive(rows)
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_conversations_without_turns_end_at_the_root(spark):
    # 1001 takes its first turns from 1000, which is absent
    ids = [c for c in range(1001, 1020) if zlib.crc32(str(c).encode()) % 4 >= 1]
    rows = [(c, 0, "user", "only", 0, 0) for c in ids]
    got = trie.prefix_trie(trie.rebuilt(trie.turns_of(spark.createDataFrame(rows, SCHEMA)))).collect()
    assert {tuple(r) for r in got} == naive(rows)
    assert [(r["depth"], r["n_convs"], r["n_leaves"]) for r in got] == [(0, len(ids), 1)]


def test_no_conversations(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert trie.prefix_trie(trie.rebuilt(trie.turns_of(none))).collect() == []


def test_many_copies_hash_like_one_list(spark):
    n = 3 * trie.ID_BLOCK + 5
    talk = spark.range(n).selectExpr("id AS _c", "array(named_struct('k', md5('t'), 'w', 2)) AS _turns")
    got = {r["depth"]: r for r in trie.prefix_trie(talk).collect()}
    assert got[1]["ends_sha256"] == hashlib.sha256(",".join(map(str, range(n))).encode()).hexdigest()
    assert got[1]["saved_tokens"] == got[0]["saved_tokens"] == 2 * (n - 1) and got[0]["n_convs"] == n


def test_parentheses_close_where_a_stack_says():
    rng = random.Random(2)
    for size in [1, 2, 31, 32, 33, 500, 5000]:
        bits, open_, left = [], 0, size
        while left or open_:
            if left and (not open_ or rng.random() < 0.6):
                bits.append(1); open_ += 1; left -= 1
            else:
                bits.append(0); open_ -= 1
        stack, want = [], {}
        for i, b in enumerate(bits):
            if b:
                stack.append(i)
            else:
                want[stack.pop()] = i
        opens = np.flatnonzero(np.array(bits))
        assert trie.Parens(np.array(bits, dtype=np.uint8)).findclose(opens).tolist() == [want[i] for i in opens]


def test_agree():
    a = bytes(range(16)) * 5
    for k in range(6):
        assert trie.agree(a, a[:16 * k] + b"\xff" * 16) == min(k, 5)
    assert trie.agree(a, b"") == 0
