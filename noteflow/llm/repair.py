"""Repair of the turn structure of conversations (operator 13).

The roles of a conversation should read ``(s?(ua)+)?`` in initials: nothing, or an optional
system turn and then user and assistant in turn.  The cheapest edit that gets there is the
shortest path through a lattice whose nodes are (turns read, state of that pattern):

* K keeps a turn (0), R gives it the role user or assistant (3), D deletes it (4; blank and
  duplicate turns must go), I inserts an empty turn of user or assistant (3).  A truncated
  turn that stays adds 3.  Of equally cheap edits the one whose letters come first in ASCII
  wins; a state and a letter determine the next state, so the letters determine the edit.
* ``cheapest`` runs Dijkstra from both ends.  It goes on until the two heaps' least labels
  together exceed the best length, when every shortest path crosses from nodes settled
  forward to nodes settled in reverse; from all equal crossings it marks back along tight
  edges in both halves, and walks the least letters over the marked edges.

Texts pass through tasks as streams, sorted by (conversation, turn): one pass reads the codes
of a conversation (a byte a turn and a digest a distinct turn) and yields its audit; a second
pass reads the audit, then the turns, and feeds them to a running SHA-256.  So a task holds
some 100 bytes per turn of one conversation, never its texts; the hash of a conversation is
sequential by definition, which is why all its rows meet in one task.

Edge cases: a null role or text counts as one space, so a null text is blank; turns are
read in the order of turn (null first), then role, then text; a null id is one
conversation of its own; initials other than s, u, a can only be deleted or given a new role;
repeated rows are duplicates; an empty table gives an empty result.  Only the named columns
are read, so further columns may have any names.
"""

from __future__ import annotations

import hashlib
import heapq
from array import array
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .util import crc32_sql, durable, table

BLANKS = " \t\n\x0b\x0c\r"
#: Costs of the edits, and of leaving a truncated turn.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: States: 0 nothing yet, 1 after s, 2 after u, 3 after a; a repaired conversation ends in 0 or 3.
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
NEW = ("u", "u", "a", "u")              # the only role an inserted or rewritten turn can take
FINAL = (0, 3)
ROLE = {"u": "user", "a": "assistant"}
FAR = 1 << 30
#: Fault of a turn: kept as it is, cut off (truncated), or to be deleted.
FINE, CUT, GONE = 0, 1, 2
#: Longest conversation whose audit is remembered for others of the same codes.
REMEMBERED = 64


def letters(code: int) -> dict:
    """Edits of a turn with this code: {(state, letter): (state after, cost)}."""
    initial, fault = "?sua"[code // 3], code % 3
    out = {(q, "D"): (q, DELETE) for q in range(4)}
    if fault != GONE:
        extra = TRUNCATED if fault == CUT else 0
        for q in range(4):
            if initial in NEXT[q]:
                out[q, "K"] = NEXT[q][initial], extra
            out[q, "R"] = NEXT[q][NEW[q]], REROLE + extra
    return out


#: What leads from, and to, each state: (letter, other state, cost), in the order of letters.
AHEAD = [[sorted((a, to, c) for (q, a), (to, c) in letters(code).items() if q == p) for p in range(4)] for code in range(12)]
BACK = [[sorted((a, q, c) for (q, a), (to, c) in letters(code).items() if to == p) for p in range(4)] for code in range(12)]
INS = [(NEXT[q][NEW[q]], INSERT) for q in range(4)]
FROM_INS = [[q for q in range(4) if INS[q][0] == p] for p in range(4)]


def cheapest(codes: bytes) -> tuple[int, str]:
    """Cost and audit of the cheapest edit, ties ASCII-least; ``codes``: 3 * initial + fault per turn."""
    n = len(codes)
    goal = [4 * n + q for q in FINAL]
    size = 4 * (n + 1)
    dist = [array("i", [FAR]) * size, array("i", [FAR]) * size]
    done = [bytearray(size), bytearray(size)]
    heaps: list[list] = [[(0, 0)], [(0, v) for v in goal]]
    dist[0][0] = 0
    for v in goal:
        dist[1][v] = 0

    def edges(side: int, v: int):
        i, q = v >> 2, v & 3
        if side == 0:
            if i < n:
                for _, to, c in AHEAD[codes[i]][q]:
                    yield v + 4 - q + to, c
            yield v - q + INS[q][0], INSERT
        else:
            if i > 0:
                for _, at, c in BACK[codes[i - 1]][q]:
                    yield v - 4 - q + at, c
            for at in FROM_INS[q]:
                yield v - q + at, INSERT

    best = FAR
    settled: tuple[list, list] = ([], [])
    while heaps[0] and heaps[1] and heaps[0][0][0] + heaps[1][0][0] <= best:
        side = 0 if heaps[0][0][0] <= heaps[1][0][0] else 1
        d, v = heapq.heappop(heaps[side])
        if done[side][v]:
            continue
        done[side][v] = 1
        settled[side].append(v)
        mine, other = dist[side], dist[1 - side]
        if d + other[v] < best:
            best = d + other[v]
        for w, c in edges(side, v):
            if d + c < mine[w]:
                mine[w] = d + c
                heapq.heappush(heaps[side], (d + c, w))
            if d + c + other[w] < best:
                best = d + c + other[w]
    # nodes on shortest paths: crossings, then what leads to them and what they lead to
    on = bytearray(size)
    todo: tuple[list, list] = ([], [])
    for v in settled[0]:
        d = dist[0][v]
        if (done[1][v] or v in goal) and d + dist[1][v] == best:
            todo[0].append(v)
            todo[1].append(v)
        for w, c in edges(0, v):
            if done[1][w] and d + c + dist[1][w] == best:
                todo[0].append(v)
                todo[1].append(w)
    for side in (0, 1):
        mine = dist[side]
        seen = bytearray(size)
        while todo[side]:
            v = todo[side].pop()
            if seen[v]:
                continue
            seen[v] = on[v] = 1
            todo[side].extend(w for w, c in edges(1 - side, v) if done[side][w] and mine[w] + c == mine[v])
    # the least letters over marked nodes; a tight edge between them is on a shortest path
    out, v, spent = [], 0, 0
    while True:
        i, q = v >> 2, v & 3
        steps = [(a, v + 4 - q + to, c) for a, to, c in AHEAD[codes[i]][q]] if i < n else []
        steps = sorted([*steps, ("I", v - q + INS[q][0], INSERT)])
        for a, w, c in steps:
            if on[w] and (dist[0][w] == spent + c if done[0][w] else spent + c + dist[1][w] == best):
                out.append(a)
                v, spent = w, spent + c
                break
        else:
            return best, "".join(out)


_remembered = lru_cache(maxsize=100_000)(cheapest)


def audit_of(codes: bytes) -> tuple[int, str]:
    return _remembered(codes) if len(codes) <= REMEMBERED else cheapest(codes)


# ------------------------------------------------------------------ Spark


def damage(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """Every row with a reproducible fault by crc32('conv:turn') mod 20: 0 drops it, 1 empties
    its text, 2 takes out ``.!?``, 3 repeats it, 4 makes it the user's.  Columns _c, _t, _role, _text."""
    def one(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat_ws(":", one(conv_col), one(turn_col)).cast("binary")) % 20
    rows = conversations.select(F.col(conv_col).alias("_c"), F.col(turn_col).alias("_t"), one(role_col).alias("_role"),
                                one(text_col).alias("_text"), fault.alias("_f")).where("_f <> 0")
    text = F.when(F.col("_f") == 1, "").when(F.col("_f") == 2, F.regexp_replace("_text", "[.!?]", "")).otherwise(F.col("_text"))
    times = F.when(F.col("_f") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("_c", "_t", F.when(F.col("_f") == 4, "user").otherwise(F.col("_role")).alias("_role"), text.alias("_text"),
                       F.explode(times).alias("_n")).drop("_n")


def by_conversation(rows: DataFrame) -> DataFrame:
    """Rows of a conversation in one partition, in order (``_first`` 0 before 1)."""
    return rows.repartition("_c").sortWithinPartitions("_c", "_first", "_t", "_role", "_text")


def number(c):
    """An id as it travels to Python: as text, so that a null beside it doesn't make it a float."""
    return None if c is None else int(c)


AUDIT = "_c long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def read_codes(frames):
    """Pass 1: faults, cost and audit of each conversation from its turns in order."""
    at, rows = None, []

    def fresh(c):
        return {"c": c, "codes": bytearray(), "seen": set(), "n": [0, 0, 0], "illegal": 0, "last": None, "turns": [None, None, 0]}

    def close(s):
        lo, hi, distinct = s["turns"]
        gaps = 0 if lo is None else hi - lo + 1 - distinct
        rows.append((number(s["c"]), gaps, *s["n"], s["illegal"], *audit_of(bytes(s["codes"]))))

    for pdf in frames:
        for c, t, role, key, fault in zip(*(pdf[x].tolist() for x in ("_id", "_turn", "_ini", "_key", "_fault"))):
            if at is None or at["c"] != c:
                if at is not None:
                    close(at)
                at = fresh(c)
            if t is not None:
                span, t = at["turns"], int(t)
                if span[1] != t:
                    span[0], span[1], span[2] = t if span[0] is None else span[0], t, span[2] + 1
            if at["last"] is not None and at["last"] + role not in ("su", "ua", "au"):
                at["illegal"] += 1
            at["last"] = role
            if fault == GONE:
                at["n"][0] += 1
            elif key in at["seen"]:
                at["n"][1] += 1
                fault = GONE
            elif fault == CUT:
                at["n"][2] += 1
            at["seen"].add(key)
            at["codes"].append(3 * max(0, "?sua".find(role)) + fault)
        if len(rows) >= 10_000:
            yield pd.DataFrame(rows, columns=AUDIT_NAMES).astype({"_c": "Int64"})
            rows = []
    if at is not None:
        close(at)
    yield pd.DataFrame(rows, columns=AUDIT_NAMES).astype({"_c": "Int64"})


AUDIT_NAMES = [x.split()[0] for x in AUDIT.split(", ")]


def write_turns(frames):
    """Pass 2: the audit (the first row of a conversation), then its turns: (id, place, role, text)
    of every repaired turn, in order."""
    at = None

    def inserts(out):
        while at["k"] < len(at["audit"]) and at["audit"][at["k"]] == "I":
            put(out, NEW[at["q"]], None, "")

    def put(out, initial, role, text):
        out.append((at["c"], at["place"], ROLE[initial] if role is None else role, text))
        at["q"] = NEXT[at["q"]][initial]
        at["place"] += 1
        at["k"] += 1

    for pdf in frames:
        out: list = []
        for c, first, role, text in zip(*(pdf[x].tolist() for x in ("_id", "_first", "_role", "_text"))):
            if first == 0:
                at = {"c": number(c), "audit": text, "k": 0, "q": 0, "place": 0}
                inserts(out)
                continue
            edit = at["audit"][at["k"]]
            if edit == "D":
                at["k"] += 1
            elif edit == "K":
                put(out, role[:1], role, text)
            else:
                put(out, NEW[at["q"]], None, text)
            inserts(out)
        yield out


def turns_out(frames):
    for out in write_turns(frames):
        yield pd.DataFrame(out, columns=["_c", "place", "role", "text"]).astype({"_c": "Int64", "place": "int64"})


def hashes_out(frames):
    """SHA-256 of a conversation's repaired ``role:text`` lines, fed turn by turn."""
    at, digest, rows = None, None, []
    for out in write_turns(frames):
        for c, place, role, text in out:
            if place == 0:
                if digest is not None:
                    rows.append((at, digest.hexdigest()))
                at, digest = c, hashlib.sha256()
            digest.update((("\n" if place else "") + role + ":" + text).encode("utf-8", "surrogatepass"))
        if len(rows) >= 10_000:
            yield pd.DataFrame(rows, columns=["_c", "_sha"]).astype({"_c": "Int64"})
            rows = []
    if digest is not None:
        rows.append((at, digest.hexdigest()))
    yield pd.DataFrame(rows, columns=["_c", "_sha"]).astype({"_c": "Int64"})


def faults_and_audits(damaged: DataFrame) -> DataFrame:
    """One row per conversation that has turns: _c, counts of faults, cost and audit."""
    last = F.substring(F.rtrim("_text", F.lit(BLANKS)), -1, 1)
    fault = F.when(last == "", GONE).when(last.isin(".", "!", "?"), FINE).otherwise(CUT)
    coded = damaged.select("_c", "_t", "_role", "_text", F.lit(1).alias("_first"),
                           F.substring("_role", 1, 1).alias("_ini"), fault.alias("_fault"),
                           F.md5(F.concat(F.length("_role").cast("string"), F.lit(":"), "_role", "_text")).alias("_key"))
    as_text = [F.col("_c").cast("string").alias("_id"), F.col("_t").cast("string").alias("_turn")]
    return by_conversation(coded).select(*as_text, "_ini", "_key", "_fault").mapInPandas(read_codes, AUDIT)


def with_audits(damaged: DataFrame, audits: DataFrame) -> DataFrame:
    """The audit of each conversation, then its turns, in order."""
    head = audits.select("_c", F.lit(0).alias("_first"), F.lit(None).cast(damaged.schema["_t"].dataType).alias("_t"),
                         F.lit("").alias("_role"), F.col("audit").alias("_text"))
    both = damaged.select("_c", F.lit(1).alias("_first"), "_t", "_role", "_text").unionByName(head)
    return by_conversation(both).select(F.col("_c").cast("string").alias("_id"), "_first", "_role", "_text")


def repair(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """Repaired conversations: id, place (from 0), role, text.  A conversation of which nothing
    is left has no rows."""
    rows = turns.select(F.col(conv_col).cast("long").alias("_c"), F.col(turn_col).cast("long").alias("_t"),
                        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(a) for c, a in ((role_col, "_role"), (text_col, "_text"))])
    audits = durable(faults_and_audits(rows))
    fixed = with_audits(rows, audits).mapInPandas(turns_out, "_c long, place long, role string, text string")
    return fixed.withColumnRenamed("_c", conv_col)


def repair_report(damaged: DataFrame, ids: DataFrame) -> DataFrame:
    """One row for every id in ``ids`` (column _id): faults, cost, audit and the hash of the repair."""
    audits = durable(faults_and_audits(damaged))
    hashes = with_audits(damaged, audits).mapInPandas(hashes_out, "_c long, _sha string").withColumnRenamed("_c", "_h")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return (ids.join(audits, F.col("_id").eqNullSafe(F.col("_c")), "left")
               .join(hashes, F.col("_id").eqNullSafe(F.col("_h")), "left")
               .select("_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts],
                       F.coalesce("audit", F.lit("")).alias("audit"),
                       F.coalesce("_sha", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256")))


def op13_bidirectional_repair(spark, sf_dir: str) -> DataFrame:
    """Damaged conversations, repaired: one row per original conversation."""
    talks = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    damaged = damage(talks).select(F.col("_c").cast("long").alias("_c"), F.col("_t").cast("long").alias("_t"), "_role", "_text")
    report = repair_report(damaged, talks.select(F.col("conv_id").cast("long").alias("_id")).distinct())
    return report.withColumnRenamed("_id", "conv_id")


OP13_SQL = rf"""
WITH RECURSIVE raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {crc32_sql("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS f FROM conversations
), damaged AS (
  SELECT conv_id, turn, CASE f WHEN 4 THEN 'user' ELSE role END AS role,
         CASE f WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE f WHEN 3 THEN [0, 1] ELSE [0] END) AS copy FROM raw WHERE f <> 0
), turns AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, left(role, 1) AS r,
         right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS last FROM damaged
), faults AS (
  SELECT *, CASE WHEN last = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                 WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         lag(r) OVER (PARTITION BY conv_id ORDER BY i) || r AS pair FROM turns
), counts AS (
  SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank,
         count(*) FILTER (WHERE fault = 'duplicate') AS duplicate, count(*) FILTER (WHERE fault = 'truncated') AS truncated,
         count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal FROM faults GROUP BY conv_id
), inserts AS (
  SELECT * FROM (VALUES (0, 0, 0, '', ''), (0, 2, 3, 'I', 'user:' || chr(10)), (0, 3, 6, 'II', 'user:' || chr(10) || 'assistant:' || chr(10)),
    (1, 1, 0, '', ''), (1, 2, 3, 'I', 'user:' || chr(10)), (1, 3, 6, 'II', 'user:' || chr(10) || 'assistant:' || chr(10)),
    (2, 2, 0, '', ''), (2, 3, 3, 'I', 'assistant:' || chr(10)), (3, 3, 0, '', ''), (3, 2, 3, 'I', 'user:' || chr(10))) AS t(q, q2, c, letters, lines)
), moves AS (
  SELECT * FROM (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)) AS t(q, r, q2)
), rewrites AS (
  SELECT * FROM (VALUES (0, 2, 'user'), (1, 2, 'user'), (2, 3, 'assistant'), (3, 2, 'user')) AS t(q, q2, role)
), steps AS (
  SELECT f.conv_id, f.i, s.q, s.q AS q1, 4 AS c, 'D' AS letter, '' AS line FROM faults f, (SELECT unnest(range(4)) AS q) s
  UNION ALL
  SELECT f.conv_id, f.i, m.q, m.q2, CASE f.fault WHEN 'truncated' THEN 3 ELSE 0 END, 'K', f.role || ':' || f.text || chr(10)
  FROM faults f JOIN moves m ON m.r = f.r WHERE f.fault NOT IN ('blank', 'duplicate')
  UNION ALL
  SELECT f.conv_id, f.i, w.q, w.q2, CASE f.fault WHEN 'truncated' THEN 6 ELSE 3 END, 'R', w.role || ':' || f.text || chr(10)
  FROM faults f, rewrites w WHERE f.fault NOT IN ('blank', 'duplicate')
), best AS (
  SELECT c.conv_id, CAST(0 AS BIGINT) AS i, s.q2 AS q, {{'c': s.c, 'audit': s.letters, 'body': s.lines}} AS b FROM counts c JOIN inserts s ON s.q = 0
  UNION ALL
  SELECT x.conv_id, x.i + 1 AS i, s.q2 AS q, min({{'c': x.b.c + t.c + s.c, 'audit': x.b.audit || t.letter || s.letters, 'body': x.b.body || t.line || s.lines}}) AS b
  FROM best x JOIN steps t ON t.conv_id IS NOT DISTINCT FROM x.conv_id AND t.i = x.i + 1 AND t.q = x.q JOIN inserts s ON s.q = t.q1
  GROUP BY x.conv_id, x.i, s.q2
), final AS (
  SELECT c.conv_id, min(x.b) AS b FROM counts c JOIN best x ON x.conv_id IS NOT DISTINCT FROM c.conv_id AND x.i = c.n WHERE x.q IN (0, 3) GROUP BY c.conv_id
)
SELECT o.conv_id, CAST(coalesce(c.gaps, 0) AS BIGINT) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate,
       coalesce(c.truncated, 0) AS truncated, coalesce(c.illegal, 0) AS illegal, CAST(coalesce(f.b.c, 0) AS BIGINT) AS cost,
       coalesce(f.b.audit, '') AS audit, sha256(coalesce(left(f.b.body, greatest(length(f.b.body) - 1, 0)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN final f ON f.conv_id IS NOT DISTINCT FROM o.conv_id
"""
