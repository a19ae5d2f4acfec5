"""Prefix trie of conversations as balanced parentheses (operator 11).

A conversation is the sequence of its turns, each a 128-bit digest of role and text; the
conversations' distinct prefixes are the nodes of a trie.  ``prefix_trie`` returns, per node,
its members and what sharing it saves.

* Equal paths are counted first; a path's ids are joined in blocks of ``ID_BLOCK`` before
  they are hashed in order, so a path that a third of all conversations share arrives at its
  task as a few rows of joined ids.
* The distinct paths are sorted by range: a shard holds a run of paths next to each other,
  about ``SHARD_NODES`` turns, and a common first turn is spread over as many shards as its
  subtree needs.
* A shard writes its trie as balanced parentheses.  ``Parens`` keeps the excess and a tree of
  block minima: findclose climbs and descends it for all nodes at once and delimits their
  subtrees; the rank of ``()`` pairs counts leaves; differences of cumulative arrays over the
  preorder give members and savings, a range minimum the least id.
* A node that neighbouring shards share is a node of the spine at their border, as deep as
  the last path of one and the first of the next agree.  Shards give the shares of such
  nodes without their shared children; the shares are summed per node and added up along the
  spines.  Only these nodes (shards x agreeing turns) reach the driver, with the shards'
  first and last paths.

Edge cases: a null role or text is empty; turns are read in the order of turn (null first),
then role, then a digest of both; a conversation without turns ends at the root; rows with a
null id belong to no conversation and are left out; repeated turns are turns of their own; an
empty table gives an empty result (no root).  A conversation's path takes 16 bytes a turn, in
one value; texts never leave the scan.  Only the named columns are read, so further columns
may have any names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import values_df
from .util import WORD, crc32_sql, durable, parts_for, table

KEY = 16
#: Ids of a path joined at once before they are hashed, as a range of ids.
ID_BLOCK = 4096
#: Turns (nodes, at most) a shard holds on average.
SHARD_NODES = 200_000
#: Parentheses per block of the excess tree.
BLOCK = 64
NOBODY = 2**63 - 1
NO_ENDS = hashlib.sha256(b"").hexdigest()
#: Rows up to which the table of shared nodes is broadcast (it is on the driver anyway).
SHARED_ROWS = 100_000
NODES = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
         "ends_sha256 string, _shared long, _above long, _words long")


class Parens:
    """Balanced parentheses (1 opens, 0 closes) with block minima of the excess."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits
        self.excess = np.cumsum(2 * bits.astype(np.int64) - 1)
        blocks = -(-len(bits) // BLOCK)
        self.base = 1 << max(0, (blocks - 1).bit_length())
        padded = np.full(self.base * BLOCK, len(bits) + 1, dtype=np.int64)
        padded[:len(bits)] = self.excess
        self.padded = padded
        self.least = np.empty(2 * self.base, dtype=np.int64)
        self.least[self.base:] = padded.reshape(self.base, BLOCK).min(axis=1)
        for i in range(self.base - 1, 0, -1):
            self.least[i] = min(self.least[2 * i], self.least[2 * i + 1])
        pair = (bits[:-1] == 1) & (bits[1:] == 0) if len(bits) else np.zeros(0, bool)
        self.pairs = np.concatenate(([0], np.cumsum(pair)))     # () pairs that begin before a place

    def _in_block(self, start: np.ndarray, goal: np.ndarray) -> np.ndarray:
        """First place from ``start`` to the end of its block with excess ``goal`` (-1: none)."""
        out = np.full(len(start), -1, dtype=np.int64)
        at, open_ = start.copy(), np.arange(len(start))
        end = (start // BLOCK + 1) * BLOCK
        while len(open_):
            inside = at[open_] < end[open_]
            open_ = open_[inside]
            hit = self.padded[at[open_]] <= goal[open_]
            out[open_[hit]] = at[open_[hit]]
            open_ = open_[~hit]
            at[open_] += 1
        return out

    def findclose(self, opens: np.ndarray) -> np.ndarray:
        """The place that closes each open parenthesis: the first later one where the excess
        falls below what it opened."""
        goal = self.excess[opens] - 1
        nxt = np.minimum(opens + 1, len(self.padded) - 1)
        same = nxt // BLOCK == opens // BLOCK
        out = np.full(len(opens), -1, dtype=np.int64)
        out[same] = self._in_block(nxt[same], goal[same])
        left = np.flatnonzero(out < 0)
        node = self.base + opens[left] // BLOCK + 1
        want = goal[left]
        while True:   # up: to the next subtree of blocks that reaches the goal
            above = self.least[node] > want
            if not above.any():
                break
            up = above & (node % 2 == 1)
            node = np.where(up, (node + 1) // 2, np.where(above, node + 1, node))
        while (node < self.base).any():   # down: to its first such block
            inner = node < self.base
            child = np.where(inner, 2 * node, node)
            node = np.where(inner & (self.least[np.minimum(child, 2 * self.base - 1)] > want), child + 1, child)
        out[left] = self._in_block((node - self.base) * BLOCK, want)
        return out

    def leaf_pairs(self, opens: np.ndarray, closes: np.ndarray) -> np.ndarray:
        return self.pairs[closes] - self.pairs[opens]


def range_min(values: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Minimum of each range, from the minima of all ranges of 2^k values."""
    out = np.empty(len(start), dtype=values.dtype)
    k, level = 0, values
    while True:
        own = (length >> k) == 1
        if own.any():
            s, e = start[own], start[own] + length[own] - (1 << k)
            out[own] = np.minimum(level[s], level[e])
        k += 1
        if len(length) == 0 or (int(length.max()) >> k) == 0:
            return out
        level = np.minimum(level[:-(1 << (k - 1))], level[(1 << (k - 1)):])


def agree(a: bytes, b: bytes) -> int:
    """Turns that two paths share from the start."""
    lo, hi = 0, min(len(a), len(b)) // KEY
    if a[:hi * KEY] == b[:hi * KEY]:
        return hi
    while hi - lo > 1:   # the first lo turns agree, the first hi do not
        mid = (lo + hi) // 2
        if a[lo * KEY:mid * KEY] == b[lo * KEY:mid * KEY]:
            lo = mid
        else:
            hi = mid
    return lo


def shard_nodes(rows, left, right):
    """The nodes of one shard as columns of ``NODES``.

    ``rows``: (path, words, ends, least id, hash of the ids), sorted by path, without repeats;
    ``left`` and ``right``: numbers of the nodes shared with the shard before and after, by depth.
    """
    bits, chain, prev = bytearray(b"\x01"), [0], b""
    depth, parent, word, end, least, sha = [0], [-1], [0], [0], [NOBODY], [None]
    on_first: list = []
    for path, words, n, low, digest in rows:
        k = agree(prev, path)
        turns = len(path) // KEY
        bits.extend(b"\x00" * (len(prev) // KEY - k))
        del chain[k + 1:]
        for j in range(k, turns):
            bits.append(1)
            parent.append(chain[j])
            chain.append(len(depth))
            depth.append(j + 1)
            word.append(words[j])
            end.append(0)
            least.append(NOBODY)
            sha.append(None)
        v = chain[turns]
        end[v], least[v], sha[v] = n, low, digest
        if not on_first:
            on_first = chain[:]
        prev = path
    bits.extend(b"\x00" * (len(prev) // KEY + 1))
    depth, parent, word, end, least = (np.array(x, dtype=np.int64) for x in (depth, parent, word, end, least))
    shared = np.full(len(depth), -1, dtype=np.int64)
    shared[on_first[:len(left)]] = left
    shared[chain[:len(right)]] = right
    tree = Parens(np.frombuffer(bytes(bits), dtype=np.uint8))
    opens = np.flatnonzero(tree.bits)
    closes = tree.findclose(opens)
    size = (closes - opens + 1) // 2
    first = np.arange(len(depth))

    def subtree(values):
        upto = np.concatenate(([0], np.cumsum(values)))
        return upto[first + size] - upto[first]

    convs = subtree(end)
    low = range_min(least, first, size)
    leaves = tree.leaf_pairs(opens, closes)
    saved = subtree(np.where(shared < 0, (convs - 1) * word, 0))
    inner = np.flatnonzero((shared < 0) & (parent >= 0))
    children = np.bincount(parent[inner], minlength=len(depth))
    spine = np.flatnonzero(shared >= 0)
    if len(spine):   # shares of shared nodes: what ends there, and their children that no other shard has
        own = inner[shared[parent[inner]] >= 0]

        def share(values, start):
            out = start.copy()
            np.add.at(out, parent[own], values[own])
            return out[spine]
        parts = share(convs, end), share(leaves, np.zeros_like(end)), share(saved, np.zeros_like(end))
        least_of = least.copy()
        np.minimum.at(least_of, parent[own], low[own])
        convs[spine], leaves[spine], saved[spine] = parts
        low[spine] = least_of[spine]
    above = np.where(parent >= 0, shared[np.maximum(parent, 0)], -1)
    up = low[np.maximum(parent, 0)]
    unknown = (parent < 0) | (above >= 0)
    return [pa.array(low), pa.array(depth), pa.array(up, mask=unknown), pa.array(convs), pa.array(children), pa.array(leaves),
            pa.array(saved), pa.array(sha, pa.string()), pa.array(shared), pa.array(above), pa.array(word)]


def hash_ids(frames):
    """Joined ids of each path in order (rows sorted by path and block) -> their SHA-256."""
    names = ["_path", "_w", "_n", "_min", "_sha"]
    at, digest, out = None, None, []

    def done():
        out.append((*at, digest.hexdigest()))

    for batch in frames:
        for path, w, n, low, ids in zip(*(batch.column(x).to_pylist() for x in ("_path", "_w", "_n", "_min", "_ids"))):
            if at is not None and at[0] == path:
                at = (path, w, at[2] + n, min(at[3], low))
                digest.update(b"," + ids.encode())
                continue
            if at is not None:
                done()
            at, digest = (path, w, n, low), hashlib.sha256(ids.encode())
        if len(out) >= 5000:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), PATH_TYPES)], names)
            out.clear()
    if at is not None:
        done()
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), PATH_TYPES)], names)


PATH_TYPES = [pa.binary(), pa.list_(pa.int32()), pa.int64(), pa.int64(), pa.string()]


# ------------------------------------------------------------------ Spark


def turns_of(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
             text_col: str = "text") -> DataFrame:
    """One row per conversation: _c and _turns, its turns in order as (digest, words)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("_c"), F.col(turn_col).alias("t"), role.alias("r"),
        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("k"),
        F.regexp_count(text, F.lit(WORD)).alias("w"))
    grouped = rows.groupBy("_c").agg(F.sort_array(F.collect_list(F.struct("t", "r", "k", "w"))).alias("s"))
    return grouped.select("_c", F.transform("s", lambda x: F.struct(x["k"].alias("k"), x["w"].alias("w"))).alias("_turns"))


def rebuilt(talks: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """Every conversation with its first h turns taken from conversation c - c % every (h is
    crc32(c) % most; fewer if that has fewer, none if it is absent)."""
    h = (F.crc32(F.col("_c").cast("string").cast("binary")) % most).cast("int")
    base = talks.where(F.col("_c") % every == 0).select(F.col("_c").alias("_b"), F.slice("_turns", 1, most - 1).alias("_head"))
    own = talks.withColumn("_h", h)
    head = F.coalesce(F.slice("_head", F.lit(1), F.col("_h")), F.slice("_turns", 1, 0))
    tail = F.when(F.col("_h") < F.size("_turns"), F.slice("_turns", F.col("_h") + 1, F.size("_turns"))).otherwise(F.slice("_turns", 1, 0))
    return own.join(base, F.col("_c") - F.col("_c") % every == F.col("_b"), "left").select("_c", F.concat(head, tail).alias("_turns"))


def distinct_paths(talks: DataFrame) -> DataFrame:
    """_path (binary), _w (words by turn), _n conversations that end there, their _min id and hash _sha."""
    paths = talks.select("_c", F.unhex(F.array_join(F.transform("_turns", lambda x: x["k"]), "")).alias("_path"),
                         F.transform("_turns", lambda x: x["w"]).alias("_w"), F.floor(F.col("_c") / ID_BLOCK).alias("_k"))
    blocks = paths.groupBy("_path", "_k").agg(F.first("_w").alias("_w"), F.count(F.lit(1)).alias("_n"), F.min("_c").alias("_min"),
                                              F.sort_array(F.collect_list("_c")).alias("_ids"))
    sorted_ = blocks.withColumn("_ids", F.array_join(F.col("_ids").cast("array<string>"), ",")) \
                    .repartition("_path").sortWithinPartitions("_path", "_k")
    return sorted_.select("_path", "_w", "_n", "_min", "_ids") \
                  .mapInArrow(hash_ids, "_path binary, _w array<int>, _n long, _min long, _sha string")


def shared_nodes(bounds) -> tuple[dict, dict]:
    """Numbers of the nodes that neighbouring shards share.

    ``bounds``: (shard, first path, last path) of the shards that have rows, in order.  Returns, by
    shard, the numbers at depths 0, 1, .. of the nodes shared with the shard before, and with the
    one after; the same node has the same number in all its shards."""
    before, after, fresh = {}, {}, 0
    known: list = []
    for (s, first, last), (t, following, _) in zip(bounds, bounds[1:]):
        deep = agree(last, following) + 1
        same = min(len(known), deep, agree(first, last) + 1)
        known = known[:same] + list(range(fresh, fresh + deep - same))
        fresh += deep - same
        after[s] = before[t] = known
    return before, after


def prefix_trie(talks: DataFrame, shard_turns: int = SHARD_NODES) -> DataFrame:
    """One row per node of the trie of ``talks`` (_c and _turns)."""
    spark = talks.sparkSession
    paths = durable(distinct_paths(talks))
    total = paths.select(F.sum(F.length("_path") / KEY + 1).cast("long").alias("n")).first()["n"] or 0
    ranged = paths.repartitionByRange(parts_for(total, shard_turns, 8), "_path").sortWithinPartitions("_path")
    sharded = durable(ranged.withColumn("_shard", F.spark_partition_id()))
    bounds = sorted(tuple(r) for r in sharded.groupBy("_shard").agg(F.min("_path"), F.max("_path")).collect())
    before, after = shared_nodes([(s, bytes(a), bytes(z)) for s, a, z in bounds])
    names = [x.split()[0] for x in NODES.split(", ")]

    def nodes(batches):
        rows, shard = [], None
        for batch in batches:
            if batch.num_rows:
                shard = batch.column("_shard")[0].as_py()
                rows += zip(*(batch.column(x).to_pylist() for x in ("_path", "_w", "_n", "_min", "_sha")))
        if rows:
            left, right = before.get(shard, []), after.get(shard, [])
            columns = shard_nodes(rows, left, right)
            for batch in pa.Table.from_arrays(columns, names).to_batches(max_chunksize=20_000):
                yield batch

    found = durable(sharded.mapInArrow(nodes, NODES))
    spine = found.where("_shared >= 0").groupBy("_shared", "_above", "depth").agg(
        F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.max("ends_sha256").alias("sha"), F.first("_words").alias("words")).collect()
    merged = merge_spines(spine)
    public = names[:8]
    tops = values_df(spark, [(r["_shared"], r["conv_id"]) for r in merged], "_top long, _top_conv long")
    if len(merged) <= SHARED_ROWS:
        tops = F.broadcast(tops)
    rest = found.where("_shared < 0").join(tops, F.col("_above") == F.col("_top"), "left") \
                .withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_top_conv")).select(*public)
    shared = values_df(spark, [tuple(r[c] for c in public) for r in merged], ", ".join(NODES.split(", ")[:8]))
    return rest.unionByName(shared).withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_ENDS)))


def merge_spines(rows) -> list[dict]:
    """Whole values of the shared nodes from their summed shares, deepest first."""
    by_id = {r["_shared"]: r.asDict() | {"ends_sha256": r["sha"]} for r in rows}
    order = sorted(by_id.values(), key=lambda r: -r["depth"])
    for r in order:
        if r["n_children"] == 0:
            r["n_leaves"] = 1
        r["saved_tokens"] += (r["n_convs"] - 1) * r["words"]
        up = by_id.get(r["_above"])
        if up is not None:
            for c in ("n_convs", "n_leaves", "saved_tokens"):
                up[c] += r[c]
            up["conv_id"] = min(up["conv_id"], r["conv_id"])
            up["n_children"] += 1
    for r in order:
        up = by_id.get(r["_above"])
        r["parent_conv_id"] = None if up is None else up["conv_id"]
    return order


def op11_parentheses_trie(spark, sf_dir: str) -> DataFrame:
    """The trie of all conversations, each rebuilt on the first turns of conversation c - c % 20."""
    return prefix_trie(rebuilt(turns_of(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))))


OP11_SQL = rf"""
WITH turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, k) AS i, k, w FROM (
    SELECT conv_id, turn, coalesce(role, '') AS role, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k,
           len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS w FROM conversations WHERE conv_id IS NOT NULL)
), talks AS (
  SELECT conv_id, {crc32_sql("CAST(conv_id AS VARCHAR)")} % 4 AS h FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL)
), rebuilt AS (
  SELECT t.conv_id, u.i, u.k, u.w FROM talks t JOIN turns u ON u.conv_id = t.conv_id - t.conv_id % 20 AND u.i <= t.h
  UNION ALL SELECT t.conv_id, u.i, u.k, u.w FROM talks t JOIN turns u ON u.conv_id = t.conv_id AND u.i > t.h
), paths AS (
  SELECT t.conv_id, list(r.k ORDER BY r.i) FILTER (WHERE r.k IS NOT NULL) AS ks, list(r.w ORDER BY r.i) AS ws, count(r.k) AS n
  FROM talks t LEFT JOIN rebuilt r USING (conv_id) GROUP BY t.conv_id
), prefixes AS (
  SELECT conv_id, n, d, CASE WHEN d = 0 THEN '' ELSE array_to_string(ks[1:d], '') END AS p, CASE WHEN d = 0 THEN 0 ELSE ws[d] END AS w
  FROM (SELECT *, unnest(range(n + 1)) AS d FROM paths)
), nodes AS (
  SELECT d, p, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(w) AS w,
         coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE n = d), '') AS ends FROM prefixes GROUP BY d, p
), kids AS (
  SELECT left(p, CAST(32 * (d - 1) AS INTEGER)) AS p, d - 1 AS d, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL
), below AS (
  SELECT left(p, CAST(32 * a AS INTEGER)) AS p, a AS d, sum((n_convs - 1) * w) AS saved, count(*) FILTER (WHERE n_children IS NULL) AS n_leaves
  FROM (SELECT n.*, k.n_children, unnest(range(n.d + 1)) AS a FROM nodes n LEFT JOIN kids k ON k.d = n.d AND k.p = n.p) GROUP BY ALL
)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, u.conv_id AS parent_conv_id, CAST(n.n_convs AS BIGINT) AS n_convs,
       CAST(coalesce(k.n_children, 0) AS BIGINT) AS n_children, CAST(b.n_leaves AS BIGINT) AS n_leaves,
       CAST(b.saved AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM nodes n JOIN below b ON b.d = n.d AND b.p = n.p LEFT JOIN kids k ON k.d = n.d AND k.p = n.p
LEFT JOIN nodes u ON u.d = n.d - 1 AND u.p = left(n.p, CAST(32 * (n.d - 1) AS INTEGER))
"""
