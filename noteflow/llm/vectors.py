"""Embedding near-duplicates by a subspace pigeonhole join (operator 4).

Unit vectors with cosine >= c differ by at most ``2 (1 - c)`` in squared distance.  A fixed
random rotation spreads that over ``BLOCKS`` subspaces; budgets proportional to the
subspaces' variance add up to the whole, so every link has a subspace in which it keeps
within its budget (pigeonhole).  Per subspace a range join finds the pairs in budget:

* Each vector's home is the cell of its nearest pivot; it also visits the later cells that
  its budget's ball can reach (a bound by the hyperplanes between pivots), so a pair in
  budget meets in exactly one cell.
* Cells are cut into tiles of about ``TILE`` vectors; a group joins two tiles.  However many
  vectors a cell has, no task holds more than two tiles, and any number of cells is exact.
* A pair in budget is verified by its cosine in double precision, and counts in the first
  subspace whose budget it keeps, so the union over subspaces has it once.

Groups return link counts and a spanning forest of their links, not pairs; components come
from :func:`noteflow.llm.util.components`.  Equal vectors are joined as one with their number.

Pivots and variances are fitted on at most ``SAMPLE`` vectors; every vector is joined.
Vectors that are null, zero or hold null or non-finite components link with nothing, as do
vectors of different lengths; a null id links with nothing and has a null component.  Rows that
share an id are one vector, the smallest of theirs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .util import components, durable, table

BLOCKS = 4
#: Vectors of a tile, and of the sample that pivots and variances are fitted on.
TILE, SAMPLE = 8192, 20_000
MAX_PIVOTS = 1024
#: Rows compared at a time inside a group.
ROWS = 512
#: Relative room for rounding in a budget.
ROOM = 1e-9


def rotation(dim: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(7).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)   # so that squares neither vanish nor overflow
    return x / np.sqrt((x * x).sum(1, keepdims=True))


class Plan:
    """Rotation, subspaces, budgets and pivots."""

    def __init__(self, sample: np.ndarray, n: int, cosine: float):
        dim = sample.shape[1]
        self.rotate = rotation(dim)
        y = unit(sample) @ self.rotate
        self.parts = [p for p in np.array_split(np.arange(dim), min(BLOCKS, dim)) if len(p)]
        spread = np.array([y[:, p].var(0).sum() + 1e-3 for p in self.parts])
        self.cosine = cosine
        self.budgets = 2 * (1 - cosine) * spread / spread.sum() * (1 + ROOM) + 1e-12
        k = int(min(MAX_PIVOTS, max(1, -(-n // TILE)), len(sample)))
        pick = np.random.default_rng(11).permutation(len(sample))[:k]
        self.pivots = [y[pick][:, p] for p in self.parts]
        self.tiles: dict[tuple[int, int], tuple[int, int]] = {}   # (block, cell) -> home tiles, visitor tiles

    def cells(self, y: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
        """Home cell of each vector, and which later cells it visits."""
        p, reach = self.pivots[block], np.sqrt(self.budgets[block]) + 1e-9
        x = y[:, self.parts[block]]
        d = (x * x).sum(1)[:, None] + (p * p).sum(1) - 2 * x @ p.T
        home = d.argmin(1)
        between = np.sqrt(np.maximum(((p[:, None] - p[None]) ** 2).sum(2), 0)) if len(p) > 1 else np.zeros((1, 1))
        visit = np.arange(len(p)) > home[:, None]
        near = np.argsort(d, axis=1)[:, :8]          # the cell must be reachable past each of the nearest pivots
        for j in near.T:
            gap = 2 * between[j]
            visit &= d - np.take_along_axis(d, j[:, None], 1) <= gap * reach + 1e-9
        return home, visit


def matrix(col) -> np.ndarray:
    return np.stack(col.to_numpy(zero_copy_only=False)).astype(np.float64)


def tile_of(ids: np.ndarray, n: int) -> np.ndarray:
    h = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((h ^ h >> np.uint64(32)) % np.uint64(n)).astype(np.int64)


def spanning(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Component label (smallest member) of each of ``n`` nodes under the links (a, b)."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[label]
        while not np.array_equal(new, new[new]):
            new = new[new]
        label = new
        open_ = label[a] != label[b]
        a, b = a[open_], b[open_]
    return label


def join_group(rows: pa.Table, plan: Plan) -> pa.Table:
    """Links between the two tiles of a group (or within one): per vector the number of
    vectors linked and the smallest vector of its local component."""
    block, tile_a, tile_b = (rows[c][0].as_py() for c in ("_block", "_a", "_b"))
    ids, many = rows["_id"].to_numpy(), rows["_m"].to_numpy()
    side = rows["_side"].to_numpy()
    u = unit(matrix(rows["_v"].combine_chunks()))
    y = u @ plan.rotate
    left, right = np.flatnonzero(side == tile_a), np.flatnonzero(side == tile_b)
    part = plan.parts[block]

    def extended(at):
        x = y[at][:, part]
        s = (x * x).sum(1)[:, None]
        return np.hstack([-2 * x, s, np.ones_like(s)]).astype(np.float32), np.hstack([x, np.ones_like(s), s]).astype(np.float32)

    other = extended(right)[1].T
    count = np.zeros(len(ids), np.int64)
    links_a, links_b = [], []
    for k in range(0, len(left), ROWS):
        mine = left[k:k + ROWS]
        near = extended(mine)[0] @ other <= np.float32(plan.budgets[block] + 1e-5)
        i, j = np.flatnonzero(near.any(1)), np.flatnonzero(near.any(0))
        if not len(i):
            continue
        p, q = mine[i], right[j]
        link = u[p] @ u[q].T >= plan.cosine
        if tile_a == tile_b:
            link &= p[:, None] < q[None]
        link &= p[:, None] != q[None]
        for b in range(block + 1):                   # the first subspace in budget counts the pair
            x, z = y[p][:, plan.parts[b]], y[q][:, plan.parts[b]]
            inside = (x * x).sum(1)[:, None] + (z * z).sum(1) - 2 * x @ z.T <= plan.budgets[b]
            link &= inside if b == block else ~inside
        a, b = np.nonzero(link)
        if len(a):
            a, b = p[a], q[b]
            np.add.at(count, a, many[b])
            np.add.at(count, b, many[a])
            label = spanning(len(ids), a, b)          # keep a forest, not the pairs
            moved = np.flatnonzero(label != np.arange(len(ids)))
            links_a.append(moved)
            links_b.append(label[moved])
    if not links_a:
        return pa.table({"_id": pa.array([], pa.int64()), "_n": pa.array([], pa.int64()), "_root": pa.array([], pa.int64())})
    by_id = np.argsort(ids, kind="stable")           # labels: the smallest id, not the first place
    place = np.empty_like(by_id)
    place[by_id] = np.arange(len(ids))
    label = spanning(len(ids), place[np.concatenate(links_a)], place[np.concatenate(links_b)])
    root = ids[by_id[label[place]]]
    at = np.flatnonzero(count)
    return pa.table({"_id": pa.array(ids[at]), "_n": pa.array(count[at]), "_root": pa.array(root[at])})


def linked(vectors: DataFrame, dim: int, cosine: float) -> DataFrame:
    """(_id, _n, _root) partial link counts and forest edges among vectors (_id, _m, _v)."""
    spark = vectors.sparkSession
    n = vectors.count()
    rows = vectors.where(F.pmod(F.xxhash64("_id"), F.lit(max(1, n))) < SAMPLE).select("_v").limit(2 * SAMPLE).toArrow()["_v"]
    if not len(rows):
        rows = vectors.select("_v").limit(1).toArrow()["_v"]
    plan = Plan(matrix(rows.combine_chunks()), n, cosine)

    def count_cells(batches):
        for b in batches:
            y = unit(matrix(b.column(2))) @ plan.rotate
            out = []
            for block in range(len(plan.parts)):
                home, visit = plan.cells(y, block)
                h = np.bincount(home, minlength=visit.shape[1])
                out += [(block, c, int(h[c]), int(v)) for c, v in enumerate(visit.sum(0)) if h[c] or v]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.int64()) for k in range(4)], names=["b", "c", "h", "v"])

    for r in vectors.mapInArrow(count_cells, "b long, c long, h long, v long").groupBy("b", "c").agg(
            F.sum("h").alias("h"), F.sum("v").alias("v")).collect():     # one row per subspace and pivot
        plan.tiles[r["b"], r["c"]] = max(1, -(-r["h"] // TILE)), -(-r["v"] // TILE)
    shared = spark.sparkContext.broadcast(plan)

    def deal(batches):
        p = shared.value
        for batch in batches:
            ids = batch.column(0).to_numpy()
            y = unit(matrix(batch.column(2))) @ p.rotate
            sent: list[tuple[np.ndarray, int, int, int, int, int]] = []
            for block in range(len(p.parts)):
                home, visit = p.cells(y, block)
                for c in range(visit.shape[1]):
                    if (block, c) not in p.tiles:
                        continue
                    s, v = p.tiles[block, c]
                    own = np.flatnonzero(home == c)
                    for t in range(s):
                        at = own[tile_of(ids[own], s) == t]
                        sent += [(at, block, c, min(t, o), max(t, o), t) for o in range(s + v)]
                    guests = np.flatnonzero(visit[:, c])
                    for t in range(v):
                        at = guests[tile_of(ids[guests], v) == t]
                        sent += [(at, block, c, o, s + t, s + t) for o in range(s)]
            sent = [x for x in sent if len(x[0])]
            if not sent:
                continue
            at = np.concatenate([x[0] for x in sent])
            repeat = [np.repeat([x[k] for x in sent], [len(x[0]) for x in sent]) for k in range(1, 6)]
            for lo in range(0, len(at), 20_000):
                part = slice(lo, lo + 20_000)
                yield pa.RecordBatch.from_arrays([*(pa.array(r[part].astype(np.int32)) for r in repeat),
                                                  *(col.take(pa.array(at[part])) for col in batch.columns)],
                                                 names=["_block", "_cell", "_a", "_b", "_side", "_id", "_m", "_v"])

    kind = vectors.schema["_v"].dataType.simpleString()
    dealt = vectors.mapInArrow(deal, f"_block int, _cell int, _a int, _b int, _side int, _id long, _m long, _v {kind}")
    return dealt.groupBy("_block", "_cell", "_a", "_b").applyInArrow(lambda t: join_group(t, shared.value), "_id long, _n long, _root long")


def near_vectors(embeddings: DataFrame, cosine: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept."""
    rows = embeddings.select(F.col(id_col).cast("long").alias("_id"), F.col(vector_col).alias("_v"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    good = rows.where(F.col("_id").isNotNull() & F.col("_v").isNotNull()).groupBy("_id").agg(F.min("_v").alias("_v")) \
               .where(F.forall("_v", finite) & F.exists("_v", lambda x: x != 0))
    grouped = good.groupBy("_v").agg(F.min("_id").alias("_rep"), F.count(F.lit(1)).alias("_m"))
    reps = durable(grouped.select(F.col("_rep").alias("_id"), "_m", "_v"))
    parts = None
    for r in reps.groupBy(F.size("_v").alias("d")).count().where("count > 1").orderBy("d").collect():
        one = linked(reps.where(F.size("_v") == r["d"]), r["d"], cosine)
        parts = one if parts is None else parts.unionByName(one)
    out = rows.select("_id")
    members = good.join(reps.select(F.col("_id").alias("_rep"), "_m", F.col("_v").alias("_w")), F.col("_v") == F.col("_w")) \
                  .select(F.col("_id").alias("_node"), "_rep", "_m")
    if parts is not None:
        parts = durable(parts)
        counts = parts.groupBy(F.col("_id").alias("_rep")).agg(F.sum("_n").alias("_n"))
        comp = components(parts, "_id", "_root").select(F.col("id").alias("_rep"), F.col("component_id").alias("_comp"))
        members = members.join(counts, "_rep", "left").join(comp, "_rep", "left")
    else:
        members = members.withColumn("_n", F.lit(0)).withColumn("_comp", F.col("_rep"))
    out = out.join(members, F.col("_id") == F.col("_node"), "left")
    component = F.coalesce("_comp", "_rep", "_id")
    return out.select(F.col("_id").alias("vec_id"), (F.coalesce("_n", F.lit(0)) + F.coalesce("_m", F.lit(1)) - 1).cast("long").alias("n_links"),
                      component.alias("component_id"), F.coalesce(component == F.col("_id"), F.lit(True)).alias("kept"))


def op4_subspace_pigeonhole(spark, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))
