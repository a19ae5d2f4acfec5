"""Gradient-boosted trees for K classes (M5): softmax objective on distributed histograms.

Features are cut at quantiles into at most ``bins`` bins and staged as one byte per feature.  Every
round grows one tree per class, level by level.  A level is one pass over the staged rows: a
task recomputes margins and gradients of its rows in numpy, walks the unfinished trees, and adds
gradient and hessian sums per (class, node, feature, bin); the blocks are summed by
:func:`blocks.sum_blocks`, and the driver picks the splits from the final histogram alone:

    gain = (G_l^2 / (H_l + lambda) + G_r^2 / (H_r + lambda) - G^2 / (H + lambda)) / 2 - gamma

The histogram of a pass is held to ``HIST_BYTES`` by taking the classes in groups.  Margins are
staged anew every ``REBASE`` rounds, so a pass walks a bounded number of trees.  The loss of a
round (train and validation rows apart) comes from the next round's first pass; with ``patience``
training ends when the validation loss has not fallen for that many rounds and the best round
is kept.

Edge cases: a null or NaN feature value goes to the last bin (right of every split); rows with a
null label are left out; a feature without two distinct values has no split; ties of gain
(within 1e-9 of it) go to the first feature and bin; an empty training set is an error.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package, staged, values_df
from .blocks import dense_rows, features_column, slices, sum_blocks

HIST_BYTES = 64 << 20
REBASE = 10
TIE = 1e-9


class Tree:
    """One tree in arrays; node 0 is the root, ``feature`` -1 marks a leaf."""

    def __init__(self):
        self.feature, self.cut, self.left, self.right, self.value = [-1], [0], [0], [0], [0.0]

    def split(self, node: int, feature: int, cut: int) -> tuple[int, int]:
        left = len(self.feature)
        self.feature[node], self.cut[node], self.left[node], self.right[node] = feature, cut, left, left + 1
        for col, v in ((self.feature, -1), (self.cut, 0), (self.left, 0), (self.right, 0), (self.value, 0.0)):
            col += [v, v]
        return left, left + 1

    def nodes(self, goes_left) -> np.ndarray:
        """The leaf of every row; ``goes_left(feature, cut)`` tells it for arrays of both, by row."""
        feature, cut, left, right = (np.array(x) for x in (self.feature, self.cut, self.left, self.right))
        node = None
        while True:
            node = goes_left(None, None) if node is None else node
            inner = feature[node] >= 0
            if not inner.any():
                return node
            go = goes_left(np.where(inner, feature[node], 0), cut[node])
            node = np.where(inner, np.where(go, left[node], right[node]), node)


def on_bins(b: np.ndarray):
    rows = np.arange(len(b))
    return lambda f, c: np.zeros(len(b), dtype=np.int64) if f is None else b[rows, f] <= c


def softmax(m: np.ndarray) -> np.ndarray:
    e = np.exp(m - m.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


class BoostedTrees:
    """A fitted ensemble: ``trees[round][class]``, the cut values per feature and the loss ``log``."""

    def __init__(self, trees: list, cuts: list, k: int, log: list):
        self.trees, self.cuts, self.k, self.log = trees, cuts, k, log

    def margins(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.zeros((len(x), self.k)), np.arange(len(x))
        values = np.full((max(1, len(self.cuts)), max([1, *map(len, self.cuts)])), np.inf)
        for j, c in enumerate(self.cuts):
            values[j, :len(c)] = c

        def goes_left(f, c):
            return np.zeros(len(x), dtype=np.int64) if f is None else x[rows, f] < values[f, np.minimum(c, values.shape[1] - 1)]
        for rnd in self.trees:
            for k, t in enumerate(rnd):
                out[:, k] += np.array(t.value)[t.nodes(goes_left)]
        return out

    def transform(self, df: DataFrame, features: str = "features", out: str = "prediction") -> DataFrame:
        """Add ``scores`` (margins) and the argmax ``prediction``."""
        col = vector_to_array(F.col(features)) if isinstance(df.schema[features].dataType, VectorUDT) else F.col(features)
        ship_package(df.sparkSession)
        model, d = self, len(self.cuts)

        @F.pandas_udf("array<double>")
        def _scores(x: pd.Series) -> pd.Series:
            m = np.array([np.asarray(r, dtype=np.float64) for r in x]).reshape(len(x), d)
            return pd.Series(list(model.margins(m)))

        s = df.withColumn("scores", _scores(col))
        return s.withColumn(out, (F.array_position("scores", F.array_max("scores")) - 1).cast("double"))

    def history(self, spark: SparkSession) -> DataFrame:
        """(round, split, mlogloss), rounds from 1."""
        return values_df(spark, self.log, "round int, split string, mlogloss double")

    def table(self, spark: SparkSession) -> DataFrame:
        """The ensemble as rows: one per node."""
        rows = [(r, k, i, t.feature[i], float(self.cuts[t.feature[i]][t.cut[i]]) if t.feature[i] >= 0 else None, t.cut[i],
                 t.left[i], t.right[i], float(t.value[i]))
                for r, rnd in enumerate(self.trees) for k, t in enumerate(rnd) for i in range(len(t.feature))]
        return values_df(spark, rows, "round int, class int, node int, feature int, threshold double, bin int, left int, right int, value double")

    def save(self, spark: SparkSession, path: str) -> None:
        """Nodes, cut values and the loss log as Parquet tables below ``path``."""
        self.table(spark).write.mode("overwrite").parquet(f"{path}/nodes")
        values_df(spark, [(j, [float(v) for v in c]) for j, c in enumerate(self.cuts)], "feature int, cuts array<double>") \
            .write.mode("overwrite").parquet(f"{path}/cuts")
        self.history(spark).write.mode("overwrite").parquet(f"{path}/log")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "BoostedTrees":
        cuts = [r["cuts"] for r in sorted(spark.read.parquet(f"{path}/cuts").collect(), key=lambda r: r["feature"])]
        log = sorted((r["round"], r["split"], r["mlogloss"]) for r in spark.read.parquet(f"{path}/log").collect())
        trees: dict = {}
        for r in sorted(spark.read.parquet(f"{path}/nodes").collect(), key=lambda r: (r["round"], r["class"], r["node"])):
            t = trees.setdefault(r["round"], {}).setdefault(r["class"], Tree())
            if r["node"] == 0:
                t.feature, t.cut, t.left, t.right, t.value = [], [], [], [], []
            for col, v in ((t.feature, "feature"), (t.cut, "bin"), (t.left, "left"), (t.right, "right"), (t.value, "value")):
                col.append(r[v])
        rounds = [[t for _, t in sorted(trees[r].items())] for r in sorted(trees)]
        return BoostedTrees(rounds, cuts, len(rounds[0]) if rounds else 1, log)


def quantile_cuts(df: DataFrame, array_col: str, bins: int, d: int) -> list:
    """Distinct inner quantiles of every feature (a mergeable summary per feature, in the JVM)."""
    shares = [i / bins for i in range(1, bins)]
    each = df.select(F.posexplode(array_col).alias("j", "x")).where(F.col("x").isNotNull() & ~F.isnan("x"))
    got = each.groupBy("j").agg(F.percentile_approx("x", shares, F.lit(20 * bins)).alias("q"), F.min("x").alias("lo")).collect()
    out = {r["j"]: sorted({float(v) for v in r["q"] if v > r["lo"]}) for r in got}   # nothing lies below the least value
    return [out.get(j, []) for j in range(d)]


def stage_bins(df: DataFrame, features: str, label: str, validation_col: str | None, cuts: list) -> DataFrame:
    """Staged rows (b binary, y int, val boolean, m binary): a byte per feature, margins null."""
    ship_package(df.sparkSession)
    d = len(cuts)
    edges = [np.array(c) for c in cuts]
    val = F.coalesce(F.col(validation_col).cast("boolean"), F.lit(False)) if validation_col else F.lit(False)
    rows = df.where(F.col(label).isNotNull()).select(features_column(df, features).alias("x"), F.col(label).cast("int").alias("y"), val.alias("val"))

    def cut(batches):
        for part in slices(batches):
            x = dense_rows(part.column("x"), d)
            b = np.empty((len(x), d), dtype=np.uint8)
            for j in range(d):
                b[:, j] = np.searchsorted(edges[j], x[:, j], side="right")
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in b], pa.binary()), part.column("y"), part.column("val"),
                                              pa.nulls(len(x), pa.binary())], ["b", "y", "val", "m"])

    return staged(rows.mapInArrow(cut, "b binary, y int, val boolean, m binary"))


def _rows(part, d: int, k: int, since: list):
    """Bins, labels, validation marks and margins (staged ones plus the trees grown since)."""
    n = part.num_rows
    b = np.frombuffer(b"".join(part.column("b").to_pylist()), dtype=np.uint8).reshape(n, d)
    m = np.zeros((n, k))
    if n and part.column("m")[0].as_py() is not None:
        m = np.frombuffer(b"".join(part.column("m").to_pylist())).reshape(n, k).copy()
    goes = on_bins(b)
    for rnd in since:
        for c, t in enumerate(rnd):
            m[:, c] += np.array(t.value)[t.nodes(goes)]
    return b, part.column("y").to_numpy(zero_copy_only=False), part.column("val").to_numpy(zero_copy_only=False), m


def _loss(m, y, val) -> np.ndarray:
    """Loss and rows, train then validation."""
    p = np.maximum(softmax(m)[np.arange(len(y)), y], 1e-300)
    loss = -np.log(p)
    return np.array([loss[~val].sum(), (~val).sum(), loss[val].sum(), val.sum()])


def fit_boosted_trees(df: DataFrame, features: str = "features", label: str = "label", lr: float = 0.3, n_trees: int = 10,
                      max_depth: int = 6, gamma: float = 0.0, reg_lambda: float = 1.0, min_child_weight: float = 1.0,
                      validation_col: str | None = None, patience: int | None = None, bins: int = 64,
                      cuts: list | None = None) -> BoostedTrees:
    """M5: ``n_trees`` rounds of one tree per class; labels are codes 0..K-1.

    ``validation_col`` marks rows that are only scored; ``cuts`` fixes the cut values per feature
    (else quantiles of the training rows, at most 255 per feature)."""
    if not 2 <= bins <= 256:
        raise ValueError("bins must be between 2 and 256")
    as_array = vector_to_array(F.col(features)) if isinstance(df.schema[features].dataType, VectorUDT) else F.col(features)
    known = df.where(F.col(label).isNotNull())
    train = known.where(~F.coalesce(F.col(validation_col).cast("boolean"), F.lit(False))) if validation_col else known
    top = known.agg(F.max(F.col(label).cast("int")).alias("k"), F.max(F.size(as_array)).alias("d")).first()
    if top["k"] is None or not top["d"] or train.isEmpty():
        raise ValueError("empty training set")
    k, d = int(top["k"]) + 1, int(top["d"])
    if cuts is None:
        cuts = quantile_cuts(train.select(as_array.cast("array<double>").alias("x")), "x", bins, d)
    cuts = [sorted(c) for c in cuts]
    width = max(len(c) + 1 for c in cuts)
    data = stage_bins(df, features, label, validation_col, cuts)
    trees: list = []
    base, log = 0, []

    def histograms(grown: list, since: list, slots: list, classes: list, with_loss: bool) -> dict:
        def work(batches):
            out = {c: np.zeros((len(slots[c]), d, width, 2)) for c in classes}
            loss = np.zeros(4)
            feature = np.arange(d)
            for part in slices(batches):
                b, y, val, m = _rows(part, d, k, since)
                if with_loss:
                    loss += _loss(m, y, val)
                p = softmax(m)
                goes = on_bins(b)
                for c in classes:
                    place = np.full(len(grown[c].feature), -1)
                    place[slots[c]] = np.arange(len(slots[c]))
                    at = place[grown[c].nodes(goes)]
                    use = (at >= 0) & ~val
                    g = p[use, c] - (y[use] == c)
                    h = np.maximum(2 * p[use, c] * (1 - p[use, c]), 1e-16)
                    index = ((at[use][:, None] * d + feature) * width + b[use]).ravel()
                    size = len(slots[c]) * d * width
                    for i, v in enumerate((g, h)):
                        out[c][..., i] += np.bincount(index, weights=np.repeat(v, d), minlength=size).reshape(-1, d, width)
            return out | ({k: loss} if with_loss else {})
        return sum_blocks(data, work)

    def note(loss, rnd: int) -> None:
        log.append((rnd, "train", float(loss[0] / loss[1])))
        if loss[3]:
            log.append((rnd, "validation", float(loss[2] / loss[3])))

    def best_split(hist: np.ndarray):
        """(feature, bin, sums left, sums right) of one node's histogram, or None."""
        left = hist.cumsum(axis=1)
        total = left[0, -1]
        right = total - left
        ok = (left[..., 1] >= min_child_weight) & (right[..., 1] >= min_child_weight)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = (left[..., 0] ** 2 / (left[..., 1] + reg_lambda) + right[..., 0] ** 2 / (right[..., 1] + reg_lambda)
                    - total[0] ** 2 / (total[1] + reg_lambda)) / 2 - gamma
        gain = np.where(ok, gain, -np.inf)
        top = gain.max() if gain.size else -np.inf
        if not top > 0:
            return None
        f, c = divmod(int(np.flatnonzero(gain.ravel() >= top * (1 - TIE))[0]), width)
        return f, c, left[f, c], right[f, c]

    def stop() -> bool:
        held = [v for _, s, v in log if s == "validation"]
        return patience is not None and len(held) > patience and min(held[-patience:]) >= min(held[:-patience])

    def grow(rnd: int) -> list | None:
        """The trees of a round; None if there is no such round, which only scores the last one."""
        grown, slots, sums = [Tree() for _ in range(k)], [[0] for _ in range(k)], [{} for _ in range(k)]
        for level in range(max_depth if rnd < n_trees else 1):
            live = [c for c in range(k) if slots[c]]
            if not live:
                break
            room = max(1, HIST_BYTES // max(1, max(len(slots[c]) for c in live) * d * width * 16))
            for start in range(0, len(live), room):
                group, first = live[start:start + room] if rnd < n_trees else [], level == 0 and start == 0
                got = histograms(grown, trees[base:], slots, group, first)
                if first and rnd > 0:
                    note(got[k], rnd)
                if first and (rnd == n_trees or stop()):
                    return None
                for c in group:
                    hist = got[c].reshape(len(slots[c]), d, width, 2)
                    if level == 0:
                        sums[c][0] = hist[0, 0].sum(axis=0)
                    following = []
                    for node, own in zip(slots[c], hist):
                        found = best_split(own)
                        if found:
                            f, cut_at, *both = found
                            children = grown[c].split(node, f, cut_at)
                            sums[c].update(zip(children, both))
                            following += children
                    slots[c] = following
        for c, t in enumerate(grown):
            for node, (g, h) in sums[c].items():
                if t.feature[node] < 0:
                    t.value[node] = -lr * float(g) / (float(h) + reg_lambda)
        return grown

    while (grown := grow(len(trees))) is not None:
        trees.append(grown)
        if len(trees) - base >= REBASE:
            data, base = _rebase(data, d, k, trees[base:]), len(trees)
    held = [(v, r) for r, s, v in log if s == "validation"]
    keep = min(held)[1] if patience is not None and held else len(trees)
    return BoostedTrees(trees[:keep], cuts, k, log)


def _rebase(data: DataFrame, d: int, k: int, since: list) -> DataFrame:
    """The staged rows with the margins that the trees ``since`` give."""
    def run(batches):
        for part in slices(batches):
            _, _, _, m = _rows(part, d, k, since)
            yield pa.RecordBatch.from_arrays([part.column("b"), part.column("y"), part.column("val"),
                                              pa.array([r.tobytes() for r in m], pa.binary())], ["b", "y", "val", "m"])
    return staged(data.mapInArrow(run, "b binary, y int, val boolean, m binary"))
