"""Many L2 multinomial logistic regressions fitted together (M1, M6, M7).

All folds and grid points of a search advance in step: one pass over the staged rows evaluates
loss and gradient of every unfinished model at its next trial point, as one block per model
(:func:`blocks.sum_blocks`), and the driver moves each model by L-BFGS with backtracking.  The
number of passes is that of the slowest model, whatever the size of the grid.  Each model sees
the rows outside its held-out fold, with its own class weights.  The objective is

    sum(w * loss) / sum(w) + reg / 2 * |coef|^2        (intercepts are not penalised)

which is that of :func:`models.fit_logreg` with ``reg = 1 / (C n)``.

Edge cases: rows with a null label are left out; a null vector counts as zeros; classes without
rows in a fold get weight 0 under ``balanced``; an empty training set is an error.
"""

from __future__ import annotations

from collections import deque
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import staged, values_df
from .blocks import dense_rows, features_column, slices, sum_blocks, vector_length
from .linear import LinearModel
from .split import kfold

MEMORY = 10          # L-BFGS steps remembered per model
ARMIJO = 1e-4


@dataclass(frozen=True)
class Spec:
    """One model of a block: ``C`` as in sklearn, class weights, and the fold it must not see."""
    C: float
    balanced: bool = False
    held_out: int | None = None


class Descent:
    """L-BFGS with backtracking as a state machine: evaluate at ``trial``, then ``tell``."""

    def __init__(self, size: int, tol: float):
        self.x = np.zeros(size)
        self.trial, self.f, self.g, self.step, self.way = self.x, None, None, 1.0, None
        self.pairs: deque = deque(maxlen=MEMORY)
        self.tol, self.done, self.rounds = tol, False, 0

    def _direction(self) -> np.ndarray:
        q, held = self.g.copy(), []
        for s, y in reversed(self.pairs):
            a = (s @ q) / (s @ y)
            q -= a * y
            held.append(a)
        if self.pairs:
            s, y = self.pairs[-1]
            q *= (s @ y) / (y @ y)
        for (s, y), a in zip(self.pairs, reversed(held)):
            q += s * (a - (y @ q) / (s @ y))
        return -q

    def tell(self, f: float, g: np.ndarray) -> None:
        if self.f is not None:
            if f > self.f + ARMIJO * self.step * (self.way @ self.g) + 1e-15 * abs(self.f):
                self.step /= 2
                if self.step < 1e-12:        # no descent left in double precision
                    self.done = True
                self.trial = self.x + self.step * self.way
                return
            s, y = self.trial - self.x, g - self.g
            if s @ y > 1e-12 * (y @ y):
                self.pairs.append((s, y))
        self.x, self.f, self.g = self.trial, f, g
        self.rounds += 1
        if np.abs(g).max() <= self.tol:
            self.done = True
            return
        self.way = self._direction()
        if self.way @ self.g >= 0:
            self.pairs.clear()
            self.way = -self.g
        self.step = 1.0 if self.pairs else min(1.0, 1.0 / np.linalg.norm(self.g))
        self.trial = self.x + self.step * self.way


class Block:
    """Staged rows (x, y, fold) with their shape and class counts per fold."""

    def __init__(self, df: DataFrame, features: str, label: str, fold_col: str | None = None):
        fold = F.col(fold_col).cast("int") if fold_col else F.lit(-1)
        rows = df.where(F.col(label).isNotNull()).select(features_column(df, features).alias("x"), F.col(label).cast("int").alias("y"), fold.alias("f"))
        self.rows = staged(rows)
        counts = self.rows.groupBy("f", "y").agg(F.count(F.lit(1)).alias("n"), F.max(vector_length(self.rows, "x")).alias("d")).collect()
        if not counts:
            raise ValueError("empty training set")
        self.d, self.k = max(r["d"] for r in counts), max(r["y"] for r in counts) + 1
        self.counts = {(r["f"], r["y"]): r["n"] for r in counts}
        self.passes = 0

    def weights(self, spec: Spec) -> np.ndarray:
        """Weight of a row by class, for the rows the model sees."""
        n = np.zeros(self.k)
        for (f, y), c in self.counts.items():
            if spec.held_out is None or f != spec.held_out:
                n[y] += c
        if not n.sum():
            raise ValueError("empty training set")
        w = np.ones(self.k)
        if spec.balanced:
            w = np.divide(n.sum(), (n > 0).sum() * n, out=np.zeros(self.k), where=n > 0)
        return w, n

    def evaluate(self, points: dict) -> dict:
        """{model: flat (loss, gradient)} sums at ``points`` {model: (spec, class weights, W)}."""
        self.passes += 1
        d, k = self.d, self.k

        def work(batches):
            out = {i: np.zeros(1 + k * (d + 1)) for i in points}
            for part in slices(batches):
                x = np.hstack([dense_rows(part.column("x"), d), np.ones((part.num_rows, 1))])
                x = np.nan_to_num(x)
                y, fold = (part.column(c).to_numpy(zero_copy_only=False) for c in ("y", "f"))
                for i, (spec, cw, w) in points.items():
                    use = slice(None) if spec.held_out is None else fold != spec.held_out
                    xs, ys = x[use], y[use]
                    m = xs @ w.T
                    m -= m.max(axis=1, keepdims=True)
                    e = np.exp(m)
                    total = e.sum(axis=1)
                    rw, rows = cw[ys], np.arange(len(ys))
                    out[i][0] += (rw * (np.log(total) - m[rows, ys])).sum()
                    p = e / total[:, None]
                    p[rows, ys] -= 1
                    out[i][1:] += ((p * rw[:, None]).T @ xs).ravel()
            return out
        return sum_blocks(self.rows, work)

    def fit(self, specs: list[Spec], max_iter: int = 100, tol: float = 1e-6) -> list[np.ndarray]:
        """Coefficients (K x d+1, intercept last) of every spec."""
        shape = (self.k, self.d + 1)
        state = [Descent(shape[0] * shape[1], tol) for _ in specs]
        ready = []
        for s in specs:
            cw, n = self.weights(s)
            ready.append((cw, (cw * n).sum(), 1.0 / (s.C * n.sum())))
        penalised = np.ones(shape)
        penalised[:, -1] = 0
        while True:
            live = [i for i, m in enumerate(state) if not m.done and m.rounds <= max_iter]
            if not live:
                return [m.x.reshape(shape) for m in state]
            got = self.evaluate({i: (specs[i], ready[i][0], state[i].trial.reshape(shape)) for i in live})
            for i in live:
                _, total, reg = ready[i]
                w = state[i].trial * penalised.ravel()
                state[i].tell(got[i][0] / total + reg / 2 * (w @ w), got[i][1:] / total + reg * w)

    def hits(self, models: dict) -> dict:
        """{model: (right, rows)} on each model's held-out fold (all rows if it has none), one pass."""
        self.passes += 1
        d = self.d

        def work(batches):
            out = {i: np.zeros(2) for i in models}
            for part in slices(batches):
                x = np.nan_to_num(np.hstack([dense_rows(part.column("x"), d), np.ones((part.num_rows, 1))]))
                y, fold = (part.column(c).to_numpy(zero_copy_only=False) for c in ("y", "f"))
                for i, (spec, w) in models.items():
                    use = slice(None) if spec.held_out is None else fold == spec.held_out
                    out[i] += ((x[use] @ w.T).argmax(axis=1) == y[use]).sum(), len(y[use])
            return out
        return {i: (int(v[0]), int(v[1])) for i, v in sum_blocks(self.rows, work).items()}


def logreg_grid(df: DataFrame, Cs, class_weights=(None,), folds: int = 3, features: str = "features", label: str = "label",
                key: str = "row_id", seed: int = 42, max_iter: int = 100, tol: float = 1e-6):
    """M6 for logistic regression: every C and class weight, cross-validated on stratified seeded
    folds in one block, then the best (highest mean accuracy, first in grid order) refitted on all rows.

    Returns ``(model, table)``, the table (C, class_weight, cv_accuracy: mean over folds) and the
    model with its pass count as ``passes``."""
    block = Block(kfold(df, folds, label, key, seed, "_nf_fold"), features, label, "_nf_fold")
    grid = [(c, cw) for c in Cs for cw in class_weights]
    specs = [Spec(c, cw == "balanced", f) for c, cw in grid for f in range(folds)]
    specs = [s for s in specs if any(f == s.held_out for f, _ in block.counts)]
    hits = block.hits({i: (s, w) for i, (s, w) in enumerate(zip(specs, block.fit(specs, max_iter, tol)))})
    scores = {g: [] for g in grid}
    for i, s in enumerate(specs):
        scores[s.C, "balanced" if s.balanced else None].append(hits[i][0] / hits[i][1])
    mean = {g: float(np.mean(v)) for g, v in scores.items()}
    best = max(grid, key=lambda g: (mean[g], -grid.index(g)))
    w = block.fit([Spec(best[0], best[1] == "balanced")], max_iter, tol)[0]
    model = LinearModel(w[:, :-1], w[:, -1], list(range(block.k)))
    model.passes, model.params = block.passes, best
    table = values_df(df.sparkSession, [(float(c), cw or "none", mean[c, cw]) for c, cw in grid], "C double, class_weight string, cv_accuracy double")
    return model, table
