"""Ridge one-vs-all on wide sparse rows by conjugate gradients (M2), and its grid (M6).

The normal equations (Xc'W Xc + alpha I) B = Xc'W Yc, X centred by its weighted means and Y in -1 / +1,
are solved for all classes, grid points and folds at once.  A step needs one product
X'W(X V), a sparse aggregate over the rows; centring is a rank-one correction, so no row is made
dense and no d x d matrix exists.  A step's block takes 8 d K bytes per model.  The diagonal
preconditions.  Systems that have reached ``tol`` (residual over right side) stop; the number of passes is that of the slowest one.

``tol`` is that of the reference's grid; solvers there (svd, cholesky, lsqr, sparse_cg, sag) reach the
same coefficients, so ``solver`` is no axis here.  Rows with a null label are left out; a null
vector counts as zeros; an empty training set is an error.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import staged, values_df
from .blocks import features_column, slices, sparse_rows, sum_blocks, vector_length
from .linear import LinearModel
from .split import kfold


@dataclass(frozen=True)
class Ridge:
    alpha: float
    balanced: bool = False
    held_out: int | None = None


class SparseRows:
    """Staged rows (x, y, fold) and the products that conjugate gradients ask of them."""

    def __init__(self, df: DataFrame, features: str, label: str, fold_col: str | None = None):
        fold = F.col(fold_col).cast("int") if fold_col else F.lit(-1)
        self.rows = staged(df.where(F.col(label).isNotNull()).select(
            features_column(df, features).alias("x"), F.col(label).cast("int").alias("y"), fold.alias("f")))
        counts = self.rows.groupBy("f", "y").agg(F.count(F.lit(1)).alias("n"), F.max(vector_length(self.rows, "x")).alias("d")).collect()
        if not counts:
            raise ValueError("empty training set")
        self.d, self.k = max(r["d"] for r in counts), max(r["y"] for r in counts) + 1
        self.counts = {(r["f"], r["y"]): r["n"] for r in counts}
        self.folds = sorted({f for f, _ in self.counts})
        self.passes = 0

    def class_weights(self, spec: Ridge) -> tuple[np.ndarray, np.ndarray]:
        n = np.zeros(self.k)
        for (f, y), c in self.counts.items():
            n[y] += c if f != spec.held_out else 0
        if not n.sum():
            raise ValueError("empty training set")
        if not spec.balanced:
            return np.ones(self.k), n
        return np.divide(n.sum(), (n > 0).sum() * n, out=np.zeros(self.k), where=n > 0), n

    def sums(self, specs: dict) -> dict:
        """{model: (sum w x by class, diagonal of X'WX)} in one pass: per fold and class."""
        self.passes += 1
        d, k, folds = self.d, self.k, self.folds

        def work(batches):
            out = {f: np.zeros((2 * k, d)) for f in folds}
            for part in slices(batches):
                rows, place, value = sparse_rows(part.column("x"))
                value = np.nan_to_num(value)
                y, fold = (part.column(c).to_numpy(zero_copy_only=False) for c in ("y", "f"))
                for f in np.unique(fold):
                    use = fold[rows] == f
                    at = y[rows[use]] * d + place[use]
                    out[int(f)][:k] += np.bincount(at, weights=value[use], minlength=k * d).reshape(k, d)
                    out[int(f)][k:] += np.bincount(at, weights=value[use] ** 2, minlength=k * d).reshape(k, d)
            return out

        per = {f: v.reshape(2 * k, d) for f, v in sum_blocks(self.rows, work).items()}
        out = {}
        for i, (spec, cw) in specs.items():
            both = sum(v for f, v in per.items() if f != spec.held_out)
            out[i] = cw[:, None] * both[:k], cw @ both[k:]
        return out

    def product(self, points: dict) -> dict:
        """{model: X'W(X V)} at ``points`` {model: (spec, class weights, V)}."""
        self.passes += 1
        d, k = self.d, self.k

        def work(batches):
            out = {i: np.zeros((k, d)) for i in points}
            for part in slices(batches):
                rows, place, value = sparse_rows(part.column("x"))
                value = np.nan_to_num(value)
                y, fold = (part.column(c).to_numpy(zero_copy_only=False) for c in ("y", "f"))
                for i, (spec, cw, v) in points.items():
                    use = slice(None) if spec.held_out is None else fold[rows] != spec.held_out
                    r, p, x = rows[use], place[use], value[use]
                    if not len(r):
                        continue
                    starts = np.flatnonzero(np.concatenate(([True], r[1:] != r[:-1])))
                    u = np.add.reduceat(x[:, None] * v[p], starts, axis=0) * cw[y[r[starts]]][:, None]
                    each = np.repeat(u, np.diff(np.concatenate((starts, [len(r)]))), axis=0) * x[:, None]
                    for c in range(k):
                        out[i][c] += np.bincount(p, weights=each[:, c], minlength=d)
            return out
        return {i: v.reshape(k, d).T for i, v in sum_blocks(self.rows, work).items()}

    def hits(self, models: dict) -> dict:
        """{model: (right, rows)} on each model's held-out fold (all rows if it has none), one pass."""
        self.passes += 1

        def work(batches):
            out = {i: np.zeros(2) for i in models}
            for part in slices(batches):
                rows, place, value = sparse_rows(part.column("x"))
                value = np.nan_to_num(value)
                y, fold = (part.column(c).to_numpy(zero_copy_only=False) for c in ("y", "f"))
                starts = np.flatnonzero(np.concatenate(([True], rows[1:] != rows[:-1]))) if len(rows) else np.zeros(0, int)
                for i, (spec, coef, intercept) in models.items():
                    s = np.tile(intercept, (len(y), 1))
                    if len(rows):
                        s[rows[starts]] += np.add.reduceat(value[:, None] * coef.T[place], starts, axis=0)
                    use = np.ones(len(y), bool) if spec.held_out is None else fold == spec.held_out
                    out[i] += (s[use].argmax(axis=1) == y[use]).sum(), use.sum()
            return out
        return {i: (int(v[0]), int(v[1])) for i, v in sum_blocks(self.rows, work).items()}

    def fit(self, specs: list[Ridge], tol: float = 1e-4, max_iter: int = 1000) -> list[LinearModel]:
        """Coefficients of every spec, all advanced together."""
        ready = {i: (s, *self.class_weights(s)) for i, s in enumerate(specs)}
        sums = self.sums({i: (s, cw) for i, (s, cw, _) in ready.items()})
        state = {}
        for i, (s, cw, n) in ready.items():
            by_class, diagonal = sums[i]
            w = cw * n
            total, mean = w.sum(), by_class.sum(axis=0) / w.sum()
            ybar = (2 * w - total) / total
            b = (2 * by_class - by_class.sum(axis=0)).T - total * np.outer(mean, ybar)      # Xc'W Yc
            scale = np.maximum(diagonal - total * mean ** 2, 0) + s.alpha
            scale[scale <= 0] = 1.0
            z = b / scale[:, None]
            state[i] = {"x": np.zeros_like(b), "r": b.copy(), "p": z.copy(), "rz": (b * z).sum(axis=0), "scale": scale, "mean": mean,
                        "total": total, "ybar": ybar, "goal": tol * np.linalg.norm(b, axis=0), "live": np.linalg.norm(b, axis=0) > 0}
        for _ in range(max_iter):
            points = {i: (ready[i][0], ready[i][1], m["p"]) for i, m in state.items() if m["live"].any()}
            if not points:
                break
            for i, xxp in self.product(points).items():
                m, on = state[i], state[i]["live"]
                p = m["p"]
                ap = xxp - m["total"] * np.outer(m["mean"], m["mean"] @ p) + specs[i].alpha * p
                curve = (p * ap).sum(axis=0)
                a = np.where(on & (curve > 0), m["rz"] / np.where(curve > 0, curve, 1), 0.0)
                m["x"] += a * p
                m["r"] -= a * ap
                z = m["r"] / m["scale"][:, None]
                rz = (m["r"] * z).sum(axis=0)
                m["live"] = on & (curve > 0) & (np.linalg.norm(m["r"], axis=0) > m["goal"])
                m["p"] = np.where(m["live"], z + np.where(m["rz"] > 0, rz / np.where(m["rz"] > 0, m["rz"], 1), 0.0) * p, 0.0)
                m["rz"] = rz
        return [LinearModel(state[i]["x"].T, state[i]["ybar"] - state[i]["mean"] @ state[i]["x"], list(range(self.k))) for i in range(len(specs))]


def fit_ridge_cg(df: DataFrame, features: str = "features", label: str = "label", alpha: float = 1.0, class_weight: str | None = None,
                 tol: float = 1e-4, max_iter: int = 1000) -> LinearModel:
    """M2 on sparse rows of any width: as :func:`models.fit_ridge`, without a d x d matrix."""
    return SparseRows(df, features, label).fit([Ridge(alpha, class_weight == "balanced")], tol, max_iter)[0]


def ridge_cg_grid(df: DataFrame, alphas, class_weights=(None,), tol: float = 1e-4, folds: int = 3, features: str = "features",
                  label: str = "label", key: str = "row_id", seed: int = 42, max_iter: int = 1000):
    """M6 for ridge on sparse rows: every alpha and class weight on stratified seeded folds, fitted together.
    Returns ``(best model refitted on all rows, table (alpha, class_weight, cv_accuracy))``."""
    rows = SparseRows(kfold(df, folds, label, key, seed, "_nf_fold"), features, label, "_nf_fold")
    grid = [(a, cw) for a in alphas for cw in class_weights]
    specs = [Ridge(a, cw == "balanced", f) for a, cw in grid for f in rows.folds]
    fits = rows.fit(specs, tol, max_iter)
    hits = rows.hits({i: (s, m.coef, m.intercept) for i, (s, m) in enumerate(zip(specs, fits))})
    mean = {g: float(np.mean([hits[i][0] / hits[i][1] for i, s in enumerate(specs) if (s.alpha, s.balanced) == (g[0], g[1] == "balanced")])) for g in grid}
    best = max(grid, key=lambda g: (mean[g], -grid.index(g)))
    model = rows.fit([Ridge(best[0], best[1] == "balanced")], tol, max_iter)[0]
    model.passes, model.params = rows.passes, best
    return model, values_df(df.sparkSession, [(float(a), cw or "none", mean[a, cw]) for a, cw in grid], "alpha double, class_weight string, cv_accuracy double")
