"""Linear discriminant analysis (M3) with the solvers ``lsqr``, ``eigen`` and ``svd``, and its grid.

* ``lsqr`` and ``eigen`` work on the pooled covariance from one pass of moments, shrunk by a
  share or by Ledoit-Wolf ('auto'); ``eigen`` solves the generalised problem of between- and
  within-class scatter and keeps the projections.
* ``svd`` never forms a covariance: a tall-skinny QR gives each task's R factor of its rows
  centred within their class, R factors are merged two by two in a tree, and the singular values
  of the last one rank the directions (``tol``).  It takes no shrinkage.
* The grid needs two passes of its own, whatever its size: moments per fold and, for ``svd``, R
  factors per fold.  The training part of a fold is the total minus its moments; its R factor
  stacks the other folds' factors with the shifts of their class means.

Scores are ``x coef' + intercept``; ``scalings`` and ``center`` project rows.  Rows with a null label
are left out; a class without rows is never predicted; equal accuracies go to the first grid point.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import staged, values_df
from .blocks import dense_rows, features_column, slices, sum_blocks
from .linear import LinearModel, all_of, minus, moments, moments_by_group
from .split import kfold

SCATTER_BYTES = 256 << 20      # class covariances a task holds at once
FAN_IN = 8                     # R factors merged by one task


class Discriminant(LinearModel):
    """A linear model that also projects: ``(x - center) @ scalings``."""

    def __init__(self, coef, intercept, classes, scalings=None, center=None):
        super().__init__(coef, intercept, classes)
        self.scalings, self.center = scalings, center

    def project(self, df: DataFrame, features: str = "features", out: str = "projected") -> DataFrame:
        """Rows on the discriminant directions, best first (``scores`` of a linear model)."""
        if self.scalings is None:
            raise ValueError("the solver lsqr has no projection")
        flat = LinearModel(self.scalings.T, -self.center @ self.scalings, list(range(self.scalings.shape[1])))
        return flat.transform(df, features, "_nf_p").drop("_nf_p").withColumnRenamed("scores", out)


def _means(m: dict) -> np.ndarray:
    mu = np.zeros_like(m["cs"])
    present = m["cw"] > 0
    mu[present] = m["cs"][present] / m["cw"][present, None]
    return mu


def _log_priors(m: dict) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.log(m["cw"] / m["sw"])


def _shrunk(cov: np.ndarray, share: float | None) -> np.ndarray:
    if not share:
        return cov
    return (1 - share) * cov + share * (np.trace(cov) / len(cov)) * np.eye(len(cov))


def pooled(m: dict) -> np.ndarray:
    """Within-class covariance (divided by all rows)."""
    mu = _means(m)
    return (m["xtx"] - (mu.T * m["cw"]) @ mu) / m["sw"]


def lda_from_moments(m: dict, shrinkage: float | None = None, cov: np.ndarray | None = None, solver: str = "lsqr") -> Discriminant:
    """``lsqr`` or ``eigen`` from moments; ``cov`` gives the within-class covariance instead of a share."""
    mu, classes = _means(m), list(range(m["k"]))
    within = _shrunk(pooled(m), shrinkage) if cov is None else cov
    if solver == "lsqr":
        coef, scalings = np.linalg.lstsq(within, mu.T, rcond=None)[0].T, None
    elif solver == "eigen":
        center = m["sx"] / m["sw"]
        total = _shrunk(m["xtx"] / m["sw"] - np.outer(center, center), shrinkage)
        root = np.linalg.cholesky(within)                      # the problem's metric: B v = e W v
        half = np.linalg.solve(root, np.linalg.solve(root, (total - within).T).T)
        values, vectors = np.linalg.eigh((half + half.T) / 2)
        scalings = np.linalg.solve(root.T, vectors[:, ::-1])
        coef = mu @ scalings @ scalings.T
        scalings = scalings[:, :max(1, min(int((m["cw"] > 0).sum()) - 1, m["d"]))]
    else:
        raise ValueError(f"unknown solver {solver}")
    intercept = -0.5 * np.einsum("kd,kd->k", mu, coef) + _log_priors(m)
    return Discriminant(coef, intercept, classes, scalings, m["sx"] / m["sw"])


def lda_from_factor(m: dict, r: np.ndarray, tol: float = 1e-4) -> Discriminant:
    """``svd`` from the R factor of the rows centred within their class and the class moments."""
    n, k = m["sw"], int((m["cw"] > 0).sum())
    mu, center = _means(m), m["sx"] / m["sw"]
    dev = np.sqrt((r ** 2).sum(axis=0) / n)
    dev[dev == 0] = 1.0
    _, s, vt = np.linalg.svd(np.sqrt(1.0 / (n - k)) * r / dev, full_matrices=False)
    rank = int((s > tol).sum())
    scalings = (vt[:rank] / dev).T / s[:rank]
    between = (np.sqrt(m["cw"] / (k - 1))[:, None] * (mu - center)) @ scalings
    _, s, vt = np.linalg.svd(between, full_matrices=False)
    rank = int((s > tol * s[0]).sum()) if len(s) and s[0] > 0 else 0
    scalings = scalings @ vt.T[:, :rank]
    coef = (mu - center) @ scalings
    intercept = -0.5 * (coef ** 2).sum(axis=1) + _log_priors(m)
    coef = coef @ scalings.T
    return Discriminant(coef, intercept - center @ coef.T, list(range(m["k"])), scalings, center)


# ---------------------------------------------------------------- tall-skinny QR

_R = "g int, p int, r binary"


def _r_batch(g: int, p: int, r: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([g], pa.int32()), pa.array([p], pa.int32()), pa.array([r.tobytes()], pa.binary())], ["g", "p", "r"])


def r_factors(df: DataFrame, features: str, label: str, centers: dict, d: int, group: str | None = None) -> dict:
    """R factor of the rows of every group, each row less the centre of its (group, class)."""
    x = df.where(F.col(label).isNotNull()).select(features_column(df, features).alias("x"), F.col(label).cast("int").alias("y"),
                                                  (F.col(group).cast("int") if group else F.lit(0)).alias("g"))
    tasks = max(1, df.sparkSession.sparkContext.defaultParallelism)

    def first(batches):
        from pyspark import TaskContext
        task, acc = TaskContext.get().partitionId(), {}
        for part in slices(batches):
            xs = np.nan_to_num(dense_rows(part.column("x"), d))
            y, g = (part.column(c).to_numpy(zero_copy_only=False) for c in ("y", "g"))
            for own in np.unique(g):
                rows = xs[g == own] - centers[int(own)][y[g == own]]
                acc[int(own)] = np.linalg.qr(np.vstack([acc[int(own)], rows]) if int(own) in acc else rows, mode="r")
        for own, r in acc.items():
            yield _r_batch(own, task, r)

    def merge(batches):
        at, r = None, None
        for batch in batches:
            for g, p, blob in zip(*(batch.column(c).to_pylist() for c in ("g", "p", "r"))):
                other = np.frombuffer(blob).reshape(-1, d)
                if at == (g, p):
                    r = np.linalg.qr(np.vstack([r, other]), mode="r")
                    continue
                if at is not None:
                    yield _r_batch(*at, r)
                at, r = (g, p), other
        if at is not None:
            yield _r_batch(*at, r)

    parts = x.coalesce(tasks).mapInArrow(first, _R)
    while tasks > 1:      # FAN_IN factors become one, until one per group is left
        tasks = -(-tasks // FAN_IN)
        parts = parts.withColumn("p", (F.col("p") / FAN_IN).cast("int")).repartition("g", "p").sortWithinPartitions("g", "p").mapInArrow(merge, _R)
    return {row["g"]: np.frombuffer(bytes(row["r"])).reshape(-1, d) for row in parts.collect()}


# ---------------------------------------------------------------- fits

def ledoit_wolf(cov: np.ndarray, n: float, fourth: float) -> np.ndarray:
    """Shrunk covariance of n centred rows, from their covariance and the sum of their squared
    squared norms (Ledoit and Wolf 2004)."""
    p = len(cov)
    mu = np.trace(cov) / p
    spread = (cov ** 2).sum()
    delta = (spread - p * mu ** 2) / p
    beta = min((fourth / n - spread) / (p * n), delta)
    s = beta / delta if beta > 0 and delta > 0 else 0.0
    return (1 - s) * cov + s * mu * np.eye(p)


def auto_covariance(df: DataFrame, features: str, label: str, m: dict) -> np.ndarray:
    """Ledoit-Wolf shrinkage of every class's standardised covariance, weighted by the class
    shares.  Class moments are taken in groups of classes that fit ``SCATTER_BYTES``; one more
    pass sums the fourth moments of all classes."""
    d, present = m["d"], [c for c in range(m["k"]) if m["cw"][c] > 0]
    mu, stats = _means(m), {}
    at_once = max(1, SCATTER_BYTES // (8 * d * d))
    for start in range(0, len(present), at_once):
        some = df.where(F.col(label).cast("int").isin(present[start:start + at_once]))
        for c, own in moments_by_group(some, features, label, label).items():
            cov = own["xtx"] / own["sw"] - np.outer(mu[c], mu[c])
            dev = np.sqrt(np.clip(np.diag(cov), 0, None))
            stats[c] = np.where(dev > 0, dev, 1.0), cov
    devs = np.ones((m["k"], d))
    for c, (dev, _) in stats.items():
        devs[c] = dev
    rows = df.where(F.col(label).isNotNull()).select(features_column(df, features).alias("x"), F.col(label).cast("int").alias("y"))

    def fourth(batches):
        out = np.zeros(m["k"])
        for part in slices(batches):
            y = part.column("y").to_numpy(zero_copy_only=False)
            z = (np.nan_to_num(dense_rows(part.column("x"), d)) - mu[y]) / devs[y]
            out += np.bincount(y, weights=(z * z).sum(axis=1) ** 2, minlength=m["k"])
        return {0: out}

    got = sum_blocks(rows, fourth)[0]
    return sum(m["cw"][c] / m["sw"] * dev[:, None] * ledoit_wolf(cov / dev[:, None] / dev, m["cw"][c], got[c]) * dev
               for c, (dev, cov) in stats.items())


def fit_lda(df: DataFrame, features: str = "features", label: str = "label", shrinkage: float | str | None = None,
            solver: str = "lsqr", tol: float = 1e-4) -> Discriminant:
    """M3: ``solver`` lsqr, eigen or svd; ``shrinkage`` None, a share, or 'auto' (not for svd)."""
    m = moments(df, features, label)
    if solver == "svd":
        if shrinkage is not None:
            raise ValueError("the solver svd takes no shrinkage")
        return lda_from_factor(m, r_factors(df, features, label, {0: _means(m)}, m["d"])[0], tol)
    if shrinkage == "auto":
        return lda_from_moments(m, None, auto_covariance(df, features, label, m), solver)
    return lda_from_moments(m, shrinkage, None, solver)


def lda_grid_cv(df: DataFrame, shrinkages=(None,), solvers=("lsqr",), tols=(1e-4,), folds: int = 3, features: str = "features",
                label: str = "label", key: str = "row_id", seed: int = 42) -> DataFrame:
    """M6 for LDA: cross-validated accuracy of every (shrinkage, solver, tol) on stratified seeded
    folds: (solver, shrinkage, tol, cv_accuracy: mean over folds).  ``tol`` only matters to svd; svd
    with a shrinkage is no model and gets a null."""
    from .search import confusions
    data = staged(kfold(df, folds, label, key, seed, "_nf_fold"))
    per = moments_by_group(data, features, label, "_nf_fold")
    total = all_of(per)
    factors = r_factors(data, features, label, {f: _means(m) for f, m in per.items()}, total["d"], "_nf_fold") if "svd" in solvers else {}
    grid = [(s, z, t) for s in solvers for z in shrinkages for t in tols]
    fits: dict = {}
    for fold in sorted(per):
        m = minus(total, per[fold])
        auto = auto_covariance(data.where(F.col("_nf_fold") != fold), features, label, m) if "auto" in shrinkages and set(solvers) - {"svd"} else None
        if factors:
            mu = _means(m)
            stack = [factors[f] for f in per if f != fold] + [np.sqrt(per[f]["cw"])[:, None] * (_means(per[f]) - mu) for f in per if f != fold]
            r = np.linalg.qr(np.vstack(stack), mode="r")
        for i, (solver, z, tol) in enumerate(grid):
            if solver == "svd":
                if z is None:
                    fits[fold, i] = lda_from_factor(m, r, tol)
            else:
                fits[fold, i] = lda_from_moments(m, None if z == "auto" else z, auto if z == "auto" else None, solver)
    got = confusions(data, {(f, i): fit for (f, i), fit in fits.items()}, features, label, "_nf_fold")
    scores: dict = {}
    for (f, i), c in got.items():
        scores.setdefault(i, []).append(np.trace(c) / c.sum())
    rows = [(s, "none" if z is None else str(z), float(t), float(np.mean(scores[i])) if i in scores else None) for i, (s, z, t) in enumerate(grid)]
    return values_df(df.sparkSession, rows, "solver string, shrinkage string, tol double, cv_accuracy double")
