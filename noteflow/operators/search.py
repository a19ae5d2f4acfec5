"""Search and learning curves over closed-form models from shared moments.

* :func:`successive_halving` draws candidates from a continuous space (ridge alphas, LDA shrinkages) and
  fits each per fold from one pass of moments.  Rungs score the surviving candidates on a bounded,
  growing number of rows (those with the smallest seeded draws); the last rung scores what is left
  on all rows in one pass.
* :func:`learning_curve_moments` gives the same points as :func:`models.learning_curve`, from one pass:
  the rows of the new class are grouped by the first point that includes them, prefix sums over
  the groups are each point's moments, and one pass scores all points.
"""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import draw
from ..session import staged, values_df
from . import evaluate as E
from .blocks import dense_rows, features_column, slices, sum_blocks
from .lda import lda_from_moments
from .linear import all_of, minus, moments_by_group, plus, ridge_from_moments
from .order import RowOrder
from .split import kfold

def confusions(df: DataFrame, models: dict, features: str = "features", label: str = "label", fold_col: str | None = None) -> dict:
    """{model: K x K counts (label, prediction)} of linear models, in one pass.  With ``fold_col`` the
    keys are (fold, ...) and a model only scores the rows of its fold."""
    fold = F.col(fold_col).cast("int") if fold_col else F.lit(0)
    rows = df.where(F.col(label).isNotNull()).select(features_column(df, features).alias("x"), F.col(label).cast("int").alias("y"), fold.alias("f"))
    names = list(models)
    k = max(len(m.classes) for m in models.values())
    d = next(iter(models.values())).coef.shape[1]
    flat = [(names[i][0] if fold_col else 0, models[n].coef.T.copy(), models[n].intercept) for i, n in enumerate(names)]

    def work(batches):
        out = {i: np.zeros((k, k)) for i in range(len(flat))}
        for part in slices(batches):
            x = np.nan_to_num(dense_rows(part.column("x"), d))
            y, f = (part.column(c).to_numpy(zero_copy_only=False) for c in ("y", "f"))
            for i, (own, coef, intercept) in enumerate(flat):
                use = (f == own) & (y < k)
                if use.any():
                    np.add.at(out[i], (y[use], (x[use] @ coef + intercept).argmax(axis=1)), 1)
        return out
    return {names[i]: v.reshape(k, k) for i, v in sum_blocks(rows, work).items()}


def _candidates(space: dict, n: int, seed: int) -> list[tuple]:
    """(model, value): models in turn, alphas log-uniform, shrinkages uniform."""
    rng, out = random.Random(seed), []
    for i in range(n):
        model = sorted(space)[i % len(space)]
        lo, hi = space[model]
        out.append((model, float(np.exp(rng.uniform(np.log(lo), np.log(hi)))) if model == "ridge" else rng.uniform(lo, hi)))
    return out


def _solve(model: str, value: float, m: dict):
    return ridge_from_moments(m, value) if model == "ridge" else lda_from_moments(m, value)


def successive_halving(df: DataFrame, space: dict, n: int = 27, rung_rows=(256, 1024), keep: float = 1 / 3, folds: int = 3,
                       features: str = "features", label: str = "label", key: str = "row_id", seed: int = 42) -> DataFrame:
    """M7: ``space`` {'ridge': (least, largest alpha), 'lda': (least, largest shrinkage)}; ``n`` candidates.

    After each rung the best ``keep`` share stays (ties: the earlier candidate).  Three passes over the
    staged rows at any number of candidates: moments, the rungs' rows (at most ``max(rung_rows)``,
    brought to the driver), and the last rung.  Returns (candidate, model, value, rung, n_rows, accuracy)."""
    data = staged(kfold(df, folds, label, key, seed, "_nf_fold"))
    per = moments_by_group(data, features, label, "_nf_fold")
    total = all_of(per)
    train = {f: minus(total, m) for f, m in per.items()}
    drawn = data.where(F.col(label).isNotNull()).withColumn("_nf_h", draw(seed + 1, key)).orderBy("_nf_h", key).limit(max(rung_rows))
    sample = drawn.select(features_column(data, features).alias("x"), F.col(label).cast("int").alias("y"), F.col("_nf_fold").alias("f"), "_nf_h", key) \
                  .orderBy("_nf_h", key).toArrow().combine_chunks()
    x = np.nan_to_num(dense_rows(pa.chunked_array(sample.column("x")).combine_chunks(), total["d"]))
    y, f = (sample.column(c).to_numpy() for c in ("y", "f"))
    alive = list(enumerate(_candidates(space, n, seed)))
    rows = []
    fits = {i: {fold: _solve(model, v, train[fold]) for fold in per} for i, (model, v) in alive}
    for rung, size in enumerate(sorted(rung_rows)):
        size = min(size, len(y))
        scores = {}
        for i, (model, v) in alive:
            hit = sum(((x[:size][f[:size] == fold] @ m.coef.T + m.intercept).argmax(axis=1) == y[:size][f[:size] == fold]).sum() for fold, m in fits[i].items())
            scores[i] = hit / size
            rows.append((i, model, v, rung, size, float(scores[i])))
        alive = sorted(alive, key=lambda c: (-scores[c[0]], c[0]))[:max(1, int(len(alive) * keep))]
    got = confusions(data, {(fold, i): fits[i][fold] for i, _ in alive for fold in per}, features, label, "_nf_fold")
    for i, (model, v) in alive:
        counts = sum(got[fold, i] for fold in per)
        rows.append((i, model, v, len(rung_rows), int(counts.sum()), float(np.trace(counts) / counts.sum())))
    return values_df(df.sparkSession, rows, "candidate int, model string, value double, rung int, n_rows long, accuracy double")


def learning_curve_moments(base: DataFrame, extra: DataFrame, sizes, solve, test: DataFrame, new_class, order_by,
                           features: str = "features", label: str = "label") -> DataFrame:
    """M11 for closed-form models: ``solve(moments)`` gives a point's model.  For every n of ``sizes``, and
    for all rows of ``extra``, the model of ``base`` with the last n rows of ``extra`` in ``order_by``
    order: ``(n, scope, acc, f1, precision, recall)`` on all test rows and on the new class's."""
    order = RowOrder(extra, order_by)
    points = sorted({min(int(n), order.total) for n in sizes}) + [order.total]
    back = F.lit(order.total) - F.col("_nf_p") + 1                        # 1 for the last row
    first = F.lit(len(points) - 1)
    for j in range(len(points) - 2, -1, -1):
        first = F.when(back <= points[j], j).otherwise(first)
    rows = base.select(features, label, F.lit(-1).alias("_nf_g")).unionByName(
        order.ranked("_nf_p").select(features, label, first.alias("_nf_g")))
    per = moments_by_group(rows, features, label, "_nf_g")
    fits, running = {}, per.get(-1)
    for j, n in enumerate(points):
        if j in per:
            running = plus(running, per[j])
        if running is None:
            raise ValueError("no training rows")
        fits[j] = solve(running)
    got = confusions(test, fits, features, label)
    counts, c = [], int(new_class)
    for j, n in enumerate(points):
        m = got[j]
        for y in range(len(m)):
            if m[y].sum() or m[:, y].sum():
                counts.append((j, n, "all", y, m[y, y], m[:, y].sum() - m[y, y], m[y].sum() - m[y, y], m[y].sum(), m[y, y]))
        hit, miss = m[c, c], m[c].sum() - m[c, c]
        if hit + miss:
            counts.append((j, n, "new_class", 1, hit, 0, miss, hit + miss, hit))
            if miss:
                counts.append((j, n, "new_class", 0, 0, miss, 0, 0, 0))
    table = values_df(base.sparkSession, [(j, n, s, y, *map(int, v)) for j, n, s, y, *v in counts],
                      "point int, n int, scope string, label int, tp long, fp long, fn long, rows long, ok long")
    return table.groupBy("point", "n", "scope").agg(*E._macro_aggs()[:4]).select("n", "scope", "acc", "f1", "precision", "recall")
