"""Boosted trees (M5) against the same boosting in plain numpy, on whole and on staged margins."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from noteflow.operators import models as M
from noteflow.operators import trees as T


def softmax_boosting(x, y, k, cuts, rounds, depth, lr, gamma, lam, least, held):
    """Losses per round and final margins; one recursive exact search per node."""
    m, losses = np.zeros((len(x), k)), []
    bins = np.stack([np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(cuts)], axis=1)

    def grow(rows, g, h, level, out):
        own = rows[~held[rows]]
        G, H, best = g[own].sum(), h[own].sum(), (0, None)
        if level < depth:
            for j in range(x.shape[1]):
                for b in range(len(cuts[j])):
                    left = own[bins[own, j] <= b]
                    gl, hl = g[left].sum(), h[left].sum()
                    if hl < least or H - hl < least:
                        continue
                    gain = (gl ** 2 / (hl + lam) + (G - gl) ** 2 / (H - hl + lam) - G ** 2 / (H + lam)) / 2 - gamma
                    if gain > best[0] * (1 + 1e-9) and gain > 0:
                        best = gain, (j, b)
        if best[1] is None:
            out[rows] = -lr * G / (H + lam)
            return
        go = bins[rows, best[1][0]] <= best[1][1]
        grow(rows[go], g, h, level + 1, out)
        grow(rows[~go], g, h, level + 1, out)

    for _ in range(rounds):
        e = np.exp(m - m.max(axis=1, keepdims=True))
        p = e / e.sum(axis=1, keepdims=True)
        step = np.zeros_like(m)
        for c in range(k):
            grow(np.arange(len(x)), p[:, c] - (y == c), np.maximum(2 * p[:, c] * (1 - p[:, c]), 1e-16), 0, step[:, c])
        m = m + step
        e = np.exp(m - m.max(axis=1, keepdims=True))
        loss = -np.log((e / e.sum(axis=1, keepdims=True))[np.arange(len(y)), y])
        losses.append((loss[~held].mean(), loss[held].mean()))
    return losses, m


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(500, 5)), 2)
    y = ((x[:, 0] > 0).astype(int) + (x[:, 1] * x[:, 2] > 0.2) + (rng.random(500) < 0.1)) % 3
    return x, y, np.arange(500) % 5 == 4


@pytest.fixture(scope="module")
def frame(spark, rows):
    x, y, held = rows
    return spark.createDataFrame([(i, x[i].tolist(), float(y[i]), bool(held[i])) for i in range(500)],
                                 "row_id long, features array<double>, label double, val boolean").repartition(5)


CUTS = [[-1.0, -0.5, 0.0, 0.4, 1.0]] * 4 + [[]]


@pytest.mark.parametrize("rebase,hist_bytes", [(10, 64 << 20), (2, 1)])
def test_equals_numpy(spark, rows, frame, monkeypatch, rebase, hist_bytes):
    monkeypatch.setattr(T, "REBASE", rebase)
    monkeypatch.setattr(T, "HIST_BYTES", hist_bytes)      # one class per pass
    x, y, held = rows
    model = M.fit_boosted_trees(frame, n_trees=5, max_depth=3, gamma=0.3, lr=0.4, validation_col="val", cuts=CUTS)
    want, margins = softmax_boosting(x, y, 3, CUTS, 5, 3, 0.4, 0.3, 1.0, 1.0, held)
    log = {(r, s): v for r, s, v in model.log}
    assert [log[r + 1, "train"] for r in range(5)] == pytest.approx([w for w, _ in want], rel=1e-9)
    assert [log[r + 1, "validation"] for r in range(5)] == pytest.approx([w for _, w in want], rel=1e-9)
    assert np.diff([log[r + 1, "train"] for r in range(5)]).max() < 0
    got = {r["row_id"]: r["scores"] for r in model.transform(frame).collect()}
    assert np.allclose([got[i] for i in range(500)], margins)


def test_gamma_prunes_and_predict_scores(spark, rows, frame):
    few = M.fit_boosted_trees(frame, n_trees=2, max_depth=3, gamma=1e9)
    assert all(t.feature == [-1] for rnd in few.trees for t in rnd)
    easy = frame.withColumn("label", (F.col("features")[0] > 0).cast("double") + (F.col("features")[1] > 0.3).cast("double"))
    model = M.fit_boosted_trees(easy.where("NOT val"), n_trees=8, max_depth=3)
    p = M.predict(model, easy.where("val")).select("label", "y_pred", "probs").collect()
    assert np.mean([r["label"] == r["y_pred"] for r in p]) > 0.9
    assert all(sum(r["probs"]) == pytest.approx(1) for r in p)


def test_early_stop_keeps_the_best_round(spark, rows, frame):
    noisy = frame.withColumn("label", F.when(F.col("val"), (F.col("label") + 1) % 3).otherwise(F.col("label")))
    model = M.fit_boosted_trees(noisy, n_trees=30, max_depth=2, validation_col="val", patience=3)
    held = [v for _, s, v in model.log if s == "validation"]
    assert len(held) < 30 and len(model.trees) == int(np.argmin(held)) + 1


def test_saved_and_loaded(spark, frame, tmp_path):
    model = M.fit_boosted_trees(frame, n_trees=3, max_depth=2, bins=8)
    model.save(spark, str(tmp_path / "m"))
    back = T.BoostedTrees.load(spark, str(tmp_path / "m"))
    a, b = ({r["row_id"]: r["scores"] for r in m.transform(frame).collect()} for m in (model, back))
    assert a == b and back.log == sorted(model.log)


def test_sparse_vectors_nulls_and_empty(spark, rows):
    x, y, _ = rows
    data = [(Vectors.sparse(5, {j: float(v) for j, v in enumerate(x[i]) if abs(v) > 0.5}), float(y[i])) for i in range(200)]
    dense = [([float(v) if abs(v) > 0.5 else 0.0 for v in x[i]], float(y[i])) for i in range(200)]
    a = M.fit_boosted_trees(spark.createDataFrame(data, ["features", "label"]), n_trees=2, max_depth=2, bins=16)
    b = M.fit_boosted_trees(spark.createDataFrame(dense, ["features", "label"]), n_trees=2, max_depth=2, bins=16)
    assert a.cuts == b.cuts and [v for *_, v in a.log] == pytest.approx([v for *_, v in b.log])
    holes = spark.createDataFrame([([1.0, None], 0.0), ([2.0, float("nan")], 1.0), ([1.0, 3.0], 0.0), ([2.0, 3.0], None)] * 5,
                                  "features array<double>, label double")
    model = M.fit_boosted_trees(holes, n_trees=2, max_depth=2)
    assert [r["prediction"] for r in model.transform(holes).select("features", "prediction").collect()[:2]] == [0.0, 1.0]
    with pytest.raises(ValueError):
        M.fit_boosted_trees(holes.where("false"))
