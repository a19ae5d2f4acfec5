"""LDA solvers, sparse ridge, halving and the learning curve (M2, M3, M6, M7, M11) against numpy and refits."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from noteflow.operators import lda as L
from noteflow.operators import models as M
from noteflow.operators import ridge_cg as R
from noteflow.operators import search as S
from noteflow.operators.split import kfold


def _data(n=240, d=5, k=3, seed=4):
    rng = np.random.default_rng(seed)
    y = rng.integers(0, k, n)
    return rng.normal(size=(n, d)) @ np.diag(np.arange(1, d + 1)) + rng.normal(size=(k, d))[y] * 2, y


@pytest.fixture(scope="module")
def frame(spark):
    x, y = _data()
    return spark.createDataFrame([(i, x[i].tolist(), float(y[i])) for i in range(len(y))], "row_id long, features array<double>, label double").repartition(5)


def _svd_lda(x, y, tol=1e-4):
    """Textbook whitening: scale, whiten by the within-class SVD, rotate to the between-class axes."""
    classes, n = np.unique(y), len(y)
    mu = np.array([x[y == c].mean(axis=0) for c in classes])
    share = np.array([(y == c).mean() for c in classes])
    centred = x - mu[y]
    dev = centred.std(axis=0)
    _, s, vt = np.linalg.svd(centred / dev / np.sqrt(n - len(classes)), full_matrices=False)
    white = (vt[s > tol] / dev).T / s[s > tol]
    center = share @ mu
    _, s, vt = np.linalg.svd((np.sqrt(n * share / (len(classes) - 1))[:, None] * (mu - center)) @ white, full_matrices=False)
    axes = white @ vt.T[:, :(s > tol * s[0]).sum()]
    return center, axes, (x - center) @ axes


def _same_up_to_sign(a, b):
    assert a.shape == b.shape
    for j in range(a.shape[1]):
        assert np.allclose(a[:, j], b[:, j], atol=1e-8) or np.allclose(a[:, j], -b[:, j], atol=1e-8)


def test_svd_solver_equals_numpy(spark, frame):
    x, y = _data()
    model = L.fit_lda(frame, solver="svd")
    _, _, want = _svd_lda(x, y)
    got = {r["row_id"]: r["projected"] for r in model.project(frame).collect()}
    _same_up_to_sign(np.array([got[i] for i in range(len(y))]), want)
    plain = L.fit_lda(frame, solver="lsqr")
    scores = x @ model.coef.T + model.intercept
    other = x @ plain.coef.T + plain.intercept
    assert (scores.argmax(axis=1) == other.argmax(axis=1)).mean() > 0.97      # n - K against n in the covariance


@pytest.mark.parametrize("shrinkage", [None, 0.3, "auto"])
def test_eigen_solver_agrees_with_lsqr_and_diagonalises(spark, frame, shrinkage):
    x, y = _data()
    a, b = L.fit_lda(frame, solver="eigen", shrinkage=shrinkage), L.fit_lda(frame, solver="lsqr", shrinkage=shrinkage)
    assert np.allclose(a.coef, b.coef) and np.allclose(a.intercept, b.intercept)
    if shrinkage is None:
        within = sum(np.cov(x[y == c].T, bias=True) * (y == c).mean() for c in range(3))
        total = np.cov(x.T, bias=True)
        v = a.scalings
        assert np.allclose(v.T @ within @ v, np.eye(2), atol=1e-8)
        between = v.T @ (total - within) @ v
        assert np.allclose(between, np.diag(np.diag(between)), atol=1e-8) and between[0, 0] >= between[1, 1]


def test_constant_features_and_many_factors(spark, frame, monkeypatch):
    monkeypatch.setattr(L, "FAN_IN", 2)
    wide = frame.withColumn("features", F.concat("features", F.array(F.lit(1.0), F.col("features")[0])))   # a constant and a copy
    got, want = (np.array([r["projected"] for r in L.fit_lda(f, solver="svd").project(f).orderBy("row_id").collect()]) for f in (wide, frame))
    _same_up_to_sign(got, want)
    with pytest.raises(ValueError):
        L.fit_lda(frame, solver="svd", shrinkage=0.1)


def test_lda_grid_equals_fits_per_fold(spark, frame):
    table = {(r["solver"], r["shrinkage"]): r["cv_accuracy"] for r in L.lda_grid_cv(
        frame, [None, "auto", 0.4], ["svd", "lsqr", "eigen"], folds=3).collect()}
    assert table["svd", "auto"] is None and table["svd", "0.4"] is None
    data = kfold(frame, 3, "label", "row_id", 42, "fold").persist()
    for solver, z in (("svd", None), ("lsqr", "auto"), ("eigen", 0.4)):
        acc = []
        for f in range(3):
            fit = L.fit_lda(data.where(F.col("fold") != f), shrinkage=z, solver=solver)
            acc.append(fit.transform(data.where(F.col("fold") == f)).agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0])
        assert table[solver, "none" if z is None else str(z)] == pytest.approx(np.mean(acc))


@pytest.mark.parametrize("class_weight", [None, "balanced"])
def test_conjugate_gradients_equal_the_closed_form(spark, frame, class_weight):
    skewed = frame.where("label <> 2 OR row_id % 3 = 0")
    a = M.fit_ridge(skewed, alpha=0.7, class_weight=class_weight)
    b = R.fit_ridge_cg(skewed, alpha=0.7, class_weight=class_weight, tol=1e-12)
    assert np.allclose(a.coef, b.coef, atol=1e-8) and np.allclose(a.intercept, b.intercept, atol=1e-8)


def test_a_hundred_thousand_sparse_features(spark):
    rng = np.random.default_rng(8)
    d, rows = 100_000, []
    for i in range(400):
        y = i % 2
        on = sorted(set(rng.integers(0, d // 2, 20) + y * (d // 2 - 20_000)))
        rows.append((i, Vectors.sparse(d, [int(j) for j in on], [1.0] * len(on)), float(y)))
    frame = spark.createDataFrame(rows, ["row_id", "features", "label"])
    model = R.fit_ridge_cg(frame, alpha=1.0, tol=1e-10)
    # the dual closed form: 400 x 400
    x = np.zeros((400, d), dtype=np.float32)
    for i, v, _ in rows:
        x[i, v.indices] = v.values
    t = np.array([[1.0 if y == c else -1.0 for c in (0.0, 1.0)] for *_, y in rows])
    xc, tc = x - x.mean(axis=0), t - t.mean(axis=0)
    want = (xc.T @ np.linalg.solve(xc @ xc.T + np.eye(400), tc)).T
    assert model.coef.shape == (2, d) and np.allclose(model.coef, want, atol=1e-4)


def test_ridge_grid_equals_single_fits(spark, frame):
    model, table = R.ridge_cg_grid(frame, [0.1, 50.0], [None, "balanced"], tol=1e-10)
    got = {(r["alpha"], r["class_weight"]): r["cv_accuracy"] for r in table.collect()}
    data = kfold(frame, 3, "label", "row_id", 42, "fold").persist()
    for (alpha, cw), acc in got.items():
        each = []
        for f in range(3):
            fit = M.fit_ridge(data.where(F.col("fold") != f), alpha=alpha, class_weight=None if cw == "none" else cw)
            each.append(fit.transform(data.where(F.col("fold") == f)).agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0])
        assert acc == pytest.approx(np.mean(each))
    best = M.fit_ridge(frame, alpha=model.params[0], class_weight=model.params[1])
    assert np.allclose(best.coef, model.coef, atol=1e-6)


def test_halving_scores_equal_fits(spark, frame):
    rows = S.successive_halving(frame, {"ridge": (1e-4, 1e3), "lda": (0.0, 1.0)}, n=12, rung_rows=(50, 100)).collect()
    per = {}
    for r in rows:
        per.setdefault(r["rung"], []).append(r)
    assert [len(per[k]) for k in sorted(per)] == [12, 4, 1] and per[2][0]["n_rows"] == 240
    best = {r["candidate"] for r in sorted(per[0], key=lambda r: (-r["accuracy"], r["candidate"]))[:4]}
    assert {r["candidate"] for r in per[1]} == best
    last, data, hits = per[2][0], kfold(frame, 3, "label", "row_id", 42, "fold").persist(), 0
    for f in range(3):
        train = data.where(F.col("fold") != f)
        fit = M.fit_ridge(train, alpha=last["value"]) if last["model"] == "ridge" else L.fit_lda(train, shrinkage=last["value"])
        hits += fit.transform(data.where(F.col("fold") == f)).where("prediction = label").count()
    assert last["accuracy"] == pytest.approx(hits / 240)


def test_curve_equals_refits(spark, frame):
    base, extra, test = frame.where("label <> 0 AND row_id % 4 > 0"), frame.where("label = 0 AND row_id % 4 > 0"), frame.where("row_id % 4 = 0")
    solve = lambda m: M.ridge_from_moments(m, 1.0)
    got = S.learning_curve_moments(base, extra, [0, 5, 20], solve, test, 0.0, ["row_id"])
    want = M.learning_curve(base, extra, [0, 5, 20], lambda t: M.fit_ridge(t, alpha=1.0), test, 0.0, ["row_id"])
    key = lambda r: (r["n"], r["scope"])
    for a, b in zip(sorted(got.collect(), key=key), sorted(want.collect(), key=key), strict=True):
        assert key(a) == key(b)
        assert [a[c] for c in ("acc", "f1", "precision", "recall")] == pytest.approx([b[c] for c in ("acc", "f1", "precision", "recall")])
