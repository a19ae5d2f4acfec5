"""Block training of logistic regressions (M6) against single Spark fits."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from noteflow.operators import models as M
from noteflow.operators import softmax as S
from noteflow.operators.split import kfold


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(300, 4))
    y = (x[:, 0] + 0.5 * rng.normal(size=300) > 0).astype(int) + (x[:, 1] > 0.8)
    return spark.createDataFrame([(i, x[i].tolist(), float(y[i])) for i in range(300)], "row_id long, features array<double>, label double").repartition(4)


def test_scores_equal_single_fits(spark, frame):
    model, table = S.logreg_grid(frame, [0.01, 1.0], [None, "balanced"], folds=3, tol=1e-8)
    got = {(r["C"], r["class_weight"]): r["cv_accuracy"] for r in table.collect()}
    data = kfold(frame, 3, "label", "row_id", 42, "fold").persist()
    for c in (0.01, 1.0):
        for cw in (None, "balanced"):
            acc = []
            for f in range(3):
                fit = M.fit_logreg(data.where(F.col("fold") != f), C=c, class_weight=cw, max_iter=200)
                acc.append(M.predict(fit, data.where(F.col("fold") == f)).agg(F.avg((F.col("y_pred") == F.col("label")).cast("double"))).first()[0])
            assert got[c, cw or "none"] == pytest.approx(np.mean(acc), abs=0.011)     # one row may sit on a border
    assert model.params in got or (model.params[0], model.params[1] or "none") in got


def test_coefficients_reach_the_optimum(spark, frame):
    block = S.Block(frame, "features", "label")
    w = block.fit([S.Spec(1.0), S.Spec(0.05, True)], tol=1e-9)
    rows = frame.collect()
    x = np.array([r["features"] + [1.0] for r in rows])
    y = np.array([int(r["label"]) for r in rows])
    for spec, got in zip([S.Spec(1.0), S.Spec(0.05, True)], w):
        cw = block.weights(spec)[0][y]
        e = np.exp(x @ got.T)
        p = e / e.sum(axis=1, keepdims=True)
        p[np.arange(len(y)), y] -= 1
        g = (p * cw[:, None]).T @ x / cw.sum()
        g[:, :-1] += got[:, :-1] / (spec.C * len(y))
        assert np.abs(g).max() < 1e-7


def test_passes_do_not_grow_with_the_grid(spark, frame):
    small = S.logreg_grid(frame, [1.0], folds=2, max_iter=15, tol=0)[0].passes
    large = S.logreg_grid(frame, [0.1, 0.5, 1.0, 2.0, 4.0], [None, "balanced"], folds=2, max_iter=15, tol=0)[0].passes
    assert large <= small + 25                   # backtracking of the slowest model, not 10 times the passes


def test_sparse_rows_and_empty(spark, frame):
    sparse = frame.rdd.map(lambda r: (r["row_id"], Vectors.sparse(4, {j: v for j, v in enumerate(r["features"]) if v > 0}), r["label"]))
    dense = frame.withColumn("features", F.transform("features", lambda v: F.greatest(v, F.lit(0.0))))
    a = S.Block(spark.createDataFrame(sparse, ["row_id", "features", "label"]), "features", "label").fit([S.Spec(1.0)], tol=1e-9)[0]
    b = S.Block(dense, "features", "label").fit([S.Spec(1.0)], tol=1e-9)[0]
    assert np.allclose(a, b, atol=1e-5)
    with pytest.raises(ValueError):
        S.Block(frame.where("false"), "features", "label")
