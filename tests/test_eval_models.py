"""Metric edge cases (Q23) and closed-form models against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from noteflow.operators import evaluate as E
from noteflow.operators import labels as L
from noteflow.operators import models as M


def test_topk_ties_go_to_higher_index(spark):
    df = spark.createDataFrame([([0.4, 0.4, 0.2], 0), ([0.4, 0.4, 0.2], 1), ([0.4, 0.4, 0.2], 2)],
                               "probs array<double>, y_true int")
    ranks = [r[0] for r in df.select(E.true_class_rank("probs", "y_true")).collect()]
    assert ranks == [2, 1, 3]
    acc = {r["k"]: r["accuracy"] for r in E.topk_accuracy(df, 3).collect()}
    assert acc[1] == pytest.approx(100 / 3) and acc[3] == pytest.approx(100.0)


def test_confidence_sweep_empty_bucket_is_null(spark):
    df = spark.createDataFrame([(0, 0, 0.3), (1, 0, 0.4)], "y_true int, y_pred int, prob_max double")
    out = {r["threshold"]: r for r in E.confidence_sweep(df, [0.0, 0.35, 0.5]).collect()}
    assert out[0.0]["n_samples"] == 2 and out[0.0]["accuracy"] == 0.5
    assert out[0.35]["n_samples"] == 1 and out[0.35]["accuracy"] == 0.0
    assert out[0.5]["n_samples"] == 0 and out[0.5]["accuracy"] is None


def test_macro_metrics_union_of_labels(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (2, 1)], "y_true int, y_pred int")
    r = E.macro_metrics(df).first()
    # labels 0,1,2: precision (1, 1/3, 0), recall (1/2, 1, 0)
    assert r["acc"] == 0.5
    assert r["precision"] == pytest.approx((1 + 1 / 3) / 3)
    assert r["recall"] == pytest.approx(0.5)
    assert r["f1"] == pytest.approx((2 / 3 + 0.5 + 0) / 3)


def test_binary_metrics(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 1), (0, 0)], "y_true int, y_pred int")
    r = E.binary_metrics(df).first()
    assert (r["acc"], r["precision"], r["recall"], r["f1"]) == (0.5, 0.5, 0.5, 0.5)


def test_label_encoder_roundtrip_and_unseen(spark):
    df = spark.createDataFrame([("b",), ("a",), ("å",), ("B",)], "c string")
    enc = L.fit_label_encoder(df, "c")
    assert [r["class"] for r in enc.orderBy("code").collect()] == ["B", "a", "b", "å"]
    coded = L.apply_label_encoder(df, enc, "c", "label")
    back = L.decode_labels(coded, enc, "label", "name").collect()
    assert all(r["c"] == r["name"] for r in back)
    unseen = spark.createDataFrame([("zz",)], "c string")
    with pytest.raises(Exception):
        L.apply_label_encoder(unseen, enc, "c", "label").collect()
    assert L.apply_label_encoder(unseen, enc, "c", "label", invalid="skip").count() == 0


def _xy(spark, n=300, d=6, k=3, seed=1):
    rng = np.random.default_rng(seed)
    y = rng.integers(0, k, n)
    X = rng.normal(size=(n, d)) + y[:, None] * 0.8
    df = spark.createDataFrame([(i, X[i].tolist(), float(y[i])) for i in range(n)],
                               "row_id long, features array<double>, label double")
    return df, X, y


def test_ridge_matches_numpy(spark):
    df, X, y = _xy(spark)
    model = M.fit_ridge(df, alpha=2.0)
    Y = np.where(y[:, None] == np.arange(3)[None, :], 1.0, -1.0)
    Xc, Yc = X - X.mean(0), Y - Y.mean(0)
    coef = np.linalg.solve(Xc.T @ Xc + 2.0 * np.eye(X.shape[1]), Xc.T @ Yc).T
    assert np.allclose(model.coef, coef, atol=1e-8)
    assert np.allclose(model.intercept, Y.mean(0) - coef @ X.mean(0), atol=1e-8)


def test_lda_matches_numpy(spark):
    df, X, y = _xy(spark)
    model = M.fit_lda(df)
    mu = np.stack([X[y == c].mean(0) for c in range(3)])
    cov = sum(((X[y == c] - mu[c]).T @ (X[y == c] - mu[c])) for c in range(3)) / len(y)
    coef = np.linalg.lstsq(cov, mu.T, rcond=None)[0].T
    assert np.allclose(model.coef, coef, atol=1e-6)


def test_linear_model_predict_and_logreg_beat_majority(spark):
    df, X, y = _xy(spark)
    p = M.predict(M.fit_ridge(df, alpha=1.0), df)
    acc = p.select(F.avg((F.col("y_pred") == F.col("label")).cast("double"))).first()[0]
    majority = np.bincount(y).max() / len(y)
    assert acc > majority
    p2 = M.predict(M.fit_logreg(df, max_iter=50), df)
    acc2 = p2.select(F.avg((F.col("y_pred") == F.col("label")).cast("double"))).first()[0]
    assert acc2 > majority


def test_scheme_drilldown_by_name_and_position(spark):
    rows = [(i, "A [SEP] x" if i % 2 else "B [SEP] y", 1, 1 if i % 3 else 0) for i in range(30)]
    df = spark.createDataFrame(rows, "k long, text string, y_true int, y_pred int")
    by_name = E.scheme_drilldown(df, " B ", 2, "k").collect()
    by_pos = E.scheme_drilldown(df, 1, 2, "k").collect()      # 'A' is position 0, 'B' position 1
    assert sorted(map(tuple, by_name)) == sorted(map(tuple, by_pos))
    assert {r["outcome"] for r in by_name} == {"TP", "FN"} and len(by_name) == 4


def test_ridge_grid_cv_matches_per_fold_fits(spark):
    df, X, y = _xy(spark, n=240)
    from noteflow.operators.split import kfold
    table = {r["alpha"]: r["cv_accuracy"] for r in M.ridge_grid_cv(df, [0.5, 5.0], folds=3).collect()}
    data = kfold(df, 3, "label", "row_id", 42, "fold")
    for a in (0.5, 5.0):
        hits = 0
        for f in range(3):
            model = M.fit_ridge(data.filter(F.col("fold") != f), alpha=a)
            p = M.predict(model, data.filter(F.col("fold") == f))
            hits += p.filter(F.col("y_pred") == F.col("label")).count()
        assert table[a] == pytest.approx(hits / 240)


def test_null_predictions_have_an_outcome(spark):
    rows = spark.createDataFrame([(1, 1), (1, None), (0, None), (0, 0), (0, 1), (1, 0), (None, None), (None, 1)], "y_true int, y_pred int")
    got = [r[0] for r in rows.select(E.outcome()).collect()]
    assert got == ["TP", "FN", "FP", "TN", "FP", "FN", "FP", "FP"]
