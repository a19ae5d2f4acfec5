"""No cap, no size switch, no lost rows: cases that once fell out of a result."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from noteflow.operators import agg, evaluate as E, joins, order
from noteflow.session import staged, values_df


def test_prediction_outside_the_labels_is_counted(spark):
    df = spark.createDataFrame([(0, 0), (0, 2), (1, None), (2, 1)], "y_true int, y_pred int")
    got = {r["y_true"]: r.asDict() for r in agg.confusion_matrix(df, wide=True, labels=[0, 1]).collect()}
    assert got[0] == {"y_true": 0, "0": 1, "1": 0, "other": 1}
    assert got[1]["other"] == 1 and got[2]["1"] == 1
    assert sum(v for r in got.values() for k, v in r.items() if k != "y_true") == 4


def test_null_prediction_is_wrong(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, None, "a")], "y_true int, y_pred int, split string")
    m = E.macro_metrics(df).first()
    assert (m["acc"], m["recall"], m["n"]) == (0.5, 0.5, 2)
    assert E.binary_metrics(df).first()["acc"] == 0.5
    assert E.accuracy_by_split(df).first()["acc"] == 0.5


def test_null_label_is_wrong_and_no_class(spark):
    df = spark.createDataFrame([(1, 1), (None, 1), (None, None)], "y_true int, y_pred int")
    m = E.macro_metrics(df).first()
    assert m["n"] == 3 and m["acc"] == pytest.approx(1 / 3) and m["precision"] == 0.5 and m["recall"] == 1.0


def test_auto_metrics_both_branches(spark):
    two = spark.createDataFrame([(0, 0), (1, 1), (1, 0)], "y_true int, y_pred int")
    three = spark.createDataFrame([(0, 0), (1, 1), (2, 0)], "y_true int, y_pred int")
    assert E.auto_metrics(two).first()["recall"] == 0.5
    assert E.auto_metrics(three).first() == E.macro_metrics(three).first()


def test_softmax_is_linear_in_the_classes(spark):
    df = spark.range(400).select(F.transform(F.sequence(F.lit(0), F.lit(399)), lambda i: (i * 37 % 101) / 10.0).alias("logits"))
    E.softmax_probs(df).agg(F.sum("prob_max")).first()
    t = time.time()
    got = E.softmax_probs(df).select(F.aggregate("probs", F.lit(0.0), lambda a, x: a + x).alias("s")).agg(F.min("s"), F.max("s")).first()
    assert time.time() - t < 5
    assert got[0] == pytest.approx(1) and got[1] == pytest.approx(1)


def test_precision_at_k_counts_unscored_classes(spark):
    classes = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "c string")
    test = spark.createDataFrame([(1, "b"), (2, "d"), (3, "a"), (4, "z"), (5, None)], "id long, c string")
    scores = spark.createDataFrame([(1, "c", 0.5), (1, "d", 0.4), (2, "d", 0.1), (3, "b", 0.0)], "id long, c string, score double")
    # 1: c, d, a, b -> rank 4; 2: rank 1; 3: all 0, a first; 4 is no class, 5 has none
    for k, hits in ((1, 2), (3, 2), (4, 3)):
        r = E.precision_at_k(test, classes, scores, "id", "c", k).first()
        assert (r["n_rows"], r["hits"]) == (5, hits)


def test_cross_with_classes_without_collect(spark):
    df = spark.createDataFrame([(1,), (2,)], "id long")
    classes = spark.createDataFrame([("b",), ("a",), (None,), ("a",)], "class string")
    assert sorted(map(tuple, joins.cross_with_classes(df, classes).collect())) == [(1, "a"), (1, "b"), (2, "a"), (2, "b")]


def test_values_of_any_type(spark):
    df = values_df(spark, [(dt.date(2024, 1, 2), [1, 2], None), (None, [], 3.5)], "d date, a array<int>, x double")
    assert df.collect()[0]["d"] == dt.date(2024, 1, 2) and order.static_max_rows(df) == 2


def test_ranks_with_null_keys(spark):
    df = spark.createDataFrame([(None, 1), ("b", 2), ("a", 3)], "g string, k int")
    assert {r["k"]: r["rank"] for r in order.global_rank(df, ["g"]).collect()} == {1: 1, 3: 2, 2: 3}
    assert {r["k"]: r["r"] for r in order.rank_within(df, ["g"], ["k"], "r").collect()} == {1: 1, 2: 1, 3: 1}


def test_staged_table_is_pruned(spark):
    df = staged(spark.range(5).withColumn("x", F.lit("y")))
    assert "ReadSchema: struct<id:bigint>" in df.select("id")._jdf.queryExecution().toString()


def test_lda_with_automatic_shrinkage(spark):
    import numpy as np
    from noteflow.operators import models as M
    rng = np.random.default_rng(5)
    y = rng.integers(0, 3, 240)
    x = rng.standard_normal((240, 4)) * [1, 2, 0.5, 3] + np.array([[0, 0, 0, 0], [2, 0, 1, 0], [0, 3, 0, -4]])[y]
    df = spark.createDataFrame([(r.tolist(), int(c)) for r, c in zip(x, y)], "features array<double>, label int")
    got = M.fit_lda(df, shrinkage="auto")
    cov, mu = np.zeros((4, 4)), np.stack([x[y == k].mean(0) for k in range(3)])
    for k in range(3):
        z = x[y == k] - mu[k]
        dev = z.std(0)
        z = z / dev
        n, p = z.shape
        s = z.T @ z / n
        m = np.trace(s) / p
        d2 = ((s - m * np.eye(p)) ** 2).sum() / p
        b2 = min(sum(((np.outer(r, r) - s) ** 2).sum() / p for r in z) / n ** 2, d2)
        cov += n / len(x) * np.outer(dev, dev) * (b2 / d2 * m * np.eye(p) + (1 - b2 / d2) * s)
    coef = np.linalg.solve(cov, mu.T).T
    assert np.allclose(got.coef, coef)
    assert np.allclose(got.intercept, -0.5 * (mu * coef).sum(1) + np.log(np.bincount(y) / len(y)))
