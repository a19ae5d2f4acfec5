"""Models (M1-M12): linear and tree classifiers, tuning, learning curves.

* M1 / M4 are Spark ML estimators (multinomial logistic regression, one-vs-rest
  linear SVM); M5, boosted trees on distributed histograms, is in :mod:`trees`.
* M2 (ridge one-vs-all) and M3 (linear discriminant analysis, in :mod:`lda`) are
  closed form: one distributed pass computes the moments (X'WX, per-class
  weighted sums and counts) as numpy blocks per task (:mod:`blocks`); the d x d
  solve runs on the driver (d <= a few thousand).  Every alpha of a grid reuses
  the same moments.  Wide sparse rows have a conjugate gradient fit without any
  d x d matrix (:mod:`ridge_cg`).
* Tuning uses ``CrossValidator`` with a stratified, seeded fold column (SP7).
"""

from __future__ import annotations

import itertools
import random
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.ml.classification import LinearSVC, LogisticRegression, OneVsRest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import staged
from . import evaluate as E
from .lda import fit_lda, lda_grid_cv  # noqa: F401 - M3, used with the other fits
from .linear import LinearModel, all_of, minus, moments, moments_by_group, ridge_from_moments
from .order import KeyOrder
from .ridge_cg import fit_ridge_cg, ridge_cg_grid  # noqa: F401 - M2 on wide rows
from .search import learning_curve_moments, successive_halving  # noqa: F401 - M7, M11
from .softmax import logreg_grid  # noqa: F401 - M6
from .split import kfold
from .trees import BoostedTrees, fit_boosted_trees  # noqa: F401 - M5



def as_vector(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """Make ``col`` an ML vector (arrays are converted)."""
    out = out or col
    if isinstance(df.schema[col].dataType, VectorUDT):
        return df if out == col else df.withColumn(out, F.col(col))
    return df.withColumn(out, array_to_vector(F.col(col)))


def balanced_weights(df: DataFrame, label: str, weight_col: str = "weight") -> DataFrame:
    """Sample weight n / (K * n_class) per row (sklearn's ``class_weight='balanced'``)."""
    counts = staged(df.groupBy(label).agg(F.count(F.lit(1)).alias("_nf_nc")))   # its size is known: a few classes are broadcast
    k, n = counts.agg(F.count(F.lit(1)), F.coalesce(F.sum("_nf_nc"), F.lit(0))).first()
    w = counts.select(label, (F.lit(float(n)) / (F.lit(float(k)) * F.col("_nf_nc"))).alias(weight_col))
    return df.join(w, label)


def fit_logreg(df: DataFrame, features: str = "features", label: str = "label", C: float = 1.0,
               class_weight: str | None = None, max_iter: int = 100):
    """M1: L2 multinomial logistic regression; sklearn's C maps to regParam = 1 / (C n)."""
    d = as_vector(df, features)
    wcol = None
    if class_weight == "balanced":
        d, wcol = balanced_weights(d, label), "weight"
    n = d.count()
    if n == 0:
        raise ValueError("empty training set")
    lr = LogisticRegression(featuresCol=features, labelCol=label, family="multinomial", regParam=1.0 / (C * n),
                            elasticNetParam=0.0, standardization=False, maxIter=max_iter)
    if wcol:
        lr.setWeightCol(wcol)
    return lr.fit(d)


def fit_linear_svm(df: DataFrame, features: str = "features", label: str = "label", reg: float = 0.01,
                   max_iter: int = 20, parallelism: int = 4):
    """M4: hinge loss with L2, one-vs-rest."""
    svc = LinearSVC(featuresCol=features, labelCol=label, regParam=reg, maxIter=max_iter)
    return OneVsRest(classifier=svc, featuresCol=features, labelCol=label, parallelism=parallelism).fit(
        as_vector(df, features))


# ---------------------------------------------------------------- ridge in closed form (M2)

def ridge_grid_cv(df: DataFrame, alphas, folds: int = 3, features: str = "features", label: str = "label",
                  key: str = "row_id", seed: int = 42) -> DataFrame:
    """M6 for ridge: cross-validated accuracy of every alpha with two passes over the
    data in total - one for the per-fold moments (training moments of fold f are
    the total minus fold f), one scoring pass that predicts each row with the
    models of its own held-out fold for all alphas at once."""
    data = kfold(as_vector(df, features), folds, label, key, seed, "fold")
    per = moments_by_group(data, features, label, "fold")
    total = all_of(per)
    models = {(f, a): ridge_from_moments(minus(total, per[f]), a) for f in per for a in alphas}
    spark = df.sparkSession
    bc = spark.sparkContext.broadcast({fa: (m.coef.T.copy(), m.intercept.copy()) for fa, m in models.items()})
    alist = list(alphas)

    @F.pandas_udf("array<int>")
    def _preds(x: pd.Series, fold: pd.Series) -> pd.Series:
        mats = bc.value
        X = np.stack(x.to_numpy()).astype(np.float64) if len(x) else np.zeros((0, 1))
        out = np.zeros((len(x), len(alist)), dtype=np.int32)
        for f in np.unique(fold.to_numpy()):
            rows = fold.to_numpy() == f
            for j, a in enumerate(alist):
                w, b = mats[(int(f), a)]
                out[rows, j] = np.argmax(X[rows] @ w + b, axis=1)
        return pd.Series(list(out))

    scored = data.withColumn("_nf_p", _preds(vector_to_array(features), F.col("fold")))
    hits = scored.agg(*[F.avg((F.col("_nf_p")[j] == F.col(label).cast("int")).cast("double")).alias(f"a{j}")
                        for j in range(len(alist))]).first()
    return spark.createDataFrame([(float(a), float(hits[f"a{j}"])) for j, a in enumerate(alist)],
                                 "alpha double, cv_accuracy double")


def fit_ridge(df: DataFrame, features: str = "features", label: str = "label", alpha: float = 1.0,
              class_weight: str | None = None) -> LinearModel:
    """M2: one-vs-all least squares on +-1 targets (argmax decision)."""
    w = None
    if class_weight == "balanced":
        df, w = balanced_weights(df, label), "weight"
    return ridge_from_moments(moments(df, features, label, w), alpha)


# ---------------------------------------------------------------- prediction and tuning

def predict(model, df: DataFrame, features: str = "features", out: str = "y_pred") -> DataFrame:
    """Predicted class code and class probabilities (``probs``) per row.

    Models with a probability column use it; one-vs-rest and closed-form models
    get probabilities as the softmax of their raw margins / scores."""
    if isinstance(model, (LinearModel, BoostedTrees)):
        s = model.transform(df, features)
        return E.softmax_probs(s.withColumnRenamed("scores", "_nf_raw"), "_nf_raw").drop("_nf_raw", "y_pred") \
            .withColumn(out, F.col("prediction").cast("int")).drop("prediction")
    s = model.transform(as_vector(df, features))
    if "probability" in s.columns:
        s = s.withColumn("probs", vector_to_array("probability"))
    else:
        s = E.softmax_probs(s.withColumn("_nf_raw", vector_to_array("rawPrediction")), "_nf_raw").drop("_nf_raw", "y_pred")
    return (s.withColumn(out, F.col("prediction").cast("int"))
             .drop("prediction", "rawPrediction", "probability", "pos_prob", "prob_max")
             .withColumn("prob_max", F.array_max("probs")))


def _evaluator(label: str):
    return MulticlassClassificationEvaluator(labelCol=label, predictionCol="prediction", metricName="accuracy")


def grid_search(df: DataFrame, estimator, grid: dict, features: str = "features", label: str = "label",
                folds: int = 3, key: str = "row_id", seed: int = 42, parallelism: int = 4):
    """M6: exhaustive grid with cross-validated accuracy on stratified seeded folds.
    Returns ``(best_model, table of (params, mean accuracy))``."""
    b = ParamGridBuilder()
    for p, vals in grid.items():
        b = b.addGrid(estimator.getParam(p) if isinstance(p, str) else p, list(vals))
    maps = b.build()
    return _cross_validate(df, estimator, maps, features, label, folds, key, seed, parallelism)


def random_search(df: DataFrame, estimator, space: dict, n_iter: int, features: str = "features",
                  label: str = "label", folds: int = 3, key: str = "row_id", seed: int = 42, parallelism: int = 4):
    """M7: a seeded random sample of ``n_iter`` parameter maps from the grid."""
    names = list(space)
    combos = list(itertools.product(*[space[n] for n in names]))
    pick = random.Random(seed).sample(combos, min(n_iter, len(combos)))
    maps = [{estimator.getParam(n): v for n, v in zip(names, c)} for c in pick]
    return _cross_validate(df, estimator, maps, features, label, folds, key, seed, parallelism)


def _cross_validate(df, estimator, maps, features, label, folds, key, seed, parallelism):
    data = kfold(as_vector(df, features), folds, label, key, seed, "fold")
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=maps, evaluator=_evaluator(label),
                        numFolds=folds, foldCol="fold", parallelism=parallelism, seed=seed)
    model = cv.fit(data)
    spark = df.sparkSession
    rows = [(", ".join(f"{p.name}={v}" for p, v in sorted(m.items(), key=lambda kv: kv[0].name)), float(a))
            for m, a in zip(maps, model.avgMetrics)]
    table = spark.createDataFrame(rows, "params string, cv_accuracy double")
    return model.bestModel, table


def leaderboard(train: DataFrame, test: DataFrame, estimators: dict, features: str = "features",
                label: str = "label") -> DataFrame:
    """M8: fit several models, macro metrics on the test rows, sorted by accuracy."""
    out = None
    for name, fit in estimators.items():
        model = fit(train)
        p = predict(model, test, features)
        m = E.macro_metrics(p, label, "y_pred").withColumn("model", F.lit(name))
        out = m if out is None else out.unionByName(m)
    return out.orderBy(F.desc("acc"), "model")


def cross_val_scores(df: DataFrame, fit: Callable, k: int = 5, features: str = "features", label: str = "label",
                     key: str = "row_id", seed: int = 42) -> DataFrame:
    """M9: accuracy per fold of a stratified seeded k-fold."""
    data = staged(kfold(df, k, label, key, seed, "fold"))   # read by every fold, also lazily afterwards
    out = None
    for f in range(k):
        model = fit(data.filter(F.col("fold") != f))
        p = predict(model, data.filter(F.col("fold") == f), features)
        m = E.macro_metrics(p, label, "y_pred").withColumn("fold", F.lit(f))
        out = m if out is None else out.unionByName(m)
    return out.select("fold", "acc", "f1", "precision", "recall", "n")


def learning_curve(base: DataFrame, extra: DataFrame, sizes, fit: Callable, test: DataFrame, new_class,
                   order_by, features: str = "features", label: str = "label") -> DataFrame:
    """For each n, append the last n rows of the new class (U2), fit, and score
    all test rows (E1) and the new class's test rows (E14); the last point uses
    all of ``extra``.  Result ``(n, scope, acc, f1, precision, recall)``."""
    order = KeyOrder(extra, order_by)     # one ranking for all points; the order of training rows is free
    out = None
    for n in list(sizes) + [order.total]:
        tail = order.flag(extra, order_by, n, True, "_nf_f").filter("_nf_f").drop("_nf_f")
        model = fit(base.unionByName(tail, allowMissingColumns=True))
        p = predict(model, test, features)
        allm = E.macro_metrics(p, label, "y_pred").withColumn("scope", F.lit("all"))
        newm = E.new_class_metrics(p, new_class, label, "y_pred").withColumn("scope", F.lit("new_class"))
        pt = allm.unionByName(newm).withColumn("n", F.lit(int(n)))
        out = pt if out is None else out.unionByName(pt)
    return out.select("n", "scope", "acc", "f1", "precision", "recall")


def refit_full(splits: DataFrame, fit: Callable, split_col: str = "split"):
    """Refit the chosen model on train + validation."""
    return fit(splits.filter(F.col(split_col).isin("train", "val")))
