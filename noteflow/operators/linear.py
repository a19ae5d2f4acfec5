"""Linear models and the moments that closed-form fits share."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import dense_rows, features_column, slices, sum_blocks, vector_length

#: The parts of a moments dict that add up over rows.
SUMS = ("xtx", "sx", "sw", "cs", "cw")


class LinearModel:
    """Scores = X coef' + intercept; prediction = argmax (class codes 0..K-1)."""

    def __init__(self, coef: np.ndarray, intercept: np.ndarray, classes: list):
        self.coef, self.intercept, self.classes = coef, intercept, classes

    def transform(self, df: DataFrame, features: str = "features", out: str = "prediction") -> DataFrame:
        """Add ``scores`` (array<double>) and the argmax ``prediction`` (Arrow-batched numpy)."""
        coef_t = self.coef.T.astype(np.float64)
        b = self.intercept.astype(np.float64)
        col = F.col(features)
        if isinstance(df.schema[features].dataType, VectorUDT):
            col = vector_to_array(col)

        @F.pandas_udf("array<double>")
        def _scores(x: pd.Series) -> pd.Series:
            if len(x) == 0:
                return pd.Series([], dtype=object)
            m = np.stack(x.to_numpy()).astype(np.float64) @ coef_t + b
            return pd.Series(list(m))

        s = df.withColumn("scores", _scores(col))
        return s.withColumn(out, (F.array_position("scores", F.array_max("scores")) - 1).cast("double"))

    def save(self, spark, path: str) -> None:
        """S7 for closed-form models: coefficients as a Parquet table."""
        rows = [(int(i), self.coef[i].tolist(), float(self.intercept[i]), str(self.classes[i]))
                for i in range(len(self.classes))]
        spark.createDataFrame(rows, "code int, coef array<double>, intercept double, class string") \
             .write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark, path: str) -> "LinearModel":
        rows = sorted(spark.read.parquet(path).collect(), key=lambda r: r["code"])
        return LinearModel(np.array([r["coef"] for r in rows]), np.array([r["intercept"] for r in rows]),
                           [r["class"] for r in rows])


def _unpack(v: np.ndarray, d: int, k: int) -> dict:
    o = 0
    xtx = v[o:o + d * d].reshape(d, d); o += d * d
    sx = v[o:o + d]; o += d
    sw = v[o]; o += 1
    cs = v[o:o + k * d].reshape(k, d); o += k * d
    return {"d": d, "k": k, "xtx": xtx, "sx": sx, "sw": sw, "cs": cs, "cw": v[o:o + k]}


def moments_by_group(df: DataFrame, features: str, label: str, group: str | None = None,
                     weight: str | None = None) -> dict:
    """Moments per value of ``group`` (one group when None) in one pass over the data:
    X'WX, sum w x, sum w, per-class sum w x and sum w.  Every task adds up its rows in numpy,
    one block per group it holds (:func:`blocks.sum_blocks`); sparse vectors stay sparse until
    a few rows at a time are multiplied.  Labels must be codes 0..K-1; rows with a null label
    are left out, a null feature value counts as 0."""
    x = df.where(F.col(label).isNotNull()).select(
        features_column(df, features).alias("x"), F.col(label).cast("int").alias("y"),
        (F.col(group).cast("int") if group else F.lit(0)).alias("g"),
        (F.col(weight) if weight else F.lit(1.0)).cast("double").alias("w"))
    shape = x.agg(F.max("y").alias("k"), F.max(vector_length(x, "x")).alias("d")).first()
    if shape["k"] is None:
        raise ValueError("empty training set")
    k, d = int(shape["k"]) + 1, int(shape["d"])

    def work(batches):
        acc: dict = {}
        for part in slices(batches):
            xs = np.nan_to_num(dense_rows(part.column("x"), d))
            y, g, w = (part.column(c).to_numpy(zero_copy_only=False) for c in ("y", "g", "w"))
            for own in np.unique(g):
                use = g == own
                X, Y = xs[use], np.zeros((int(use.sum()), k))
                Y[np.arange(len(Y)), y[use]] = w[use]
                Xw = X * w[use][:, None]
                a = acc.setdefault(int(own), [np.zeros((d, d)), np.zeros(d), np.zeros(1), np.zeros((k, d)), np.zeros(k)])
                for total, add in zip(a, (Xw.T @ X, Xw.sum(axis=0), w[use].sum(), Y.T @ X, Y.sum(axis=0))):
                    total += add
        return {g: np.concatenate([v.ravel() for v in a]) for g, a in acc.items()}

    return {g: _unpack(v, d, k) for g, v in sum_blocks(x, work).items()}


def moments(df: DataFrame, features: str, label: str, weight: str | None = None) -> dict:
    """One-pass moments of the whole frame (see :func:`moments_by_group`)."""
    return moments_by_group(df, features, label, None, weight)[0]


def minus(total: dict, part: dict) -> dict:
    return {**total, **{f: total[f] - part[f] for f in SUMS}}


def plus(a: dict | None, b: dict) -> dict:
    return dict(b) if a is None else {**a, **{f: a[f] + b[f] for f in SUMS}}


def all_of(per: dict) -> dict:
    """Moments of all groups together."""
    total = None
    for g in sorted(per):
        total = plus(total, per[g])
    return total


def ridge_from_moments(m: dict, alpha: float) -> LinearModel:
    """Ridge one-vs-all with targets +-1 and an intercept (centred by the weighted means)."""
    sw, sx = m["sw"], m["sx"]
    xbar = sx / sw
    xtx_c = m["xtx"] - sw * np.outer(xbar, xbar)
    xty = 2.0 * m["cs"].T - sx[:, None]               # sum w x y, y = +1 for own class else -1
    ybar = (2.0 * m["cw"] - sw) / sw
    xty_c = xty - sw * np.outer(xbar, ybar)
    coef = np.linalg.solve(xtx_c + alpha * np.eye(m["d"]), xty_c).T
    intercept = ybar - coef @ xbar
    return LinearModel(coef, intercept, list(range(m["k"])))
