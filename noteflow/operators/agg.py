"""Aggregation (A1-A7): ordered concatenation, first values, class counts, confusion matrix."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _not_null_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))


def concat_groups(df: DataFrame, keys: list[str], text_col: str, order_by: list[str],
                  sep: str = ".", out: str | None = None) -> DataFrame:
    """A1: per key, the texts joined with ``sep`` in ``order_by`` order.

    Null-key groups are dropped (pandas groupby drops them); null texts are
    skipped.  The per-group list is built by a partial + final aggregate; the
    result of a group is one string, so its size is the group's text size.
    """
    order = [F.col(c) for c in order_by]
    items = F.collect_list(F.struct(*order, F.col(text_col).alias("_nf_t")))
    return (_not_null_keys(df, keys).groupBy(*keys)
            .agg(F.array_join(F.transform(F.array_sort(items), lambda s: s["_nf_t"]), sep)
                 .alias(out or text_col)))


def first_per_group(df: DataFrame, keys: list[str], order_by: list[str],
                    cols: list[str] | None = None) -> DataFrame:
    """A2: per key and per column, the first non-null value in ``order_by`` order."""
    cols = cols or [c for c in df.columns if c not in keys and c not in order_by]
    order = F.struct(*[F.col(c) for c in order_by])
    aggs = [F.min_by(F.col(c), F.when(F.col(c).isNotNull(), order)).alias(c) for c in cols]
    return _not_null_keys(df, keys).groupBy(*keys).agg(*aggs)


def distinct_classes(df: DataFrame, col: str) -> DataFrame:
    """A3: unique class names."""
    return df.select(col).distinct()


def class_cardinality(df: DataFrame, label_col: str = "label", split_col: str = "split") -> DataFrame:
    """A4: number of distinct classes per split."""
    return df.groupBy(split_col).agg(F.countDistinct(label_col).alias("n_classes"))


def class_histogram(df: DataFrame, col: str) -> DataFrame:
    """A5: rows per class."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def split_shapes(df: DataFrame, split_col: str = "split") -> DataFrame:
    """Rows per split."""
    return df.groupBy(split_col).agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(df: DataFrame, y: str = "y_true", yhat: str = "y_pred", wide: bool = False,
                     labels: list | None = None) -> DataFrame:
    """True x predicted counts.  Long form ``(y, yhat, n)``; wide form pivots the
    predicted labels (the union of true and predicted labels on both axes).  With ``labels``
    given, predictions outside the list (and null ones) are counted in the column ``other``."""
    long = df.groupBy(y, yhat).agg(F.count(F.lit(1)).alias("n"))
    if not wide:
        return long
    rows = long.select(F.explode(F.array(y, F.col(yhat).cast(long.schema[y].dataType))).alias("_l")) \
               .filter(F.col("_l").isNotNull()).distinct()
    other = labels is not None
    if labels is None:   # the pivot's columns
        labels = sorted(r[0] for r in rows.collect())
    wide_df = long.groupBy(y).pivot(yhat, labels).agg(F.first("n"))
    full = rows.withColumnRenamed("_l", y).join(wide_df, y, "left")
    if other:
        rest = long.filter(~F.coalesce(F.col(yhat).isin(*labels), F.lit(False))).groupBy(y).agg(F.sum("n").alias("other"))
        full = full.join(rest, y, "left")
    return full.fillna(0, subset=[str(v) for v in labels] + ["other"] * other)
