"""Splitting (SP1-SP7): time-ordered tails, seeded exact-size random splits, k-fold.

Every split adds a ``split`` column instead of producing several DataFrames,
so one plan carries all parts and a Parquet sink can ``partitionBy('split')``.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import draw
from .order import KeyOrder, global_rank, rank_within


def round_half_even(x: float) -> int:
    """``np.round`` on one number (Python's ``round`` is half-to-even as well)."""
    return int(round(x))


def tail_split_n(df: DataFrame, n_test: int, order_by, split_col: str = "split",
                 names=("train_val", "test")) -> DataFrame:
    """SP1: the last ``n_test`` rows in ``order_by`` order are the test set; 0 -> all train."""
    flagged = KeyOrder(df, order_by).flag(df, order_by, n_test, True, "_nf_t")
    return flagged.withColumn(split_col, F.when(F.col("_nf_t"), names[1]).otherwise(names[0])).drop("_nf_t")


def tail_split_frac(df: DataFrame, frac: float, order_by, split_col: str = "split",
                    names=("train_val", "test")) -> DataFrame:
    """SP2: last ``round_half_even(n * frac)`` rows are the test set."""
    order = KeyOrder(df, order_by)
    flagged = order.flag(df, order_by, round_half_even(order.total * frac), True, "_nf_t")
    return flagged.withColumn(split_col, F.when(F.col("_nf_t"), names[1]).otherwise(names[0])).drop("_nf_t")


def time_split3(df: DataFrame, order_by, n: int | None = None, rate_pct: float | None = None,
                split_col: str = "split") -> DataFrame:
    """SP3: test = last m rows, val = the m rows before, train = the rest.

    ``m = n`` if given, else ``int(count * rate_pct / 100)``; m = 0 -> all train.
    When 2m exceeds the row count the parts follow positional slicing with
    wrapped negative starts (``data[n-m:]``, then ``x[len(x)-m:]``), as the
    slices of an in-memory table would.
    """
    order = KeyOrder(df, order_by)
    total = order.total
    m = n if n else int(total * (rate_pct or 0) / 100)

    def start(length: int, back: int) -> int:
        # start index of the slice [length - back:], with Python's wrap of negative starts
        s = length - back
        return s if s >= 0 else max(0, length + s)

    test_start = start(total, m)              # rows [test_start, total) are test
    val_start = start(test_start, m)          # rows [val_start, test_start) are val
    f = order.flag(order.flag(df, order_by, total - test_start, True, "_nf_t"), order_by, total - val_start, True, "_nf_v")
    return (f.withColumn(split_col, F.when(F.col("_nf_t"), "test").when(F.col("_nf_v"), "val")
                         .otherwise("train")).drop("_nf_t", "_nf_v"))


def transfer_split(df: DataFrame, transfer_df: DataFrame, transfer_type: int, n_test: int, order_by,
                   split_col: str = "split") -> DataFrame:
    """SP4: own data split at the last ``n_test`` rows plus a transfer set.

    type 1: train = own rest, val = transfer;  type 2: train = transfer, val = own rest;
    type 3: as type 1, and the transfer set is also appended to train.
    """
    order = KeyOrder(df, order_by)
    total = order.total
    s0 = total - n_test
    n_last = total - (s0 if s0 >= 0 else max(0, total + s0))   # rows of data[n - n_test:]
    own = order.flag(df, order_by, n_last, True, "_nf_t")
    rest = "val" if transfer_type == 2 else "train"
    own = own.withColumn(split_col, F.when(F.col("_nf_t"), "test").otherwise(rest)).drop("_nf_t")
    tr_name = "train" if transfer_type == 2 else "val"
    out = own.unionByName(transfer_df.withColumn(split_col, F.lit(tr_name)), allowMissingColumns=True)
    if transfer_type == 3:
        out = out.unionByName(transfer_df.withColumn(split_col, F.lit("train")), allowMissingColumns=True)
    return out


def random_split(df: DataFrame, key: str, frac: float = 0.2, seed: int = 42, split_col: str = "split",
                 names=("train", "val"), exact: bool = True) -> DataFrame:
    """SP5: seeded split; the second part has exactly ``ceil(n * frac)`` rows.

    Rows with the smallest ``draw(seed, key)`` go to the second part.  With
    ``exact=False`` a threshold on the draw gives the expected size without a
    count or ranking pass.
    """
    h = draw(seed, key)
    if not exact:
        cut = int(frac * (1 << 60))
        return df.withColumn(split_col, F.when(h < F.lit(cut), names[1]).otherwise(names[0]))
    drawn, by = df.withColumn("_nf_h", h), ["_nf_h", key]
    order = KeyOrder(drawn, by)
    f = order.flag(drawn, by, math.ceil(order.total * frac), False, "_nf_s")
    return (f.withColumn(split_col, F.when(F.col("_nf_s"), names[1]).otherwise(names[0]))
             .drop("_nf_s", "_nf_h"))


def subsample_sizes(df: DataFrame, sizes, key: str, seed: int = 42, test_frac: float = 0.2,
                    split_col: str = "split") -> DataFrame:
    """SP6: nested seeded subsamples (size 0 = all rows), each split at ``test_frac``.

    One global rank by ``draw(seed, key)`` orders all rows; the sample of size s
    is the first s rows, so smaller samples nest in larger ones.  Inside each
    sample the test part is the ``ceil(s' * test_frac)`` rows with the smallest
    second draw (s' = actual sample size).
    """
    ranked = global_rank(df.withColumn("_nf_h", draw(seed, key)), ["_nf_h", key], "_nf_r").drop("_nf_h")
    n = df.count()
    pairs = F.array(*[F.struct(F.lit(int(s)).cast("long").alias("sample_size"),
                                F.lit(int(min(s, n) if s else n)).cast("long").alias("_nf_eff"))
                      for s in sizes])
    exploded = (ranked.withColumn("_nf_s", F.explode(pairs)).select("*", "_nf_s.*").drop("_nf_s")
                      .filter(F.col("_nf_r") <= F.col("_nf_eff")))
    exploded = exploded.withColumn("_nf_h2", draw(seed + 1, key))
    within = rank_within(exploded, ["sample_size"], ["_nf_h2", key], "_nf_w")
    m = F.ceil(F.col("_nf_eff") * F.lit(test_frac))
    return (within.withColumn(split_col, F.when(F.col("_nf_w") <= m, "test").otherwise("train"))
                  .drop("_nf_r", "_nf_eff", "_nf_h2", "_nf_w"))


def kfold(df: DataFrame, k: int, label: str, key: str, seed: int = 42, fold_col: str = "fold") -> DataFrame:
    """SP7: stratified k-fold: inside each class, rows in draw order are dealt to folds
    0..k-1 in turn, so every fold gets floor or ceil of the class's n/k."""
    h = df.withColumn("_nf_h", draw(seed, key))
    r = rank_within(h, [label], ["_nf_h", key], "_nf_r")
    return r.withColumn(fold_col, ((F.col("_nf_r") - 1) % k).cast("int")).drop("_nf_h", "_nf_r")
