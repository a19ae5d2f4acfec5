"""Sort, limit and top-k (O1-O4) without single-partition plans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import parse_date
from .order import first_n_flag, global_rank, group_window, last_n_flag


def sort_by_date(df: DataFrame, date_col: str = "LastUpdateDate", order_by=("obs_id",),
                 fmt: str = "yyyy/MM/dd", pos_col: str = "pos") -> DataFrame:
    """O1: parse the date, add year/month/day and the sorted position ``pos``
    (date ascending, invalid dates first, ties by ``order_by``)."""
    d = parse_date(date_col, fmt)
    out = df.withColumn("_nf_d", d).withColumns(
        {"year": F.year("_nf_d"), "month": F.month("_nf_d"), "day": F.dayofmonth("_nf_d")})
    return global_rank(out, ["_nf_d", *order_by], pos_col).drop("_nf_d")


def topk_classes(scored: DataFrame, id_col: str, score_col: str, class_col: str, k: int,
                 rank_col: str = "rank") -> DataFrame:
    """O2: best ``k`` classes per sample (score descending, class name ascending).

    The window is partitioned by sample; a sample holds one row per class, so a
    window partition is bounded by the class count.
    """
    w = group_window([id_col], [F.col(score_col).desc(), F.col(class_col).asc()])
    return scored.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)


def head_rows(df: DataFrame, n: int, order_by) -> DataFrame:
    """O3: first ``n`` rows in ``order_by`` order."""
    return first_n_flag(df, n, order_by, "_nf_f").filter("_nf_f").drop("_nf_f")


def tail_rows(df: DataFrame, n: int, order_by) -> DataFrame:
    """O3: last ``n`` rows in ``order_by`` order."""
    return last_n_flag(df, n, order_by, "_nf_f").filter("_nf_f").drop("_nf_f")


def row_range(df: DataFrame, lo: int, hi: int | None, order_by, pos_col: str = "pos") -> DataFrame:
    """Positional slice ``[lo:hi]`` (0-based, end exclusive; negative from the end)."""
    ranked = global_rank(df, order_by, pos_col)
    if lo < 0 or (hi is not None and hi < 0):
        n = df.count()
        lo = max(n + lo, 0) if lo < 0 else lo
        hi = (n + hi) if (hi is not None and hi < 0) else hi
    cond = F.col(pos_col) > lo
    if hi is not None:
        cond = cond & (F.col(pos_col) <= hi)
    return ranked.filter(cond)
