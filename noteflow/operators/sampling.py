"""Sampling (N1-N4) and set operations."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import draw
from ..functions.text import parse_date
from ..session import staged
from .order import KeyOrder, RowOrder, global_rank, rank_within
from .sorting import head_rows, sort_by_date


def negative_samples(df: DataFrame, change_cols, scheme_col: str = "ObservationScheme",
                     key="obs_id", seed: int = 100, label_col: str = "labels",
                     len_col: str | None = "ObservationAnswer_len", within: str | None = None, reread: bool = False) -> DataFrame:
    """For every row, take ``change_cols`` from a uniformly drawn row of a
    *different* scheme (and, with ``within``, the same value of that column, e.g.
    answers draw from answers and comments from comments); label 0.  O(n): the rows
    are ranked by key once, and all joins are by row number.

    Rows in (within, scheme, key) order occupy a contiguous block
    ``[lo_s, lo_s+m_s)`` per scheme inside the part ``[p_lo, p_lo+p_n)``.  A row
    of scheme s draws ``r = draw(seed, key) mod (p_n - m_s)`` and takes row
    ``p_lo + r`` if ``r < lo_s - p_lo`` else ``p_lo + r + m_s`` - uniform over the
    part's rows of other schemes.  Row numbers are unique, also where keys repeat, so
    the join never fans out, and targets are uniform, so it is not skewed.  A hot scheme
    is spread over many range partitions.

    With ``reread`` (see :class:`RowOrder`) rows are not staged: donors' columns move once, to
    the rows that drew them, and not at all if they are not selected.
    """
    order, neg = _negatives(df, change_cols, scheme_col, key, seed, label_col, len_col, within, reread)
    return neg.drop("_nf_ro_row")


def _negatives(df: DataFrame, change_cols, scheme_col, key, seed, label_col, len_col, within, reread) -> tuple[RowOrder, DataFrame]:
    """The order of the rows, and their negatives with the row number (``_nf_ro_row``)."""
    keys = [key] if isinstance(key, str) else list(key)
    group = [*([within] if within else []), scheme_col]
    change = list(change_cols) + ([len_col] if len_col and len_col in df.columns else [])
    order = RowOrder(df, [*group, *keys], reread=reread)
    names, drawn_by = order.keys.names[:len(group)], order.keys.names[len(group):len(group) + len(keys)]
    ranks = order.positions("_nf_idx", first=0)
    blocks = ranks.groupBy(*names).agg(F.min("_nf_idx").alias("_nf_lo"), F.count(F.lit(1)).alias("_nf_m"))
    if within:
        span = blocks.groupBy(F.col(names[0]).alias("_nf_part")).agg(F.min("_nf_lo").alias("_nf_plo"), F.sum("_nf_m").alias("_nf_pn"))
        side = blocks.join(span, F.col(names[0]).eqNullSafe(F.col("_nf_part"))).drop("_nf_part")
    else:
        side = blocks.withColumns({"_nf_plo": F.lit(0).cast("long"), "_nf_pn": F.lit(order.total).cast("long")})
    side = staged(side.select(*[F.col(n).alias(f"{n}_b") for n in names], "_nf_lo", "_nf_m", "_nf_plo", "_nf_pn"))
    alone = side.where(F.col("_nf_m") == F.col("_nf_pn")).first()
    if alone:
        raise ValueError("negative sampling needs at least two schemes" + (f" in {within}={alone[0]}" if within else ""))
    r = F.col("_nf_draw") % (F.col("_nf_pn") - F.col("_nf_m"))
    target = F.col("_nf_plo") + F.when(r < F.col("_nf_lo") - F.col("_nf_plo"), r).otherwise(r + F.col("_nf_m"))
    drawn = (ranks.join(side, [F.col(n).eqNullSafe(F.col(f"{n}_b")) for n in names])
                  .withColumn("_nf_draw", F.coalesce(draw(seed, *drawn_by), draw(seed, "_nf_idx")))
                  .select(F.col(order.row).alias("_nf_to"), target.alias("_nf_t")))
    # row numbers only: who receives from whom
    pairs = drawn.join(ranks.select(F.col("_nf_idx").alias("_nf_t"), F.col(order.row).alias("_nf_from")), "_nf_t").drop("_nf_t")
    if reread:   # donors that nobody drew (about a third) are left out before their columns are read: a subquery filter
        pairs = staged(pairs)   # is pushed down to the keys, a semi join stays above the joins and computed columns of the rows
        source = order.rows.where(F.col("_nf_ro_row").isin(pairs.select("_nf_from").distinct()))
    else:
        source = order.rows
    donors = source.select(F.col("_nf_ro_row").alias("_nf_donor"), *[F.col(c).alias("_nf_d_" + c) for c in change])
    joined = (order.rows.join(pairs, F.col("_nf_ro_row") == F.col("_nf_to")).join(donors, F.col("_nf_from") == F.col("_nf_donor")))
    values = {c: F.col("_nf_d_" + c) for c in change} | {label_col: F.lit(0)}
    return order, joined.select(*[values[c].alias(c) if c in values else F.col(c) for c in df.columns],
                                *([F.lit(0).alias(label_col)] if label_col not in df.columns else []), "_nf_ro_row")


def pos_neg(pos: DataFrame, change_cols, scheme_col: str = "ObservationScheme", key: str = "obs_id",
            seed: int = 100, label_col: str = "labels", date_col: str = "LastUpdateDate", reread: bool = False) -> DataFrame:
    """Positives (label 1) and their negatives (label 0), date sorted: year, month, day and
    ``pos`` (date ascending, invalid dates first, ties by key and label).

    Every row is known by the number of its positive and its label, so only dates and keys are
    ranked; the position joins the rows in their columns that are used, and rows whose position
    is not used are not joined at all."""
    p = pos.withColumn(label_col, F.lit(1))
    order, neg = _negatives(p, change_cols, scheme_col, key, seed, label_col, "ObservationAnswer_len", None, reread)
    both = order.rows.select(*p.columns, "_nf_ro_row").unionByName(neg)
    dated = lambda df: df.withColumn("_nf_d", parse_date(date_col))
    marks = dated(order.rows).select("_nf_d", F.col(key).alias("_nf_key"), F.explode(F.array(F.lit(0), F.lit(1))).alias("_nf_label"),
                                     "_nf_ro_hash", F.col("_nf_ro_row").alias("_nf_own"))
    ranks = KeyOrder(marks, ["_nf_d", "_nf_key", "_nf_label", "_nf_ro_hash", "_nf_own"])
    at = ranks.ranks("pos").groupBy(F.col(ranks.names[4]).alias("_nf_own"), F.col(ranks.names[2]).alias("_nf_label")).agg(F.max("pos").alias("pos"))
    placed = dated(both).withColumns({"year": F.year("_nf_d"), "month": F.month("_nf_d"), "day": F.dayofmonth("_nf_d")}).drop("_nf_d")
    return placed.join(at, (F.col("_nf_ro_row") == F.col("_nf_own")) & (F.col(label_col) == F.col("_nf_label")), "left") \
                 .drop("_nf_ro_row", "_nf_own", "_nf_label")


def examples_per_outcome(df: DataFrame, k: int, key: str, outcome_col: str = "outcome", seed: int = 0,
                         reread: bool = False) -> DataFrame:
    """``k`` rows drawn with replacement from each outcome (TP/TN/FP/FN); ``reread``: see :class:`RowOrder`.

    Draw i of outcome o takes the row at position ``1 + draw(seed, o, i) mod n_o``
    of that outcome (positions in ``key`` order); an empty outcome gives no rows.
    """
    draws = df.groupBy(F.col(outcome_col).alias("_nf_o")).agg(F.count(F.lit(1)).alias("_nf_n")) \
              .withColumn("draw_no", F.explode(F.sequence(F.lit(0), F.lit(max(k, 1) - 1)))).where(F.col("draw_no") < k)
    draws = draws.select("_nf_o", F.col("draw_no").cast("int").alias("draw_no"),
                         (1 + draw(seed, F.coalesce(F.col("_nf_o").cast("string"), F.lit("")), "draw_no") % F.col("_nf_n")).alias("_nf_want"))
    ranked = rank_within(df, [outcome_col], [key], "_nf_pos", reread=reread)
    return ranked.join(draws, F.col(outcome_col).eqNullSafe(F.col("_nf_o")) & (F.col("_nf_want") == F.col("_nf_pos"))) \
                 .select(*df.columns, "draw_no")


def shuffle_rows(df: DataFrame, key: str, seed: int = 0, pos_col: str = "pos") -> DataFrame:
    """Seeded permutation; ``pos`` is the row's position in the shuffled order."""
    h = df.withColumn("_nf_h", draw(seed, key))
    return global_rank(h, ["_nf_h", key], pos_col).drop("_nf_h")


# ---------------------------------------------------------------- set operations

def concat_sorted(df1: DataFrame, df2: DataFrame, date_col: str = "LastUpdateDate",
                  order_by=("obs_id",), fmt: str = "yyyy/MM/dd", pos_col: str = "pos") -> DataFrame:
    """Union by name (missing columns null), then sort by date (O1)."""
    u = df1.unionByName(df2, allowMissingColumns=True)
    return sort_by_date(u, date_col, list(order_by), fmt, pos_col)


def append_tail(df: DataFrame, extra: DataFrame, n: int, order_by, key: str, seed: int = 0,
                pos_col: str = "pos") -> DataFrame:
    """Append the last ``n`` rows of ``extra`` (all of them, with a warning, if
    fewer are available) and shuffle."""
    order = KeyOrder(extra, order_by)
    if order.total < n:
        warnings.warn(f"append_tail: fewer than {n} rows available; appending all of them", stacklevel=2)
    tail = order.flag(extra, order_by, n, True, "_nf_f").filter("_nf_f").drop("_nf_f")
    u = df.unionByName(tail, allowMissingColumns=True)
    return shuffle_rows(u, key, seed, pos_col)


def append_placeholder(df: DataFrame, template: DataFrame, order_by, text_col: str, text: str) -> DataFrame:
    """Append one copy of the first ``template`` row with its text replaced."""
    one = head_rows(template, 1, order_by).withColumn(text_col, F.lit(text))
    return df.unionByName(one, allowMissingColumns=True)


def append_matrix(df: DataFrame, other: DataFrame) -> DataFrame:
    """U4: concatenate two feature sets (union by name)."""
    return df.unionByName(other, allowMissingColumns=True)
