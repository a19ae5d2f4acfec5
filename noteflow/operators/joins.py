"""Joins (J1-J9): lookups, semi/anti filters and the goal-scheme relevance join."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_text
from ..session import staged
from .order import bounded_broadcast, lookup_side


def _null_safe(left: DataFrame, right: DataFrame, keys: list[str], rprefix: str):
    """Rename right keys and build a null-safe equality (pandas merge pairs NaN keys)."""
    r = right.select(*[F.col(c).alias(rprefix + c) if c in keys else F.col(c) for c in right.columns])
    cond = reduce(lambda a, b: a & b, [left[k].eqNullSafe(r[rprefix + k]) for k in keys])
    return r, cond


def join_comments(data: DataFrame, comments: DataFrame, keys: list[str]) -> DataFrame:
    """Inner equi-join on the form keys; null keys match each other."""
    r, cond = _null_safe(data, comments, keys, "_nf_r_")
    return data.join(r, cond, "inner").drop(*["_nf_r_" + k for k in keys])


def decode_names(df: DataFrame, converter: DataFrame, col: str = "type",
                 out: str = "ObservationScheme", clean_col: str = "clean_scheme",
                 original_col: str = "original_scheme") -> DataFrame:
    """Left lookup clean name -> original name; unmatched -> null.

    A converter with several rows for one clean name is reduced to its
    smallest original name, so the lookup never fans out.
    """
    conv = (converter.groupBy(clean_col).agg(F.min(original_col).alias(out))
                     .withColumnRenamed(clean_col, "_nf_clean"))
    base = df.drop(out) if out in df.columns and out != col else df
    return (base.join(bounded_broadcast(conv), base[col] == conv["_nf_clean"], "left")
                .drop("_nf_clean"))


def semi_filter(df: DataFrame, keys_df: DataFrame, col: str, key_col: str | None = None) -> DataFrame:
    """Keep rows whose ``col`` appears in ``keys_df``."""
    k = keys_df.select(F.col(key_col or keys_df.columns[0]).alias(col)).distinct()
    return df.join(lookup_side(k), col, "left_semi")


def _clean_goals(goals: DataFrame, goal_col: str) -> DataFrame:
    return goals.select(clean_text(goal_col).alias("type")).distinct()


def keep_relevant(df: DataFrame, goals: DataFrame, scheme_col: str = "ObservationScheme",
                  order_by: list[str] = ("obs_id",), goal_col: str = "type",
                  all_spellings: bool = False) -> DataFrame:
    """Keep rows of goal schemes; the cleaned scheme goes to column ``type``.

    Both sides are normalised with :func:`clean_text`.  Faithful mode keeps, per
    goal, only the first raw spelling seen in ``order_by`` order (rows with
    other spellings of the same cleaned name are dropped); ``all_spellings``
    keeps every row whose cleaned name is a goal.
    """
    g = _clean_goals(goals, goal_col)
    cleaned = df.withColumn("_nf_clean", clean_text(scheme_col))
    if all_spellings:
        kept = cleaned.join(g.withColumnRenamed("type", "_nf_clean"), "_nf_clean", "left_semi")
    else:
        order = F.struct(*[F.col(c) for c in order_by])
        first = (cleaned.groupBy("_nf_clean")
                        .agg(F.min_by(F.col(scheme_col), order).alias("_nf_raw"))
                        .join(g.withColumnRenamed("type", "_nf_clean"), "_nf_clean", "left_semi")
                        .select("_nf_raw"))
        first = lookup_side(first)     # a few spellings: the rows and their texts are not moved by scheme
        kept = cleaned.join(first, cleaned[scheme_col] == first["_nf_raw"], "left_semi")
    cols = [F.col("_nf_clean").alias("type") if c == scheme_col else F.col(c) for c in df.columns]
    return kept.select(*cols)


def unmatched_goals(df: DataFrame, goals: DataFrame, scheme_col: str = "ObservationScheme",
                    goal_col: str = "type") -> DataFrame:
    """Cleaned goal names with no matching row.  The rows are reduced to their
    distinct spellings, then names, map-side; the fact table itself is never shuffled."""
    seen = df.select(scheme_col).distinct().select(clean_text(scheme_col).alias("type")).distinct()
    return _clean_goals(goals, goal_col).join(seen, "type", "left_anti")


def anti_keys(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``df`` whose key tuple is not in ``other`` (nulls match nulls)."""
    r, cond = _null_safe(df, other.select(*keys).distinct(), keys, "_nf_r_")
    return df.join(r, cond, "left_anti")


def cross_with_classes(df: DataFrame, classes: DataFrame, class_col: str = "class") -> DataFrame:
    """Pair each row with every distinct class (rows x classes by definition).

    The class list is one array value, a scalar subquery of the same plan; each row is
    expanded with ``explode``, so there is no cartesian product and nothing is collected.
    """
    names = (classes.select(F.col(class_col).alias("_nf_c")).filter(F.col("_nf_c").isNotNull())
                    .agg(F.array_sort(F.collect_set("_nf_c")).alias("_nf_list")).scalar())
    base = df.drop(class_col) if class_col in df.columns else df
    return base.withColumn(class_col, F.explode(names))


def attach_by_row_id(df: DataFrame, labels: DataFrame, row_id: str = "row_id") -> DataFrame:
    """Attach labels / predictions to rows by their row id (inner join)."""
    return df.join(labels, row_id, "inner")


def common_classes(splits: DataFrame, label_col: str = "label", split_col: str = "split",
                   names=("train", "val", "test")) -> DataFrame:
    """Keep rows whose class occurs in every listed split."""
    names = list(names)
    present = (splits.filter(F.col(split_col).isin(names))
                     .groupBy(label_col).agg(F.countDistinct(split_col).alias("_nf_n"))
                     .filter(F.col("_nf_n") == len(names)).select(label_col))
    # written first, so the planner knows its size: a small class list is broadcast and the
    # rows stay where they are, a large one is shuffle-joined
    return splits.join(staged(present), label_col, "left_semi")


__all__ = ["join_comments", "decode_names", "semi_filter", "keep_relevant", "unmatched_goals",
           "anti_keys", "cross_with_classes", "attach_by_row_id", "common_classes"]
