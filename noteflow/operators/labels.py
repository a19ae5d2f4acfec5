"""Label encoding (L1-L6): a class dimension ``(class, code)`` joined to the facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .order import dim_rank, lookup_side


def fit_label_encoder(df: DataFrame, col: str, class_col: str = "class", code_col: str = "code") -> DataFrame:
    """L1: codes 0..K-1 in sorted (code-point) class order."""
    classes = df.select(F.col(col).alias(class_col)).filter(F.col(class_col).isNotNull()).distinct()
    return dim_rank(classes, [class_col], code_col).withColumn(code_col, (F.col(code_col) - 1).cast("int"))


def apply_label_encoder(df: DataFrame, enc: DataFrame, col: str, out: str = "label",
                        invalid: str = "error", class_col: str = "class", code_col: str = "code") -> DataFrame:
    """L2: encode ``col`` with a fitted encoder; unseen class -> error, ``keep`` (null) or ``skip``."""
    e = lookup_side(enc.select(F.col(class_col).alias("_nf_c"), F.col(code_col).alias(out)))
    how = "inner" if invalid == "skip" else "left"
    j = df.join(e, df[col] == e["_nf_c"], how)
    if invalid == "error":
        j = j.withColumn(out, F.when(F.col("_nf_c").isNull() & F.col(col).isNotNull(),
                                     F.raise_error(F.concat(F.lit("unseen label: "), F.col(col).cast("string"))))
                         .otherwise(F.col(out)).cast("int"))
    return j.drop("_nf_c")


def fit_first_seen_encoder(df: DataFrame, col: str, order_by, class_col: str = "class",
                           code_col: str = "code") -> DataFrame:
    """L3: codes by order of first appearance."""
    first = (df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias(class_col))
               .agg(F.min(F.struct(*[F.col(c) for c in order_by])).alias("_nf_first")))
    return (dim_rank(first, ["_nf_first"], code_col)
            .withColumn(code_col, (F.col(code_col) - 1).cast("int")).drop("_nf_first"))


def extend_encoder(enc: DataFrame, new_classes: DataFrame, class_col: str = "class",
                   code_col: str = "code") -> DataFrame:
    """L4: append unseen classes after the existing codes (in sorted order); old codes kept."""
    top = enc.agg(F.max(code_col)).first()[0]
    top = -1 if top is None else top
    fresh = (new_classes.select(F.col(new_classes.columns[0]).alias(class_col)).filter(F.col(class_col).isNotNull())
             .distinct().join(enc.select(class_col), class_col, "left_anti"))
    ranked = dim_rank(fresh, [class_col], code_col).withColumn(code_col, (F.col(code_col) + top).cast("int"))
    return enc.select(class_col, code_col).unionByName(ranked)


def class_code(enc: DataFrame, names=None, codes=None, class_col: str = "class",
               code_col: str = "code") -> DataFrame:
    """Look up codes by name and/or names by code (any number of each)."""
    cond = F.lit(False)
    if names:
        cond = cond | F.col(class_col).isin(list(names))
    if codes:
        cond = cond | F.col(code_col).isin(list(codes))
    return enc.filter(cond)


def decode_labels(df: DataFrame, enc: DataFrame, col: str, out: str = "class_name",
                  class_col: str = "class", code_col: str = "code") -> DataFrame:
    """Code -> class name."""
    e = lookup_side(enc.select(F.col(code_col).alias("_nf_k"), F.col(class_col).alias(out)))
    return df.join(e, df[col] == e["_nf_k"], "left").drop("_nf_k")
