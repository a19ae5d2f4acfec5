"""Projections, filters, predicates (P1-P11) and ordered de-duplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.constants import (COMMENT_QUESTION, DATE_DMY_PATTERN, DATE_YMD_PATTERN,
                                   NUMBER_PATTERN)
from ..functions.text import parse_date, word_count


def clean_names(df: DataFrame, renames: dict[int, str] | None = None,
                date_col: str | None = "date", date_fmt: str = "yyyy-MM-dd") -> DataFrame:
    """Rename columns by position, spaces -> '_', strip a literal '_(FSIII)' suffix,
    parse the date column (invalid -> null)."""
    names = list(df.columns)
    for i, n in (renames or {}).items():
        names[i] = n
    names = [n.replace(" ", "_").replace("_(FSIII)", "") for n in names]
    out = df.toDF(*names)
    if date_col and date_col in out.columns:
        out = out.withColumn(date_col, parse_date(F.col(date_col).cast("string"), date_fmt))
    return out


def select_as(df: DataFrame, cols: list[str], new_names: list[str]) -> DataFrame:
    """Project and rename positionally (e.g. to the training schema ``text, labels``)."""
    return df.select(*[F.col(c).alias(n) for c, n in zip(cols, new_names)])


def drop_null(df: DataFrame, subset: list[str]) -> DataFrame:
    """Keep rows where every listed column is non-null."""
    return df.dropna(how="any", subset=subset)


def is_number(c: Column) -> Column:
    return c.rlike(NUMBER_PATTERN)


def _valid_ymd(y: Column, m: Column, d: Column) -> Column:
    ok = y.between(1, 9999) & m.between(1, 12) & (d >= 1)
    month_len = F.dayofmonth(F.last_day(F.make_date(y, m, F.lit(1))))
    return F.when(ok, d <= month_len).otherwise(F.lit(False))


def is_date(c: Column) -> Column:
    """Text that is a whole valid calendar date, ``yyyy-m-d`` / ``yyyy/m/d`` or
    ``d-m-yyyy`` (either day-first or month-first valid), with an optional time."""
    def g(p, i):
        return F.regexp_extract(c, p, i).try_cast("int")
    ymd = c.rlike(DATE_YMD_PATTERN) & _valid_ymd(g(DATE_YMD_PATTERN, 1), g(DATE_YMD_PATTERN, 2),
                                                  g(DATE_YMD_PATTERN, 3))
    a, b, y = g(DATE_DMY_PATTERN, 1), g(DATE_DMY_PATTERN, 2), g(DATE_DMY_PATTERN, 3)
    dmy = c.rlike(DATE_DMY_PATTERN) & (_valid_ymd(y, a, b) | _valid_ymd(y, b, a))
    return ymd | dmy


def drop_date_numeric(df: DataFrame, subset: list[str]) -> DataFrame:
    """Drop rows whose text is entirely a number or a date; nulls survive."""
    out = df
    for c in subset:
        col = F.col(c)
        out = out.filter(~F.coalesce(is_number(col) | is_date(col), F.lit(False)))
    return out


def min_len(df: DataFrame, len_col: str, threshold: int = 5) -> DataFrame:
    """P5: keep rows with ``len_col >= threshold``."""
    return df.filter(F.col(len_col) >= threshold)


def keep_classes(df: DataFrame, col: str, values) -> DataFrame:
    """Keep rows whose class is in ``values`` (a list or a one-column DataFrame)."""
    if isinstance(values, DataFrame):
        v = values.select(F.col(values.columns[0]).alias(col))
        return df.join(v, col, "left_semi")
    return df.filter(F.col(col).isin(list(values)))


def exclude_classes(df: DataFrame, col: str, values) -> DataFrame:
    """Drop rows whose class is in ``values``; a null class is kept."""
    if isinstance(values, DataFrame):
        v = values.select(F.col(values.columns[0]).alias("_nf_v")).filter(F.col("_nf_v").isNotNull())
        return df.join(v, F.col(col) == F.col("_nf_v"), "left_anti")
    return df.filter(~F.coalesce(F.col(col).isin(list(values)), F.lit(False)))


def with_constants(df: DataFrame, consts: dict) -> DataFrame:
    """Add constant columns."""
    return df.withColumns({k: F.lit(v) for k, v in consts.items()})


def fill_empty(df: DataFrame, cols: list[str]) -> DataFrame:
    """Null text -> ''."""
    return df.fillna("", subset=cols)


def drop_cols(df: DataFrame, cols: list[str] | None = None, suffix: str | None = None) -> DataFrame:
    """Drop the named columns and/or every column ending in ``suffix``."""
    names = list(cols or [])
    if suffix:
        names += [c for c in df.columns if c.endswith(suffix)]
    return df.drop(*names)


def positives(df: DataFrame, label_col: str = "labels") -> DataFrame:
    """P10: rows with ``label == 1``."""
    return df.filter(F.col(label_col) == 1)


def comments_as_answers(df: DataFrame, comment_col: str = "comments_") -> DataFrame:
    """A joined comment becomes the answer, with the fixed question text."""
    base = df.drop("ObservationAnswer", "ObservationQuestion", "ObservationAnswer_len")
    return (base.withColumnRenamed(comment_col, "ObservationAnswer")
                .withColumn("ObservationQuestion", F.lit(COMMENT_QUESTION))
                .fillna("", subset=["ObservationAnswer"]))


def len_words(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """T3 as an operator: ``<col>_len`` = white-space token count."""
    return df.withColumn(out or f"{col}_len", word_count(col))


def date_parts(df: DataFrame, date_col: str, fmt: str = "yyyy/MM/dd") -> DataFrame:
    """Year, month, day of a date column given as text or date."""
    d = parse_date(date_col, fmt) if dict(df.dtypes)[date_col] == "string" else F.col(date_col)
    return df.withColumns({"year": F.year(d), "month": F.month(d), "day": F.dayofmonth(d)})


def _dedup(df: DataFrame, subset: list[str], order_by: list[str], last: bool) -> DataFrame:
    cols = df.columns
    row = F.struct(*[F.col(c) for c in cols])
    order = F.struct(*[F.col(c) for c in order_by])
    pick = F.max_by(row, order) if last else F.min_by(row, order)
    # Hash aggregate with a map-side partial step: a hot key is reduced to one
    # row per input partition before the shuffle, so skew never reaches one task.
    return df.groupBy(*subset).agg(pick.alias("_nf_row")).select("_nf_row.*").select(*cols)


def dedup_last(df: DataFrame, subset: list[str], order_by: list[str]) -> DataFrame:
    """Keep the last row (in ``order_by`` order) per ``subset`` key; nulls compare equal."""
    return _dedup(df, subset, order_by, last=True)


def dedup_first(df: DataFrame, subset: list[str], order_by: list[str]) -> DataFrame:
    """Keep the first row per key."""
    return _dedup(df, subset, order_by, last=False)
