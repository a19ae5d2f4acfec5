"""Seeded hash draws that are independent of partitioning.

``draw(seed, k1, k2, ...)`` is the first 60 bits of ``md5('seed:k1:k2...')`` read as a
non-negative BIGINT.  Every seeded operator (random split, k-fold, negative
sampling, example draws, sentence shuffle) uses it instead of ``rand()`` so a
result does not depend on how rows are partitioned or on task retries, and an
SQL engine with ``md5`` can repeat it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _as_col(k) -> Column:
    return k if isinstance(k, Column) else F.col(k)


def hash_text(seed, *keys) -> Column:
    parts = [F.lit(str(seed))]
    for k in keys:
        parts += [F.lit(":"), _as_col(k).cast("string")]
    return F.concat(*parts)


def draw(seed, *keys) -> Column:
    """Uniform 60-bit draw per (seed, keys); a BIGINT in [0, 2**60)."""
    return F.conv(F.substring(F.md5(hash_text(seed, *keys)), 1, 15), 16, 10).cast("bigint")


def draw_sql(seed, *keys: str) -> str:
    """The same draw as an SQL expression (DuckDB dialect) for the oracle."""
    inner = " || ':' || ".join([f"'{seed}'"] + [f"CAST({k} AS VARCHAR)" for k in keys])
    return f"CAST(('0x' || substr(md5({inner}), 1, 15)) AS BIGINT)"
