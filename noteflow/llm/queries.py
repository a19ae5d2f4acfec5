"""The operators' queries and their SQL, as ``__spark_entry__`` adds them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import curriculum, decontam, langid, licences, lines, lm, minhash, packing, quality, repair, substrings, trie, vectors
from .util import prepare

_OPS = [
    substrings.op1_longest_previous_factor,
    minhash.op2_bbit_minhash,
    langid.op3_language_bitmask,
    vectors.op4_subspace_pigeonhole,
    packing.op5_best_fit_packing,
    licences.op6_licence_paragraphs,
    lm.op7_log_bilinear,
    quality.op8_hierarchical_quality,
    lines.op9_line_suffix_array,
    decontam.op10_greedy_tiling,
    trie.op11_parentheses_trie,
    curriculum.op12_curriculum_mix,
    repair.op13_bidirectional_repair,
]


def _prepared(fn: Callable[[SparkSession, str], DataFrame]):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return fn(spark, sf_dir)
    query.__name__, query.__doc__ = fn.__name__, fn.__doc__
    return query


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {fn.__name__: _prepared(fn) for fn in _OPS}


def oracle_sql() -> dict[str, str]:
    return {"op9_line_suffix_array": lines.OP9_SQL, "op11_parentheses_trie": trie.OP11_SQL,
            "op12_curriculum_mix": curriculum.OP12_SQL, "op13_bidirectional_repair": repair.OP13_SQL}
