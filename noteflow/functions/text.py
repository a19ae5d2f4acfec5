"""Text, array and date scalar functions (T1-T13) as native Column expressions.

All of them stay inside whole-stage code generation: no Python UDF is used.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import (ASCII_PUNCTUATION, COMBINE_TOKENS, DANISH_STOPWORDS, LETTER_WORD, NON_WORD_CHARS,
                        NULL_SENTINEL, TOKEN_PATTERN)
from .hashing import hash_text


def _c(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def clean_text(c) -> Column:
    """Lower case, drop everything but letters, digits, '_' and white space, drop spaces."""
    low = F.lower(_c(c))
    return F.regexp_replace(F.regexp_replace(low, NON_WORD_CHARS, ""), " ", "")


def basic_clean(c) -> Column:
    """Lower case and strip ASCII punctuation, except the '\\N' sentinel."""
    c = _c(c)
    return F.when(c == F.lit(NULL_SENTINEL), c).otherwise(
        F.translate(F.lower(c), ASCII_PUNCTUATION, ""))


def word_count(c) -> Column:
    """Number of white-space separated tokens (Python ``len(s.split())``): one
    regex pass counting non-space runs, no intermediate array."""
    return F.regexp_count(_c(c), F.lit(r"\S+"))


def token_count(c) -> Column:
    """T4 for sentences: words plus punctuation marks, each counted as one token."""
    return F.regexp_count(_c(c), F.lit(TOKEN_PATTERN))


def tokens_to_string(c) -> Column:
    """T5: join tokens with one space."""
    return F.array_join(_c(c), " ")


def split_sentences(c, mode: str = "rule", language: str = "da", country: str = "DK") -> Column:
    """Split after '.', '!' or '?' followed by white space, and at line breaks.

    Returns ``array<string>`` of trimmed, non-empty sentences.  ``mode='locale'``
    uses the JVM's locale-aware sentence iterator (Spark ``sentences``) instead;
    its sentences are word lists without punctuation, joined here by one space.
    """
    if mode == "locale":
        words = F.sentences(_c(c), F.lit(language), F.lit(country))
        return F.filter(F.transform(words, lambda ws: F.array_join(ws, " ")), lambda x: x != "")
    marked = F.regexp_replace(_c(c), r"([.!?])\s+", "$1\n")
    parts = F.transform(F.split(marked, r"\n+"), lambda x: F.trim(x))
    return F.filter(parts, lambda x: x != "")


def shuffle_sentences(c, key, seed: int = 0, keep_tail: bool = False) -> Column:
    """Split on '.', drop the last piece, permute by a seeded hash, join with '.'.

    Null text becomes ''.  The permutation of piece i is ordered by
    ``md5(seed:key:i)``, so it does not depend on partitioning.
    """
    pieces = F.split(F.coalesce(_c(c).cast("string"), F.lit("")), r"\.", -1)
    if not keep_tail:
        pieces = F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0)))
    tagged = F.transform(pieces, lambda x, i: F.struct(
        F.md5(F.concat(hash_text(seed, key), F.lit(":"), i.cast("string"))).alias("h"),
        x.alias("p")))
    shuffled = F.transform(F.array_sort(tagged), lambda s: s["p"])
    return F.array_join(shuffled, ".")


def tokenize(c, stopwords=DANISH_STOPWORDS) -> Column:
    """Alphabetic words, stop words removed (tested before lower-casing), lower-cased."""
    # One regex pass yields the alphabetic words; ``isin`` over the stop list is
    # planned as a hash-set lookup (InSet), not a scan of the list per token.
    words = F.regexp_extract_all(_c(c), F.lit(LETTER_WORD), 0)
    kept = F.filter(words, lambda x: ~x.isin(*stopwords))
    return F.transform(kept, lambda x: F.lower(x))


def combine_fields(scheme, answer, question=None, version: int = 1) -> Column:
    """``tok0 + scheme + tok1 + [question + tok2 +] answer``; null in, null out."""
    if question is None:
        t0, t1 = COMBINE_TOKENS[("SchemeAnswer", version)]
        return F.concat(F.lit(t0), _c(scheme), F.lit(t1), _c(answer))
    t0, t1, t2 = COMBINE_TOKENS[("SchemeQuestionAnswer", version)]
    return F.concat(F.lit(t0), _c(scheme), F.lit(t1), _c(question), F.lit(t2), _c(answer))


def scheme_of_text(c, strip: bool = True) -> Column:
    """The part before the first '[SEP]'."""
    head = F.split(_c(c), r"\[SEP\]", 2).getItem(0)
    return F.trim(head) if strip else head


def combine_answer_comment(answer, comment) -> Column:
    """``answer + '.' + comment`` with nulls read as ''."""
    return F.concat(F.coalesce(_c(answer), F.lit("")), F.lit("."), F.coalesce(_c(comment), F.lit("")))


def parse_date(c, fmt: str = "yyyy/MM/dd") -> Column:
    """Parse a date string; an invalid value gives null instead of an error."""
    return F.to_date(F.try_to_timestamp(_c(c), F.lit(fmt)))
