"""Learned sentence borders (T6): abbreviations from corpus counts alone, no labelled text.

A period after a word ends a sentence unless the word is an abbreviation.  Following Kiss and Strunk
(2006), a word is one if periods follow it far more often than chance: with N words, N_p of them
before a period, and a word seen c times, c_p of them before a period, the score is the log
likelihood ratio of (always a period) against (a period at the corpus rate), times exp(-length),
times its inner periods + 1, times length^-(c - c_p).

``learn_abbreviations`` is one aggregate over the words (map-side combined, so a frequent word is
one row per partition); ``split_sentences_learned`` applies the abbreviations as a Column: no
Python, no join.  Single letters before a period count as initials and end no sentence.

Words are what stands between white space, without brackets and quotes around it and without
``,;:!?`` behind it, in lower case; words with other characters than letters, hyphens and inner
periods are no abbreviations.  Null texts have no words and split to null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Least score and least count of an abbreviation, as the method's authors set them.
LEAST_SCORE = 0.3
LEAST_COUNT = 2
#: Rate of periods behind an abbreviation under the alternative.
ALWAYS = 0.99
#: What a border is marked with while a text is cut (a private-use character).
MARK = "\ue000"

_EDGE_L, _EDGE_R = r"^[(\"'\[]+", r"[,;:!?)\"'\]]+$"
_WORD = r"^[\p{L}.\-]*\p{L}[\p{L}.\-]*$"
_CANDIDATE = r"([.!?]+[\"')\]]*\s+)([\"'(\[]*[\p{Lu}\p{N}])"


def word_counts(df: DataFrame, text_col: str) -> DataFrame:
    """(word, c, c_period): how often a word occurs, and before a period."""
    raw = df.select(F.explode_outer(F.split(F.lower(F.col(text_col)), r"\s+")).alias("t")).where(F.col("t").isNotNull())
    core = raw.select(F.regexp_replace(F.regexp_replace("t", _EDGE_L, ""), _EDGE_R, "").alias("t"))
    period = F.col("t").endswith(".")
    words = core.select(F.regexp_replace("t", r"\.+$", "").alias("word"), period.cast("long").alias("p")).where(F.col("word").rlike(_WORD))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("c"), F.sum("p").alias("c_period"))


def abbreviation_scores(counts: DataFrame) -> DataFrame:
    """``counts`` of words that periods follow, with their ``score``."""
    total = counts.agg(F.sum("c").alias("n"), F.sum("c_period").alias("n_p")).first()
    n, n_p = total["n"] or 0, total["n_p"] or 0
    rate = min(max(n_p / n, 1e-9), 1 - 1e-9) if n else 0.5
    without = F.col("c") - F.col("c_period")
    chance = F.col("c_period") * F.log(F.lit(rate)) + without * F.log(F.lit(1 - rate))
    always = F.col("c_period") * F.log(F.lit(ALWAYS)) + without * F.log(F.lit(1 - ALWAYS))
    length = F.char_length(F.regexp_replace("word", r"\.", "")).cast("double")
    inner = F.char_length("word") - length
    score = -2 * (chance - always) * F.exp(-length) * (inner + 1) * F.pow(length, -without.cast("double"))
    return counts.where(F.col("c_period") > 0).withColumn("score", score)


def learn_abbreviations(df: DataFrame, text_col: str, least_score: float = LEAST_SCORE, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, c, c_period, score) of the corpus's abbreviations."""
    return abbreviation_scores(word_counts(df, text_col)).where((F.col("score") >= least_score) & (F.col("c_period") >= least_count))


def split_sentences_learned(text: Column, abbreviations) -> Column:
    """Sentences of ``text`` (``array<string>``, trimmed, none empty): cut behind ``.!?`` before an upper-case
    letter or a digit, and at line breaks, but not behind an abbreviation or an initial.  The
    abbreviations travel in the plan as a hash set; ``least_count`` of the learner bounds them."""
    known = sorted({a for a in abbreviations})
    pieces = F.split(F.regexp_replace(text, _CANDIDATE, "$1" + MARK + "$2"), MARK)

    def ends(piece: Column) -> Column:
        last = F.regexp_extract(piece, r"(\S+)\.\s+$", 1)
        word = F.lower(F.regexp_replace(last, _EDGE_L, ""))
        stop = word.isin(known) if known else F.lit(False)
        return F.concat(piece, F.when(stop | word.rlike(r"^\p{L}$"), "").otherwise(MARK))

    cut = F.split(F.array_join(F.transform(pieces, ends), ""), "[\n" + MARK + "]+")
    return F.filter(F.transform(cut, lambda s: F.trim(s)), lambda s: s != "")
