"""Learned sentence borders."""

import math

import pytest
from pyspark.sql import functions as F

from noteflow.operators import borders as B


@pytest.fixture(scope="module")
def corpus(spark):
    rows = []
    for i in range(60):
        rows += [(f"Hun spiste bl.a. Brød kl. 8 i dag. Dr. Holm kom kl. 9. Han gik {'hjem' if i % 2 else 'ud'}.",),
                 ("Vi så ham i dag (f.eks. Jens). Alle er glade i dag!",), ("Hjem og ud går vi nu",), (None,), ("",)]
    return spark.createDataFrame(rows, "text string")


def test_counts_and_scores(spark, corpus):
    counts = {r["word"]: (r["c"], r["c_period"]) for r in B.word_counts(corpus, "text").collect()}
    assert counts["kl"] == (120, 120) and counts["dag"] == (180, 60) and counts["bl.a"] == (60, 60) and counts["f.eks"] == (60, 60)
    assert "8" not in counts and "" not in counts
    n, n_p = sum(c for c, _ in counts.values()), sum(p for _, p in counts.values())
    rate = n_p / n
    score = {r["word"]: r["score"] for r in B.abbreviation_scores(B.word_counts(corpus, "text")).collect()}
    assert score["bl.a"] == pytest.approx(-2 * 60 * (math.log(rate) - math.log(0.99)) * math.exp(-3) * 2)
    known = {r["word"] for r in B.learn_abbreviations(corpus, "text").collect()}
    assert {"kl", "bl.a", "dr", "f.eks"} <= known and not {"dag", "i", "hjem", "ud"} & known


def test_abbreviations_and_initials_end_no_sentence(spark):
    def split(text, known=("kl", "bl.a", "dr")):
        return spark.range(1).select(B.split_sentences_learned(F.lit(text), known).alias("s")).first()["s"]
    assert split("Hun kom kl. 8 i dag. Dr. Holm gik. Så blev der stille!") == ["Hun kom kl. 8 i dag.", "Dr. Holm gik.", "Så blev der stille!"]
    assert split("Mød A. P. Møller her. Tak.") == ["Mød A. P. Møller her.", "Tak."]
    assert split("Spis bl.a. Brød.  Nu\nlinje to") == ["Spis bl.a. Brød.", "Nu", "linje to"]
    assert split("Kl. 8 kom de (kl. 9 gik de). Slut") == ["Kl. 8 kom de (kl. 9 gik de).", "Slut"]
    assert split("Pris 3.5 kr. i alt. 2 stk. er nok.", ()) == ["Pris 3.5 kr. i alt.", "2 stk. er nok."]
    assert split("") == [] and spark.range(1).select(B.split_sentences_learned(F.lit(None).cast("string"), ["kl"]).alias("s")).first()["s"] is None


def test_no_texts(spark, corpus):
    assert B.learn_abbreviations(corpus.where("false"), "text").collect() == []
