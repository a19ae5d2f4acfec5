"""Scalar text functions on hand-made rows (quirks Q2, Q10, Q11, Q14)."""

from pyspark.sql import functions as F

from noteflow.functions import text as T
from noteflow.operators import clean


def one(spark, values, expr, schema="s string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(expr).collect()]


def test_clean_text_keeps_danish_letters_digits_and_underscore(spark):
    out = one(spark, ["Blodsukkermåling (før)", "Kontakt-tillæg", "a_b 1 2", None], T.clean_text("s"))
    assert out == ["blodsukkermålingfør", "kontakttillæg", "a_b12", None]


def test_basic_clean_keeps_sentinel(spark):
    out = one(spark, ["\\N", "Hej, med dig!", None], T.basic_clean("s"))
    assert out == ["\\N", "hej med dig", None]


def test_drop_date_numeric_grammar(spark):
    rows = ["12", "1e5", " 7 ", "1,5", "120d", "nan", "2020/01/02", "2020-01-02", "10:30", "37.2 grader",
            "inf", "31-12-2020", "2021/02/30", "12/31/2020", None, "Hej med dig"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rows)], "i int, s string")
    kept = sorted(r["s"] or "<null>" for r in clean.drop_date_numeric(df, ["s"]).collect())
    assert kept == sorted(["1,5", "120d", "nan", "10:30", "37.2 grader", "2021/02/30", "<null>", "Hej med dig"])


def test_word_and_token_counts(spark):
    assert one(spark, ["Hej med  dig.", "", None], T.word_count("s")) == [3, 0, None]
    assert one(spark, ["Hej med dig."], T.token_count("s")) == [4]


def test_split_sentences(spark):
    out = one(spark, ["Hej med dig. Hvordan går det? Fint.\nNy linje"], F.array_join(T.split_sentences("s"), "|"))
    assert out == ["Hej med dig.|Hvordan går det?|Fint.|Ny linje"]


def test_shuffle_sentences_edges(spark):
    df = spark.createDataFrame([(1, "a.b.c."), (2, "a.b.c"), (3, "abc"), (4, ""), (5, None)], "k int, s string")
    out = {r["k"]: r["x"] for r in df.select("k", T.shuffle_sentences("s", "k", 0).alias("x")).collect()}
    assert sorted(out[1].split(".")) == ["a", "b", "c"]
    assert sorted(out[2].split(".")) == ["a", "b"]      # the last piece is always dropped
    assert out[3] == "" and out[4] == "" and out[5] == ""
    again = {r["k"]: r["x"] for r in df.select("k", T.shuffle_sentences("s", "k", 0).alias("x")).collect()}
    assert again == out


def test_tokenize_checks_stopwords_before_lowercasing(spark):
    out = one(spark, ["Og og hun p-pille 12 Hun Blodsukker"], F.array_join(T.tokenize("s"), " "))
    assert out == ["og p pille hun blodsukker"]


def test_combine_fields_and_scheme_of_text(spark):
    df = spark.createDataFrame([("Puls", "Hej", "q")], "s string, a string, q string")
    r = df.select(T.combine_fields("s", "a", version=0).alias("v0"), T.combine_fields("s", "a", version=2).alias("v2"),
                  T.combine_fields("s", "a", "q", 1).alias("qa"),
                  T.scheme_of_text(T.combine_fields("s", "a", version=2)).alias("sch")).first()
    assert (r.v0, r.v2, r.qa, r.sch) == ("Puls  ,Hej", "[CLS] Puls [SEP] Hej", "Puls [SEP] q [SEP] Hej", "[CLS] Puls")


def test_split_sentences_locale_mode(spark):
    out = one(spark, ["Hej med dig. Hvordan går det? Fint."], F.array_join(T.split_sentences("s", mode="locale"), "|"))
    assert out == ["Hej med dig|Hvordan går det|Fint"]
