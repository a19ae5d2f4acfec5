"""TF-IDF with a vocabulary kept as a table: same weights as the vector form, nothing collected."""

import pytest
from pyspark.sql import functions as F

from noteflow.operators import features as FT


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, [f"w{j}" for j in range(i % 7)] + ["all"] + ([f"only{i}"] if i % 3 else []) * 2) for i in range(200)]
    return spark.createDataFrame([*rows, (200, []), (201, None), (5, ["all", "w1"]), (None, ["all"])], "id long, toks array<string>")


@pytest.mark.parametrize("share", [0.0, 0.01, 2.0])
def test_join_form_equals_vector_form(spark, docs, monkeypatch, share):
    monkeypatch.setattr(FT, "FREQUENT", share)          # every term broadcast, some, none
    bounded = FT.tfidf_fit(docs, "toks", max_features=10_000)
    table = FT.tfidf_fit(docs, "toks")
    assert bounded.bounded and not table.bounded
    a, b = (sorted(((r["id"] is None, r["id"] or 0, r["term_id"], r["term"], round(r["weight"], 9)) for r in FT.tfidf_weights(docs, m, "id").collect()))
            for m in (bounded, table))
    assert a == b and len(a) > 500


def test_sparse_rows(spark, docs):
    model = FT.tfidf_fit(docs, "toks", min_df=2)
    rows = FT.tfidf_sparse(docs, model, "id").collect()
    assert len(rows) == docs.count()
    n = model.vocab.count()
    assert all(r["features"]["size"] == n and r["features"]["indices"] == sorted(r["features"]["indices"]) for r in rows)
    assert sum(not r["features"]["indices"] for r in rows) == 2      # the empty and the null row
    for r in rows:
        assert not r["features"]["values"] or sum(v * v for v in r["features"]["values"]) == pytest.approx(1)


def test_an_unbounded_vocabulary_is_no_vector(spark, docs):
    with pytest.raises(ValueError):
        FT.tfidf_transform(docs, FT.tfidf_fit(docs, "toks"), "toks")
    plan = FT.tfidf_weights(docs, FT.tfidf_fit(docs, "toks"), "id")._jdf.queryExecution().toString()
    assert "only17" not in plan and "CountVectorizer" not in plan


def test_terms_are_counted_in_their_rows(spark):
    rows = [(1, ["b", "a", "b", None, "B", "b"]), (2, []), (3, None), (4, [None]), (5, ["a"]), (5, ["a", "é", "e"])]
    df = spark.createDataFrame(rows, "id long, toks array<string>")
    got = df.select("id", FT.term_counts(F.col("toks")).alias("c")).collect()
    assert [(r["id"], [tuple(e) for e in r["c"]]) for r in got] == [
        (1, [("B", 1), ("a", 1), ("b", 3)]), (2, []), (3, []), (4, []), (5, [("a", 1)]), (5, [("a", 1), ("e", 1), ("é", 1)])]
    model = FT.tfidf_fit(df, "toks")
    assert {(r["term"], r["df"]) for r in model.vocab.collect()} == {("B", 1), ("a", 3), ("b", 1), ("e", 1), ("é", 1)} and model.n_docs == 6
    plan = FT.tfidf_weights(df, model, "id")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_nf_row" in plan and "_nf_term#" in plan
    exchanged = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x and "_nf_term" in x and "_nf_row" in x]
    assert not exchanged                                  # (row, term) pairs are not shuffled to be counted
    counted = df.select("id", FT.term_counts(F.col("toks")).alias("toks"))       # the caller may count first
    weights = [sorted((r["id"], r["term"], r["term_id"], r["weight"]) for r in FT.tfidf_weights(x, FT.tfidf_fit(x, "toks"), "id").collect()) for x in (df, counted, FT.counted_rows(df, "id", "toks"))]
    assert weights[0] == weights[1] == weights[2] and len(weights[0]) == 7
