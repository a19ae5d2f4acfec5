"""Lookups by a key that few values share leave the rows where they are."""

import pytest
from pyspark.sql import functions as F

from noteflow.operators import joins, labels, models, split


@pytest.fixture(scope="module")
def rows(spark, tmp_path_factory):
    """Rows of few classes, most in one; null classes and repeated keys among them."""
    path = str(tmp_path_factory.mktemp("rows") / "rows.parquet")
    i = F.col("id")
    spark.range(4000).select(
        F.when(i % 40 == 0, i - 1).otherwise(i).alias("row_id"),
        F.when(i % 500 == 7, F.lit(None)).when(i % 9 == 0, "a").when(i % 9 == 1, "b").otherwise("c").alias("lang"),
        F.repeat(F.md5(i.cast("string")), 200).alias("text")).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture
def small(spark):
    """Few bytes are broadcast, as if the tables were large."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    was = spark.conf.get(key)
    spark.conf.set(key, "64k")
    yield
    spark.conf.set(key, was)


def moved(df):
    """Exchanges by key of rows that hold a text, in the plan as it was run."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [x for x in plan.splitlines() if "SortMergeJoin" in x or "Exchange hashpartitioning(lang" in x]


def test_label_encoder(spark, rows, small):
    enc = labels.fit_label_encoder(rows, "lang")
    out = labels.apply_label_encoder(rows, enc, "lang", "label")
    assert not moved(out)
    assert {(r["lang"], r["label"]): r["count"] for r in out.groupBy("lang", "label").count().collect()} == {
        (r["lang"], {"a": 0, "b": 1, "c": 2}.get(r["lang"])): r["count"] for r in rows.groupBy("lang").count().collect()}
    back = labels.decode_labels(out, enc, "label")
    assert not moved(back) and back.where("NOT class_name <=> lang").isEmpty()


def test_balanced_weights(spark, rows, small):
    out = models.balanced_weights(rows, "lang")
    assert not moved(out)
    n, of = rows.count(), {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    got = {r["lang"]: r["weight"] for r in out.select("lang", "weight").distinct().collect()}
    assert got == {c: pytest.approx(n / (len(of) * k)) for c, k in of.items() if c is not None}


def test_folds_join_group_starts_by_broadcast(spark, rows, small):
    out = split.kfold(rows, 3, "lang", "row_id")
    assert out._jdf.queryExecution().executedPlan().toString().count("SortMergeJoin") == 1     # positions by row number
    sizes = {}
    for r in out.groupBy("lang", "fold").count().collect():
        sizes.setdefault(r["lang"], []).append(r["count"])
    assert len(sizes) == 4 and all(max(s) - min(s) <= 1 and len(s) == 3 for s in sizes.values())


def test_relevant_schemes_and_users(spark, rows, small):
    goals = spark.createDataFrame([("A",), ("c ",), ("none",)], "type string")
    raw = rows.withColumn("lang", F.when(F.col("row_id") % 2 == 0, F.upper("lang")).otherwise(F.col("lang")))
    out = joins.keep_relevant(raw, goals, "lang", ["row_id"])
    assert not moved(out)
    first = {}
    for r in raw.select("lang", "row_id").where("lang IS NOT NULL").collect():
        first[r["lang"].lower()] = min(first.get(r["lang"].lower(), (1 << 40, "")), (r["row_id"], r["lang"]))
    want = raw.where(F.col("lang").isin(first["a"][1], first["c"][1])).count()
    assert out.count() == want and {r["type"] for r in out.select("type").distinct().collect()} == {"a", "c"}
    some = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).where("n < 1000")
    kept = joins.semi_filter(rows, some, "lang")
    assert not moved(kept) and kept.count() == rows.where("lang IN ('a', 'b')").count()
