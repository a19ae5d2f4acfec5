"""Batch operators applied per micro-batch of a file stream."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from noteflow.functions.text import word_count
from noteflow.sources.files import scratch_path
from noteflow.streaming import stream_through


def test_stream_through_appends_each_batch(spark):
    src = scratch_path(spark, "stream-in")
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    docs.repartition(3).write.parquet(src)
    stream = spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", 1).parquet(src)
    out, ck = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ck")
    q = stream_through(stream, lambda b: b.select("doc_id", word_count("text").alias("n_words")), out, ck)
    q.awaitTermination(120)
    res = spark.read.parquet(out)
    assert res.select("doc_id").distinct().count() == docs.count()
    want = docs.select(F.sum(word_count("text"))).first()[0]
    assert res.agg(F.sum("n_words")).first()[0] == want
