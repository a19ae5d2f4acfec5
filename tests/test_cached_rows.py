"""Rows that fits read again and again from memory lie in partitions of bounded size, however few the splits of their file."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from noteflow import session
from noteflow.operators.blocks import vector_bytes
from noteflow.plans import q_models


@pytest.fixture
def folder(tmp_path):
    """Documents in one file of one row group, with null and repeated ids."""
    n = 600
    text = [" ".join(f"word{chr(97 + (i * j) % 23)}{chr(97 + j % 19)}" for j in range(40)) for i in range(n)]
    ids = [None if i % 200 == 9 else i // 2 if i % 50 == 1 else i for i in range(n)]
    pq.write_table(pa.table({"doc_id": pa.array(ids, pa.int64()), "text": text, "lang": [("de", "en", "fr")[i % 3] for i in range(n)]}),
                   tmp_path / "documents.parquet", row_group_size=1 << 20)
    return str(tmp_path)


def bytes_by_partition(x):
    return [r["n"] for r in x.groupBy(F.spark_partition_id().alias("p")).agg(F.sum(vector_bytes(x, "features")).alias("n")).collect()]


@pytest.mark.parametrize("embed", [False, True])
def test_partitions_follow_the_bytes_of_features(spark, folder, monkeypatch, embed):
    whole = q_models._model_data(spark, folder, embed)
    total = sum(bytes_by_partition(whole))
    monkeypatch.setattr(session, "PART_BYTES", total // 10)
    x = q_models._model_data(spark, folder, embed)
    assert max(bytes_by_partition(x)) <= 2 * (total // 10)
    key = lambda r: (str(r["row_id"]), r["lang"], r["label"], r["split"], str(r["features"]))
    assert sorted(map(key, x.collect())) == sorted(map(key, whole.collect()))
    whole.unpersist()
    x.unpersist()


def test_small_rows_stay_where_they_are(spark, folder):
    rows = spark.read.parquet(f"{folder}/documents.parquet")
    assert session.spread_rows(rows, F.octet_length("text")) is rows
    assert session.spread_rows(rows.limit(0), F.octet_length("text")).isEmpty()
