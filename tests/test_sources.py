"""Sources and sinks, and dedup idempotence."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from noteflow.operators import clean
from noteflow.sources import files as SRC


def test_csv_with_sentinel_order_and_parquet(spark):
    rows = [(1, "Hej med dig.\nAnden linje", "a"), (2, "\\N", "b"), (3, "  kant  ", None)]
    df = spark.createDataFrame(rows, "id long, text string, cls string")
    path = SRC.scratch_path(spark, "csv-test")
    SRC.write_csv_sink(df.coalesce(1), path, sep=";")
    back = SRC.csv_to_parquet(spark, path, "id long, text string, cls string", SRC.scratch_path(spark, "pq"),
                              sep=";", null_value="\\N")
    got = {r["id"]: r for r in back.collect()}
    assert got[1]["text"] == "Hej med dig.\nAnden linje"
    assert got[2]["text"] is None                   # the sentinel reads as null
    assert got[3]["text"] == "  kant  "             # white space kept
    assert sorted(r["row_order"] for r in back.collect()) == sorted(set(r["row_order"] for r in back.collect()))
    assert [got[i]["row_order"] for i in (1, 2, 3)] == sorted(got[i]["row_order"] for i in (1, 2, 3))


def test_splits_prune_partitions(spark):
    df = spark.range(100).withColumn("split", F.when(F.col("id") < 10, "test").when(F.col("id") < 30, "val")
                                                .otherwise("train"))
    path = SRC.scratch_path(spark, "splits-test")
    SRC.write_splits(df, path)
    t = SRC.read_splits(spark, path, ["test"])
    assert t.count() == 10
    plan = t._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "test" in plan
    assert SRC.read_splits(spark, path, ["train_val"]).count() == 90


def test_dedup_last_is_idempotent(spark):
    o = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "lang", "text")
    once = clean.dedup_last(o, ["lang", "text"], ["doc_id"])
    twice = clean.dedup_last(once, ["lang", "text"], ["doc_id"])
    a = sorted(r["doc_id"] for r in once.collect())
    assert a == sorted(r["doc_id"] for r in twice.collect())
    assert len(a) == o.select("lang", "text").distinct().count()


def test_values_df_roundtrips_awkward_strings(spark):
    from noteflow.session import values_df
    vals = ["it's", "back\\slash", "\\N", "tab\there", "næste 'x' \\' y", "", None, "%_$", "line\nbreak"]
    df = values_df(spark, [(v, i) for i, v in enumerate(vals)], "s string, i bigint")
    got = {r["i"]: r["s"] for r in df.collect()}
    assert [got[i] for i in range(len(vals))] == vals


def _csv_text(rows, newline="\n"):
    import csv
    import io
    out = io.StringIO()
    w = csv.writer(out, delimiter=";", lineterminator=newline)
    w.writerow(["k", "text"])
    for r in rows:
        w.writerow(r)
    return out.getvalue()


@pytest.mark.parametrize("split_bytes", ["64", "700", "64m"])
def test_csv_rows_keep_file_and_line_order_in_any_splits(spark, tmp_path, split_bytes):
    import random
    rng = random.Random(5)
    words = ["a", 'quo"ted', "two\nlines", "\n\n", ";", '"', "", "é", " padded ", "x" * 150]
    want, n = [], 0
    for name, size in (("b.csv", 3), ("a.csv", 200), ("c.csv", 40), ("d.csv", 0)):
        rows = [(n + i, "".join(rng.choice(words) for _ in range(rng.randint(1, 5))) or "z") for i in range(size)]
        n += size
        body = _csv_text(rows, "\r\n" if name == "c.csv" else "\n")
        (tmp_path / name).write_text(body.replace("\n2;", "\n\n2;", 1) if name == "b.csv" else body, newline="")
        want.append((name, rows))
    flat = [r for _, rows in sorted(want) for r in rows]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = SRC.read_csv_source(spark, str(tmp_path), "k long, text string", sep=";", order_col="pos").orderBy("pos").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [r["pos"] for r in got] == list(range(len(flat)))
    assert [(r["k"], r["text"]) for r in got] == flat
    assert got[0]["_source_file"].endswith("a.csv")


def test_positions_pair_files_cut_differently(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    spark.range(100).repartitionByRange(7, "id").sortWithinPartitions("id").selectExpr("id AS x").write.parquet(a)
    spark.range(100).repartitionByRange(3, "id").sortWithinPartitions("id").selectExpr("id AS y").write.parquet(b)
    rows = SRC.read_aligned(spark, a, b).collect()
    assert sorted((r["position"], r["x"], r["y"]) for r in rows) == [(i, i, i) for i in range(100)]
    spark.range(5).selectExpr("id AS y").write.mode("append").parquet(b)
    with pytest.raises(ValueError):
        SRC.read_aligned(spark, a, b)


def test_sparse_vectors_stay_sparse_on_disk(spark, tmp_path):
    from pyspark.ml.linalg import SparseVector, Vectors
    path = str(tmp_path / "v")
    df = spark.createDataFrame([(1, Vectors.sparse(1 << 20, [3, 70_000], [0.5, 2.0])), (2, Vectors.dense([1.0, 0.25])), (3, None)], ["id", "features"])
    SRC.write_embeddings(df, path)
    assert dict(spark.read.parquet(path).dtypes)["features"].startswith("struct<type")
    back = {r["id"]: r["features"] for r in SRC.read_vectors(spark, path).collect()}
    assert back[1] == Vectors.sparse(1 << 20, [3, 70_000], [0.5, 2.0]) and isinstance(back[1], SparseVector)
    assert back[2] == Vectors.dense([1.0, 0.25]) and back[3] is None


def test_csv_sink_bounds_its_files(spark):
    import glob
    path = SRC.scratch_path(spark, "bounded").removeprefix("file:")
    SRC.write_csv_sink(spark.range(95).selectExpr("id", "concat('a\n', id) AS t").coalesce(1), path, file_rows=10)
    assert len(glob.glob(f"{path}/*.csv")) == 10
    got = SRC.read_csv_source(spark, path, "id long, t string", order_col="n").orderBy("n").collect()
    assert [(r["id"], r["t"], r["n"]) for r in got] == [(i, f"a\n{i}", i) for i in range(95)]


def test_ordered_csv_is_not_staged(spark, monkeypatch):
    """Lines are counted in one pass and moved in the other: nothing but counts is staged."""
    from noteflow.sources import files
    kept = []
    monkeypatch.setattr(files, "staged", lambda df: kept.append(df.columns) or df.localCheckpoint())
    path = SRC.scratch_path(spark, "twice").removeprefix("file:")
    SRC.write_csv_sink(spark.range(20).selectExpr("id", "concat('say \"x\n', id, '\"') AS t").coalesce(1), path)
    got = SRC.read_csv_source(spark, path, "id long, t string", order_col="n").orderBy("n").collect()
    assert [r["t"] for r in got] == [f'say "x\n{i}"' for i in range(20)]
    assert kept and all("t" not in c for c in kept)


def _shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_written_tables_leave_no_shuffle_files(spark):
    """What a stage or a CSV sink shuffled is gone when its files are there."""
    import time
    from noteflow.session import staged
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(key, None)
    kept = _shuffle_files(spark)
    rows = spark.range(1000).repartition(5, "id").sortWithinPartitions("id")
    assert len(staged(rows).collect()) == 1000
    SRC.write_csv_sink(rows, SRC.scratch_path(spark, "released"))
    for _ in range(25):     # files are deleted in the background
        if _shuffle_files(spark) <= kept:
            break
        time.sleep(0.2)
    assert _shuffle_files(spark) <= kept
    assert spark.conf.get(key, None) == was


def test_ordered_csv_moves_no_line(spark, tmp_path):
    """Compressed files with line breaks in their texts: numbered in order, and no line is shuffled."""
    rows = [(i, f'say "x;y",\n{i}\n\n' + "z" * (i % 7)) for i in range(3000)]
    for name, part in (("b", rows[:100]), ("a", rows[100:2900]), ("c", rows[2900:])):
        SRC.write_csv_sink(spark.createDataFrame(part, "id long, t string").coalesce(2).sortWithinPartitions("id"), str(tmp_path / name),
                           file_rows=700, compression="gzip")
    assert not list(tmp_path.glob("*/*.csv")) and len(list(tmp_path.glob("a/*.csv.gz"))) >= 4
    got = SRC.read_csv_source(spark, f"{tmp_path}/*", "id long, t string", order_col="n")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "hashpartitioning" not in plan and "Window" not in plan
    assert [(r["id"], r["t"], r["n"]) for r in got.orderBy("n").collect()] == [(*r, i) for i, r in enumerate(rows[100:2900] + rows[:100] + rows[2900:])]


def test_records_longer_than_batches_and_splits(spark, tmp_path):
    """One record of many lines, read in batches of a few lines and splits of a few bytes."""
    rows = [(0, "a"), (1, "\n".join(f'l"{i}' for i in range(200)) + "\n"), (2, "\n \n")]
    (tmp_path / "a.csv").write_text(_csv_text(rows), newline="")
    keys = {"spark.sql.files.maxPartitionBytes": "100", "spark.sql.files.openCostInBytes": "0", "spark.sql.execution.arrow.maxRecordsPerBatch": "3"}
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        got = SRC.read_csv_source(spark, str(tmp_path), "k long, text string", sep=";", order_col="n").orderBy("n").collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert [(r["k"], r["text"], r["n"]) for r in got] == [(*r, i) for i, r in enumerate(rows)]


def test_round_trip_files_are_compressed(spark):
    from noteflow.plans import fixtures as fx, q_sources
    got = q_sources._csv(spark, SF_SMALL)
    assert got.inputFiles() and all(f.endswith(".csv.gz") for f in got.inputFiles())
    want = fx.observations_null(spark, SF_SMALL).select(*got.columns).collect()
    assert sorted(map(str, got.collect())) == sorted(map(str, want))


def test_encoder_hashes_each_word_once(monkeypatch):
    import hashlib
    import numpy as np
    import pandas as pd
    from noteflow.operators import features as FT
    calls, md5 = [], hashlib.md5
    monkeypatch.setattr(hashlib, "md5", lambda b: calls.append(b) or md5(b))
    for most in (200_000, 2):     # a full table is started anew, with the same vectors
        monkeypatch.setattr(FT, "KNOWN_WORDS", most)
        calls.clear()
        got = FT.hashing_encoder(8)()(pd.Series(["a b a c", None, "b b", ""]))
        want = np.zeros((4, 8))
        for i, t in ((0, "abac"), (2, "bb")):
            for w in t:
                h = int(md5(f"0:{w}".encode()).hexdigest()[:15], 16)
                want[i, h % 8] += -1.0 if (h >> 59) & 1 else 1.0
        norm = np.sqrt((want * want).sum(1, keepdims=True))
        assert np.array_equal(got, (want / np.where(norm == 0, 1, norm)).astype(np.float32))
        if most > 2:
            assert len(calls) == 3


def test_model_rows_hold_no_texts(spark):
    from conftest import SF_SMALL
    from noteflow.plans import q_models
    for embed in (False, True):
        x = q_models._model_data(spark, SF_SMALL, embed=embed)
        assert not {"text", "toks"} & set(x.columns) and x.count() == 200
        x.unpersist()
