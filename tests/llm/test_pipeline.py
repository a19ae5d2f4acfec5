"""The pipeline's stages against brute force, and the registration of the queries."""

import hashlib

from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline as C
from noteflow.llm import queries

SF = "/root/testdata/sf0.01"


def test_queries_are_registered():
    names = [k.split("_")[0] for k in queries.queries()]
    assert names == [f"op{n}" for n in range(1, 14)]
    assert {*queries.queries(), "pipeline"} <= set(E.queries()) and {"op9_line_suffix_array", "op11_parentheses_trie", "op12_curriculum_mix", "op13_bidirectional_repair"} <= set(E.oracle_sql())


def planted(spark):
    """Clean rows with a toxic one, copies, a near copy, a benchmark passage and a repeated passage."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1 AND toxic = 0").select("doc_id")
    clean = [r.asDict() for r in docs.join(labels, "doc_id").where("length(text) BETWEEN 600 AND 4000").orderBy("doc_id").limit(40).collect()]
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first()["text"]
    passage = " ".join(hashlib.md5(str(k).encode()).hexdigest()[:7] for k in range(60))
    row = lambda i, text: {"doc_id": i, "text": text, "lang": "en", "source": "s", "n_chars": len(text)}
    words = clean[0]["text"].replace("\n", " ").split()
    near = [w if k != 20 else "edit" for k, w in enumerate(words)]
    made = [row(9001, " ".join(words)), row(9002, " ".join(near)), row(9003, clean[1]["text"]), row(9004, clean[2]["text"][:300] + "\n" + item),
            row(9005, f"first own line\n{passage}\nlast"), row(9006, f"another own line\n{passage}\nend"), row(9007, "")]
    return spark.createDataFrame([{k: r[k] for k in docs.columns} for r in clean + made], docs.schema), {r["doc_id"] for r in clean}, passage


def test_stages_take_effect(spark):
    docs, clean, passage = planted(spark)
    kept = {}
    for name, stage in C.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        docs = out.checkpoint(eager=True)
        kept[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    after_lines = kept["line dedup"]
    assert passage in after_lines[9005] and passage not in after_lines[9006]
    assert 9003 not in after_lines or after_lines[9003] == ""        # every line is an earlier document's
    assert {9001, 9002} <= set(after_lines) and not {9001, 9002} & set(kept["MinHash near-dedup"]) and min(clean) in kept["MinHash near-dedup"]
    assert 9004 not in kept["benchmark decontamination"]
    lost = clean - set(kept["line dedup"])
    assert len(lost) <= 2                                            # clean documents stay
    packed = C.STAGES[-1][1](spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_run_equals_its_stages(spark):
    got = C.run(spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    per = got.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"))
    assert per.where("n <> end OR n > 1024").count() == 0 and got.count() > 50


def test_stages_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in C.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() == 0


def test_line_stage_keeps_clashing_columns_and_null_ids(spark):
    run = "\n".join(" ".join(f"w{i}x{j}" for j in range(20)) for i in range(3))
    rows = [(1, run, 5, 7, "a"), (2, f"own\n{run}", 6, 8, "b"), (None, None, 0, 9, "c"), (None, run, 0, 10, "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars int, _n_removed int, _counts string")
    got = {r["_counts"]: r for r in C.drop_repeated_lines(spark, docs, SF).collect()}
    assert set(got) == {"a", "b", "c"}                                # the last row has no words left
    assert got["a"]["text"] == run and got["b"]["text"] == "own" and got["b"]["n_chars"] == 3 and got["b"]["_n_removed"] == 8
    assert got["c"]["text"] is None
