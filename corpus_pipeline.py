"""Corpus cleaning from raw documents to packed training sequences.

Five stages, each one of the operators of :mod:`noteflow.llm` over all documents its
predecessor kept.  ``run`` applies them to ``documents``, every stage written as Parquet to
the shared checkpoint folder and read back, so a lost executor costs a stage at most.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noteflow.llm import decontam, lines, minhash, packing, quality
from noteflow.llm.util import WORD, prepare, table
from noteflow.session import checkpoint_dir


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier accepts; rows without an id stay."""
    prepare(spark)
    model = quality.fit_classifier(docs, table(spark, sf_dir, "labels"))
    bad = quality.classify(docs, model).where("NOT kept AND doc_id IS NOT NULL").select(F.col("doc_id").alias("_bad")).distinct()
    return docs.join(bad, docs["doc_id"] == bad["_bad"], "left_anti")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the later copies of repeated line runs; ``n_chars`` follows the text,
    and a document that loses all its words goes."""
    prepare(spark)
    counts = max(docs.columns, key=len) + "_counts"        # longer than any column, so none of them
    cut = lines.dedup_lines(docs, counts=counts)
    removed = F.col(counts)["_n_removed"]
    cut = cut.where((removed == 0) | F.col("text").rlike(WORD))
    n_chars = F.when(removed > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return cut.withColumn("n_chars", n_chars).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity 0.8)."""
    prepare(spark)
    return minhash.without_near_duplicates(docs, shingle_words=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    prepare(spark)
    return decontam.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a training sequence."""
    prepare(spark)
    return packing.pack(docs, *packing.tokenizer_file())


STAGES = [
    ("quality classifier", drop_low_quality),
    ("line dedup", drop_repeated_lines),
    ("MinHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("best-fit packing", pack),
]

#: Tokenisation and a trained classifier are not SQL; tests/llm checks run() by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
