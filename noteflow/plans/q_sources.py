"""Registered queries: source/sink round trips.

Each query reads the driver's tables, writes an intermediate table under the
session's shared checkpoint folder and reads it back; the oracle is the same
data computed directly from the tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import sources as SRC
from ..operators import evaluate as E
from ..operators.split import time_split3
from . import fixtures as fx
from .fixtures import with_views
from .q_eval import _METRIC_COLS, _P10, _macro_sql, _pred, _round
from .registry import register

_OBS_SCHEMA = "obs_id long, ObservationScheme string, ObservationAnswer string, LastUpdateDate string"


def _csv(spark, d):
    path = SRC.scratch_path(spark, "csv")
    SRC.write_csv_sink(fx.observations_null(spark, d).select("obs_id", "ObservationScheme", "ObservationAnswer",
                                                             "LastUpdateDate"), path, sep=";", file_rows=20_000, compression="gzip")
    return SRC.read_csv_source(spark, path, _OBS_SCHEMA, sep=";")


register("csv_roundtrip", with_views(
    "SELECT obs_id, ObservationScheme, ObservationAnswer, LastUpdateDate FROM observations_null", "observations_null"))(_csv)


def _csv_order(spark, d):
    """Folders of unequal size, texts with quotes and line breaks, read in order, by as many tasks as there are splits.
    Folders are written one after the other, the largest part in three, each in files that follow the order, so that
    about a quarter of the rows is being sorted at a time; files are compressed."""
    path = SRC.scratch_path(spark, "csv-order")
    o = fx.observations_null(spark, d).select("obs_id", "ObservationScheme", "ObservationAnswer", "LastUpdateDate")
    part = F.when(F.col("obs_id") % 100 < 5, 0).when(F.col("obs_id") % 100 < 75, 1).otherwise(2)
    quoted = F.when(F.col("obs_id") % 4 == 0, F.concat(F.lit('say "x;y",\n'), "ObservationAnswer")).otherwise(F.col("ObservationAnswer"))
    cuts = o.where(part == 1).approxQuantile("obs_id", [2 / 3, 1 / 3], 0.01)
    inner = [None, *cuts, None]
    folders = [(0, None, None), *[(1, high, low) for high, low in zip(inner, inner[1:])], (2, None, None)]
    for k, (p, high, low) in enumerate(folders):
        rows = o.where(part == p)
        rows = rows if high is None else rows.where(F.col("obs_id") <= high)
        rows = rows if low is None else rows.where(F.col("obs_id") > low)
        files = rows.withColumn("ObservationAnswer", quoted).repartitionByRange(F.desc("obs_id")).sortWithinPartitions(F.desc("obs_id"))
        SRC.write_csv_sink(files, f"{path}/{k}", sep=";", compression="gzip")
    got = SRC.read_csv_source(spark, f"{path}/*", _OBS_SCHEMA, sep=";", order_col="row_order")
    return got.select("obs_id", "row_order", F.md5("ObservationAnswer").alias("answer_md5"))


register("csv_file_order", with_views("""
SELECT obs_id, row_number() OVER (ORDER BY CASE WHEN obs_id % 100 < 5 THEN 0 WHEN obs_id % 100 < 75 THEN 1 ELSE 2 END, obs_id DESC) - 1 AS row_order,
       md5(CASE WHEN obs_id % 4 = 0 THEN 'say "x;y",' || chr(10) || ObservationAnswer ELSE ObservationAnswer END) AS answer_md5
FROM observations_null""", "observations_null"))(_csv_order)


def _aligned(spark, d):
    """Features and labels without a key, in files cut differently, paired by position."""
    fp, lp = SRC.scratch_path(spark, "feat"), SRC.scratch_path(spark, "lab")
    e = fx.embedded(spark, d)
    e.repartitionByRange(3, "row_id").sortWithinPartitions("row_id").select("features").write.parquet(fp)
    e.repartitionByRange(2, "row_id").sortWithinPartitions("row_id").select("label", F.col("row_id").alias("was")).write.parquet(lp)
    return SRC.read_aligned(spark, fp, lp).select("position", "was", "label", F.round(F.aggregate("features", F.lit(0.0), lambda a, x: a + x), 6).alias("sum_f"))


register("embeddings_by_position", """
SELECT row_number() OVER (ORDER BY vec_id) - 1 AS position, vec_id AS was, label,
       round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE))), 6) AS sum_f FROM embeddings""")(_aligned)


def _splits(spark, d):
    path = SRC.scratch_path(spark, "splits")
    s = time_split3(fx.observations(spark, d).select("obs_id", "LastUpdateDate"), ["LastUpdateDate", "obs_id"],
                    rate_pct=10)
    SRC.write_splits(s, path)
    return SRC.read_splits(spark, path, ["val", "test"]).select("obs_id", "split")


register("splits_roundtrip", with_views("""
SELECT obs_id, split FROM (
  SELECT obs_id, CASE WHEN rn <= m THEN 'test' WHEN rn <= 2 * m THEN 'val' ELSE 'train' END AS split
  FROM (SELECT obs_id, row_number() OVER (ORDER BY LastUpdateDate DESC, obs_id DESC) AS rn,
               CAST(floor((SELECT count(*) FROM observations) * 10 / 100) AS BIGINT) AS m FROM observations) t) u
WHERE split IN ('val', 'test')""", "observations"))(_splits)


def _emb(spark, d):
    fp, lp = SRC.scratch_path(spark, "feat"), SRC.scratch_path(spark, "lab")
    e = fx.embedded(spark, d)
    SRC.write_embeddings(e.select("row_id", "features"), fp)
    e.select("row_id", "label").write.mode("overwrite").parquet(lp)
    return SRC.read_embeddings(spark, fp, lp).select("row_id", "label", F.size("features").alias("dim"),
                                                      F.round(F.aggregate("features", F.lit(0.0),
                                                                          lambda a, x: a + x), 6).alias("sum_f"))


register("embeddings_roundtrip", """
SELECT vec_id AS row_id, label, CAST(len(embedding) AS INTEGER) AS dim, round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE))), 6) AS sum_f
FROM embeddings""")(_emb)


def _variants(spark, d):
    base = SRC.scratch_path(spark, "variants")
    e, lg = fx.embedded(spark, d), fx.logits10(spark, d)
    for name, x, labels in (("full64", e, e.select("row_id", "label")),
                            ("fold10", lg.select("row_id", F.col("logits").cast("array<float>").alias("features")),
                             lg.select("row_id", (F.col("y_true") + 100).alias("label")))):
        x.select("row_id", "features").write.mode("overwrite").parquet(f"{base}/{name}/features")
        labels.write.mode("overwrite").parquet(f"{base}/{name}/labels")
    v = SRC.read_variants(spark, base)
    return v.groupBy("variant").agg(F.count(F.lit(1)).alias("n"), F.max(F.size("features")).alias("dim"),
                                    F.sum(F.col("label").cast("long")).alias("sum_label"))


register("read_variants", """
SELECT 'full64' AS variant, count(*) AS n, CAST(max(len(embedding)) AS INTEGER) AS dim, CAST(sum(label) AS BIGINT) AS sum_label FROM embeddings
UNION ALL SELECT 'fold10', count(*), 10, CAST(sum(label + 100) AS BIGINT) FROM embeddings""")(_variants)


def _materialize(spark, d):
    path = SRC.scratch_path(spark, "stage")
    build = lambda: fx.table(spark, d, "documents").select(
        "doc_id", F.size(F.split("text", r"\s+")).alias("n_pieces"))
    SRC.materialize(spark, path, build)
    return SRC.materialize(spark, path, build)  # second call reads the stored stage


register("materialize", "SELECT doc_id, CAST(len(regexp_split_to_array(text, '\\s+')) AS INTEGER) AS n_pieces FROM documents")(_materialize)


def _metrics(spark, d):
    path = SRC.scratch_path(spark, "metrics")
    SRC.write_metrics(_round(E.macro_metrics(_pred(fx.logits10(spark, d))), _METRIC_COLS), path)
    return spark.read.schema("acc double, f1 double, precision double, recall double, n long").json(path)


register("write_metrics", with_views(_macro_sql("p10"), "logits10", extra=[_P10]))(_metrics)
