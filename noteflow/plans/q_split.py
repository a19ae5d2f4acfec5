"""Registered queries: splits (SP), sampling (N), set operations (U), label encoders (L),
split statistics (A4, A6) and common classes (J9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import agg, joins, labels as L, sampling as N, split as SP
from ..operators.evaluate import outcome
from ..functions.text import word_count
from . import fixtures as fx
from . import sqlsnip as S
from .fixtures import with_views
from .registry import register


def _obs(spark, d):
    return fx.observations(spark, d).select("obs_id", "LastUpdateDate", "ObservationScheme")


_ORDER = ["LastUpdateDate", "obs_id"]

# ---------------------------------------------------------------- SP1-SP7

register("tail_split_n", with_views("""
SELECT obs_id, CASE WHEN row_number() OVER (ORDER BY LastUpdateDate DESC, obs_id DESC) <= 200
                    THEN 'test' ELSE 'train_val' END AS split FROM observations""", "observations"))(
    lambda spark, d: SP.tail_split_n(_obs(spark, d), 200, _ORDER).select("obs_id", "split"))

register("tail_split_frac", with_views("""
SELECT obs_id, CASE WHEN row_number() OVER (ORDER BY LastUpdateDate DESC, obs_id DESC)
                         <= round_even((SELECT count(*) FROM observations) * CAST(0.15 AS DOUBLE), 0)
                    THEN 'test' ELSE 'train_val' END AS split FROM observations""", "observations"))(
    lambda spark, d: SP.tail_split_frac(_obs(spark, d), 0.15, _ORDER).select("obs_id", "split"))

register("time_split3", with_views("""
SELECT obs_id, CASE WHEN rn <= m THEN 'test' WHEN rn <= 2 * m THEN 'val' ELSE 'train' END AS split
FROM (SELECT obs_id, row_number() OVER (ORDER BY LastUpdateDate DESC, obs_id DESC) AS rn,
             CAST(floor((SELECT count(*) FROM observations) * 10 / 100) AS BIGINT) AS m FROM observations) t""",
    "observations"))(
    lambda spark, d: SP.time_split3(_obs(spark, d), _ORDER, rate_pct=10).select("obs_id", "split"))


def _transfer(spark, d):
    own = _obs(spark, d).select(F.lit("obs").alias("src"), F.col("obs_id").alias("id"), "LastUpdateDate")
    tr = fx.form_answers(spark, d).select(F.lit("form").alias("src"),
                                          (F.col("myUnqualifiedId") * 100 + F.col("turn")).alias("id"),
                                          "LastUpdateDate")
    return SP.transfer_split(own, tr, 3, 100, ["LastUpdateDate", "id"]).select("src", "id", "split")


register("transfer_split", with_views("""
SELECT 'obs' AS src, obs_id AS id,
       CASE WHEN row_number() OVER (ORDER BY LastUpdateDate DESC, obs_id DESC) <= 100 THEN 'test' ELSE 'train' END AS split
FROM observations
UNION ALL SELECT 'form', myUnqualifiedId * 100 + turn, 'val' FROM form_answers
UNION ALL SELECT 'form', myUnqualifiedId * 100 + turn, 'train' FROM form_answers""",
    "observations", "form_answers"))(_transfer)

register("random_split", f"""
SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY {S.draw(42, 'doc_id')}, doc_id)
                         <= ceil((SELECT count(*) FROM documents) * CAST(0.2 AS DOUBLE)) THEN 'val' ELSE 'train' END AS split
FROM documents""")(
    lambda spark, d: SP.random_split(fx.doc_classes(spark, d), "doc_id", 0.2, 42).select("doc_id", "split"))

register("subsample_sizes", with_views("""
SELECT sample_size, doc_id, CASE WHEN w <= ceil(eff * CAST(0.2 AS DOUBLE)) THEN 'test' ELSE 'train' END AS split
FROM (SELECT x.*, row_number() OVER (PARTITION BY sample_size ORDER BY h2, doc_id) AS w FROM x) t""",
    extra=[("r", f"SELECT doc_id, {S.draw(43, 'doc_id')} AS h2, row_number() OVER (ORDER BY {S.draw(42, 'doc_id')}, doc_id) AS r FROM documents"),
           ("e", """SELECT CAST(s AS BIGINT) AS sample_size,
                           CASE WHEN s = 0 THEN n ELSE least(s, n) END AS eff
                    FROM (VALUES (0), (100), (300)) v(s), (SELECT count(*) AS n FROM documents) c"""),
           ("x", "SELECT e.sample_size, e.eff, r.doc_id, r.h2 FROM r JOIN e ON r.r <= e.eff")]))(
    lambda spark, d: SP.subsample_sizes(fx.doc_classes(spark, d), [0, 100, 300], "doc_id", 42, 0.2)
    .select("sample_size", "doc_id", "split"))

register("kfold", f"""
SELECT doc_id, lang AS label,
       CAST((row_number() OVER (PARTITION BY lang ORDER BY {S.draw(42, 'doc_id')}, doc_id) - 1) % 3 AS INTEGER) AS fold
FROM documents""")(
    lambda spark, d: SP.kfold(fx.doc_classes(spark, d), 3, "label", "doc_id", 42).select("doc_id", "label", "fold"))

# ---------------------------------------------------------------- N1-N4


def _positives(spark, d):
    o = fx.observations(spark, d)
    return o.select("obs_id", "ObservationScheme", "ObservationAnswer", "LastUpdateDate",
                    word_count("ObservationAnswer").alias("ObservationAnswer_len"))


_POS = ("p", f"""SELECT obs_id, ObservationScheme, ObservationAnswer, LastUpdateDate,
                        {S.word_count('ObservationAnswer')} AS ObservationAnswer_len FROM observations""")


def _neg_sql(src: str, key, scheme: str, seed: int, cols: list[str], prefix: str = "",
             src_has_labels: bool = False) -> list[tuple[str, str]]:
    """Oracle CTEs for negative sampling: index rows by (scheme, key), draw a donor
    index outside the row's scheme block, fetch the donor's columns."""
    keys = [key] if isinstance(key, str) else list(key)
    sel = ", ".join(f"d.{c}" for c in cols)
    x, c, t, neg = (prefix + n for n in ("x", "c", "t", "neg"))
    return [
        (x, f"SELECT *, row_number() OVER (ORDER BY {scheme}, {', '.join(keys)}) - 1 AS idx FROM {src}"),
        (c, f"SELECT {scheme}, min(idx) AS lo, count(*) AS m FROM {x} GROUP BY {scheme}"),
        (t, f"""SELECT {x}.* EXCLUDE (idx), {c}.lo, {c}.m,
                       {S.draw(seed, *keys)} % ((SELECT count(*) FROM {x}) - {c}.m) AS r
                FROM {x} JOIN {c} USING ({scheme})"""),
        (neg, f"""SELECT t.* EXCLUDE (lo, m, r, {', '.join(cols)}{', labels' if src_has_labels else ''}),
                         {sel}, 0 AS labels
                  FROM {t} t JOIN {x} d ON d.idx = CASE WHEN t.r < t.lo THEN t.r ELSE t.r + t.m END"""),
    ]


register("negative_samples", with_views(
    "SELECT obs_id, ObservationScheme, ObservationAnswer, ObservationAnswer_len, labels FROM neg", "observations",
    extra=[_POS] + _neg_sql("p", "obs_id", "ObservationScheme", 100, ["ObservationAnswer", "ObservationAnswer_len"])))(
    lambda spark, d: N.negative_samples(_positives(spark, d), ["ObservationAnswer"], "ObservationScheme", "obs_id", 100, reread=True)
    .select("obs_id", "ObservationScheme", "ObservationAnswer", "ObservationAnswer_len", "labels"))

register("pos_neg", with_views("""
SELECT obs_id, labels, ObservationAnswer_len, ObservationScheme,
       row_number() OVER (ORDER BY CAST(try_strptime(LastUpdateDate, '%Y/%m/%d') AS DATE) NULLS FIRST, obs_id, labels) AS pos
FROM (SELECT obs_id, labels, ObservationAnswer_len, ObservationScheme, LastUpdateDate FROM neg
      UNION ALL SELECT obs_id, 1, ObservationAnswer_len, ObservationScheme, LastUpdateDate FROM p) u""", "observations",
    extra=[_POS] + _neg_sql("p", "obs_id", "ObservationScheme", 100, ["ObservationAnswer", "ObservationAnswer_len"])))(
    lambda spark, d: N.pos_neg(_positives(spark, d), ["ObservationAnswer"], "ObservationScheme", "obs_id", 100, reread=True)
    .select("obs_id", "labels", "ObservationAnswer_len", "ObservationScheme", "pos"))


def _outcomes(spark, d):
    lg = fx.logits2(spark, d).withColumn("y_pred", (F.array_position("logits", F.array_max("logits")) - 1).cast("int"))
    return lg.withColumn("outcome", outcome("y_true", "y_pred"))


_OUTCOME_SQL = ("o", """SELECT row_id, CASE WHEN y_pred = y_true THEN (CASE WHEN y_pred = 1 THEN 'TP' ELSE 'TN' END)
                                        ELSE (CASE WHEN y_pred = 1 THEN 'FP' ELSE 'FN' END) END AS outcome
                        FROM (SELECT row_id, y_true, list_position(logits, list_max(logits)) - 1 AS y_pred FROM logits2) s""")

register("examples_per_outcome", with_views(f"""
SELECT d.outcome, d.draw_no, r.row_id
FROM (SELECT outcome, CAST(i AS INTEGER) AS draw_no, 1 + {S.draw(0, 'outcome', 'i')} % n AS rn
      FROM (SELECT outcome, count(*) AS n FROM o GROUP BY outcome) c, range(5) t(i)) d
JOIN (SELECT outcome, row_id, row_number() OVER (PARTITION BY outcome ORDER BY row_id) AS rn FROM o) r
  USING (outcome, rn)""", "logits2", extra=[_OUTCOME_SQL]))(
    lambda spark, d: N.examples_per_outcome(_outcomes(spark, d).select("row_id", "outcome"), 5, "row_id", "outcome", 0)
    .select("outcome", "draw_no", "row_id"))

register("shuffle_rows", f"SELECT doc_id, row_number() OVER (ORDER BY {S.draw(3, 'doc_id')}, doc_id) AS pos FROM documents")(
    lambda spark, d: N.shuffle_rows(fx.table(spark, d, "documents").select("doc_id"), "doc_id", 3))

# ---------------------------------------------------------------- U1-U4


def _concat_sorted(spark, d):
    a = _obs(spark, d).select(F.lit("obs").alias("src"), F.col("obs_id").alias("id"), "LastUpdateDate",
                              "ObservationScheme")
    b = fx.form_answers(spark, d).select(F.lit("form").alias("src"),
                                         (F.col("myUnqualifiedId") * 100 + F.col("turn")).alias("id"),
                                         "LastUpdateDate", "ObservationComponentID")
    return N.concat_sorted(a, b, "LastUpdateDate", ["src", "id"]).select(
        "src", "id", "pos", "year", "month", "day", "ObservationScheme", "ObservationComponentID")


register("concat_sorted", with_views("""
SELECT src, id, row_number() OVER (ORDER BY d NULLS FIRST, src, id) AS pos, CAST(year(d) AS INTEGER) AS year,
       CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day, ObservationScheme, ObservationComponentID
FROM (SELECT *, CAST(try_strptime(LastUpdateDate, '%Y/%m/%d') AS DATE) AS d FROM (
        SELECT 'obs' AS src, obs_id AS id, LastUpdateDate, ObservationScheme, NULL AS ObservationComponentID FROM observations
        UNION ALL
        SELECT 'form', myUnqualifiedId * 100 + turn, LastUpdateDate, NULL, ObservationComponentID FROM form_answers) u) t""",
    "observations", "form_answers"))(_concat_sorted)


def _append_tail(spark, d):
    o = _obs(spark, d)
    base = o.filter(F.col("ObservationScheme") != "error")
    extra = o.filter(F.col("ObservationScheme") == "error")
    return N.append_tail(base, extra, 30, _ORDER, "obs_id", 5).select("obs_id", "ObservationScheme", "pos")


register("append_tail", with_views(f"""
SELECT obs_id, ObservationScheme, row_number() OVER (ORDER BY {S.draw(5, 'obs_id')}, obs_id) AS pos FROM (
  SELECT obs_id, ObservationScheme FROM observations WHERE ObservationScheme <> 'error'
  UNION ALL
  SELECT obs_id, ObservationScheme FROM (
    SELECT obs_id, ObservationScheme FROM observations WHERE ObservationScheme = 'error'
    ORDER BY LastUpdateDate DESC, obs_id DESC LIMIT 30) e) u""", "observations"))(_append_tail)


def _append_placeholder(spark, d):
    o = fx.observations(spark, d).select("obs_id", "ObservationScheme", "ObservationAnswer")
    return N.append_placeholder(o.filter(F.col("ObservationScheme") != "view"),
                                o.filter(F.col("ObservationScheme") == "view"), ["obs_id"],
                                "ObservationAnswer", "placeholder")


register("append_placeholder", with_views("""
SELECT obs_id, ObservationScheme, ObservationAnswer FROM observations WHERE ObservationScheme <> 'view'
UNION ALL
SELECT * FROM (SELECT obs_id, ObservationScheme, 'placeholder' AS ObservationAnswer FROM observations
               WHERE ObservationScheme = 'view' ORDER BY obs_id LIMIT 1) f""", "observations"))(_append_placeholder)

register("append_matrix", """
SELECT vec_id AS row_id, label, CAST(len(embedding) AS INTEGER) AS dim FROM embeddings
UNION ALL SELECT vec_id, label % 2, 2 FROM embeddings""")(
    lambda spark, d: N.append_matrix(
        fx.embedded(spark, d).select("row_id", "label", F.size("features").alias("dim")),
        fx.logits2(spark, d).select("row_id", F.col("y_true").alias("label"), F.size("logits").alias("dim"))))

# ---------------------------------------------------------------- L1-L6


def _enc_raw(spark, d):
    return L.fit_label_encoder(fx.observations_raw(spark, d), "ObservationScheme")


_ENC_RAW = ("enc", """SELECT class, CAST(row_number() OVER (ORDER BY class) - 1 AS INTEGER) AS code
                      FROM (SELECT DISTINCT ObservationScheme AS class FROM observations_raw) c""")

register("fit_label_encoder", with_views("SELECT class, code FROM enc", "observations_raw", extra=[_ENC_RAW]))(_enc_raw)

register("apply_label_encoder", with_views("""
SELECT o.obs_id, e.code AS label FROM observations_raw o JOIN enc e ON o.ObservationScheme = e.class""",
    "observations_raw", extra=[_ENC_RAW]))(
    lambda spark, d: L.apply_label_encoder(fx.observations_raw(spark, d), _enc_raw(spark, d), "ObservationScheme")
    .select("obs_id", "label"))

register("fit_first_seen_encoder", with_views("""
SELECT class, CAST(row_number() OVER (ORDER BY first_id) - 1 AS INTEGER) AS code
FROM (SELECT ObservationScheme AS class, min(obs_id) AS first_id FROM observations_raw GROUP BY 1) c""",
    "observations_raw"))(
    lambda spark, d: L.fit_first_seen_encoder(fx.observations_raw(spark, d), "ObservationScheme", ["obs_id"]))

register("extend_encoder", with_views("""
WITH base AS (SELECT class, CAST(row_number() OVER (ORDER BY class) - 1 AS INTEGER) AS code
              FROM (SELECT DISTINCT ObservationScheme AS class FROM observations) c)
SELECT class, code FROM base
UNION ALL
SELECT class, CAST(row_number() OVER (ORDER BY class) + (SELECT max(code) FROM base) AS INTEGER)
FROM (SELECT DISTINCT ObservationScheme AS class FROM observations_raw
      WHERE ObservationScheme NOT IN (SELECT class FROM base)) n""".replace("WITH base AS", "SELECT * FROM (WITH base AS", 1) + ") z",
    "observations_raw"))(
    lambda spark, d: L.extend_encoder(L.fit_label_encoder(fx.observations(spark, d), "ObservationScheme"),
                                      fx.observations_raw(spark, d).select("ObservationScheme")))

register("class_code", with_views("SELECT class, code FROM enc WHERE class IN ('view', 'CLICK') OR code IN (0)",
                                  "observations_raw", extra=[_ENC_RAW]))(
    lambda spark, d: L.class_code(_enc_raw(spark, d), names=["view", "CLICK"], codes=[0]))

register("decode_labels", """
SELECT l.vec_id AS row_id, e.class AS class_name FROM embeddings l LEFT JOIN
  (SELECT class, CAST(row_number() OVER (ORDER BY class) - 1 AS INTEGER) AS code
   FROM (SELECT DISTINCT source AS class FROM documents) c) e ON l.label = e.code""")(
    lambda spark, d: L.decode_labels(fx.logits10(spark, d), L.fit_label_encoder(fx.table(spark, d, "documents"), "source"),
                                     "y_true").select("row_id", "class_name"))

# ---------------------------------------------------------------- A4, A6, J9

_DOC_SPLIT = ("ds", """SELECT doc_id, label,
        CASE WHEN rn <= m THEN 'test' WHEN rn <= 2 * m THEN 'val' ELSE 'train' END AS split
    FROM (SELECT doc_id, lang AS label, row_number() OVER (ORDER BY doc_id DESC) AS rn,
                 CAST(floor((SELECT count(*) FROM documents) * 10 / 100) AS BIGINT) AS m FROM documents) t""")


def _doc_split(spark, d):
    return SP.time_split3(fx.doc_classes(spark, d), ["doc_id"], rate_pct=10)


register("class_cardinality", with_views("SELECT split, count(DISTINCT label) AS n_classes FROM ds GROUP BY split",
                                         extra=[_DOC_SPLIT]))(
    lambda spark, d: agg.class_cardinality(_doc_split(spark, d), "label", "split"))

register("split_shapes", with_views("SELECT split, count(*) AS n FROM ds GROUP BY split", extra=[_DOC_SPLIT]))(
    lambda spark, d: agg.split_shapes(_doc_split(spark, d), "split"))


def _common(spark, d):
    s = SP.time_split3(fx.observations_raw(spark, d).select("obs_id", "LastUpdateDate", "ObservationScheme"),
                       _ORDER, rate_pct=10)
    return joins.common_classes(s, "ObservationScheme", "split").select("obs_id", "split", "ObservationScheme")


register("common_classes", with_views("""
SELECT obs_id, split, ObservationScheme FROM s
WHERE ObservationScheme IN (SELECT ObservationScheme FROM s GROUP BY 1 HAVING count(DISTINCT split) = 3)""",
    "observations_raw", extra=[("s", """
    SELECT obs_id, ObservationScheme,
           CASE WHEN rn <= m THEN 'test' WHEN rn <= 2 * m THEN 'val' ELSE 'train' END AS split
    FROM (SELECT obs_id, ObservationScheme, row_number() OVER (ORDER BY LastUpdateDate DESC, obs_id DESC) AS rn,
                 CAST(floor((SELECT count(*) FROM observations_raw) * 10 / 100) AS BIGINT) AS m
          FROM observations_raw) t""")]))(_common)
