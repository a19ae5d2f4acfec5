"""Registered queries: evaluation (E1-E15) on fixture logits and sentence pairs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.constants import CLASSIFIER_THRESHOLDS, LOG_TAGS, SCORER_THRESHOLDS
from ..functions.hashing import draw
from ..operators import evaluate as E
from ..operators import sampling as N
from ..operators.order import global_rank
from ..operators.split import time_split3
from . import fixtures as fx
from . import sqlsnip as S
from .fixtures import with_views
from .q_split import _POS, _neg_sql, _positives
from .registry import register

R = S.r6
_ARGMAX = "CAST(list_position(logits, list_max(logits)) - 1 AS INTEGER)"


def _pred(df):
    return df.withColumn("y_pred", (F.array_position("logits", F.array_max("logits")) - 1).cast("int"))


def _round(df, cols):
    return df.select(*[F.round(F.col(c).cast("double"), 6).alias(c) if c in cols else F.col(c) for c in df.columns])


_METRIC_COLS = ["acc", "f1", "precision", "recall"]


def _macro_sql(src: str, group: str = "") -> str:
    g = f"{group}, " if group else ""
    gb = f"GROUP BY {group}" if group else ""
    join_on = f"USING ({group})" if group else "ON true"
    return f"""
SELECT {g}{R('a.acc')} AS acc, {R('m.f1')} AS f1, {R('m.precision')} AS precision, {R('m.recall')} AS recall, a.n
FROM (SELECT {g}avg(CASE WHEN y_true = y_pred THEN 1.0 ELSE 0.0 END) AS acc, count(*) AS n FROM {src} {gb}) a
JOIN (SELECT {g}avg(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END) AS precision,
             avg(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END) AS recall,
             avg(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END) AS f1
      FROM (SELECT {g}l.label,
                   CAST(count(*) FILTER (WHERE y_true = l.label AND y_pred = l.label) AS DOUBLE) AS tp,
                   CAST(count(*) FILTER (WHERE y_pred = l.label AND y_true <> l.label) AS DOUBLE) AS fp,
                   CAST(count(*) FILTER (WHERE y_true = l.label AND y_pred <> l.label) AS DOUBLE) AS fn
            FROM (SELECT DISTINCT {g}y_true AS label FROM {src} UNION SELECT DISTINCT {g}y_pred FROM {src}) l
            JOIN {src} s {('USING (' + group + ')') if group else 'ON true'}
            GROUP BY {g}l.label) pc {gb}) m {join_on}"""


_P10 = ("p10", f"SELECT row_id, y_true, {_ARGMAX} AS y_pred, logits FROM logits10")
_P2 = ("p2", f"SELECT row_id, y_true, {_ARGMAX} AS y_pred, logits FROM logits2")

register("macro_metrics", with_views(_macro_sql("p10"), "logits10", extra=[_P10]))(
    lambda spark, d: _round(E.macro_metrics(_pred(fx.logits10(spark, d))), _METRIC_COLS))

_BINARY_SQL = f"""
SELECT {R('acc')} AS acc, {R("CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END")} AS f1,
       {R("CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END")} AS precision,
       {R("CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END")} AS recall, n
FROM (SELECT CAST(count(*) FILTER (WHERE y_true = 1 AND y_pred = 1) AS DOUBLE) AS tp,
             CAST(count(*) FILTER (WHERE y_true <> 1 AND y_pred = 1) AS DOUBLE) AS fp,
             CAST(count(*) FILTER (WHERE y_true = 1 AND y_pred <> 1) AS DOUBLE) AS fn,
             avg(CASE WHEN y_true = y_pred THEN 1.0 ELSE 0.0 END) AS acc, count(*) AS n FROM p2) s"""

register("binary_metrics", with_views(_BINARY_SQL, "logits2", extra=[_P2]))(
    lambda spark, d: _round(E.binary_metrics(_pred(fx.logits2(spark, d))), _METRIC_COLS))

register("auto_metrics", with_views(_BINARY_SQL, "logits2", extra=[_P2]))(
    lambda spark, d: _round(E.auto_metrics(_pred(fx.logits2(spark, d))), _METRIC_COLS))

register("accuracy_by_split", with_views(f"""
SELECT split, {R("avg(CASE WHEN y_true = y_pred THEN 1.0 ELSE 0.0 END)")} AS acc, count(*) AS n FROM (
  SELECT y_true, y_pred, CASE WHEN rn <= m THEN 'test' WHEN rn <= 2 * m THEN 'val' ELSE 'train' END AS split
  FROM (SELECT *, row_number() OVER (ORDER BY row_id DESC) AS rn,
               CAST(floor((SELECT count(*) FROM p10) * 10 / 100) AS BIGINT) AS m FROM p10) t) u GROUP BY split""",
    "logits10", extra=[_P10]))(
    lambda spark, d: _round(E.accuracy_by_split(time_split3(_pred(fx.logits10(spark, d)), ["row_id"], rate_pct=10)),
                            ["acc"]))

_SOFT = ("sm", """SELECT row_id, y_true, logits, p, list_max(p) AS prob_max, p[2] AS pos_prob,
                         CAST(list_position(logits, list_max(logits)) - 1 AS INTEGER) AS y_pred
                  FROM (SELECT *, list_transform(e, lambda x: x / list_sum(e)) AS p
                        FROM (SELECT *, list_transform(logits, lambda x: exp(x - list_max(logits))) AS e FROM {src}) a) b""")

register("softmax_probs", with_views(f"SELECT row_id, y_pred, {R('prob_max')} AS prob_max, {R('pos_prob')} AS pos_prob FROM sm",
                                     "logits10", extra=[(_SOFT[0], _SOFT[1].format(src="logits10"))]))(
    lambda spark, d: _round(E.softmax_probs(fx.logits10(spark, d)).select("row_id", "y_pred", "prob_max", "pos_prob"),
                            ["prob_max", "pos_prob"]))


def _sweep_sql(thresholds) -> str:
    vals = ", ".join(f"(CAST({float(t)} AS DOUBLE))" for t in thresholds)
    return f"""
SELECT t.threshold, count(sm.row_id) FILTER (WHERE sm.prob_max > t.threshold) AS n_samples,
       (SELECT count(*) FROM sm) AS total,
       {R("avg(CASE WHEN y_true = y_pred THEN 1.0 ELSE 0.0 END) FILTER (WHERE sm.prob_max > t.threshold)")} AS accuracy
FROM (VALUES {vals}) t(threshold) LEFT JOIN sm ON true GROUP BY t.threshold"""


register("confidence_sweep", with_views(_sweep_sql(CLASSIFIER_THRESHOLDS), "logits10",
                                        extra=[(_SOFT[0], _SOFT[1].format(src="logits10"))]))(
    lambda spark, d: _round(E.confidence_sweep(E.softmax_probs(fx.logits10(spark, d)), CLASSIFIER_THRESHOLDS),
                            ["accuracy"]))

register("confidence_sweep_scorer", with_views(_sweep_sql(SCORER_THRESHOLDS), "logits2",
                                               extra=[(_SOFT[0], _SOFT[1].format(src="logits2"))]))(
    lambda spark, d: _round(E.confidence_sweep(E.softmax_probs(fx.logits2(spark, d)), SCORER_THRESHOLDS),
                            ["accuracy"]))

register("topk_accuracy", with_views(f"""
SELECT k, {R("avg(CASE WHEN rk <= k THEN 100.0 ELSE 0.0 END)")} AS accuracy
FROM (SELECT 1 + len(list_filter(range(len(logits)), lambda j: logits[j + 1] > logits[y_true + 1]
                                   OR (logits[j + 1] = logits[y_true + 1] AND j > y_true))) AS rk FROM logits10) r,
     range(1, 6) t(k) GROUP BY k""", "logits10"))(
    lambda spark, d: _round(E.topk_accuracy(fx.logits10(spark, d), 5, "logits", "y_true")
                            .withColumn("k", F.col("k").cast("long")), ["accuracy"]))

register("outcome", with_views("""
SELECT row_id, CASE WHEN y_pred = y_true THEN (CASE WHEN y_pred = 1 THEN 'TP' ELSE 'TN' END)
                    ELSE (CASE WHEN y_pred = 1 THEN 'FP' ELSE 'FN' END) END AS outcome FROM p2""",
    "logits2", extra=[_P2]))(
    lambda spark, d: _pred(fx.logits2(spark, d)).select("row_id", E.outcome().alias("outcome")))

# ---------------------------------------------------------------- sentence pairs


def pairs(spark, d):
    """Positives and negatives of the observations with ``SchemeAnswer`` text (v1) and a
    prediction column from a fixed seeded noise rule (75 % agreement with the label)."""
    pn = N.pos_neg(_positives(spark, d), ["ObservationAnswer"], "ObservationScheme", "obs_id", 100, reread=True)
    flip = (draw(11, "obs_id", "labels") % 4) == 0
    return pn.select("obs_id", F.col("labels").alias("y_true"),
                     T.combine_fields("ObservationScheme", "ObservationAnswer", version=1).alias("text"),
                     F.when(flip, 1 - F.col("labels")).otherwise(F.col("labels")).alias("y_pred"))


_PAIRS = [_POS] + _neg_sql("p", "obs_id", "ObservationScheme", 100, ["ObservationAnswer", "ObservationAnswer_len"]) + [
    ("pn", "SELECT obs_id, labels, ObservationScheme, ObservationAnswer FROM neg "
           "UNION ALL SELECT obs_id, 1, ObservationScheme, ObservationAnswer FROM p"),
    ("pairs", f"""SELECT obs_id, labels AS y_true, ObservationScheme || ' [SEP] ' || ObservationAnswer AS text,
                         CASE WHEN {S.draw(11, 'obs_id', 'labels')} % 4 = 0 THEN 1 - labels ELSE labels END AS y_pred
                  FROM pn"""),
    ("oc", """SELECT *, split_part(text, '[SEP]', 1) AS scheme,
                     CASE WHEN y_pred = y_true THEN (CASE WHEN y_pred = 1 THEN 'TP' ELSE 'TN' END)
                          ELSE (CASE WHEN y_pred = 1 THEN 'FP' ELSE 'FN' END) END AS outcome FROM pairs"""),
]

_OBS_SQL = """
SELECT scheme, count(*) FILTER (WHERE outcome = 'TP') AS true_pos, count(*) FILTER (WHERE outcome = 'FN') AS false_neg,
       count(*) FILTER (WHERE outcome = 'FP') AS false_pos, count(*) FILTER (WHERE outcome = 'TN') AS true_neg
FROM oc GROUP BY scheme"""

register("outcomes_by_scheme", with_views(_OBS_SQL, "observations", extra=_PAIRS))(
    lambda spark, d: E.outcomes_by_scheme(pairs(spark, d), "text"))

register("correct_vs_missed", with_views(f"SELECT scheme, true_pos, false_neg FROM ({_OBS_SQL}) t",
                                         "observations", extra=_PAIRS))(
    lambda spark, d: E.correct_vs_missed(pairs(spark, d), "text"))

register("scheme_drilldown", with_views(f"""
SELECT d.outcome, d.draw_no, r.obs_id, c.n AS n_outcome
FROM (SELECT outcome, CAST(i AS INTEGER) AS draw_no, 1 + {S.draw(0, 'outcome', 'i')} % n AS rn
      FROM (SELECT outcome, count(*) AS n FROM f GROUP BY outcome) c, range(3) t(i)) d
JOIN (SELECT outcome, obs_id, row_number() OVER (PARTITION BY outcome ORDER BY obs_id) AS rn FROM f) r USING (outcome, rn)
JOIN (SELECT outcome, count(*) AS n FROM f GROUP BY outcome) c USING (outcome)""",
    "observations", extra=_PAIRS + [("f", "SELECT * FROM oc WHERE trim(scheme) = 'purchase' AND outcome IN ('TP', 'FN')")]))(
    lambda spark, d: E.scheme_drilldown(pairs(spark, d), " purchase ", 3, "obs_id", "text")
    .select("outcome", "draw_no", "obs_id", "n_outcome"))

# ---------------------------------------------------------------- E13-E15

_TAGMAP = "(VALUES " + ", ".join(f"('{t}', '{m}')" for t, m in LOG_TAGS.items()) + ") mp(tag, metric)"
_METRICS = list(dict.fromkeys(LOG_TAGS.values()))

register("training_log_pivot", with_views(f"""
SELECT i, {', '.join(f"{R(f'max(value) FILTER (WHERE metric = {S.lit(m)})')} AS {m}" for m in _METRICS)}
FROM (SELECT CASE WHEN metric = 'epochs' THEN (p - 1) // 2 WHEN metric IN ('train_loss', 'lr') THEN p - 1 ELSE p END AS i,
             metric, value
      FROM (SELECT m.metric, t.value, row_number() OVER (PARTITION BY m.metric ORDER BY t.seq) - 1 AS p,
                   count(*) OVER (PARTITION BY m.metric) AS n
            FROM train_log t JOIN {_TAGMAP.replace('mp(tag', 'm(tag')} ON t.tag = m.tag) r
      WHERE CASE WHEN metric = 'epochs' THEN p >= 1 AND p < n - 2 AND (p - 1) % 2 = 0
                 WHEN metric IN ('train_loss', 'lr') THEN p >= 1 ELSE true END) k
GROUP BY i""", "train_log"))(
    lambda spark, d: _round(E.training_log_pivot(fx.train_log(spark, d))
                            .select("i", *[F.col(m).cast("double").alias(m) for m in _METRICS]), _METRICS))

register("new_class_metrics", with_views(
    _macro_sql("(SELECT 1 AS y_true, CAST(y_pred = 3 AS INTEGER) AS y_pred FROM p10 WHERE y_true = 3)"),
    "logits10", extra=[_P10]))(
    lambda spark, d: _round(E.new_class_metrics(_pred(fx.logits10(spark, d)), 3), _METRIC_COLS))


def _series(spark, d):
    lg = _pred(fx.logits10(spark, d))
    ranked = global_rank(lg.withColumn("_h", draw(9, "row_id")), ["_h", "row_id"], "_r")
    n = lg.agg(F.count(F.lit(1)).alias("n")).scalar()          # the last point is all rows
    sizes = F.array(*[F.lit(s).cast("long") for s in (100, 200, 500)], n)
    pts = ranked.withColumn("n_points", F.explode(F.array_distinct(sizes))).filter(F.col("_r") <= F.col("n_points"))
    return _round(E.metric_series(E.macro_metrics(pts, group=["n_points"]), "n_points"), _METRIC_COLS)


register("metric_series", with_views(
    f"SELECT n_points, acc, f1, precision, recall FROM ({_macro_sql('pts', 'n_points')}) q", "logits10", extra=[_P10, (
        "pts", f"""SELECT CAST(s.n_points AS BIGINT) AS n_points, r.y_true, r.y_pred FROM
               (SELECT *, row_number() OVER (ORDER BY {S.draw(9, 'row_id')}, row_id) AS rk FROM p10) r
               JOIN (SELECT * FROM (VALUES (100), (200), (500)) v(n_points) UNION SELECT count(*) FROM p10) s ON r.rk <= s.n_points""")]))(_series)
