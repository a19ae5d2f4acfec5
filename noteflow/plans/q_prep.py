"""Registered queries: cleaning, joins, aggregation, dedup and the preprocessing pipelines."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import agg, clean, joins
from . import fixtures as fx
from . import pipelines
from . import sqlsnip as S
from .fixtures import with_views
from .registry import register

# ---------------------------------------------------------------- T1 / J4 / J5 / J2

register("clean_text", with_views(f"""
SELECT obs_id, ObservationScheme AS raw, {S.clean_text('ObservationScheme')} AS cleaned
FROM observations_raw""", "observations_raw"))(
    lambda spark, d: fx.observations_raw(spark, d).select(
        "obs_id", F.col("ObservationScheme").alias("raw"), T.clean_text("ObservationScheme").alias("cleaned")))

_KEEP_RELEVANT_CTES = [
    ("g", f"SELECT DISTINCT {S.clean_text('type')} AS type FROM goals"),
    ("c", f"SELECT *, {S.clean_text('ObservationScheme')} AS _clean FROM observations_raw"),
    ("firsts", "SELECT _clean, arg_min(ObservationScheme, obs_id) AS raw FROM c GROUP BY _clean"),
    ("chosen", "SELECT raw FROM firsts WHERE _clean IN (SELECT type FROM g)"),
    ("rel", """SELECT obs_id, _clean AS type, ObservationQuestion, ObservationAnswer, PractionerName,
                      LastUpdateDate FROM c WHERE ObservationScheme IN (SELECT raw FROM chosen)"""),
]

register("keep_relevant", with_views("SELECT obs_id, type, LastUpdateDate FROM rel",
                                     "observations_raw", "goals", extra=_KEEP_RELEVANT_CTES))(
    lambda spark, d: joins.keep_relevant(fx.observations_raw(spark, d), fx.goals(spark), "ObservationScheme",
                                         ["obs_id"]).select("obs_id", "type", "LastUpdateDate"))

register("keep_relevant_all_spellings", with_views(f"""
SELECT obs_id, {S.clean_text('ObservationScheme')} AS type FROM observations_raw
WHERE {S.clean_text('ObservationScheme')} IN (SELECT type FROM g)""",
    "observations_raw", "goals", extra=_KEEP_RELEVANT_CTES[:1]))(
    lambda spark, d: joins.keep_relevant(fx.observations_raw(spark, d), fx.goals(spark), "ObservationScheme",
                                         ["obs_id"], all_spellings=True).select("obs_id", "type"))

register("unmatched_goals", with_views(f"""
SELECT type FROM g WHERE type NOT IN (SELECT {S.clean_text('ObservationScheme')} FROM observations_raw)""",
    "observations_raw", "goals", extra=_KEEP_RELEVANT_CTES[:1]))(
    lambda spark, d: joins.unmatched_goals(fx.observations_raw(spark, d), fx.goals(spark)))

_CONV = "(SELECT clean_scheme, min(original_scheme) AS original_scheme FROM converter GROUP BY clean_scheme)"

register("decode_names", with_views(f"""
SELECT o.obs_id, o.type, v.original_scheme AS ObservationScheme
FROM (SELECT obs_id, {S.clean_text('ObservationScheme')} AS type FROM observations_raw) o
LEFT JOIN {_CONV} v ON o.type = v.clean_scheme""", "observations_raw", "converter"))(
    lambda spark, d: joins.decode_names(
        fx.observations_raw(spark, d).select("obs_id", T.clean_text("ObservationScheme").alias("type")),
        fx.converter(spark), "type", "ObservationScheme"))

# ---------------------------------------------------------------- PL1


def _pl1(spark, d):
    return pipelines.preprocess_pipeline(fx.observations_null(spark, d), fx.goals(spark),
                                         fx.converter(spark), fx.superusers(spark, d), 5)


_PL1_SQL = with_views(f"""
SELECT * FROM (
  SELECT *, {S.word_count('ObservationAnswer')} AS ObservationAnswer_len
  FROM (SELECT * FROM named WHERE ObservationAnswer IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY ObservationQuestion, ObservationAnswer, ObservationScheme
                                   ORDER BY obs_id DESC) = 1) dd
  WHERE {S.keep_not_date_numeric('ObservationAnswer')}) ln
WHERE PractionerName IN (SELECT PractionerName FROM superusers) AND ObservationAnswer_len >= 5""",
    "observations_null", "goals", "converter", "superusers",
    extra=[(n, b.replace("observations_raw", "observations_null")) for n, b in _KEEP_RELEVANT_CTES] + [
        ("named", f"SELECT rel.*, v.original_scheme AS ObservationScheme FROM rel LEFT JOIN {_CONV} v "
                  "ON rel.type = v.clean_scheme")])

register("preprocess_pipeline", _PL1_SQL)(_pl1)

# ---------------------------------------------------------------- P1-P11


def _named_cols(spark, d):
    o = fx.observations(spark, d)
    return o.select("obs_id", F.col("ObservationQuestion").alias("Observation Question_(FSIII)"),
                    F.col("LastUpdateDate").alias("last update"))


register("clean_names", with_views("""
SELECT obs_id AS Obs_Id, ObservationQuestion AS Observation_Question,
       strftime(CAST(try_strptime(LastUpdateDate, '%Y/%m/%d') AS DATE), '%Y-%m-%d') AS date
FROM observations""", "observations"))(
    lambda spark, d: clean.clean_names(_named_cols(spark, d), {0: "Obs Id", 2: "date"}, "date", "yyyy/MM/dd")
    .withColumn("date", F.date_format("date", "yyyy-MM-dd")))

register("select_as", with_views("SELECT ObservationAnswer AS text, ObservationScheme AS labels FROM observations",
                                 "observations"))(
    lambda spark, d: clean.select_as(fx.observations(spark, d), ["ObservationAnswer", "ObservationScheme"],
                                     ["text", "labels"]))

register("drop_null", with_views("SELECT obs_id FROM observations_null WHERE ObservationAnswer IS NOT NULL",
                                 "observations_null"))(
    lambda spark, d: clean.drop_null(fx.observations_null(spark, d), ["ObservationAnswer"]).select("obs_id"))

register("drop_date_numeric", with_views(f"""
SELECT obs_id, ObservationAnswer FROM observations_null WHERE {S.keep_not_date_numeric('ObservationAnswer')}""",
    "observations_null"))(
    lambda spark, d: clean.drop_date_numeric(fx.observations_null(spark, d), ["ObservationAnswer"])
    .select("obs_id", "ObservationAnswer"))

register("min_len", with_views(f"""
SELECT obs_id, ObservationAnswer_len FROM (
  SELECT obs_id, {S.word_count('ObservationAnswer')} AS ObservationAnswer_len FROM observations) t
WHERE ObservationAnswer_len >= 5""", "observations"))(
    lambda spark, d: clean.min_len(clean.len_words(fx.observations(spark, d), "ObservationAnswer"),
                                   "ObservationAnswer_len", 5).select("obs_id", "ObservationAnswer_len"))


def _nullable_class(spark, d):
    o = fx.observations(spark, d)
    return o.withColumn("ObservationScheme", F.when(F.col("obs_id") % 11 == 0, F.lit(None))
                        .otherwise(F.col("ObservationScheme")))


_NULLABLE_CLASS = ("nc", "SELECT obs_id, CASE WHEN obs_id % 11 = 0 THEN NULL ELSE ObservationScheme END "
                         "AS ObservationScheme FROM observations")

register("keep_classes", with_views("SELECT obs_id, ObservationScheme FROM nc WHERE ObservationScheme IN ('view', 'click')",
                                    "observations", extra=[_NULLABLE_CLASS]))(
    lambda spark, d: clean.keep_classes(_nullable_class(spark, d), "ObservationScheme", ["view", "click"])
    .select("obs_id", "ObservationScheme"))

register("exclude_classes", with_views("""
SELECT obs_id, ObservationScheme FROM nc WHERE NOT coalesce(ObservationScheme IN ('view', 'click'), false)""",
    "observations", extra=[_NULLABLE_CLASS]))(
    lambda spark, d: clean.exclude_classes(_nullable_class(spark, d), "ObservationScheme", ["view", "click"])
    .select("obs_id", "ObservationScheme"))

register("with_constants", with_views("SELECT obs_id, 1 AS labels, 'Bemærkning' AS ObservationQuestion FROM observations",
                                      "observations"))(
    lambda spark, d: clean.with_constants(fx.observations(spark, d).select("obs_id"),
                                          {"labels": 1, "ObservationQuestion": "Bemærkning"}))

register("fill_empty", with_views("SELECT obs_id, coalesce(ObservationAnswer, '') AS ObservationAnswer FROM observations_null",
                                  "observations_null"))(
    lambda spark, d: clean.fill_empty(fx.observations_null(spark, d).select("obs_id", "ObservationAnswer"),
                                      ["ObservationAnswer"]))

register("drop_cols", with_views("SELECT myUnqualifiedId, turn FROM form_answers", "form_answers"))(
    lambda spark, d: clean.drop_cols(
        fx.form_answers(spark, d).select("myUnqualifiedId", "turn", F.col("ObservationAnswer").alias("text_drop"),
                                         F.col("ObservationScheme").alias("scheme_drop"), "ObservationQuestion"),
        ["ObservationQuestion"], suffix="_drop"))

register("positives", "SELECT doc_id FROM labels WHERE quality = 1")(
    lambda spark, d: clean.positives(fx.table(spark, d, "labels").withColumnRenamed("quality", "labels"))
    .select("doc_id"))

_KEYS = ["myUnqualifiedId", "unqualifiedversionid__"]
_JOIN_ON = ("a.myUnqualifiedId IS NOT DISTINCT FROM c.myUnqualifiedId AND "
            "a.unqualifiedversionid__ IS NOT DISTINCT FROM c.unqualifiedversionid__")


def _answers_with_len(spark, d):
    a = fx.form_answers(spark, d)
    return clean.len_words(a, "ObservationAnswer")


register("comments_as_answers", with_views(f"""
SELECT a.myUnqualifiedId, a.unqualifiedversionid__, a.turn AS a_turn, c.turn AS c_turn,
       coalesce(c.comments_, '') AS ObservationAnswer, 'Bemærkning' AS ObservationQuestion
FROM form_answers a JOIN form_comments c ON {_JOIN_ON}""", "form_answers", "form_comments"))(
    lambda spark, d: clean.comments_as_answers(joins.join_comments(
        _answers_with_len(spark, d).withColumnRenamed("turn", "a_turn"),
        fx.form_comments(spark, d).withColumnRenamed("turn", "c_turn"), _KEYS))
    .select(*_KEYS, "a_turn", "c_turn", "ObservationAnswer", "ObservationQuestion"))

# ---------------------------------------------------------------- D1 / D2

_DEDUP_KEYS = ["ObservationQuestion", "ObservationAnswer", "ObservationScheme"]
register("dedup_last", with_views("""
SELECT obs_id, ObservationScheme FROM observations
QUALIFY row_number() OVER (PARTITION BY ObservationQuestion, ObservationAnswer, ObservationScheme ORDER BY obs_id DESC) = 1""",
    "observations"))(
    lambda spark, d: clean.dedup_last(fx.observations(spark, d), _DEDUP_KEYS, ["obs_id"])
    .select("obs_id", "ObservationScheme"))

register("dedup_first", with_views("""
SELECT obs_id, ObservationScheme FROM observations_null
QUALIFY row_number() OVER (PARTITION BY ObservationAnswer ORDER BY obs_id) = 1""", "observations_null"))(
    lambda spark, d: clean.dedup_first(fx.observations_null(spark, d), ["ObservationAnswer"], ["obs_id"])
    .select("obs_id", "ObservationScheme"))

# ---------------------------------------------------------------- A1-A7

register("concat_groups", with_views("""
SELECT myUnqualifiedId, unqualifiedversionid__, string_agg(ObservationAnswer, '.' ORDER BY turn) AS ObservationAnswer
FROM form_answers GROUP BY myUnqualifiedId, unqualifiedversionid__""", "form_answers"))(
    lambda spark, d: agg.concat_groups(fx.form_answers(spark, d), _KEYS, "ObservationAnswer", ["turn"]))

register("concat_comments", with_views("""
SELECT myUnqualifiedId, unqualifiedversionid__, string_agg(coalesce(comments_, ''), '.' ORDER BY turn) AS comments_
FROM form_comments GROUP BY myUnqualifiedId, unqualifiedversionid__""", "form_comments"))(
    lambda spark, d: agg.concat_groups(clean.fill_empty(fx.form_comments(spark, d), ["comments_"]), _KEYS,
                                       "comments_", ["turn"]))


def _answers_with_gaps(spark, d):
    a = fx.form_answers(spark, d)
    return a.withColumn("ObservationComponentID", F.when(F.col("turn") < 3, F.lit(None))
                        .otherwise(F.col("ObservationComponentID")))


register("first_per_group", with_views("""
SELECT myUnqualifiedId, unqualifiedversionid__,
       arg_min(ObservationComponentID, turn) FILTER (WHERE ObservationComponentID IS NOT NULL) AS ObservationComponentID,
       arg_min(ObservationQuestion, turn) AS ObservationQuestion
FROM (SELECT * REPLACE (CASE WHEN turn < 3 THEN NULL ELSE ObservationComponentID END AS ObservationComponentID)
      FROM form_answers) t
GROUP BY myUnqualifiedId, unqualifiedversionid__""", "form_answers"))(
    lambda spark, d: agg.first_per_group(_answers_with_gaps(spark, d), _KEYS, ["turn"],
                                         ["ObservationComponentID", "ObservationQuestion"]))

register("distinct_classes", with_views("SELECT DISTINCT ObservationScheme FROM observations_raw",
                                        "observations_raw"))(
    lambda spark, d: agg.distinct_classes(fx.observations_raw(spark, d), "ObservationScheme"))

register("class_histogram", with_views(
    "SELECT ObservationScheme, count(*) AS n FROM observations GROUP BY ObservationScheme", "observations"))(
    lambda spark, d: agg.class_histogram(fx.observations(spark, d), "ObservationScheme"))

_ARGMAX_SQL = "list_position(logits, list_max(logits)) - 1"
register("confusion_matrix", with_views(f"""
SELECT y_true, CAST({_ARGMAX_SQL} AS INTEGER) AS y_pred, count(*) AS n FROM logits10 GROUP BY 1, 2""", "logits10"))(
    lambda spark, d: agg.confusion_matrix(
        fx.logits10(spark, d).withColumn("y_pred", (F.array_position("logits", F.array_max("logits")) - 1).cast("int"))))


def _wide_cm(spark, d):
    df = fx.logits2(spark, d).withColumn(
        "y_pred", (F.array_position("logits", F.array_max("logits")) - 1).cast("int"))
    return agg.confusion_matrix(df, wide=True, labels=[0, 1]).select(
        "y_true", F.col("0").alias("pred_0"), F.col("1").alias("pred_1"))


register("confusion_matrix_wide", with_views(f"""
SELECT y_true, count(*) FILTER (WHERE {_ARGMAX_SQL} = 1) AS pred_0, count(*) FILTER (WHERE {_ARGMAX_SQL} = 2) AS pred_1
FROM logits2 GROUP BY y_true""".replace(f"{_ARGMAX_SQL} = 1", "list_position(logits, list_max(logits)) = 1")
    .replace(f"{_ARGMAX_SQL} = 2", "list_position(logits, list_max(logits)) = 2"), "logits2"))(_wide_cm)

# ---------------------------------------------------------------- J1, J3, J6-J8

register("join_comments", with_views(f"""
SELECT a.myUnqualifiedId, a.unqualifiedversionid__, a.turn AS a_turn, c.turn AS c_turn
FROM form_answers a JOIN form_comments c ON {_JOIN_ON}""", "form_answers", "form_comments"))(
    lambda spark, d: joins.join_comments(
        fx.form_answers(spark, d).select(*_KEYS, F.col("turn").alias("a_turn")),
        fx.form_comments(spark, d).select(*_KEYS, F.col("turn").alias("c_turn")), _KEYS))

register("semi_filter", with_views("""
SELECT obs_id, PractionerName FROM observations WHERE PractionerName IN (SELECT PractionerName FROM superusers)""",
    "observations", "superusers"))(
    lambda spark, d: joins.semi_filter(fx.observations(spark, d).select("obs_id", "PractionerName"),
                                       fx.superusers(spark, d), "PractionerName"))

register("anti_keys", with_views(f"""
SELECT c.myUnqualifiedId, c.unqualifiedversionid__, c.turn FROM form_comments c
WHERE NOT EXISTS (SELECT 1 FROM form_answers a WHERE {_JOIN_ON})""", "form_answers", "form_comments"))(
    lambda spark, d: joins.anti_keys(fx.form_comments(spark, d).select(*_KEYS, "turn"),
                                     fx.form_answers(spark, d), _KEYS))

register("cross_with_classes", with_views("""
SELECT o.obs_id, c.class FROM observations o, (SELECT DISTINCT ObservationScheme AS class FROM observations) c""",
    "observations"))(
    lambda spark, d: joins.cross_with_classes(
        fx.observations(spark, d).select("obs_id"),
        fx.observations(spark, d).select(F.col("ObservationScheme").alias("class")), "class"))

register("attach_by_row_id", """
SELECT f.vec_id AS row_id, CAST(len(f.embedding) AS INTEGER) AS dim, l.label FROM embeddings f JOIN embeddings l ON f.vec_id = l.vec_id""")(
    lambda spark, d: joins.attach_by_row_id(
        fx.table(spark, d, "embeddings").select(F.col("vec_id").alias("row_id"), F.size("embedding").alias("dim")),
        fx.table(spark, d, "embeddings").select(F.col("vec_id").alias("row_id"), "label"), "row_id"))

# ---------------------------------------------------------------- PL2

_PL2_SQL = with_views(f"""
SELECT myUnqualifiedId, unqualifiedversionid__, turn, ObservationComponentID, ObservationScheme,
       LastUpdateDate, PractionerName, ObservationAnswer, comments_, all_text FROM (
  SELECT * REPLACE ({S.shuffle_sentences('all_text', "CAST(myUnqualifiedId AS VARCHAR) || ':' || CAST(unqualifiedversionid__ AS VARCHAR)", 0)} AS all_text)
  FROM d1) s
QUALIFY row_number() OVER (PARTITION BY all_text, ObservationScheme ORDER BY myUnqualifiedId, unqualifiedversionid__) = 1""",
    "form_answers", "form_comments", extra=[
        ("c", """SELECT myUnqualifiedId, unqualifiedversionid__, string_agg(coalesce(comments_, ''), '.' ORDER BY turn) AS comments_
                 FROM form_comments WHERE myUnqualifiedId IS NOT NULL AND unqualifiedversionid__ IS NOT NULL
                 GROUP BY 1, 2"""),
        ("a", """SELECT myUnqualifiedId, unqualifiedversionid__,
                        string_agg(ObservationAnswer, '.' ORDER BY turn) AS ObservationAnswer,
                        min(turn) AS turn,
                        arg_min(ObservationComponentID, turn) FILTER (WHERE ObservationComponentID IS NOT NULL) AS ObservationComponentID,
                        arg_min(ObservationScheme, turn) FILTER (WHERE ObservationScheme IS NOT NULL) AS ObservationScheme,
                        arg_min(LastUpdateDate, turn) FILTER (WHERE LastUpdateDate IS NOT NULL) AS LastUpdateDate,
                        arg_min(PractionerName, turn) FILTER (WHERE PractionerName IS NOT NULL) AS PractionerName
                 FROM form_answers WHERE myUnqualifiedId IS NOT NULL AND unqualifiedversionid__ IS NOT NULL
                 GROUP BY 1, 2"""),
        ("j", f"""SELECT a.*, c.comments_, {S.combine_answer_comment('a.ObservationAnswer', 'c.comments_')} AS all_text
                 FROM a JOIN c ON {_JOIN_ON}"""),
        ("d1", """SELECT * FROM j QUALIFY row_number() OVER (PARTITION BY ObservationComponentID, ObservationScheme, all_text
                                                           ORDER BY myUnqualifiedId DESC, unqualifiedversionid__ DESC) = 1"""),
    ])

register("combined_text_pipeline", _PL2_SQL)(
    lambda spark, d: pipelines.combined_text_pipeline(
        fx.form_answers(spark, d).drop(), fx.form_comments(spark, d)))

# ---------------------------------------------------------------- PL3

_K = "myUnqualifiedId, unqualifiedversionid__"
_KD = "myUnqualifiedId DESC, unqualifiedversionid__ DESC"
_FORM_KEY = "CAST(myUnqualifiedId AS VARCHAR) || ':' || CAST(unqualifiedversionid__ AS VARCHAR)"
_DATE = "CAST(try_strptime(LastUpdateDate, '%Y/%m/%d') AS DATE)"


def _pl3(spark, d):
    df = pipelines.new_class_dataset_pipeline(
        fx.form_answers(spark, d), fx.form_comments(spark, d), fx.goals(spark), fx.converter(spark),
        fx.superusers(spark, d), ["click"])
    return df.select(*_KEYS, "type", "ObservationScheme", "all_text", "all_text_len", "pos", "split")


_PL3_SQL = with_views(f"""
SELECT {_K}, type, ObservationScheme, all_text, all_text_len, pos, split FROM tst
UNION ALL SELECT {_K}, type, ObservationScheme, all_text, all_text_len, pos, 'excluded' FROM tv WHERE type IN ('click')
UNION ALL
SELECT {_K}, type, ObservationScheme, all_text, all_text_len, pos,
       CASE WHEN row_number() OVER (ORDER BY {S.draw(42, 'form_key')}, form_key)
                 <= ceil((SELECT count(*) FROM kept) * CAST(0.2 AS DOUBLE)) THEN 'val' ELSE 'train' END
FROM kept""", "form_answers", "form_comments", "goals", "converter", "superusers", extra=[
    ("a0", f"SELECT * FROM form_answers WHERE {S.keep_not_date_numeric('ObservationAnswer')}"),
    ("g", f"SELECT DISTINCT {S.clean_text('type')} AS type FROM goals"),
    ("c0", f"SELECT *, {S.clean_text('ObservationScheme')} AS _clean FROM a0"),
    ("firsts", f"SELECT _clean, arg_min(ObservationScheme, ({_K}, turn)) AS raw FROM c0 GROUP BY _clean"),
    ("rel", """SELECT c0.* EXCLUDE (ObservationScheme, _clean), _clean AS type FROM c0
               WHERE ObservationScheme IN (SELECT raw FROM firsts WHERE _clean IN (SELECT type FROM g))"""),
    ("named", f"SELECT rel.*, v.original_scheme AS ObservationScheme FROM rel LEFT JOIN {_CONV} v ON rel.type = v.clean_scheme"),
    ("cm", f"""SELECT {_K}, string_agg(coalesce(comments_, ''), '.' ORDER BY turn) AS comments_ FROM form_comments
              WHERE myUnqualifiedId IS NOT NULL AND unqualifiedversionid__ IS NOT NULL GROUP BY {_K}"""),
    ("an", f"""SELECT {_K}, string_agg(ObservationAnswer, '.' ORDER BY turn) AS ObservationAnswer, min(turn) AS turn,
                     {', '.join(f"arg_min({c}, turn) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in
                                ['ObservationComponentID', 'type', 'PractionerName', 'LastUpdateDate', 'ObservationScheme'])}
              FROM named GROUP BY {_K}"""),
    ("j", f"""SELECT a.*, c.comments_, {S.combine_answer_comment('a.ObservationAnswer', 'c.comments_')} AS all_text
             FROM an a JOIN cm c ON {_JOIN_ON}"""),
    ("d1", f"""SELECT * FROM j QUALIFY row_number() OVER (PARTITION BY ObservationComponentID, ObservationScheme, all_text
                                                        ORDER BY {_KD}) = 1"""),
    ("su", "SELECT * FROM d1 WHERE PractionerName IN (SELECT PractionerName FROM superusers)"),
    ("sh", f"SELECT * REPLACE ({S.shuffle_sentences('all_text', _FORM_KEY, 0)} AS all_text) FROM su"),
    ("d2", f"SELECT * FROM sh QUALIFY row_number() OVER (PARTITION BY all_text, ObservationScheme ORDER BY {_K}) = 1"),
    ("ln", f"SELECT * FROM (SELECT *, {S.word_count('all_text')} AS all_text_len FROM d2 WHERE all_text IS NOT NULL) t "
           "WHERE all_text_len >= 5"),
    ("srt", f"SELECT *, row_number() OVER (ORDER BY {_DATE} NULLS FIRST, {_K}) AS pos FROM ln"),
    ("sp", """SELECT *, CASE WHEN row_number() OVER (ORDER BY pos DESC)
                                <= round_even((SELECT count(*) FROM srt) * CAST(0.2 AS DOUBLE), 0)
                           THEN 'test' ELSE 'trainval' END AS split FROM srt"""),
    ("tst", "SELECT * FROM sp WHERE split = 'test'"),
    ("tv", f"""SELECT * FROM sp a WHERE NOT EXISTS (SELECT 1 FROM tst c WHERE {_JOIN_ON})"""),
    ("kept", f"SELECT *, {_FORM_KEY} AS form_key FROM tv WHERE NOT coalesce(type IN ('click'), false)"),
])

register("new_class_dataset_pipeline", _PL3_SQL)(_pl3)

# ---------------------------------------------------------------- PL4

_SK = ["myUnqualifiedId", "unqualifiedversionid__", "turn", "c_turn", "spos"]


def _pl4(spark, d):
    df = pipelines.sentence_scoring_pipeline(fx.form_answers(spark, d), fx.form_comments(spark, d),
                                             fx.superusers(spark, d), min_tokens=5, seed=100, n_test=500)
    return df.select("src", *_SK, "labels", "ObservationScheme", "ObservationAnswer", "ObservationAnswer_len",
                     "SchemeAnswer", "pos", "split")


def _sentence_ctes(prefix: str, src: str, tag: str) -> list[tuple[str, str]]:
    from ..functions.constants import TOKEN_PATTERN
    from .q_split import _neg_sql
    keys = ", ".join(_SK[:-1])
    return [
        (prefix + "e", f"""SELECT * EXCLUDE (s), CAST(unnest(range(len(s))) AS INTEGER) AS spos, unnest(s) AS sentence
                          FROM (SELECT *, {S.split_sentences('ObservationAnswer')} AS s FROM {src}) t WHERE len(s) > 0"""),
        (prefix + "d", f"""SELECT * FROM {prefix}e QUALIFY row_number() OVER (
                             PARTITION BY ObservationQuestion, sentence, ObservationScheme
                             ORDER BY {', '.join(k + ' DESC' for k in _SK)}) = 1"""),
        (prefix + "p", f"""SELECT * EXCLUDE (toks, sentence, ObservationAnswer), array_to_string(toks, ' ') AS ObservationAnswer,
                                 CAST(len(toks) AS INTEGER) AS ObservationAnswer_len, 1 AS labels, '{tag}' AS src
                          FROM (SELECT *, regexp_extract_all(sentence, {S.lit(TOKEN_PATTERN)}) AS toks FROM {prefix}d) t
                          WHERE len(toks) >= 5"""),
    ] + _neg_sql(prefix + "p", _SK, "ObservationScheme", 100, ["ObservationAnswer", "ObservationAnswer_len"],
                 prefix=prefix, src_has_labels=True) + [
        (prefix + "all", f"""SELECT {keys}, spos, labels, src, ObservationScheme, ObservationAnswer, ObservationAnswer_len,
                                    LastUpdateDate FROM {prefix}p
                             UNION ALL
                             SELECT {keys}, spos, labels, src, ObservationScheme, ObservationAnswer, ObservationAnswer_len,
                                    LastUpdateDate FROM {prefix}neg"""),
    ]


_PL4_SQL = with_views("""
SELECT src, myUnqualifiedId, unqualifiedversionid__, turn, c_turn, spos, labels, ObservationScheme, ObservationAnswer,
       ObservationAnswer_len, SchemeAnswer, pos,
       CASE WHEN row_number() OVER (ORDER BY pos DESC) <= 500 THEN 'test' ELSE 'train_val' END AS split
FROM (SELECT *, ObservationScheme || ' [SEP] ' || ObservationAnswer AS SchemeAnswer,
             row_number() OVER (ORDER BY CAST(try_strptime(LastUpdateDate, '%Y/%m/%d') AS DATE) NULLS FIRST, src,
                                myUnqualifiedId, unqualifiedversionid__, turn, c_turn, spos, labels) AS pos
      FROM (SELECT * FROM a_all UNION ALL SELECT * FROM c_all) u) v""",
    "form_answers", "form_comments", "superusers", extra=[
        ("su", "SELECT * FROM form_answers WHERE PractionerName IN (SELECT PractionerName FROM superusers)"),
        ("base", "SELECT *, CAST(-1 AS BIGINT) AS c_turn FROM su"),
        ("com0", f"""SELECT a.myUnqualifiedId, a.unqualifiedversionid__, a.turn, a.ObservationComponentID, a.ObservationScheme,
                            a.PractionerName, a.LastUpdateDate, c.turn AS c_turn,
                            coalesce(c.comments_, '') AS ObservationAnswer, 'Bemærkning' AS ObservationQuestion
                     FROM su a JOIN form_comments c ON {_JOIN_ON}"""),
    ] + _sentence_ctes("a_", "base", "answer") + _sentence_ctes("c_", "com0", "comment"))

register("sentence_scoring_pipeline", _PL4_SQL)(_pl4)
