"""Registered queries: text functions (T2-T13) and ordering."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.constants import TOKEN_PATTERN
from ..operators import clean, sorting
from . import fixtures as fx
from . import sqlsnip as S
from .fixtures import with_views
from .registry import register


def _sentinel_answers(spark, d):
    o = fx.observations_null(spark, d)
    return o.withColumn("ObservationAnswer", F.when(F.col("obs_id") % 17 == 0, F.lit("\\N"))
                        .otherwise(F.col("ObservationAnswer")))


_SENTINEL = ("sa", "SELECT obs_id, CASE WHEN obs_id % 17 = 0 THEN '\\N' ELSE ObservationAnswer END AS ObservationAnswer "
                   "FROM observations_null")

register("basic_clean", with_views(f"SELECT obs_id, {S.basic_clean('ObservationAnswer')} AS cleaned FROM sa",
                                   "observations_null", extra=[_SENTINEL]))(
    lambda spark, d: _sentinel_answers(spark, d).select("obs_id", T.basic_clean("ObservationAnswer").alias("cleaned")))

register("len_words", f"SELECT doc_id, {S.word_count('text')} AS text_len FROM documents")(
    lambda spark, d: clean.len_words(fx.table(spark, d, "documents"), "text").select("doc_id", "text_len"))

register("len_items", f"""
SELECT doc_id, {S.token_count('text')} AS n_tokens, CAST(length(text) AS INTEGER) AS n_chars FROM documents""")(
    lambda spark, d: fx.table(spark, d, "documents").select(
        "doc_id", T.token_count("text").alias("n_tokens"), F.char_length("text").alias("n_chars")))

register("tokens_to_string", f"""
SELECT doc_id, array_to_string(regexp_extract_all(text, {S.lit(TOKEN_PATTERN)}), ' ') AS tokens FROM documents""")(
    lambda spark, d: fx.table(spark, d, "documents").select(
        "doc_id", T.tokens_to_string(F.regexp_extract_all("text", F.lit(TOKEN_PATTERN), 0)).alias("tokens")))

register("split_sentences", f"""
SELECT doc_id, CAST(len(s) AS INTEGER) AS n_sentences, array_to_string(s, ' || ') AS sentences
FROM (SELECT doc_id, {S.split_sentences('text')} AS s FROM documents) t""")(
    lambda spark, d: fx.table(spark, d, "documents").withColumn("s", T.split_sentences("text")).select(
        "doc_id", F.size("s").alias("n_sentences"), F.array_join("s", " || ").alias("sentences")))


def _explode(spark, d):
    o = fx.observations_null(spark, d).select("obs_id", T.split_sentences("ObservationAnswer").alias("s"))
    return o.select("obs_id", F.posexplode_outer("s").alias("pos", "sentence")).withColumn(
        "sentence", F.coalesce("sentence", F.lit("")))


register("explode_sentences", with_views("""
SELECT obs_id, CAST(unnest(range(len(s))) AS INTEGER) AS pos, unnest(s) AS sentence FROM s WHERE len(s) > 0
UNION ALL
SELECT obs_id, NULL AS pos, '' AS sentence FROM s WHERE s IS NULL OR len(s) = 0""", "observations_null",
    extra=[("s", f"SELECT obs_id, {S.split_sentences('ObservationAnswer')} AS s FROM observations_null")]))(_explode)

register("shuffle_sentences", with_views(f"""
SELECT obs_id, {S.shuffle_sentences('ObservationAnswer', 'CAST(obs_id AS VARCHAR)', 7)} AS shuffled
FROM observations_null""", "observations_null"))(
    lambda spark, d: fx.observations_null(spark, d).select(
        "obs_id", T.shuffle_sentences("ObservationAnswer", "obs_id", 7).alias("shuffled")))

register("tokenize", f"SELECT doc_id, array_to_string({S.tokenize('text')}, ' ') AS tokens FROM documents")(
    lambda spark, d: fx.table(spark, d, "documents").select(
        "doc_id", F.array_join(T.tokenize("text"), " ").alias("tokens")))

register("combine_fields", with_views("""
SELECT obs_id,
       '' || ObservationScheme || '  ,' || ObservationAnswer AS sa_v0,
       '' || ObservationScheme || ' [SEP] ' || ObservationAnswer AS sa_v1,
       '[CLS] ' || ObservationScheme || ' [SEP] ' || ObservationAnswer AS sa_v2,
       '[CLS] ' || ObservationScheme || ' [SEP] ' || ObservationQuestion || ' [SEP] ' || ObservationAnswer AS sqa_v2
FROM observations_null""", "observations_null"))(
    lambda spark, d: fx.observations_null(spark, d).select(
        "obs_id",
        T.combine_fields("ObservationScheme", "ObservationAnswer", version=0).alias("sa_v0"),
        T.combine_fields("ObservationScheme", "ObservationAnswer", version=1).alias("sa_v1"),
        T.combine_fields("ObservationScheme", "ObservationAnswer", version=2).alias("sa_v2"),
        T.combine_fields("ObservationScheme", "ObservationAnswer", "ObservationQuestion", 2).alias("sqa_v2")))

register("scheme_of_text", with_views("""
SELECT obs_id, trim(split_part('[CLS] ' || ObservationScheme || ' [SEP] ' || ObservationAnswer, '[SEP]', 1)) AS scheme
FROM observations""", "observations"))(
    lambda spark, d: fx.observations(spark, d).select(
        "obs_id", T.scheme_of_text(T.combine_fields("ObservationScheme", "ObservationAnswer", version=2)).alias("scheme")))

register("combine_answer_comment", with_views(f"""
SELECT a.myUnqualifiedId, a.turn AS a_turn, c.turn AS c_turn,
       {S.combine_answer_comment('a.ObservationAnswer', 'c.comments_')} AS all_text
FROM form_answers a JOIN form_comments c
  ON a.myUnqualifiedId = c.myUnqualifiedId AND a.unqualifiedversionid__ = c.unqualifiedversionid__""",
    "form_answers", "form_comments"))(
    lambda spark, d: fx.form_answers(spark, d).alias("a").join(
        fx.form_comments(spark, d).alias("c"), ["myUnqualifiedId", "unqualifiedversionid__"]).select(
        "myUnqualifiedId", F.col("a.turn").alias("a_turn"), F.col("c.turn").alias("c_turn"),
        T.combine_answer_comment("ObservationAnswer", "comments_").alias("all_text")))

register("date_parts", with_views("""
SELECT obs_id, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day
FROM (SELECT obs_id, CAST(strptime(LastUpdateDate, '%Y/%m/%d') AS DATE) AS d FROM observations) t""",
    "observations"))(
    lambda spark, d: clean.date_parts(fx.observations(spark, d), "LastUpdateDate").select(
        "obs_id", "year", "month", "day"))

# ---------------------------------------------------------------- O1-O4

register("sort_by_date", with_views("""
SELECT obs_id, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day,
       row_number() OVER (ORDER BY d NULLS FIRST, obs_id) AS pos
FROM (SELECT obs_id, CAST(try_strptime(LastUpdateDate, '%Y/%m/%d') AS DATE) AS d FROM observations) t""",
    "observations"))(
    lambda spark, d: sorting.sort_by_date(fx.observations(spark, d).select("obs_id", "LastUpdateDate"),
                                          "LastUpdateDate", ["obs_id"]).drop("LastUpdateDate"))


def _scored(spark, d):
    lg = fx.logits10(spark, d)
    return lg.select("row_id", F.posexplode("logits").alias("class", "score"))


register("topk_classes", with_views("""
SELECT row_id, class, rank FROM (
  SELECT row_id, CAST(i - 1 AS INTEGER) AS class,
         CAST(row_number() OVER (PARTITION BY row_id ORDER BY s DESC, i) AS INTEGER) AS rank
  FROM (SELECT row_id, unnest(logits) AS s, unnest(range(1, len(logits) + 1)) AS i FROM logits10) t) u
WHERE rank <= 3""", "logits10"))(
    lambda spark, d: sorting.topk_classes(_scored(spark, d), "row_id", "score", "class", 3).select(
        "row_id", "class", "rank"))

register("head_rows", with_views("SELECT obs_id FROM observations ORDER BY LastUpdateDate, obs_id LIMIT 50",
                                 "observations"))(
    lambda spark, d: sorting.head_rows(fx.observations(spark, d), 50, ["LastUpdateDate", "obs_id"]).select("obs_id"))

register("tail_rows", with_views("SELECT obs_id FROM observations ORDER BY LastUpdateDate DESC, obs_id DESC LIMIT 50",
                                 "observations"))(
    lambda spark, d: sorting.tail_rows(fx.observations(spark, d), 50, ["LastUpdateDate", "obs_id"]).select("obs_id"))

register("row_range", with_views("""
SELECT obs_id, pos FROM (SELECT obs_id, row_number() OVER (ORDER BY obs_id) AS pos FROM observations) t
WHERE pos > 100 AND pos <= 300""", "observations"))(
    lambda spark, d: sorting.row_range(fx.observations(spark, d).select("obs_id"), 100, 300, ["obs_id"]))

# ---------------------------------------------------------------- T6 with learned borders

from ..operators import borders as B  # noqa: E402

#: A frequent word of each language of the texts, put before a period as an abbreviation.
_PLANT = r" (the|und|les|que) "


def _shortened(spark, d):
    return fx.table(spark, d, "documents").select("doc_id", F.regexp_replace("text", _PLANT, " bl.a. ").alias("text"))


_BORDER_CTES = [
    ("short", f"SELECT doc_id, regexp_replace(text, '{_PLANT}', ' bl.a. ', 'g') AS text FROM documents"),
    ("cores", r"""SELECT regexp_replace(regexp_replace(t, '^[("''\[]+', ''), '[,;:!?)"''\]]+$', '') AS t FROM (
                  SELECT unnest(regexp_split_to_array(lower(text), '\s+')) AS t FROM short)"""),
    ("counts", r"""SELECT word, count(*) AS c, CAST(sum(p) AS BIGINT) AS c_period FROM (
                   SELECT regexp_replace(t, '\.+$', '') AS word, CASE WHEN t LIKE '%.' THEN 1 ELSE 0 END AS p FROM cores)
                   WHERE regexp_matches(word, '^[\p{L}.\-]*\p{L}[\p{L}.\-]*$') GROUP BY word"""),
    ("scored", f"""SELECT word, c, c_period, -2 * (c_period * ln(rate) + (c - c_period) * ln(1 - rate) - c_period * ln({B.ALWAYS}) - (c - c_period) * ln(1 - {B.ALWAYS}))
                   * exp(-len) * (length(word) - len + 1) * pow(len, -CAST(c - c_period AS DOUBLE)) AS score
                 FROM (SELECT *, CAST(length(replace(word, '.', '')) AS DOUBLE) AS len, (SELECT sum(c_period) / sum(c) FROM counts) AS rate FROM counts)
                 WHERE c_period >= {B.LEAST_COUNT}"""),
    ("abbr", f"SELECT * FROM scored WHERE score >= {B.LEAST_SCORE}"),
]

register("learn_abbreviations", with_views("SELECT word, c, c_period, round(score, 4) AS score FROM abbr", extra=_BORDER_CTES))(
    lambda spark, d: B.learn_abbreviations(_shortened(spark, d), "text").withColumn("score", F.round("score", 4)))


def _learned_split(spark, d):
    texts = _shortened(spark, d)
    known = [r["word"] for r in B.learn_abbreviations(texts, "text").select("word").collect()]
    s = texts.select("doc_id", B.split_sentences_learned(F.col("text"), known).alias("s"))
    return s.select("doc_id", F.size("s").alias("n_sentences"), F.md5(F.array_join("s", "\n")).alias("sentences_md5"))


register("split_sentences_learned", with_views(r"""
SELECT doc_id, CAST(len(s) AS INTEGER) AS n_sentences, md5(array_to_string(s, chr(10))) AS sentences_md5 FROM (
  SELECT doc_id, list_filter(list_transform(regexp_split_to_array(array_to_string(list_transform(string_split(
      regexp_replace(text, '([.!?]+["'')\]]*\s+)(["''(\[]*[\p{Lu}\p{N}])', '\1' || chr(57344) || '\2', 'g'), chr(57344)),
    lambda p: p || CASE WHEN list_contains(known, lower(regexp_replace(regexp_extract(p, '(\S+)\.\s+$', 1), '^[("''\[]+', '')))
                     OR regexp_matches(lower(regexp_replace(regexp_extract(p, '(\S+)\.\s+$', 1), '^[("''\[]+', '')), '^\p{L}$') THEN '' ELSE chr(57344) END), ''),
    '[\n' || chr(57344) || ']+'), lambda x: trim(x)), lambda x: x <> '') AS s
  FROM short, (SELECT coalesce(list(word), []) AS known FROM abbr))""", extra=_BORDER_CTES))(_learned_split)
