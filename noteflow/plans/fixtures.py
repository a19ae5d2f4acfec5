"""Fixture views over the driver tables (see FIXTURES.md).

Each view is defined twice: as a Spark DataFrame (``build(spark, sf_dir)``)
and as a DuckDB CTE (``FIXTURE_SQL``) for the SQL oracle.  All views derive
from the given tables, so their size grows with the scale factor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import spread, values_df

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()

# Goal schemes (mixed spellings, one unknown) and the scheme-name converter.
GOALS = ["Sign-Up", "PURCHASE", "click ", "Not-There"]
CONVERTER = [("signup", "Sign up"), ("purchase", "Purchase"), ("click", "Click"), ("view", "Page view")]
# Metric names given to the five event types in the training-log view.
LOG_TAG_OF_EVENT = [("signup", "train/epoch"), ("purchase", "train/loss"), ("view", "eval/accuracy"),
                    ("click", "eval/f1"), ("error", "train/learning_rate")]
SCHEMES = ["signup", "purchase", "view", "click", "error"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def _date_of(id_col: str):
    return F.date_format(F.date_add(F.lit("2023-10-01").cast("date"),
                                    ((F.col(id_col) * 37) % 200).cast("int")), "yyyy/MM/dd")


def observations(spark, sf_dir, with_value: bool = False) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    n = docs.agg(F.count(F.lit(1)).alias("n")).scalar()   # one observation per event, its text a document's
    d = docs.select("doc_id", "text", "lang")
    e = table(spark, sf_dir, "events").select("event_id", "event_type", "user_id", "value", (F.col("event_id") % n).alias("_doc"))
    return (e.join(d, d.doc_id == e["_doc"])
             .select(F.col("event_id").alias("obs_id"),
                     F.col("event_type").alias("ObservationScheme"),
                     F.col("lang").alias("ObservationQuestion"),
                     F.col("text").alias("ObservationAnswer"),
                     F.col("user_id").cast("string").alias("PractionerName"),
                     _date_of("event_id").alias("LastUpdateDate"),
                     *([F.col("value")] if with_value else [])))


def observations_raw(spark, sf_dir, with_value: bool = False) -> DataFrame:
    o = observations(spark, sf_dir, with_value)
    s = F.col("ObservationScheme")
    raw = (F.when(F.col("obs_id") % 3 == 0, F.upper(s))
            .when(F.col("obs_id") % 3 == 1, F.concat(s, F.lit(" ")))
            .otherwise(F.concat(F.substring(s, 1, 3), F.lit("-"), F.expr("substr(ObservationScheme, 4)"))))
    return o.withColumn("ObservationScheme", raw)


def observations_null(spark, sf_dir) -> DataFrame:
    o = observations_raw(spark, sf_dir, with_value=True)
    i = F.col("obs_id")
    ans = (F.when(i % 11 == 0, F.lit(None).cast("string"))
            .when(i % 7 == 0, F.col("value").cast("string"))
            .when(i % 13 == 0, F.col("LastUpdateDate"))
            .otherwise(F.col("ObservationAnswer")))
    return o.withColumn("ObservationAnswer", ans).drop("value")


def goals(spark, sf_dir=None) -> DataFrame:
    return values_df(spark, [(g,) for g in GOALS], "type string")


def converter(spark, sf_dir=None) -> DataFrame:
    return values_df(spark, CONVERTER, "clean_scheme string, original_scheme string")


def superusers(spark, sf_dir) -> DataFrame:
    per_user = (table(spark, sf_dir, "events").groupBy("user_id")
                .agg(F.count(F.lit(1)).alias("n")))
    med = per_user.agg(F.median("n")).scalar()  # scalar subquery, planned with the query
    return (per_user.filter((F.col("n") >= med) | (F.col("user_id") % 3 == 0))
            .select(F.col("user_id").cast("string").alias("PractionerName")))


def _conv_scheme():
    arr = F.array(*[F.lit(s) for s in SCHEMES])
    return F.element_at(arr, (F.col("conv_id") % 5 + 1).cast("int"))


def form_answers(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "conversations").filter(F.col("role") == "assistant")
    return c.select(F.col("conv_id").alias("myUnqualifiedId"),
                    (F.col("conv_id") % 3).alias("unqualifiedversionid__"),
                    F.col("turn"),
                    F.concat(F.lit("c"), (F.col("conv_id") % 7).cast("string")).alias("ObservationComponentID"),
                    _conv_scheme().alias("ObservationScheme"),
                    F.concat(F.lit("q"), F.col("turn").cast("string")).alias("ObservationQuestion"),
                    F.col("text").alias("ObservationAnswer"),
                    (F.col("conv_id") % 150).cast("string").alias("PractionerName"),
                    _date_of("conv_id").alias("LastUpdateDate"))


def form_comments(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "conversations").filter(F.col("role") == "user")
    txt = F.when((F.col("conv_id") + F.col("turn")) % 5 == 0, F.lit(None).cast("string")).otherwise(F.col("text"))
    return c.select(F.col("conv_id").alias("myUnqualifiedId"),
                    (F.col("conv_id") % 3).alias("unqualifiedversionid__"),
                    F.col("turn"), txt.alias("comments_"))


def embedded(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("row_id"), F.col("embedding").alias("features"), "label")


def _folded(k: int):
    """k logits from all values: logit j is the sum of those at positions i with i % k = j."""
    return F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda j: F.aggregate(
        F.filter("embedding", lambda x, i: i % k == j), F.lit(0.0), lambda a, x: a + x))


def logits10(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("row_id"),
        _folded(10).alias("logits"),
        F.col("label").alias("y_true"))


def logits2(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("row_id"),
        _folded(2).alias("logits"),
        (F.col("label") % 2).alias("y_true"))


def train_log(spark, sf_dir) -> DataFrame:
    tags = values_df(spark, LOG_TAG_OF_EVENT, "event_type string, tag string")
    return (table(spark, sf_dir, "events").join(F.broadcast(tags), "event_type")
            .select(F.col("event_id").alias("seq"), "tag", "value"))


def doc_classes(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id"), F.col("text"), F.col("lang").alias("label"))


# ---------------------------------------------------------------------------
# DuckDB definitions of the same views (CTE bodies).

def _date_sql(id_col: str) -> str:
    return f"strftime(DATE '2023-10-01' + CAST(({id_col} * 37) % 200 AS INTEGER), '%Y/%m/%d')"


def _values(rows, cols) -> str:
    def q(v):
        return "'" + str(v).replace("'", "''") + "'"
    body = ", ".join("(" + ", ".join(q(v) for v in (r if isinstance(r, tuple) else (r,))) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) AS t({', '.join(cols)})"


def _folded_sql(k: int) -> str:
    return (f"list_transform(range({k}), lambda j: list_sum(list_transform(list_filter(embedding, "
            f"lambda x, i: (i - 1) % {k} = j), lambda x: CAST(x AS DOUBLE))))")


_SCHEME_LIST_SQL = "[" + ", ".join(f"'{s}'" for s in SCHEMES) + "]"

FIXTURE_SQL: dict[str, tuple[str, tuple[str, ...]]] = {
    "observations": (f"""
        SELECT e.event_id AS obs_id, e.event_type AS ObservationScheme, d.lang AS ObservationQuestion,
               d.text AS ObservationAnswer, CAST(e.user_id AS VARCHAR) AS PractionerName,
               {_date_sql('e.event_id')} AS LastUpdateDate
        FROM events e JOIN documents d ON d.doc_id = e.event_id % (SELECT count(*) FROM documents)""", ()),
    "observations_raw": ("""
        SELECT * REPLACE (CASE obs_id % 3 WHEN 0 THEN upper(ObservationScheme)
                                           WHEN 1 THEN ObservationScheme || ' '
                                           ELSE substr(ObservationScheme, 1, 3) || '-' || substr(ObservationScheme, 4)
                          END AS ObservationScheme)
        FROM observations""", ("observations",)),
    "observations_null": ("""
        SELECT o.* REPLACE (CASE WHEN o.obs_id % 11 = 0 THEN NULL
                                 WHEN o.obs_id % 7 = 0 THEN CAST(e.value AS VARCHAR)
                                 WHEN o.obs_id % 13 = 0 THEN o.LastUpdateDate
                                 ELSE o.ObservationAnswer END AS ObservationAnswer)
        FROM observations_raw o JOIN events e ON o.obs_id = e.event_id""", ("observations_raw",)),
    "goals": (_values(GOALS, ["type"]), ()),
    "converter": (_values(CONVERTER, ["clean_scheme", "original_scheme"]), ()),
    "superusers": ("""
        SELECT CAST(user_id AS VARCHAR) AS PractionerName
        FROM (SELECT user_id, count(*) AS n FROM events GROUP BY user_id) u
        WHERE n >= (SELECT median(n) FROM (SELECT count(*) AS n FROM events GROUP BY user_id))
           OR user_id % 3 = 0""", ()),
    "form_answers": (f"""
        SELECT conv_id AS myUnqualifiedId, conv_id % 3 AS unqualifiedversionid__, turn,
               'c' || CAST(conv_id % 7 AS VARCHAR) AS ObservationComponentID,
               {_SCHEME_LIST_SQL}[CAST(conv_id % 5 + 1 AS INTEGER)] AS ObservationScheme,
               'q' || CAST(turn AS VARCHAR) AS ObservationQuestion,
               text AS ObservationAnswer, CAST(conv_id % 150 AS VARCHAR) AS PractionerName,
               {_date_sql('conv_id')} AS LastUpdateDate
        FROM conversations WHERE role = 'assistant'""", ()),
    "form_comments": ("""
        SELECT conv_id AS myUnqualifiedId, conv_id % 3 AS unqualifiedversionid__, turn,
               CASE WHEN (conv_id + turn) % 5 = 0 THEN NULL ELSE text END AS comments_
        FROM conversations WHERE role = 'user'""", ()),
    "embedded": ("SELECT vec_id AS row_id, embedding AS features, label FROM embeddings", ()),
    "logits10": (f"SELECT vec_id AS row_id, {_folded_sql(10)} AS logits, label AS y_true FROM embeddings", ()),
    "logits2": (f"SELECT vec_id AS row_id, {_folded_sql(2)} AS logits, label % 2 AS y_true FROM embeddings", ()),
    "train_log": (f"""
        SELECT e.event_id AS seq, t.tag, e.value
        FROM events e JOIN ({_values(LOG_TAG_OF_EVENT, ['event_type', 'tag'])}) t
          ON e.event_type = t.event_type""", ()),
    "doc_classes": ("SELECT doc_id, text, lang AS label FROM documents", ()),
}

BUILDERS = {
    "observations": observations, "observations_raw": observations_raw,
    "observations_null": observations_null, "goals": goals, "converter": converter,
    "superusers": superusers, "form_answers": form_answers, "form_comments": form_comments,
    "embedded": embedded, "logits10": logits10, "logits2": logits2, "train_log": train_log,
    "doc_classes": doc_classes,
}


def with_views(sql_body: str, *names: str, extra: list[tuple[str, str]] = ()) -> str:
    """Prefix ``sql_body`` with the CTEs of the named fixture views (dependencies first)
    and any ``extra`` (name, body) CTEs, which may use the fixtures."""
    order: list[str] = []

    def visit(n):
        if n in order:
            return
        for dep in FIXTURE_SQL[n][1]:
            visit(dep)
        order.append(n)

    for n in names:
        visit(n)
    ctes = [f"{n} AS ({FIXTURE_SQL[n][0]})" for n in order] + [f"{n} AS ({b})" for n, b in extra]
    return ("WITH " + ",\n".join(ctes) + "\n" + sql_body) if ctes else sql_body
