"""Registered queries: features (F1-F5), the centroid scorer (E8), sources (S1-S9),
models (M1-M12) and the model pipelines (PL5-PL7)."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..operators import evaluate as E
from ..operators import features as FT
from ..operators.blocks import vector_bytes
from ..operators.split import random_split
from ..session import spread_rows, staged
from ..sources import files as SRC
from . import fixtures as fx
from . import sqlsnip as S
from .fixtures import with_views
from .registry import register

R = S.r6


def _docs(spark, d, table="documents", id_col="doc_id"):
    return fx.table(spark, d, table).select(id_col, "text", FT.analyzer_tokens("text").alias("toks"),
                                            *(["lang"] if table == "documents" else []))


_DOCS = ("docs", f"SELECT doc_id, lang, {S.analyzer_tokens('text')} AS toks FROM documents")


def _counted_docs(spark, d):
    """Documents with their counted terms, made once for a fit and its weights."""
    return FT.counted_rows(_docs(spark, d), "doc_id", "toks")


def _weights_q(spark, d, **kw):
    docs = _docs(spark, d) if "max_features" in kw else _counted_docs(spark, d)
    model = FT.tfidf_fit(docs, "toks", **kw)
    return FT.tfidf_weights(docs, model, "doc_id").select("doc_id", "term", F.round("weight", 6).alias("weight"))


register("tfidf", with_views(f"SELECT doc_id, term, {R('weight')} AS weight FROM t_wt", extra=[_DOCS]
                             + S.tfidf_vocab_ctes("t_", "docs", max_features=1024)
                             + S.tfidf_weight_ctes("t_", "docs", "doc_id", "t_voc")))(
    lambda spark, d: _weights_q(spark, d, max_features=1024))

register("tfidf_df_bounds", with_views(f"SELECT doc_id, term, {R('weight')} AS weight FROM t_wt", extra=[_DOCS]
                                       + S.tfidf_vocab_ctes("t_", "docs", min_df=5, max_df=0.25)
                                       + S.tfidf_weight_ctes("t_", "docs", "doc_id", "t_voc")))(
    lambda spark, d: _weights_q(spark, d, min_df=5, max_df=0.25))


def _vectors(spark, d):
    docs = _docs(spark, d)
    model = FT.tfidf_fit(docs, "toks", max_features=1024)
    v = FT.tfidf_transform(docs, model, "toks").withColumn("a", vector_to_array("tfidf"))
    return v.select("doc_id", F.size(F.filter("a", lambda x: x != 0)).alias("nnz"),
                    F.round(F.aggregate("a", F.lit(0.0), lambda s, x: s + x), 6).alias("sum_w"))


register("tfidf_vectors", with_views(f"""
SELECT d.doc_id, CAST(coalesce(w.nnz, 0) AS INTEGER) AS nnz, {R('coalesce(w.sum_w, 0)')} AS sum_w
FROM docs d LEFT JOIN (SELECT doc_id, count(*) AS nnz, sum(weight) AS sum_w FROM t_wt GROUP BY doc_id) w USING (doc_id)""",
    extra=[_DOCS] + S.tfidf_vocab_ctes("t_", "docs", max_features=1024)
    + S.tfidf_weight_ctes("t_", "docs", "doc_id", "t_voc")))(_vectors)


def _sparse(spark, d):
    """The whole vocabulary, stored as sparse structs and read back as vectors."""
    docs = _counted_docs(spark, d)
    path = SRC.scratch_path(spark, "sparse")
    FT.tfidf_sparse(docs, FT.tfidf_fit(docs, "toks", min_df=2), "doc_id").write.parquet(path)
    v = F.unwrap_udt(F.col("features"))
    return SRC.read_vectors(spark, path).select(
        "doc_id", v["size"].alias("size"), F.size(v["indices"]).alias("nnz"), F.round(F.aggregate(v["values"], F.lit(0.0), lambda s, x: s + x), 6).alias("sum_w"),
        F.coalesce(F.array_max(v["indices"]), F.lit(-1)).alias("last_term"))


register("tfidf_sparse", with_views(f"""
SELECT d.doc_id, CAST((SELECT count(*) FROM t_voc) AS INTEGER) AS size, CAST(coalesce(w.nnz, 0) AS INTEGER) AS nnz, {R('coalesce(w.sum_w, 0)')} AS sum_w,
       CAST(coalesce(w.last_term, -1) AS INTEGER) AS last_term
FROM docs d LEFT JOIN (SELECT doc_id, count(*) AS nnz, sum(weight) AS sum_w, max(v.id) AS last_term
                       FROM t_wt JOIN (SELECT term, row_number() OVER (ORDER BY term) - 1 AS id FROM t_voc) v USING (term) GROUP BY doc_id) w USING (doc_id)""",
    extra=[_DOCS] + S.tfidf_vocab_ctes("t_", "docs", min_df=2) + S.tfidf_weight_ctes("t_", "docs", "doc_id", "t_voc")))(_sparse)


def _prefix(spark, d):
    docs = _docs(spark, d)
    model = FT.tfidf_fit_prefix(docs, 300, ["doc_id"], "toks", max_features=1024)
    return FT.tfidf_weights(docs, model, "doc_id").select("doc_id", "term", F.round("weight", 6).alias("weight"))


register("tfidf_fit_prefix", with_views(f"SELECT doc_id, term, {R('weight')} AS weight FROM t_wt", extra=[
    _DOCS, ("head", "SELECT * FROM docs ORDER BY doc_id LIMIT 300")]
    + S.tfidf_vocab_ctes("t_", "head", max_features=1024) + S.tfidf_weight_ctes("t_", "docs", "doc_id", "t_voc")))(_prefix)


def _transfer(spark, d):
    model = FT.tfidf_fit(_docs(spark, d), "toks", max_features=1024)
    bench = _docs(spark, d, "benchmark", "item_id")
    return FT.tfidf_weights(bench, model, "item_id").select("item_id", "term", F.round("weight", 6).alias("weight"))


register("tfidf_transfer", with_views(f"SELECT item_id, term, {R('weight')} AS weight FROM b_wt", extra=[
    _DOCS, ("bench", f"SELECT item_id, {S.analyzer_tokens('text')} AS toks FROM benchmark")]
    + S.tfidf_vocab_ctes("t_", "docs", max_features=1024) + S.tfidf_weight_ctes("b_", "bench", "item_id", "t_voc")))(
    _transfer)

def _embed(spark, d):
    e = FT.embed_batches(fx.table(spark, d, "documents").select("doc_id", "text"), "text", dim=64)
    return (e.select("doc_id", F.posexplode("features").alias("bucket", "value")).filter(F.col("value") != 0)
             .withColumn("value", F.round(F.col("value").cast("double"), 6)))


register("embed_batches", f"""
SELECT doc_id, bucket, round(CAST(CAST(s / sqrt(sum(s * s) OVER (PARTITION BY doc_id)) AS FLOAT) AS DOUBLE), 6) AS value
FROM (SELECT doc_id, CAST(h % 64 AS INTEGER) AS bucket,
             sum(CASE WHEN (h >> 59) & 1 = 1 THEN -1.0 ELSE 1.0 END) AS s
      FROM (SELECT doc_id, {S.draw(0, 'w')} AS h
            FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+')) AS w FROM documents) t) u
      GROUP BY doc_id, bucket) v
QUALIFY s <> 0""")(_embed)


def _mean_pool(spark, d):
    m = FT.mean_pool(fx.embedded(spark, d), ["label"], "features")
    return m.select("label", F.posexplode("mean").alias("pos", "mean")).withColumn("mean", F.round("mean", 6))


register("mean_pool", f"""
SELECT label, CAST(i - 1 AS INTEGER) AS pos, {R('avg(x)')} AS mean
FROM (SELECT label, unnest(embedding) AS x, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings) t
GROUP BY label, i""")(_mean_pool)

# ---------------------------------------------------------------- E8 with the centroid scorer


def _precision_at_k(spark, d, k=2):
    from ..session import reliable_checkpoint
    # tokens are read by the fit, the centroids and the scoring: stage them once
    docs = reliable_checkpoint(random_split(_docs(spark, d).withColumnRenamed("lang", "label"), "doc_id", 0.2, 42)
                               .select("doc_id", "label", "toks", "split"))
    train = docs.filter(F.col("split") == "train")
    test = docs.filter(F.col("split") == "val")
    model = FT.tfidf_fit(train, "toks", max_features=1024)
    cents = FT.class_centroids(FT.tfidf_weights(train, model, "doc_id"), train, "doc_id", "label")
    scores = FT.centroid_scores(FT.tfidf_weights(test, model, "doc_id"), cents, "doc_id", "label")
    out = E.precision_at_k(test, train.select("label").distinct(), scores, "doc_id", "label", k)
    return out.withColumn("precision_at_k", F.round("precision_at_k", 6))


_SPLIT_DOCS = [_DOCS, ("sd", f"""SELECT *, CASE WHEN row_number() OVER (ORDER BY {S.draw(42, 'doc_id')}, doc_id)
                                  <= ceil((SELECT count(*) FROM docs) * CAST(0.2 AS DOUBLE)) THEN 'val' ELSE 'train' END AS split
                                  FROM docs"""),
               ("tr", "SELECT doc_id, lang AS label, toks FROM sd WHERE split = 'train'"),
               ("te", "SELECT doc_id, lang AS label, toks FROM sd WHERE split = 'val'")]

register("precision_at_k", with_views(f"""
SELECT 2 AS k, count(*) AS n_rows, CAST(sum(hit) AS BIGINT) AS hits, {R('avg(hit) * 100')} AS precision_at_k
FROM (SELECT te.doc_id, coalesce(max(CASE WHEN r.rk <= 2 AND r.label = te.label THEN 1 ELSE 0 END), 0) AS hit
      FROM te LEFT JOIN (
        SELECT p.doc_id, p.label, row_number() OVER (PARTITION BY p.doc_id ORDER BY coalesce(s.score, 0) DESC, p.label) AS rk
        FROM (SELECT te.doc_id, c.label FROM te, (SELECT DISTINCT label FROM tr) c) p
        LEFT JOIN (SELECT w.doc_id, c.label, sum(w.weight * c.c) AS score FROM e_wt w JOIN cent c USING (term)
                   GROUP BY w.doc_id, c.label) s USING (doc_id, label)) r ON r.doc_id = te.doc_id
      GROUP BY te.doc_id) h""", extra=_SPLIT_DOCS + S.tfidf_vocab_ctes("t_", "tr", max_features=1024)
    + S.tfidf_weight_ctes("r_", "tr", "doc_id", "t_voc") + S.tfidf_weight_ctes("e_", "te", "doc_id", "t_voc") + [
        ("cent", """SELECT s.label, s.term, s.sw / n.n AS c FROM
                    (SELECT tr.label, w.term, sum(w.weight) AS sw FROM r_wt w JOIN tr USING (doc_id) GROUP BY 1, 2) s
                    JOIN (SELECT label, count(*) AS n FROM tr GROUP BY label) n USING (label)""")]))(_precision_at_k)

# ---------------------------------------------------------------- models (rows-only checks)

from ..operators import labels as L  # noqa: E402
from ..operators import models as M  # noqa: E402
from . import pipelines  # noqa: E402


def _model_data(spark, d, embed: bool = False):
    """Documents with language labels: TF-IDF vectors (or 64-d hashing embeddings), codes, split;
    texts and tokens end here, so fits keep and move features only, in partitions of bounded size."""
    docs = fx.doc_classes(spark, d)
    enc = L.fit_label_encoder(docs, "label")
    docs = L.apply_label_encoder(docs.withColumnRenamed("label", "lang"), enc, "lang", "label") \
            .withColumn("label", F.col("label").cast("double"))
    if embed:
        x = FT.embed_batches(docs, "text", dim=64)
    else:
        t = docs.withColumn("toks", FT.analyzer_tokens("text"))
        x = FT.tfidf_transform(t, FT.tfidf_fit(t, "toks", max_features=1024), "toks", "features")
    rows = staged(x.select(F.col("doc_id").alias("row_id"), "lang", "label", "features"))
    return spread_rows(random_split(rows, "row_id", 0.2, 42), vector_bytes(rows, "features")).persist()


def _metrics_of(model, data, scope="test"):
    p = M.predict(model, data.filter(F.col("split") == "val"), "features")
    return _round4(E.macro_metrics(p, "label", "y_pred"))


def _round4(df):
    return df.select(*[F.round(c, 6).alias(c) if c in ("acc", "f1", "precision", "recall") else F.col(c)
                       for c in df.columns])


def _train(data):
    return data.filter(F.col("split") == "train")


register("fit_logreg")(lambda spark, d: _metrics_of(M.fit_logreg(_train(x := _model_data(spark, d)), max_iter=50), x))
register("fit_logreg_balanced")(lambda spark, d: _metrics_of(
    M.fit_logreg(_train(x := _model_data(spark, d)), class_weight="balanced", max_iter=50), x))
register("fit_ridge")(lambda spark, d: _metrics_of(M.fit_ridge(_train(x := _model_data(spark, d)), alpha=1.0), x))
register("fit_lda")(lambda spark, d: _metrics_of(M.fit_lda(_train(x := _model_data(spark, d)), shrinkage=0.5), x))
register("fit_linear_svm")(lambda spark, d: _metrics_of(
    M.fit_linear_svm(_train(x := _model_data(spark, d, embed=True)), max_iter=20), x))
register("boosted_trees_metrics")(lambda spark, d: _metrics_of(
    M.fit_boosted_trees(_train(x := _model_data(spark, d, embed=True)), n_trees=5, max_depth=3), x))


def _grid(spark, d):
    x = _model_data(spark, d, embed=True)
    lr = LogisticRegression(featuresCol="features", labelCol="label", maxIter=30)
    return M.grid_search(_train(x), lr, {"regParam": [0.001, 0.1], "elasticNetParam": [0.0]}, key="row_id")[1]


def _random(spark, d):
    x = _model_data(spark, d, embed=True)
    lr = LogisticRegression(featuresCol="features", labelCol="label", maxIter=30)
    return M.random_search(_train(x), lr, {"regParam": [0.001, 0.01, 0.1], "maxIter": [20, 30]}, 2, key="row_id")[1]


from pyspark.ml.classification import LogisticRegression  # noqa: E402

register("grid_search")(_grid)
register("ridge_grid_cv")(lambda spark, d: M.ridge_grid_cv(_train(_model_data(spark, d)).drop("split"),
                                                           [0.1, 1.0, 10.0], folds=3))
register("random_search")(_random)


def _leaderboard(spark, d):
    x = _model_data(spark, d)
    fits = {"logreg": lambda t: M.fit_logreg(t, max_iter=50), "ridge": lambda t: M.fit_ridge(t, alpha=1.0),
            "lda": lambda t: M.fit_lda(t, shrinkage=0.5)}
    return _round4(M.leaderboard(_train(x), x.filter(F.col("split") == "val"), fits))


register("leaderboard")(_leaderboard)
register("cross_val_scores")(lambda spark, d: _round4(M.cross_val_scores(
    _model_data(spark, d, embed=True).drop("split"), lambda t: M.fit_ridge(t, alpha=1.0), k=3)))


def _predict(spark, d):
    x = _model_data(spark, d)
    p = M.predict(M.fit_logreg(_train(x), max_iter=50), x.filter(F.col("split") == "val"))
    return p.select("row_id", "y_pred", F.round("prob_max", 6).alias("prob_max"))


register("predict")(_predict)


def _learning_curve(spark, d):
    x = _model_data(spark, d, embed=True)
    train, test = _train(x), x.filter(F.col("split") == "val")
    new_code = 0.0  # 'de', the first language in code-point order
    base = train.filter(F.col("label") != new_code)
    extra = train.filter(F.col("label") == new_code)
    return _round4(M.learning_curve(base, extra, [0, 20], lambda t: M.fit_ridge(t, alpha=1.0), test, new_code,
                                    ["row_id"]))


register("learning_curve")(_learning_curve)
def _refit_full(spark, d):
    from ..operators.split import time_split3
    x = time_split3(_model_data(spark, d).drop("split"), ["row_id"], rate_pct=10)
    model = M.refit_full(x, lambda t: M.fit_ridge(t, alpha=1.0))       # train + val
    p = M.predict(model, x.filter(F.col("split") == "test"), "features")
    return _round4(E.macro_metrics(p, "label", "y_pred"))


register("refit_full")(_refit_full)


def _save_load(spark, d):
    x = _model_data(spark, d)
    lr = M.fit_logreg(_train(x), max_iter=50)
    p1 = SRC.scratch_path(spark, "model-lr")
    SRC.save_model(lr, p1)
    from pyspark.ml.classification import LogisticRegressionModel
    back = SRC.load_model(p1, LogisticRegressionModel)
    rg = M.fit_ridge(_train(x), alpha=1.0)
    p2 = SRC.scratch_path(spark, "model-ridge")
    rg.save(spark, p2)
    rg2 = M.LinearModel.load(spark, p2)
    a = _metrics_of(back, x).withColumn("model", F.lit("logreg"))
    b = _metrics_of(rg2, x).withColumn("model", F.lit("ridge"))
    return a.unionByName(b)


register("save_load_model")(_save_load)


def _pl5(spark, d):
    e = fx.embedded(spark, d)
    return pipelines.classify_evaluate_pipeline(
        e.select("row_id", "features"), e.select("row_id", F.col("label").cast("double").alias("label")),
        "row_id", 10).select("section", "split", "x", F.round("value", 6).alias("value"), "n")


register("classify_evaluate_pipeline")(_pl5)


def _pl6(spark, d):
    pairs = pipelines.sentence_scoring_pipeline(fx.form_answers(spark, d), fx.form_comments(spark, d),
                                                fx.superusers(spark, d), min_tokens=5, seed=100, n_test=0.1)
    return pipelines.scorer_evaluation_pipeline(pairs, ["src", "myUnqualifiedId", "unqualifiedversionid__", "turn",
                                                        "c_turn", "spos"]).select(
        "section", "x", F.round("value", 6).alias("value"), "n")


register("scorer_evaluation_pipeline")(_pl6)


def _pl7(spark, d):
    out = pipelines.feature_build_pipeline(fx.doc_classes(spark, d), SRC.scratch_path(spark, "features"),
                                           tokens_path=SRC.scratch_path(spark, "tokens"))
    a = F.unwrap_udt(F.col("features"))["values"]      # only the stored entries
    return out.select("doc_id", "label", F.size(F.filter(a, lambda v: v != 0)).alias("nnz"),
                      F.round(F.aggregate(a, F.lit(0.0), lambda s, v: s + v), 6).alias("sum_w"))


register("feature_build_pipeline", with_views(f"""
SELECT d.doc_id, c.code AS label, CAST(coalesce(w.nnz, 0) AS INTEGER) AS nnz, {R('coalesce(w.sum_w, 0)')} AS sum_w
FROM dd d JOIN (SELECT lang, CAST(row_number() OVER (ORDER BY lang) - 1 AS INTEGER) AS code
                FROM (SELECT DISTINCT lang FROM dd) l) c USING (lang)
LEFT JOIN (SELECT doc_id, count(*) AS nnz, sum(CAST(CAST(weight AS FLOAT) AS DOUBLE)) AS sum_w FROM t_wt GROUP BY doc_id) w USING (doc_id)""",
    extra=[("dd", f"""SELECT doc_id, lang, {S.analyzer_tokens('text')} AS toks FROM documents
                     QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1""")]
    + S.tfidf_vocab_ctes("t_", "dd", max_features=1024) + S.tfidf_weight_ctes("t_", "dd", "doc_id", "t_voc")))(_pl7)
