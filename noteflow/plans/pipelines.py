"""Composed pipelines PL1-PL7 (each one registered query)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.constants import TOKEN_PATTERN
from ..operators import clean, joins
from ..session import staged


def preprocess_pipeline(obs: DataFrame, goals: DataFrame, converter: DataFrame,
                        superusers: DataFrame | None = None, min_tokens: int | None = 5,
                        order_by=("obs_id",), text_col: str = "ObservationAnswer") -> DataFrame:
    """PL1: relevant schemes -> display names -> drop null answers -> dedup (keep last)
    -> drop number/date answers -> word counts -> [superusers] -> [min length]."""
    df = joins.keep_relevant(obs, goals, "ObservationScheme", list(order_by))
    df = joins.decode_names(df, converter, "type", "ObservationScheme")
    df = clean.drop_null(df, [text_col])
    df = clean.dedup_last(df, ["ObservationQuestion", text_col, "ObservationScheme"], list(order_by))
    df = clean.drop_date_numeric(df, [text_col])
    df = clean.len_words(df, text_col)
    if superusers is not None:
        df = joins.semi_filter(df, superusers, "PractionerName")
    if min_tokens is not None:
        df = clean.min_len(df, f"{text_col}_len", min_tokens)
    return df


def combine_answers_comments(answers: DataFrame, comments: DataFrame,
                             keys=("myUnqualifiedId", "unqualifiedversionid__"), order_by=("turn",),
                             text_col: str = "ObservationAnswer", comment_col: str = "comments_") -> DataFrame:
    """One text per form = its answers joined with '.', then '.', then its comments.

    Comments: null -> '' then ordered concat per form.  Answers: one aggregate
    per form gives both the ordered concat and the first non-null value of
    every other column.  Inner join on the form key, ``all_text``, dedup on
    (component, scheme, all_text) keeping the last form in key order.
    """
    from ..functions import text as T
    from ..operators import agg
    keys, order_by = list(keys), list(order_by)
    c = agg.concat_groups(clean.fill_empty(comments, [comment_col]), keys, comment_col, order_by)
    others = [x for x in answers.columns if x not in keys + [text_col]]
    order = F.struct(*[F.col(o) for o in order_by])
    items = F.collect_list(F.struct(*[F.col(o) for o in order_by], F.col(text_col).alias("_nf_t")))
    a = (answers.filter(F.col(keys[0]).isNotNull() & F.col(keys[1]).isNotNull()).groupBy(*keys)
         .agg(F.array_join(F.transform(F.array_sort(items), lambda s: s["_nf_t"]), ".").alias(text_col),
              *[F.min_by(F.col(x), F.when(F.col(x).isNotNull(), order)).alias(x) for x in others]))
    j = joins.join_comments(a, c, keys)
    j = j.withColumn("all_text", T.combine_answer_comment(text_col, comment_col))
    j = clean.dedup_last(j, ["ObservationComponentID", "ObservationScheme", "all_text"], keys)
    return clean.drop_null(j.drop("ObservationQuestion"), ["all_text"])


def shuffle_texts(df: DataFrame, keys=("myUnqualifiedId", "unqualifiedversionid__"), seed: int = 0,
                  text_col: str = "all_text", scheme_col: str = "ObservationScheme") -> DataFrame:
    """Seeded sentence shuffle of each form's text, then dedup (text, scheme) keeping the first form."""
    from ..functions import text as T
    keys = list(keys)
    form_key = F.concat_ws(":", *[F.col(k).cast("string") for k in keys])
    j = df.withColumn(text_col, T.shuffle_sentences(text_col, form_key, seed))
    j = clean.dedup_first(j, [text_col, scheme_col], keys)
    return clean.drop_null(j, [text_col])


def combined_text_pipeline(answers: DataFrame, comments: DataFrame,
                           keys=("myUnqualifiedId", "unqualifiedversionid__"), order_by=("turn",),
                           text_col: str = "ObservationAnswer", comment_col: str = "comments_",
                           shuffle_seed: int | None = 0) -> DataFrame:
    """PL2: combined answers + comments per form, optionally sentence-shuffled."""
    j = combine_answers_comments(answers, comments, keys, order_by, text_col, comment_col)
    return j if shuffle_seed is None else shuffle_texts(j, keys, shuffle_seed)


def new_class_dataset_pipeline(answers: DataFrame, comments: DataFrame, goals: DataFrame,
                               converter: DataFrame, superusers: DataFrame, exclude,
                               keys=("myUnqualifiedId", "unqualifiedversionid__"), order_by=("turn",),
                               test_frac: float = 0.2, val_frac: float = 0.2, seed: int = 42,
                               shuffle_seed: int = 0, min_tokens: int = 5) -> DataFrame:
    """PL3: data set for the new-class task, one frame with ``split`` in
    {train, val, test, excluded}.

    drop number/date answers -> relevant schemes -> display names -> combine
    answers and comments -> superusers -> sentence shuffle + dedup -> all_text
    word count >= min_tokens -> date sort -> last round(n*test_frac) = fixed test
    -> the rest minus the test keys -> excluded classes apart -> seeded
    train/val split of the remainder.
    """
    from ..operators import sorting, split as SP
    keys, order_by = list(keys), list(order_by)
    a = clean.drop_date_numeric(answers, ["ObservationAnswer"])
    a = joins.keep_relevant(a, goals, "ObservationScheme", keys + order_by)
    a = joins.decode_names(a, converter, "type", "ObservationScheme")
    c = combine_answers_comments(a, comments, keys, order_by)
    c = joins.semi_filter(c, superusers, "PractionerName")
    c = shuffle_texts(c, keys, shuffle_seed)
    c = clean.min_len(clean.len_words(c, "all_text"), "all_text_len", min_tokens)
    c = sorting.sort_by_date(c, "LastUpdateDate", keys)
    # pos is 1..n already: the last round(n * test_frac) positions are the test set
    n = c.agg(F.count(F.lit(1)).alias("n")).scalar()
    c = c.withColumn("split", F.when(F.col("pos") > n - F.bround(n * F.lit(float(test_frac))), "test").otherwise("trainval"))
    test = c.filter(F.col("split") == "test")
    trainval = joins.anti_keys(c, test, keys)
    excluded = clean.keep_classes(trainval, "type", exclude).withColumn("split", F.lit("excluded"))
    kept = clean.exclude_classes(trainval, "type", exclude).withColumn(
        "form_key", F.concat_ws(":", *[F.col(k).cast("string") for k in keys]))
    tv = SP.random_split(kept, "form_key", val_frac, seed, "split", ("train", "val")).drop("form_key")
    return test.unionByName(excluded).unionByName(tv)


def sentence_rows(df: DataFrame, order_by, src: str, min_tokens: int = 5,
                  text_col: str = "ObservationAnswer") -> DataFrame:
    """Positive sentence samples of PL4: one row per sentence (empty text -> one '' row),
    dedup (question, sentence, scheme) keeping the last, token count >= min_tokens,
    tokens joined by one space, label 1."""
    from ..functions import text as T
    s = (df.withColumn("_nf_s", T.split_sentences(text_col))
           .select("*", F.posexplode_outer("_nf_s").alias("spos", "_nf_sent"))
           .withColumn("spos", F.coalesce(F.col("spos"), F.lit(0)))
           .withColumn(text_col, F.coalesce(F.col("_nf_sent"), F.lit("")))
           .drop("_nf_s", "_nf_sent"))
    order = list(order_by) + ["spos"]
    s = clean.dedup_last(s, ["ObservationQuestion", text_col, "ObservationScheme"], order)
    toks = F.regexp_extract_all(F.col(text_col), F.lit(TOKEN_PATTERN), 0)
    s = s.withColumn(f"{text_col}_len", F.size(toks)).withColumn(text_col, F.array_join(toks, " "))
    s = clean.min_len(s, f"{text_col}_len", min_tokens)
    return s.withColumn("labels", F.lit(1)).withColumn("src", F.lit(src))


def sentence_scoring_pipeline(answers: DataFrame, comments: DataFrame, superusers: DataFrame | None = None,
                              keys=("myUnqualifiedId", "unqualifiedversionid__"), order_by=("turn",),
                              min_tokens: int = 5, seed: int = 100, n_test: int | float = 16000,
                              combine_version: int = 1) -> DataFrame:
    """PL4: sentence-scoring data: positives from answers and from comments, one
    negative per positive (answer of another scheme), all sorted by date,
    ``SchemeAnswer`` text, last ``n_test`` rows (below 1: that share of all rows) = test."""
    from ..functions import text as T
    from ..operators import sampling
    keys, order_by = list(keys), list(order_by)
    if superusers is not None:
        answers = joins.semi_filter(answers, superusers, "PractionerName")
    base = answers.withColumn("c_turn", F.lit(-1).cast("long"))
    key_cols = keys + order_by + ["c_turn", "spos"]
    pos_a = sentence_rows(base, keys + order_by + ["c_turn"], "answer", min_tokens)
    com = joins.join_comments(clean.len_words(answers, "ObservationAnswer"),
                              comments.withColumnRenamed(order_by[0], "c_turn"), keys)
    com = clean.comments_as_answers(com)
    pos_c = sentence_rows(com, keys + order_by + ["c_turn"], "comment", min_tokens)
    pos = pos_a.unionByName(pos_c)
    # answers draw their negatives from answers, comments from comments: one shared rank
    neg = sampling.negative_samples(pos, ["ObservationAnswer"], "ObservationScheme", key_cols, seed, within="src")
    u = pos.unionByName(neg)
    u = u.withColumn("SchemeAnswer", T.combine_fields("ObservationScheme", "ObservationAnswer",
                                                      version=combine_version))
    from ..operators import sorting
    u = sorting.sort_by_date(u, "LastUpdateDate", ["src"] + key_cols + ["labels"])
    # pos is 1..n already: the last n_test positions are the test set
    n = u.agg(F.count(F.lit(1)).alias("n")).scalar()
    held = F.bround(n * F.lit(float(n_test))) if n_test < 1 else F.lit(n_test)
    return u.withColumn("split", F.when(F.col("pos") > n - held, "test").otherwise("train_val"))


def classify_evaluate_pipeline(features: DataFrame, labels: DataFrame, row_id: str = "row_id",
                               rate_pct: float = 10, fit=None, thresholds=None, kmax: int = 5) -> DataFrame:
    """PL5: aligned features + labels -> time split (last m = test, m before = val)
    -> fit on train -> predict every split -> accuracy per split (E4), confidence
    sweep (E6) and top-k accuracy (E7) on the test rows.

    Output: one long metric table ``(section, split, x, value, n)``."""
    from ..functions.constants import CLASSIFIER_THRESHOLDS
    from ..operators import models as M, split as SP
    data = features.join(labels, row_id)
    data = SP.time_split3(data, [row_id], rate_pct=rate_pct).persist()
    fit = fit or (lambda df: M.fit_logreg(df, "features", "label", C=1.0, max_iter=50))
    model = fit(data.filter(F.col("split") == "train"))
    p = M.predict(model, data, "features").withColumnRenamed("label", "y_true")
    return _report(p, ["test"], thresholds or CLASSIFIER_THRESHOLDS, kmax)


def _report(p: DataFrame, sections, thresholds, kmax: int) -> DataFrame:
    """Accuracy of every split (E4), and the confidence sweep (E6) and top-k accuracy (E7) of ``sections``."""
    from ..operators import evaluate as E
    out = E.accuracy_by_split(p, "y_true", "y_pred").select(
        F.lit("accuracy").alias("section"), "split", F.lit(None).cast("double").alias("x"),
        F.col("acc").alias("value"), "n")
    for name in sections:
        rows = p.filter(F.col("split") == name)
        sw = E.confidence_sweep(rows, thresholds, "y_true", "y_pred", "prob_max").select(
            F.lit("confidence").alias("section"), F.lit(name).alias("split"), F.col("threshold").alias("x"),
            F.col("accuracy").alias("value"), F.col("n_samples").alias("n"))
        tk = E.topk_accuracy(rows, kmax, "probs", "y_true").select(
            F.lit("topk").alias("section"), F.lit(name).alias("split"), F.col("k").cast("double").alias("x"),
            F.col("accuracy").alias("value"), F.lit(None).cast("long").alias("n"))
        out = out.unionByName(sw).unionByName(tk)
    return out


def validate_pipeline(model, features: DataFrame, labels: DataFrame, row_id: str = "row_id", rate_pct: float = 10,
                      thresholds=None, kmax: int = 5) -> DataFrame:
    """PL5, validate-only: a fitted (loaded) model on the time split of the data; train, validation
    and test rows each get accuracy, confidence sweep and top-k accuracy.  Nothing is fitted.
    Output as :func:`classify_evaluate_pipeline`."""
    from ..functions.constants import CLASSIFIER_THRESHOLDS
    from ..operators import models as M, split as SP
    data = SP.time_split3(staged(features.join(labels, row_id)), [row_id], rate_pct=rate_pct)
    p = staged(M.predict(model, data, "features").withColumnRenamed("label", "y_true"))
    return _report(p, ["train", "val", "test"], thresholds or CLASSIFIER_THRESHOLDS, kmax)


def scorer_evaluation_pipeline(pairs: DataFrame, id_cols, split_col: str = "split", k: int = 3,
                               thresholds=None, max_features: int = 1024) -> DataFrame:
    """PL6: evaluate a pair scorer on the sentence-scoring splits.

    Native scorer (no neural model): TF-IDF of the answer, dot product with the
    centroid of its scheme's positive training answers, calibrated to a
    two-class logit by a one-feature logistic regression fitted on the training
    pairs.  Reports softmax confidence sweep (E5, E6) and binary metrics (E2) on
    the test pairs, and precision@k (E8) of the test positives against all
    training schemes.  Output ``(section, x, value, n)``.
    """
    from ..functions.constants import SCORER_THRESHOLDS
    from ..operators import evaluate as E, features as FT, models as M
    ids = list(id_cols)
    # ids are structs of the key columns: nulls and separators inside them can't merge rows
    df = staged(pairs.withColumn("_nf_id", F.struct(*ids)).withColumn("toks", FT.analyzer_tokens("ObservationAnswer"))
                     .withColumn("_nf_pid", F.struct(*ids, "labels", F.col("ObservationScheme").alias("_nf_scheme"))))
    positives = df.filter((F.col(split_col) != "test") & (F.col("labels") == 1)).dropDuplicates(["_nf_id"])
    model = FT.tfidf_fit(positives, "toks", max_features=max_features)
    # the vectors once: centroids, own-scheme scores and the ranking read them
    vecs = staged(FT.tfidf_transform(df, model, "toks", "_nf_vec").drop("toks"))
    weights = lambda rows, by: FT.vector_weights(rows, model, by, "_nf_vec")
    train_pos = vecs.filter((F.col(split_col) != "test") & (F.col("labels") == 1)).dropDuplicates(["_nf_id"])
    cents = FT.class_centroids(weights(train_pos, "_nf_id"), train_pos, "_nf_id", "ObservationScheme")
    # every pair against the centroid of its own scheme only
    sc = FT.own_class_scores(weights(vecs, "_nf_pid"), cents, "_nf_pid", "_nf_pid._nf_scheme", "ObservationScheme")
    own = staged(vecs.drop("_nf_vec").join(sc.withColumnRenamed("_nf_pid", "_nf_sid"), F.col("_nf_pid") == F.col("_nf_sid"), "left")
                   .withColumn("features", F.array(F.coalesce(F.col("score"), F.lit(0.0)))).drop("_nf_sid"))
    lr = M.fit_logreg(own.filter(F.col(split_col) != "test"), "features", "labels", C=1.0, max_iter=50)
    p = M.predict(lr, own.filter(F.col(split_col) == "test"), "features")
    p = E.softmax_probs(p.withColumn("_nf_lg", F.transform("probs", lambda x: F.log(x))), "_nf_lg") \
         .withColumnRenamed("labels", "y_true")
    sweep = E.confidence_sweep(p, thresholds or SCORER_THRESHOLDS, "y_true", "y_pred", "prob_max").select(
        F.lit("confidence").alias("section"), F.col("threshold").alias("x"), F.col("accuracy").alias("value"),
        F.col("n_samples").alias("n"))
    b = E.binary_metrics(p, "y_true", "y_pred")
    bin_rows = b.selectExpr("stack(4, 'acc', acc, 'f1', f1, 'precision', precision, 'recall', recall) as (section, value)",
                            "n").select("section", F.lit(None).cast("double").alias("x"), "value", "n")
    test_pos = vecs.filter((F.col(split_col) == "test") & (F.col("labels") == 1)).dropDuplicates(["_nf_id"])
    tsc = FT.centroid_scores(weights(test_pos, "_nf_id"), cents, "_nf_id", "ObservationScheme")
    pk = E.precision_at_k(test_pos, train_pos.select("ObservationScheme").distinct(), tsc, "_nf_id",
                          "ObservationScheme", k).select(
        F.lit("precision_at_k").alias("section"), F.col("k").cast("double").alias("x"),
        F.col("precision_at_k").alias("value"), F.col("n_rows").alias("n"))
    return sweep.unionByName(bin_rows).unionByName(pk)


def feature_build_pipeline(docs: DataFrame, out_path: str, id_col: str = "doc_id", text_col: str = "text",
                           label_col: str = "label", order_by=("doc_id",), max_features: int = 1024,
                           tokens_path: str | None = None) -> DataFrame:
    """PL7: dedup texts (keep first) -> tokens (cached as a stage) -> TF-IDF ->
    label codes -> sparse features written as an embeddings table; returns the table,
    its features ML vectors."""
    from ..operators import features as FT, labels as L
    from ..sources import files as SRC
    d = clean.dedup_first(docs, [text_col], list(order_by))
    build = lambda: d.select(id_col, label_col, FT.analyzer_tokens(text_col).alias("toks"))
    toks = SRC.materialize(docs.sparkSession, tokens_path, build) if tokens_path else build()
    model = FT.tfidf_fit(toks, "toks", max_features=max_features)
    enc = L.fit_label_encoder(toks, label_col)
    coded = L.apply_label_encoder(toks, enc, label_col, "label_code")
    vec = FT.tfidf_transform(coded, model, "toks", "features")
    SRC.write_embeddings(vec.select(id_col, F.col("label_code").alias("label"), "features"), out_path)
    return SRC.read_vectors(docs.sparkSession, out_path)
