"""Evaluation (E1-E15): macro/binary metrics, softmax, confidence sweep, top-k accuracy,
outcome tables and training-log series.

Every metric is one aggregate pass over the scored rows (partial aggregation
map-side); per-class tables have at most K or K*K rows.  Thresholds and k
values become columns of a single aggregate and are unpivoted with ``stack``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.constants import CLASSIFIER_THRESHOLDS, LOG_TAGS
from ..functions.text import scheme_of_text
from ..session import staged, values_df
from .order import bounded_broadcast, dim_rank, rank_within


def _c(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def _div0(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def _same(y: str, yhat: str) -> Column:
    """Prediction equals label; a null on either side is a miss."""
    return F.coalesce(F.col(y) == F.col(yhat), F.lit(False))


def per_class_counts(df: DataFrame, y: str = "y_true", yhat: str = "y_pred", group=()) -> DataFrame:
    """TP/FP/FN per class (and group) from the K x K confusion counts, with ``rows`` and
    ``ok`` (all rows and right ones, counted at the true label); null labels have a row of
    their own."""
    group = list(group)
    ltype = df.schema[y].dataType
    cm = (df.withColumn(yhat, F.col(yhat).cast(ltype))
            .groupBy(*group, y, yhat).agg(F.count(F.lit(1)).alias("_n")))
    hit, n, none = _same(y, yhat), F.col("_n"), F.lit(0).cast("long")
    roles = F.array(
        F.struct(F.col(y).alias("label"), F.when(hit, n).otherwise(none).alias("tp"), none.alias("fp"),
                 F.when(hit, none).otherwise(n).alias("fn"), n.alias("rows"), F.when(hit, n).otherwise(none).alias("ok")),
        F.struct(F.col(yhat).alias("label"), none.alias("tp"), F.when(hit, none).otherwise(n).alias("fp"), none.alias("fn"),
                 none.alias("rows"), none.alias("ok")))
    return (cm.select(*group, F.explode(roles).alias("r")).select(*group, "r.*")
              .groupBy(*group, "label").agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn", "rows", "ok")]))


_MACRO = ["acc", "f1", "precision", "recall", "n"]


def _macro_aggs() -> list[Column]:
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    named = F.col("label").isNotNull()
    avg = lambda c: F.avg(F.when(named, c))
    return [(F.sum("ok") / F.sum("rows")).alias("acc"), avg(_div0(2 * tp, 2 * tp + fp + fn)).alias("f1"),
            avg(_div0(tp, tp + fp)).alias("precision"), avg(_div0(tp, tp + fn)).alias("recall"),
            F.coalesce(F.sum("rows"), F.lit(0)).cast("long").alias("n")]


def macro_metrics(df: DataFrame, y: str = "y_true", yhat: str = "y_pred", group=()) -> DataFrame:
    """Accuracy and macro precision / recall / F1 over the union of true and
    predicted labels; an undefined ratio counts as 0, a null prediction or label as wrong.
    One row (per group), one pass over the rows."""
    group = list(group)
    per = per_class_counts(df, y, yhat, group)
    return (per.groupBy(*group) if group else per).agg(*_macro_aggs()).select(*group, *_MACRO)


def binary_metrics(df: DataFrame, y: str = "y_true", yhat: str = "y_pred", positive=1) -> DataFrame:
    """Accuracy, precision, recall and F1 of the positive class, one pass."""
    t, p = (F.coalesce(F.col(c) == positive, F.lit(False)) for c in (y, yhat))
    s = df.agg(F.sum((t & p).cast("long")).alias("tp"), F.sum((~t & p).cast("long")).alias("fp"),
               F.sum((t & ~p).cast("long")).alias("fn"), F.avg(_same(y, yhat).cast("double")).alias("acc"),
               F.count(F.lit(1)).alias("n"))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return s.select("acc", _div0(2 * tp, 2 * tp + fp + fn).alias("f1"), _div0(tp, tp + fp).alias("precision"),
                    _div0(tp, tp + fn).alias("recall"), "n")


def auto_metrics(df: DataFrame, y: str = "y_true", yhat: str = "y_pred", positive=1) -> DataFrame:
    """Binary metrics when the true labels have exactly two values, else macro; decided
    inside the plan, from the same per-class counts."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    one = lambda c: F.coalesce(F.max(F.when(F.col("label") == positive, c)), F.lit(0.0))
    both = per_class_counts(df, y, yhat).agg(
        *_macro_aggs(), F.sum(((tp + fn > 0) & F.col("label").isNotNull()).cast("int")).alias("_k"),
        one(_div0(2 * tp, 2 * tp + fp + fn)).alias("_f1"), one(_div0(tp, tp + fp)).alias("_precision"),
        one(_div0(tp, tp + fn)).alias("_recall"))
    return both.select("acc", *[F.when(F.col("_k") == 2, F.col(f"_{c}")).otherwise(F.col(c)).alias(c) for c in _MACRO[1:4]], "n")


def accuracy_by_split(df: DataFrame, y: str = "y_true", yhat: str = "y_pred", split: str = "split") -> DataFrame:
    """Accuracy per split; a null prediction or label is wrong."""
    return df.groupBy(split).agg(F.avg(_same(y, yhat).cast("double")).alias("acc"),
                                 F.count(F.lit(1)).alias("n"))


def softmax_probs(df: DataFrame, logits: str = "logits", probs: str = "probs") -> DataFrame:
    """E5: row softmax; ``y_pred`` = argmax (lowest index on ties), ``prob_max``, and
    ``pos_prob`` = probability of class 1."""
    lg = F.col(logits)
    mx = F.array_max(lg)
    # the maximum and the sum are zipped in: inside a lambda they would be computed per element
    ex = F.zip_with(lg, F.array_repeat(mx, F.size(lg)), lambda x, m: F.exp(x - m))
    tot = F.aggregate(F.col("_nf_ex"), F.lit(0.0), lambda a, x: a + x)
    p = F.zip_with(F.col("_nf_ex"), F.array_repeat(tot, F.size("_nf_ex")), lambda x, t: x / t)
    return (df.withColumn("_nf_ex", ex).withColumn(probs, p).drop("_nf_ex")
              .withColumn("y_pred", (F.array_position(lg, mx) - 1).cast("int"))
              .withColumn("prob_max", F.array_max(F.col(probs)))
              .withColumn("pos_prob", F.try_element_at(F.col(probs), F.lit(2))))


def _stack(df: DataFrame, n: int, groups, names: list[str]) -> DataFrame:
    """Unpivot one wide aggregate row into ``n`` rows of ``names``."""
    parts = ", ".join(", ".join(f"`{c}`" for c in g) for g in groups)
    return df.selectExpr(f"stack({n}, {parts}) as ({', '.join(names)})")


def confidence_sweep(df: DataFrame, thresholds=CLASSIFIER_THRESHOLDS, y: str = "y_true",
                     yhat: str = "y_pred", prob: str = "prob_max") -> DataFrame:
    """Per threshold t, rows with probability strictly above t, their share of all
    rows and their accuracy (null when none).  One aggregate for all thresholds."""
    ok = (F.col(y) == F.col(yhat)).cast("long")
    aggs = [F.count(F.lit(1)).alias("total")]
    for i, t in enumerate(thresholds):
        above = F.col(prob) > F.lit(float(t))
        aggs += [F.sum(above.cast("long")).alias(f"n{i}"), F.sum(F.when(above, ok)).alias(f"c{i}")]
    wide = df.agg(*aggs)
    wide = wide.select("total", *[F.lit(float(t)).alias(f"t{i}") for i, t in enumerate(thresholds)],
                       *[F.coalesce(F.col(f"n{i}"), F.lit(0)).alias(f"n{i}") for i in range(len(thresholds))],
                       *[F.col(f"c{i}") for i in range(len(thresholds))])
    groups = [(f"t{i}", f"n{i}", f"c{i}", "total") for i in range(len(thresholds))]
    out = _stack(wide, len(thresholds), groups, ["threshold", "n_samples", "n_correct", "total"])
    return out.select("threshold", "n_samples", "total",
                      F.when(F.col("n_samples") > 0, F.col("n_correct") / F.col("n_samples")).alias("accuracy"))


def true_class_rank(probs: str, y: str) -> Column:
    """1 + #(p_j > p_y) + #(p_j = p_y and j > y): rank of the true class when ties
    put the higher index first (as an ascending argsort read from the end)."""
    py = F.element_at(F.col(probs), F.col(y).cast("int") + 1)
    idx = F.sequence(F.lit(0), F.size(F.col(probs)) - 1)
    higher = F.filter(idx, lambda j: (F.element_at(F.col(probs), j + 1) > py)
                      | ((F.element_at(F.col(probs), j + 1) == py) & (j > F.col(y))))
    return 1 + F.size(higher)


def topk_accuracy(df: DataFrame, kmax: int = 5, probs: str = "probs", y: str = "y_true") -> DataFrame:
    """For k = 1..kmax, percentage of rows whose true class is among the k most probable."""
    r = df.withColumn("_nf_rank", true_class_rank(probs, y))
    wide = r.agg(*[(F.avg((F.col("_nf_rank") <= k).cast("double")) * 100).alias(f"a{k}") for k in range(1, kmax + 1)])
    wide = wide.select(*[F.lit(k).alias(f"k{k}") for k in range(1, kmax + 1)],
                       *[F.col(f"a{k}") for k in range(1, kmax + 1)])
    return _stack(wide, kmax, [(f"k{k}", f"a{k}") for k in range(1, kmax + 1)], ["k", "accuracy"])


def outcome(y: str = "y_true", yhat: str = "y_pred", positive=1) -> Column:
    """TP / TN / FP / FN of one row.  A null prediction is a wrong one: FN of a positive
    row, FP of any other; a null label is no positive, and its row is never right."""
    hit, p = F.col(y) == F.col(yhat), F.col(yhat) == positive
    lost = F.col(yhat).isNull() & ~F.coalesce(F.col(y) == positive, F.lit(False))
    return F.when(hit & p, "TP").when(hit, "TN").when(p | lost, "FP").otherwise("FN")


OUTCOMES = ["TP", "FN", "FP", "TN"]


def outcomes_by_scheme(df: DataFrame, text_col: str = "text", y: str = "y_true", yhat: str = "y_pred") -> DataFrame:
    """Counts of TP/FN/FP/TN per scheme (text before '[SEP]'), zeros filled."""
    s = df.withColumn("scheme", scheme_of_text(text_col, strip=False)).withColumn("outcome", outcome(y, yhat))
    p = s.groupBy("scheme").pivot("outcome", OUTCOMES).agg(F.count(F.lit(1)))
    p = p.fillna(0, subset=OUTCOMES)
    return p.select("scheme", *[F.col(o).cast("long").alias(n) for o, n in
                                zip(OUTCOMES, ["true_pos", "false_neg", "false_pos", "true_neg"])])


def correct_vs_missed(df: DataFrame, text_col: str = "text", y: str = "y_true", yhat: str = "y_pred") -> DataFrame:
    """The TP vs FN table behind the bar chart."""
    return outcomes_by_scheme(df, text_col, y, yhat).select("scheme", "true_pos", "false_neg")


def scheme_drilldown(df: DataFrame, scheme, k: int, key: str, text_col: str = "text",
                     y: str = "y_true", yhat: str = "y_pred", seed: int = 0) -> DataFrame:
    """For one scheme - a name (compared stripped) or a position in the
    name-sorted outcome table (E10) - TP and FN counts and k drawn examples of each."""
    from .sampling import examples_per_outcome
    if isinstance(scheme, int):
        names = (outcomes_by_scheme(df, text_col, y, yhat).select(F.trim("scheme").alias("s"))
                 .orderBy("s").offset(scheme).limit(1).collect())
        if not names:
            raise IndexError(f"no scheme at position {scheme}")
        scheme = names[0]["s"]
    # the scheme's rows are counted, ranked and read: stage them once
    s = staged(df.withColumn("scheme", F.trim(scheme_of_text(text_col, strip=False)))
                 .filter(F.col("scheme") == scheme.strip())
                 .withColumn("outcome", outcome(y, yhat)).filter(F.col("outcome").isin("TP", "FN")))
    counts = s.groupBy("outcome").agg(F.count(F.lit(1)).alias("n_outcome"))
    ex = examples_per_outcome(s, k, key, "outcome", seed, reread=True)
    return ex.join(counts, "outcome")


def training_log_pivot(df: DataFrame, seq: str = "seq", tag: str = "tag", value: str = "value") -> DataFrame:
    """Training-log scalars -> aligned metric series.

    Tags map to metric names; the first train-loss and learning-rate points are
    dropped; the epoch series is thinned to positions 1, 3, 5, ... before the
    last two.  Output: one row per position ``i`` with one column per metric.
    """
    spark = df.sparkSession
    tags = values_df(spark, list(LOG_TAGS.items()), "tag string, metric string")
    m = df.join(bounded_broadcast(tags), tag).select(seq, "metric", value)
    r = rank_within(m, ["metric"], [seq], "_nf_p").withColumn("_nf_p", F.col("_nf_p") - 1)
    n = r.groupBy("metric").agg(F.count(F.lit(1)).alias("_nf_n"))
    r = r.join(bounded_broadcast(n), "metric")
    p, cnt, met = F.col("_nf_p"), F.col("_nf_n"), F.col("metric")
    keep = (F.when(met == "epochs", (p >= 1) & (p < cnt - 2) & ((p - 1) % 2 == 0))
             .when(met.isin("train_loss", "lr"), p >= 1).otherwise(F.lit(True)))
    idx = (F.when(met == "epochs", ((p - 1) / 2).cast("long"))
            .when(met.isin("train_loss", "lr"), p - 1).otherwise(p))
    long = r.filter(keep).select(idx.alias("i"), "metric", F.col(value))
    names = list(dict.fromkeys(LOG_TAGS.values()))
    return long.groupBy("i").pivot("metric", names).agg(F.first(value))


def new_class_metrics(df: DataFrame, cls, y: str = "y_true", yhat: str = "y_pred") -> DataFrame:
    """On the rows of one class: y_true = 1, y_pred = (prediction == class) -> E1."""
    rows = df.filter(F.col(y) == F.lit(cls)).select(
        F.lit(1).alias("_nf_t"), (F.col(yhat) == F.lit(cls)).cast("int").alias("_nf_p"))
    return macro_metrics(rows, "_nf_t", "_nf_p")


def metric_series(df: DataFrame, x: str = "n", keys=("acc", "f1", "precision", "recall"),
                  scope_col: str | None = "scope") -> DataFrame:
    """The metric series over ``x`` (one row per point, per scope)."""
    cols = ([scope_col] if scope_col and scope_col in df.columns else []) + [x, *keys]
    return df.select(*cols)


def precision_at_k(test: DataFrame, classes: DataFrame, scores: DataFrame, id_col: str, class_col: str,
                   k: int = 3) -> DataFrame:
    """Share (x100) of test rows whose own class is among the ``k`` best-scored
    training classes (score descending, class name ascending).

    ``scores`` holds ``(id, class, score)`` for scored pairs (a scorer hook, e.g.
    :func:`noteflow.operators.features.centroid_scores`); missing pairs score 0.
    No row x class pairs are built: a row's rank is one plus the scored pairs that beat
    its own, plus, when its own score is 0 or less, the unscored classes that do (all of
    them below 0; at 0 those with smaller names: the names before its own less the scored
    ones among them).  A class absent from training can never hit.
    """
    names = dim_rank(classes.select(F.col(class_col).alias("_nf_own")).filter(F.col("_nf_own").isNotNull()).distinct(),
                     ["_nf_own"], "_nf_pos")
    n_classes = names.agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    own = test.select(F.col(id_col).alias("_nf_id"), F.col(class_col).alias("_nf_own")).join(names, "_nf_own", "left")
    s = scores.select(F.col(id_col).alias("_nf_sid"), F.col(class_col).alias("_nf_c"), "score") \
              .join(names.select(F.col("_nf_own").alias("_nf_c")), "_nf_c")
    mine = s.select(F.col("_nf_sid").alias("_nf_mid"), F.col("_nf_c").alias("_nf_mc"), F.col("score").alias("_nf_s"))
    own = own.join(mine, (F.col("_nf_id") == F.col("_nf_mid")) & (F.col("_nf_own") == F.col("_nf_mc")), "left") \
             .select("_nf_id", "_nf_own", "_nf_pos", F.coalesce("_nf_s", F.lit(0.0)).alias("_nf_s"))
    before = F.col("_nf_c") < F.col("_nf_own")
    beats = (F.col("score") > F.col("_nf_s")) | ((F.col("score") == F.col("_nf_s")) & before)
    per = (own.join(s, F.col("_nf_id") == F.col("_nf_sid"), "left").groupBy("_nf_id", "_nf_own", "_nf_pos", "_nf_s")
              .agg(F.coalesce(F.sum(beats.cast("long")), F.lit(0)).alias("_nf_beat"), F.count("_nf_c").alias("_nf_scored"),
                   F.coalesce(F.sum(before.cast("long")), F.lit(0)).alias("_nf_lower")))
    unscored = F.when(F.col("_nf_s") < 0, n_classes - F.col("_nf_scored")) \
                .when(F.col("_nf_s") == 0, F.col("_nf_pos") - 1 - F.col("_nf_lower")).otherwise(0)
    hit = F.coalesce(F.col("_nf_pos").isNotNull() & (F.col("_nf_beat") + unscored < k), F.lit(False)).cast("long")
    return per.agg(F.lit(k).alias("k"), F.count(F.lit(1)).alias("n_rows"), F.sum(hit).alias("hits"),
                   (F.avg(hit) * 100).alias("precision_at_k"))
