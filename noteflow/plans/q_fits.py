"""Registered queries: fits that share one pass over the rows, each with an SQL oracle that
repeats the fit on few features folded out of the whole embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import models as M
from ..operators import search
from ..session import staged
from ..sources import files as SRC
from . import fixtures as fx
from . import pipelines
from . import sqlsnip as S
from .q_eval import _macro_sql
from .registry import register

# ---------------------------------------------------------------- M5: boosted trees

TREES = dict(n_trees=3, max_depth=2, lr=0.3, gamma=0.1)
WIDTH = 4
CUTS = [-1.0, -0.5, 0.0, 0.5, 1.0]


def _folded_rows(spark, d, k: int, classes: int):
    """(row_id, features of k folded values, label, val): every fifth row is for validation; staged,
    as a fit reads its rows several times."""
    return staged(fx.table(spark, d, "embeddings").select(
        F.col("vec_id").alias("row_id"), fx._folded(k).alias("features"), (F.col("label") % classes).cast("double").alias("label"),
        (F.col("vec_id") % 5 == 4).alias("val")))


def folded_sql(k: int, classes: int) -> str:
    return (f"SELECT vec_id AS row_id, {fx._folded_sql(k)} AS features, CAST(label % {classes} AS INTEGER) AS label, "
            f"vec_id % 5 = 4 AS val FROM embeddings")


def _boosted(rows):
    return M.fit_boosted_trees(rows, validation_col="val", cuts=[CUTS] * WIDTH, **TREES)


def boosting_ctes(rounds: int, depth: int, lr: float, gamma: float, lam: float = 1.0, least: float = 1.0) -> list[str]:
    """Softmax boosting level by level: gradients, histograms, best splits, leaves, margins."""
    ctes = [f"t AS MATERIALIZED ({folded_sql(WIDTH, 4)})",
            f"""x AS MATERIALIZED (SELECT row_id, f - 1 AS f, len(list_filter({CUTS}, lambda c: c <= v)) AS bin
                FROM (SELECT row_id, unnest(features) AS v, generate_subscripts(features, 1) AS f FROM t))""",
            """m0 AS MATERIALIZED (SELECT row_id, label, val, k, CAST(0 AS DOUBLE) AS m
                FROM t, (SELECT unnest(range(max(label) + 1)) AS k FROM t))"""]
    for r in range(rounds):
        ctes += [f"p{r} AS MATERIALIZED (SELECT *, exp(m) / sum(exp(m)) OVER (PARTITION BY row_id) AS p FROM m{r})",
                 f"""n{r}_0 AS MATERIALIZED (SELECT *, CASE WHEN k = label THEN p - 1 ELSE p END AS g, greatest(2 * p * (1 - p), 1e-16) AS h,
                     0 AS node, true AS live FROM p{r})"""]
        for lv in range(depth):
            ctes += [f"""h{r}_{lv} AS MATERIALIZED (SELECT k, node, f, bin, sum(g) AS g, sum(h) AS h FROM n{r}_{lv} JOIN x USING (row_id)
                         WHERE live AND NOT val GROUP BY ALL)""",
                     f"""c{r}_{lv} AS (SELECT k, node, f, bin, sum(g) OVER u AS gl, sum(h) OVER u AS hl, sum(g) OVER w AS gt, sum(h) OVER w AS ht
                         FROM h{r}_{lv} WINDOW u AS (PARTITION BY k, node, f ORDER BY bin), w AS (PARTITION BY k, node, f))""",
                     f"""s{r}_{lv} AS MATERIALIZED (SELECT k, node, f, bin FROM (
                           SELECT *, max(gain) OVER (PARTITION BY k, node) AS top FROM (
                             SELECT *, (gl * gl / (hl + {lam}) + (gt - gl) * (gt - gl) / (ht - hl + {lam}) - gt * gt / (ht + {lam})) / 2 - {gamma} AS gain
                             FROM c{r}_{lv} WHERE hl >= {least} AND ht - hl >= {least}))
                         WHERE gain > 0 AND gain >= top * (1 - 1e-9)
                         QUALIFY row_number() OVER (PARTITION BY k, node ORDER BY f, bin) = 1)""",
                     f"""n{r}_{lv + 1} AS MATERIALIZED (SELECT n.* REPLACE (
                           CASE WHEN s.f IS NULL THEN n.node WHEN x.bin <= s.bin THEN 2 * n.node + 1 ELSE 2 * n.node + 2 END AS node,
                           n.live AND s.f IS NOT NULL AS live)
                         FROM n{r}_{lv} n LEFT JOIN s{r}_{lv} s ON s.k = n.k AND s.node = n.node AND n.live
                         LEFT JOIN x ON x.row_id = n.row_id AND x.f = s.f)"""]
        ctes += [f"v{r} AS (SELECT k, node, -{lr} * sum(g) / (sum(h) + {lam}) AS v FROM n{r}_{depth} WHERE NOT val GROUP BY ALL)",
                 f"""m{r + 1} AS MATERIALIZED (SELECT n.row_id, n.label, n.val, n.k, n.m + v.v AS m
                     FROM n{r}_{depth} n JOIN v{r} v ON v.k = n.k AND v.node = n.node)"""]
    return ctes


def _boosting_sql(body: str) -> str:
    ctes = boosting_ctes(TREES["n_trees"], TREES["max_depth"], TREES["lr"], TREES["gamma"])
    return "WITH " + ",\n".join(ctes) + "\n" + body


_LOSSES = "\nUNION ALL\n".join(
    f"""SELECT {r} AS round, CASE WHEN val THEN 'validation' ELSE 'train' END AS split, round(avg(-ln(p)), 6) AS mlogloss
        FROM (SELECT *, exp(m) / sum(exp(m)) OVER (PARTITION BY row_id) AS p FROM m{r}) WHERE k = label GROUP BY val"""
    for r in range(1, TREES["n_trees"] + 1))

register("fit_boosted_trees", _boosting_sql(_LOSSES))(
    lambda spark, d: _boosted(_folded_rows(spark, d, WIDTH, 4)).history(spark).withColumn("mlogloss", F.round("mlogloss", 6)))

register("predict_boosted_trees", _boosting_sql(f"""
SELECT row_id, CAST(arg_max(k, (p, -k)) AS INTEGER) AS y_pred, round(max(p), 6) AS prob_max
FROM (SELECT *, exp(m) / sum(exp(m)) OVER (PARTITION BY row_id) AS p FROM m{TREES['n_trees']}) WHERE val GROUP BY row_id"""))(
    lambda spark, d: M.predict(_boosted(x := _folded_rows(spark, d, WIDTH, 4)), x.where("val"))
    .select("row_id", "y_pred", F.round("prob_max", 6).alias("prob_max")))

# ---------------------------------------------------------------- closed forms on two folded features

CLASSES = 4


def _pairs(spark, d):
    return _folded_rows(spark, d, 2, CLASSES)


#: (row_id, a, b, label, val), and the folds of every row.
_ROWS = f"t AS MATERIALIZED (SELECT row_id, features[1] AS a, features[2] AS b, label, val FROM ({folded_sql(2, CLASSES)}))"
_FOLDS = f"""folded AS MATERIALIZED (SELECT *, CAST((row_number() OVER (PARTITION BY label ORDER BY {S.draw(42, 'row_id')}, row_id) - 1) % 3 AS INTEGER) AS fold FROM t)"""
#: Training rows per left-out fold.
_BY_FOLD = "train AS (SELECT g.fold AS grp, f.* FROM folded f JOIN (SELECT DISTINCT fold FROM folded) g ON g.fold <> f.fold)"


def linear_ctes(cands: str) -> list[str]:
    """``fits`` (grp, cand, k, wa, wb, w0) of every candidate (cand, model, value, balanced) on ``train``
    (grp, label, a, b): ridge on -1 / +1, or a discriminant by lsqr, eigen or svd, solved by hand for two features."""
    return [
        f"cands AS (SELECT * FROM (VALUES {cands}) AS t(cand, model, value, balanced))",
        """raw AS MATERIALIZED (SELECT grp, label AS k, count(*) AS c, sum(a) AS ca, sum(b) AS cb, sum(a * a) AS caa, sum(a * b) AS cab, sum(b * b) AS cbb
           FROM train GROUP BY grp, label)""",
        """classes AS (SELECT unnest(range((SELECT max(label) + 1 FROM train))) AS k)""",
        """grown AS (SELECT r.*, count(*) OVER (PARTITION BY grp) AS kinds, sum(c) OVER (PARTITION BY grp) AS rows FROM raw r)""",
        """weighed AS MATERIALIZED (SELECT q.cand, q.model, q.value, g.grp, g.k, g.kinds, w * c AS c, w * ca AS ca, w * cb AS cb, w * caa AS caa, w * cab AS cab, w * cbb AS cbb
           FROM (SELECT g.*, q.cand AS qc, CASE WHEN q.balanced THEN rows / (kinds * c) ELSE 1 END AS w FROM grown g, cands q) g JOIN cands q ON q.cand = g.qc)""",
        """sums AS MATERIALIZED (SELECT cand, model, any_value(value) AS value, grp, any_value(kinds) AS kinds, sum(c) AS n, sum(ca) AS sa, sum(cb) AS sb,
             sum(caa) AS saa, sum(cab) AS sab, sum(cbb) AS sbb, sum(caa - ca * ca / c) AS waa, sum(cab - ca * cb / c) AS wab, sum(cbb - cb * cb / c) AS wbb
           FROM weighed GROUP BY cand, model, grp)""",
        """ridges AS (SELECT *, (m2 * xa - m1 * xb) / (m0 * m2 - m1 * m1) AS wa, (m0 * xb - m1 * xa) / (m0 * m2 - m1 * m1) AS wb FROM (
             SELECT s.cand, s.grp, k.k, s.n, s.sa, s.sb, s.saa - s.sa * s.sa / s.n + s.value AS m0, s.sab - s.sa * s.sb / s.n AS m1,
                    s.sbb - s.sb * s.sb / s.n + s.value AS m2, (2 * coalesce(w.c, 0) - s.n) / s.n AS y,
                    2 * coalesce(w.ca, 0) - s.sa - s.sa * (2 * coalesce(w.c, 0) - s.n) / s.n AS xa,
                    2 * coalesce(w.cb, 0) - s.sb - s.sb * (2 * coalesce(w.c, 0) - s.n) / s.n AS xb
             FROM sums s CROSS JOIN classes k LEFT JOIN weighed w ON w.cand = s.cand AND w.grp = s.grp AND w.k = k.k WHERE s.model = 'ridge'))""",
        """discriminants AS (SELECT *, (m2 * ua - m1 * ub) / (m0 * m2 - m1 * m1) AS wa, (m0 * ub - m1 * ua) / (m0 * m2 - m1 * m1) AS wb FROM (
             SELECT s.cand, s.grp, w.k, s.n, w.c, w.ca / w.c AS ua, w.cb / w.c AS ub,
                    ((1 - s.value) * s.waa + s.value * (s.waa + s.wbb) / 2) / m AS m0, (1 - s.value) * s.wab / m AS m1,
                    ((1 - s.value) * s.wbb + s.value * (s.waa + s.wbb) / 2) / m AS m2
             FROM (SELECT *, CASE model WHEN 'svd' THEN n - kinds ELSE n END AS m FROM sums WHERE model <> 'ridge') s JOIN weighed w ON w.cand = s.cand AND w.grp = s.grp))""",
        """fits AS MATERIALIZED (SELECT cand, grp, k, wa, wb, y - (wa * sa + wb * sb) / n AS w0 FROM ridges
           UNION ALL SELECT cand, grp, k, wa, wb, ln(c / n) - (wa * ua + wb * ub) / 2 FROM discriminants)"""]


def _scored(test: str) -> str:
    """``scored``: (cand, grp, row_id, label, y_pred) of the rows ``test`` (grp, row_id, label, a, b)."""
    return f"""scored AS MATERIALIZED (SELECT f.cand, x.grp, x.row_id, any_value(x.label) AS label,
        CAST(arg_max(f.k, (f.w0 + f.wa * x.a + f.wb * x.b, -f.k)) AS INTEGER) AS y_pred
      FROM ({test}) x JOIN fits f ON f.grp = x.grp GROUP BY f.cand, x.grp, x.row_id)"""


def _linear_sql(body: str, cands: str, train: str, test: str, *ctes: str) -> str:
    parts = [_ROWS, *ctes, train, *linear_ctes(cands), _scored(test)]
    return "WITH " + ",\n".join(parts) + "\n" + body


_TRAIN = "train AS (SELECT 0 AS grp, * FROM t WHERE NOT val)"
_TEST = "SELECT 0 AS grp, * FROM t WHERE val"
_HELD = "SELECT fold AS grp, * FROM folded"
_PREDICTED = "SELECT row_id, y_pred FROM scored"
_CV = "SELECT cand, avg(acc) AS cv_accuracy FROM (SELECT cand, grp, avg(CAST(y_pred = label AS INTEGER)) AS acc FROM scored GROUP BY ALL) GROUP BY cand"


def _split(rows):
    return rows.where("NOT val"), rows.where("val")


def _predicted(model, test):
    return M.predict(model, test).select("row_id", "y_pred")


def _ridge_predictions(spark, d):
    train, test = _split(_pairs(spark, d))
    return _predicted(M.fit_ridge(train, alpha=2.0), test)


def _ridge_cg_predictions(spark, d):
    train, test = _split(_pairs(spark, d))
    return _predicted(M.fit_ridge_cg(train, alpha=2.0, class_weight="balanced", tol=1e-12), test)


def _saved_ridge(spark, d):
    train, test = _split(_pairs(spark, d))
    path = SRC.scratch_path(spark, "model-ridge")
    M.fit_ridge(train, alpha=2.0).save(spark, path)
    return _predicted(M.LinearModel.load(spark, path), test)


def _lda_predictions(spark, d):
    train, test = _split(_pairs(spark, d))
    out = None
    for solver, z in (("lsqr", None), ("lsqr", 0.4), ("eigen", 0.4), ("svd", None)):
        p = _predicted(M.fit_lda(train, shrinkage=z, solver=solver), test).withColumn("solver", F.lit(solver)).withColumn("shrinkage", F.lit(z or 0.0))
        out = p if out is None else out.unionByName(p)
    return out


register("predict_ridge", _linear_sql(_PREDICTED, "(0, 'ridge', 2.0, false)", _TRAIN, _TEST))(_ridge_predictions)
register("predict_saved_ridge", _linear_sql(_PREDICTED, "(0, 'ridge', 2.0, false)", _TRAIN, _TEST))(_saved_ridge)
register("predict_ridge_cg", _linear_sql(_PREDICTED, "(0, 'ridge', 2.0, true)", _TRAIN, _TEST))(_ridge_cg_predictions)
register("predict_lda", _linear_sql(
    "SELECT row_id, y_pred, c.model AS solver, CAST(c.value AS DOUBLE) AS shrinkage FROM scored JOIN cands c USING (cand)",
    "(0, 'lsqr', 0.0, false), (1, 'lsqr', 0.4, false), (2, 'eigen', 0.4, false), (3, 'svd', 0.0, false)", _TRAIN, _TEST))(_lda_predictions)


def _rounded(df, *cols):
    return df.withColumns({c: F.round(c, 6) for c in cols})


_RIDGE_GRID = [(a, b) for a in (0.0001, 0.001, 0.01, 0.1, 10.0) for b in (False, True)]
register("ridge_cg_grid", _linear_sql(
    f"""SELECT CAST(c.value AS DOUBLE) AS alpha, CASE WHEN c.balanced THEN 'balanced' ELSE 'none' END AS class_weight, round(v.cv_accuracy, 6) AS cv_accuracy
        FROM ({_CV}) v JOIN cands c USING (cand)""",
    ", ".join(f"({i}, 'ridge', {a}, {str(b).lower()})" for i, (a, b) in enumerate(_RIDGE_GRID)), _BY_FOLD, _HELD, _FOLDS))(
    lambda spark, d: _rounded(M.ridge_cg_grid(_pairs(spark, d), [0.0001, 0.001, 0.01, 0.1, 10.0], [None, "balanced"], tol=1e-12)[1], "cv_accuracy"))

_LDA_GRID = [(m, z) for m in ("svd", "lsqr", "eigen") for z in (0.0, 0.001, 0.02, 0.4, 0.6, 0.8, 1.0) if m != "svd" or z == 0]
register("lda_grid", _linear_sql(
    f"""SELECT c.model AS solver, CASE WHEN c.value = 0 THEN 'none' ELSE CAST(CAST(c.value AS DOUBLE) AS VARCHAR) END AS shrinkage, round(v.cv_accuracy, 6) AS cv_accuracy
        FROM ({_CV}) v JOIN cands c USING (cand)
        UNION ALL SELECT 'svd', CAST(CAST(value AS DOUBLE) AS VARCHAR), NULL FROM cands WHERE model = 'lsqr' AND value > 0""",
    ", ".join(f"({i}, '{m}', {z}, false)" for i, (m, z) in enumerate(_LDA_GRID)), _BY_FOLD, _HELD, _FOLDS))(
    lambda spark, d: _rounded(M.lda_grid_cv(_pairs(spark, d), [None, 0.001, 0.02, 0.4, 0.6, 0.8, 1.0], ["svd", "lsqr", "eigen"]), "cv_accuracy").drop("tol"))

register("ridge_grid_moments", _linear_sql(
    """SELECT CAST(c.value AS DOUBLE) AS alpha, round(v.acc, 6) AS cv_accuracy
       FROM (SELECT cand, avg(CAST(y_pred = label AS INTEGER)) AS acc FROM scored GROUP BY cand) v JOIN cands c USING (cand)""",
    "(0, 'ridge', 0.1, false), (1, 'ridge', 100.0, false)", _BY_FOLD, _HELD, _FOLDS))(
    lambda spark, d: _rounded(M.ridge_grid_cv(_pairs(spark, d), [0.1, 100.0], folds=3), "cv_accuracy"))


def _macro_of(src: str, group: str) -> str:
    return f"SELECT {group}, round(acc, 6) AS acc, round(f1, 6) AS f1, round(precision, 6) AS precision, round(recall, 6) AS recall FROM ({_macro_sql(src, group)}) q"


_METRICS = ("acc", "f1", "precision", "recall")
register("cross_val_ridge", _linear_sql(
    _macro_of("(SELECT grp AS fold, label AS y_true, y_pred FROM scored)", "fold"), "(0, 'ridge', 1.0, false)", _BY_FOLD, _HELD, _FOLDS))(
    lambda spark, d: _rounded(M.cross_val_scores(_pairs(spark, d), lambda t: M.fit_ridge(t, alpha=1.0), k=3), *_METRICS).select("fold", *_METRICS))

register("leaderboard_closed_form", _linear_sql(
    _macro_of("(SELECT c.model AS model, s.label AS y_true, s.y_pred FROM scored s JOIN cands c USING (cand))", "model"),
    "(0, 'ridge', 1.0, false), (1, 'lsqr', 0.0, false)", _TRAIN, _TEST))(
    lambda spark, d: _rounded(M.leaderboard(*_split(_pairs(spark, d)), {"ridge": lambda t: M.fit_ridge(t, alpha=1.0), "lsqr": lambda t: M.fit_lda(t)}),
                              *_METRICS).select("model", *_METRICS))


def _refit(spark, d):
    rows = _pairs(spark, d).withColumn("split", F.when(F.col("row_id") % 5 == 4, "test").when(F.col("row_id") % 5 == 3, "val").otherwise("train"))
    return _predicted(M.refit_full(rows, lambda t: M.fit_ridge(t, alpha=2.0)), rows.where("split = 'test'"))


register("refit_ridge", _linear_sql(_PREDICTED, "(0, 'ridge', 2.0, false)", _TRAIN, _TEST))(_refit)

# ---------------------------------------------------------------- PL5, validate-only: a saved model on every split

def _validate(spark, d):
    rows = _pairs(spark, d)
    path = SRC.scratch_path(spark, "model-lda")
    M.fit_lda(rows.where("NOT val")).save(spark, path)
    out = pipelines.validate_pipeline(M.LinearModel.load(spark, path), rows.select("row_id", "features"), rows.select("row_id", "label"), kmax=3)
    return out.select("section", "split", "x", F.round("value", 6).alias("value"), "n")


register("validate_pipeline", _linear_sql(
    """SELECT 'accuracy' AS section, split, CAST(NULL AS DOUBLE) AS x, round(avg(CAST(y_pred = label AS INTEGER)), 6) AS value, count(*) AS n FROM judged GROUP BY split
       UNION ALL SELECT 'confidence', split, CAST(v.t AS DOUBLE), round(avg(CAST(y_pred = label AS INTEGER)) FILTER (WHERE top > v.t), 6), count(*) FILTER (WHERE top > v.t)
       FROM judged, (VALUES (0.0), (0.1), (0.2), (0.3), (0.4), (0.5), (0.6), (0.7), (0.8), (0.9)) v(t) GROUP BY split, v.t
       UNION ALL SELECT 'topk', split, CAST(k.k AS DOUBLE), round(100 * avg(CAST(place <= k.k AS INTEGER)), 6), NULL FROM judged, range(1, 4) k(k) GROUP BY split, k.k""",
    "(0, 'lsqr', 0.0, false)", _TRAIN, "SELECT 0 AS grp, * FROM t") .replace("\nSELECT 'accuracy'", """,
probs AS (SELECT x.row_id, x.label, f.k, exp(f.w0 + f.wa * x.a + f.wb * x.b) / sum(exp(f.w0 + f.wa * x.a + f.wb * x.b)) OVER (PARTITION BY x.row_id) AS p FROM t x, fits f),
places AS (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY p DESC, k DESC) AS place, max(p) OVER (PARTITION BY row_id) AS top FROM probs),
judged AS (SELECT l.row_id, l.label, l.place, l.top, s.y_pred, CASE WHEN back <= m THEN 'test' WHEN back <= 2 * m THEN 'val' ELSE 'train' END AS split
  FROM places l JOIN scored s USING (row_id) JOIN (SELECT row_id, row_number() OVER (ORDER BY row_id DESC) AS back, CAST(floor(count(*) OVER () * 10 / 100) AS BIGINT) AS m FROM t) b USING (row_id)
  WHERE l.k = l.label)
SELECT 'accuracy'""", 1))(_validate)

# ---------------------------------------------------------------- M11: the curve from prefix sums of moments

CURVE = list(range(0, 100, 5))


def _curve(spark, d):
    train, test = _split(_pairs(spark, d))
    out = search.learning_curve_moments(train.where("label <> 0"), train.where("label = 0"), CURVE, lambda m: M.ridge_from_moments(m, 1.0),
                                        test, 0, ["row_id"])
    return _rounded(out, *_METRICS)


register("learning_curve_moments", _linear_sql(
    f"""SELECT p.n, q.scope, q.acc, q.f1, q.precision, q.recall FROM points p JOIN (
          SELECT 'all' AS scope, * FROM ({_macro_of("(SELECT grp, label AS y_true, y_pred FROM scored)", "grp")})
          UNION ALL SELECT 'new_class', * FROM ({_macro_of("(SELECT grp, 1 AS y_true, CAST(y_pred = 0 AS INTEGER) AS y_pred FROM scored WHERE label = 0)", "grp")})) q
        ON q.grp = p.point""",
    "(0, 'ridge', 1.0, false)", "train AS (SELECT p.point AS grp, o.* EXCLUDE (back) FROM points p JOIN own o ON o.label <> 0 OR o.back <= p.n)",
    "SELECT p.point AS grp, t.* FROM t, points p WHERE t.val",
    "own AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY row_id DESC) AS back FROM t WHERE NOT val)",
    f"""points AS MATERIALIZED (SELECT row_number() OVER (ORDER BY last, n) - 1 AS point, n FROM (
          SELECT DISTINCT CAST(least(i, total) AS INTEGER) AS n, false AS last FROM (SELECT unnest({CURVE}) AS i, (SELECT count(*) FROM own WHERE label = 0) AS total)
          UNION ALL SELECT CAST(count(*) AS INTEGER), true FROM own WHERE label = 0))"""))(_curve)

# ---------------------------------------------------------------- M7: successive halving

SPACE = {"ridge": (1e-4, 1e4), "lda": (0.0, 1.0)}
N_CANDIDATES, RUNG = 9, 64


def _halving(spark, d):
    out = search.successive_halving(_pairs(spark, d), SPACE, n=N_CANDIDATES, rung_rows=(RUNG,))
    return _rounded(out, "value", "accuracy")


register("successive_halving", _linear_sql(
    f"""SELECT CAST(c.cand AS INTEGER) AS candidate, CASE c.model WHEN 'ridge' THEN 'ridge' ELSE 'lda' END AS model, round(CAST(c.value AS DOUBLE), 6) AS value, r.rung,
               CAST(r.n_rows AS BIGINT) AS n_rows, round(r.acc, 6) AS accuracy
        FROM (SELECT *, 0 AS rung FROM first UNION ALL
              SELECT s.cand, avg(CAST(y_pred = label AS INTEGER)), count(*), 1 FROM scored s WHERE s.cand IN (
                SELECT cand FROM first ORDER BY acc DESC, cand LIMIT {max(1, int(N_CANDIDATES / 3))}) GROUP BY s.cand) r JOIN cands c USING (cand)""".replace(
        "FROM first", """FROM (SELECT s.cand, avg(CAST(y_pred = label AS INTEGER)) AS acc, count(*) AS n_rows FROM scored s
            WHERE s.row_id IN (SELECT row_id FROM t ORDER BY {}, row_id LIMIT {}) GROUP BY s.cand)""".format(S.draw(43, "row_id"), RUNG)),
    ", ".join(f"({i}, '{'ridge' if m == 'ridge' else 'lsqr'}', CAST({v!r} AS DOUBLE), false)" for i, (m, v) in enumerate(search._candidates(SPACE, N_CANDIDATES, 42))),
    _BY_FOLD, _HELD, _FOLDS))(_halving)

# ---------------------------------------------------------------- M6: logistic regression, all folds and points in one block (no SQL)

register("logreg_grid")(lambda spark, d: _rounded(M.logreg_grid(_folded_rows(spark, d, 16, 10), [0.01, 0.1, 1.0, 10.0], [None, "balanced"])[1], "cv_accuracy"))
