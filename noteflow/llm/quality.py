"""Quality classifier with hierarchical empirical Bayes over sites (operator 8).

1. Document evidence: a logistic regression over style measures of the whole text and
   hits in a learned list of words and word beginnings that almost only occur in rejected
   documents.  It is fitted on a bounded sample of labelled rows (``sample_rows``, chosen by
   hash; good = quality 1 and toxic 0): the list on one half, the weights on the other.
2. Site evidence, over all documents: grouped sums of the documents' probabilities per
   path and host, shrunk path -> host -> global prior.  The prior strengths come from the
   spread between sites (method of moments), so sparse sites stay near their parent.
3. Posterior: the document's log odds plus those of its site relative to the prior.

Only the sample's features, the list (``max_terms`` entries) and a few moments reach the
driver; sites are aggregated map-side first, so a host with a third of all rows is one
row per task before it is shuffled, and the site table is joined back by key.

A null or empty text has no evidence of its own (its probability is the prior); a null
host or path is a site of its own; rows with null ids are scored too; repeated rows each
give a row; without labels of both kinds every document's evidence is the prior.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .util import durable, table

TOKEN = re.compile(r"\w+")
MARKS = re.compile(r"[^\w\s.,;:'\"()?¿¡-]")
DIGITS = re.compile(r"\d")
#: Letters of a word's beginning that count as a term of their own (marked by "^").
STEM = 4
FEATURES = 11


def terms_of(text: str) -> set[str]:
    words = set(TOKEN.findall(text.lower()))
    return words | {"^" + w[:STEM] for w in words if len(w) > STEM}


def measures(text: str, bad_terms: set[str]) -> list[float]:
    """Style of a whole text and its hits in the learned list."""
    words = text.split()
    n = max(1, len(words))
    lines = [x for x in text.split("\n") if x.strip()]
    low = list(map(str.lower, words))
    kinds = set(low)
    hits = len(terms_of(text) & bad_terms)
    return [
        sum(len(w) > 1 and w.isupper() for w in words) / n,
        len(MARKS.findall(text)) / n,
        len(kinds) / n,
        math.log(n),
        sum(map(len, words)) / n,
        text.count("|") / n,
        len(DIGITS.findall(text)) / n,
        1 - len(set(lines)) / max(1, len(lines)),
        min(hits, 3) / 3,
        math.log1p(hits),
        (text.count("!") + text.count("?")) / n,
    ]


def count_terms(batches):
    """(_text, _good) to (term, good, bad) sums, flushed when the task holds many."""
    held: dict[str, list[int]] = {}

    def out():
        yield pa.RecordBatch.from_arrays(
            [pa.array(held), pa.array([v[0] for v in held.values()], pa.int64()), pa.array([v[1] for v in held.values()], pa.int64())],
            names=["term", "good", "bad"])
        held.clear()

    for batch in batches:
        for text, good in zip(*(c.to_pylist() for c in batch.columns)):
            for t in terms_of(text):
                held.setdefault(t, [0, 0])[0 if good else 1] += 1
            if len(held) > 300_000:
                yield from out()
    yield from out()


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> dict:
    """Newton steps with a ridge penalty on standardised features."""
    mean, dev = x.mean(0), x.std(0) + 1e-9
    a = np.c_[np.ones(len(x)), (x - mean) / dev]
    w, penalty = np.zeros(a.shape[1]), ridge * np.r_[0, np.ones(x.shape[1])]
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + np.diag(penalty + 1e-9), a.T @ (y - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return {"mean": mean, "dev": dev, "w": w}


def fit_classifier(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   quality_col: str = "quality", toxic_col: str = "toxic", sample_rows: int = 20_000,
                   max_terms: int = 20_000, min_bad: int = 8, min_share: float = 0.97) -> dict:
    """Fit on at most about ``sample_rows`` labelled documents with different texts."""
    spark = docs.sparkSession
    known = labels.where(F.col(id_col).isNotNull() & F.col(quality_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("_k")) \
                  .agg(F.min((F.col(quality_col) == 1) & (F.coalesce(F.col(toxic_col), F.lit(0)) == 0)).alias("_good"))
    total = known.count()
    if total > sample_rows:
        known = known.where(F.pmod(F.xxhash64("_k"), F.lit(total)) < sample_rows)
    # the sample is bounded by sample_rows
    rows = durable(docs.select(F.col(id_col).cast("long").alias("_k"), F.col(text_col).cast("string").alias("_text"))
                       .where("_text IS NOT NULL AND trim(_text) <> ''")
                       .join(F.broadcast(known), "_k").dropDuplicates(["_text"])
                       .select("_text", "_good", (F.pmod(F.xxhash64("_text", F.lit(1)), F.lit(2)) == 0).alias("_listing")))
    support = F.col("bad") / (F.col("good") + F.col("bad"))
    listed = (rows.where("_listing").select("_text", "_good").mapInArrow(count_terms, "term string, good long, bad long")
                  .groupBy("term").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
                  .where((F.col("bad") >= min_bad) & (support >= min_share))
                  .orderBy(F.desc("bad"), "term").limit(max_terms).select("term").toArrow()["term"].to_pylist())
    terms = spark.sparkContext.broadcast(frozenset(listed))

    def features(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array([measures(t, terms.value) for t in b.column(0).to_pylist()], pa.list_(pa.float64())), b.column(1)],
                names=["x", "good"])

    got = rows.where("NOT _listing").select("_text", "_good").mapInArrow(features, "x array<double>, good boolean").toArrow()
    y = got["good"].to_numpy().astype(float)
    prior = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
    if not 0 < y.sum() < len(y):
        return {"terms": frozenset(listed), "prior": prior, "logit": None}
    return {"terms": frozenset(listed), "prior": prior, "logit": fit_logistic(np.array(got["x"].to_pylist()), y)}


def site_posteriors(scores: DataFrame) -> DataFrame:
    """(_host, _path) with posterior rates, from columns _host, _path, _p."""
    path = durable(scores.groupBy("_host", "_path").agg(F.count(F.lit(1)).alias("_n"), F.sum("_p").alias("_s")))
    host = path.groupBy("_host").agg(F.sum("_n").alias("_hn"), F.sum("_s").alias("_hs"))

    def strength(groups: DataFrame, n: str, s: str, parent) -> tuple[float, float]:
        """Rate and prior strength of a level: between-group variance by moments."""
        r = groups.agg(F.sum(n).alias("n"), F.sum(s).alias("s"), F.count(F.lit(1)).alias("k"),
                       F.sum(F.col(n) * F.pow(F.col(s) / F.col(n) - parent, 2)).alias("ss"),
                       F.sum(F.pow(F.col(n), 2)).alias("n2")).first()
        if not r["n"]:
            return 0.5, 10.0
        rate = min(max(r["s"] / r["n"], 1e-3), 1 - 1e-3)
        within = rate * (1 - rate)
        spread = (r["ss"] - r["k"] * within) / max(1.0, r["n"] - r["n2"] / r["n"])
        return rate, min(max(within / max(spread, 1e-9) - 1, 1.0), 1e4)

    total = host.agg(F.sum("_hn").alias("n"), F.sum("_hs").alias("s")).first()
    base = min(max((total["s"] or 0) / (total["n"] or 1), 1e-3), 1 - 1e-3)
    _, k_host = strength(host, "_hn", "_hs", F.lit(base))
    host = host.withColumn("_host_rate", (F.col("_hs") + k_host * base) / (F.col("_hn") + k_host))
    both = path.join(host, path["_host"].eqNullSafe(host["_host"])).drop(host["_host"])
    _, k_path = strength(both, "_n", "_s", F.col("_host_rate"))
    return both.select("_host", "_path", "_host_rate", F.lit(base).alias("_base"),
                       ((F.col("_s") + k_path * F.col("_host_rate")) / (F.col("_n") + k_path)).alias("_path_rate"))


def classify(docs: DataFrame, model: dict, host_col: str = "source", path_col: str = "lang", id_col: str = "doc_id",
             text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """Per row: doc_id, doc_score (classifier), host_rate, path_rate, score, kept."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def evidence(batches):
        m = shared.value
        for b in batches:
            p = np.full(b.num_rows, m["prior"])
            texts = b.column(3).to_pylist()
            at = [i for i, t in enumerate(texts) if t and t.strip()]
            if m["logit"] and at:
                g = m["logit"]
                x = (np.array([measures(texts[i], m["terms"]) for i in at]) - g["mean"]) / g["dev"]
                p[at] = 1 / (1 + np.exp(-np.clip(g["w"][0] + x @ g["w"][1:], -20, 20)))
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(p)], names=["doc_id", "_host", "_path", "_p"])

    scores = durable(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(host_col).cast("string").alias("_host"),
                                 F.col(path_col).cast("string").alias("_path"), F.col(text_col).cast("string").alias("_text"))
                         .mapInArrow(evidence, "doc_id long, _host string, _path string, _p double"))
    sites = site_posteriors(scores).select(F.col("_host").alias("_sh"), F.col("_path").alias("_sp"), "_host_rate", "_path_rate", "_base")
    odds = lambda c: F.log(c / (1 - c))
    z = odds(F.col("_p")) + odds(F.col("_path_rate")) - odds(F.col("_base"))
    return (scores.join(sites, scores["_host"].eqNullSafe(F.col("_sh")) & scores["_path"].eqNullSafe(F.col("_sp")))
                  .select("doc_id", F.col("_p").alias("doc_score"), F.col("_host_rate").alias("host_rate"),
                          F.col("_path_rate").alias("path_rate"), (1 / (1 + F.exp(-z))).alias("score"))
                  .withColumn("kept", F.col("score") >= threshold))


def op8_hierarchical_quality(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return classify(docs, fit_classifier(docs, table(spark, sf_dir, "labels")))
