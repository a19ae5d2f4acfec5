"""Features (F1-F5): TF-IDF with smooth idf and L2 norm, mean pooling, batch encoders.

TF-IDF plan
-----------
* fit: every row counts its own terms (:func:`term_counts`: sorted tokens, runs of equal
  ones), one explode of (term, count) per distinct token and one ``groupBy(term)`` for corpus
  counts and document frequencies.  The aggregate combines map-side, so a term present in every document costs one row per input
  partition, not one per document.  ``max_features`` cuts by corpus count
  descending, ties alphabetically; term ids are alphabetical, idf is
  ``ln((1+n)/(1+df)) + 1``.
* transform, vector form (vocabularies that ``max_features`` bounds): a
  ``CountVectorizerModel`` built from the fitted vocabulary counts terms per
  document inside the JVM (no shuffle), an ``ElementwiseProduct`` applies idf and a
  ``Normalizer`` the L2 norm - all document-local, sparse.
* transform, long form ``(id, term, term_id, weight)``, for SQL-checkable output and
  for the sparse dot products of the centroid scorer: a bounded vocabulary explodes
  those vectors; any other stays a table on shared storage that (document, term)
  counts, made in the rows themselves and so without a shuffle, are joined with.  Terms in more than ``FREQUENT`` of the documents are split
  off and broadcast (their number is bounded by the mean number of distinct terms
  per document over ``FREQUENT``, whatever the corpus), so no join key holds more than
  that share of the documents; norms are summed per document.  Nothing is collected.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import tokenize
from ..session import staged
from .order import KeyOrder, dim_rank


def analyzer_tokens(text_col, stopwords=None):
    """Tokens as the vectorizer sees them: T9 words of at least two characters."""
    toks = tokenize(text_col) if stopwords is None else tokenize(text_col, stopwords)
    return F.filter(toks, lambda t: F.char_length(t) >= 2)


#: Share of the documents from which a term is looked up by broadcast instead of a shuffle.
FREQUENT = 0.01
#: Largest ``max_features`` whose vocabulary is carried in the plan.
VECTOR_TERMS = 1 << 18


def term_counts(tokens) -> Column:
    """The distinct tokens of an array with their numbers, ``array<struct<term, n>>``, counted inside
    the row: sorted, then cut into runs.  Null tokens and null arrays count as none."""
    tokens = F.coalesce(tokens, F.array().cast("array<string>"))

    def runs(s):
        first = F.filter(F.transform(s, lambda t, i: F.when((i == 0) | (t != F.get(s, i - 1)), i)), lambda i: i.isNotNull())
        # one-element arrays name the sorted tokens and the run starts, so that each is made once
        return F.transform(F.array(first), lambda at: F.transform(at, lambda p, k: F.struct(
            F.get(s, p).alias("term"), (F.coalesce(F.get(at, k + 1), F.size(s)) - p).cast("long").alias("n"))))[0]

    return F.transform(F.array(F.sort_array(F.array_compact(tokens))), runs)[0]


def counted_rows(df: DataFrame, id_col: str, tokens_col: str) -> DataFrame:
    """Ids, counted terms (in ``tokens_col``) and row numbers, staged: what a fit and the weights of an unbounded
    vocabulary read, made once for both."""
    return staged(df.select(id_col, term_counts(F.col(tokens_col)).alias(tokens_col)).withColumn("_nf_row", F.monotonically_increasing_id()))


def _counted(df: DataFrame, col: str) -> Column:
    """Counted terms of a column of tokens, or of :func:`term_counts` that the caller has made already."""
    return F.col(col) if dict(df.dtypes)[col].startswith("array<struct<") else term_counts(F.col(col))


class TfidfModel:
    """A fitted vocabulary: DataFrame ``(term, term_id, df, idf)`` plus the document count;
    ``bounded`` if ``max_features`` holds it to what a plan can carry."""

    def __init__(self, vocab: DataFrame, n_docs: int, tokens_col: str, bounded: bool = True):
        self.vocab, self.n_docs, self.tokens_col, self.bounded = vocab, n_docs, tokens_col, bounded
        self._terms = None

    def terms(self) -> list[tuple[str, float]]:
        """(term, idf) in term-id order, collected once: the vector form's dictionary."""
        if not self.bounded:
            raise ValueError("vectors need a vocabulary bounded by max_features; use tfidf_weights or tfidf_sparse")
        if self._terms is None:
            self._terms = [(r["term"], r["idf"]) for r in self.vocab.orderBy("term_id").collect()]
        return self._terms


def tfidf_fit(df: DataFrame, tokens_col: str, min_df: float = 1, max_df: float = 1.0,
              max_features: int | None = None) -> TfidfModel:
    """F1 fit.  ``min_df``/``max_df``: int = document count, float = share of documents.
    The vocabulary may have any size; ``max_features`` keeps the terms with the largest
    corpus counts (ties alphabetically).  The column holds tokens or, for vocabularies of any size,
    their :func:`term_counts`."""
    n = df.count()
    # corpus and document counts from one explode and one shuffle
    v = (df.select(F.explode_outer(_counted(df, tokens_col)).alias("x")).filter(F.col("x").isNotNull())
           .groupBy("x.term").agg(F.sum("x.n").alias("cf"), F.count(F.lit(1)).alias("df")))
    lo = min_df if isinstance(min_df, int) else min_df * n
    hi = max_df if isinstance(max_df, int) else max_df * n
    v = staged(v.filter((F.col("df") >= lo) & (F.col("df") <= hi)).withColumn("_nf_neg", -F.col("cf")))
    if max_features is not None:
        by = ["_nf_neg", "term"]
        v = KeyOrder(v, by).flag(v, by, max_features, False, "_nf_in").filter("_nf_in").drop("_nf_in")
    v = dim_rank(v.select("term", "df"), ["term"], "term_id").withColumn("term_id", (F.col("term_id") - 1).cast("int"))
    vocab = staged(v.withColumn("idf", F.log((F.lit(1.0) + n) / (F.lit(1.0) + F.col("df"))) + 1.0))
    return TfidfModel(vocab, n, tokens_col, max_features is not None and max_features <= VECTOR_TERMS)


def tfidf_transform(df: DataFrame, model: TfidfModel, tokens_col: str | None = None,
                    out: str = "tfidf") -> DataFrame:
    """F1/F3 transform to a sparse ``Vector`` column, document-local in the JVM.
    Terms outside the vocabulary are ignored; null tokens count as none."""
    terms = model.terms()
    col = tokens_col or model.tokens_col
    cv = CountVectorizerModel.from_vocabulary([t for t, _ in terms] or ["\u0000"], inputCol="_nf_in",
                                              outputCol="_nf_tf")
    ep = ElementwiseProduct(scalingVec=Vectors.dense([i for _, i in terms] or [0.0]), inputCol="_nf_tf",
                            outputCol="_nf_w")
    nz = Normalizer(p=2.0, inputCol="_nf_w", outputCol=out)
    some = df.withColumn("_nf_in", F.coalesce(F.col(col), F.array().cast("array<string>")))
    return nz.transform(ep.transform(cv.transform(some))).drop("_nf_in", "_nf_tf", "_nf_w")


def tfidf_weights(df: DataFrame, model: TfidfModel, id_col: str, tokens_col: str | None = None) -> DataFrame:
    """F1/F3 transform in long form ``(id, term, term_id, weight)``.

    Bounded vocabulary: the sparse vectors of :func:`tfidf_transform` exploded, so no
    (document, term) row is shuffled; ``term`` joins in by ``term_id``.  Any other: term counts per
    row joined with the vocabulary table.  Rows with the same id are documents of their own."""
    col = tokens_col or model.tokens_col
    if not model.bounded:
        return _weights_by_join(_numbered(df, id_col, col), model).withColumnRenamed("_nf_id", id_col).drop("_nf_row")
    vec = tfidf_transform(df.select(id_col, F.col(col).alias("_nf_toks")), model, "_nf_toks", "_nf_v")
    return vector_weights(vec, model, id_col, "_nf_v")


def vector_weights(df: DataFrame, model: TfidfModel, id_col: str, vec_col: str) -> DataFrame:
    """Sparse vectors of :func:`tfidf_transform` in long form ``(id, term, term_id, weight)``."""
    v = F.unwrap_udt(F.col(vec_col))
    parts = F.transform(v["indices"], lambda t, i: F.struct(t.alias("term_id"), v["values"][i].alias("weight")))
    long = df.select(id_col, F.explode_outer(parts).alias("x")).filter(F.col("x").isNotNull()).select(id_col, "x.*")
    return long.join(model.vocab.select("term", "term_id"), "term_id").select(id_col, "term", "term_id", "weight")


def _numbered(df: DataFrame, id_col: str, col: str) -> DataFrame:
    """Staged (_nf_id, _nf_c, _nf_row): ids, counted terms and a number of the row; :func:`counted_rows` as they are."""
    if "_nf_row" in df.columns:
        return df.select(F.col(id_col).alias("_nf_id"), F.col(col).alias("_nf_c"), "_nf_row")
    return staged(df.select(F.col(id_col).alias("_nf_id"), _counted(df, col).alias("_nf_c")).withColumn("_nf_row", F.monotonically_increasing_id()))


def _weights_by_join(rows: DataFrame, model: TfidfModel) -> DataFrame:
    """Long form (_nf_id, _nf_row, term, term_id, weight) of numbered rows, for a vocabulary of any size."""
    counts = (rows.select("_nf_id", "_nf_row", F.explode_outer("_nf_c").alias("x")).where(F.col("x").isNotNull())
                  .select("_nf_id", "_nf_row", F.col("x.term").alias("_nf_term"), F.col("x.n").alias("_nf_tf")))
    vocab = model.vocab.select("term", "term_id", "df", "idf")
    often = F.col("df") > FREQUENT * model.n_docs
    hit = F.col("_nf_term") == F.col("term")
    near = counts.join(F.broadcast(vocab.where(often)), hit, "left")
    rest = near.where(F.col("term").isNull()).drop("term", "term_id", "df", "idf").join(vocab.where(~often), hit)
    raw = F.col("_nf_tf") * F.col("idf")
    norm = F.sqrt(F.sum(raw * raw).over(Window.partitionBy("_nf_row")))
    return near.where(F.col("term").isNotNull()).unionByName(rest).select("_nf_id", "_nf_row", "term", "term_id", (raw / norm).alias("weight"))


def tfidf_sparse(df: DataFrame, model: TfidfModel, id_col: str, tokens_col: str | None = None, out: str = "features") -> DataFrame:
    """F1 for a vocabulary of any size: one row per row of ``df``, ``(id, features)``, the features a
    struct (type, size, indices, values) that :func:`sources.files.read_vectors` reads as ML vectors;
    a row without a known term has no entries."""
    rows = _numbered(df, id_col, tokens_col or model.tokens_col)
    docs = (_weights_by_join(rows, model).groupBy(F.col("_nf_row").alias("_nf_r"))
            .agg(F.sort_array(F.collect_list(F.struct("term_id", "weight"))).alias("_nf_e")))
    entries = F.coalesce("_nf_e", F.array().cast("array<struct<term_id:int,weight:double>>"))
    size = model.vocab.agg(F.count(F.lit(1)).cast("int").alias("n")).scalar()
    return rows.join(docs, F.col("_nf_row") == F.col("_nf_r"), "left").withColumn("_nf_e", entries).select(
        F.col("_nf_id").alias(id_col), F.struct(F.lit(0).cast("byte").alias("type"), size.alias("size"),
                                                F.transform("_nf_e", lambda e: e["term_id"]).alias("indices"),
                                                F.transform("_nf_e", lambda e: e["weight"]).alias("values")).alias(out))


def tfidf_fit_prefix(df: DataFrame, n: int, order_by, tokens_col: str, **kw) -> TfidfModel:
    """fit on the first ``n`` rows in ``order_by`` order (transform everything after)."""
    from .sorting import head_rows
    return tfidf_fit(head_rows(df, n, order_by), tokens_col, **kw)


def mean_pool(df: DataFrame, group, vec: str, out: str = "mean") -> DataFrame:
    """elementwise mean of the vectors of each group (arrays or ML vectors).

    ``Summarizer.mean`` is one JVM aggregate with map-side partial state of one
    vector per group and partition."""
    v = array_to_vector(F.col(vec)) if dict(df.dtypes)[vec].startswith("array") else F.col(vec)
    return (df.groupBy(*group).agg(Summarizer.mean(v).alias("_nf_m"))
              .withColumn(out, vector_to_array("_nf_m")).drop("_nf_m"))


# ---------------------------------------------------------------- encoders

Encoder = Callable[[pd.Series], np.ndarray]
#: Words whose hash a task of the hashing encoder keeps.
KNOWN_WORDS = 200_000


def hashing_encoder(dim: int = 64, seed: int = 0) -> Callable[[], Encoder]:
    """A deterministic stand-in for a neural sentence encoder: signed feature hashing
    of lower-cased word tokens (``[\\p{L}\\p{N}_]+``) into ``dim`` buckets, L2-normalised.

    Token t goes to bucket ``h mod dim`` with sign ``+1`` if bit 59 of ``h`` is 0,
    where ``h`` is the seeded md5 draw of :mod:`noteflow.functions.hashing`; sums
    and the norm are computed in float64, the result is float32.  Returns a
    factory so the encoder is built once per task."""
    def factory() -> Encoder:
        import hashlib

        import regex
        word = regex.compile(r"[\p{L}\p{N}_]+")
        known: dict[str, tuple[int, float]] = {}      # bucket and sign of the words met by this task

        def place(w: str) -> tuple[int, float]:
            h = int(hashlib.md5(f"{seed}:{w}".encode()).hexdigest()[:15], 16)
            if len(known) >= KNOWN_WORDS:
                known.clear()
            known[w] = at = (h % dim, -1.0 if (h >> 59) & 1 else 1.0)
            return at

        def enc(texts: pd.Series) -> np.ndarray:
            out = np.zeros((len(texts), dim), dtype=np.float64)
            for i, t in enumerate(texts):
                if t is None:
                    continue
                row = [0.0] * dim
                for w in word.findall(t.lower()):
                    j, sign = known.get(w) or place(w)
                    row[j] += sign
                out[i] = row
            norms = np.sqrt((out * out).sum(axis=1, keepdims=True))
            return (out / np.where(norms == 0, 1.0, norms)).astype(np.float32)
        return enc
    return factory


def embed_batches(df: DataFrame, text_col: str, encoder_factory: Callable[[], Encoder] | None = None,
                  out: str = "features", dim: int = 64) -> DataFrame:
    """text -> vector with a pluggable batch encoder (Arrow batches, one encoder
    instance per task via an iterator pandas UDF)."""
    factory = encoder_factory or hashing_encoder(dim)

    @F.pandas_udf("array<float>")
    def _embed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = factory()
        for s in batches:
            m = enc(s)
            yield pd.Series(list(m))

    return df.withColumn(out, _embed(F.col(text_col)))


# ---------------------------------------------------------------- centroid scorer (E8 native scorer)

def class_centroids(weights: DataFrame, labels: DataFrame, id_col: str, class_col: str) -> DataFrame:
    """Mean TF-IDF vector of each class in long form ``(class, term_id, c)``:
    sum of weights over the class's documents / number of its documents."""
    n = labels.groupBy(class_col).agg(F.count(F.lit(1)).alias("_nf_n"))
    s = weights.join(labels.select(id_col, class_col), id_col).groupBy(class_col, "term_id").agg(
        F.sum("weight").alias("_nf_s"))
    return staged(s.join(n, class_col).select(class_col, "term_id", (F.col("_nf_s") / F.col("_nf_n")).alias("c")))


def centroid_scores(weights: DataFrame, centroids: DataFrame, id_col: str, class_col: str) -> DataFrame:
    """Dot product of each document with each class centroid, for pairs that share a
    term: ``(id, class, score)``.  The join is AQE's choice: a small centroid table is
    broadcast, a large one shuffled with hot terms split."""
    return (weights.join(centroids, "term_id").groupBy(id_col, class_col)
                   .agg(F.sum(F.col("weight") * F.col("c")).alias("score")))


def own_class_scores(weights: DataFrame, centroids: DataFrame, id_col: str, own: str, class_col: str) -> DataFrame:
    """Dot product of each document with the centroid of its own class alone: ``(id, score)``;
    ``own`` is an expression for the class, e.g. a field of the id struct."""
    c = centroids.select(F.col(class_col).alias("_nf_cls"), F.col("term_id").alias("_nf_tid"), "c")
    return (weights.join(c, (F.expr(own) == F.col("_nf_cls")) & (F.col("term_id") == F.col("_nf_tid")))
                   .groupBy(id_col).agg(F.sum(F.col("weight") * F.col("c")).alias("score")))
