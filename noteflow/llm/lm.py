"""Language-model scores from a log-bilinear model with noise-contrastive estimation (operator 7).

Words are runs without ASCII white space, A-Z in lower case; every text ends with an end
token.  All statistics cover all training texts:

* *Counts.*  Cells of documents send the distinct words they hold (64-bit hashes) with
  their training counts to hash buckets; a bucket adds them up and returns every word's
  total to the cells that asked.  No word list ever stands in one place, and a word found
  in every document is one entry per cell.
* *Model.*  The most frequent words, classes of the other words by their last two bytes, and the
  end token are the model's classes.  Counts of neighbouring classes (classes squared, at
  any corpus size) are summed over all training texts; numpy then fits
  ``s(j | i) = q_i C . r_j + b_j`` by noise-contrastive estimation against the classes'
  frequencies, the noise taken in expectation.
* *Scores.*  One matrix product gives every class's normalised log probabilities after every
  class; a token's is that of its class times its share within the class,
  ``(c + 0.1) / (n + 0.1 (v + 1))``, so the probabilities of all known words and one
  unknown per class add up to one.

The driver holds the classes' counts and the model, never more.  Null texts are empty (the
end token alone); a null id is scored and not learned from (``held_out`` null); repeated
rows each count and are scored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .minhash import text_blocks, word_hashes
from .util import crc_mod, durable, parts_for, table, text_bytes

#: Classes: frequent words, classes of other words, the end token.
WORDS, TAILS = 383, 128
CLASSES, END = WORDS + TAILS + 1, WORDS + TAILS
ADD = 0.1
CELL, BUCKET = 4 << 20, 2 << 20
_U = np.uint64


def tail_class(tail: np.ndarray) -> np.ndarray:
    """Class of a word's last two bytes."""
    return ((tail.astype(np.uint64) * _U(0x9E3779B97F4A7C15)) >> _U(48)) % _U(TAILS)


class Words:
    """The words of some texts: hash and tail class of each distinct one, and every token's."""

    def __init__(self, texts: list[bytes | None]):
        h, owner, tails = [], [], []
        for a, block in text_blocks(texts):
            x, o, t = word_hashes(block)
            h.append(x)
            owner.append(o + a)
            tails.append(t)
        h = np.concatenate(h) if h else np.empty(0, np.uint64)
        self.owner = np.concatenate(owner) if owner else np.empty(0, np.int64)
        self.hash, first, self.code = np.unique(h, return_index=True, return_inverse=True)
        self.tail = tail_class((np.concatenate(tails) if tails else np.empty(0, np.int64))[first]).astype(np.uint8)

    def by_bucket(self, buckets: int):
        b = (self.hash >> _U(24)).astype(np.int64) % buckets
        order = np.argsort(b, kind="stable")
        cuts = np.flatnonzero(np.diff(b[order])) + 1
        for at in np.split(order, cuts):
            if len(at):
                yield int(b[at[0]]), at


def send_counts(rows: pa.Table, buckets: int) -> pa.Table:
    words, train = Words(rows["_text"].to_pylist()), np.array(rows["_train"].to_pylist(), bool)
    n = np.bincount(words.code[train[words.owner]], minlength=len(words.hash)).astype("<u4")
    cell, out = rows["_cell"][0].as_py(), []
    for b, at in words.by_bucket(buckets):
        out.append((b, cell, words.hash[at].astype("<u8").tobytes(), n[at].tobytes(), words.tail[at].tobytes()))
    return pa.table([pa.array([r[k] for r in out], t) for k, t in enumerate((pa.int64(), pa.int64(), *[pa.binary()] * 3))],
                    names=["_bucket", "_cell", "_hashes", "_counts", "_tails"])


ANSWER = "_kind int, _cell long, _bucket long, _blob binary, _hash long, _tail int, _c long, _v long"


def add_counts(rows: pa.Table) -> pa.Table:
    """Of a bucket: kind 0 totals for each cell; 1 frequent words; 2 tokens and words per tail class."""
    sent = [np.frombuffer(x, "<u8") for x in rows["_hashes"].to_pylist()]
    value, first, code = np.unique(np.concatenate(sent), return_index=True, return_inverse=True)
    n = np.concatenate([np.frombuffer(x, "<u4") for x in rows["_counts"].to_pylist()])
    tail = np.concatenate([np.frombuffer(x, np.uint8) for x in rows["_tails"].to_pylist()])[first].astype(np.int64)
    c = np.bincount(code, n, len(value)).astype(np.int64)
    wide, out, a = "<u4" if c.max(initial=0) < 1 << 32 else "<u8", [], 0
    bucket = rows["_bucket"][0].as_py()
    for cell, x in zip(rows["_cell"].to_pylist(), sent):
        out.append((0, cell, bucket, c[code[a:a + len(x)]].astype(wide).tobytes(), None, None, None, None))
        a += len(x)
    top = np.argsort(-c, kind="stable")[:WORDS]
    out += [(1, None, None, None, int(value[k].astype(np.int64)), int(tail[k]), int(c[k]), None) for k in top.tolist() if c[k]]
    per_n, per_v = np.bincount(tail, c, TAILS), np.bincount(tail[c > 0], minlength=TAILS)
    out += [(2, None, None, None, None, t, int(per_n[t]), int(per_v[t])) for t in range(TAILS) if per_v[t]]
    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
    return pa.table([pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)],
                    names=[x.split()[0] for x in ANSWER.split(", ")])


class Classes:
    """Which class a word is in, and its share within the class."""

    def __init__(self, top: list[tuple[int, int, int]], tails: dict[int, tuple[int, int]], n_texts: int):
        self.hash = np.sort(np.array([np.int64(h) for h, _, _ in top], np.int64).view(np.uint64))
        self.n, self.v = np.zeros(TAILS), np.zeros(TAILS)
        for t, (n, v) in tails.items():
            self.n[t], self.v[t] = n, v
        self.ends = n_texts
        self.tokens = int(self.n.sum()) + n_texts
        self.words = int(self.v.sum()) + (n_texts > 0)
        for _, t, c in top:
            self.n[t] -= c
            self.v[t] -= 1

    def of(self, words: Words) -> np.ndarray:
        """Class of each distinct word."""
        if not len(self.hash):
            return WORDS + words.tail.astype(np.int64)
        at = np.minimum(np.searchsorted(self.hash, words.hash), len(self.hash) - 1)
        return np.where(self.hash[at] == words.hash, at, WORDS + words.tail.astype(np.int64))

    def share(self, words: Words, cls: np.ndarray, c: np.ndarray) -> np.ndarray:
        """log10 probability of each distinct word within its class."""
        t = words.tail.astype(np.int64)
        return np.where(cls < WORDS, 0.0, np.log10((c + ADD) / (self.n[t] + ADD * (self.v[t] + 1))))


def neighbours(words: Words, cls: np.ndarray, n_texts: int):
    """(class before, class, text) of every token, ends included; texts begin after an end."""
    per = np.bincount(words.owner, minlength=n_texts)
    ends = np.cumsum(per + 1)
    seq = np.full(int(ends[-1]) if n_texts else 0, END)
    inner = np.ones(len(seq), bool)
    inner[ends - 1] = False
    seq[inner] = cls[words.code]
    before = np.concatenate([[END], seq[:-1]]) if len(seq) else seq
    return before, seq, np.repeat(np.arange(n_texts), per + 1)


def count_neighbours(batches, classes: Classes):
    held = np.zeros(CLASSES * CLASSES, np.int64)
    for batch in batches:
        texts = batch.column(0).to_pylist()
        words = Words(texts)
        before, cls, _ = neighbours(words, classes.of(words), len(texts))
        held += np.bincount(before * CLASSES + cls, minlength=len(held))
    at = np.flatnonzero(held)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(held[at])], names=["pair", "n"])


def fit_nce(pairs: np.ndarray, width: int = 32, noise: int = 20, steps: int = 400, rate: float = 0.05) -> np.ndarray:
    """Log-bilinear model of neighbouring classes; returns normalised log10 P(class | class before).

    Full-batch Adam on the noise-contrastive objective: data pairs against ``noise`` draws a
    token from the classes' frequencies, taken in expectation."""
    total = max(1.0, pairs.sum())
    data = pairs / total
    q = (pairs.sum(0) + 0.5) / (total + 0.5 * CLASSES)
    rng = np.random.default_rng(3)
    ctx, out = 0.1 * rng.standard_normal((2, CLASSES, width))
    mix, bias = np.eye(width), np.log(q)
    params = [ctx, out, mix, bias]
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    offset, draws = np.log(noise * q), noise * data.sum(1)[:, None] * q
    for step in range(1, steps + 1):
        h = ctx @ mix
        sig = 1 / (1 + np.exp(-np.clip(h @ out.T + bias - offset, -40, 40)))
        g = data * (1 - sig) - draws * sig               # of the log likelihood by each score
        gh = g @ out
        grads = [gh @ mix.T, g.T @ h, ctx.T @ gh, g.sum(0)]
        lr = rate * (1 - step / (steps + 1))
        for k, (p, d) in enumerate(zip(params, grads)):
            m[k] = 0.9 * m[k] + 0.1 * d
            v[k] = 0.99 * v[k] + 0.01 * d * d
            p += lr * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-10)
    s = ctx @ mix @ out.T + bias
    s -= s.max(1, keepdims=True)
    return (s - np.log(np.exp(s).sum(1, keepdims=True))) / np.log(10)


RESULT = "doc_id long, n_tokens long, n_known long, base_score double, score double"


def score_cell(rows: pa.Table, answers: pa.Table, classes: Classes, table_: np.ndarray, buckets: int) -> pa.Table:
    texts = rows["_text"].to_pylist()
    words = Words(texts)
    c = np.zeros(len(words.hash), np.int64)
    got = dict(zip(answers["_bucket"].to_pylist(), answers["_blob"].to_pylist())) if answers.num_rows else {}
    for b, at in words.by_bucket(buckets):
        c[at] = np.frombuffer(got[b], "<u4" if len(got[b]) == 4 * len(at) else "<u8")
    floor = classes.tokens + ADD * (classes.words + 1)
    cls = classes.of(words)
    n = np.bincount(words.owner, minlength=len(texts)) + 1
    ends = classes.ends
    base = np.bincount(words.owner, np.log10((c + ADD) / floor)[words.code], len(texts)) + np.log10((ends + ADD) / floor)
    known = np.bincount(words.owner, (c > 0)[words.code], len(texts)) + (ends > 0)
    before, seq, text = neighbours(words, cls, len(texts))
    score = np.bincount(text, table_[before, seq], len(texts)) \
        + np.bincount(words.owner, classes.share(words, cls, c)[words.code], len(texts))
    return pa.table({"doc_id": rows["_id"], "n_tokens": pa.array(n, pa.int64()), "n_known": pa.array(known.astype(np.int64)),
                     "base_score": pa.array(base), "score": pa.array(score)})


def score_texts(docs: DataFrame, train, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Learn from the rows where ``train`` holds and score every row: doc_id, n_tokens, n_known,
    train_tokens, base_score, score."""
    spark = docs.sparkSession
    total = text_bytes(docs, text_col)
    n_cells, buckets = parts_for(total, CELL, 12), parts_for(total // 3, BUCKET, 12)
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(train, F.lit(False)).alias("_train"),
                       F.coalesce(F.col(text_col).cast("string").cast("binary"), F.lit(b"")).alias("_text"))
    cells = rows.withColumn("_cell", F.pmod(F.xxhash64("_id"), F.lit(n_cells)))
    answers = durable(cells.groupBy("_cell").applyInArrow(lambda t: send_counts(t, buckets),
                                                          "_bucket long, _cell long, _hashes binary, _counts binary, _tails binary")
                           .groupBy("_bucket").applyInArrow(add_counts, ANSWER))
    top = answers.where("_kind = 1").orderBy(F.desc("_c"), "_hash").limit(WORDS).select("_hash", "_tail", "_c").collect()
    tails = answers.where("_kind = 2").groupBy("_tail").agg(F.sum("_c").alias("c"), F.sum("_v").alias("v")).collect()
    classes = Classes([tuple(r) for r in top], {r["_tail"]: (r["c"], r["v"]) for r in tails}, rows.where("_train").count())
    pairs = np.zeros(CLASSES * CLASSES)
    got = rows.where("_train").select("_text").mapInArrow(lambda it: count_neighbours(it, classes), "pair long, n long") \
              .groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    pairs[got["pair"].to_numpy()] = got["n"].to_numpy()
    model = spark.sparkContext.broadcast((classes, fit_nce(pairs.reshape(CLASSES, CLASSES))))
    returned = answers.where("_kind = 0").select(F.col("_cell").alias("_cell"), F.col("_bucket").alias("_bucket"), F.col("_blob").alias("_blob"))
    scored = cells.groupBy("_cell").cogroup(returned.groupBy("_cell")) \
                  .applyInArrow(lambda a, b: score_cell(a, b, *model.value, buckets), RESULT)
    return scored.withColumn("train_tokens", F.lit(classes.tokens).cast("long"))


def op7_log_bilinear(spark, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"), crc_mod("doc_id", 10) != 0).select(
        "doc_id", (crc_mod("doc_id", 10) == 0).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
