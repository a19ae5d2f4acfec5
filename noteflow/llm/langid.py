"""Language identification with language-bitmask n-gram filters (operator 3).

A letter trigram's languages are the bits of one word per filter slot (a bit-sliced
Bloom filter: one probe answers for all languages at once).  Learning counts every
trigram of every labelled text; a language contains a trigram if it occurs there twice
or more and at least ``min_share`` times as often, per trigram, as in the language that
uses it most - so foreign passages inside labelled texts do not blur the filters, at any
corpus size.  A text is scored by the popcount of each language's bit over all its
trigrams, corrected for the filter's false positives.

Only the trigrams' aggregated bitmasks (at most ``max_slots`` slots) reach the driver.
Null texts and texts without a letter are ``und`` with score 0; a text whose trigrams are
all unknown gets the most frequent label and score 0; without any label to learn from all
texts are ``und``.  Rows with a null id are scored and never learned from; repeated rows
each give a row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .util import crc_mod, durable, table

#: Characters worked on at a time; longer texts are cut (two characters overlap).
BLOCK_CHARS = 1 << 20
#: Languages per filter word (a long without its sign).
WORD_BITS = 63
HASHES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
#: Trigrams a task gathers before it hands them on.
FLUSH = 400_000
_LETTER: list[np.ndarray] = []


def letter_table() -> np.ndarray:
    """code point -> itself if a letter, else a space."""
    if not _LETTER:
        t = np.full(0x110000, 32, np.uint32)
        letters = [i for i in range(0x110000) if chr(i).isalpha()]
        t[letters] = letters
        _LETTER.append(t)
    return _LETTER[0]


def trigrams(texts: list[str]):
    """Yields (trigram codes, row of each): letters in lower case, every other character
    a space, a space before and after each text, trigrams without two spaces in a row."""
    part: list[str] = []
    rows: list[int] = []
    n = 0

    def codes():
        s = "".join(part)
        c = letter_table()[np.frombuffer(s.encode("utf-32-le", "replace"), np.uint32)].astype(np.uint64)
        row = np.repeat(np.array(rows), [len(p) for p in part])
        ok = (row[:-2] == row[2:]) & ((c[:-2] != 32) | (c[1:-1] != 32)) & ((c[1:-1] != 32) | (c[2:] != 32))
        return (c[:-2] | c[1:-1] << np.uint64(21) | c[2:] << np.uint64(42))[ok], row[:-2][ok]

    for i, t in enumerate(texts):
        t = " " + t.lower() + " "
        for a in range(0, max(1, len(t) - 2), BLOCK_CHARS):
            piece = t[a:a + BLOCK_CHARS + 2]
            if n and (n + len(piece) > BLOCK_CHARS or rows[-1] == i):   # pieces of one text stay apart
                yield codes()
                part, rows, n = [], [], 0
            part.append(piece)
            rows.append(i)
            n += len(piece)
    if n:
        yield codes()


def count_trigrams(batches):
    """Arrow batches (_text, _lang) to (lang, gram, n), summed within the task."""
    held: dict[str, list] = {}
    size = 0

    def merge():
        for lang, parts in held.items():
            g, inv = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            held[lang] = [(g, np.bincount(inv, np.concatenate([p[1] for p in parts]), len(g)).astype(np.int64))]
        return sum(len(p[0][0]) for p in held.values())

    def out():
        for lang, parts in held.items():
            for g, n in parts:
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(g)), pa.array(g.astype(np.int64)), pa.array(n)],
                                                 names=["lang", "gram", "n"])
        held.clear()

    for batch in batches:
        texts, langs = batch.column(0).to_pylist(), np.array(batch.column(1).to_pylist(), object)
        for lang in dict.fromkeys(langs.tolist()):
            for g, _ in trigrams([t for t, x in zip(texts, langs) if x == lang]):
                u, n = np.unique(g, return_counts=True)
                held.setdefault(lang, []).append((u, n))
                size += len(u)
        if size > FLUSH and (size := merge()) > FLUSH:
            yield from out()
            size = 0
    merge()
    yield from out()


def slots(gram: np.ndarray, bits: int) -> list[np.ndarray]:
    return [((gram ^ gram >> np.uint64(29)) * np.uint64(h) >> np.uint64(64 - bits)).astype(np.int64) for h in HASHES]


def fit_filters(labelled: DataFrame, text_col: str, lang_col: str, min_share: float = 0.1, min_count: int = 2,
                max_slots: int = 1 << 22) -> dict:
    """The filters: languages, most frequent language, slot words and false-positive rates.
    Slots: the power of two from 16 per trigram on, ``max_slots`` at most (the correction
    takes over what a fuller filter answers wrongly)."""
    texts = labelled.select(F.col(text_col).cast("string").alias("_text"), F.col(lang_col).cast("string").alias("_lang")) \
                    .where("_text IS NOT NULL AND _lang IS NOT NULL")
    spark = texts.sparkSession
    langs = [r["_lang"] for r in texts.groupBy("_lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "_lang").collect()]
    model = {"langs": sorted(langs), "default": langs[0] if langs else None, "bits": 0, "words": [], "fp": []}
    if not langs:
        return model
    index = spark.createDataFrame([(x, i // WORD_BITS, i % WORD_BITS) for i, x in enumerate(model["langs"])],
                                  "lang string, word int, bit int")
    counts = texts.mapInArrow(count_trigrams, "lang string, gram long, n long") \
                  .groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    sums = counts.groupBy("lang").agg(F.sum("n").alias("_total"))
    freq = counts.join(sums, "lang").withColumn("_p", F.col("n") / F.col("_total"))
    own = (freq.withColumn("_most", F.max("_p").over(Window.partitionBy("gram")))
               .where((F.col("n") >= min_count) & (F.col("_p") >= min_share * F.col("_most")))
               .join(index, "lang")
               .groupBy("gram", "word").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("mask")))
    own = durable(own)
    grams = own.select("gram").distinct().count()
    bits = max(10, min(max_slots, max(1, 16 * grams)).bit_length() - 1)

    def to_slots(batches):
        for b in batches:
            g, word, mask = (c.to_numpy() for c in b.columns)
            for s in slots(g.astype(np.uint64), bits):
                yield pa.RecordBatch.from_arrays([pa.array(s), pa.array(word), pa.array(mask)], names=["slot", "word", "mask"])

    rows = own.mapInArrow(to_slots, "slot long, word int, mask long").groupBy("slot", "word") \
              .agg(F.expr("bit_or(mask)").alias("mask")).toArrow()
    words = np.zeros(((len(langs) - 1) // WORD_BITS + 1, 1 << bits), np.int64)
    words[rows["word"].to_numpy(), rows["slot"].to_numpy()] = rows["mask"].to_numpy()
    fill = [np.count_nonzero(words[i // WORD_BITS] >> (i % WORD_BITS) & 1) / (1 << bits) for i in range(len(langs))]
    return model | {"bits": bits, "words": list(words), "fp": [f ** len(HASHES) for f in fill]}


def popcounts(texts: list[str], model: dict) -> tuple[np.ndarray, np.ndarray]:
    """Per text: trigrams, and how many of them each language contains."""
    n, hits = np.zeros(len(texts)), np.zeros((len(texts), len(model["langs"])))
    for g, row in trigrams(texts):
        n += np.bincount(row, minlength=len(texts))
        at = slots(g, model["bits"])
        for w, word in enumerate(model["words"]):
            mask = word[at[0]]
            for s in at[1:]:
                mask &= word[s]
            for i in range(w * WORD_BITS, min(len(model["langs"]), (w + 1) * WORD_BITS)):
                hits[:, i] += np.bincount(row, mask >> (i % WORD_BITS) & 1, len(texts))
    return n, hits


def identify(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)   # at most max_slots words

    def predict(batches):
        m = shared.value
        fp = np.array(m["fp"])
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            has_letter = b.column(2).to_numpy(zero_copy_only=False)
            pred, score = ["und"] * len(texts), [0.0] * len(texts)
            if m["langs"] and texts:
                n, hits = popcounts(texts, m)
                right = np.clip((hits / np.maximum(n, 1)[:, None] - fp) / np.maximum(1e-9, 1 - fp), 0, 1)
                best, total = right.argmax(1), right.sum(1)
                for i in np.flatnonzero(has_letter).tolist():
                    pred[i] = m["langs"][best[i]] if total[i] else m["default"]
                    score[i] = float(right[i, best[i]] / total[i]) if total[i] else 0.0
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(pred), pa.array(score, pa.float64())],
                                             names=["doc_id", "lang_pred", "score"])

    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("_id"), text.alias("_text"),
                       F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("_has")) \
               .mapInArrow(predict, "doc_id long, lang_pred string, score double")


def op3_language_bitmask(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_filters(docs.where(crc_mod("doc_id", 5) != 0), "text", "lang")
    return identify(docs, model).select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")
