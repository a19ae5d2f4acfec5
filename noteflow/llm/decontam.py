"""Benchmark decontamination by greedy string tiling (operator 10).

Words are lower-cased runs of letters, digits and underscores.  A document and a
benchmark item become a pair if they share a seed of ``min_match`` consecutive words.
For each pair, the longest common runs that overlap no earlier tile are marked again and
again (running Karp-Rabin over word numbers, every hit compared word by word) until none
of ``min_match`` words is left.  The share of the item's words under tiles does not
depend on the order of the passages, so reordered copies are caught too.  A pair counts if
that share reaches ``threshold`` or one tile has ``long_tile`` words: a passage quoted from a
long item is a leak however small its share.

The benchmark is read in blocks of at most about ``BLOCK_WORDS`` words (an item is never
cut), each held by the tasks while they stream over all documents; any size of benchmark
is covered, one pass of the documents per block.  Documents never meet each other, so no
group of them can be hot.

Null and empty texts and items of fewer than ``min_match`` words match nothing; repeated
documents each give their own rows; an item repeated with the same text counts once, and each
distinct text of an id, or of no id (``item_id`` null), is searched.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .util import table

#: Words of benchmark text held by a task at a time.
BLOCK_WORDS = 500_000
WORDS = re.compile(r"\w+")
MATCHES = "doc_id long, item_id long, n_words long, covered long, n_tiles int, longest int, coverage double"
BASE = np.uint64(1_000_003)


def rolling(ids: np.ndarray, n: int) -> np.ndarray:
    """Polynomial hash (mod 2^64) of every ``n`` consecutive word numbers."""
    if len(ids) < n:
        return np.empty(0, np.uint64)
    h = np.zeros(len(ids) - n + 1, np.uint64)
    for i in range(n):
        h = h * BASE + ids[i:len(ids) - n + 1 + i].astype(np.uint64)
    return h


def longest_run(a: np.ndarray, b: np.ndarray, i: int, j: int, used_a: np.ndarray, used_b: np.ndarray) -> int:
    """Length of the common run from a[i], b[j] that touches no marked word."""
    n = min(len(a) - i, len(b) - j)
    stop = (a[i:i + n] != b[j:j + n]) | used_a[i:i + n] | used_b[j:j + n]
    return int(stop.argmax()) if stop.any() else n


def tiles(item: np.ndarray, doc: np.ndarray, min_match: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (start in item, start in document, length), longest first;
    equal lengths by place in the item, then in the document."""
    used_i, used_d, out = np.zeros(len(item), bool), np.zeros(len(doc), bool), []
    hi, hd = rolling(item, min_match), rolling(doc, min_match)
    at: dict[int, list[int]] = {}
    for j in np.flatnonzero(np.isin(hd, hi)).tolist():
        at.setdefault(int(hd[j]), []).append(j)
    seeds = [(i, j) for i, h in enumerate(hi.tolist()) for j in at.get(h, ())]
    while seeds:
        best, found, live = min_match, [], []
        for i, j in seeds:
            n = longest_run(item, doc, i, j, used_i, used_d)
            if n < min_match:
                continue
            live.append((i, j))
            if n > best:
                best, found = n, [(i, j)]
            elif n == best:
                found.append((i, j))
        for i, j in found:
            if not (used_i[i:i + best].any() or used_d[j:j + best].any()):
                used_i[i:i + best] = used_d[j:j + best] = True
                out.append((i, j, best))
        seeds = live
    return out


class Block:
    """A part of the benchmark: word numbers, items and the seed index."""

    def __init__(self, items: list[tuple[int | None, str]], min_match: int):
        self.min_match, self.number = min_match, {}
        self.items: dict[int, tuple[int | None, np.ndarray]] = {}   # by place: ids may repeat or be null
        seeds: list[np.ndarray] = []
        owners: list[np.ndarray] = []
        for k, (item_id, text) in enumerate(items):
            ids = np.array([self.number.setdefault(w, len(self.number) + 1) for w in WORDS.findall(text.lower())], np.int64)
            if len(ids) >= min_match:
                self.items[k] = item_id, ids
                seeds.append(rolling(ids, min_match))
                owners.append(np.full(len(seeds[-1]), k, np.int64))
        h = np.concatenate(seeds) if seeds else np.empty(0, np.uint64)
        order = np.argsort(h, kind="stable")
        self.seeds, self.owners = h[order], (np.concatenate(owners) if owners else np.empty(0, np.int64))[order]

    def pairs(self, doc: np.ndarray) -> list[int]:
        """Places of the items that share a seed with the document."""
        known = np.convolve(doc > 0, np.ones(self.min_match, int), "valid") == self.min_match
        h = rolling(doc, self.min_match)[known]
        lo, hi = np.searchsorted(self.seeds, h), np.searchsorted(self.seeds, h, "right")
        return np.unique(np.concatenate([self.owners[a:b] for a, b in zip(lo, hi) if b > a] or [np.empty(0, np.int64)])).tolist()

    def match(self, doc_id: int, text: str):
        get = self.number.get
        doc = np.array([get(w, 0) for w in WORDS.findall(text.lower())], np.int64)
        if len(doc) < self.min_match:
            return
        for k in self.pairs(doc):
            item_id, item = self.items[k]
            if found := tiles(item, doc, self.min_match):
                n = sum(t[2] for t in found)
                yield doc_id, item_id, len(item), n, len(found), max(t[2] for t in found), n / len(item)


def benchmark_blocks(benchmark: DataFrame, item_col: str, text_col: str, words: int):
    """The benchmark's items, at most about ``words`` words at a time."""
    items = benchmark.select(F.col(item_col).cast("long").alias("_k"), F.col(text_col).cast("string").alias("_t")) \
                     .where("_t IS NOT NULL").distinct()
    total = items.agg(F.sum(F.size(F.split("_t", r"\s+"))).alias("n")).first()["n"] or 0
    n = -(-total // words)
    for b in range(n):
        yield [(r["_k"], r["_t"]) for r in items.where(F.pmod(F.xxhash64("_k", "_t"), F.lit(n)) == b).orderBy("_k", "_t").collect()]


def contamination(docs: DataFrame, benchmark: DataFrame, min_match: int = 5, threshold: float = 0.5,
                  id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", block_words: int = BLOCK_WORDS, long_tile: int = 13) -> DataFrame:
    """Pairs with coverage >= ``threshold`` or a tile of >= ``long_tile`` words: doc_id, item_id, n_words (of the item),
    covered (words under tiles), n_tiles, longest (words of the longest tile), coverage."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_t")).where("_t IS NOT NULL")
    out = None
    for items in benchmark_blocks(benchmark, item_col, item_text_col, block_words):
        def scan(batches, items=items):
            block = Block(items, min_match)
            for batch in batches:
                rows = [r for d, t in zip(*(c.to_pylist() for c in batch.columns)) for r in block.match(d, t) if r[-1] >= threshold or r[-2] >= long_tile]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in rows], t) for i, t in enumerate(
                        (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.float64()))],
                    names=["doc_id", "item_id", "n_words", "covered", "n_tiles", "longest", "coverage"])
        found = texts.mapInArrow(scan, MATCHES)
        out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], MATCHES) if out is None else out


def without_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` less every row whose id matched an item; rows without an id stay."""
    bad = contamination(docs, benchmark, **options).select(F.col("doc_id").alias("_bad")).distinct()
    key = docs[options.get("id_col", "doc_id")].cast("long")
    return docs.join(bad, key == bad["_bad"], "left_anti")


def op10_greedy_tiling(spark, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
