"""Best-fit packing of tokenised documents into fixed-length sequences (operator 5).

Documents are tokenised inside Arrow batches; only the number of pieces of each length
(at most ``max_tokens`` numbers) reaches the driver, where best-fit decreasing runs over
counts: a segment tree over remaining capacities finds the tightest open bin in
O(log max_tokens), and all pieces of one length that go to bins of one capacity move in
one step.  The plan's size depends on ``max_tokens`` alone, never on the rows; pieces
then look up their bin by (length, rank among equals).

Null and empty texts are one piece with the end id alone; repeated rows are packed each
on its own; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .util import durable, table

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, _pid int, _nth long"
#: Units kept in a worker's token cache before it is emptied.
CACHE_UNITS = 200_000


class CapacityTree:
    """Segment tree over capacities 1..cap: which of them have an open bin."""

    def __init__(self, cap: int):
        self.base = 1
        while self.base <= cap:
            self.base *= 2
        self.open = [False] * (2 * self.base)

    def put(self, r: int, is_open: bool) -> None:
        i = self.base + r
        self.open[i] = is_open
        while i > 1:
            i //= 2
            self.open[i] = self.open[2 * i] or self.open[2 * i + 1]

    def tightest(self, s: int) -> int | None:
        """Smallest capacity >= s with an open bin."""
        i = self.base + s
        if self.open[i]:
            return s
        while i > 1:
            if i % 2 == 0 and self.open[i + 1]:
                i += 1
                while i < self.base:
                    i = 2 * i if self.open[2 * i] else 2 * i + 1
                return i - self.base
            i //= 2
        return None


def best_fit_plan(counts: dict[int, int], cap: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts of equal lengths.

    Returns steps (length, first rank, pieces, pieces per bin, first bin, offset in the
    bin): within a length, ranks ``first .. first + pieces`` fill consecutive bins.  A
    bin that took a piece is the tightest one for the next equal piece, so bins fill up
    one after the other exactly as they would piece by piece.
    """
    tree, runs, steps, bins = CapacityTree(cap), defaultdict(list), [], 0

    def add(r: int, first: int, n: int) -> None:
        if r and n:
            runs[r].append((first, n))
            tree.put(r, True)

    for s in sorted(counts, reverse=True):
        rank, left = 0, counts[s]
        while left:
            r = tree.tightest(s)
            if r is None:
                r, n = cap, -(-left // (cap // s))
                add(r, bins, n)
                bins += n
            q = r // s
            first, n = runs[r].pop()
            full = min(n, left // q)
            if full:
                steps.append((s, rank, full * q, q, first, cap - r))
                rank, left = rank + full * q, left - full * q
                add(r - q * s, first, full)
                first, n = first + full, n - full
            if n and left and left < q:
                steps.append((s, rank, left, left, first, cap - r))
                add(r - left * s, first, 1)
                rank, left, first, n = rank + left, 0, first + 1, n - 1
            add(r, first, n)
            if not runs[r]:
                tree.put(r, False)
    return steps


class Encoder:
    """Token ids of a byte-level BPE file of the ``tokenizers`` library.

    A pre-token of that scheme never crosses a single space between two other
    characters, so texts are cut there and each distinct unit is encoded once (by
    ``tiktoken`` with the same vocabulary and merge order, checked at load).  Texts with
    other white-space patterns around a cut are encoded whole.

    The file's added tokens (``<|endoftext|>``) are matched in the text as the library does by
    default: earliest first, longest at a place, each one id, and the parts around them are
    encoded as texts of their own.
    """

    def __init__(self, path: str, pattern: str):
        import tiktoken
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model, added = file["model"], file.get("added_tokens") or []
        if any(t.get(k) for t in added for k in ("single_word", "lstrip", "rstrip")):
            raise ValueError(f"{path}: added tokens that depend on the text around them")
        self.added = {t["content"]: t["id"] for t in added if t["content"]}
        self.literals = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        vocab = model["vocab"]
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        char_of = {chr(b): b for b in printable}
        char_of.update({chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(printable))})
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        if any(vocab[a + b] != 256 + i for i, (a, b) in enumerate(pairs)):
            raise ValueError(f"{path}: merge order and ids differ")
        ranks = {bytes(char_of[c] for c in t): i for t, i in vocab.items() if t not in self.added}
        self.bpe = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.newline = vocab[chr(256 + 10)]
        self.cache: dict[str, bytes | None] = {}

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.bpe.encode_ordinary(text), dtype="<u4")

    def learn(self, units: list[str]) -> None:
        """Cache the ids of " " + unit; None where the unit can't stand alone."""
        if len(self.cache) > CACHE_UNITS:
            self.cache.clear()
        plain = []
        for w in units:
            if not w or w != w.strip():
                self.cache[w] = None
            elif "\n" in w:
                self.cache[w] = self.whole(" " + w).tobytes()
            else:
                plain.append(w)
        if plain:  # a lone newline before a space is a token of its own
            ids = self.whole(" " + "\n ".join(plain))
            ends, raw, a = [*np.flatnonzero(ids == self.newline).tolist(), len(ids)], ids.tobytes(), 0
            for w, b in zip(plain, ends, strict=True):
                self.cache[w] = raw[4 * a:4 * b]
                a = b + 1

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text, added tokens included."""
        if not self.added:
            return self.encode_plain(texts)
        hit = pc.match_substring(texts, next(iter(self.added))) if len(self.added) == 1 else \
            pc.match_substring_regex(texts, "|".join(map(re.escape, self.added)))
        cut = {i: self.literals.split(texts[i].as_py()) for i in np.flatnonzero(hit.to_numpy(zero_copy_only=False)).tolist()}
        if not cut:
            return self.encode_plain(texts)
        parts, first = [], []
        for i, text in enumerate(texts.to_pylist()):
            first.append(len(parts))
            parts += cut[i][::2] if i in cut else [text]     # odd places hold the literals
        coded, out = self.encode_plain(pa.array(parts, pa.string())), []
        for i, a in enumerate(first):
            ids = [coded[a]]
            for k, literal in enumerate(cut[i][1::2] if i in cut else ()):
                ids += [np.array([self.added[literal]], "<u4"), coded[a + k + 1]]
            out.append(np.concatenate(ids) if len(ids) > 1 else ids[0])
        return out

    def encode_plain(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text, added tokens taken as ordinary characters."""
        if not len(texts):
            return []
        units = pc.split_pattern(texts, " ")
        coded = units.values.dictionary_encode()
        words = coded.dictionary.to_pylist()
        new = [w for w in words if w not in self.cache]
        if len(self.cache) + len(new) > CACHE_UNITS:
            self.cache.clear()
            new = words
        self.learn(new)
        ids = [self.cache[w] for w in words]
        offsets = units.offsets.to_numpy() - units.offsets[0].as_py()
        code = coded.indices.to_numpy().copy()
        firsts = [words[c] for c in code[offsets[:-1]].tolist()]
        code[offsets[:-1]] = len(words) + np.arange(len(texts))   # the first unit has no space before it
        odd = np.array([x is None for x in ids] + [w != w.strip() for w in firsts])
        heads = [self.whole(w).tobytes() for w in firsts]
        flat = np.frombuffer(b"".join([x or b"" for x in ids] + heads), dtype="<u4")
        size = np.array([len(x or b"") // 4 for x in ids] + [len(x) // 4 for x in heads])
        begin = np.cumsum(size) - size
        n = size[code]
        end = np.cumsum(n)
        out = flat[np.repeat(begin[code] - (end - n), n) + np.arange(end[-1])]
        cut = np.concatenate([[0], end])[offsets]
        bad = np.logical_or.reduceat(odd[code], offsets[:-1])
        return [self.whole(texts[i].as_py()) if bad[i] else out[cut[i]:cut[i + 1]] for i in range(len(texts))]


_ENCODERS: dict[str, Encoder] = {}


def tokenise(batches, tokenizer_path: str, pattern: str, max_tokens: int, end_id: int):
    """Arrow batches (_id, _text) to piece rows; ``_nth`` counts equal lengths within the task."""
    if tokenizer_path not in _ENCODERS:
        _ENCODERS[tokenizer_path] = Encoder(tokenizer_path, pattern)
    encoder, seen, pid = _ENCODERS[tokenizer_path], defaultdict(int), TaskContext.get().partitionId()
    for batch in batches:
        for at in range(0, batch.num_rows, 400):
            b = batch.slice(at, 400)
            rows: list[tuple] = []
            for doc, ids in zip(b.column(0).to_pylist(), encoder.encode(pc.fill_null(b.column(1), "")), strict=True):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                first = len(ids) % max_tokens or max_tokens
                cuts = [0, *range(first, len(ids) + 1, max_tokens)]
                for k, (a, z) in enumerate(zip(cuts, cuts[1:])):
                    rows.append((doc, k, a, z - a, zlib.crc32(ids[a:z].tobytes()), pid, seen[z - a]))
                    seen[z - a] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate(
                    (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()))],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "_pid", "_nth"])


def pack(docs: DataFrame, tokenizer_path: str, pattern: str, max_tokens: int = 1024, end_id: int = 2,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pack every document: one row per piece (doc_id, piece, start, length, ids_crc32,
    sequence_id, offset).  A document is its ids and the end id; only longer ones are cut,
    the first piece taking what is left over."""
    spark = docs.sparkSession
    pieces = durable(docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text"))
                     .mapInArrow(lambda it: tokenise(it, tokenizer_path, pattern, max_tokens, end_id), PIECES))
    dealt = pieces.groupBy("length", "_pid").agg(F.count(F.lit(1)).alias("_n"))
    totals = {r["length"]: r["_n"] for r in dealt.groupBy("length").agg(F.sum("_n").alias("_n")).collect()}
    steps = spark.createDataFrame(best_fit_plan(totals, max_tokens),
                                  "length long, _rank long, _take long, _per long, _bin long, _at long")
    # a length's rows here are one per task that met it, not one per piece
    before = dealt.withColumn("_before", F.sum("_n").over(
        Window.partitionBy("length").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)))
    ranked = (pieces.join(before.select("length", "_pid", F.coalesce("_before", F.lit(0)).alias("_before")),
                          ["length", "_pid"])
                    .withColumn("_r", F.col("_before") + F.col("_nth")))
    k = F.col("_r") - F.col("_rank")
    # the steps are bounded by max_tokens squared, whatever the rows
    return (ranked.join(F.broadcast(steps), "length")
                  .where((k >= 0) & (k < F.col("_take")))
                  .select("doc_id", "piece", "start", "length", "ids_crc32",
                          (F.col("_bin") + F.floor(k / F.col("_per"))).cast("long").alias("sequence_id"),
                          (F.col("_at") + (k % F.col("_per")) * F.col("length")).cast("long").alias("offset")))


def tokenizer_file() -> tuple[str, str]:
    """Path and split pattern of the public byte-level vocabulary."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN


def op5_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), *tokenizer_file())
