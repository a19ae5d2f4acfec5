"""Near-duplicate documents by b-bit MinHash (operator 2).

1. Every text's set of word shingles gives ``BANDS * ROWS`` minima in one pass: the bands'
   keys, and the lowest ``B_BITS`` bits of every minimum packed into bit planes.  Texts with
   equal sets become one class first (grouped by a 128-bit digest, aggregated map-side).
2. Documents that share a band key are candidates.  A key held by thousands is never
   expanded into all pairs: each of its documents is compared with one leader per key
   (drawn anew for every key), and only documents of different components found that way
   are then compared with each other, each pair at the least key it shares, so no link is lost.
3. A pair is dropped if a parity sketch of its sets proves too many different shingles (each
   differing bit is one at least), or if its similarity estimated from the packed bits,
   corrected for chance agreement (``(e - 1/2^b) / (1 - 1/2^b)`` of the agreeing share e),
   lies ``SLACK`` (six standard errors) below the threshold.  Both tests are conditions of the
   join, so such a pair is never made.  The rest is confirmed on the full sets, which are
   built for the documents of surviving pairs alone: documents that only share a common
   passage end before any text is read for them.
4. Connected components by contraction (:func:`noteflow.llm.util.components`).

A link of exactly the threshold is missed with probability about 1e-7.  Texts without
words, null texts and null ids are linked with nothing (a null id has a null component and
is kept).  Rows that share an id are one document, represented by its largest set.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .util import components, durable, release, table

ROWS, BANDS, B_BITS = 5, 40, 4
#: Longs of a parity sketch.
SKETCH = 4
N_MIN = ROWS * BANDS
#: Longs of a bit plane (one bit a minimum).
PLANE = -(-N_MIN // 64)
#: Share under the threshold at which an estimate is still confirmed.
SLACK = 0.18
#: Bytes of text hashed at a time (longer texts alone).
BLOCK = 1 << 20
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_RNG = np.random.default_rng(20)
MULTIPLY = (_RNG.integers(0, 1 << 32, N_MIN, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)[:, None]
ADD = _RNG.integers(0, 1 << 32, N_MIN, dtype=np.uint64).astype(np.uint32)[:, None]
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> _U(30)) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ h >> _U(27)) * _U(0x94D049BB133111EB)
    return h ^ h >> _U(31)


def _powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64."""
    p = np.ones(n, np.uint64)
    if n > 1:
        p[1:] = _U(base)
        np.multiply.accumulate(p, out=p)
    return p


_TABLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _tables(n: int):
    size = max(BLOCK, 1 << (n - 1).bit_length())
    if size not in _TABLES:
        _TABLES.clear()
        _TABLES[size] = _powers(_BASE, size), _powers(pow(_BASE, -1, 1 << 64), size)
    return _TABLES[size]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every word of the texts: its hash, the text it is in, and its last two bytes."""
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    space = SPACE[data]
    start = np.flatnonzero(~space & np.append(True, space[:-1]))
    end = np.flatnonzero(space & np.append(False, ~space[:-1]))
    up, down = _tables(len(data))
    total = np.concatenate([[_U(0)], np.cumsum((data + _U(1)) * up[:len(data)], dtype=np.uint64)])
    h = mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))
    ends = np.cumsum([len(t) + 1 for t in texts])
    tail = data[end - 1].astype(np.int64) | np.where(end - start > 1, data[end - 2], 0).astype(np.int64) << 8
    return h, np.searchsorted(ends, start, "right"), tail


def text_blocks(texts: list[bytes | None]):
    """(place of the first, texts in lower case) about ``BLOCK`` bytes at a time."""
    at = 0
    while at < len(texts):
        stop, n = at, 0
        while stop < len(texts) and (stop == at or n + len(texts[stop] or b"") < BLOCK):
            n += len(texts[stop] or b"") + 1
            stop += 1
        yield at, [(t or b"").lower() for t in texts[at:stop]]
        at = stop


def shingle_sets(texts: list[bytes | None], size: int):
    """The sorted distinct shingle hashes of each text."""
    for _, block in text_blocks(texts):
        h, owner, _ = word_hashes(block)
        cuts = np.searchsorted(owner, np.arange(len(block) + 1))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            w = h[a:b]
            k = min(size, len(w))
            if not k:
                yield w
                continue
            s = np.full(len(w) - k + 1, _U(k))
            for i in range(k):
                s = mix(s * _U(0x632BE59BD9B4E019) + w[i:len(w) - k + 1 + i])
            yield np.unique(s)


def minima(s: np.ndarray) -> np.ndarray:
    """``N_MIN`` minima of a non-empty set."""
    x = (s >> _U(32)).astype(np.uint32)
    best = None
    for a in range(0, len(x), 4096):
        m = (x[None, a:a + 4096] * MULTIPLY + ADD).min(1)
        best = m if best is None else np.minimum(best, m)
    return best


def packed(m: np.ndarray) -> np.ndarray:
    """The lowest ``B_BITS`` bits of the minima, a bit plane each."""
    planes = np.zeros((B_BITS, PLANE * 64), bool)
    planes[:, :N_MIN] = m[None, :] >> np.arange(B_BITS, dtype=np.uint32)[:, None] & 1
    return np.packbits(planes, axis=1).reshape(-1).view(np.int64)


def parity(s: np.ndarray) -> np.ndarray:
    """Sketch of a set: per bit, whether an odd number of its members hash there."""
    odd = np.bincount((s >> _U(3)).astype(np.int64) & (64 * SKETCH - 1), minlength=64 * SKETCH) & 1
    return np.packbits(odd.astype(bool)).view(np.int64)


def differing(a, b) -> Column:
    """Shingles in one set only, at least: the differing bits of two sketches."""
    return reduce(lambda x, y: x + y, [F.bit_count(a[i].bitwiseXOR(b[i])) for i in range(SKETCH)])


def possible(na, nb, a, b, percent: int) -> Column:
    """Sizes and sketches allow a similarity of ``percent``: in linked sets at most
    ``(100 - p) / (100 + p)`` of both sizes together lie in one set only."""
    return (100 * F.least(na, nb) >= percent * F.greatest(na, nb)) & \
        ((100 + percent) * differing(a, b) <= (100 - percent) * (na + nb))


def similar(a, b, percent: int) -> Column:
    """The similarity estimated from packed bit planes, corrected for chance agreement, is at
    most ``SLACK`` below ``percent``: so many minima may differ in one of their low bits."""
    chance = 1 / (1 << B_BITS)
    most = N_MIN * (1 - chance) * (1 - (percent / 100 - SLACK))
    planes = [[a[p * PLANE + w].bitwiseXOR(b[p * PLANE + w]) for p in range(B_BITS)] for w in range(PLANE)]
    differ = reduce(lambda x, y: x + y, [F.bit_count(reduce(lambda x, y: x.bitwiseOR(y), word)) for word in planes])
    return differ <= F.lit(most)


def signatures(batches, size: int):
    """(_id, _text) to _id, _n, _sig (digest of the set), _bands, _bits, _parity."""
    for batch in batches:
        rows = []
        for i, s in zip(batch.column(0).to_pylist(), shingle_sets(batch.column(1).to_pylist(), size)):
            if not len(s):
                rows.append((i, 0, None, [], [], []))
                continue
            m = minima(s)
            bands = np.full(BANDS, 0, np.uint64) + np.arange(BANDS, dtype=np.uint64)
            for r in range(ROWS):
                bands = mix(bands * _U(0xC2B2AE3D27D4EB4F) + m.reshape(BANDS, ROWS)[:, r])
            rows.append((i, len(s), xxhash.xxh3_128_digest(s.tobytes()), bands.astype(np.int64), packed(m), parity(s)))
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in rows], t) for k, t in enumerate(
                (pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64())))],
            names=["_id", "_n", "_sig", "_bands", "_bits", "_parity"])


class Corpus:
    """The documents' signatures and what pair tests need."""

    def __init__(self, docs: DataFrame, size: int, percent: int, id_col: str, text_col: str):
        self.percent = percent
        self.texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").cast("binary").alias("_text"))
        self.size = size
        self.signed = durable(self.texts.mapInArrow(lambda it: signatures(it, size),
                                                    "_id long, _n long, _sig binary, _bands array<long>, _bits array<long>, _parity array<long>"))
        sets = self.signed.where("_id IS NOT NULL AND _n > 0").groupBy("_id") \
                   .agg(F.max(F.struct("_n", "_sig")).alias("_s")).select("_id", F.col("_s._sig").alias("_sig"))
        sets = durable(sets)
        self.classes = durable(sets.join(durable(sets.groupBy("_sig").agg(F.min("_id").alias("_rep"))), "_sig"))   # _sig, _id, _rep
        reps = self.classes.where("_id = _rep").select("_id", "_sig")
        self.reps = self.signed.join(reps, ["_id", "_sig"]).dropDuplicates(["_id"])
        keys = self.reps.select("_id", F.explode("_bands").alias("_key"))
        shared = durable(keys.groupBy("_key").agg(F.count(F.lit(1)).alias("_m")).where("_m > 1").select("_key"))
        self.buckets = durable(keys.join(shared, "_key"))      # _key, _id
        # everything below concerns documents with a candidate only
        cand = self.buckets.select("_id").distinct()
        self.bits = durable(self.reps.join(cand, "_id").select("_id", "_n", "_bits", "_parity"))

    def sets(self, pairs: DataFrame) -> DataFrame:
        """(_id, _set) of the documents of ``pairs``; of rows that share an id the largest set."""
        size = self.size

        def run(batches):
            for batch in batches:
                own = [s.astype("<u8").tobytes() for s in shingle_sets(batch.column(1).to_pylist(), size)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([len(s) for s in own], pa.int64()), pa.array([xxhash.xxh3_128_digest(s) for s in own], pa.binary()),
                     pa.array(own, pa.binary())], names=["_id", "_n", "_sig", "_set"])

        ids = pairs.select(F.explode(F.array("_u", "_v")).alias("_id")).distinct()
        return self.texts.join(ids, "_id").mapInArrow(run, "_id long, _n long, _sig binary, _set binary") \
                   .groupBy("_id").agg(F.max(F.struct("_n", "_sig", "_set")).alias("_s")).select("_id", F.col("_s._set").alias("_set"))

    def candidates(self, pairs: DataFrame) -> DataFrame:
        """Pairs (_u, _v) whose sizes, parities and estimate allow a link."""
        one, two = (self.bits.select(*[F.col(c).alias(f"{c}{x}") for c in ("_id", "_n", "_parity", "_bits")]) for x in "uv")
        return pairs.join(one, F.col("_u") == F.col("_idu")).join(two, (F.col("_v") == F.col("_idv")) & self.near("u", "v")).select("_u", "_v")

    def near(self, x: str, y: str) -> Column:
        """A link is possible between the rows whose columns end in ``x`` and in ``y``."""
        return possible(F.col(f"_n{x}"), F.col(f"_n{y}"), F.col(f"_parity{x}"), F.col(f"_parity{y}"), self.percent) & \
            similar(F.col(f"_bits{x}"), F.col(f"_bits{y}"), self.percent)

    def links(self, pairs: DataFrame) -> DataFrame:
        """Confirmed links among ``pairs`` (all their columns, longs), which have passed :meth:`near`."""
        p, columns = self.percent, pairs.columns

        def confirm(batches):
            for b in batches:
                keep = []
                for x, y in zip(b.column("_su").to_pylist(), b.column("_sv").to_pylist()):
                    x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
                    both = np.sort(np.concatenate([x, y]), kind="stable")
                    common = int((both[1:] == both[:-1]).sum())
                    keep.append(100 * common >= p * (len(x) + len(y) - common))
                yield b.filter(pa.array(keep, pa.bool_())).select(columns)

        sets = durable(self.sets(pairs))
        one, two = (sets.select(F.col("_id").alias(u), F.col("_set").alias(s)) for u, s in (("_u", "_su"), ("_v", "_sv")))
        return durable(pairs.join(one, "_u").join(two, "_v").select(*columns, "_su", "_sv")
                       .mapInArrow(confirm, ", ".join(f"{c} long" for c in columns)))


def ordered(a: str, b: str):
    return F.least(a, b).alias("_u"), F.greatest(a, b).alias("_v")


def near_duplicates(docs: DataFrame, shingle_words: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept."""
    c = Corpus(docs, shingle_words, percent, id_col, text_col)
    leads = durable(c.buckets.groupBy("_key").agg(F.min_by("_id", F.xxhash64("_id", "_key")).alias("_lead")))
    tried = durable(c.buckets.join(leads, "_key").where("_id <> _lead").select(*ordered("_id", "_lead")).distinct())
    stars = c.links(durable(c.candidates(tried)))
    first = components(stars, "_u", "_v")
    release(docs.sparkSession)
    # documents of one key that are not in one component yet
    own = durable(c.buckets.join(first.withColumnRenamed("id", "_id"), "_id", "left")
                   .select("_key", "_id", F.coalesce("component_id", "_id").alias("_c")))
    open_keys = own.groupBy("_key").agg(F.min("_c").alias("_lo"), F.max("_c").alias("_hi")).where("_lo < _hi").select("_key")
    opened = durable(own.join(open_keys, "_key"))
    mine = opened.groupBy("_id").agg(F.collect_list("_key").alias("_keys"))
    rest = opened.join(mine.join(c.bits, "_id"), "_id")
    one, two = (rest.select(F.col("_key").alias(f"_key{x}"), *[F.col(k).alias(f"{k}{x}") for k in ("_id", "_c", "_n", "_parity", "_bits", "_keys")])
                for x in "uv")
    # a pair is made at the least of its common keys only
    least = F.array_min(F.array_intersect("_keysu", "_keysv")) == F.col("_keyu")
    more = one.join(two, (F.col("_keyu") == F.col("_keyv")) & (F.col("_cu") < F.col("_cv")) & c.near("u", "v") & least) \
              .select(*ordered("_idu", "_idv"), "_cu", "_cv").join(tried, ["_u", "_v"], "left_anti")
    release(docs.sparkSession)
    # these links join whole components: the links found before need not be walked again
    joined = components(c.links(durable(more)), "_cu", "_cv").select(F.col("id").alias("_c"), F.col("component_id").alias("_to"))
    release(docs.sparkSession)
    comp = c.classes.join(first.withColumnRenamed("id", "_rep"), "_rep", "left") \
                    .select(F.col("_id").alias("_node"), F.coalesce("component_id", "_rep").alias("_c")).join(joined, "_c", "left") \
                    .select("_node", F.coalesce("_to", "_c").alias("_comp"))
    out = c.signed.select("_id", "_n").join(comp, F.col("_id") == F.col("_node"), "left")
    component = F.coalesce("_comp", "_id")
    return out.select(F.col("_id").alias("doc_id"), F.col("_n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(F.col("_id") == component, F.lit(True)).alias("kept"))


def without_near_duplicates(docs: DataFrame, shingle_words: int = 5, percent: int = 80, id_col: str = "doc_id",
                            text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each group: the one with the smallest id."""
    gone = near_duplicates(docs, shingle_words, percent, id_col, text_col).where("NOT kept").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs[id_col].cast("long") == gone["_gone"], "left_anti")


def op2_bbit_minhash(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle_words=2)
