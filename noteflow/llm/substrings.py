"""Exact substring dedup with suffix arrays and longest-previous-factor tests (operator 1).

Every byte under a ``length``-byte string that also starts in a document with a smaller id
goes; the first document keeps its copy.

A suffix array over the whole corpus would move every suffix at every doubling step, so
suffixes first go to buckets where all their equals are:

1. *Anchors.*  The window of ``length`` bytes at each position is represented by the
   smallest hash among its ``GRAM``-byte grams; consecutive windows mostly share one.  Equal
   windows have equal anchors.  Whole copies of a text are set aside (one row per document,
   aggregated map-side): all of a later copy goes.
2. *Candidates.*  Cells of documents send the distinct anchors they hold (four bytes each)
   to hash buckets; anchors in two or more documents come back.
3. *Suffix arrays.*  A candidate's context (the bytes of all its windows) goes to a bucket
   by its anchor, once per cell and text, with the smallest document id.  Each bucket sorts
   its suffixes by their first ``length`` bytes; in that order a previous or next suffix of
   a smaller document with a common prefix of ``length`` is an earlier match (the
   longest-previous-factor array reaches ``length`` there), and those windows come back.
   Anchors found in more than ``HOT_CELLS`` cells are dealt by whole window instead, so a
   passage in a third of all documents is one string per cell, and a short phrase with ever
   different surroundings spreads over all buckets.
4. *Removal.*  Cells mark the windows and cut the documents.

Cells and buckets follow the number of bytes; no anchor, count or text is capped.  The
texts are shuffled once, by cell, and read again from that shuffle.

A null text is empty.  A null id counts as the largest; rows with the same id never remove
each other's bytes; repeated rows each give a row; matches never cross documents.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .util import CELL_BYTES, durable, parts_for, table, text_bytes

GRAM = 20
#: Windows worked on at a time (their positions take 24 bits).
SEGMENT = 1 << 19
#: Cells that may hold an anchor before its windows are dealt one by one.
HOT_CELLS = 64
#: Bytes of anchors a candidate bucket holds, and of contexts a suffix bucket would hold if
#: every anchor were a candidate (contexts come to about four times the text).
ANCHOR_BUCKET, CONTEXT_BUCKET = 2 << 20, 12 << 20
#: Windows whose suffixes are sorted together.
SORT_WINDOWS = 1 << 18
NO_ID = np.iinfo(np.int64).max
_U = np.uint64


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> _U(31)) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ h >> _U(29)) * _U(0x94D049BB133111EB)
    return h ^ h >> _U(32)


def words_at(data: np.ndarray, dtype: str) -> np.ndarray:
    """The integers that start at every byte."""
    size = np.dtype(dtype).itemsize
    return np.ndarray((max(0, len(data) - size + 1),), dtype, data, 0, (1,))


def gram_hashes(data: np.ndarray) -> np.ndarray:
    n = len(data) - GRAM + 1
    a, b, c = words_at(data, "<u8")[:n], words_at(data, "<u8")[8:8 + n], words_at(data, "<u4")[16:16 + n]
    h = a * _U(0x9E3779B97F4A7C15)
    h ^= h >> _U(32)
    h += b
    h *= _U(0xC2B2AE3D27D4EB4F)
    h ^= h >> _U(29)
    h += c
    return mix(h)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum over every ``width`` consecutive values."""
    span = 1
    while 2 * span <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[:len(x) - (width - span)], x[width - span:]) if width > span else x


def anchors(data: np.ndarray, ends: np.ndarray, length: int):
    """Anchors of the concatenated texts: (identity, first window, last window, text).

    ``ends`` are the texts' ends.  Windows never cross a text's end."""
    out = []
    starts = np.concatenate([[0], ends[:-1]])
    for a in range(0, len(data) - length + 1, SEGMENT):
        b = min(len(data) - length + 1, a + SEGMENT)
        part = data[a:b + length - 1]
        h = gram_hashes(part)
        key = (h & ~_U((1 << 24) - 1)) | np.arange(len(h), dtype=np.uint64)
        at = (sliding_min(key, length - GRAM + 1) & _U((1 << 24) - 1)).astype(np.int64)
        text = np.searchsorted(ends, np.arange(a, b), "right") if len(ends) < 64 else np.repeat(
            np.arange(len(ends)), np.clip(ends, a, b) - np.clip(starts, a, b))
        ok = np.arange(a, b) + length <= ends[text]
        new = np.ones(b - a, bool)
        new[1:] = (at[1:] != at[:-1]) | ~ok[:-1] | (text[1:] != text[:-1])
        first = np.flatnonzero(new & ok)
        if not len(first):
            continue
        breaks = np.flatnonzero(np.append(new | ~ok, True))
        last = breaks[np.searchsorted(breaks, first, "right")] - 1
        out.append((mix(h[at[first]] + _U(0x632BE59BD9B4E019)), first + a, last + a, text[first]))
    if not out:
        e = np.empty(0, np.int64)
        return np.empty(0, np.uint64), e, e, e
    return tuple(np.concatenate(x) for x in zip(*out))


class Cell:
    """The documents of a cell in the order of their ids, without whole copies."""

    def __init__(self, rows: pa.Table, side: pa.Table, length: int):
        ids, texts = rows["_ord"].to_pylist(), rows["_text"].to_pylist()
        order = sorted(range(len(ids)), key=lambda i: (ids[i], texts[i]))
        self.ids, self.texts, self.length = [ids[i] for i in order], [texts[i] for i in order], length
        copies: dict[int, set[bytes]] = {}
        for kind, i, sha in zip(side["_kind"].to_pylist(), side["_ord"].to_pylist(), side["_blob"].to_pylist()):
            if kind == 0:
                copies.setdefault(i, set()).add(sha)
        self.copy = [i in copies and hashlib.sha256(t).digest() in copies[i] for i, t in zip(self.ids, self.texts)]
        self.doc = np.array([k for k, (c, t) in enumerate(zip(self.copy, self.texts)) if not c and len(t) >= length], np.int64)
        self.data = np.frombuffer(b"".join([self.texts[k] for k in self.doc.tolist()]), np.uint8)
        self.ends = np.cumsum([len(self.texts[k]) for k in self.doc.tolist()]).astype(np.int64)

    def anchors(self):
        return anchors(self.data, self.ends, self.length)


def split_by(bucket: np.ndarray):
    """(bucket, positions) for every bucket that occurs."""
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    for part in np.split(order, cuts):
        if len(part):
            yield int(bucket[part[0]]), part


def records(rows: list[tuple], fields: list[tuple[str, pa.DataType]]) -> pa.Table:
    return pa.table([pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(fields)], names=[n for n, _ in fields])


SENT = [("_bucket", pa.int64()), ("_cell", pa.int64()), ("_blob", pa.binary())]
SIDE = [("_cell", pa.int64()), ("_kind", pa.int32()), ("_ord", pa.int64()), ("_blob", pa.binary()), ("_more", pa.binary())]
CONTEXTS = [("_bucket", pa.int64()), ("_cell", pa.int64()), ("_kind", pa.int32()), ("_doc", pa.binary()), ("_start", pa.binary()),
            ("_size", pa.binary()), ("_ids", pa.binary()), ("_bytes", pa.binary())]


def send_anchors(rows: pa.Table, side: pa.Table, length: int, buckets: int) -> pa.Table:
    """The cell's distinct anchors by bucket; those in two of its documents twice."""
    side = side if side.num_rows else records([], SIDE)   # an empty side has no columns
    cell = Cell(rows, side, length)
    h, _, _, text = cell.anchors()
    order = np.lexsort((text, h))
    h, text = h[order], text[order]
    new = np.append(True, h[1:] != h[:-1]) if len(h) else np.empty(0, bool)
    twice = np.zeros(len(h), bool)
    if len(h):
        begin = np.flatnonzero(new)
        twice[begin] = np.maximum.reduceat(text, begin) != text[begin]
    h = np.concatenate([h[new], h[twice]])
    key = rows["_cell"][0].as_py() if len(rows) else 0
    low = (h & _U(0xFFFFFFFF)).astype("<u4")
    return records([(b, key, low[at].tobytes()) for b, at in split_by((h >> _U(32)).astype(np.int64) % buckets)], SENT)


def shared_anchors(rows: pa.Table) -> pa.Table:
    """Of a bucket: the anchors sent twice or more go back to their cells; kind 2: hot ones."""
    blobs = [np.frombuffer(x, "<u4") for x in rows["_blob"].to_pylist()]
    # one sort of the whole bucket counts every anchor where it stands; no cell searches the bucket's values again
    _, place, times = np.unique(np.concatenate(blobs), return_inverse=True, return_counts=True)
    times = np.split(times[place], np.cumsum([len(x) for x in blobs])[:-1])
    bucket, out = rows["_bucket"][0].as_py(), []
    for cell, x, n in zip(rows["_cell"].to_pylist(), blobs, times):
        mine, burning = np.unique(x[(n > 1) & (n <= HOT_CELLS)]), np.unique(x[n > HOT_CELLS])
        if len(mine) or len(burning):
            out.append((cell, 1, bucket, mine.tobytes(), burning.tobytes()))
    return records(out, SIDE)


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions starts[i] .. starts[i] + sizes[i], one after another."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def send_contexts(rows: pa.Table, side: pa.Table, length: int, buckets: int, suffix_buckets: int) -> pa.Table:
    """Contexts of the cell's candidates by bucket, one per text, under its first document;
    what another document of the cell repeats is already known (kind 1)."""
    if not len(rows):
        return records([], CONTEXTS)
    side = side if side.num_rows else records([], SIDE)   # an empty side has no columns
    cell = Cell(rows, side, length)
    h, first, last, text = cell.anchors()
    high, low = (h >> _U(32)).astype(np.int64) % buckets, (h & _U(0xFFFFFFFF))
    key = high.astype(np.uint64) << _U(32) | low
    kinds = [x == 1 for x in side["_kind"].to_pylist()]
    sets = [(b, m, n) for is_set, b, m, n in zip(kinds, side["_ord"].to_pylist(), side["_blob"].to_pylist(), side["_more"].to_pylist()) if is_set]
    known = [np.concatenate([np.frombuffer(s[i], "<u4").astype(np.uint64) | _U(s[0] << 32) for s in sets] or [np.empty(0, np.uint64)]) for i in (1, 2)]
    hot = np.isin(key, known[1])
    plain = np.isin(key, known[0])
    # hot anchors: each window is a context of its own
    n = (last - first + 1)[hot]
    start = np.concatenate([first[plain], ragged(first[hot], n)])
    size = np.concatenate([(last - first)[plain] + length, np.full(n.sum(), length)])
    text = np.concatenate([text[plain], np.repeat(text[hot], n)])
    del key, high, low, first, last
    route = np.concatenate([h[plain], np.zeros(n.sum(), np.uint64)])
    if n.sum():
        w = words_at(cell.data, "<u8")
        acc, at = np.zeros(n.sum(), np.uint64), start[plain.sum():]
        for off in [*range(0, length - 8, 8), length - 8]:
            acc = mix(acc * _U(31) + w[at + off])
        route[plain.sum():] = acc
    order = np.lexsort((start, text))
    start, size, text, route = start[order], size[order], text[order], route[order]
    raw, seen, fresh, again = cell.data.tobytes(), {}, [], []
    for i, (a, z, t) in enumerate(zip(start.tolist(), (start + size).tolist(), text.tolist())):
        j = seen.setdefault(raw[a:z], i)
        (fresh if j == i else again).append((i, j))
    base = np.concatenate([[0], cell.ends[:-1]]) if len(cell.ends) else np.empty(0, np.int64)
    ids = np.array(cell.ids, np.int64)[cell.doc] if len(cell.doc) else np.empty(0, np.int64)
    out, number = [], rows["_cell"][0].as_py()

    def row(bucket: int, kind: int, at: np.ndarray, carried: np.ndarray, body: bytes):
        out.append((bucket, number, kind, cell.doc[text[at]].astype("<u4").tobytes(), (start[at] - base[text[at]]).astype("<u4").tobytes(),
                    size[at].astype("<u2").tobytes(), carried.tobytes(), body))

    f = np.array([i for i, _ in fresh], np.int64)
    for b, at in split_by((mix(route[f]) >> _U(16)).astype(np.int64) % suffix_buckets if len(f) else f):
        at = f[at]
        row(b, 0, at, ids[text[at]].astype("<i8"), cell.data[ragged(start[at], size[at])].tobytes())
    if again:
        # a later document of the cell: gone; the same document again: as its first place
        i, j = (np.array(x, np.int64) for x in zip(*again))
        later = ids[text[i]] > ids[text[j]]
        if later.any():
            row(number % suffix_buckets, 1, i[later], np.empty(0, "<i8"), b"")
        same_i, same_j = i[~later], j[~later]
        for b, at in split_by((mix(route[same_j]) >> _U(16)).astype(np.int64) % suffix_buckets if len(same_j) else same_j):
            at = same_i[at]
            row(b, 0, at, ids[text[at]].astype("<i8"), cell.data[ragged(start[at], size[at])].tobytes())
    return records(out, CONTEXTS)


def earlier_matches(data: np.ndarray, at: np.ndarray, doc: np.ndarray, length: int) -> np.ndarray:
    """Which suffixes ``data[at:]`` have an earlier match of ``length`` bytes.

    Suffix order by the first ``length`` bytes; a run of common prefixes >= ``length`` is an
    interval of the LCP array.  A suffix has an earlier match there if a smaller document
    precedes it in the run (previous smaller value) or follows it (next smaller value)."""
    w = words_at(data, ">u8")
    keys = [w[at + off].astype(np.uint64) for off in [*range(0, length - 8, 8), length - 8]]
    order = np.lexsort(keys[::-1])
    cut = np.zeros(len(at), bool)
    if len(at):
        cut[0] = True
    for k in keys:
        s = k[order]
        cut[1:] |= s[1:] != s[:-1]
    begin = np.flatnonzero(cut)
    run = np.cumsum(cut) - 1
    d = doc[order]
    least = np.minimum.reduceat(d, begin) if len(d) else d
    # a smaller value anywhere in the run is a previous or a next smaller one
    out = np.zeros(len(at), bool)
    out[order] = least[run] < d
    return out


def match_suffixes(rows: pa.Table, length: int) -> pa.Table:
    """Of a suffix bucket: for every context the windows with an earlier match, by cell."""
    out = []
    parts: dict[bytes, list] = {}   # context -> [first id, places]
    sent = list(zip(*(rows[c].to_pylist() for c in ("_cell", "_kind", "_doc", "_start", "_size", "_ids", "_bytes"))))
    for r, (cell, kind, doc, start, size, ids, body) in enumerate(sent):
        if kind == 1:
            n = np.frombuffer(size, "<u2").astype(np.int64) - length + 1
            out.append((cell, 3, 0, doc + start, ((_U(1) << n.astype(np.uint64)) - _U(1)).astype("<u4").tobytes()))
            continue
        a = 0
        for k, (z, i) in enumerate(zip(np.frombuffer(size, "<u2").tolist(), np.frombuffer(ids, "<i8").tolist())):
            got = parts.setdefault(body[a:a + z], [i, []])
            got[0] = min(got[0], i)
            got[1].append((r, k, i))
            a += z
    texts = list(parts)
    # suffixes that share `length` bytes share an anchor but not always a context: all of them are sorted together,
    # in groups by the hash of their own first bytes, so that memory stays bounded
    sizes = np.array([len(t) for t in texts], np.int64)
    data = np.frombuffer(b"".join(texts), np.uint8)
    n = sizes - length + 1
    base = np.cumsum(sizes) - sizes
    at = ragged(base, n) if len(n) else np.empty(0, np.int64)
    doc = np.repeat(np.array([v[0] for v in parts.values()], np.int64), n) if len(n) else np.empty(0, np.int64)
    hit = np.zeros(len(at), bool)
    if len(at):
        groups = -(-len(at) // SORT_WINDOWS)
        w = words_at(data, "<u8")
        group = (mix(w[at] ^ w[at + length - 8] * _U(0x9E3779B97F4A7C15)) % _U(groups)).astype(np.int64) if groups > 1 else np.zeros(len(at), np.int64)
        for g in range(groups):
            own = np.flatnonzero(group == g)
            hit[own] = earlier_matches(data, at[own], doc[own], length)
    # windows of a context -> bits
    ends = np.cumsum(n)
    place = np.arange(len(at)) - np.repeat(ends - n, n) if len(n) else at
    bits = np.zeros(len(n), np.uint64)
    if len(at):
        bits = np.bitwise_or.reduceat(np.where(hit, _U(1) << place.astype(np.uint64), _U(0)), ends - n)
    found: dict[int, list] = {}
    for (first, places), b, m in zip(parts.values(), bits.tolist(), n.tolist()):
        for r, k, i in places:
            if mask := ((1 << m) - 1 if i > first else b):
                found.setdefault(r, []).append((k, mask))
    for r, marks in found.items():
        cell, _, docs, starts = sent[r][:4]
        k = np.array([x for x, _ in marks])
        out.append((cell, 3, 0, np.frombuffer(docs, "<u4")[k].tobytes() + np.frombuffer(starts, "<u4")[k].tobytes(),
                    np.array([x for _, x in marks], "<u4").tobytes()))
    return records(out, SIDE)


RESULT = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
          ("kept_sha256", pa.string()), ("kept", pa.binary())]


def remove(rows: pa.Table, side: pa.Table, length: int) -> pa.Table:
    """Cut the marked windows out of the cell's documents."""
    side = side if side.num_rows else records([], SIDE)   # an empty side has no columns
    cell = Cell(rows, side, length)
    gone = [np.zeros(len(t) + 1, np.int32) for t in cell.texts]
    docs, starts, masks = [], [], []
    for kind, place, mask in zip(side["_kind"].to_pylist(), side["_blob"].to_pylist(), side["_more"].to_pylist()):
        if kind == 3:
            p = np.frombuffer(place, "<u4").reshape(2, -1)
            docs.append(p[0])
            starts.append(p[1])
            masks.append(np.frombuffer(mask, "<u4"))
    if docs:
        doc, start, mask = np.concatenate(docs), np.concatenate(starts).astype(np.int64), np.concatenate(masks)
        for d, own in split_by(doc.astype(np.int64)):
            for t in range(length - GRAM + 1):
                at = start[own][(mask[own] >> np.uint32(t) & np.uint32(1)) == 1] + t
                np.add.at(gone[d], at, 1)
                np.add.at(gone[d], at + length, -1)
    out = []
    for i, text, copy, g in zip(cell.ids, cell.texts, cell.copy, gone):
        if copy and len(text) >= length:
            cut = np.ones(len(text), bool)
        else:
            cut = np.cumsum(g[:-1]) > 0
        kept = np.frombuffer(text, np.uint8)[~cut].tobytes() if cut.any() else text
        spans = int(cut[0]) + int((cut[1:] & ~cut[:-1]).sum()) if len(cut) else 0
        out.append((None if i == NO_ID else i, len(text), int(cut.sum()), spans, hashlib.sha256(kept).hexdigest(), kept))
    return records(out, RESULT)


def dedup_substrings(docs: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text",
                     with_text: bool = True) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, with ``with_text``, the
    remaining bytes ``kept``.  ``length`` may be 28 to 51."""
    if not GRAM + 8 <= length < GRAM + 32:
        raise ValueError("length must be 28 to 51")
    total = text_bytes(docs, text_col)
    n_cells = parts_for(total, CELL_BYTES)
    buckets, suffix_buckets = parts_for(total // 4, ANCHOR_BUCKET), parts_for(total * 4, CONTEXT_BUCKET)
    cells = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(int(NO_ID))).alias("_ord"),
                        F.coalesce(F.col(text_col).cast("string").cast("binary"), F.lit(b"")).alias("_text")) \
                .withColumn("_cell", F.pmod(F.xxhash64("_ord"), F.lit(n_cells)))
    marks = cells.select("_cell", "_ord", F.sha2("_text", 256).alias("_sha"))
    firsts = marks.groupBy("_sha").agg(F.min("_ord").alias("_first"), F.max("_ord").alias("_last")).where("_last > _first")
    none = F.lit(None).cast("binary")
    copies = durable(marks.join(firsts, "_sha").where("_ord > _first")
                     .select("_cell", F.lit(0).alias("_kind"), "_ord", F.unhex("_sha").alias("_blob"), none.alias("_more")).distinct())
    copies = copies.select(*(F.col(c).alias(c) for c in copies.columns))   # columns apart from those of the cells
    side = "_cell long, _kind int, _ord long, _blob binary, _more binary"
    by_cell = cells.groupBy("_cell")
    sent = by_cell.cogroup(copies.groupBy("_cell")) \
                  .applyInArrow(lambda a, b: send_anchors(a, b, length, buckets), "_bucket long, _cell long, _blob binary")
    shared = sent.groupBy("_bucket").applyInArrow(shared_anchors, side)
    contexts = by_cell.cogroup(copies.unionByName(shared).groupBy("_cell")) \
                      .applyInArrow(lambda a, b: send_contexts(a, b, length, buckets, suffix_buckets),
                                    "_bucket long, _cell long, _kind int, _doc binary, _start binary, _size binary, _ids binary, _bytes binary")
    found = contexts.groupBy("_bucket").applyInArrow(lambda t: match_suffixes(t, length), side)
    out = by_cell.cogroup(copies.unionByName(found).groupBy("_cell")) \
                 .applyInArrow(lambda a, b: remove(a, b, length) if with_text else remove(a, b, length).drop_columns(["kept"]),
                               "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
                               + ", kept binary" * with_text)
    return out


def op1_longest_previous_factor(spark, sf_dir: str) -> DataFrame:
    return dedup_substrings(table(spark, sf_dir, "documents"), with_text=False)
