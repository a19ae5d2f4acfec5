"""Line dedup with a suffix array over line sequences (operator 9), DataFrame operations only.

A document is its sequence of non-blank lines.  A run of whole lines with at least
``min_words`` words that stands earlier (in a smaller document, or before in the same one) is
deleted wherever it comes again, blank lines inside it too; the first copy stays.

* Only lines that occur twice or more can be in such a run; the others are dropped first
  (counted with map-side sums).  Line ids follow the sort order of the lines' hashes.
* Prefix doubling: rank k sorts the suffixes by their first ``2^k`` lines; rank k+1 names
  the distinct pairs (rank k here, rank k at ``2^k`` lines on) in sort order.  Pairs that
  occur once start no repeated run and get no name, so rounds get smaller; there are
  log2 of the most lines that ``min_words`` words can take.
* A window from ``i`` of ``n`` lines is an interval of common prefixes >= n in that order,
  named by the ranks of its first and its last ``2^k`` lines.  Each line starts the shortest
  window that reaches ``min_words`` words and ends one; a repeated run of that many words is
  the union of such windows, so deleting all but the first window of each interval deletes
  the maximal runs' later copies, whole.

Ranks are given by range sorts and minima per interval by two-step aggregates, so a line
in a third of all documents never meets in one task.  Lines are compared by 128 bits of
hashes.  A null text stays null and has no lines; a null id comes after all others; rows
with the same id are documents of their own (in the order of a hash of their texts, equal
rows counting once).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .util import WORD, durable, table

KEY = ["_ord", "_h", "_i"]
NO_ID = 2**63 - 1


def doc_key(id_col: str, text_col: str):
    return (F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("_ord"),
            F.xxhash64(F.col(text_col).cast("string")).alias("_h"))


def lines_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Non-blank lines: key, _i (place among them), _pos (place among all lines), hashes, words."""
    numbered = F.transform(F.split(F.col(text_col).cast("string"), "\n", -1),
                           lambda x, i: F.struct(i.alias("pos"), x.alias("line")))
    some = docs.select(*doc_key(id_col, text_col), F.filter(numbered, lambda s: s["line"].rlike(WORD)).alias("_lines"))
    each = some.select("_ord", "_h", F.posexplode_outer("_lines").alias("_i", "_l")).where("_i IS NOT NULL")
    return each.select(*KEY, F.col("_l.pos").alias("_pos"), F.xxhash64("_l.line").alias("_a"),
                       F.xxhash64(F.lit(1), "_l.line").alias("_b"), F.regexp_count("_l.line", F.lit(WORD)).alias("_w"))


def named(rows: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """``name`` for every distinct (a, b) that occurs twice or more, in sort order."""
    twice = rows.groupBy(a, b).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(a, b)
    return durable(twice.repartitionByRange(a, b).sortWithinPartitions(a, b).withColumn(name, F.monotonically_increasing_id()))


def windows_of(base: DataFrame, min_words: int) -> DataFrame:
    """The shortest windows of ``min_words`` words that start or end at a line: key of the
    first line, _n lines, and the first and last line's place in the text."""
    own = Window.partitionBy("_ord", "_h").orderBy("_i")
    cols = F.struct("_i", "_pos", "_w")

    def reach(side, step: int):
        # lines from here on that follow each other without a gap, with words so far
        zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("w"), F.lit(-1).alias("pos"), F.lit(True).alias("on"))

        def add(s, x):
            on = s["on"] & (x["_i"] == F.col("_i") + step * s["n"]) & (s["w"] < min_words)
            return F.when(on, F.struct((s["n"] + 1).alias("n"), (s["w"] + x["_w"]).alias("w"), x["_pos"].alias("pos"), F.lit(True).alias("on"))) \
                    .otherwise(F.struct(s["n"].alias("n"), s["w"].alias("w"), s["pos"].alias("pos"), F.lit(False).alias("on")))
        return F.aggregate(side, zero, add)

    ahead = F.collect_list(cols).over(own.rangeBetween(0, min_words - 1))
    back = F.reverse(F.collect_list(cols).over(own.rangeBetween(1 - min_words, 0)))
    both = base.select(*KEY, "_pos", ahead.alias("_ahead"), back.alias("_back")) \
               .select(*KEY, "_pos", reach(F.col("_ahead"), 1).alias("_f"), reach(F.col("_back"), -1).alias("_g"))
    starts = both.where(F.col("_f.w") >= min_words).select(*KEY, F.col("_f.n").alias("_n"), "_pos", F.col("_f.pos").alias("_end"))
    ends = both.where(F.col("_g.w") >= min_words) \
               .select("_ord", "_h", (F.col("_i") - F.col("_g.n") + 1).cast("int").alias("_i"), F.col("_g.n").alias("_n"),
                       F.col("_g.pos").alias("_pos"), F.col("_pos").alias("_end"))
    return starts.unionByName(ends).distinct()


def repeated_runs(docs: DataFrame, min_words: int = 30, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Maximal runs to delete: _ord, _h, _first and _last line (places in the text)."""
    lines = durable(lines_of(docs, id_col, text_col))
    ids = named(lines, "_a", "_b", "_r")
    base = durable(lines.join(ids, ["_a", "_b"]).select(*KEY, "_pos", "_w", "_r").dropDuplicates(KEY))
    windows = durable(windows_of(base, min_words))
    ranks = base.select(*KEY, "_r")
    most = windows.agg(F.max("_n").alias("n")).first()["n"] or 0
    found, k = None, 0
    while (1 << k) <= most:
        # windows of 2^k .. 2^(k+1) - 1 lines: the ranks of their first and last 2^k lines name the interval
        own = windows.where(F.col("_n").between(1 << k, (2 << k) - 1))
        head = own.join(ranks.withColumnRenamed("_r", "_ra"), KEY)
        tail = ranks.select("_ord", "_h", F.col("_i").alias("_j"), F.col("_r").alias("_rb"))
        part = head.withColumn("_j", F.col("_i") + F.col("_n") - (1 << k)).join(tail, ["_ord", "_h", "_j"]) \
                   .select(*KEY, "_n", "_pos", "_end", "_ra", "_rb")
        found = part if found is None else found.unionByName(part)
        if (2 << k) <= most:
            after = ranks.select("_ord", "_h", (F.col("_i") - (1 << k)).alias("_i"), F.col("_r").alias("_s"))
            pairs = durable(ranks.join(after, KEY))
            ranks = durable(pairs.join(named(pairs, "_r", "_s", "_q"), ["_r", "_s"]).select(*KEY, F.col("_q").alias("_r")))
        k += 1
    if found is None:
        return lines.select("_ord", "_h", F.col("_pos").alias("_first"), F.col("_pos").alias("_last")).limit(0)
    found = durable(found)
    interval = ["_n", "_ra", "_rb"]
    first = found.groupBy(*interval).agg(F.min(F.struct(*KEY)).alias("_one"), F.count(F.lit(1)).alias("_times")).where("_times > 1")
    later = found.join(first, interval).where(F.struct(*KEY) != F.col("_one"))
    # windows of a document that touch become one run
    w = Window.partitionBy("_ord", "_h").orderBy("_pos", "_end")
    span = later.select("_ord", "_h", "_pos", "_end").distinct() \
                .withColumn("_before", F.max("_end").over(w.rowsBetween(Window.unboundedPreceding, -1))) \
                .withColumn("_run", F.sum(F.when(F.col("_pos") <= F.col("_before") + 1, 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return span.groupBy("_ord", "_h", "_run").agg(F.min("_pos").alias("_first"), F.max("_end").alias("_last")).drop("_run")


def dedup_lines(docs: DataFrame, min_words: int = 30, id_col: str = "doc_id", text_col: str = "text",
                counts: bool | str = False) -> DataFrame:
    """``docs`` with the later copies cut out of ``text_col``; with ``counts`` also _n_lines
    (all lines), _n_removed (lines) and _n_runs, or as fields of one struct column of the name
    that ``counts`` gives (for tables that have columns of those names)."""
    runs = repeated_runs(docs, min_words, id_col, text_col)
    cuts = runs.groupBy("_ord", "_h").agg(F.array_sort(F.collect_list(F.struct("_first", "_last"))).alias("_cuts")) \
               .select(F.col("_ord").alias("_ord2"), F.col("_h").alias("_h2"), "_cuts")
    # the row as a struct: its columns can't clash with ours
    rows = docs.select(F.struct("*").alias("_row"), *doc_key(id_col, text_col))
    text = F.col("_row")[text_col].cast("string")
    joined = rows.join(cuts, (F.col("_ord") == F.col("_ord2")) & (F.col("_h") == F.col("_h2")), "left")
    # what lies between the runs, piece by piece
    lines = F.split(text, "\n", -1)
    begin = F.concat(F.array(F.lit(0)), F.transform("_cuts", lambda c: c["_last"] + 1))
    end = F.concat(F.transform("_cuts", lambda c: c["_first"]), F.array(F.size(lines)))
    kept = F.flatten(F.zip_with(begin, end, lambda a, z: F.slice(lines, a + 1, z - a)))
    new = F.when(F.col("_cuts").isNull(), text).otherwise(F.array_join(kept, "\n"))
    out = [new.alias(c) if c == text_col else F.col("_row")[c].alias(c) for c in docs.columns]
    if counts:
        removed = F.aggregate("_cuts", F.lit(0), lambda s, c: s + c["_last"] - c["_first"] + 1)
        n_lines = F.when(text.isNull(), 0).otherwise(F.size(lines))
        found = [n_lines.cast("long").alias("_n_lines"), F.coalesce(removed, F.lit(0)).cast("long").alias("_n_removed"),
                 F.when(F.col("_cuts").isNull(), 0).otherwise(F.size("_cuts")).cast("long").alias("_n_runs")]
        out += [F.struct(*found).alias(counts)] if isinstance(counts, str) else found
    return joined.select(*out)


def op9_line_suffix_array(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs, counts=True).select(
        "doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_removed").alias("n_removed"), F.col("_n_runs").alias("n_runs"),
        F.md5(F.coalesce("text", F.lit(""))).alias("kept_md5"))


OP9_SQL = r"""
WITH lines AS (
  SELECT doc_id, t.pos - 1 AS pos, t.line AS line, len(regexp_extract_all(t.line, '[^\x20\x09-\x0D]+')) AS w
  FROM documents, LATERAL (SELECT unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos) t
), own AS (
  SELECT *, row_number() OVER d AS i, sum(w) OVER d AS upto FROM lines WHERE w > 0 WINDOW d AS (PARTITION BY doc_id ORDER BY pos)
), bounds AS (
  SELECT a.doc_id, a.i AS i, min(b.i) AS j FROM own a JOIN own b ON a.doc_id = b.doc_id AND b.i >= a.i AND b.i < a.i + 30
         AND b.upto - a.upto + a.w >= 30 GROUP BY ALL
  UNION
  SELECT a.doc_id, max(b.i) AS i, a.i AS j FROM own a JOIN own b ON a.doc_id = b.doc_id AND b.i <= a.i AND b.i > a.i - 30
         AND a.upto - b.upto + b.w >= 30 GROUP BY a.doc_id, a.i
), content AS (
  SELECT k.doc_id, k.i, k.j, min(o.pos) AS first, max(o.pos) AS last, string_agg(o.line, chr(10) ORDER BY o.i) AS body
  FROM bounds k JOIN own o ON o.doc_id = k.doc_id AND o.i BETWEEN k.i AND k.j GROUP BY ALL
), later AS (
  SELECT doc_id, first, last FROM (SELECT *, row_number() OVER (PARTITION BY body ORDER BY doc_id, i) AS nth FROM content) WHERE nth > 1
), marked AS (
  SELECT l.*, EXISTS (SELECT 1 FROM later x WHERE x.doc_id = l.doc_id AND l.pos BETWEEN x.first AND x.last) AS gone FROM lines l
), runs AS (
  SELECT *, coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY pos), false) AS before FROM marked
)
SELECT d.doc_id, count(r.pos) AS n_lines, count(*) FILTER (WHERE r.gone) AS n_removed,
       count(*) FILTER (WHERE r.gone AND NOT r.before) AS n_runs,
       md5(coalesce(string_agg(CASE WHEN NOT r.gone THEN r.line END, chr(10) ORDER BY r.pos), '')) AS kept_md5
FROM documents d LEFT JOIN runs r USING (doc_id) GROUP BY d.doc_id
"""
