"""Mixing sources to target weights by a time-varying curriculum (operator 12).

Every source has a weight schedule, a piecewise linear curve over the training time 0..1.

* The integral of a curve is the source's weight.  Sources share the words of the mix by
  weight; no target exceeds ``max_times`` the source's size, and what is cut off there is
  shared again among the others until none is above (``targets``).
* A source's documents stand in a seeded random order, again and again, as one stream of
  words.  The source's demand up to time t is its target times the integral of its curve
  up to t over the whole integral; the document that starts at word c of the stream is due
  at the time at which the demand reaches c (the curve's integral is inverted in closed
  form, a quadratic in every segment).
* Documents are sorted by range on that time.  ``place`` gives one row per document,
  ``sequence`` one row per appearance in training order, with the text.

A place in a source's stream is a prefix sum of sizes.  The random order is a hash, so its
leading bits cut every source into buckets of about ``BUCKET_ROWS`` rows of the table; sums
per bucket and per ``FAN`` buckets give each bucket's start and a window inside a bucket
the rest.  A source with a third of all rows is thereby split like any other.  The sources
themselves are ranked by a range sort, and only sums over them reach the driver.

Edge cases: a null text has size 0; a document of size 0 is never taken; null sources are
one source, the last; a null id is kept, its place drawn from its text; rows with the same
id are documents of their own (their places follow id, size and a hash of the text, rows
that agree in all of them interchange); an empty table gives an empty result.  Only the
named columns are read, so further columns may have any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import draw
from ..operators.order import KeyOrder, join_keys
from .util import WORD, durable, table

#: Schedules as (time, weight) knots; their integrals are 1, 2 and 3.  Sources take them in
#: turn: early sources fade out, steady ones stay, late ones gain.
CURVES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 2.0), (1.0, 2.0)), ((0.0, 2.0), (0.5, 3.0), (1.0, 4.0)))
#: Rows of the table that share a bucket of the random order, and buckets summed at once.
BUCKET_ROWS = 1000
FAN_BITS = 10
DRAW_BITS = 60


def integrals(curve) -> list[float]:
    """The curve's integral up to each knot."""
    total, out = 0.0, [0.0]
    for (t0, w0), (t1, w1) in zip(curve, curve[1:]):
        total += (t1 - t0) * (w0 + w1) / 2
        out.append(total)
    if curve[0][0] != 0 or curve[-1][0] != 1 or total <= 0 or min(w for _, w in curve) < 0 or sorted(curve) != list(curve):
        raise ValueError(f"a schedule runs from time 0 to 1 with weights >= 0, not all 0: {curve}")
    return out


def reached(curve, t: Column) -> Column:
    """Share of the whole integral that the curve has reached at time ``t``."""
    upto = integrals(curve)
    out = F.lit(upto[-1])
    for (t0, w0), (t1, w1), base in reversed(list(zip(curve, curve[1:], upto))):
        x = t - t0
        out = F.when(t <= t1, base + w0 * x + (w1 - w0) / (t1 - t0) / 2 * x * x).otherwise(out)
    return out / upto[-1]


def time_of(curve, share: Column) -> Column:
    """The time at which the curve's integral reaches ``share`` of the whole."""
    upto = integrals(curve)
    need = share * upto[-1]
    out = F.lit(1.0)
    for (t0, w0), (t1, w1), base, end in reversed(list(zip(curve, curve[1:], upto, upto[1:]))):
        r = F.greatest(need - base, F.lit(0.0))
        slope = (w1 - w0) / (t1 - t0)
        x = 2 * r / (w0 + F.sqrt(F.greatest(w0 * w0 + 2 * slope * r, F.lit(0.0))))
        out = F.when(need <= end, F.when(r <= 0, t0).otherwise(F.least(t0 + x, F.lit(t1)))).otherwise(out)
    return out


def by_curve(curves, of, which: str = "_curve") -> Column:
    """``of(curve)`` for the curve whose number stands in the column ``which``."""
    out = F.lit(None).cast("double")
    for k, curve in enumerate(curves):
        out = F.when(F.col(which) == k, of(curve)).otherwise(out)
    return out


def targets(sources: DataFrame, source_col: str, size_col: str, total: int | None = None,
            max_times: int = 3, curves=CURVES) -> DataFrame:
    """Per source: _source, _source_size, _curve and _target, words of the mix.

    ``sources`` holds one row per source.  Sources in code point order, null last, take the
    curves in turn; ``total`` (all sizes together unless given) is shared by the integrals.
    """
    src = sources.select(F.col(source_col).alias("_source"), F.col(size_col).alias("_source_size"))
    by = [F.col("_source").isNull(), F.col("_source")]
    order = KeyOrder(src, by)
    ranked = join_keys(src, order.ranks("_rank"), by, order.names)
    ranked = durable(ranked.withColumn("_curve", ((F.col("_rank") - 1) % len(curves)).cast("int"))
                     .withColumn("_w", by_curve(curves, lambda c: F.lit(integrals(c)[-1])))
                     .withColumn("_cap", F.lit(max_times) * F.col("_source_size")))
    sums = ranked.agg(F.sum("_source_size").alias("all"), F.sum("_w").alias("w")).first()
    rest = total = (sums["all"] or 0) if total is None else total
    weight = sums["w"] or 0.0
    while weight > 0:   # sources over their cap leave with it, which only raises the others
        above = F.col("_w") * rest > F.col("_cap") * F.lit(weight)
        got = ranked.agg(F.sum(F.when(above, F.col("_cap"))).alias("cut"), F.sum(F.when(~above, F.col("_w"))).alias("w")).first()
        then = total - (got["cut"] or 0), got["w"] or 0.0
        if then == (rest, weight):
            break
        rest, weight = then
    share = F.col("_w") * F.lit(float(rest)) / F.lit(weight) if weight > 0 else F.col("_cap").cast("double")
    return ranked.select("_source", "_source_size", "_curve", F.least(share, F.col("_cap").cast("double")).alias("_target"))


def place(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", carry=(),
          total: int | None = None, max_times: int = 3, curves=CURVES, seed: int = 0) -> DataFrame:
    """One row per document: id, size, source_size, target, taken (words, repeats counted),
    time (training time of its first appearance, null if never taken) and starts_at (words of
    the mix before that time); also the columns ``carry`` names, as ``_row``, and the
    private columns that ``sequence`` reads."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    mine = draw(seed, F.col(id_col))
    rows = durable(docs.select(
        F.col(id_col).alias("_id"), F.col(source_col).cast("string").alias("_source"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("_size"),
        F.coalesce(mine, draw(seed, F.md5(text))).alias("_draw"), F.xxhash64(text).alias("_x"),
        *([F.struct(*carry).alias("_row")] if carry else [])))
    bits = max(0, (rows.count() // BUCKET_ROWS).bit_length())
    keyed = rows.withColumn("_b", F.shiftright("_draw", DRAW_BITS - bits) if bits else F.lit(0).cast("long"))
    fine = durable(keyed.groupBy("_source", "_b").agg(F.sum("_size").alias("_sum"))
                   .withColumn("_c", F.shiftright("_b", FAN_BITS)))
    goals = targets(fine.groupBy("_source").agg(F.sum("_sum").alias("_all")), "_source", "_all", total, max_times, curves)
    goals = durable(goals.withColumn("_quota", F.floor(F.col("_target") + 0.5)))
    # the words of the source before a bucket: coarser buckets first, then those beside it
    before = (Window.unboundedPreceding, -1)
    coarse = fine.groupBy("_source", "_c").agg(F.sum("_sum").alias("_sum")) \
                 .select(F.col("_source").alias("_s1"), F.col("_c").alias("_c1"), F.coalesce(
                     F.sum("_sum").over(Window.partitionBy("_source").orderBy("_c").rowsBetween(*before)), F.lit(0)).alias("_far"))
    near = F.coalesce(F.sum("_sum").over(Window.partitionBy("_source", "_c").orderBy("_b").rowsBetween(*before)), F.lit(0))
    starts = fine.withColumn("_near", near) \
                 .join(coarse, F.col("_source").eqNullSafe(F.col("_s1")) & (F.col("_c") == F.col("_c1"))) \
                 .join(goals.withColumnRenamed("_source", "_s3"), F.col("_source").eqNullSafe(F.col("_s3"))) \
                 .select(F.col("_source").alias("_s2"), F.col("_b").alias("_b2"), (F.col("_far") + F.col("_near")).alias("_base"),
                         "_source_size", "_curve", "_target", "_quota")
    own = Window.partitionBy("_source", "_b").orderBy("_draw", "_id", "_size", "_x").rowsBetween(*before)
    placed = keyed.withColumn("_in", F.coalesce(F.sum("_size").over(own), F.lit(0))) \
                  .join(starts, F.col("_source").eqNullSafe(F.col("_s2")) & (F.col("_b") == F.col("_b2"))) \
                  .withColumn("_at", F.col("_base") + F.col("_in"))
    taken = sum((in_pass(p) for p in range(max_times)), F.lit(0).cast("long"))
    time = F.when(taken > 0, by_curve(curves, lambda c: time_of(c, F.try_divide("_at", "_quota"))))
    share = {r["_curve"]: float(r["q"] or 0) for r in goals.groupBy("_curve").agg(F.sum("_quota").alias("q")).collect()}
    offset = sum((q * reached(curves[k], F.col("time")) for k, q in share.items()), F.lit(0.0))
    return placed.select(F.col("_id").alias(id_col), F.col("_size").alias("size"), F.col("_source_size").alias("source_size"),
                         F.col("_target").alias("target"), taken.alias("taken"), time.alias("time"),
                         *(["_row"] if carry else []), "_source", "_curve", "_at", "_quota") \
                 .withColumn("starts_at", F.floor(offset))


def in_pass(p: int) -> Column:
    """Words the mix takes of a document in the p-th pass over its source: all of them, or the
    first ones of the document at which the source's quota ends."""
    left = F.col("_quota") - (F.lit(p) * F.col("_source_size") + F.col("_at"))
    return F.greatest(F.lit(0).cast("long"), F.least(F.col("_size"), left))


def sequence(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
             max_times: int = 3, curves=CURVES, **options) -> DataFrame:
    """The mix in training order, sorted by range: id, source, pass (from 0), time, n_words
    (the first words of the text that the mix takes) and the text, one row per appearance."""
    placed = place(docs, id_col, source_col, text_col, carry=[F.col(text_col).alias("text")], max_times=max_times,
                   curves=curves, **options)
    left = F.col("_quota") - (F.col("_p") * F.col("source_size") + F.col("_at"))
    each = placed.where("taken > 0").withColumn("_p", F.explode(F.sequence(F.lit(0), F.lit(max_times - 1)))) \
                 .withColumn("n_words", F.least(F.col("size"), left)).where("n_words > 0")
    due = by_curve(curves, lambda c: time_of(c, F.try_divide(F.col("_p") * F.col("source_size") + F.col("_at"), F.col("_quota"))))
    return each.select(id_col, F.col("_source").alias("source"), F.col("_p").alias("pass"), due.alias("time"), "n_words",
                       F.col("_row.text").alias("text")).orderBy("time", "source", "pass", id_col)


def op12_curriculum_mix(spark, sf_dir: str) -> DataFrame:
    """All documents under the production schedules, in the order of their first appearance."""
    placed = place(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return placed.select("doc_id", "size", "source_size", "target", "taken", F.round("time", 6).alias("first_time")) \
                 .orderBy(F.col("first_time").asc_nulls_last(), "doc_id")


OP12_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST(('0x' || substr(md5('0:' || CAST(doc_id AS VARCHAR)), 1, 15)) AS BIGINT) AS draw
  FROM documents
), s AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS nth FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source)
), w AS (
  SELECT *, CAST(nth % 3 + 1 AS DOUBLE) AS w, 3 * source_size AS cap FROM s
), o AS (
  -- k sources with the least cap per weight stay at their cap, the others share the rest
  SELECT *, row_number() OVER z AS k, CAST(sum(cap) OVER z - cap AS BIGINT) AS below, sum(w) OVER () - sum(w) OVER z + w AS others, sum(source_size) OVER () AS total
  FROM w WINDOW z AS (ORDER BY cap / w, nth)
), cut AS (
  SELECT CAST(total - below AS DOUBLE) AS rest, others FROM o WHERE w * (total - below) <= cap * others ORDER BY k LIMIT 1
), t AS (
  SELECT w.source, w.nth, w.source_size, least(w.w * cut.rest / cut.others, CAST(w.cap AS DOUBLE)) AS target FROM w, cut
), q AS (
  SELECT *, CAST(floor(target + 0.5) AS BIGINT) AS quota FROM t
), p AS (
  SELECT d.doc_id, d.size, q.source_size, q.target, q.quota, q.nth,
         coalesce(sum(d.size) OVER (PARTITION BY q.nth ORDER BY d.draw, d.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place
  FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source
), a AS (
  SELECT *, CAST(greatest(0, least(size, quota - place)) + greatest(0, least(size, quota - place - source_size))
            + greatest(0, least(size, quota - place - 2 * source_size)) AS BIGINT) AS taken, CAST(place AS DOUBLE) / nullif(quota, 0) AS share FROM p
), c AS (
  -- 1.5 t - t^2/2 = share; t = share; 2 t + t^2 = 3 share
  SELECT *, CASE WHEN taken = 0 THEN NULL WHEN nth % 3 = 0 THEN 2 * share / (1.5 + sqrt(2.25 - 2 * share))
                         WHEN nth % 3 = 1 THEN share
                         ELSE sqrt(1 + 3 * share) - 1 END AS tm FROM a
)
SELECT doc_id, size, source_size, target, taken, CASE WHEN taken > 0 THEN round(tm, 6) END AS first_time FROM c
"""
