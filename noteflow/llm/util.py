"""Helpers shared by the training-data operators.

Inputs may carry any further columns, also ones named like our own: every operator
selects what it needs under private ``_x`` names first.  A null text counts as empty
unless the operator's docstring says otherwise.
"""

from __future__ import annotations

import gc
import math
import os
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

#: Words as the contracts define them: maximal runs without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: UTF-8 bytes of text one cell (a unit of Python work) holds on average.
CELL_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it (on a cluster
    without that path ship it with ``--py-files`` as usual), and hand them texts in Arrow
    batches that stay small with long documents."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])


def durable(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back: later passes see the
    same rows, and a lost executor costs a re-read instead of the whole lineage."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Let the driver's cleaner drop shuffles and checkpoints that nothing refers to any more,
    now rather than at its next full collection."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def parts_for(n_bytes: int, per_part: int, least: int = 24) -> int:
    """How many equal parts keep each near ``per_part`` bytes, at any input size."""
    return max(least, math.ceil(n_bytes / per_part))


def text_bytes(docs: DataFrame, text_col: str = "text") -> int:
    """UTF-8 bytes of all texts (one number to the driver)."""
    return docs.select(F.sum(F.octet_length(F.col(text_col).cast("string"))).alias("n")).first()["n"] or 0


def crc_mod(id_col: str, m: int) -> Column:
    """crc32(id as text) mod m."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % F.lit(m)


def crc32_sql(text: str) -> str:
    """Unsigned crc32 of an ASCII string in DuckDB SQL, bit by bit (reversed polynomial 0xEDB88320)."""
    bits = f"flatten(list_transform(string_split({text}, ''), lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))"
    step = "CASE WHEN b >= 0 THEN xor(a, b) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END"
    return f"xor(4294967295, list_reduce({bits}, lambda a, b: {step}, CAST(4294967295 AS BIGINT)))"


#: Edges up to which components ends in one task (1 MB of pairs): rounds of jobs for so few rows cost the driver
#: more (plans, broadcasts, tasks, their events and metrics) than the work itself.
SMALL_EDGES = 50_000


def smallest_reached(batches):
    """Edges (_u, _v) to (_n, _m): every node and the smallest node that edges lead to from it."""
    to: dict[int, int] = {}

    def root(x: int) -> int:
        while (y := to.setdefault(x, x)) != x:
            to[x] = x = to[y]
        return x

    for batch in batches:
        for u, v in zip(*(c.to_pylist() for c in batch.columns)):
            u, v = root(u), root(v)
            to[max(u, v)] = min(u, v)
    yield pa.RecordBatch.from_arrays([pa.array(list(to), pa.int64()), pa.array([root(x) for x in list(to)], pa.int64())], names=["_n", "_m"])


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """Connected components: (id, component_id) for every node that has an edge;
    ``component_id`` is the smallest id of the component.

    Contraction: each node points to its smallest neighbour (or itself), pointers are
    doubled until they reach roots, edges are rewritten to the roots and loops and repeats
    dropped, until none is left; labels follow the pointers.  Only minima per node are aggregated (map-side combined), so a
    hub with very many neighbours is reduced before it is shuffled, and each round is a
    reliable checkpoint.  Rounds grow with the logarithm of the longest chain.  As soon as no more than
    ``SMALL_EDGES`` edges are left (counted each round) one task finds their roots; any more are shuffled.
    """
    e = durable(edges.select(F.col(u).cast("long").alias("_u"), F.col(v).cast("long").alias("_v")).where("_u <> _v")
                .select(F.least("_u", "_v").alias("_u"), F.greatest("_u", "_v").alias("_v")).distinct())
    labels = None
    while left := e.count():
        if small := left <= SMALL_EDGES:
            to = durable(e.coalesce(1).mapInArrow(smallest_reached, "_n long, _m long"))
        else:
            both = e.unionByName(e.select(F.col("_v").alias("_u"), F.col("_u").alias("_v")))
            to = durable(both.groupBy(F.col("_u").alias("_n")).agg(F.min("_v").alias("_m"))
                         .select("_n", F.least("_n", "_m").alias("_m")))
            while True:   # pointers form a forest; doubling brings each node to its root
                step = durable(to.join(to.select(F.col("_n").alias("_m"), F.col("_m").alias("_mm")), "_m").select("_n", "_m", "_mm"))
                if step.where("_mm <> _m").isEmpty():
                    break
                to = step.select("_n", F.col("_mm").alias("_m"))
        if labels is None:
            labels = to.select(F.col("_n").alias("_id"), F.col("_m").alias("_c"))
        else:
            labels = (labels.join(to.select(F.col("_n").alias("_c"), F.col("_m").alias("_to")), "_c", "left")
                            .select("_id", F.coalesce("_to", "_c").alias("_c")))
            labels = durable(labels)
        if small:
            break
        e = durable(e.join(to.select(F.col("_n").alias("_u"), F.col("_m").alias("_a")), "_u")
                     .join(to.select(F.col("_n").alias("_v"), F.col("_m").alias("_b")), "_v")
                     .where("_a <> _b")
                     .select(F.least("_a", "_b").alias("_u"), F.greatest("_a", "_b").alias("_v")).distinct())
    if labels is None:
        labels = e.select(F.col("_u").alias("_id"), F.col("_v").alias("_c"))
    return labels.select(F.col("_id").alias("id"), F.col("_c").alias("component_id"))
