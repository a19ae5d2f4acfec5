"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import math
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "noteflow",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or fetch) a session with AQE on and the UI off."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it (on a cluster without
    that path ship it with ``--py-files`` as usual)."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    known = [p for p in spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *known])


#: Estimated bytes of an input that is dealt to all cores before work on its rows.
SPREAD_BYTES = (4 << 20, 256 << 20)


def spread(df: DataFrame) -> DataFrame:
    """Deal an input of a few MB, which may come as one Parquet row group and so as one task, to all
    cores.  Smaller inputs gain nothing, larger ones have splits enough: both stay as they are.
    Filters and column pruning pass the exchange."""
    least, most = SPREAD_BYTES
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism) if least <= size <= most else df


#: Estimated bytes of rows in one partition: about so many when they are dealt, twice as many until they are.
PART_BYTES = 32 << 20


def spread_rows(df: DataFrame, n_bytes: Column) -> DataFrame:
    """Rows that several passes read from memory, in partitions of bounded size: ``n_bytes`` estimates a row.
    The splits of a file follow its compressed bytes and its row groups, so they say little of the rows' size in
    memory and may be few; rows are dealt anew only if a partition holds more than twice ``PART_BYTES``."""
    held = df.groupBy(F.spark_partition_id().alias("_nf_p")).agg(F.sum(n_bytes).alias("_nf_b"))
    most, total = held.agg(F.max("_nf_b"), F.sum("_nf_b")).first()
    return df.repartition(math.ceil(total / PART_BYTES)) if (most or 0) > 2 * PART_BYTES else df


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder of the session.

    On a cluster the folder comes from ``spark.checkpoint.dir`` (a shared file
    system).  Only a local-mode session without that setting gets a scratch
    folder of its own, as in tests.
    """
    sc = spark.sparkContext
    cur = sc._jsc.sc().getCheckpointDir()
    if cur.isDefined():
        return cur.get()
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return conf_dir
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder on a cluster")
    d = tempfile.mkdtemp(prefix="noteflow-ckpt-", dir=os.environ.get("NOTEFLOW_SCRATCH", "/tmp"))
    sc.setCheckpointDir(d)
    return d


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and cut its lineage.

    Used where two passes must see identical rows (per-partition offsets of a
    global rank); a lost executor then re-reads the checkpoint instead of
    recomputing a possibly different partitioning.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """What is written inside deletes its shuffle files when its write ends.  Else they stay on the disks until
    the driver's garbage collector finds the plan, beside those of all later steps."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


_STAGED: list[tuple[SparkSession, str]] = []


def remove_staged() -> None:
    """Delete the staged tables of sessions that still run (at exit, or when results are read)."""
    while _STAGED:
        spark, path = _STAGED.pop()
        try:
            p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # noqa: BLE001 - the session is gone
            pass


atexit.register(remove_staged)


def staged(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: lineage is cut, columns
    can be pruned, and the planner knows the size in bytes (zstd: texts take about half of what
    the default codec leaves).  Removed at exit."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/staged-{uuid.uuid4().hex}"
    with shuffles_released(spark):
        df.write.option("compression", "zstd").parquet(path)
    _STAGED.append((spark, path))
    return spark.read.parquet(path)


def values_df(spark: SparkSession, rows, schema: str) -> DataFrame:
    """A small fixed table as a local relation: Catalyst knows its exact row count (a
    static bound for broadcast decisions) and no RDD is built.  ``schema`` is a DDL string
    of any types; values are Python objects of those types."""
    fields = StructType.fromDDL(schema)
    arrow = to_arrow_schema(fields)
    cols = list(zip(*rows)) or [()] * len(fields)
    return spark.createDataFrame(pa.table([pa.array(list(c), f.type) for c, f in zip(cols, arrow)], schema=arrow), fields)
