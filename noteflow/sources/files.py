"""Sources and sinks (S1-S9): CSV, Parquet splits, embeddings, variants, models, metrics.

Intermediate tables go under the session's shared checkpoint folder
(``spark.checkpoint.dir``), never a machine-local temporary folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..session import checkpoint_dir, shuffles_released, ship_package, staged, values_df


def scratch_path(spark: SparkSession, name: str, unique: bool = True) -> str:
    """A path for an intermediate table in the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/noteflow-tables/{name}" + (f"-{uuid.uuid4().hex[:12]}" if unique else "")


def read_csv_source(spark: SparkSession, path: str, schema: StructType | str, sep: str = ",",
                    order_col: str | None = None, multiline: bool = True, mode: str = "FAILFAST",
                    null_value: str | None = None) -> DataFrame:
    """Read a delimited file with a header and a declared schema.

    ``order_col`` numbers the rows, from 0, in the order of the files' paths and of the lines in
    them; such files are read in splits (see :func:`read_csv_ordered`).  Without it a ``multiLine``
    file is one task.
    """
    options = {"sep": sep, "escape": '"', "mode": mode, "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    if null_value is not None:
        options["nullValue"] = null_value
    if order_col:
        return read_csv_ordered(spark, path, schema, options, order_col)
    return spark.read.schema(schema).options(header="true", multiLine=str(multiline).lower(), **options).csv(path)


def read_csv_ordered(spark: SparkSession, path: str, schema: StructType | str, options: dict, order_col: str) -> DataFrame:
    """Delimited files with a header each, read in splits, rows numbered in file and line order.

    * Lines come from the splittable text scan with their file and split (a compressed file is one
      split).  A line break is inside a quoted field when the quotes before it, from the start of the
      file, are odd in number; each split counts its quotes, and a prefix sum over the file's splits
      gives the parity at each split's start.  A line that begins at even parity begins a record.
    * The files are read twice: counts per split first, then the lines.  Both times a task walks
      the lines of its splits in their order, so no line is shuffled.
    * Records are numbered by prefix sums of the record starts per split; the lines of a record
      are joined inside their split.  Only records that run over the end of a split are joined
      across: if there are any, the splits they touch are read once more.
    * ``from_csv`` parses the finished records.  Blank lines between records count for nothing.

    ``_source_file`` holds the row's file; its first record, the header, is dropped."""
    ship_package(spark)
    raw = spark.read.option("lineSep", "\n").text(path)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    at = ["f", "s", "b"]
    lines = raw.select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("s"),
                       F.col("_metadata.file_block_length").alias("b"), quotes.alias("n"),
                       (~F.col("value").rlike(r"[^\s]")).alias("blank"), F.col("value").alias("t"))
    # first pass: counts only
    splits = lines.drop("t").mapInArrow(_count_starts, "f string, s long, b long, parity long, even long, uneven long")
    ordered = Window.partitionBy("f").orderBy("s")
    file = ordered.rowsBetween(Window.unboundedPreceding, -1)
    known = splits.withColumn("p0", F.coalesce(F.sum("parity").over(file), F.lit(0)) % 2) \
                  .withColumn("starts", F.when(F.col("p0") == 0, F.col("even")).otherwise(F.col("uneven"))) \
                  .withColumn("r0", F.coalesce(F.sum("starts").over(file), F.lit(0))) \
                  .withColumn("ends_inside", F.coalesce(F.lead("p0").over(ordered) == 1, F.lit(False)))
    known = staged(known.select(*at, "p0", "r0", "starts", "ends_inside"))
    total, offsets, crossing = 0, [], 0
    per_file = known.groupBy("f").agg(F.sum("starts").alias("n"), F.count_if("ends_inside").alias("crossing")).collect()
    for r in sorted(per_file, key=lambda r: r["f"]):
        offsets.append((r["f"], total))
        total += max(0, r["n"] - 1)
        crossing += r["crossing"]
    first = values_df(spark, offsets, "f string, rows_before long")

    def records(of: DataFrame, how: str) -> DataFrame:
        p0 = F.coalesce("p0", F.raise_error(F.lit("the files were split differently in the second pass")).cast("long"))
        return lines.join(F.broadcast(of), at, how).withColumn("p0", p0).mapInArrow(_join_lines, "f string, s long, r long, t string, whole boolean")
    # second pass: the lines; splits cut otherwise than in the first pass are an error
    whole = records(known, "left").where("whole").select("f", "r", "t")
    if crossing:
        parts = records(known.where("p0 = 1 OR ends_inside"), "inner").where("NOT whole")
        in_order = F.transform(F.array_sort(F.collect_list(F.struct("s", "t"))), lambda x: x["t"])
        whole = whole.unionByName(parts.groupBy("f", "r").agg(F.array_join(in_order, "\n").alias("t")))
    fields = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    parsed = F.from_csv(F.rtrim("t", F.lit("\r")), ", ".join(f"`{x.name}` {x.dataType.simpleString()}" for x in fields), options)
    return (whole.where("r > 1").join(F.broadcast(first), "f")
                 .select(parsed.alias("x"), F.col("f").alias("_source_file"), (F.col("rows_before") + F.col("r") - 2).alias(order_col))
                 .select("x.*", "_source_file", order_col))


def _by_split(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """(file, start) of a split and lines of it, in the order of the scan; a split's lines may come in several pieces."""
    for batch in batches:
        if not batch.num_rows:
            continue
        f, s = batch.column("f"), batch.column("s")
        new = pc.or_(pc.not_equal(f[1:], f[:-1]), pc.not_equal(s[1:], s[:-1])).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(new) + 1).tolist(), batch.num_rows]
        for a, z in zip(cuts, cuts[1:]):
            yield (f[a].as_py(), s[a].as_py()), batch.slice(a, z - a)


def _inside(lines: pa.RecordBatch, parity: int) -> tuple[np.ndarray, int]:
    """Which lines begin inside a quoted field, and the parity after them."""
    n = lines.column("n").to_numpy(zero_copy_only=False).astype(np.int64)
    ends = parity + np.cumsum(n)
    return (ends - n) % 2 == 1, int(ends[-1] % 2)


def _count_starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per split: the parity of its quotes, and its record starts if it begins outside (``even``) or inside (``uneven``) a field."""
    for _, pieces in groupby(_by_split(batches), key=lambda x: x[0]):
        parity = even = uneven = 0
        for (f, s), lines in pieces:
            b = lines.column("b")[0].as_py()
            odd, parity = _inside(lines, parity)
            filled = ~lines.column("blank").to_numpy(zero_copy_only=False)
            even, uneven = even + int((filled & ~odd).sum()), uneven + int((filled & odd).sum())
        yield pa.RecordBatch.from_pydict({"f": [f], "s": [s], "b": [b], "parity": [parity], "even": [even], "uneven": [uneven]})


def _join_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records of each split, their lines joined; ``whole`` is false for one that began before the split or goes on after it."""
    for (f, s), pieces in groupby(_by_split(batches), key=lambda x: x[0]):
        parity = last = r0 = r = ends_inside = None
        held: list[pa.Array] = []     # lines so far of the record r

        def out(first: int, texts: pa.Array) -> pa.RecordBatch:
            number = np.arange(first, first + len(texts))
            whole = ((number != r0) & ~((number == last) & ends_inside))
            return pa.RecordBatch.from_arrays([pa.array([f] * len(texts), pa.string()), pa.array([s] * len(texts), pa.int64()), pa.array(number), texts.cast(pa.string()), pa.array(whole)], ["f", "s", "r", "t", "whole"])

        for _, lines in pieces:
            if parity is None:
                parity, r0, n, ends_inside = (lines.column(c)[0].as_py() for c in ("p0", "r0", "starts", "ends_inside"))
                r, last = r0, r0 + n
            inside, parity = _inside(lines, parity)
            kept = inside | ~lines.column("blank").to_numpy(zero_copy_only=False)
            t, starts = lines.column("t").filter(pa.array(kept)), np.flatnonzero(~inside[kept])
            held += [t[:starts[0]] if len(starts) else t]
            if len(starts):
                if sum(map(len, held)):
                    yield out(r, _joined(pa.concat_arrays(held)))
                if len(starts) > 1:
                    yield out(r + 1, _joined(t, starts))
                held, r = [t[starts[-1]:]], r + len(starts)
        if sum(map(len, held)):
            yield out(r, _joined(pa.concat_arrays(held)))


def _joined(lines: pa.Array, starts=None) -> pa.Array:
    """The lines from each start to the next joined (all of them without ``starts``)."""
    lists = pa.ListArray.from_arrays(pa.array([0, len(lines)] if starts is None else starts, pa.int32()), lines)
    return pc.binary_join(lists, "\n")


def csv_to_parquet(spark: SparkSession, csv_path: str, schema: StructType | str, out_path: str, sep: str = ",",
                   order_col: str | None = "row_order", **kw) -> DataFrame:
    """S1 helper: read a CSV once, keep its row order in ``order_col`` and store it as Parquet;
    later stages read the Parquet."""
    read_csv_source(spark, csv_path, schema, sep, order_col, **kw).write.mode("overwrite").parquet(out_path)
    return spark.read.parquet(out_path)


def write_csv_sink(df: DataFrame, path: str, sep: str = ",", file_rows: int = 0, compression: str = "none") -> None:
    """Write with a header (no index column).  ``file_rows`` bounds the rows of a file: a reader
    of texts with line breaks takes each file in one task, as any reader does a file of most ``compression`` codecs."""
    out = (df.write.option("maxRecordsPerFile", file_rows).mode("overwrite").option("header", True).option("sep", sep).option("escape", '"')
           .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).option("compression", compression))
    with shuffles_released(df.sparkSession):
        out.csv(path)


def write_splits(df: DataFrame, path: str, split_col: str = "split") -> None:
    """S3: persist all named splits as one Parquet table partitioned by split."""
    df.write.mode("overwrite").partitionBy(split_col).parquet(path)


def read_splits(spark: SparkSession, path: str, names=None, split_col: str = "split") -> DataFrame:
    """S3: read some splits back; the filter prunes partitions (only their files are read).
    ``train_val`` stands for train + val."""
    df = spark.read.parquet(path)
    if names:
        wanted = []
        for n in names:
            wanted += ["train", "val", "train_val"] if n == "train_val" else [n]
        df = df.filter(F.col(split_col).isin(wanted))
    return df


def read_embeddings(spark: SparkSession, feat_path: str, label_path: str, row_id: str = "row_id") -> DataFrame:
    """Feature rows and label rows, aligned by row id (inner join)."""
    return spark.read.parquet(feat_path).join(spark.read.parquet(label_path), row_id)


def write_embeddings(df: DataFrame, path: str, features: str = "features") -> None:
    """Persist features with their labels, in single precision: arrays as they are; ML vectors
    as a struct (type, size, indices, values) that keeps sparse rows sparse (its values are
    stored as doubles, which ML vectors need, rounded to floats)."""
    if isinstance(df.schema[features].dataType, VectorUDT):
        v = F.unwrap_udt(features)
        rounded = F.transform(v["values"], lambda x: x.cast("float").cast("double"))
        entries = F.struct(v["type"].alias("type"), v["size"].alias("size"), v["indices"].alias("indices"), rounded.alias("values"))
        df = df.withColumn(features, F.when(F.col(features).isNotNull(), entries))
    df.write.mode("overwrite").parquet(path)


def read_vectors(spark: SparkSession, path: str, features: str = "features") -> DataFrame:
    """Features stored as (type, size, indices, values) read back as ML vectors, in the scan
    itself (no conversion step, other columns as they are)."""
    plain = spark.read.parquet(path).schema
    return spark.read.schema(StructType([StructField(f.name, VectorUDT() if f.name == features else f.dataType, f.nullable) for f in plain])).parquet(path)


def read_positions(spark: SparkSession, path: str, position: str = "position") -> DataFrame:
    """Parquet rows with their place: files in the order of their paths, rows in the order of
    the file, counted from 0.  One count per file reaches the driver."""
    rows = spark.read.parquet(path)
    placed = rows.select("*", F.col("_metadata.file_path").alias("_nf_file"), F.col("_metadata.row_index").alias("_nf_index"))
    counts = sorted(tuple(r) for r in placed.groupBy("_nf_file").count().collect())
    offsets, total = [], 0
    for name, n in counts:
        offsets.append((name, total))
        total += n
    before = values_df(spark, offsets, "_nf_name string, _nf_before long")
    return placed.join(F.broadcast(before), F.col("_nf_file") == F.col("_nf_name")) \
                 .select(*rows.columns, (F.col("_nf_before") + F.col("_nf_index")).alias(position))


def read_aligned(spark: SparkSession, feat_path: str, label_path: str, position: str = "position") -> DataFrame:
    """S4 / J8 without a key: feature and label rows paired by position.  Files of both sides may
    be cut differently; different row counts are an error."""
    left, right = read_positions(spark, feat_path, position), read_positions(spark, label_path, position)
    n, m = (x.agg(F.count(F.lit(1)).alias("n")).first()["n"] for x in (left, right))
    if n != m:
        raise ValueError(f"{n} feature rows cannot be paired with {m} label rows")
    return left.join(right, position)


def read_variants(spark: SparkSession, base: str, row_id: str = "row_id", variant_col: str = "variant") -> DataFrame:
    """The embedding variants under ``base``, each feature file paired with its label
    file by name: ``<base>/<variant>/features`` and ``<base>/<variant>/labels``, joined on
    (variant, row id), never by position."""
    def part(kind: str) -> DataFrame:
        name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -3)
        return spark.read.parquet(f"{base}/*/{kind}").withColumn(variant_col, name)
    return part("features").join(part("labels"), [variant_col, row_id])


def save_model(model, path: str) -> None:
    """Persist a fitted Spark ML model / pipeline model."""
    model.write().overwrite().save(path)


def load_model(path: str, cls=None):
    """Reload a persisted model (``PipelineModel`` unless another class is given)."""
    if cls is None:
        from pyspark.ml import PipelineModel as cls
    return cls.load(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hpath)


def materialize(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Load a stage's output if it was completed (``_SUCCESS`` marker), else
    compute, save and load it.  Always returns a fresh read of the files."""
    if not path_exists(spark, f"{path}/_SUCCESS"):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def write_metrics(df: DataFrame, path: str) -> None:
    """Write a metric table (a handful of rows) as one JSON file; ``repartition`` keeps the
    stages above it parallel and moves only the finished rows."""
    df.repartition(1).write.mode("overwrite").json(path)
