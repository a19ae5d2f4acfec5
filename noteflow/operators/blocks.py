"""Sums of numpy blocks over all rows, and rows as matrices, for the model fits.

A fit that needs a sum over all rows of something large (X'X, a gradient of many models, a
histogram of all nodes) lets every task add up its own rows in numpy and emit the sum cut into
pieces of ``PIECE`` doubles, as bytes.  Pieces are added in two levels of streaming tasks, so no
task holds more than its own block and a piece, and only the final block reaches the driver.
There is one partial block per core, not per input partition.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship_package

PIECE = 65_536     # doubles per piece (512 KB)
FAN = 64           # partial blocks added by one task of the first level
ROWS = 2_000       # rows made dense at a time


def features_column(df: DataFrame, name: str) -> Column:
    """The features as Arrow can carry them: arrays as they are, ML vectors as their struct of
    (type, size, indices, values), so that sparse rows stay sparse on the way."""
    return F.unwrap_udt(F.col(name)) if isinstance(df.schema[name].dataType, VectorUDT) else F.col(name)


def vector_length(df: DataFrame, name: str) -> Column:
    """Number of features of each row of a :func:`features_column`."""
    t = df.schema[name].dataType
    if hasattr(t, "fieldNames"):
        return F.coalesce(F.col(f"{name}.size"), F.size(f"{name}.values"))
    return F.size(name)


def vector_bytes(df: DataFrame, name: str) -> Column:
    """Bytes of each row's stored entries, of ML vectors or arrays (doubles; indices of sparse vectors)."""
    c = features_column(df, name)
    if not isinstance(df.schema[name].dataType, VectorUDT):
        return F.coalesce(8 * F.size(c), F.lit(0))
    return F.coalesce(4 * F.size(c["indices"]), F.lit(0)) + F.coalesce(8 * F.size(c["values"]), F.lit(0))


def _parts(column) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and flat values of a list column (nulls count as empty)."""
    lens = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    return lens.astype(np.int64), pc.list_flatten(column).to_numpy(zero_copy_only=False)


def sparse_rows(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature, value) of all stored entries, in row order."""
    if pa.types.is_struct(column.type):
        lens, values = _parts(column.field("values"))
        ilens, indices = _parts(column.field("indices"))
        rows = np.repeat(np.arange(len(lens)), lens)
        starts = np.concatenate(([0], np.cumsum(lens)))
        places = np.arange(len(values)) - starts[rows]             # dense vectors: the place is the feature
        stored = np.repeat(ilens > 0, lens)
        places[stored] = indices
        return rows, places, values.astype(np.float64)
    lens, values = _parts(column)
    rows = np.repeat(np.arange(len(lens)), lens)
    return rows, np.arange(len(values)) - np.concatenate(([0], np.cumsum(lens)))[rows], values.astype(np.float64)


def dense_rows(column, d: int) -> np.ndarray:
    """The rows as an n x d matrix of doubles."""
    if pa.types.is_list(column.type):
        lens, values = _parts(column)
        if len(lens) and (lens == d).all():
            return values.astype(np.float64).reshape(len(lens), d)
    rows, places, values = sparse_rows(column)
    out = np.zeros((len(column), d))
    out[rows, places] = values
    return out


def slices(batches: Iterator[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def _pieces(key: int, task: int, block: np.ndarray):
    flat = np.ascontiguousarray(block, dtype=np.float64).ravel()
    for c, start in enumerate(range(0, max(1, len(flat)), PIECE)):
        yield key, task % FAN, c, task, flat[start:start + PIECE].tobytes()


_SCHEMA = "k int, s int, c int, p int, v binary"
_ARROW = pa.schema([("k", pa.int32()), ("s", pa.int32()), ("c", pa.int32()), ("p", pa.int32()), ("v", pa.binary())])


def _batch(rows) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _ARROW.types)], schema=_ARROW)


def _add_runs(keys):
    """Adds neighbouring rows that agree in ``keys`` (rows arrive sorted by them)."""
    def run(batches):
        at, total = None, None
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("k", "s", "c", "p", "v"))):
                own, value = tuple(row[i] for i in keys), np.frombuffer(row[4])
                if at is not None and tuple(at[i] for i in keys) == own:
                    total = total + value
                    continue
                if at is not None:
                    yield _batch([(*at[:4], total.tobytes())])
                at, total = row, value
        if at is not None:
            yield _batch([(*at[:4], total.tobytes())])
    return run


def sum_blocks(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], dict]) -> dict[int, np.ndarray]:
    """Sum over all tasks of the blocks ``work(batches)`` returns by key (flat, in double precision).

    Partial blocks are added in the order of their tasks, so equal partitions give equal sums."""
    spark = df.sparkSession
    ship_package(spark)
    tasks = max(1, spark.sparkContext.defaultParallelism)

    def emit(batches):
        from pyspark import TaskContext
        task = TaskContext.get().partitionId()
        for key, block in work(batches).items():
            for row in _pieces(key, task, block):
                yield _batch([row])

    parts = df.coalesce(tasks).mapInArrow(emit, _SCHEMA)
    if tasks > FAN:
        parts = parts.repartition("k", "c", "s").sortWithinPartitions("k", "c", "s", "p").mapInArrow(_add_runs((0, 2, 1)), _SCHEMA)
    sums = parts.repartition("k", "c").sortWithinPartitions("k", "c", "p").mapInArrow(_add_runs((0, 2)), _SCHEMA)
    out: dict[int, dict[int, np.ndarray]] = {}
    for r in sums.select("k", "c", "v").collect():
        out.setdefault(r["k"], {})[r["c"]] = np.frombuffer(bytes(r["v"]))
    return {k: np.concatenate([cs[c] for c in sorted(cs)]) for k, cs in out.items()}
