"""Order-dependent building blocks that never move a fact table into one task.

A Spark DataFrame has no row order, so every operator whose result depends on
position takes ``order_by``: a list of columns.  Rows that agree in all of them
follow a hash of the whole row, so each keeps a place of its own and no key is too
frequent to be split; rows that agree in every column interchange.

* :class:`KeyOrder` - the key columns alone, range partitioned, sorted and staged;
  gives the key at a position and marks the rows before or after it.
* :class:`RowOrder` - the rows staged once with a row number, ranked by their keys alone;
  gives every row its exact position, joined back by the number.  Rows that read the same
  every time may stay where they are: a hash of the keys or the row then takes the number's place.
* :func:`global_rank` - exact 1-based position in ``order_by`` order (no
  ``Window.orderBy`` without ``partitionBy``, which would plan ``Exchange
  SinglePartition``).
* :func:`rank_within` - exact position inside a group, also when one group
  holds a large share of all rows (the group is split across many range
  partitions instead of landing in one window task).
* :func:`last_n_flag` / :func:`first_n_flag` - mark rows against the key at a position.
* :func:`bounded_broadcast` - hint a side only if the plan itself proves it tiny.
* :func:`lookup_side` - the same, and any other side written first so that its size is known.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from ..session import reliable_checkpoint, staged, values_df

# Rows up to which a side whose size the plan proves (inline values, limits, global
# aggregates) is hinted for broadcast; every other join is left to AQE's measured sizes.
BROADCAST_PROVEN_ROWS = 10_000
_LOCAL_BITS = 33  # monotonically_increasing_id(): partition id << 33 | row index


def _cols(cols) -> list[Column]:
    return [c if isinstance(c, Column) else F.col(c) for c in cols]


def static_max_rows(df: DataFrame) -> int | None:
    """Row bound Catalyst proves from the plan alone (local data, limits, global
    aggregates and what preserves them), or None."""
    try:
        opt = df._jdf.queryExecution().optimizedPlan().maxRows()
        return int(opt.get()) if opt.isDefined() else None
    except Exception:  # noqa: BLE001 - plans without the JVM accessor
        return None


def bounded_broadcast(df: DataFrame, max_rows: int = BROADCAST_PROVEN_ROWS) -> DataFrame:
    """Hint ``df`` for broadcast if the plan proves at most ``max_rows`` rows; no job is
    run, and any other side is left to AQE, which sees its size in bytes."""
    bound = static_max_rows(df)
    return F.broadcast(df) if bound is not None and bound <= max_rows else df


def lookup_side(df: DataFrame) -> DataFrame:
    """``df`` as the small side of a lookup by a class or another key that few values share.  If the
    plan proves no bound it is written first, so the planner knows its bytes: a small one is broadcast
    and the rows stay where they are, a large one is shuffle-joined.  Left to AQE a handful of classes fills
    too few partitions to be broadcast, and every row moves to the task of its class."""
    bound = static_max_rows(df)
    return F.broadcast(df) if bound is not None and bound <= BROADCAST_PROVEN_ROWS else staged(df)


def _has_map(t: DataType) -> bool:
    return (isinstance(t, MapType) or isinstance(t, ArrayType) and _has_map(t.elementType)
            or isinstance(t, StructType) and any(_has_map(f.dataType) for f in t))


def row_hash(df: DataFrame) -> Column:
    """64-bit hash of all columns (maps cannot be hashed and are left out)."""
    cols = [F.col(f"`{f.name}`") for f in df.schema if not _has_map(f.dataType)]
    return F.xxhash64(*cols) if cols else F.lit(0).cast("long")


def _starts(df: DataFrame) -> tuple[list[tuple[int, int, int]], int]:
    """(partition, rows before it, its rows) from the staged ids, and the number of all rows."""
    pid = F.shiftright(F.col("_nf_mid"), _LOCAL_BITS)
    counts = sorted((r["p"], r["n"]) for r in df.groupBy(pid.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())
    offsets, total = [], 0
    for p, n in counts:
        offsets.append((p, total, n))
        total += n
    return offsets, total


def _with_position(df: DataFrame, offsets, rank_col: str, first: int = 1) -> DataFrame:
    """``rank_col`` from the staged ids (one offset row per range partition is broadcast)."""
    off = values_df(df.sparkSession, [(p, o) for p, o, _ in offsets], "_nf_pid long, _nf_off long")
    local = F.col("_nf_mid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    return (df.withColumn("_nf_pid", F.shiftright(F.col("_nf_mid"), _LOCAL_BITS)).join(F.broadcast(off), "_nf_pid")
              .withColumn(rank_col, F.col("_nf_off") + local + first).drop("_nf_pid", "_nf_off", "_nf_mid"))


class KeyOrder:
    """The rows of ``df`` in ``order_by`` order, as keys.

    Only the key columns are range partitioned, sorted and staged (a reliable
    checkpoint, so all passes see the same positions after an executor loss); one
    count per partition goes to the driver.
    """

    def __init__(self, df: DataFrame, order_by, descending: bool = False, num_partitions: int | None = None):
        names = [f"_nf_k{i}" for i in range(len(list(order_by)))]
        keys = df.select(*[c.alias(n) for c, n in zip(_cols(order_by), names)])
        sort = [F.col(n).desc() if descending else F.col(n).asc() for n in names]
        ranged = keys.repartitionByRange(num_partitions, *sort) if num_partitions else keys.repartitionByRange(*sort)
        self.names, self.spark = names, df.sparkSession
        self.staged = reliable_checkpoint(ranged.sortWithinPartitions(*sort).withColumn("_nf_mid", F.monotonically_increasing_id()))
        self.offsets, self.total = _starts(self.staged)

    def ranks(self, rank_col: str) -> DataFrame:
        """Key columns ``_nf_k0 ..`` and the 1-based position, one row per row of ``df``."""
        return _with_position(self.staged, self.offsets, rank_col)

    def key_at(self, position: int):
        """Key (a Row) at the 1-based ``position``, None outside the rows."""
        for p, o, n in self.offsets:
            if o < position <= o + n:
                return self.staged.where(F.col("_nf_mid") == (p << _LOCAL_BITS | (position - o - 1))).select(*self.names).first()
        return None

    def flag(self, df: DataFrame, order_by, n: int, last: bool, name: str) -> DataFrame:
        """Mark exactly the last (or first) ``n`` rows of ``df``.  Rows are compared with the
        key at the cut; only if that key is repeated across the cut are its rows ranked."""
        if n <= 0 or n >= self.total:
            return df.withColumn(name, F.lit(n > 0))
        at = self.total - n + 1 if last else n
        row = self.key_at(at)
        cut, mine = _lit_key(df, order_by, row), _key_struct(order_by)
        own = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(self.names)])
        near = self.staged.agg(F.count_if(own < cut).alias("lower"), F.count_if(own == cut).alias("same")).first()
        wanted = near["lower"] + near["same"] - at + 1 if last else at - near["lower"]
        if wanted == near["same"]:
            return df.withColumn(name, mine >= cut if last else mine <= cut)
        tied = RowOrder(df.where(mine == cut), []).ranked("_nf_tie")
        inside = F.col("_nf_tie") > near["same"] - wanted if last else F.col("_nf_tie") <= wanted
        clear = df.where(mine != cut).withColumn(name, mine > cut if last else mine < cut)
        return clear.unionByName(tied.withColumn(name, inside).drop("_nf_tie"))


class RowOrder:
    """The rows of ``df`` in ``order_by`` order: staged once as Parquet with a row number and a hash,
    then ranked by their keys alone (a :class:`KeyOrder` over keys, hash and row number, which
    no two rows share).  Positions join back by the row number.

    ``reread`` says that ``df`` holds the same rows whenever it is read (tables and staged rows,
    filtered, projected and joined).  Only keys are staged then: a hash of the keys is the row
    number if none occurs twice - counted, not assumed - or else a hash of the whole row.  Wide
    rows move when the caller joins them, in the columns that are used.  Equal rows are staged
    as any others."""

    def __init__(self, df: DataFrame, order_by, descending: bool = False, num_partitions: int | None = None, reread: bool = False):
        self.columns = df.columns
        names = ["_nf_ro_hash", "_nf_ro_row"]
        by, source = [*order_by, *names], None
        if reread:
            keys = [c.alias(f"_nf_n{i}") for i, c in enumerate(_cols(order_by))]
            for own in (F.xxhash64(*_cols(order_by)), row_hash(df)):
                narrow = staged(df.select(*keys, *[own.alias(n) for n in names]))
                if narrow.groupBy("_nf_ro_row").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
                    source, by, self.rows = narrow, narrow.columns, df.select("*", *[own.alias(n) for n in names])
                    break
        if source is None:
            source = self.rows = staged(df.withColumn("_nf_ro_hash", row_hash(df)).withColumn("_nf_ro_row", F.monotonically_increasing_id()))
        self.keys = KeyOrder(source, by, descending, num_partitions)
        self.total, self.row = self.keys.total, self.keys.names[-1]

    def positions(self, rank_col: str, first: int = 1) -> DataFrame:
        """Keys (``_nf_k0 ..``), row number (``self.row``) and position, counted from ``first``."""
        return _with_position(self.keys.staged, self.keys.offsets, rank_col, first)

    def ranked(self, rank_col: str, first: int = 1) -> DataFrame:
        """The rows with their position."""
        own = self.positions(rank_col, first).select(F.col(self.row).alias("_nf_ro_own"), F.col(rank_col).alias("_nf_ro_rank"))
        return self.rows.join(own, F.col("_nf_ro_row") == F.col("_nf_ro_own")).select(
            *[F.col(f"`{c}`") for c in self.columns if c != rank_col], F.col("_nf_ro_rank").alias(rank_col))


def join_keys(df: DataFrame, ranks: DataFrame, order_by, names) -> DataFrame:
    """``df`` with what ``ranks`` says about its key (nulls match nulls); ``ranks`` holds a key once."""
    mine = [f"{n}_own" for n in names]
    own = df.select("*", *[c.alias(m) for c, m in zip(_cols(order_by), mine)])
    cond = reduce(lambda a, b: a & b, [F.col(m).eqNullSafe(F.col(n)) for m, n in zip(mine, names)])
    return own.join(ranks, cond).drop(*mine, *names)


def global_rank(df: DataFrame, order_by, rank_col: str = "rank",
                descending: bool = False, num_partitions: int | None = None) -> DataFrame:
    """Add ``rank_col`` = 1-based position of each row in ``order_by`` order; rows with the
    same key take consecutive positions."""
    return RowOrder(df, order_by, descending, num_partitions).ranked(rank_col)


def rank_within(df: DataFrame, group_by, order_by, rank_col: str = "rank",
                descending: bool = False, reread: bool = False) -> DataFrame:
    """Add ``rank_col`` = 1-based position inside each ``group_by`` group (``reread``: see :class:`RowOrder`).

    Ranks rows globally by (group, order) - a hot group is then spread over many
    range partitions - and subtracts the rank where the group starts (one row per
    group, joined back by the group).
    """
    groups = [F.col(g) if isinstance(g, str) else g for g in group_by]
    order = RowOrder(df, [*groups, *order_by], descending, reread=reread)
    ranked = order.ranked("_nf_g")
    names = [f"_nf_s{i}" for i in range(len(groups))]
    keys = order.positions("_nf_g")     # groups start where their least position is: no row is read for it
    starts = keys.groupBy(*[F.col(k).alias(n) for k, n in zip(order.keys.names, names)]).agg(F.min("_nf_g").alias("_nf_lo"))
    cond = [g.eqNullSafe(F.col(n)) for g, n in zip(groups, names)]
    return ranked.join(lookup_side(starts), cond).withColumn(rank_col, F.col("_nf_g") - F.col("_nf_lo") + 1).drop("_nf_g", "_nf_lo", *names)


def _key_struct(order_by) -> Column:
    return F.struct(*[c.alias(f"k{i}") for i, c in enumerate(_cols(order_by))])


def _lit_key(df: DataFrame, order_by, row) -> Column:
    types = df.select(_key_struct(order_by).alias("k")).schema["k"].dataType.fields
    return F.struct(*[F.lit(v).cast(t.dataType).alias(f"k{i}")
                      for i, (v, t) in enumerate(zip(row, types))])


def last_n_flag(df: DataFrame, n: int, order_by, flag: str = "is_last") -> DataFrame:
    """Add boolean ``flag``: row is among the last ``n`` rows in ``order_by`` order."""
    if n <= 0:
        return df.withColumn(flag, F.lit(False))
    return KeyOrder(df, order_by).flag(df, order_by, n, True, flag)


def first_n_flag(df: DataFrame, n: int, order_by, flag: str = "is_first") -> DataFrame:
    """Add boolean ``flag``: row is among the first ``n`` rows in ``order_by`` order."""
    if n <= 0:
        return df.withColumn(flag, F.lit(False))
    return KeyOrder(df, order_by).flag(df, order_by, n, False, flag)


def group_window(group_by, order_by) -> Window:
    """Window over a bounded group (e.g. the K classes of one row)."""
    return Window.partitionBy(*_cols(group_by)).orderBy(*_cols(order_by))


def dim_rank(df: DataFrame, order_by, rank_col: str = "rank") -> DataFrame:
    """Rank a dimension table (classes, a vocabulary) of any size: the global rank."""
    return global_rank(df, order_by, rank_col)
