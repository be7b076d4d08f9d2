"""Exact, skew-safe row numbering and running totals without a single-task window.

``row_number() OVER (PARTITION BY k ORDER BY o)`` puts every row of a key into one task, and
without a PARTITION BY it puts the whole table into one task.  Here the table is sorted by
``(k, o)``, a hash of the row and, for copies of a row, their number, so that neither a key nor a
value that a third of the rows have stays in one range partition.  All sort keys are values of the
row: a task that runs again after a lost executor sends each row to the same range.  Then

1. ``monotonically_increasing_id`` gives each sorted row its partition and place in it (in the
   same stage as the sort), and the result is written once to the shared checkpoint folder,
   which pins one partitioning for the uses below and survives lost executors;
2. a running sum over one row per partition gives each partition's offset;
3. a key's first position, a partial aggregate, turns global into per-key positions.

There is one path for tables and groups of every size, and no Python in the tasks.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import delete_path, ensure_checkpoint_dir, shuffles_deleted

_PID, _AT, _TIE = "__seq_pid", "__seq_at", "__seq_tie"


def pin(df: DataFrame, prefix: str = "pinned") -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back (cuts lineage,
    fixes nondeterministic partitioning, survives executor loss).  Its shuffles go, as later jobs read what is written."""
    root = ensure_checkpoint_dir(df.sparkSession).rstrip("/")
    path = f"{root}/{prefix}/{uuid.uuid4().hex}"
    with shuffles_deleted(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def unpin(df: DataFrame) -> None:
    """Deletes what ``pin`` wrote, when no later job reads it."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        delete_path(df.sparkSession, folder)


def _numbered_copies(df: DataFrame) -> DataFrame:
    """Adds ``_TIE``, the number of a row among its copies in one partition of ``df``.

    Copies are counted by partition, so a row that a third of the table repeats is many groups; which
    copy gets which number doesn't matter, and the set of numbered rows is the same in every run."""
    counted = df.withColumn(_PID, F.spark_partition_id()).groupBy(*df.columns, _PID).agg(F.count(F.lit(1)).alias("__copies"))
    return counted.withColumn(_TIE, F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies")))) \
        .withColumn(_TIE, F.col(_TIE) * (1 << 24) + F.col(_PID)).drop(_PID, "__copies")


def _sorted(df: DataFrame, order_by: list[str], keys: list[str]) -> DataFrame:
    """Globally sorted rows with their partition and place in it, written once."""
    order = [F.col(c).asc_nulls_first() for c in [*keys, *order_by]]
    ties = [F.xxhash64(*[c for c in df.columns if c != _TIE])] + ([F.col(_TIE)] if _TIE in df.columns else [])
    place = F.monotonically_increasing_id()
    return pin(df.orderBy(*order, *ties).drop(_TIE)
                 .withColumn(_AT, place).withColumn(_PID, F.shiftright(_AT, 33))
                 .withColumn(_AT, F.col(_AT).bitwiseAND(F.lit((1 << 33) - 1))), "sequence")


def _with_offset(placed: DataFrame, size: F.Column) -> DataFrame:
    """Adds ``_before``: ``size`` summed over the earlier partitions (one row per partition)."""
    per = placed.groupBy(_PID).agg(size.alias("_size"))
    before = per.select(F.col(_PID).alias("_p"), (F.sum("_size").over(Window.orderBy(_PID)) - F.col("_size")).alias("_before"))
    return placed.join(F.broadcast(before), F.col(_PID) == F.col("_p")).drop("_p")


def _within_key(df: DataFrame, keys: list[str], begin: F.Column, position: str) -> DataFrame:
    """``position`` less the smallest ``begin`` of the row's key."""
    if not keys:
        return df
    first = df.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(F.min(begin).alias("_first"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return df.join(first, same).withColumn(position, F.col(position) - F.col("_first")) \
        .drop("_first", *[f"_k_{k}" for k in keys])


def exact_sequence(df: DataFrame, order_by: list[str], partition_by: list[str] | tuple = (),
                   out: str = "seq") -> DataFrame:
    """Append ``out`` = 1-based position of each row in ``order_by`` order, restarting
    for every ``partition_by`` group (global position when no group columns).

    ``order_by`` should make the order total (ties are numbered arbitrarily but
    consistently, as in ``row_number``)."""
    placed = _with_offset(_sorted(_numbered_copies(df), list(order_by), list(partition_by)), F.count(F.lit(1)))
    placed = placed.withColumn(out, F.col("_before") + F.col(_AT)).drop("_before", _PID, _AT)
    return _within_key(placed, list(partition_by), F.col(out), out).withColumn(out, F.col(out) + 1)


def running_total(df: DataFrame, order_by: list[str], weight: str, partition_by: list[str] | tuple = (),
                  out: str = "total") -> DataFrame:
    """Append ``out`` = sum of ``weight`` up to and including each row in ``order_by`` order, restarting
    for every ``partition_by`` group.  Meant for pre-aggregated rows: one per group and value."""
    placed = _sorted(df, list(order_by), list(partition_by))
    placed = _with_offset(placed, F.sum(weight))
    # a range partition's rows, which one task already held to sort them
    local = F.sum(weight).over(Window.partitionBy(_PID).orderBy(_AT))
    placed = placed.withColumn(out, F.col("_before") + local).drop("_before", _PID, _AT)
    return _within_key(placed, list(partition_by), F.col(out) - F.col(weight), out)
