"""Deterministic dense surrogate keys.

A key is the 0-based rank of the natural key among the distinct natural
keys, nulls last, as a bigint. It does not depend on partitioning, input
order or the number of tasks, so a dimension written by one job and a fact
table built by another always agree (the reference's
``monotonically_increasing_id`` keys do not).

Two physical paths compute the same numbers:

* ``window`` -- one ``row_number`` over a global order. All rows meet in
  one task, so it is only used when the caller proves a small bound on the
  number of distinct keys (a code domain enforced by a filter).
* ``ranged`` -- any size. Keys are range-partitioned and sorted inside each
  partition; each row's position inside its partition is frozen in a
  reliable checkpoint; per-partition counts (one row per partition) give
  prefix offsets which are broadcast back. No task ever holds more than
  one range partition, and the data never passes through the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

# Largest proven key count handled by the single-task window path.
WINDOW_PATH_MAX_ROWS = 10_000

PART = "_ys_part"
POS = "_ys_pos"


def _order(col: str) -> Column:
    return F.col(col).asc_nulls_last()


def window_dense_key(keys: DataFrame, col: str, key_name: str) -> DataFrame:
    """Dense key for a proven-small set of distinct keys (single task)."""
    w = Window.orderBy(_order(col))
    return keys.select(col, (F.row_number().over(w) - 1).cast("long").alias(key_name))


def ranged_dense_key(keys: DataFrame, col: str, key_name: str) -> tuple[DataFrame, DataFrame]:
    """Dense key for any number of distinct keys.

    Returns ``(dimension, partition_counts)``; the second frame has one row
    per range partition and is what the row count of the dimension is read
    from.
    """
    spark = keys.sparkSession
    ensure_checkpoint_dir(spark)
    ranged = keys.repartitionByRange(_order(col)).sortWithinPartitions(_order(col))
    pid = F.spark_partition_id()
    indexed = ranged.select(
        col,
        pid.alias(PART),
        (F.monotonically_increasing_id() - F.shiftleft(pid.cast("long"), 33)).alias(POS),
    )
    # Freeze partition ids and in-partition positions: every later read sees
    # exactly these values, even after an executor is lost.
    indexed = indexed.checkpoint(eager=True)
    counts = indexed.groupBy(PART).agg(F.count(F.lit(1)).alias("rows"))
    before = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(PART, F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("_ys_offset"))
    dim = indexed.join(F.broadcast(offsets), PART).select(
        col, (F.col("_ys_offset") + F.col(POS)).cast("long").alias(key_name)
    )
    return dim, counts


def dense_key(keys: DataFrame, col: str, key_name: str, max_rows: int | None = None) -> DataFrame:
    """Attach ``key_name`` = dense rank of ``col`` (nulls last) to distinct ``keys``.

    ``max_rows`` is a proven upper bound on the number of rows; when given
    and small the single-task window path is used, otherwise the ranged one.
    """
    if max_rows is not None and max_rows <= WINDOW_PATH_MAX_ROWS:
        return window_dense_key(keys, col, key_name)
    return ranged_dense_key(keys, col, key_name)[0]

