"""Row caps and bounded counts."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Largest number of rows the final top-n merge may receive in one task.
SINGLE_MERGE_MAX_ROWS = 5_000_000


def _task_estimate(df: DataFrame) -> int:
    """Upper estimate of the tasks feeding the top-n, without running anything.

    (``df.rdd.getNumPartitions()`` would execute the input's shuffle stages
    under adaptive execution.) Inputs after a shuffle have at most the
    configured shuffle partitions; file scans have at least one task per file.
    """
    shuffle = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(shuffle, len(df.inputFiles()))


def limit_ordered(
    df: DataFrame,
    n: int,
    order_cols: list[str] | None = None,
    single_merge_max_rows: int = SINGLE_MERGE_MAX_ROWS,
) -> DataFrame:
    """First ``n`` rows under a total order.

    The reference capped rows without an order, so which rows survived was
    left to the scheduler. Ordering by every column (nulls last) makes the
    result a fixed multiset.

    Spark's top-n keeps ``n`` rows per task and merges them in one task,
    i.e. ``tasks x n`` rows there. When that exceeds
    ``single_merge_max_rows`` a middle level is added: tasks are grouped
    into about sqrt(tasks) groups, a row-number window with a group limit
    keeps ``n`` rows per task before the shuffle and ``n`` per group after
    it, so no task merges more than about sqrt(tasks) x ``n`` rows.
    """
    order = [F.col(c).asc_nulls_last() for c in (order_cols or df.columns)]
    tasks = _task_estimate(df)
    if tasks * n <= single_merge_max_rows:
        return df.orderBy(*order).limit(n)
    groups = max(2, math.isqrt(tasks - 1) + 1)
    by_group = Window.partitionBy("_ys_group").orderBy(*order)
    middle = (
        df.withColumn("_ys_group", F.pmod(F.spark_partition_id(), F.lit(groups)))
        .withColumn("_ys_rn", F.row_number().over(by_group))
        .filter(F.col("_ys_rn") <= n)
        .drop("_ys_group", "_ys_rn")
    )
    return middle.orderBy(*order).limit(n)


def bounded_count(df: DataFrame, n: int, alias: str = "rows") -> DataFrame:
    """``least(count(*), n)``, stopping once ``n`` rows are seen."""
    return df.limit(n).agg(F.count(F.lit(1)).alias(alias))
