"""Profiling: counts, value counts, cardinalities, conditional counts.

Every profile is one aggregate over one scan: partial aggregation runs in
each task and only per-task partial results are shuffled, so no value, not
even one shared by a third of all rows, concentrates in a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def row_count(df: DataFrame, alias: str = "rows") -> DataFrame:
    """Number of rows as a one-row frame."""
    return df.agg(F.count(F.lit(1)).alias(alias))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """``(value, count)`` per distinct value, null included."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Distinct values of one column, null included (E5)."""
    return df.select(col).distinct()


def count_where(df: DataFrame, **conditions: Column) -> DataFrame:
    """One row, one ``count_if`` column per named condition."""
    return df.agg(*[F.count_if(cond).alias(name) for name, cond in conditions.items()])


def cardinality_profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """Per column: distinct values counting null as a value, and null presence.

    Output ``(column, n_distinct, has_null)``. The reference collected each
    distinct list to the driver; here only the counts leave the executors
    (the values themselves are ``value_counts``).
    """
    aggs = []
    for c in cols:
        aggs.append(F.count_distinct(F.col(c)).alias(f"{c}__d"))
        aggs.append(F.max(F.col(c).isNull()).alias(f"{c}__n"))
    one = df.agg(*aggs)
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            (F.col(f"{c}__d") + F.col(f"{c}__n").cast("long")).alias("n_distinct"),
            F.col(f"{c}__n").alias("has_null"),
        )
        for c in cols
    ]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def value_lists(df: DataFrame, cols: list[str]) -> DataFrame:
    """Every distinct value (as a string) of each column with its row count.

    Output ``(column, value, rows)``, one row per value, null included. One
    scan and one partial aggregate; no list is gathered, so columns of any
    cardinality are listed whole.
    """
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols])
    )
    return df.select(pairs.alias("p")).groupBy("p.column", "p.value").agg(F.count(F.lit(1)).alias("rows"))


def schema_rows(df: DataFrame) -> DataFrame:
    """``(column, type)`` rows of a frame's schema (C18); metadata, not data."""
    spark = SparkSession.active()
    return spark.createDataFrame(
        [(f.name, f.dataType.simpleString()) for f in df.schema.fields], "column string, type string"
    )


def table_sizes(tables: dict[str, DataFrame]) -> DataFrame:
    """``(table, rows)`` for several frames in one job."""
    out = None
    for name, df in tables.items():
        part = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
        out = part if out is None else out.unionByName(part)
    return out
