"""Counts taken on a pass that runs anyway: row counts and the cleaning funnel on the write.

``DataFrame.observe`` adds aggregates to a frame; Spark evaluates them while
the frame is written. Spark counts each task of a job's last stage once, also
when tasks are retried or run twice; a stage before an exchange can be
counted again when an executor is lost. So a measure is taken from the pass
only where no exchange lies above it, and by a query of its own otherwise:
both give the same, exact, counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.cleaning import STAGE_NAMES, clean_trips, funnel_counts
from .writers import write_parquet


class Measured:
    """``df`` with aggregates that are evaluated by the action that reads it.

    Use ``.df`` in place of ``df`` in one write, then read ``.values()``.
    """

    def __init__(self, df: DataFrame, measures: dict[str, Column]):
        self.source, self.measures = df, measures
        self.observation = Observation()
        self.df = df.observe(self.observation, *[c.alias(name) for name, c in measures.items()])

    def values(self) -> dict[str, int]:
        """The counts of the write that has ended."""
        return {name: self.observation.get[name] for name in self.measures}

    def recount(self) -> dict[str, int]:
        """The same counts by a query of their own."""
        return self.source.agg(*[c.alias(name) for name, c in self.measures.items()]).first().asDict()


def counted_once(written: DataFrame) -> bool:
    """Whether the plan of ``written`` has no exchange above its observed metrics."""
    from ..plans.inspect import plan_text

    tree = plan_text(written, "simple").split("== Physical Plan ==")[-1]
    above = tree.split("CollectMetrics", 1)[0]
    # a broadcast beside the observed branch runs in a job of its own
    return "CollectMetrics" in tree and not any(
        "Exchange" in line and "BroadcastExchange" not in line for line in above.splitlines()
    )


def funnel_rows(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    """``(step, stage, rows)`` as ``cleaning_funnel`` gives them."""
    return spark.createDataFrame([(i, name, counts[name]) for i, name in enumerate(STAGE_NAMES)], "step int, stage string, rows bigint")


def size_rows(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    """``(table, rows)`` as ``table_sizes`` gives them."""
    return spark.createDataFrame(list(counts.items()), "table string, rows bigint")


class MeasuredFunnel:
    """Raw trips that count their cleaning funnel while something made from them is written."""

    def __init__(self, raw: DataFrame):
        lowered, measures = funnel_counts(raw)
        self.measured = Measured(lowered, measures)
        #: in place of the raw trips; without the implied prefilter, which would hide rows from the counts
        self.raw = self.measured.df

    def clean(self) -> DataFrame:
        return clean_trips(self.raw, pushdown=False)

    def rows(self, written: DataFrame) -> DataFrame:
        """The funnel after ``written`` (made from ``raw``) has been written."""
        counts = self.measured.values() if counted_once(written) else self.measured.recount()
        return funnel_rows(written.sparkSession, counts)


def write_clean(raw: DataFrame, path: str) -> DataFrame:
    """Write the cleaned trips and return their funnel, both from one scan of ``raw``."""
    funnel = MeasuredFunnel(raw)
    clean = funnel.clean()
    write_parquet(clean, path)
    return funnel.rows(clean)


def write_tables(tables: dict[str, DataFrame], write_one) -> DataFrame:
    """Write tables in order with ``write_one(name, df)``; returns ``(table, rows)`` as written."""
    counts, spark = {}, None
    for name, df in tables.items():
        measured = Measured(df, {"rows": F.count(F.lit(1))})
        write_one(name, measured.df)
        # observed on top of the frame: the last stage by construction
        counts[name], spark = measured.values()["rows"], df.sparkSession
    return size_rows(spark, counts)
