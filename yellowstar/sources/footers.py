"""Counts and extreme values from parquet footers, without reading a column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _footer_session(spark: SparkSession) -> SparkSession:
    """A session beside ``spark`` (same cluster, settings of its own) whose parquet reads push aggregates down."""
    own = spark.newSession()
    for key in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions"):
        own.conf.set(key, spark.conf.get(key))
    # the reader that can answer an aggregate from the footers
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own


def footer_counts(spark: SparkSession, *paths: str, columns: tuple[str, ...] = ()) -> DataFrame:
    """One row: ``rows``, and per column ``{c}_values`` (non-null), ``{c}_min``, ``{c}_max``, from footers only.

    Tasks read the files' last bytes; the work grows with files and row groups,
    not with rows. Columns may be whole numbers, dates and booleans: footers may cut
    extreme values of other types, and Spark then reads the column instead.
    """
    df = _footer_session(spark).read.parquet(*paths)
    aggs = [F.count(F.lit(1)).alias("rows")]
    for c in columns:
        aggs += [F.count(c).alias(f"{c}_values"), F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max")]
    return df.agg(*aggs)
