"""Incremental cleaning of newly landed trip files (K2 over a file stream).

The reference re-runs monthly and skips files that already landed. The
Spark form of that schedule is a file-source stream run with
``trigger(availableNow=True)``: each run processes exactly the files not
yet recorded in the stream's checkpoint (the skip-existing rule, kept by
Spark's commit log), applies the same stateless cleaning as the batch
job, appends the cleaned rows and stops. A lost executor replays only its
micro-batch; the checkpoint lives under the shared checkpoint folder.

Dense dimension keys are a global rank over all data, so they are not
maintained by the stream; the batch pipeline rebuilds them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.cleaning import clean_trips
from ..schemas import YELLOW_TRIPS


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def landed_files_stream(
    spark: SparkSession,
    landing_dir: str,
    schema: T.StructType = YELLOW_TRIPS,
    glob: str = "*",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Stream of rows from parquet files as they land, whatever their names
    (hidden files aside); column names are matched case-insensitively."""
    reader = spark.readStream.schema(_nullable(schema)).option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(landing_dir)


def default_checkpoint(output_path: str) -> str:
    """Checkpoint folder that belongs to an output table: its sibling of the same name."""
    return f"{output_path.rstrip('/')}__checkpoint"


def start_clean_stream(
    raw_stream: DataFrame,
    output_path: str,
    checkpoint_location: str | None = None,
    available_now: bool = True,
    transform: Callable[[DataFrame], DataFrame] = clean_trips,
    processing_time: str = "1 minute",
) -> StreamingQuery:
    """Append ``transform(raw_stream)`` to a parquet table; returns the running query.

    Without ``checkpoint_location`` the checkpoint lies beside the output, so
    that the next run into the same table goes on where this one ended.
    """
    checkpoint_location = checkpoint_location or default_checkpoint(output_path)
    writer = (
        transform(raw_stream)
        .writeStream.format("parquet")
        .option("path", output_path)
        .option("checkpointLocation", checkpoint_location)
        .outputMode("append")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()


def land_clean_trips(
    spark: SparkSession,
    landing_dir: str,
    output_path: str,
    checkpoint_location: str | None = None,
    schema: T.StructType = YELLOW_TRIPS,
) -> StreamingQuery:
    """One scheduled run: clean every file landed since the previous run, then stop."""
    stream = landed_files_stream(spark, landing_dir, schema)
    query = start_clean_stream(stream, output_path, checkpoint_location, available_now=True)
    query.awaitTermination()
    return query
