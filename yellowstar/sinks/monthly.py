"""A fact table that grows by loads: any load can be run again and replaces its own rows.

Rows are partitioned by the load that brought them (``load_month``), not by
the month in the data: a monthly file holds stray trips of other months, and
replacing a pickup month would lose the strays that another file brought.
Writing a load again replaces its partition by dynamic partition overwrite.

A load counts once its marker is written, after its rows. Running it again first
takes the marker back, so no reader sees rows of two attempts, and none sees
a load that died half way. The marker carries the row count taken on the
write itself; a load of no rows is committed as empty and hides whatever an
earlier attempt left. One writer at a time per load.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.registry import folder_exists
from .observed import Measured

LOAD = "load_month"
MARKER = "rows bigint, open boolean"


def _markers(spark: SparkSession, path: str) -> DataFrame | None:
    folder = f"{path.rstrip('/')}/commits"
    if not folder_exists(spark, folder):
        return None
    return spark.read.schema(f"{MARKER}, {LOAD} string").option("basePath", folder).parquet(folder)


def _mark(spark: SparkSession, path: str, load: str, rows: int, open_: bool) -> None:
    row = spark.createDataFrame([(rows, open_)], MARKER).coalesce(1)
    row.write.mode("overwrite").parquet(f"{path.rstrip('/')}/commits/{LOAD}={load}")


def write_load(fact: DataFrame, path: str, load: str) -> int:
    """Write one load's rows, replacing those of an earlier attempt; returns their number.

    The load's name (letters, digits, ``-`` and ``_``) names its partition.
    """
    if not re.fullmatch(r"[\w-]+", load):
        raise ValueError(f"not a load name: {load!r}")
    spark = fact.sparkSession
    _mark(spark, path, load, 0, True)
    measured = Measured(fact, {"rows": F.count(F.lit(1))})
    rows = measured.df.withColumn(LOAD, F.lit(load))
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(LOAD)
    writer.parquet(f"{path.rstrip('/')}/data")
    written = measured.values()["rows"]
    _mark(spark, path, load, written, False)
    return written


def committed_loads(spark: SparkSession, path: str) -> dict[str, int]:
    """Rows of each committed load; one small row a load reaches the driver."""
    marks = _markers(spark, path)
    return {} if marks is None else {r[LOAD]: r["rows"] for r in marks.filter("not open").collect()}


def read_loads(spark: SparkSession, path: str, loads: list[str] | None = None) -> DataFrame:
    """The committed loads' rows (of ``loads`` only, if given), ``load_month`` last; other partitions are not opened."""
    committed = committed_loads(spark, path)
    wanted = [x for x, n in committed.items() if n and (loads is None or x in loads)]
    if not wanted:
        raise FileNotFoundError(f"no committed load with rows in {path!r}")
    data = f"{path.rstrip('/')}/data"
    paths = [f"{data}/{LOAD}={x}" for x in sorted(wanted)]
    # names such as 01 stay strings
    schema = T.StructType([*spark.read.parquet(paths[0]).schema.fields, T.StructField(LOAD, T.StringType())])
    return spark.read.schema(schema).option("basePath", data).parquet(*paths)
