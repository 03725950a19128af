"""The ``trips`` input: a yellow-trip-shaped view over ``lineitem`` JOIN ``orders``.

The same SQL expression text is used by Spark (``F.expr``) and by the DuckDB
oracle, so both engines see identical inputs. Every dirty case the cleaning
rules handle occurs in it: vendor 6, null/zero/fractional passenger counts,
zero and negative distances, rate code 99 and null, payment code 0 and null,
negative fares and totals, null surcharges, mixed-case column names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# (output column, SQL expression over lineitem/orders columns), in file order.
TRIPS_COLUMNS: list[tuple[str, str]] = [
    ("VendorID", "CAST(CASE WHEN l_linenumber<=3 THEN 1 WHEN l_linenumber<=6 THEN 2 ELSE 6 END AS BIGINT)"),
    ("tpep_pickup_datetime", "o_orderdate"),
    ("tpep_dropoff_datetime", "l_shipdate"),
    ("passenger_count", "CASE WHEN l_partkey%20=0 THEN NULL ELSE CAST(CAST(l_quantity AS INT)%7 AS DOUBLE) END"),
    ("trip_distance", "CAST(CASE WHEN l_partkey%25=1 THEN -1.5 WHEN l_discount=0 THEN 0.0 ELSE l_quantity*0.25 END AS DOUBLE)"),
    ("RatecodeID", "CASE WHEN l_suppkey%10=9 THEN NULL WHEN l_suppkey%10=0 THEN CAST(99 AS DOUBLE) ELSE CAST(1+l_suppkey%6 AS DOUBLE) END"),
    ("store_and_fwd_flag", "CASE WHEN l_linestatus='O' THEN 'Y' ELSE 'N' END"),
    ("PULocationID", "CAST(1+l_suppkey%265 AS BIGINT)"),
    ("DOLocationID", "CAST(1+l_partkey%265 AS BIGINT)"),
    ("payment_type", "CASE WHEN l_orderkey%50=0 THEN NULL WHEN l_orderkey%50=1 THEN CAST(0 AS BIGINT) ELSE CAST(1+l_orderkey%6 AS BIGINT) END"),
    ("fare_amount", "CAST(CASE WHEN l_returnflag='R' AND l_linenumber=1 THEN -2.5*l_quantity ELSE 2.5*l_quantity END AS DOUBLE)"),
    ("extra", "CAST(CASE WHEN l_partkey%3=0 THEN 0.5 ELSE 0.0 END AS DOUBLE)"),
    ("mta_tax", "CAST(0.5 AS DOUBLE)"),
    ("tip_amount", "CAST(l_quantity*0.5 AS DOUBLE)"),
    ("tolls_amount", "CAST(CASE WHEN l_suppkey%10=3 THEN 6.5 ELSE 0.0 END AS DOUBLE)"),
    ("improvement_surcharge", "CAST(1.0 AS DOUBLE)"),
    ("total_amount", "CAST(CASE WHEN l_returnflag='R' AND l_linenumber=1 THEN -2.0*l_quantity ELSE 3.0*l_quantity+1.5 END AS DOUBLE)"),
    ("congestion_surcharge", "CASE WHEN l_partkey%40=2 THEN NULL ELSE CAST(2.5 AS DOUBLE) END"),
    ("Airport_fee", "CAST(CASE WHEN l_suppkey%265<10 THEN 1.25 ELSE 0.0 END AS DOUBLE)"),
]

JOIN_CONDITION = "l_orderkey = o_orderkey"

# The input columns the fixture reads, with the driver tables' types. Declaring
# them skips a footer-inference job per read and prunes columns at the reader.
LINEITEM_COLUMNS = (
    "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_discount double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
)
ORDERS_COLUMNS = "o_orderkey bigint, o_orderdate timestamp_ntz"


def trips_select_sql() -> str:
    """The fixture as one SELECT over the ``lineitem`` and ``orders`` views."""
    cols = ",\n  ".join(f'{expr} AS "{name}"' for name, expr in TRIPS_COLUMNS)
    return f"SELECT\n  {cols}\nFROM lineitem JOIN orders ON {JOIN_CONDITION}"


def trips_fixture(spark: SparkSession, sf_dir: str, lineitem: DataFrame | None = None) -> DataFrame:
    """Build the fixture from the driver's parquet tables with the DataFrame API.

    ``lineitem`` may be given, e.g. as a file stream; orders are then joined
    to each micro-batch as a static table.
    """
    if lineitem is None:
        # Dealt by the join key: a file with a single row group is read by one task, and
        # everything after the join would stay there if orders is broadcast. A shuffle
        # join needs this exchange anyway.
        lineitem = spark.read.schema(LINEITEM_COLUMNS).parquet(f"{sf_dir}/lineitem.parquet").repartition("l_orderkey")
    orders = spark.read.schema(ORDERS_COLUMNS).parquet(f"{sf_dir}/orders.parquet")
    # Both sides are fact-sized at scale; the planner chooses, and a sort-merge join can spill.
    joined = lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "inner")
    return joined.select(*[F.expr(expr).alias(name) for name, expr in TRIPS_COLUMNS])
