"""Declared schemas, column lists and code tables of the trip star schema."""

from __future__ import annotations

from pyspark.sql import types as T

# --- source schemas -------------------------------------------------------
# The declared yellow and green trip layouts (column names and
# types as the data dictionary gives them; names here lower-cased, since
# conform() matches case-insensitively).

YELLOW_TRIPS = T.StructType(
    [
        T.StructField("vendorid", T.LongType()),
        T.StructField("tpep_pickup_datetime", T.TimestampNTZType()),
        T.StructField("tpep_dropoff_datetime", T.TimestampNTZType()),
        T.StructField("passenger_count", T.LongType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("ratecodeid", T.LongType()),
        T.StructField("store_and_fwd_flag", T.StringType()),
        T.StructField("pulocationid", T.IntegerType()),
        T.StructField("dolocationid", T.IntegerType()),
        T.StructField("payment_type", T.LongType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("extra", T.DoubleType()),
        T.StructField("mta_tax", T.DoubleType()),
        T.StructField("tip_amount", T.DoubleType()),
        T.StructField("tolls_amount", T.DoubleType()),
        T.StructField("improvement_surcharge", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("congestion_surcharge", T.DoubleType()),
        T.StructField("airport_fee", T.DoubleType()),
    ]
)

GREEN_TRIPS = T.StructType(
    [
        T.StructField("vendorid", T.IntegerType()),
        T.StructField("lpep_pickup_datetime", T.TimestampNTZType()),
        T.StructField("lpep_dropoff_datetime", T.TimestampNTZType()),
        T.StructField("store_and_fwd_flag", T.StringType()),
        T.StructField("ratecodeid", T.LongType()),
        T.StructField("pulocationid", T.IntegerType()),
        T.StructField("dolocationid", T.IntegerType()),
        T.StructField("passenger_count", T.LongType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("extra", T.DoubleType()),
        T.StructField("mta_tax", T.DoubleType()),
        T.StructField("tip_amount", T.DoubleType()),
        T.StructField("tolls_amount", T.DoubleType()),
        T.StructField("ehail_fee", T.DoubleType()),
        T.StructField("improvement_surcharge", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("payment_type", T.LongType()),
        T.StructField("trip_type", T.LongType()),
        T.StructField("congestion_surcharge", T.DoubleType()),
    ]
)

PICKUP = "tpep_pickup_datetime"
DROPOFF = "tpep_dropoff_datetime"

# The money columns that must all be non-negative for
# errordata = 'n'.
MONEY_COLUMNS = [
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "total_amount",
    "congestion_surcharge",
    "airport_fee",
]

# The fact table's columns in load order.
FACT_COLUMNS = [
    "vendor_key",
    "putime_key",
    "dotime_key",
    "passenger_count",
    "trip_distance",
    "ratecode_key",
    "store_and_fwd_flag",
    "puzone_key",
    "dozone_key",
    "paymenttype_key",
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "total_amount",
    "congestion_surcharge",
    "airport_fee",
    "errordata",
]

# --- code tables ------------------------------------------------------------
# These labels must equal the reference's data dictionary.
VENDOR_NAMES = {
    1: "Creative Mobile Technologies, LLC",
    2: "VeriFone Inc.",
}
PAYMENT_TYPES = {
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}
RATE_CODES = {
    1: "Standard rate",
    2: "JFK",
    3: "Newark",
    4: "Nassau or Westchester",
    5: "Negotiated fare",
    6: "Group ride",
}

# Table names in load order (dimensions first, then the fact table).
DIMENSION_TABLES = [
    "vendor_DIM",
    "datetime_DIM",
    "taxizone_DIM",
    "paymenttype_DIM",
    "ratecode_DIM",
]
FACT_TABLE = "fact_table"
