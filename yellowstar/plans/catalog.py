"""The query catalogue: one Spark job per operator of the survey inventory.

Every entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
driver's tables (the ``trips`` fixture is lineitem JOIN orders). Column
names match the DuckDB oracle in ``plans.oracle`` exactly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import (
    all_non_negative,
    fare_sign_flag,
    indicator,
    invalid_location,
    lower_names,
    lower_values,
    payment_description,
    ratecode_description,
    to_double,
    to_float,
    to_int,
    vendor_name,
)
from ..operators import (
    bounded_count,
    build_dimensions,
    build_fact,
    cardinality_profile,
    clean_trips,
    cleaning_funnel,
    column_sketches,
    count_where,
    distinct_values,
    join_role,
    key_integrity,
    limit_ordered,
    merged_cardinality,
    ranged_dense_key,
    row_count,
    stage_frames,
    table_sizes,
    value_counts,
    value_lists,
)
from ..operators.dimensions import DIMENSION_BUILDERS, SPECS
from ..operators.facts import ROLES
from ..schemas import MONEY_COLUMNS, YELLOW_TRIPS
from ..session import scratch_path
from ..sources import (
    conform,
    file_names,
    footer_counts,
    list_data_files,
    load_trips,
    nested_page_links,
    new_files,
    page_links,
    read_parquet,
    read_saved,
    trips_fixture,
    union_by_name,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return register


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lower_names(trips_fixture(spark, sf_dir))


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_trips(trips_fixture(spark, sf_dir))


# --- sources -----------------------------------------------------------------


@query("parquet_scan_orders")
def parquet_scan_orders(spark, sf_dir):
    return read_parquet(spark, *list_data_files(spark, sf_dir, glob="orders.parquet"))


@query("multi_file_union")
def multi_file_union(spark, sf_dir):
    # Two "monthly files" of one table whose second copy has drifted: upper
    # case names, reversed column order. They must line up by name.
    first = read_parquet(spark, f"{sf_dir}/orders.parquet")
    drifted = first.select(*[F.col(c).alias(c.upper()) for c in reversed(first.columns)])
    return union_by_name([first, drifted], schema=first.schema)


@query("conform_schema")
def conform_schema(spark, sf_dir):
    return conform(trips_fixture(spark, sf_dir), YELLOW_TRIPS)


# --- projections, flags, casts ----------------------------------------------


@query("when_indicator")
def when_indicator(spark, sf_dir):
    clean = _clean(spark, sf_dir)
    return value_counts(clean.select(indicator(F.col("store_and_fwd_flag") == "y").alias("test")), "test")


@query("trips_row_count")
def trips_row_count(spark, sf_dir):
    return row_count(trips_fixture(spark, sf_dir))


@query("cast_columns")
def cast_columns(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    return raw.select(
        to_int("vendorid").alias("vendorid"),
        to_int("passenger_count").alias("passenger_count"),
        to_float("trip_distance").alias("trip_distance"),
        to_int("pulocationid").alias("pulocationid"),
        to_int("dolocationid").alias("dolocationid"),
        to_int("ratecodeid").alias("ratecodeid"),
        to_double("fare_amount").alias("fare_amount"),
    )


@query("lower_flag")
def lower_flag(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    return value_counts(raw.select(lower_values("store_and_fwd_flag").alias("store_and_fwd_flag")), "store_and_fwd_flag")


@query("fare_sign_flag")
def fare_sign(spark, sf_dir):
    return value_counts(_clean(spark, sf_dir).select(fare_sign_flag("fare_amount").alias("fare_sign")), "fare_sign")


@query("quality_flag")
def quality(spark, sf_dir):
    return value_counts(_clean(spark, sf_dir), "errordata")


# --- filters and conditional counts ----------------------------------------


def _stage(name: str) -> Query:
    return lambda spark, sf_dir: stage_frames(trips_fixture(spark, sf_dir))[name]


QUERIES["filter_vendor"] = _stage("vendor")
QUERIES["filter_passengers"] = _stage("passenger_positive")
QUERIES["filter_distance"] = _stage("distance")
QUERIES["filter_ratecode"] = _stage("ratecode")


@query("count_zero_distance")
def count_zero_distance(spark, sf_dir):
    frame = stage_frames(trips_fixture(spark, sf_dir))["passenger_positive"]
    return count_where(frame, zero_distance=F.col("trip_distance") == 0)


@query("count_bad_locations")
def count_bad_locations(spark, sf_dir):
    frame = stage_frames(trips_fixture(spark, sf_dir))["distance"]
    return count_where(
        frame, bad_pickup=invalid_location("pulocationid"), bad_dropoff=invalid_location("dolocationid")
    )


@query("count_negative_fare")
def count_negative_fare(spark, sf_dir):
    frame = stage_frames(trips_fixture(spark, sf_dir))["ratecode"]
    return count_where(frame, negative_fares=F.col("fare_amount") < 0)


@query("count_nonneg_eight")
def count_nonneg_eight(spark, sf_dir):
    eight = [c for c in MONEY_COLUMNS if c != "fare_amount"]
    return count_where(_clean(spark, sf_dir), nonneg_rows=all_non_negative(eight))


# --- profiling ----------------------------------------------------------------


@query("cleaning_funnel")
def funnel(spark, sf_dir):
    return cleaning_funnel(trips_fixture(spark, sf_dir))


def _value_counts(col: str) -> Query:
    return lambda spark, sf_dir: value_counts(_clean(spark, sf_dir), col)


for _col in ["passenger_count", "store_and_fwd_flag", "payment_type", "extra", "mta_tax"]:
    QUERIES[f"value_counts_{_col}"] = _value_counts(_col)

@query("value_counts_passenger_count_raw")
def passenger_counts_before_cleaning(spark, sf_dir):
    # as profiled before the passenger stage: after the vendor filter, raw values
    frame = stage_frames(trips_fixture(spark, sf_dir))["vendor"]
    return value_counts(frame, "passenger_count")


@query("value_counts_store_and_fwd_flag_raw")
def flag_counts_before_lowering(spark, sf_dir):
    # as profiled after the last filter stage, before values are lower-cased
    frame = stage_frames(trips_fixture(spark, sf_dir))["ratecode"]
    return value_counts(frame, "store_and_fwd_flag")


@query("distinct_vendor_raw")
def distinct_vendor_raw(spark, sf_dir):
    return distinct_values(_raw(spark, sf_dir), "vendorid")


CARDINALITY_COLUMNS = ["vendorid", "passenger_count", "ratecodeid", "store_and_fwd_flag", "payment_type", "airport_fee"]


@query("cardinality_profile")
def cardinality(spark, sf_dir):
    return cardinality_profile(_raw(spark, sf_dir), CARDINALITY_COLUMNS)


@query("value_lists_profile")
def value_lists_profile(spark, sf_dir):
    """The notebook's distinct-value listing of six columns, and of one with thousands of values."""
    return value_lists(_raw(spark, sf_dir), [*CARDINALITY_COLUMNS, "pulocationid"])


@query("clean_trips")
def clean(spark, sf_dir):
    return _clean(spark, sf_dir)


# --- code labels and dimensions -------------------------------------------------


@query("code_label_vendor")
def code_label_vendor(spark, sf_dir):
    counts = value_counts(_clean(spark, sf_dir), "vendorid")
    return counts.withColumn("vendor_name", vendor_name("vendorid"))


@query("code_label_payment")
def code_label_payment(spark, sf_dir):
    counts = value_counts(_clean(spark, sf_dir), "payment_type")
    return counts.withColumn("description", payment_description("payment_type"))


@query("code_label_ratecode")
def code_label_ratecode(spark, sf_dir):
    counts = value_counts(_clean(spark, sf_dir), "ratecodeid")
    return counts.withColumn("description", ratecode_description("ratecodeid"))


def _dim(table: str) -> Query:
    return lambda spark, sf_dir: DIMENSION_BUILDERS[table](_clean(spark, sf_dir)).df


QUERIES["dim_vendor"] = _dim("vendor_DIM")
QUERIES["dim_datetime"] = _dim("datetime_DIM")
QUERIES["dim_taxizone"] = _dim("taxizone_DIM")
QUERIES["dim_paymenttype"] = _dim("paymenttype_DIM")
QUERIES["dim_ratecode"] = _dim("ratecode_DIM")


# --- joins and the fact table ---------------------------------------------------

SINGLE_JOINS = {
    "fact_join_pickup_time": ("datetime_DIM", "tpep_pickup_datetime", "putime_key"),
    "fact_join_dropoff_time": ("datetime_DIM", "tpep_dropoff_datetime", "dotime_key"),
    "fact_join_vendor": ("vendor_DIM", "vendorid", "vendor_key"),
    "fact_join_ratecode": ("ratecode_DIM", "ratecodeid", "ratecode_key"),
    "fact_join_pickup_zone": ("taxizone_DIM", "pulocationid", "puzone_key"),
    "fact_join_dropoff_zone": ("taxizone_DIM", "dolocationid", "dozone_key"),
    "fact_join_payment": ("paymenttype_DIM", "payment_type", "paymenttype_key"),
}


def _single_join(table: str, fact_col: str, role_key: str) -> Query:
    def run(spark, sf_dir):
        clean = _clean(spark, sf_dir)
        return join_role(clean, DIMENSION_BUILDERS[table](clean), fact_col, role_key)

    return run


for _name, (_table, _fact_col, _role_key) in SINGLE_JOINS.items():
    QUERIES[_name] = _single_join(_table, _fact_col, _role_key)


def fact_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = _clean(spark, sf_dir)
    return build_fact(clean, build_dimensions(clean))


QUERIES["fact_table"] = fact_table


@query("fact_table_shuffle_join")
def fact_table_at_scale(spark, sf_dir):
    """The fact table with the plan used when dimensions outgrow a broadcast:
    every key ranked by the range-partitioned path, every join a shuffle join."""
    clean = _clean(spark, sf_dir)
    dims = build_dimensions(clean, window_max_rows=0, block_rows=0)
    return build_fact(clean, dims, broadcast_rows=0, block_rows=0)


@query("fact_table_hot_split")
def fact_table_hot_keys(spark, sf_dir):
    """The shuffle-join plan with hot-value splitting engaged: every natural-key
    value holding at least 1 000 trips is joined map-side, the rest shuffled."""
    clean = _clean(spark, sf_dir)
    dims = build_dimensions(clean, window_max_rows=0, hot_key_rows=1_000, block_rows=0)
    return build_fact(clean, dims, broadcast_rows=0, block_rows=0)


@query("fact_table_block_lookup")
def fact_table_blocks(spark, sf_dir):
    """The fact table with every dimension treated as too big to broadcast,
    resolved through broadcast block lookups (map-side, no shuffle of trips)."""
    clean = _clean(spark, sf_dir)
    return build_fact(clean, build_dimensions(clean, window_max_rows=0), broadcast_rows=0)


@query("dense_key_ranged")
def dense_key_ranged(spark, sf_dir):
    """Dense key over a large natural-key set (distinct extended prices)."""
    prices = read_parquet(spark, f"{sf_dir}/lineitem.parquet").select("l_extendedprice").distinct()
    return ranged_dense_key(prices, "l_extendedprice", "price_key")[0]


@query("dense_key_blocks")
def dense_key_blocks(spark, sf_dir):
    """Dense key over a large integer key set (distinct order keys), from blocks."""
    from ..operators.blocks import block_dense_key

    orders = read_parquet(spark, f"{sf_dir}/lineitem.parquet").select("l_orderkey").distinct()
    return block_dense_key(orders, "l_orderkey", "order_key")[0]


@query("dim_sizes")
def dim_sizes(spark, sf_dir):
    dims = build_dimensions(_clean(spark, sf_dir))
    return table_sizes({name: d.df for name, d in dims.items()})


@query("limit_ordered")
def limit_rows(spark, sf_dir):
    # The reference's 10 000-row cap, here over a total order.
    return limit_ordered(_raw(spark, sf_dir), 10_000)


@query("limit_bounded_count")
def limit_count(spark, sf_dir):
    return bounded_count(fact_table(spark, sf_dir), 100)


@query("parquet_roundtrip")
def parquet_roundtrip(spark, sf_dir):
    from ..sinks import write_parquet

    dim = DIMENSION_BUILDERS["taxizone_DIM"](_clean(spark, sf_dir))
    path = scratch_path(spark, "taxizone_DIM")
    write_parquet(dim.df, path)
    return read_saved(spark, path)


# --- ingest -------------------------------------------------------------------------

LINK_WORD = "th"


@query("page_links")
def links(spark, sf_dir):
    return page_links(read_parquet(spark, f"{sf_dir}/pages.parquet"), word=LINK_WORD)


@query("new_files")
def files_to_land(spark, sf_dir):
    discovered = page_links(read_parquet(spark, f"{sf_dir}/pages.parquet"), word=LINK_WORD)
    listing = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(sf_dir)
    return new_files(discovered, landed=file_names(listing.select("path")))


@query("streaming_clean_trips")
def streaming_clean(spark, sf_dir):
    """Cleaned trips produced by the incremental (availableNow) stream job:
    lineitem files stream in, orders join as a static table, the output is
    appended to a parquet table that is read back."""
    from ..streaming import start_clean_stream

    schema = spark.read.parquet(f"{sf_dir}/lineitem.parquet").schema
    lines = spark.readStream.schema(schema).option("pathGlobFilter", "lineitem.parquet").parquet(sf_dir)
    out = scratch_path(spark, "clean-stream")
    q = start_clean_stream(
        lines, out, transform=lambda s: clean_trips(trips_fixture(spark, sf_dir, lineitem=s))
    )
    q.awaitTermination()
    return read_saved(spark, out)


@query("key_integrity")
def integrity(spark, sf_dir):
    clean = _clean(spark, sf_dir)
    return key_integrity(clean, build_dimensions(clean))


# --- growing star schema, counts on the write, many files ----------------------------------

FIRST_HALF = "coalesce({} < TIMESTAMP_NTZ '1998-05-01 00:00:00', false)"


def _halves(df: DataFrame, col: str) -> list[DataFrame]:
    """Stand-ins for two loads: the rows before a date, and all others."""
    first = FIRST_HALF.format(col)
    return [df.filter(first), df.filter(f"not {first}")]


@query("stable_keys")
def stable_keys(spark, sf_dir):
    """Keys of all distinct extended prices, registered from two halves of lineitem one after the
    other: the second load adds keys above the first one's and changes none; a repeated load adds none."""
    from ..operators.dimensions import DimSpec
    from ..operators.registry import KeyRegistry

    lines = read_parquet(spark, f"{sf_dir}/lineitem.parquet")
    spec = DimSpec("price_DIM", "l_extendedprice", "price_key", ("l_extendedprice",))
    book = KeyRegistry(spark, scratch_path(spark, "price-keys"), spec, lines.schema["l_extendedprice"].dataType)
    first, second = _halves(lines, "l_shipdate")
    for load, part in (("first", first), ("second", second), ("second", second)):
        book.add(part.select("l_extendedprice").distinct(), load)
    return book.members()


def _grown(spark, sf_dir):
    """A star schema grown by two loads, the second of which is run twice: the first
    attempt brings only some of its trips, as a file that is corrected later would."""
    from ..pipeline import run_load

    first, second = _halves(trips_fixture(spark, sf_dir), "tpep_pickup_datetime")
    base = scratch_path(spark, "growing-star")
    run_load(spark, first, base, "2023-01")
    run_load(spark, second.filter(F.col("VendorID") == 1), base, "2023-02")
    run_load(spark, second, base, "2023-02")
    return base


@query("monthly_rewrite")
def monthly_rewrite(spark, sf_dir):
    """The fact table of the grown star, with natural keys looked up again in the registries."""
    from ..pipeline import read_star

    clean = _clean(spark, sf_dir)
    star = read_star(spark, _grown(spark, sf_dir), clean)
    out = star["fact_table"]
    for role in ROLES:
        spec = SPECS[role.dimension]
        names = star[role.dimension].select(F.col(spec.key).alias(role.key), F.col(spec.natural).alias(role.fact_col))
        out = out.join(names, role.key).drop(role.key)
    return out


@query("observed_funnel")
def observed_funnel(spark, sf_dir):
    """The cleaning funnel as counted while the cleaned trips are written."""
    from ..sinks import write_clean

    return write_clean(trips_fixture(spark, sf_dir), scratch_path(spark, "clean-trips"))


@query("observed_sizes")
def observed_sizes(spark, sf_dir):
    """Rows of the six tables as counted while the whole pipeline writes them."""
    from ..pipeline import run_pipeline

    return run_pipeline(spark, trips_fixture(spark, sf_dir), scratch_path(spark, "star"), measure=True).sizes


@query("pipeline_star")
def pipeline_star(spark, sf_dir):
    """The fact table as the whole pipeline wrote it."""
    from ..pipeline import run_pipeline
    from ..schemas import FACT_TABLE

    out = scratch_path(spark, "star")
    run_pipeline(spark, trips_fixture(spark, sf_dir), out)
    return read_saved(spark, f"{out}/{FACT_TABLE}")


def _drifted_files(spark, sf_dir):
    """Two folders' worth of trip files: other column order, name case and types in the later ones."""
    first, later = _halves(trips_fixture(spark, sf_dir), "tpep_pickup_datetime")
    out = scratch_path(spark, "trip-files")
    first.write.parquet(f"{out}/a")
    later = later.select(*[F.col(c).alias(c.upper()) for c in reversed(later.columns)])
    later.withColumn("VENDORID", F.col("VENDORID").cast("int")).write.parquet(f"{out}/b")
    return [sorted(list_data_files(spark, f"{out}/{x}", glob="*.parquet")) for x in "ab"]


@query("load_trip_files")
def load_trip_files(spark, sf_dir):
    """Many files of two layouts loaded by name, their footers read by one distributed job."""
    first, later = _drifted_files(spark, sf_dir)
    return load_trips(spark, first + later, YELLOW_TRIPS)


@query("load_first_files")
def load_first_files(spark, sf_dir):
    """Only the first files in path order: those of the first folder."""
    first, later = _drifted_files(spark, sf_dir)
    return load_trips(spark, later + first, YELLOW_TRIPS, max_files=len(first))


@query("incremental_listing")
def incremental_listing(spark, sf_dir):
    """Monthly folders of lineitem that each of two runs lists: the second one only those that came since."""
    from ..sources import Manifest

    lines = read_parquet(spark, f"{sf_dir}/lineitem.parquet")
    area = scratch_path(spark, "landing-area")
    manifest = Manifest(spark, area, scratch_path(spark, "manifest"))
    for part in _halves(lines, "l_shipdate"):
        months = part.withColumn("month", F.date_format("l_shipdate", "yyyy-MM"))
        months.repartition("month").write.mode("append").partitionBy("month").parquet(area)
        manifest.run()
    return manifest.files().select("run", "folder").distinct()


@query("cardinality_sketches")
def cardinality_sketches(spark, sf_dir):
    """The cardinality profile from sketches kept per rate code and merged; no column has more
    values than a sketch holds, so all counts are exact."""
    raw = _raw(spark, sf_dir)
    kept = scratch_path(spark, "sketches")
    column_sketches(raw, [*CARDINALITY_COLUMNS, "pulocationid"], by=F.col("ratecodeid")).write.parquet(kept)
    return merged_cardinality(read_saved(spark, kept))


@query("parquet_footer_counts")
def parquet_footer_counts(spark, sf_dir):
    """Rows, and values and extremes of two columns, from the footers of lineitem's files."""
    return footer_counts(spark, f"{sf_dir}/lineitem.parquet", columns=("l_orderkey", "l_linenumber"))


@query("clean_clustered")
def clean_clustered(spark, sf_dir):
    """The cleaned trips, read from files written so that cleaning skips what it drops."""
    from ..sinks import write_clustered

    path = scratch_path(spark, "clustered")
    write_clustered(trips_fixture(spark, sf_dir), path)
    return clean_trips(read_saved(spark, path))


NESTED_ITEM = '<ul><li><a href="/sub/inner-th-1.csv">x</a></li><li><a href="/sub/other.csv">y</a></li></ul></li>'


@query("nested_page_links")
def nested_links(spark, sf_dir):
    """Links of pages whose every list item holds a list of its own."""
    pages = read_parquet(spark, f"{sf_dir}/pages.parquet")
    deep = pages.withColumn("html", F.replace("html", F.lit("</li>"), F.lit(NESTED_ITEM)))
    return nested_page_links(deep, word=LINK_WORD)
