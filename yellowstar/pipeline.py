"""End-to-end job: files -> cleaned trips -> five dimensions -> fact table -> sink (K1, K3).

Execution shape, per run:

* Each dimension is computed once from a narrow scan of the source (only
  its key columns and the filter columns are read) and frozen in a
  reliable checkpoint, so its keys cannot change between the write of the
  dimension and the build of the fact table.
* The fact table is one scan of the source; dimensions within the
  broadcast bound are hash-joined map-side, larger ones (in practice only
  the datetime dimension) through a shuffle join that adaptive execution
  splits when a key is skewed.
* The cleaned trips are never cached: at scale they are nearly the size of
  the input, and re-reading a few parquet columns is cheaper than holding
  every column in executor memory.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .operators.cleaning import clean_trips
from .operators.dimensions import Dimension, build_dimensions
from .operators.blocks import BLOCK_LOOKUP_MAX_ROWS
from .operators.facts import BROADCAST_MAX_ROWS, PICKUP_MONTH, build_fact
from .operators.registry import register_load, registries
from .schemas import FACT_TABLE, YELLOW_TRIPS
from .session import scale_conf
from .sinks.monthly import read_loads, write_load
from .sinks.observed import MeasuredFunnel, write_tables
from .sinks.writers import write_jdbc, write_parquet, write_star
from .sources.files import load_trips

Sink = Callable[[str, DataFrame], None]


@dataclass
class StarSchema:
    clean: DataFrame
    dimensions: dict[str, Dimension]
    fact: DataFrame
    #: with ``measure``: the cleaning funnel and the tables' rows, as counted on the writes
    funnel: DataFrame | None = None
    sizes: DataFrame | None = None

    def tables(self) -> dict[str, DataFrame]:
        """All six tables in load order: dimensions first, fact last."""
        out = {name: dim.df for name, dim in self.dimensions.items()}
        out[FACT_TABLE] = self.fact
        return out


def build_star(
    raw: DataFrame,
    how: str = "inner",
    broadcast_rows: int = BROADCAST_MAX_ROWS,
    strict: bool = False,
    with_pickup_month: bool = False,
    block_rows: int = BLOCK_LOOKUP_MAX_ROWS,
    measured: MeasuredFunnel | None = None,
    **dimension_options,
) -> StarSchema:
    """Clean raw trips and build the star schema (lazy except for key freezing).

    ``measured`` counts the cleaning funnel of the same raw trips when the
    fact table is written.

    ``dimension_options`` go to ``build_dimensions`` (``window_max_rows``,
    ``hot_key_rows``); ``block_rows`` bounds block tables for both the keys
    and the fact lookups.
    """
    clean = clean_trips(raw)
    dims = build_dimensions(clean, strict=strict, block_rows=block_rows, **dimension_options)
    fact = build_fact(
        measured.clean() if measured else clean, dims, how=how, broadcast_rows=broadcast_rows, with_pickup_month=with_pickup_month, block_rows=block_rows
    )
    return StarSchema(clean, dims, fact)


def parquet_sink(base_path: str, partition_fact_by: list[str] | None = None) -> Sink:
    """Write each table to ``{base_path}/{table}`` as parquet."""

    def write(name: str, df: DataFrame) -> None:
        write_parquet(df, f"{base_path.rstrip('/')}/{name}", partition_by=partition_fact_by if name == FACT_TABLE else None)

    return write


def jdbc_sink(url: str, **options) -> Sink:
    """Overwrite each table over JDBC (B1, B2); options as in ``jdbc_options``."""

    def write(name: str, df: DataFrame) -> None:
        write_jdbc(df, url=url, table=name, **options)

    return write


def input_bytes(spark: SparkSession, source: str | list[str], glob: str = "*") -> int:
    """Total size of the source files, from the file listing only (no data read)."""
    paths = [source] if isinstance(source, str) else source
    listing = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(*paths)
    return int(listing.agg(F.sum("length")).first()[0] or 0)


def size_shuffles(spark: SparkSession, source: str | list[str]) -> dict[str, str]:
    """Set shuffle partition counts for this session from the input size."""
    try:
        cores = spark.sparkContext.defaultParallelism
    except Exception:  # Spark Connect
        cores = int(spark.conf.get("spark.default.parallelism", "200"))
    conf = scale_conf(input_bytes(spark, source), cores)
    for key, value in conf.items():
        spark.conf.set(key, value)
    return conf


def run_pipeline(
    spark: SparkSession,
    source: str | list[str] | DataFrame,
    sink: Sink | str,
    schema: T.StructType = YELLOW_TRIPS,
    how: str = "inner",
    broadcast_rows: int = BROADCAST_MAX_ROWS,
    strict: bool = False,
    auto_size: bool = False,
    partition_by_month: bool = False,
    measure: bool = False,
    **star_options,
) -> StarSchema:
    """Load, clean, model and write the six tables (K3).

    ``measure`` takes the cleaning funnel and all table sizes from the writes
    themselves (``star.funnel``, ``star.sizes``): no further scan.

    ``source`` is a directory, a file list, or an already loaded frame.
    All of its rows are read; to cap them, pass a frame made with
    ``limit_ordered`` or ``load_trips(max_files=...)``.
    ``auto_size`` sets the shuffle partition count from the input's bytes.
    ``partition_by_month`` writes the fact table (parquet sink) partitioned
    by ``pickup_month`` so readers of a month range prune whole folders.
    ``star_options`` go to ``build_star`` (``block_rows``, ``window_max_rows``,
    ``hot_key_rows``).
    """
    if auto_size and not isinstance(source, DataFrame):
        size_shuffles(spark, source)
    raw = source if isinstance(source, DataFrame) else load_trips(spark, source, schema)
    measured = MeasuredFunnel(raw) if measure else None
    star = build_star(
        raw,
        how=how,
        broadcast_rows=broadcast_rows,
        strict=strict,
        with_pickup_month=partition_by_month,
        measured=measured,
        **star_options,
    )
    if isinstance(sink, str):
        write_one = parquet_sink(sink, [PICKUP_MONTH] if partition_by_month else None)
    else:
        write_one = sink
    # Dimensions within the broadcast bound are read twice, by their own
    # write and by the fact build's broadcast: keep those (not the trips) in
    # memory for the run (K1). A larger dimension reaches the fact build
    # through its block table or a shuffle of the checkpointed keys, so its
    # frame is read once and caching it would only cost memory.
    cached = [d for d in star.dimensions.values() if d.fits_broadcast(broadcast_rows)]
    for dim in cached:
        dim.df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if measured:
            star.sizes = write_tables(star.tables(), write_one)
            star.funnel = measured.rows(star.fact)
        else:
            write_star(star.tables(), write_one)
    finally:
        for dim in cached:
            dim.df.unpersist()
    return star


def run_load(
    spark: SparkSession,
    source: str | list[str] | DataFrame,
    base: str,
    load: str,
    schema: T.StructType = YELLOW_TRIPS,
    broadcast_rows: int = BROADCAST_MAX_ROWS,
    strict: bool = False,
) -> int:
    """Add one load (a month's files) to a growing star schema below ``base``; returns its fact rows (K3).

    Keys of earlier loads never change and their fact files stay untouched:
    ``keys/`` holds a registry per dimension, ``fact_table/`` a partition per
    load. Running a load again, after a crash or with corrected files,
    replaces that load's rows and nothing else.
    """
    raw = source if isinstance(source, DataFrame) else load_trips(spark, source, schema)
    clean = clean_trips(raw)
    base = base.rstrip("/")
    dims = register_load(clean, f"{base}/keys", load, strict=strict)
    return write_load(build_fact(clean, dims, broadcast_rows=broadcast_rows), f"{base}/{FACT_TABLE}", load)


def read_star(spark: SparkSession, base: str, clean: DataFrame, loads: list[str] | None = None) -> dict[str, DataFrame]:
    """The tables below ``base`` by name; ``clean`` (any cleaned trips, unread) gives the key types."""
    base = base.rstrip("/")
    out = {name: book.dimension().df for name, book in registries(spark, f"{base}/keys", clean).items()}
    out[FACT_TABLE] = read_loads(spark, f"{base}/{FACT_TABLE}", loads)
    return out


def main(argv: list[str] | None = None) -> None:
    """``spark-submit -m yellowstar.pipeline --source DIR --sink DIR`` (parquet sink)."""
    import argparse

    from .session import build_session

    parser = argparse.ArgumentParser(description="Build the trip star schema.")
    parser.add_argument("--source", required=True, help="directory (or glob) of monthly trip parquet files")
    parser.add_argument("--sink", required=True, help="output base path for the six parquet tables")
    parser.add_argument("--broadcast-rows", type=int, default=BROADCAST_MAX_ROWS)
    parser.add_argument("--strict", action="store_true", help="fail on unknown code values")
    parser.add_argument("--partition-by-month", action="store_true", help="partition the fact table by pickup month")
    args = parser.parse_args(argv)
    spark = build_session()
    run_pipeline(
        spark,
        args.source,
        args.sink,
        broadcast_rows=args.broadcast_rows,
        strict=args.strict,
        auto_size=True,
        partition_by_month=args.partition_by_month,
    )


if __name__ == "__main__":
    main()
