"""File sources: listing, parquet scans, schema conforming and by-name union."""

from __future__ import annotations

from collections import OrderedDict
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import YELLOW_TRIPS


def list_data_files(spark: SparkSession, directory: str, glob: str = "*") -> list[str]:
    """Data files of a directory, sorted by path (A1); every file that is not hidden, whatever its name.

    Spark's file index does the listing (hidden ``.``/``_`` files are
    skipped, as the reference skips dot files); the binary-file source is
    used only for its listing, no file content is read.
    """
    listing = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(directory)
    return sorted(listing.inputFiles())


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    """Parquet scan with the schema taken from the file footers (A2)."""
    return spark.read.parquet(*paths)


def read_saved(spark: SparkSession, path: str) -> DataFrame:
    """Scan a table this library wrote earlier."""
    return spark.read.parquet(path)


def _field_index(df: DataFrame) -> dict[str, str]:
    index: dict[str, str] = {}
    for name in df.columns:
        key = name.lower()
        if key in index:
            raise ValueError(f"columns {index[key]!r} and {name!r} differ only by case")
        index[key] = name
    return index


def conform(df: DataFrame, schema: T.StructType, keep_extra: bool = False) -> DataFrame:
    """Project ``df`` onto ``schema`` by name, ignoring case.

    Each target column is taken from the source column of the same name
    (any case) with ``try_cast`` to the target type; columns the source
    lacks become typed nulls. Output names are the schema's names. With
    ``keep_extra`` the remaining source columns follow, lower-cased.
    """
    index = _field_index(df)
    cols = []
    for field in schema.fields:
        source = index.get(field.name.lower())
        if source is None:
            cols.append(F.lit(None).cast(field.dataType).alias(field.name))
        elif df.schema[source].dataType == field.dataType:
            cols.append(F.col(f"`{source}`").alias(field.name))
        else:
            cols.append(F.col(f"`{source}`").try_cast(field.dataType).alias(field.name))
    if keep_extra:
        wanted = {f.name.lower() for f in schema.fields}
        cols += [F.col(f"`{src}`").alias(key) for key, src in index.items() if key not in wanted]
    return df.select(*cols)


def union_by_name(frames: list[DataFrame], schema: T.StructType | None = None) -> DataFrame:
    """UNION ALL of frames matched by column name, not position (A3, H1).

    With a ``schema`` every frame is conformed first, so differing column
    order, name case and physical types cannot mix values between columns.
    """
    if not frames:
        raise ValueError("nothing to union")
    if schema is not None:
        frames = [conform(f, schema) for f in frames]
    return reduce(lambda a, b: a.unionByName(b), frames)


def load_trips(
    spark: SparkSession,
    source: str | list[str],
    schema: T.StructType = YELLOW_TRIPS,
    max_files: int | None = None,
    group_by_schema: bool = True,
    provenance: str | None = None,
) -> DataFrame:
    """Load many monthly trip files as one frame with the declared schema (A3, A4).

    ``source`` is a directory or a list of files; ``max_files`` keeps the
    first n files in path order. Files are grouped by footer schema so each
    schema variant is a single parallel scan, then the variants are
    conformed and unioned by name. All footers are read by one distributed
    job (``footer_groups``). With ``group_by_schema=False`` no footer is
    read: all files are scanned with the declared schema (Spark resolves
    names case-insensitively and fills missing columns with null).
    ``provenance`` names an extra column holding each row's source file name
    (from the scan's ``_metadata``).
    """
    paths = list_data_files(spark, source) if isinstance(source, str) else sorted(source)
    if max_files is not None:
        paths = paths[:max_files]
    if not paths:
        raise FileNotFoundError(f"no data files in {source!r}")
    if not group_by_schema:
        scans = [spark.read.schema(_nullable(schema)).parquet(*paths)]
    else:
        scans = [spark.read.parquet(*group) for group in footer_groups(spark, paths)]
    frames = [conform(scan, schema) for scan in scans]
    if provenance:
        frames = [
            f.withColumn(provenance, scan["_metadata.file_name"]) for f, scan in zip(frames, scans)
        ]
    return union_by_name(frames)


def footer_groups(spark: SparkSession, paths: list[str]) -> list[list[str]]:
    """Files that share a footer schema (names ignoring case), in order of their first file.

    One job of as many tasks as there are cores: each reads the footers of
    some files, only their last bytes, and returns a short hash per file, not
    a schema. Files in a store that the tasks can't open by themselves (its
    connector being known to Spark alone) have their footers read from the
    driver, a few at a time.
    """
    if len(paths) < 2:
        return [list(paths)] if paths else []

    def fingerprint(path: str) -> str | None:
        import hashlib
        from urllib.parse import unquote

        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow import fs

        try:
            if path.startswith("file:"):
                store, name = fs.LocalFileSystem(), unquote(path.removeprefix("file://").removeprefix("file:"))
            else:
                store, name = fs.FileSystem.from_uri(path)
            columns = pq.read_metadata(name, filesystem=store).schema
        except (OSError, ImportError, pa.ArrowInvalid, pa.ArrowNotImplementedError):
            return None
        fields = [(c.path.lower(), c.physical_type, str(c.logical_type)) for c in map(columns.column, range(len(columns)))]
        return hashlib.sha256(repr(fields).encode()).hexdigest()

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            known = [fingerprint(p) for p in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(known, pa.string())], names=["at", "schema"])

    names = spark.createDataFrame(list(zip(paths, range(len(paths)))), "path string, at int")
    found = {r["at"]: r["schema"] for r in names.mapInArrow(run, "at int, schema string").collect()}
    unread = [i for i in range(len(paths)) if found[i] is None]
    found.update(zip(unread, _footer_schemas(spark, [paths[i] for i in unread])))
    variants: OrderedDict[str, list[str]] = OrderedDict()
    for i, path in enumerate(paths):
        variants.setdefault(found[i], []).append(path)
    return list(variants.values())


def _footer_schemas(spark: SparkSession, paths: list[str], threads: int = 16) -> list[str]:
    """Footer schema of each file (lower-cased), read as concurrent small jobs."""
    if not paths:
        return []

    def read(path: str) -> str:
        return spark.read.parquet(path).schema.simpleString().lower()

    with ThreadPoolExecutor(max_workers=min(threads, len(paths))) as pool:
        return list(pool.map(read, paths))


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
