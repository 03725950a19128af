"""Stable surrogate keys across runs: a versioned key registry per dimension.

Dense ranks are stable within a run but shift when a later month brings a new
value. A registry remembers every natural key that ever had a surrogate key.
A load looks its distinct values up, gives only the unseen ones new keys
above the high-water mark (dense, in the values' order, null last), and adds
them as a new version; known values keep their key for ever, so fact files of
earlier months stay valid.

On storage a registry is a folder of parquet tables::

    members/version=N/   natural key, surrogate key: what version N added
    commits/version=N/   one row: load name, first key, members, high-water mark

A version counts only once its commit row is written, after its members. A
load that dies in between leaves a version that nobody reads and that the
next load overwrites. A load that is repeated finds all its values known and
adds nothing; one repeated with corrected data adds just the values that are
new. One writer at a time per registry (monthly loads are scheduled one after
another); any number of readers.

At scale a registry holds distinct natural keys, not trips: a load shuffles
the distinct values of the new trips against the members once, and writes only
the unseen ones.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.codes import code_label
from ..session import ensure_checkpoint_dir
from .dimensions import (
    HOT_KEY_MIN_ROWS,
    SPECS,
    Dimension,
    DimSpec,
    key_dimension,
    mark_hot_values,
    natural_key_sets,
    natural_values,
)

VERSION = "version"
COMMIT_FIELDS = "load string, first_key bigint, members bigint, high_water bigint"


@dataclass(frozen=True)
class Commit:
    """One committed version: its load's name, its first key, its new members, and the keys used so far."""

    version: int
    load: str
    first_key: int
    members: int
    high_water: int


class KeyRegistry:
    """The keys of one dimension, kept under ``path``."""

    def __init__(self, spark: SparkSession, path: str, spec: DimSpec, natural_type: T.DataType):
        self.spark, self.spec = spark, spec
        self.path = path.rstrip("/")
        self.natural_type = natural_type

    @property
    def schema(self) -> T.StructType:
        return T.StructType(
            [T.StructField(self.spec.natural, self.natural_type), T.StructField(self.spec.key, T.LongType())]
        )

    def commits(self) -> list[Commit]:
        """The committed versions in order, one small row each."""
        if not folder_exists(self.spark, f"{self.path}/commits"):
            return []
        rows = self.spark.read.schema(f"{COMMIT_FIELDS}, {VERSION} int").parquet(f"{self.path}/commits").collect()
        found = [Commit(r[VERSION], r["load"], r["first_key"], r["members"], r["high_water"]) for r in rows]
        return sorted(found, key=lambda c: c.version)

    def members(self, version: int | None = None) -> DataFrame:
        """Natural key, surrogate key and version of every member (as of ``version``, if given)."""
        schema = T.StructType([*self.schema.fields, T.StructField(VERSION, T.IntegerType())])
        committed = [c.version for c in self.commits() if version is None or c.version <= version]
        paths = [f"{self.path}/members/{VERSION}={v}" for v in committed]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/members").parquet(*paths)

    def add(self, values: DataFrame, load: str) -> Commit:
        """Register the natural keys in ``values`` (distinct; nulls allowed) under the load's name.

        Returns the new version, or the latest one with no members if every value was known.
        """
        done = self.commits()
        ensure_checkpoint_dir(self.spark)
        natural, key = self.spec.natural, self.spec.key
        known = self.members().select(F.col(natural).alias("_ys_known"))
        unseen = values.select(F.col(natural).cast(self.natural_type).alias(natural)).join(
            known, F.col(natural).eqNullSafe(F.col("_ys_known")), "left_anti"
        )
        # counted and keyed below: found once
        unseen = unseen.checkpoint(eager=True)
        n = unseen.count()
        first = done[-1].high_water if done else 0
        if n == 0:
            return Commit(done[-1].version if done else 0, load, first, 0, first)
        version = done[-1].version + 1 if done else 1
        plain = DimSpec(self.spec.name, natural, key, self.spec.sources)
        keyed = key_dimension(unseen, plain, n).df.select(natural, (F.col(key) + F.lit(first)).alias(key))
        keyed.write.mode("overwrite").parquet(f"{self.path}/members/{VERSION}={version}")
        commit = Commit(version, load, first, n, first + n)
        row = self.spark.createDataFrame([(load, first, n, first + n)], COMMIT_FIELDS)
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/commits/{VERSION}={version}")
        return commit

    def dimension(self, strict: bool = False, version: int | None = None) -> Dimension:
        """The registry as a dimension, labels included, for joins and as the table to load."""
        df = self.members(version).drop(VERSION)
        if self.spec.labels is not None:
            df = df.withColumn(
                self.spec.label_col or "description", code_label(self.spec.natural, self.spec.labels, strict)
            )
        committed = [c for c in self.commits() if version is None or c.version <= version]
        rows = committed[-1].high_water if committed else 0
        return Dimension(self.spec.name, df, self.spec.natural, self.spec.key, max_rows=rows, dense=False, _rows=rows)


def folder_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, asked of the store that Spark writes to."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def registries(spark: SparkSession, base: str, clean: DataFrame, specs: dict[str, DimSpec] = SPECS) -> dict[str, KeyRegistry]:
    """One registry per dimension below ``base``; key types are those of the cleaned trips."""
    kinds = {f.name: f.dataType for f in clean.schema.fields}
    return {
        name: KeyRegistry(spark, f"{base.rstrip('/')}/{name}", spec, kinds[spec.sources[0]]) for name, spec in specs.items()
    }


def register_load(
    clean: DataFrame,
    base: str,
    load: str,
    specs: dict[str, DimSpec] = SPECS,
    strict: bool = False,
    hot_key_rows: int = HOT_KEY_MIN_ROWS,
) -> dict[str, Dimension]:
    """Add the values of one load's cleaned trips to all registries; the dimensions as they are after it.

    All dimensions' values come from one scan of the trips (grouping sets),
    which also finds the values that are hot in this load.
    """
    books = registries(clean.sparkSession, base, clean, specs)
    columns = list(dict.fromkeys(src for spec in specs.values() for src in spec.sources))
    keys, stats = natural_key_sets(clean, columns)
    out = {}
    for name, book in books.items():
        book.add(natural_values(keys, specs[name]), load)
        out[name] = book.dimension(strict)
        mark_hot_values(out[name], specs[name], keys, stats, hot_key_rows)
    return out
