"""Incremental listing: which files arrived since the last run.

Listing a landing area of years of monthly folders on every run costs one
request per folder and a name per file on the driver. A manifest remembers the
files of earlier runs and the greatest folder name seen (folders are named so
that later ones sort higher, such as ``month=2023-02``). A run reads the
area's folder names, lists only folders above that mark, and adds their
files. With ``overlap`` the last folders below the mark are listed again and
their known files left out, for areas where files come late.

A run counts once its commit row is written, after its files; a run that dies
in between is done again by the next one. One writer at a time.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.registry import folder_exists

FILES = "folder string, path string, length bigint"
COMMIT = "high_water string, files bigint"


def child_folders(spark: SparkSession, base: str) -> list[str]:
    """Names of the folders directly below ``base``, sorted; one request to the store."""
    path = spark._jvm.org.apache.hadoop.fs.Path(base)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = store.listStatus(path) if store.exists(path) else []
    names = [s.getPath().getName() for s in found if s.isDirectory()]
    return sorted(n for n in names if not n.startswith((".", "_")))


class Manifest:
    """The files found below ``base``, remembered under ``path``."""

    def __init__(self, spark: SparkSession, base: str, path: str):
        self.spark, self.base, self.path = spark, base.rstrip("/"), path.rstrip("/")

    def commits(self) -> list[tuple[int, str, int]]:
        """Run, high-water mark and number of files of each committed run, in order."""
        if not folder_exists(self.spark, f"{self.path}/commits"):
            return []
        rows = self.spark.read.schema(f"{COMMIT}, run int").parquet(f"{self.path}/commits").collect()
        return sorted((r["run"], r["high_water"], r["files"]) for r in rows)

    def files(self, run: int | None = None) -> DataFrame:
        """``folder, path, length, run`` of all known files (of one run, if given)."""
        runs = [r for r, _, n in self.commits() if n and run in (None, r)]
        if not runs:
            return self.spark.createDataFrame([], f"{FILES}, run int")
        reader = self.spark.read.schema(f"{FILES}, run int").option("basePath", f"{self.path}/files")
        return reader.parquet(*[f"{self.path}/files/run={r}" for r in runs])

    def pending(self, overlap: int = 0) -> list[str]:
        """Folders that the next run lists."""
        done = self.commits()
        mark = max((m for _, m, _ in done), default="")
        folders = child_folders(self.spark, self.base)
        below = [f for f in folders if f <= mark]
        return below[max(0, len(below) - overlap) :] * (overlap > 0) + [f for f in folders if f > mark]

    def run(self, glob: str = "*.parquet", overlap: int = 0) -> DataFrame:
        """List what is pending, remember it, and return the files that are new."""
        done = self.commits()
        folders = self.pending(overlap)
        number = done[-1][0] + 1 if done else 1
        if not folders:
            return self.spark.createDataFrame([], f"{FILES}, run int")
        reader = self.spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
        listing = reader.load([f"{self.base}/{f}" for f in folders]).select("path", "length")
        # the folder is the first part of the path below the area
        area = re.sub(r"^[A-Za-z][\w+.-]*:", "", self.base).lstrip("/")
        below = F.element_at(F.split("path", f"/{re.escape(area)}/", 2), -1)
        rows = listing.select(F.substring_index(below, "/", 1).alias("folder"), "path", "length")
        if overlap:
            rows = rows.join(self.files().select("path"), "path", "left_anti").select("folder", "path", "length")
        rows.write.mode("overwrite").parquet(f"{self.path}/files/run={number}")
        found = self.spark.read.schema(FILES).parquet(f"{self.path}/files/run={number}")
        commit = found.agg(F.lit(max([*folders, *(m for _, m, _ in done)])).alias("high_water"), F.count(F.lit(1)).alias("files"))
        commit.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/commits/run={number}")
        return self.files(number)
