"""Helpers shared by the text operators."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: White space that separates words: space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder, read by Spark (any store it can reach)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``text`` only, null text as the empty text; other columns never clash."""
    return docs.select(
        docs[id_col].alias("doc_id"),
        F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"),
    )


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Cuts the lineage, so that a lost executor costs a reread, not a rerun.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._saved_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``saved`` returned, once every frame made from them has been written itself.

    Nothing that a lost executor would have to read again may be among them.
    """
    for table_ in tables:
        spark = table_.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table_._saved_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def long_array(values) -> Column:
    """A constant ``array<bigint>`` column; folded to one literal by the optimizer."""
    return F.split(F.lit(",".join(str(int(v)) for v in values)), ",").cast("array<bigint>")


def text_batches(spark: SparkSession, rows: int = 512) -> None:
    """Hand texts to Python a few hundred at a time, so that a batch of long ones fits in memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


#: Characters that a task hands to numpy at once; a longer text stands alone.
BATCH_CHARS = 2_000_000


def batches(texts: list[str], limit: int = BATCH_CHARS) -> Iterator[slice]:
    """Slices of about ``limit`` characters; a longer text stands alone."""
    begin, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield slice(begin, i)
            begin, size = i, 0
        size += len(t)
    if begin < len(texts):
        yield slice(begin, len(texts))


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package: as a zip file, unless PYTHONPATH names its folder."""
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    root = os.path.dirname(package)
    context = spark.sparkContext
    if root in os.environ.get("PYTHONPATH", "").split(os.pathsep) or getattr(context, "_package_shipped", False):
        return
    base = os.path.join(tempfile.mkdtemp(prefix="package-"), os.path.basename(package))
    context.addPyFile(shutil.make_archive(base, "zip", root, os.path.basename(package)))
    context._package_shipped = True


def map_texts(docs: DataFrame, function, fields: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Apply ``function`` to lists of whole texts; null text is the empty text.

    ``function(texts)`` gives the rows per text (None: one each) and a dict of
    output columns, named and typed by ``fields``. Ids stay Arrow values, so
    null and large ids pass unchanged.
    """
    rows = id_text(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    text_batches(docs.sparkSession)
    ship_package(docs.sparkSession)

    def run(record_batches):
        import numpy as np
        import pyarrow as pa

        for batch in record_batches:
            texts = batch.column(1).to_pylist()
            for part in batches(texts):
                counts, columns = function(texts[part])
                ids = batch.column(0).slice(part.start, part.stop - part.start)
                if counts is not None:
                    ids = ids.take(pa.array(np.repeat(np.arange(len(ids)), counts)))
                types = [f.type for f in schema]
                arrays = [pa.array(values, type=t) for values, t in zip(columns.values(), types, strict=True)]
                yield pa.RecordBatch.from_arrays([ids, *arrays], names=["doc_id", *columns])

    schema = arrow_fields(fields)
    return rows.mapInArrow(run, f"doc_id {kind}, {fields}")


def arrow_fields(fields: str):
    """Arrow schema of a DDL list of simple types and arrays of them."""
    import pyarrow as pa

    plain = {
        "int": pa.int32(), "bigint": pa.int64(), "string": pa.string(), "double": pa.float64(),
        "boolean": pa.bool_(), "binary": pa.binary(),
    }

    def kind(name: str):
        return pa.list_(kind(name[6:-1])) if name.startswith("array<") else plain[name]

    pairs = (f.strip().split(" ", 1) for f in fields.split(","))
    return pa.schema([(name, kind(value.strip())) for name, value in pairs])


#: Bits of the membership filters: 2**20 words of 16 bytes, 16 MB broadcast at most.
FILTER_BITS = 1 << 26


def _bit(column: Column, bits: int) -> Column:
    return F.xxhash64(column).bitwiseAND(F.lit(bits - 1))


def bit_words(keys: DataFrame, column: str, bits: int = FILTER_BITS) -> DataFrame:
    """Hashed membership bits of a column's values, as 64-bit words (at most ``bits`` / 64 rows)."""
    at = keys.select(_bit(F.col(column), bits).alias("bit"))
    return at.groupBy(F.shiftright("bit", 6).alias("filter_word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("filter_mask")
    )


def flag_bits(df: DataFrame, column: str, words: DataFrame, flag: str, bits: int = FILTER_BITS) -> DataFrame:
    """``df`` with a boolean ``flag``: false where the value is certainly not among the keys.

    The words are bounded by ``bits`` however many keys there are, so they are
    broadcast; more keys mean more flagged rows, never a lost one.
    """
    at = df.withColumn("filter_bit", _bit(F.col(column), bits))
    met = at.join(F.broadcast(words), F.shiftright("filter_bit", 6) == F.col("filter_word"), "left")
    hit = F.expr("(shiftrightunsigned(filter_mask, cast(filter_bit & 63 as int)) & 1) = 1")
    return met.select(*[F.col(f"`{c}`") for c in df.columns], F.coalesce(hit, F.lit(False)).alias(flag))


def in_bits(df: DataFrame, column: str, words: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """Rows whose value may be among the keys; a row left out is certainly not."""
    flagged = flag_bits(df, column, words, "filter_hit", bits)
    return flagged.filter("filter_hit").drop("filter_hit")


def twice_bitmap(values: DataFrame, column: str, bits: int):
    """Bitmap (numpy bytes) of the hashed values that occur in two rows or more.

    Tasks fold the bits into blocks of 512 words of 64 bits; the driver gets
    at most ``bits`` / 2**15 rows of at most 6 kB, however many values there are.
    """
    import numpy as np

    at = values.select(F.col(column).bitwiseAND(F.lit(bits - 1)).alias("bit"))
    twice = at.groupBy("bit").agg(F.count(F.lit(1)).alias("n")).filter("n >= 2")
    words = twice.groupBy(F.shiftright("bit", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("mask")
    )
    blocks = words.groupBy(F.shiftright("word", 9).alias("block")).agg(
        F.collect_list(F.struct(F.expr("cast(word & 511 as int)").alias("at"), "mask")).alias("w")
    )
    out = np.zeros(bits // 64, np.int64)
    table = blocks.select("block", F.col("w.at").alias("at"), F.col("w.mask").alias("mask")).toArrow().combine_chunks()
    if table.num_rows:
        sizes = np.asarray(table.column("at").combine_chunks().value_lengths())
        start = np.repeat(table.column("block").to_numpy() << 9, sizes)
        out[start + table.column("at").combine_chunks().flatten().to_numpy()] = table.column("mask").combine_chunks().flatten().to_numpy()
    return out.view(np.uint8)
