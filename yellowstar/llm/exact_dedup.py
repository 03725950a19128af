"""Exact deduplication by two-pass Bloom filtering.

Texts are equal when identical after lower-casing A-Z only. Pass one hashes
every text and sets the bits of its hash in a Bloom filter that also knows
which bits were set by two rows or more. A text that occurs twice has all its
bits set twice, so a row with a bit set once is certainly unique: it passes
straight through. Only the remaining rows shuffle, as id and hash, and are
grouped exactly by SHA-256, so a false positive of the filter costs a row in
the shuffle and never a wrong answer.

The filter has 16 bits a row up to ``MAX_FILTER_BITS``; beyond that size more
rows pass the filter and shuffle, with the same result. Its twice-set bits
travel as 64-bit words, at most ``MAX_FILTER_BITS / 64`` rows, which is the
proven bound of the broadcast.

Defined cases: a null text counts as empty, so all null and empty texts are
copies of each other. Of equal texts the row with the largest id stays; a
null id is smaller than any other. Of repeated rows (same id, same text) one
stays. An empty table gives an empty result. Other columns are untouched.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_text, saved

#: 2**27 bits: 2**21 words of 16 bytes, 32 MB broadcast at most.
MAX_FILTER_BITS = 1 << 27
MIN_FILTER_BITS = 1 << 10
BITS_PER_ROW = 16


def text_hash(text: Column) -> Column:
    """SHA-256 (binary) of the text with A-Z lower-cased."""
    return F.unhex(F.sha2(F.translate(text, string.ascii_uppercase, string.ascii_lowercase), 256))


def filter_bits(rows: int) -> int:
    """Filter size for ``rows`` rows: a power of two within the bounds."""
    wanted = 1 << max(0, (BITS_PER_ROW * max(rows, 1) - 1).bit_length())
    return min(MAX_FILTER_BITS, max(MIN_FILTER_BITS, wanted))


def _positions(key: Column, bits: int) -> tuple[Column, Column]:
    h = F.xxhash64(key)
    return h.bitwiseAND(F.lit(bits - 1)), F.shiftrightunsigned(h, 32).bitwiseAND(F.lit(bits - 1))


def twice_set_bits(hashed: DataFrame, bits: int) -> DataFrame:
    """Pass one: the bits set by two rows or more, as (word, mask) of 64 bits."""
    p, q = _positions(F.col("sha"), bits)
    return (
        hashed.select(F.explode(F.array_distinct(F.array(p, q))).alias("bit"))
        .groupBy("bit")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n >= 2")
        .groupBy(F.shiftright("bit", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("mask"))
    )


def possibly_repeated(keyed: DataFrame, twice: DataFrame, bits: int) -> DataFrame:
    """Pass two: ``keyed`` with a boolean ``maybe``, false only where ``sha`` is certainly unique."""
    p, q = _positions(F.col("sha"), bits)
    # at most MAX_FILTER_BITS / 64 rows: the broadcast is bounded by construction
    first = F.broadcast(twice.select(F.col("word").alias("w1"), F.col("mask").alias("m1")))
    second = F.broadcast(twice.select(F.col("word").alias("w2"), F.col("mask").alias("m2")))

    def is_set(mask: str, bit: str) -> Column:
        return F.coalesce(F.expr(f"(shiftrightunsigned({mask}, cast({bit} & 63 as int)) & 1) = 1"), F.lit(False))

    return (
        keyed.withColumns({"bit1": p, "bit2": q})
        .join(first, F.shiftright("bit1", 6) == F.col("w1"), "left")
        .join(second, F.shiftright("bit2", 6) == F.col("w2"), "left")
        .withColumn("maybe", is_set("m1", "bit1") & is_set("m2", "bit2"))
        .drop("bit1", "bit2", "w1", "m1", "w2", "m2")
    )


def hash_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame, int]:
    """Saved (doc_id, sha, row), the filter's twice-set bits and its size."""
    rows = id_text(docs, id_col, text_col)
    hashed = saved(
        rows.select("doc_id", text_hash(F.col("text")).alias("sha")).withColumn("row", F.monotonically_increasing_id()),
        "copy-hashes",
    )
    return filter_of(hashed)


def filter_of(hashed: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """Rows (doc_id, sha, row) of a saved table, their filter's twice-set bits and its size."""
    bits = filter_bits(hashed.count())
    return hashed, saved(twice_set_bits(hashed, bits), "copy-filter"), bits


def _groups(maybe: DataFrame) -> DataFrame:
    """Per hash: the row that stays, as (doc_id, row), and the size of the group."""
    return maybe.groupBy(F.col("sha").alias("g")).agg(
        F.max(F.struct("doc_id", "row")).alias("keep"), F.count(F.lit(1)).alias("group_size")
    )


def copy_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", known: tuple | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256 (``known``: its ``hash_rows``)."""
    hashed, twice, bits = known or hash_rows(docs, id_col, text_col)
    marked = possibly_repeated(hashed, twice, bits)
    unique = marked.filter(~F.col("maybe")).select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("bigint").alias("group_size"),
        F.lit(True).alias("kept"),
        "sha",
    )
    maybe = marked.filter("maybe")
    groups = _groups(maybe)
    grouped = maybe.join(groups, maybe["sha"] == groups["g"]).select(
        "doc_id",
        F.col("keep.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("keep.row")).alias("kept"),
        "sha",
    )
    return unique.unionByName(grouped).withColumn("text_sha256", F.lower(F.hex("sha"))).drop("sha")


def copy_rows(known: tuple) -> DataFrame:
    """``row`` of every row that does not stay (``known``: ``hash_rows`` or ``filter_of``)."""
    hashed, twice, bits = known
    maybe = possibly_repeated(hashed, twice, bits).filter("maybe")
    groups = _groups(maybe)
    return maybe.join(groups, maybe["sha"] == groups["g"]).filter(F.col("row") != F.col("keep.row")).select("row")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", known: tuple | None = None) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns (``known``: its ``hash_rows``).

    Rows that the filter proves unique pass straight through; only possibly
    repeated rows shuffle, and only by (id, hash), which no group shares.
    """
    hashed, twice, bits = known or hash_rows(docs, id_col, text_col)
    maybe_hashes = possibly_repeated(hashed, twice, bits).filter("maybe")
    groups = _groups(maybe_hashes)
    stays = saved(
        groups.join(maybe_hashes, (F.col("g") == F.col("sha")) & F.col("doc_id").eqNullSafe(F.col("keep.doc_id")))
        .groupBy("g")
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("ties")),
        "copy-stays",
    )
    packed = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("whole"),
        docs[id_col].alias("doc_id"),
        text_hash(F.coalesce(docs[text_col].cast("string"), F.lit(""))).alias("sha"),
    )
    marked = possibly_repeated(packed, twice, bits)
    unique = marked.filter(~F.col("maybe")).select("whole.*")
    met = marked.filter("maybe").join(stays, (F.col("sha") == F.col("g")) & F.col("doc_id").eqNullSafe(F.col("keep_id")))
    once = met.filter("ties = 1").select("whole.*")
    tied = met.filter("ties > 1").dropDuplicates(["sha", "doc_id"]).select("whole.*")
    return unique.unionByName(once).unionByName(tied)
