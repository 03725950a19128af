"""Dense keys and their broadcastable lookup from 64-value blocks (G6, F1-F7 at scale).

A dense key is the rank of a value among the dimension's distinct values.
When the natural key has an exact integer ordinal (integers; timestamps
whose values are whole seconds), that rank can be read from a much smaller
structure: cut the ordinal line into blocks of 64, and keep per present
block the key of its first value and a 64-bit word with one bit per
present value. Then

    key(v) = first_key[block(v)] + bit_count(word[block(v)] & bits_below(v))

and ``v`` is a member iff its own bit is set. The lookup has one row per
non-empty block (at most one per 64 ordinals of the key span, and at most
one per distinct value), so ten years of second-resolution timestamps
need under 5 million rows: small enough to broadcast. The fact table then
resolves even the biggest dimension map-side, without shuffling the trips.

The same table also *assigns* the keys (``block_dense_key``): the first key
of a block is the running sum of the bit counts of all earlier blocks, so
a dimension of hundreds of millions of timestamps is keyed without
range-partitioning or sorting its values.

Everything is built-in column arithmetic (``shiftright``, ``bit_or``,
``bit_count``); nothing leaves the JVM.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Largest lookup (rows = non-empty blocks) that is broadcast; ~50 bytes a row.
BLOCK_LOOKUP_MAX_ROWS = 8_000_000

# A block-table row is 32 bytes as collected (null bits + three longs); keep
# each broadcast within half of spark.driver.maxResultSize.
ROW_BYTES = 32


def _size_bytes(text: str) -> int:
    """Spark size string ("1g", "512m", "1048576") in bytes."""
    text = text.strip().lower()
    units = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}
    for suffix in ("kb", "mb", "gb", "tb", "b"):
        if text.endswith(suffix):
            text = text[: -len(suffix)] + (suffix[0] if suffix != "b" else "")
            break
    if text and text[-1] in units:
        return int(float(text[:-1]) * units[text[-1]])
    return int(text)


def driver_row_cap(spark, max_rows: int) -> int:
    """``max_rows``, lowered so a broadcast fits half of ``spark.driver.maxResultSize``."""
    limit = _size_bytes(spark.conf.get("spark.driver.maxResultSize", "1g"))
    if limit <= 0:  # 0 means unlimited
        return max_rows
    return min(max_rows, limit // (2 * ROW_BYTES))


BLOCK = "_ys_block"
FIRST = "_ys_first_key"
WORD = "_ys_word"


def ordinal(col: Column, dtype: T.DataType) -> tuple[Column, Column] | None:
    """``(bigint ordinal, exactness predicate)`` for a natural key type, or None.

    The predicate is true when the ordinal represents the value exactly
    (timestamps: no fraction of a second). NTZ timestamps are read as their
    own seconds since the epoch (``unix_timestamp`` of an NTZ value applies
    no time zone), so two wall-clock values never share an ordinal, not
    even across a daylight-saving gap in the session's zone. The
    whole-second test casts both of its sides alike, so it is zone-safe too.
    """
    if isinstance(dtype, T.IntegralType):
        return col.cast("long"), F.lit(True)
    if isinstance(dtype, T.TimestampNTZType):
        return F.unix_timestamp(col), F.date_trunc("second", col) == col
    if isinstance(dtype, T.TimestampType):
        return F.unix_seconds(col), F.unix_micros(col) % 1_000_000 == 0
    return None


def _block(o: Column) -> Column:
    return F.shiftright(o, 6)  # arithmetic shift: floor(o / 64), negatives included


def _bit(o: Column) -> Column:
    return o.bitwiseAND(F.lit(63))


def _one_at(bit: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), bit)


def _bits_below(bit: Column) -> Column:
    # ~(-1 << bit): no arithmetic overflow for bit = 63, even under ANSI mode
    return F.bitwise_not(F.call_function("shiftleft", F.lit(-1).cast("long"), bit))


@dataclass
class BlockLookup:
    """The broadcastable lookup of one dimension, its row count and key total.

    ``members`` is the number of non-null values it encodes, which is also
    the key of the dimension's null member (nulls rank last).
    """

    df: DataFrame
    rows: int
    members: int


def block_dense_key(
    values: DataFrame, col: str, key_name: str, max_rows: int = BLOCK_LOOKUP_MAX_ROWS
) -> tuple[DataFrame, BlockLookup] | None:
    """Dense keys of distinct ``values`` computed from blocks, without a global sort.

    The distinct values are folded into one row per 64-wide block (a bit
    word); a running sum of the words' bit counts, in block order, gives
    each block's first key. That table is frozen in a checkpoint and is at
    the same time the broadcast lookup for fact joins, so dimension keys and
    fact keys come from one structure. Each value's key is then computed
    map-side from the broadcast table. Returns None when the values have no
    exact ordinal or the table would exceed ``max_rows`` (the caller then
    uses the range-partitioned path). The running sum runs over at most
    ``max_rows`` block rows in one task, no more than the broadcast itself
    gathers.
    """
    spec = ordinal(F.col(col), values.schema[col].dataType)
    max_rows = driver_row_cap(values.sparkSession, max_rows)
    if spec is None or max_rows <= 0:
        return None
    o, exact = spec
    present = values.filter(F.col(col).isNotNull()).select(o.alias("_o"), exact.cast("int").alias("_exact"))
    words = (
        present.groupBy(_block(F.col("_o")).alias(BLOCK))
        .agg(F.bit_or(_one_at(_bit(F.col("_o")))).alias(WORD), F.min("_exact").alias("_exact"))
        .checkpoint(eager=True)
    )
    stats = words.agg(
        F.count(F.lit(1)).alias("n"), F.min("_exact").alias("exact"), F.sum(F.bit_count(WORD)).alias("members")
    ).first()
    if stats["n"] > max_rows or (stats["n"] > 0 and stats["exact"] != 1):
        return None
    before = Window.orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    table = words.select(
        BLOCK, F.coalesce(F.sum(F.bit_count(WORD)).over(before), F.lit(0)).cast("long").alias(FIRST), WORD
    ).checkpoint(eager=True)
    lookup = BlockLookup(table, int(stats["n"]), int(stats["members"] or 0))
    keyed = join_by_blocks(values.withColumn("_ys_value", F.col(col)), lookup, "_ys_value", key_name, "left")
    dim = keyed.select(col, F.coalesce(F.col(key_name), F.lit(lookup.members).cast("long")).alias(key_name))
    return dim, lookup


def build_block_lookup(dim: DataFrame, natural: str, key: str, max_rows: int = BLOCK_LOOKUP_MAX_ROWS) -> BlockLookup | None:
    """Block lookup of a keyed dimension, or None when not exact or too large.

    One aggregate over the dimension (frozen in a checkpoint) and one count
    over that small result.
    """
    spec = ordinal(F.col(natural), dim.schema[natural].dataType)
    max_rows = driver_row_cap(dim.sparkSession, max_rows)
    if spec is None or max_rows <= 0:
        return None
    o, exact = spec
    present = dim.filter(F.col(natural).isNotNull()).select(
        o.alias("_o"), exact.cast("int").alias("_exact"), F.col(key).alias("_k")
    )
    blocks = (
        present.groupBy(_block(F.col("_o")).alias(BLOCK))
        .agg(
            F.min("_k").alias(FIRST),
            F.bit_or(_one_at(_bit(F.col("_o")))).alias(WORD),
            F.min("_exact").alias("_exact"),
        )
        .checkpoint(eager=True)
    )
    stats = blocks.agg(
        F.count(F.lit(1)).alias("n"), F.min("_exact").alias("exact"), F.sum(F.bit_count(WORD)).alias("members")
    ).first()
    if stats["n"] > max_rows or (stats["n"] > 0 and stats["exact"] != 1):
        return None
    return BlockLookup(blocks.select(BLOCK, FIRST, WORD), int(stats["n"]), int(stats["members"] or 0))


def join_by_blocks(
    fact: DataFrame, lookup: BlockLookup, fact_col: str, role_key: str, how: str = "inner"
) -> DataFrame:
    """Replace ``fact_col`` by its dense key read from a broadcast block lookup.

    Values that are not members (their bit is clear, or they are not exact
    ordinals) get a null key; ``inner`` drops those rows like a join would.
    The ordinal and its exactness are computed once, below the join; above
    it only bit arithmetic on those columns remains.
    """
    o, exact = ordinal(F.col(fact_col), fact.schema[fact_col].dataType)
    staged = fact.withColumns({_ORD: o, _EXACT: exact})
    joined = staged.withColumn(BLOCK, _block(F.col(_ORD))).join(F.broadcast(lookup.df), BLOCK, "left")
    bit = _bit(F.col(_ORD))
    hit = F.col(_EXACT) & (F.col(WORD).bitwiseAND(_one_at(bit)) != 0)
    rank = F.col(FIRST) + F.bit_count(F.col(WORD).bitwiseAND(_bits_below(bit)))
    if how in ("left", "left_outer", "leftouter"):
        joined = joined.withColumn(role_key, F.when(hit, rank).cast("long"))
    else:
        joined = joined.filter(hit).withColumn(role_key, rank.cast("long"))
    return joined.drop(fact_col, BLOCK, FIRST, WORD, _ORD, _EXACT)


_ORD, _EXACT = "_ys_ordinal", "_ys_exact"
