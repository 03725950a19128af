"""Fact-table build: role-playing key joins and the key-integrity report."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import DROPOFF, FACT_COLUMNS, PICKUP
from .blocks import BLOCK_LOOKUP_MAX_ROWS, join_by_blocks
from .dimensions import ROWS, SOURCE, Dimension, natural_key_sets

# Dimensions with at most this many rows are broadcast to the fact scan;
# larger ones go through a shuffle join with hot values split off (see
# join_role). Checked against the exact row count of the built dimension.
BROADCAST_MAX_ROWS = 2_000_000


@dataclass(frozen=True)
class Role:
    """A foreign key of the fact table: fact column -> key of a dimension."""

    fact_col: str
    dimension: str
    key: str


# Join order: the small code dimensions first (broadcast, no shuffle), the
# two datetime roles last, since only they can outgrow a broadcast.
ROLES = [
    Role("vendorid", "vendor_DIM", "vendor_key"),
    Role("ratecodeid", "ratecode_DIM", "ratecode_key"),
    Role("pulocationid", "taxizone_DIM", "puzone_key"),
    Role("dolocationid", "taxizone_DIM", "dozone_key"),
    Role("payment_type", "paymenttype_DIM", "paymenttype_key"),
    Role(PICKUP, "datetime_DIM", "putime_key"),
    Role(DROPOFF, "datetime_DIM", "dotime_key"),
]


# working columns of the shuffle path
_HOT, _COLD, _JK, _JS = "_ys_hot_key", "_ys_cold_key", "_ys_join_key", "_ys_join_salt"


def join_role(
    fact: DataFrame,
    dim: Dimension,
    fact_col: str,
    role_key: str,
    how: str = "inner",
    broadcast_rows: int = BROADCAST_MAX_ROWS,
    block_rows: int = BLOCK_LOOKUP_MAX_ROWS,
) -> DataFrame:
    """Replace ``fact_col`` by the dimension key under its role name.

    The dimension side is renamed to the fact's column before the join, so
    a dimension used twice never yields ambiguous columns; it is broadcast
    only when its size is proven or measured to be within ``broadcast_rows``.
    Null natural keys never match: ``inner`` drops those rows, ``left``
    keeps them with a null key.

    A dimension too big to broadcast is next tried as a block lookup
    (``blocks.py``): for integer or whole-second keys its dense keys fit a
    broadcast of one row per 64-wide block, so the join stays map-side.

    Only when that is not possible does the join shuffle. On the shuffle
    path no reducer may receive a hot value (one value can hold a third of
    all rows). Values the dimension build found hot get
    their key from a broadcast join against their few dimension rows;
    those rows, and rows with a null key, then enter the shuffle join with
    a null join key and a row-hash salt, so they spread over all partitions
    and match nothing there. The plan stays a single chain: no branch of
    the input is evaluated twice.
    """
    side = dim.df.select(F.col(dim.natural).alias(fact_col), F.col(dim.key).alias(role_key))
    if dim.fits_broadcast(broadcast_rows):
        return fact.join(F.broadcast(side), on=fact_col, how=how).drop(fact_col)
    lookup = dim.block_lookup(block_rows) if block_rows > 0 else None
    if lookup is not None:
        return join_by_blocks(fact, lookup, fact_col, role_key, how)
    left = how in ("left", "left_outer", "leftouter")
    hot = dim.hot_values.get(fact_col)
    if hot is None and not left:
        # Inner join: Catalyst drops null keys before the shuffle.
        return fact.join(side, on=fact_col, how=how).drop(fact_col)
    cur = fact
    out_of_shuffle = F.col(fact_col).isNull()
    if hot is not None:
        values = F.broadcast(hot.select(F.col(hot.columns[0]).alias(fact_col)))
        hot_side = side.join(values, fact_col, "left_semi").select(fact_col, F.col(role_key).alias(_HOT))
        cur = cur.join(F.broadcast(hot_side), fact_col, "left")
        out_of_shuffle = out_of_shuffle | F.col(_HOT).isNotNull()
    salt = F.xxhash64(*[F.col(c) for c in fact.columns])
    cur = cur.withColumns(
        {
            _JK: F.when(out_of_shuffle, F.lit(None)).otherwise(F.col(fact_col)),
            _JS: F.when(out_of_shuffle, salt).otherwise(F.lit(0).cast("long")),
        }
    )
    cold_side = side.select(F.col(fact_col).alias(_JK), F.lit(0).cast("long").alias(_JS), F.col(role_key).alias(_COLD))
    joined = cur.join(cold_side, [_JK, _JS], "left")
    key = F.coalesce(F.col(_HOT), F.col(_COLD)) if hot is not None else F.col(_COLD)
    joined = joined.withColumn(role_key, key)
    if not left:
        joined = joined.filter(F.col(role_key).isNotNull())
    return joined.drop(fact_col, _JK, _JS, _HOT, _COLD)


PICKUP_MONTH = "pickup_month"


def build_fact(
    clean: DataFrame,
    dims: dict[str, Dimension],
    how: str = "inner",
    broadcast_rows: int = BROADCAST_MAX_ROWS,
    roles: list[Role] | None = None,
    ordered: bool = True,
    with_pickup_month: bool = False,
    block_rows: int = BLOCK_LOOKUP_MAX_ROWS,
) -> DataFrame:
    """Swap every natural key of the cleaned trips for its surrogate key.

    ``with_pickup_month`` adds a ``pickup_month`` date column after the 20
    fact columns, for writing the table partitioned by month.
    """
    fact = clean
    if with_pickup_month:
        fact = fact.withColumn(PICKUP_MONTH, F.trunc(F.col(PICKUP), "month"))
    for role in roles or ROLES:
        fact = join_role(fact, dims[role.dimension], role.fact_col, role.key, how, broadcast_rows, block_rows)
    if not ordered:
        return fact
    return fact.select(*FACT_COLUMNS, *([PICKUP_MONTH] if with_pickup_month else []))


def key_integrity(clean: DataFrame, dims: dict[str, Dimension]) -> DataFrame:
    """Per role: cleaned rows without a dimension member, and duplicate natural keys.

    The trips are not joined. One scan counts the rows of every distinct value
    of the key columns (grouping sets, partial aggregation first); only these
    values meet the dimensions, and the rows of a value that finds no member
    are the role's unmatched rows, null values included. Duplicates come from
    one partial aggregate per dimension. Output ``role, dimension,
    fact_column, unmatched_rows, duplicate_keys``; all zeros except null keys
    means the inner-join fact table lost nothing it should have kept.
    """
    keys, _ = natural_key_sets(clean, list(dict.fromkeys(r.fact_col for r in ROLES)))
    per_role = None
    for r in ROLES:
        dim = dims[r.dimension]
        members = dim.df.select(F.col(dim.natural).alias("_ys_member"))
        values = keys.filter(F.col(SOURCE) == r.fact_col).select(F.col(r.fact_col).alias("_ys_value"), ROWS)
        lost = values.join(members, F.col("_ys_value") == F.col("_ys_member"), "left_anti")
        part = lost.agg(F.coalesce(F.sum(ROWS), F.lit(0).cast("bigint")).alias("unmatched_rows")).select(
            F.lit(r.key).alias("role"), F.lit(r.dimension).alias("dimension"), F.lit(r.fact_col).alias("fact_column"), "unmatched_rows"
        )
        per_role = part if per_role is None else per_role.unionByName(part)
    dupes = None
    for name, dim in dims.items():
        d = (
            dim.df.groupBy(dim.natural)
            .count()
            .filter(F.col("count") > 1)
            .agg(F.count(F.lit(1)).alias("duplicate_keys"))
            .select(F.lit(name).alias("dimension"), "duplicate_keys")
        )
        dupes = d if dupes is None else dupes.unionByName(d)
    return per_role.join(dupes, "dimension").select(
        "role", "dimension", "fact_column", "unmatched_rows", "duplicate_keys"
    )
