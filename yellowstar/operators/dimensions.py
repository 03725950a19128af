"""Dimension tables with dense surrogate keys.

All dimensions of a run come from ONE scan of the cleaned trips: a
grouping-sets aggregate with one set per source column yields the distinct
values of every natural-key column at once (partial aggregation in each
task first, so a value shared by a third of all rows costs one row per
task). That small result is frozen in a reliable checkpoint, its per-set
sizes are counted, and each dimension is cut from it:

* single-column dimensions (vendor, payment type, rate code) are one set;
* role-playing dimensions (datetime, zone) are the UNION DISTINCT of two
  sets (pickup and dropoff).

The measured sizes choose the key path: a dimension whose proven bound is
at most ``WINDOW_PATH_MAX_ROWS`` is ranked in one task; a larger one with
integer or whole-second keys is keyed from 64-value blocks (``blocks.py``),
which also gives the fact table its broadcast lookup; anything else takes
the range-partitioned path of ``keys.py``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.codes import code_label
from ..schemas import DROPOFF, PAYMENT_TYPES, PICKUP, RATE_CODES, VENDOR_NAMES
from ..session import ensure_checkpoint_dir
from .blocks import BLOCK_LOOKUP_MAX_ROWS, BlockLookup, block_dense_key, build_block_lookup
from .keys import WINDOW_PATH_MAX_ROWS, ranged_dense_key, window_dense_key

SOURCE = "_ys_source"
ROWS = "_ys_rows"

# A natural-key value is "hot" when it holds at least this many fact rows,
# and never fewer than total_rows / MAX_HOT_KEYS, so at most MAX_HOT_KEYS
# values per column are hot: a proven bound for broadcasting them.
HOT_KEY_MIN_ROWS = 2_000_000
MAX_HOT_KEYS = 100_000


@dataclass(frozen=True)
class DimSpec:
    """How a dimension is derived: natural key, surrogate key, source columns, labels."""

    name: str
    natural: str
    key: str
    sources: tuple[str, ...]
    labels: dict[int, str] | None = None
    label_col: str | None = None


@dataclass
class Dimension:
    """A built dimension: its frame, natural/surrogate key names and size facts."""

    name: str
    df: DataFrame
    natural: str
    key: str
    max_rows: int | None = None  # proven upper bound on the row count
    partition_counts: DataFrame | None = field(default=None, repr=False)
    # fact column -> its hot natural-key values (at most MAX_HOT_KEYS rows)
    hot_values: dict[str, DataFrame] = field(default_factory=dict, repr=False)
    # keys rise with the natural key without gaps; block lookups rest on that
    dense: bool = True
    _rows: int | None = field(default=None, repr=False)
    _blocks: dict[int, BlockLookup | None] = field(default_factory=dict, repr=False)

    def block_lookup(self, max_rows: int) -> BlockLookup | None:
        """The broadcastable block lookup of this dimension (built once), or None."""
        if not self.dense:
            return None
        for lookup in self._blocks.values():
            if lookup is not None and lookup.rows <= max_rows:
                return lookup
        if max_rows not in self._blocks:
            self._blocks[max_rows] = build_block_lookup(self.df, self.natural, self.key, max_rows)
        return self._blocks[max_rows]

    def row_count(self) -> int:
        """Exact row count; read from the per-partition counts when available."""
        if self._rows is None:
            if self.partition_counts is not None:
                self._rows = int(self.partition_counts.agg(F.sum("rows")).first()[0] or 0)
            else:
                self._rows = self.df.count()
        return self._rows

    def fits_broadcast(self, max_rows: int) -> bool:
        """True when the dimension is proven or measured to hold <= max_rows rows."""
        if self.max_rows is not None and self.max_rows <= max_rows:
            return True
        return self.row_count() <= max_rows


SPECS: dict[str, DimSpec] = {
    s.name: s
    for s in [
        DimSpec("vendor_DIM", "vendorid", "vendor_key", ("vendorid",), VENDOR_NAMES, "vendor_name"),
        DimSpec("datetime_DIM", "timestamp", "datetime_key", (PICKUP, DROPOFF)),
        DimSpec("taxizone_DIM", "locationid", "zone_key", ("pulocationid", "dolocationid")),
        DimSpec("paymenttype_DIM", "payment_type", "paymenttype_key", ("payment_type",), PAYMENT_TYPES, "description"),
        DimSpec("ratecode_DIM", "ratecodeid", "ratecode_key", ("ratecodeid",), RATE_CODES, "description"),
    ]
}


@dataclass(frozen=True)
class KeyStats:
    """Per source column: distinct values (null included), rows, rows of the hottest value,
    and whether null is one of the values."""

    values: int
    rows: int
    top_rows: int
    has_null: bool = False


def natural_key_sets(clean: DataFrame, columns: list[str]) -> tuple[DataFrame, dict[str, KeyStats]]:
    """Distinct values of each column with their row counts, one grouping set per column, frozen.

    Returns the checkpointed frame (``_ys_source`` names the column a row
    belongs to, the other value columns are null, ``_ys_rows`` counts the
    rows holding the value) and per-column statistics.
    """
    ensure_checkpoint_dir(clean.sparkSession)
    grouped = clean.groupingSets([[c] for c in columns], *columns).agg(
        F.count(F.lit(1)).alias(ROWS), *[F.grouping(c).alias(f"_g{i}") for i, c in enumerate(columns)]
    )
    which: Column = F.lit(None).cast("string")
    for i, c in reversed(list(enumerate(columns))):
        which = F.when(F.col(f"_g{i}") == 0, F.lit(c)).otherwise(which)
    keys = grouped.select(which.alias(SOURCE), *columns, ROWS).checkpoint(eager=True)
    # One row per source column: a bounded collect of the set statistics.
    own_null: Column = F.lit(False)
    for c in reversed(columns):
        own_null = F.when(F.col(SOURCE) == c, F.col(c).isNull()).otherwise(own_null)
    stats = keys.groupBy(SOURCE).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(ROWS).alias("rows"),
        F.max(ROWS).alias("top"),
        F.max(own_null).alias("has_null"),
    )
    found = {
        r[SOURCE]: KeyStats(int(r["n"]), int(r["rows"]), int(r["top"]), bool(r["has_null"])) for r in stats.collect()
    }
    return keys, {c: found.get(c, KeyStats(0, 0, 0)) for c in columns}


def hot_threshold(total_rows: int, min_rows: int = HOT_KEY_MIN_ROWS) -> int:
    """Rows a value must hold to be hot; bounds the hot set by MAX_HOT_KEYS."""
    return max(min_rows, -(-total_rows // MAX_HOT_KEYS), 1)


def _hot_values(keys: DataFrame, source: str, threshold: int) -> DataFrame:
    """Non-null values of one source column holding at least ``threshold`` rows."""
    return keys.filter(
        (F.col(SOURCE) == source) & F.col(source).isNotNull() & (F.col(ROWS) >= threshold)
    ).select(source)


def mark_hot_values(
    dim: Dimension, spec: DimSpec, keys: DataFrame, stats: dict[str, KeyStats], hot_key_rows: int
) -> None:
    """Note the values of each source column that hold enough rows to be joined apart."""
    for src in spec.sources:
        threshold = hot_threshold(stats[src].rows, hot_key_rows)
        if stats[src].top_rows >= threshold:
            dim.hot_values[src] = _hot_values(keys, src, threshold)


def natural_values(keys: DataFrame, spec: DimSpec) -> DataFrame:
    """The distinct natural keys of one dimension, from the frozen key sets."""
    part = keys.filter(F.col(SOURCE).isin(*spec.sources))
    if len(spec.sources) == 1:
        return part.select(F.col(spec.sources[0]).alias(spec.natural))
    value: Column = F.lit(None)
    for src in reversed(spec.sources):
        value = F.when(F.col(SOURCE) == src, F.col(src)).otherwise(value)
    return part.select(value.alias(spec.natural)).distinct()


def key_dimension(
    values: DataFrame,
    spec: DimSpec,
    bound: int,
    strict: bool = False,
    window_max_rows: int = WINDOW_PATH_MAX_ROWS,
    block_rows: int = BLOCK_LOOKUP_MAX_ROWS,
    has_null: bool | None = None,
) -> Dimension:
    """Dense-key distinct ``values`` whose row count is at most ``bound``.

    ``has_null`` (when known) tells whether null is one of the values; with
    the block path the exact row count then needs no job at all.

    Paths, in order: one window in one task (proven bound within
    ``window_max_rows``); blocks (integer or whole-second keys, lookup
    within ``block_rows``); range partitioning (anything else).
    """
    counts, blocks = None, {}
    max_rows: int | None = None
    if bound <= window_max_rows:
        dim, max_rows = window_dense_key(values, spec.natural, spec.key), bound
    else:
        by_blocks = block_dense_key(values, spec.natural, spec.key, block_rows)
        if by_blocks is not None:
            dim, lookup = by_blocks
            blocks = {block_rows: lookup}
        else:
            dim, counts = ranged_dense_key(values, spec.natural, spec.key)
    if spec.labels is not None:
        dim = dim.withColumn(spec.label_col or "description", code_label(spec.natural, spec.labels, strict))
    rows = None
    if blocks and has_null is not None:
        rows = next(iter(blocks.values())).members + int(has_null)
    return Dimension(spec.name, dim, spec.natural, spec.key, max_rows, counts, _rows=rows, _blocks=blocks)


def build_dimensions(
    clean: DataFrame,
    names: list[str] | None = None,
    strict: bool = False,
    specs: dict[str, DimSpec] = SPECS,
    window_max_rows: int = WINDOW_PATH_MAX_ROWS,
    hot_key_rows: int = HOT_KEY_MIN_ROWS,
    block_rows: int = BLOCK_LOOKUP_MAX_ROWS,
) -> dict[str, Dimension]:
    """The requested dimensions (all five by default), keyed by name in load order.

    ``window_max_rows`` is the largest proven size ranked in a single task
    (0 disables that path); ``block_rows`` the largest block table used for
    keys and lookups (0 disables it, leaving the range-partitioned path).
    ``hot_key_rows`` is the row count from which a natural-key value is
    joined by broadcast instead of through the shuffle (see ``facts.join_role``).
    """
    wanted = [specs[n] for n in (names or list(specs))]
    columns = list(dict.fromkeys(src for spec in wanted for src in spec.sources))
    keys, stats = natural_key_sets(clean, columns)
    out = {}
    for spec in wanted:
        bound = sum(stats[s].values for s in spec.sources)
        has_null = any(stats[s].has_null for s in spec.sources)
        dim = key_dimension(natural_values(keys, spec), spec, bound, strict, window_max_rows, block_rows, has_null)
        mark_hot_values(dim, spec, keys, stats, hot_key_rows)
        out[spec.name] = dim
    return out


def build_code_dim(
    clean: DataFrame,
    code_col: str,
    key: str,
    name: str,
    labels: dict[int, str] | None = None,
    label_col: str | None = None,
    strict: bool = False,
) -> Dimension:
    """Distinct codes of one column, dense key, optional label."""
    spec = DimSpec(name, code_col, key, (code_col,), labels, label_col)
    return build_dimensions(clean, [name], strict, {name: spec})[name]


def build_role_dim(clean: DataFrame, role_cols: list[str], natural: str, key: str, name: str) -> Dimension:
    """One dimension over several role columns: UNION DISTINCT of their values."""
    spec = DimSpec(name, natural, key, tuple(role_cols))
    return build_dimensions(clean, [name], False, {name: spec})[name]


def _single(name: str):
    def build(
        clean: DataFrame,
        strict: bool = False,
        window_max_rows: int = WINDOW_PATH_MAX_ROWS,
        hot_key_rows: int = HOT_KEY_MIN_ROWS,
        block_rows: int = BLOCK_LOOKUP_MAX_ROWS,
    ) -> Dimension:
        return build_dimensions(
            clean, [name], strict, window_max_rows=window_max_rows, hot_key_rows=hot_key_rows, block_rows=block_rows
        )[name]

    build.__name__ = name.lower()
    return build


vendor_dim = _single("vendor_DIM")
datetime_dim = _single("datetime_DIM")
taxizone_dim = _single("taxizone_DIM")
paymenttype_dim = _single("paymenttype_DIM")
ratecode_dim = _single("ratecode_DIM")

DIMENSION_BUILDERS = {
    "vendor_DIM": vendor_dim,
    "datetime_DIM": datetime_dim,
    "taxizone_DIM": taxizone_dim,
    "paymenttype_DIM": paymenttype_dim,
    "ratecode_DIM": ratecode_dim,
}
