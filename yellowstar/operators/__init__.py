"""Relational operators of the trip star schema, all DataFrame -> DataFrame."""

from .blocks import BLOCK_LOOKUP_MAX_ROWS, build_block_lookup, join_by_blocks
from .cleaning import STAGE_NAMES, STAGES, clean_trips, cleaning_funnel, filter_stages, stage_frames
from .dimensions import (
    Dimension,
    build_code_dim,
    build_dimensions,
    build_role_dim,
    datetime_dim,
    paymenttype_dim,
    ratecode_dim,
    taxizone_dim,
    vendor_dim,
)
from .facts import BROADCAST_MAX_ROWS, ROLES, build_fact, join_role, key_integrity
from .keys import dense_key, ranged_dense_key, window_dense_key
from .limits import bounded_count, limit_ordered
from .profiling import (
    cardinality_profile,
    count_where,
    distinct_values,
    row_count,
    schema_rows,
    table_sizes,
    value_counts,
    value_lists,
)
from .registry import KeyRegistry, register_load, registries
from .sketches import column_sketches, merged_cardinality

__all__ = [
    "BLOCK_LOOKUP_MAX_ROWS",
    "BROADCAST_MAX_ROWS",
    "Dimension",
    "KeyRegistry",
    "ROLES",
    "STAGES",
    "STAGE_NAMES",
    "bounded_count",
    "build_block_lookup",
    "build_code_dim",
    "build_dimensions",
    "build_fact",
    "build_role_dim",
    "cardinality_profile",
    "clean_trips",
    "cleaning_funnel",
    "column_sketches",
    "count_where",
    "datetime_dim",
    "dense_key",
    "distinct_values",
    "filter_stages",
    "join_by_blocks",
    "join_role",
    "key_integrity",
    "limit_ordered",
    "merged_cardinality",
    "paymenttype_dim",
    "ranged_dense_key",
    "ratecode_dim",
    "register_load",
    "registries",
    "row_count",
    "schema_rows",
    "stage_frames",
    "table_sizes",
    "taxizone_dim",
    "value_counts",
    "value_lists",
    "vendor_dim",
    "window_dense_key",
]
