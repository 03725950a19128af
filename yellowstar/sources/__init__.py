"""Sources: parquet files, schema conforming, the trips fixture and page links."""

from .files import conform, footer_groups, list_data_files, load_trips, read_parquet, read_saved, union_by_name
from .fixture import TRIPS_COLUMNS, trips_fixture, trips_select_sql
from .footers import footer_counts
from .manifest import Manifest
from .pages import file_names, nested_page_links, new_files, page_links

__all__ = [
    "Manifest",
    "TRIPS_COLUMNS",
    "conform",
    "file_names",
    "footer_counts",
    "footer_groups",
    "list_data_files",
    "load_trips",
    "nested_page_links",
    "new_files",
    "page_links",
    "read_parquet",
    "read_saved",
    "trips_fixture",
    "trips_select_sql",
    "union_by_name",
]
