"""Sinks: parquet and JDBC, loads that can be run again, counts taken on the write."""

from .clustered import write_clustered
from .monthly import committed_loads, read_loads, write_load
from .observed import Measured, MeasuredFunnel, write_clean, write_tables
from .writers import jdbc_options, write_jdbc, write_parquet, write_star

__all__ = [
    "Measured",
    "MeasuredFunnel",
    "committed_loads",
    "jdbc_options",
    "read_loads",
    "write_clean",
    "write_clustered",
    "write_jdbc",
    "write_load",
    "write_parquet",
    "write_star",
    "write_tables",
]
