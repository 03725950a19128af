"""Query catalogue, DuckDB oracle and plan inspection."""

from .catalog import QUERIES
from .oracle import ORACLE

__all__ = ["ORACLE", "QUERIES"]
