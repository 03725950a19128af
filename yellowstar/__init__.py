"""yellowstar: trip records to a star schema, as Spark DataFrame jobs.

Subpackages:
  sources    parquet listing/scans, schema conforming, trips fixture, page links
  functions  column expressions: casts, flags, code labels
  operators  cleaning, profiling, dense keys, dimensions, fact build, limits
  plans      the query catalogue and its DuckDB oracle, plan inspection
  sinks      parquet and JDBC writers
  streaming  incremental cleaning of newly landed files
"""

__version__ = "0.1.0"
