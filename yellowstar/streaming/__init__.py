"""Structured Streaming: incremental cleaning of newly landed files."""

from .landing import land_clean_trips, landed_files_stream, start_clean_stream

__all__ = ["land_clean_trips", "landed_files_stream", "start_clean_stream"]
