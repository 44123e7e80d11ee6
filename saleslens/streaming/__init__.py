"""Incremental form of the CSV load: newly landed files appended as they arrive."""

from saleslens.streaming.ingest import stream_load_csv  # noqa: F401
