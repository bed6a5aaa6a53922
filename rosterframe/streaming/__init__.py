"""Structured Streaming ingestion of posted record batches."""

from .ingest_stream import posted_stream, read_landed, start_ingest  # noqa: F401
