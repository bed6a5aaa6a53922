"""Readers, the driver-table binding, typed ingestion and sinks."""

from .binding import bind  # noqa: F401
from .sinks import csv_safe  # noqa: F401
from .tables import Tables, read_tables, write_tables  # noqa: F401
