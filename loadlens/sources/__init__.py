"""Sources: driver tables, the measurement view, and line readers."""

from loadlens.sources.tables import (
    MEASUREMENT_COLUMNS,
    TABLES,
    balanced,
    load_candidate_measurements,
    load_measurements,
    measurements_from_events,
    read_table,
    table_path,
)
from loadlens.sources.text import (
    document_lines,
    document_texts,
    kafka_lines,
    literal_lines,
    socket_lines,
    text_lines,
    union_sources,
)

__all__ = [
    "MEASUREMENT_COLUMNS", "TABLES", "balanced", "load_candidate_measurements", "document_lines", "document_texts", "kafka_lines",
    "literal_lines", "load_measurements", "measurements_from_events", "read_table",
    "socket_lines", "table_path", "text_lines", "union_sources",
]
