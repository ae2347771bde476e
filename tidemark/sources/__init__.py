from tidemark.sources.readers import (
    CORRUPT_COLUMN,
    read_delimited,
    read_metrics,
    read_metrics_history,
    read_quarantine,
    read_raw_json,
    read_table,
    text_schema,
)
from tidemark.sources.tables import Table

__all__ = [
    "CORRUPT_COLUMN",
    "Table",
    "read_delimited",
    "read_metrics",
    "read_metrics_history",
    "read_quarantine",
    "read_raw_json",
    "read_table",
    "text_schema",
]
