from tidemark.sinks.writers import (
    QualityRecord,
    append_mart,
    merge_into,
    metrics_scope,
    write_metrics,
    write_quarantine,
)

__all__ = [
    "QualityRecord",
    "append_mart",
    "merge_into",
    "metrics_scope",
    "write_metrics",
    "write_quarantine",
]
