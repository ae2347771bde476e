from tidemark.operators.conform import align, conform, declared, typed_projection
from tidemark.operators.dml import (
    delete_children,
    explode_children,
    keep_latest,
    replace_children,
    undated_children,
    upsert,
)
from tidemark.operators.enrich import attach, child_counts, child_lists, lookup, restrict_children
from tidemark.operators.incremental import bounds, high_water, mark_value, newer_than, since
from tidemark.operators.quality import (
    Rule,
    clean_rows,
    corrupt,
    enforce_gate,
    error_counts,
    gate,
    in_range,
    not_null,
    null_counts,
    predicate,
    quality_counts,
    quality_metrics,
    rejected_rows,
    tag,
)
from tidemark.operators.sizes import broadcast_if_small, fits_broadcast, payload_bytes

__all__ = [
    "Rule",
    "align",
    "attach",
    "bounds",
    "broadcast_if_small",
    "child_counts",
    "child_lists",
    "clean_rows",
    "conform",
    "corrupt",
    "declared",
    "delete_children",
    "enforce_gate",
    "error_counts",
    "explode_children",
    "fits_broadcast",
    "gate",
    "high_water",
    "in_range",
    "keep_latest",
    "lookup",
    "mark_value",
    "newer_than",
    "not_null",
    "null_counts",
    "payload_bytes",
    "predicate",
    "quality_counts",
    "quality_metrics",
    "rejected_rows",
    "replace_children",
    "restrict_children",
    "since",
    "tag",
    "typed_projection",
    "undated_children",
    "upsert",
]
