from tidemark.functions.columns import (
    guarded_ratio,
    hash_key,
    month_start,
    parse_timestamp,
    run_clock,
)
from tidemark.functions.typing import typed_column

__all__ = [
    "guarded_ratio",
    "hash_key",
    "month_start",
    "parse_timestamp",
    "run_clock",
    "typed_column",
]
