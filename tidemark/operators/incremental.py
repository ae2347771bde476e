"""High-water marks and the increments they select.

A mark given by hand as a ``datetime`` without a zone is in UTC for a column with one.
"""

from datetime import datetime, timedelta, timezone
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: where an increment starts when the target holds nothing yet.
BEGINNING = datetime(1970, 1, 1)


def high_water(target: DataFrame, column: str) -> DataFrame:
    """One row with the greatest value of ``column``, null when there is none."""
    return target.agg(F.max(column).alias("mark"))


def mark_value(target: DataFrame, column: str) -> Any | None:
    """The high-water mark as a value: one collected row.

    As a literal it reaches the scan, where it prunes files and row groups. A moment with
    a time zone comes as microseconds since 1970, which no session or process zone can
    shift; other types come as they are printed.
    """
    mark = F.max(column)
    zoned = isinstance(target.schema[column].dataType, T.TimestampType)
    shown = F.unix_micros(mark) if zoned else mark.cast("string")
    return target.agg(shown.alias("mark")).first()["mark"]


def bounds(df: DataFrame, column: str) -> DataFrame:
    """One row with the least and the greatest value of ``column``."""
    return df.agg(F.min(column).alias("low"), F.max(column).alias("high"))


def since(df: DataFrame, column: str, mark: Any | None) -> DataFrame:
    """Rows at or after the mark; everything from the beginning without one."""
    return df.filter(F.col(column) >= _literal(df, column, BEGINNING if mark is None else mark))


def newer_than(df: DataFrame, column: str, mark: Any | None) -> DataFrame:
    """Rows strictly after the mark; all rows without one."""
    if mark is None:
        return df
    return df.filter(F.col(column) > _literal(df, column, mark))


def micros(mark: Any) -> int | None:
    """A mark on a moment as microseconds since 1970; None for one that cannot be read so.

    Moments of a column without a zone are counted as if they were in UTC.
    """
    if isinstance(mark, str):
        try:
            mark = datetime.fromisoformat(mark)
        except ValueError:
            return None
    if isinstance(mark, datetime):
        aware = mark if mark.tzinfo else mark.replace(tzinfo=timezone.utc)
        return (aware - BEGINNING.replace(tzinfo=timezone.utc)) // timedelta(microseconds=1)
    return mark if isinstance(mark, int) else None


def _literal(df: DataFrame, column: str, mark: Any):
    kind = df.schema[column].dataType
    if isinstance(kind, T.TimestampType):
        if isinstance(mark, datetime):
            mark = micros(mark)
        if isinstance(mark, int):
            return F.timestamp_micros(F.lit(mark))
    return F.lit(str(mark)).cast(kind)
