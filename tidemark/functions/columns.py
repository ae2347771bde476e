"""Column expressions shared by the jobs. All of them stay inside the JVM."""

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: stands for a missing part of a natural key.
MISSING_KEY_PART = "EMPTY"

_CLOCK = r"( \d{2}:\d{2}:\d{2})?\z"
_YEAR_FIRST = r"\A\d{4}-\d{2}-\d{2}" + _CLOCK
_DAY_FIRST = r"\A\d{2}\.\d{2}\.\d{4}" + _CLOCK


def parse_timestamp(text: Column) -> Column:
    """``yyyy-MM-dd`` or ``dd.MM.yyyy``, each with or without ``HH:mm:ss``; else null.

    The result is a ``timestamp_ntz``, so it does not depend on the session zone.
    The layout test comes first because a bare cast also accepts ``2024`` or
    ``T``-separated text.
    """
    text = text.cast("string")
    year_first = F.concat(
        F.substring(text, 7, 4),
        F.lit("-"),
        F.substring(text, 4, 2),
        F.lit("-"),
        F.substring(text, 1, 2),
        F.substring(text, 11, 9),
    )
    layout = F.when(text.rlike(_YEAR_FIRST), text).when(text.rlike(_DAY_FIRST), year_first)
    return layout.try_cast("timestamp_ntz")


def hash_key(*parts: Column) -> Column:
    """md5 over the parts of a natural key; a missing part hashes as a fixed word."""
    texts = [F.coalesce(part.cast("string"), F.lit(MISSING_KEY_PART)) for part in parts]
    return F.md5(F.concat_ws("-", *texts))


def guarded_ratio(weight: Column, height: Column) -> Column:
    """Weight over squared height in metres, one digit; null unless both are positive."""
    metres = height / F.lit(100)
    return F.when((height > 0) & (weight > 0), F.round(weight / (metres * metres), 1))


def month_start(moment: Column) -> Column:
    """First day of the month, as a date."""
    return F.trunc(moment, "MM")


def run_clock(run_ts: datetime | None = None) -> Column:
    """Load stamp: the time given for the run, or the session's clock."""
    if run_ts is None:
        return F.current_timestamp().cast("timestamp_ntz")
    return F.lit(run_ts.isoformat(sep=" ")).cast("timestamp_ntz")
