"""Curated -> mart: month column, strict delta, append, not-null checks, keep-latest."""

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import MergeKeysError, NotNullError
from tidemark.functions.columns import month_start
from tidemark.operators.dml import keep_latest
from tidemark.operators.incremental import mark_value, newer_than
from tidemark.sinks.writers import append_mart
from tidemark.sources.swaps import Swaps
from tidemark.sources.tables import Table
from tidemark.staging import scratch, staged

MONTH = "event_month"


def mart_stage(curated: DataFrame, date: str, month: str = MONTH) -> DataFrame:
    """Curated rows with the month of their business time."""
    return curated.withColumn(month, month_start(F.col(date)))


def mart_delta(staged_rows: DataFrame, mart: DataFrame, version: str = "updated_at") -> DataFrame:
    """Rows strictly newer than anything in the mart; all rows for an empty mart."""
    return newer_than(staged_rows, version, mark_value(mart, version))


def read_mart(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    keys: Sequence[str],
    version: str = "updated_at",
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """The mart as its readers see it: the newest row per key."""
    return keep_latest(_stored(spark, path, schema), keys, version, tiebreak)


def run_mart(
    curated: DataFrame | Table,
    path: str,
    date: str,
    keys: Sequence[str],
    required: Sequence[str],
    version: str = "updated_at",
) -> int:
    """Append what is new in ``curated`` to the mart; returns how many rows.

    Of a ``Table`` only the partitions that were written since the mark are read. ``keys`` are the mart's keys besides the month. The required columns are checked after
    the append, so a row with a null is reported once and keeps no newer row out: raises
    ``NotNullError`` when what was appended holds such rows.

    The newest version appended is left beside the mart for the next run; only where it
    is missing the mart is scanned for it. A run that stops between the two appends its
    rows again, which readers do not see: they keep one row per key.
    """
    if isinstance(curated, Table):
        spark = SparkSession.active()
        schema = mart_stage(spark.createDataFrame([], curated.file_schema()), date).schema
    else:
        spark = curated.sparkSession
        schema = mart_stage(curated, date).schema
    table = Table(path, schema)
    mark = table.stored_mark(spark, version)
    if mark is None:
        mark = mark_value(_stored(spark, path, schema), version)
    given = curated.read_since(spark, version, mark, strict=True) if isinstance(curated, Table) else curated
    with scratch(spark, "mart") as folder:
        delta = staged(newer_than(mart_stage(given, date), version, mark), "delta", folder=folder)
        counts = [F.count_if(F.col(c).isNull()) for c in required]
        total, months, *nulls = delta.agg(F.count(F.lit(1)), F.collect_set(_named(F.col(MONTH))), *counts).first()
        waiting = table.stored_mark(spark, _WAITING)
        if waiting is not None:  # before the append, so that none is forgotten
            table.store_mark(spark, _WAITING, sorted({*waiting, *months}))
        Swaps(spark, path).finish()
        append_mart(delta, path, MONTH, keys)
        table.store_mark(spark, version, mark_value(delta, version))
    missing = [f"{c}: {n}" for c, n in zip(required, nulls) if n]
    if missing:
        raise NotNullError(", ".join(missing))
    return total


def compact_mart(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    keys: Sequence[str],
    version: str = "updated_at",
    tiebreak: Sequence[str] = (),
    share: float = 0.2,
) -> list[str]:
    """Leave one row per key in the months where more than ``share`` of the rows are superseded.

    Returns those months. ``keys`` must hold the month, so that no key is in two. Rows are
    counted per month, for those months that were appended to since they were last looked
    at, if that is known. Readers see the same rows before and after: the newest per key
    stay. A compaction that stops before its end changes nothing, or is finished by whoever
    next reads or writes the mart.
    """
    if MONTH not in keys:
        raise MergeKeysError(f"keys of a mart that is compacted must hold {MONTH}")
    rows = _stored(spark, path, schema)
    table = Table(path, schema)
    waiting = table.stored_mark(spark, _WAITING)
    if waiting is not None:
        rows = rows.filter(_in_months(waiting))
    per_key = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))
    counted = per_key.groupBy(MONTH).agg(F.sum("__rows").alias("rows"), F.count(F.lit(1)).alias("kept"))
    found = counted.filter(F.col("rows") > F.col("kept")).select(_named(F.col(MONTH)), F.col("rows") - F.col("kept") > share * F.col("rows")).collect()
    crowded = sorted(month for month, much in found if much)
    if crowded:
        swaps = Swaps(spark, path)
        swap = swaps.start()
        kept = keep_latest(_stored(spark, path, schema).filter(_in_months(crowded)), keys, version, tiebreak)
        append_mart(kept, f"{path}/{swap}", MONTH, [k for k in keys if k != MONTH])
        swaps.put_partitions(swap)
    table.store_mark(spark, _WAITING, sorted(month for month, much in found if not much))
    return crowded


#: Name of the mark that lists the months with superseded rows, or that may have them.
_WAITING = "waiting-months"
_NO_MONTH = ""


def _named(month: Column) -> Column:
    return F.coalesce(month.cast("string"), F.lit(_NO_MONTH))


def _in_months(months: Sequence[str]) -> Column:
    """Literal, so that no file of another month is listed."""
    days = ", ".join(f"DATE '{m}'" for m in months if m != _NO_MONTH)
    named = F.expr(f"{MONTH} IN ({days})") if days else F.lit(False)
    return named | F.col(MONTH).isNull() if _NO_MONTH in months else named


def _stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    Swaps(spark, path).finish()
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
