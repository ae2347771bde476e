"""Writers for quarantine, quality metrics, partitioned tables and the mart."""

import logging
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidemark.errors import QuarantineError
from tidemark.files import COMPRESSION, Files
from tidemark.operators.dml import inserted, upsert
from tidemark.operators.sizes import fits_broadcast, shuffles_of
from tidemark.sources.readers import METRICS_SCHEMA
from tidemark.sources.tables import Table

log = logging.getLogger(__name__)


@dataclass
class QualityRecord:
    """Quality numbers of one run; zeros until they are measured.

    Fixed values: the names of the first four fields are those of the stored record.
    """

    total_rows: int = 0
    valid_rows: int = 0
    invalid_rows: int = 0
    error_percent: float = 0.0
    corrupt_rows: int = 0
    undated_children: int = 0

    def take(self, metrics: Row | Mapping[str, int]) -> None:
        """The counts, and the percent from them, rounded as Python rounds it: to the nearer
        of two digits of the exact value, so that 1,001 of 20,000 is 5.0."""
        for name in ("total_rows", "valid_rows", "invalid_rows", "corrupt_rows"):
            setattr(self, name, metrics[name])
        share = self.invalid_rows / self.total_rows * 100 if self.total_rows else 0.0
        self.error_percent = round(share, 2)


def write_quarantine(df: DataFrame, path: str, ds: str) -> None:
    """Store the rejected rows of a run date, in the place of those stored before.

    Batches may differ in their columns. Without rows nothing is left of the run date.
    """
    try:
        files = Files(df.sparkSession, path)
        files.delete(f"ds={ds}")
        (
            df.withColumn("ds", F.lit(ds))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("ds")
            .parquet(path)
        )
    except Exception as error:
        raise QuarantineError(f"rejected rows could not be written: {error}") from error


def write_metrics(metrics: DataFrame, path: str, ds: str | None = None) -> None:
    """Store quality metrics as JSON, one file per run date, replacing earlier ones.

    ``metrics`` is one record of the run date ``ds``, or one record per value of
    its own ``ds`` column. Counts that it does not have are stored as 0.
    """
    rows = metrics if ds is None else metrics.withColumn("ds", F.lit(ds))
    stored = [
        F.col(f.name) if f.name in rows.columns else F.lit(0).cast(f.dataType).alias(f.name)
        for f in METRICS_SCHEMA.fields
    ]
    (
        rows.select(*stored, F.col("ds").cast("string"))
        .repartition("ds")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("ds")
        .json(path)
    )


@contextmanager
def metrics_scope(spark: SparkSession, path: str, ds: str) -> Iterator[QualityRecord]:
    """Store the run's metrics when the scope ends, also after a failure.

    A failure to store them is logged and never hides the outcome of the run.
    """
    record = QualityRecord()
    try:
        yield record
    finally:
        try:
            values = [tuple(getattr(record, n) for n in METRICS_SCHEMA.names)]
            write_metrics(spark.createDataFrame(values, METRICS_SCHEMA), path, ds)
        except Exception:
            log.exception("quality metrics of %s could not be stored", ds)


def merge_into(
    table: Table,
    batch: DataFrame,
    run_ts: datetime | None = None,
    parts: Sequence[str] | None = None,
    small: bool | None = None,
    frozen: Sequence[str] = ("id",),
    by_file: bool | None = None,
) -> None:
    """Upsert ``batch`` into ``table``, reading and replacing only what it touches.

    ``parts`` and ``small`` are what the caller already knows: the touched partitions, and
    whether the batch was measured to fit a broadcast. A small batch first looks for its keys
    in the touched partitions: only the files that hold one are read whole and rewritten, and
    new rows come in files of their own. Otherwise the partitions are rewritten. ``by_file``
    asks for the one or the other at any size; a batch that is not small is shuffled, not
    broadcast, in both. Where the touched partitions hold no files, nothing is looked for.
    """
    keys = table.require_merge_keys()
    spark = batch.sparkSession
    if parts is None:
        parts = table.touched(batch)
    if small is None:
        small = fits_broadcast(batch)
    if not table.holds(spark, parts):
        table.rewrite(inserted(batch, table.file_schema(), run_ts), [])
        return
    look = small if by_file is None else by_file
    files = table.files_holding(batch, {k: k for k in keys}, parts, table.null_safe, small) if look else None
    held = table.read_parts(spark, parts) if files is None else table.read_files(spark, files)
    rows = upsert(
        held,
        batch,
        keys,
        run_ts=run_ts,
        frozen=frozen,
        null_safe=table.null_safe,
        small_source=small,
    )
    with shuffles_of(spark, 0 if small else held.count() + batch.count()):
        if files is None:
            table.replace(rows, parts)
        else:
            table.rewrite(rows, files)


def append_mart(df: DataFrame, path: str, month: str, order: Sequence[str]) -> None:
    """Append rows by month, sorted within each file.

    Rebalancing gives files of even size and splits a month that holds most of the
    batch over several tasks.
    """
    (
        df.hint("rebalance", month)
        .sortWithinPartitions(month, *order)
        .write.mode("append")
        .option("compression", COMPRESSION)
        .partitionBy(month)
        .parquet(path)
    )
