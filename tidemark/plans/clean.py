"""Raw -> clean: type, tag, quarantine, gate, upsert, replace children."""

import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.conform import typed_projection
from tidemark.operators.dml import explode_children, inserted, replace_children, undated_counts
from tidemark.operators.quality import (
    ERRORS,
    Rule,
    clean_rows,
    enforce_gate,
    quality_counts,
    rejected_rows,
    tag,
)
from tidemark.operators.sizes import BROADCAST_BYTES, row_bytes, shuffles_of
from tidemark.sinks.writers import QualityRecord, merge_into, metrics_scope, write_quarantine
from tidemark.sources.tables import Table
from tidemark.staging import scratch, staged_and_counted

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class ChildTable:
    """A child table filled from one array column of the batch.

    ``keys`` maps its key columns, of which ``table.date`` is one, to the batch's.
    """

    table: Table
    keys: dict[str, str]
    array: str
    code: str


@dataclass(frozen=True)
class CleanJob:
    raw_schema: T.StructType
    rules: Sequence[Rule]
    limit_percent: float
    shape: Callable[[DataFrame], DataFrame]
    """Typed clean rows -> columns of the clean table plus the child arrays."""
    clean: Table
    children: Sequence[ChildTable]
    quarantine: str
    metrics: str


def run_clean(raw: DataFrame, job: CleanJob, ds: str, run_ts: datetime | None = None) -> QualityRecord:
    """Load one raw batch. Metrics are stored whatever happens.

    The batch is parsed once: the tagged rows are staged with clean and rejected
    rows in folders of their own, and everything after reads those. They are counted while
    they are written, and so is what the clean batch weighs. The copies go when the run ends. Children that cannot be placed for want of a date are counted in the
    record, as are records that could not be read; an empty batch and anything left out
    is also logged.
    """
    spark = raw.sparkSession
    job.clean.require_merge_keys()
    with metrics_scope(spark, job.metrics, ds) as record, scratch(spark, "clean") as folder:
        tagged = tag(typed_projection(raw, job.raw_schema), job.rules)
        tagged = tagged.withColumn("rejected", F.size(ERRORS) > 0)
        tagged, counts = staged_and_counted(tagged, "tagged", folder, quality_counts(tagged), ("rejected",))
        record.take(counts)
        rejected = rejected_rows(tagged.filter("rejected").drop("rejected"), run_ts)
        write_quarantine(rejected, job.quarantine, ds)
        if not record.total_rows:
            log.warning("the batch of %s is empty", ds)
            return record
        if record.corrupt_rows:
            log.warning("%d records of %s could not be read", record.corrupt_rows, ds)
        enforce_gate({"error_percent": record.error_percent}, job.limit_percent)

        clean = clean_rows(tagged.filter("not rejected").drop("rejected"))
        shaped = job.shape(clean)
        undated = undated_counts([(c.keys[c.table.date], c.array) for c in job.children])
        size = F.sum(row_bytes(shaped.schema)).alias("bytes")
        batch, counts = staged_and_counted(shaped, "batch", folder, [*undated, size])
        small = (counts.pop("bytes") or 0) <= BROADCAST_BYTES
        record.undated_children = sum(n or 0 for n in counts.values())
        if record.undated_children:
            log.warning("%d children of %s have no date and are left out", record.undated_children, ds)
        merge_into(job.clean, batch, run_ts, small=small)
        for child in job.children:
            _replace(batch, child, small, run_ts)
    return record


def _replace(batch: DataFrame, child: ChildTable, small: bool, run_ts: datetime | None) -> None:
    table = child.table
    dated = batch.filter(F.col(child.keys[table.date]).isNotNull())
    # A partition whose parents all come without children may lose its last row: it goes.
    parts = table.touched(dated.select(*[F.col(b).alias(c) for c, b in child.keys.items()]))
    spark = batch.sparkSession
    if not table.holds(spark, parts):
        fresh = explode_children(dated, child.keys, child.array, child.code, table.date)
        table.rewrite(inserted(fresh, table.file_schema(), run_ts), [])
        return
    files = table.files_holding(dated, child.keys, parts) if small else None
    held = table.read_parts(spark, parts) if files is None else table.read_files(spark, files)
    rows = replace_children(
        held,
        dated,
        child.keys,
        child.array,
        child.code,
        date=table.date,
        run_ts=run_ts,
        small_batch=small,
    )
    with shuffles_of(spark, 0 if small else held.count() + dated.count()):
        if files is None:
            table.replace(rows, parts)
        else:
            table.rewrite(rows, files)
