"""Reference directories: delimited file -> upsert by id."""

from datetime import datetime

from pyspark.sql import SparkSession

from tidemark.errors import NotNullError
from tidemark.operators.quality import null_counts
from tidemark.sinks.writers import merge_into
from tidemark.sources.readers import read_delimited
from tidemark.sources.tables import Table


def load_reference(
    spark: SparkSession, path: str, table: Table, sep: str = ";", run_ts: datetime | None = None
) -> None:
    """Merge a reference file into its directory.

    File readers do not enforce declared not-null columns, so they are checked here.
    """
    incoming = read_delimited(spark, path, table.schema, sep=sep)
    required = [f.name for f in table.schema.fields if not f.nullable]
    if required:
        missing = null_counts(incoming, required).filter("null_rows > 0").collect()
        if missing:
            raise NotNullError(", ".join(f"{r.column_name}: {r.null_rows}" for r in missing))
    merge_into(table, incoming, run_ts, frozen=())
