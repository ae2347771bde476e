"""Work folders on the storage every executor can reach.

An executor can be lost at any time, so intermediate results that are read more
than once are written as Parquet under ``spark.checkpoint.dir`` instead of being
kept on executors.
"""

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession

from tidemark.errors import TidemarkError
from tidemark.files import COMPRESSION, Files

_fallback: list[str] = []
_scopes: ContextVar[tuple[str, ...]] = ContextVar("scopes", default=())


def use_folder(path: str) -> None:
    """The folder to work in where a session names none; it must be shared by all machines."""
    _fallback[:] = [path]


def work_root(spark: SparkSession) -> str | None:
    """The folder to work in: the session's checkpoint folder, else the one given for that case."""
    return spark.conf.get("spark.checkpoint.dir", None) or next(iter(_fallback), None)


def work_dir(spark: SparkSession, label: str) -> str:
    """A new folder, never used before, below the folder to work in."""
    root = work_root(spark)
    if not root:
        raise TidemarkError("spark.checkpoint.dir must name a shared folder")
    return f"{root.rstrip('/')}/tidemark/{label}-{uuid.uuid4().hex}"


def staged(
    df: DataFrame, label: str, partition_by: tuple[str, ...] = (), folder: str | None = None, keep: bool = False
) -> DataFrame:
    """Write ``df`` once and hand back a scan of what was written.

    Without a ``folder`` of the caller's the copy goes with the ``scratch`` that it is made in,
    or with ``keep``, as the result of that scope, with the one around it. Outside of any it
    stays, because what is built on it may be read at any later time.
    """
    spark = df.sparkSession
    scopes = _scopes.get()[:-1] if keep else _scopes.get()
    inside = folder or next(reversed(scopes), None)
    path = f"{inside}/{label}{'' if folder else '-' + uuid.uuid4().hex}" if inside else work_dir(spark, label)
    df.write.option("compression", COMPRESSION).partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def staged_and_counted(
    df: DataFrame, label: str, folder: str, counts: Sequence[Column], partition_by: tuple[str, ...] = ()
) -> tuple[DataFrame, dict]:
    """``staged``, and the named aggregates ``counts`` over what was written, taken in the same
    pass. They are added up where the rows are written, by tasks that succeeded, so a task that
    runs again is counted once."""
    seen = Observation()
    rows = staged(df.observe(seen, *counts), label, partition_by, folder)
    return rows, seen.get


@contextmanager
def scratch(spark: SparkSession, label: str) -> Iterator[str]:
    """A folder for the staged copies of one run, removed when the run ends or fails."""
    path = work_dir(spark, label)
    outer = _scopes.set((*_scopes.get(), path))
    try:
        yield path
    finally:
        _scopes.reset(outer)
        Files(spark, path).delete()
