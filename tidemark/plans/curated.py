"""Clean -> curated: increment, child lists, dimensions, upsert."""

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.errors import NothingToDo
from tidemark.operators.conform import align
from tidemark.operators.enrich import attach, child_lists, lookup
from tidemark.operators.incremental import mark_value, since
from tidemark.operators.sizes import BROADCAST_BYTES, fits_broadcast, shuffles_of
from tidemark.sinks.writers import merge_into
from tidemark.sources.tables import Table
from tidemark.staging import scratch, staged


@dataclass(frozen=True)
class ChildLists:
    """A child relation to list per parent; ``keys`` maps its keys to the parent's."""

    rows: DataFrame
    keys: Mapping[str, str]
    code: str
    alias: str


@dataclass(frozen=True)
class Dimension:
    """A directory to look up; ``columns`` maps its columns to the curated ones."""

    rows: DataFrame
    on: str
    key: str
    columns: Mapping[str, str]


def build_curated(
    parents: DataFrame,
    children: Sequence[ChildLists],
    dimensions: Sequence[Dimension],
    small_parents: bool = False,
    max_broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Parents with the lists of their children and the names of their dimensions.

    Children are listed before they are joined, so no parent row is multiplied, and
    all lists share the parents' partitioning.
    """
    rows = parents
    for child in children:
        lists = child_lists(
            child.rows, child.keys, child.code, child.alias, parents, small_parents
        )
        rows = attach(rows, lists, child.keys)
    for dim in dimensions:
        rows = lookup(rows, dim.rows, dim.on, dim.key, dim.columns, max_broadcast_bytes)
    return rows


@dataclass(frozen=True)
class CuratedJob:
    parents: Table
    children: Sequence[tuple[Table, Mapping[str, str], str, str]]
    """Child table, its keys mapped to the parent's, code column, list column."""
    dimensions: Sequence[tuple[Table, str, str, Mapping[str, str]]]
    """Directory, joining parent column, key, its columns mapped to the curated ones."""
    curated: Table
    mark: str = "created_at"
    """Parent column the increment is cut by. Upserts never change ``created_at``, so
    corrected parents only reach the curated table with ``updated_at``."""
    target_mark: str = "created_at"
    carry_mark: bool = False
    """Cut by the newest ``mark`` that was read from the parents, not by the curated
    table's own clock: parents stamped before that clock, but committed after the last
    run had read, are then not passed over."""


def run_curated(spark: SparkSession, job: CuratedJob, run_ts: datetime | None = None) -> int:
    """Bring new parents into the curated table; returns how many.

    The mark is the newest ``target_mark`` of the curated table, or with ``carry_mark`` the
    newest ``mark`` of the parents read so far. It is included, so rows at the mark are
    merged again, which changes nothing but their stamp. Each run leaves its mark beside
    the curated table; where it is missing it is read from the
    partitions that may hold it. A run that
    stops before that starts from the older mark again. Of the parents only the partitions
    that were written at or after the mark are read, where their table keeps that. Raises
    ``NothingToDo`` for an empty increment.
    """
    job.curated.require_merge_keys()
    kind = f"{'source' if job.carry_mark else 'target'}-{job.mark if job.carry_mark else job.target_mark}"
    mark = job.curated.stored_mark(spark, kind)
    if mark is None and not job.carry_mark:
        mark = job.curated.greatest(spark, job.target_mark)
    with scratch(spark, "curated") as folder:
        parents = staged(since(job.parents.read_since(spark, job.mark, mark), job.mark, mark), "increment", folder=folder)
        count = parents.count()
        if not count:
            raise NothingToDo(f"no rows at or after {mark}")
        known: dict[tuple[str | None, str], list[str]] = {}

        def touched(table: Table, keys: Mapping[str, str]) -> DataFrame:
            date = table.date and keys[table.date]
            if (date, table.grain) not in known:
                dated = parents.select(*[F.col(p).alias(c) for c, p in keys.items()])
                known[date, table.grain] = table.touched(dated) if date else []
            return table.read_parts(spark, known[date, table.grain])

        small = fits_broadcast(parents)
        children = [ChildLists(touched(t, keys), keys, code, alias) for t, keys, code, alias in job.children]
        built = build_curated(
            parents,
            children,
            [Dimension(t.read(spark), on, key, columns) for t, on, key, columns in job.dimensions],
            small_parents=small,
        )
        with shuffles_of(spark, max([count, *(child.rows.count() for child in children)])):
            batch = staged(align(built, job.curated.schema), "curated", folder=folder)
        parts = known.get((job.curated.date, job.curated.grain)) or job.curated.touched(batch)
        merge_into(job.curated, batch, run_ts, parts, small)
        if job.carry_mark:
            found = mark_value(parents, job.mark)
        else:
            found = mark_value(job.curated.read_parts(spark, parts), job.target_mark)
        marks = [m for m in (mark, found) if m is not None]
        # Marks of one column are all numbers or all moments printed alike.
        job.curated.store_mark(spark, kind, max(marks) if marks else None)
    return count
