"""Declared Parquet tables with a derived date partition."""

import json
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import MergeKeysError, TidemarkError
from tidemark.files import COMPRESSION, Files
from tidemark.operators.conform import require_conformable
from tidemark.operators.incremental import mark_value, micros
from tidemark.sources.swaps import Swaps, Written

PARTITION_COLUMN = "part_date"

# Fixed value: partition of the rows without a business date. It is a real date,
# so equality on the partition column also finds these rows.
NO_DATE = "0001-01-01"

#: Most partitions that one batch may touch; a calendar of days has fewer.
MOST_PARTITIONS = 100_000
#: Most files that a batch may match and still be merged file by file.
MOST_FILES = 10_000
#: A partition of more files is rewritten whole by the next batch that matches rows in it.
FILES_A_PARTITION = 200
#: Partitions whose files are listed at the same time.
_LISTERS = 16

#: Most values that are looked up as literals.
FEW_VALUES = 500
#: Values of one list that the file reader turns into equalities, which Bloom filters answer.
_LISTED = 10
#: Small files get small filters.
_BLOOM_SIZES = {"parquet.bloom.filter.adaptive.enabled": "true"}

_MARKS = "_marks"


@dataclass(frozen=True)
class Table:
    """A folder of Parquet files with a declared schema.

    ``date`` names the business time whose ``grain`` (``month`` or ``day``)
    partitions the table; without it the table is one partition. ``null_safe`` makes
    null keys equal when batches are merged. One job at a time may write a table.

    Files are sorted by the columns of ``cluster`` and carry a Bloom filter for each, so that
    a search for a few of their values reads the row groups that may hold one.

    Of the ``stamps`` among the columns the greatest value written is kept for every
    partition, beside the table, so that increments cut by one of them read only the
    partitions that changed.
    """

    path: str
    schema: T.StructType
    keys: tuple[str, ...] = ()
    date: str | None = None
    grain: str = "month"
    null_safe: bool = False
    stamps: tuple[str, ...] = ("created_at", "updated_at")
    cluster: tuple[str, ...] = ()

    def partition(self) -> Column:
        if self.date is None:
            return F.lit(NO_DATE).cast("date")
        day = F.col(self.date).cast("date")
        value = F.trunc(day, "MM") if self.grain == "month" else day
        return F.coalesce(value, F.lit(NO_DATE).cast("date"))

    def require_merge_keys(self) -> tuple[str, ...]:
        """The merge keys. The date must be one: else a row whose date changes would be
        looked for in its new partition only, and stay in the old one as well."""
        if not self.keys:
            raise MergeKeysError(f"{self.path} has no merge keys")
        if self.date is not None and self.date not in self.keys:
            raise MergeKeysError(f"{self.path} is partitioned by {self.date!r}, which is not a merge key")
        return self.keys

    def read(self, spark: SparkSession) -> DataFrame:
        """Declared columns in declared order; a table not written yet is empty.

        Passing the declaration to the scan is what lets files written under an
        older one be read: missing columns are null, dropped ones are not read,
        narrower numbers are widened. The declarations that files were written under are kept
        beside the table: one that cannot be brought to this without losing values raises
        ``SchemaChangeError`` before anything is read, as ``conform`` does.
        """
        return self._scan(spark).drop(PARTITION_COLUMN)

    def partitions_of(self, rows: DataFrame) -> DataFrame:
        """The partitions that ``rows`` falls into, one row each."""
        return rows.select(self.partition().alias(PARTITION_COLUMN)).distinct()

    def touched(self, rows: DataFrame) -> list[str]:
        """The same as a list of days: one job, and no more than a calendar holds."""
        text = self.partitions_of(rows).select(F.col(PARTITION_COLUMN).cast("string"))
        found = sorted(r[0] for r in text.limit(MOST_PARTITIONS + 1).collect())
        if len(found) > MOST_PARTITIONS:
            raise TidemarkError(f"a batch for {self.path} touches over {MOST_PARTITIONS} partitions")
        return found

    def read_parts(self, spark: SparkSession, parts: Sequence[str]) -> DataFrame:
        """Rows in the given partitions. The list is literal, so no other file is listed
        for the scan, whatever the size of the batch that touches them."""
        if self.date is None:
            return self.read(spark)
        return self._scan(spark).filter(self._among(parts)).drop(PARTITION_COLUMN)

    def read_touched(self, spark: SparkSession, batch: DataFrame) -> DataFrame:
        """Rows in the partitions that the batch falls into, and no others."""
        return self.read(spark) if self.date is None else self.read_parts(spark, self.touched(batch))

    def parts_since(self, spark: SparkSession, column: str, mark: Any | None, strict: bool = False) -> list[str] | None:
        """Partitions that may hold a row with ``column`` at or after ``mark``, or only after it
        when ``strict``.

        They are those that were written with such a row, or of which it is not known. None
        where nothing is known: without a mark, for a column that is no stamp, and for a
        table that was written without keeping what it is known by.
        """
        at = None if mark is None or self.date is None else micros(mark)
        if at is None or column not in self._stamped():
            return None
        swaps = Swaps(spark, self.path)
        swaps.finish()
        known = swaps.changes()
        if not known.parts:
            return None
        ahead = f"{PARTITION_COLUMN}="
        there = [n for n in Files(spark, self.path).names() if n.startswith(ahead)]

        def may(part: str) -> bool:
            bound = known.bound(part, column, unknown=at + 1)
            return bound is not None and (bound > at if strict else bound >= at)

        return [p.removeprefix(ahead) for p in there if may(p)]

    def read_since(self, spark: SparkSession, column: str, mark: Any | None, strict: bool = False) -> DataFrame:
        """Rows of ``parts_since``; all rows where that is not known. They are still to be cut
        by the mark."""
        parts = self.parts_since(spark, column, mark, strict)
        return self.read(spark) if parts is None else self.read_parts(spark, parts)

    def greatest(self, spark: SparkSession, column: str) -> Any | None:
        """``mark_value`` of the table, from the partitions that may hold the greatest value.

        What is kept beside the table bounds a stamp from above, and rows may have gone since.
        So the partitions of the highest bound are read first; if what they hold is less than
        other bounds, the partitions of those are read too. Without that knowledge the whole
        column is read.
        """
        parts = self.parts_since(spark, column, 0)
        known = Swaps(spark, self.path).changes().parts
        bounds = {p: known.get(f"{PARTITION_COLUMN}={p}", {"bounds": {}})["bounds"].get(column) for p in parts or ()}
        if not parts or None in bounds.values():
            return mark_value(self.read(spark), column)
        high = max(bounds.values())
        found = mark_value(self.read_parts(spark, [p for p in parts if bounds[p] == high]), column)
        at = None if found is None else micros(found)
        more = [p for p in parts if bounds[p] < high and (at is None or bounds[p] > at)]
        also = mark_value(self.read_parts(spark, more), column) if more else None
        return max((m for m in (found, also) if m is not None), key=lambda m: micros(m) or 0, default=None)

    def holds(self, spark: SparkSession, parts: Sequence[str]) -> bool:
        """Whether any of ``parts`` has files."""
        return any(self._file_counts(spark, parts))

    def files_holding(
        self, batch: DataFrame, keys: Mapping[str, str], parts: Sequence[str], null_safe: bool = False, small: bool = True
    ) -> list[str] | None:
        """Files of ``parts`` with a row whose ``keys`` (column to batch column) are those of a
        row of ``batch``. A ``small`` batch is broadcast; for another the keys of both sides are
        shuffled. Up to ``FEW_VALUES`` values of a clustering key are looked up by the files'
        Bloom filters.

        None where rewriting whole partitions is as good: when half of their files match, or
        one of them has come to hold more than ``FILES_A_PARTITION``.
        """
        spark = batch.sparkSession
        counts = self._file_counts(spark, parts)
        if not any(counts):
            return []
        sought = batch.select(*[F.col(b).alias(f"__{c}") for c, b in keys.items()]).distinct()
        same = [F.col(c).eqNullSafe(F.col(f"__{c}")) if null_safe else F.col(c) == F.col(f"__{c}") for c in keys]
        rows = self._scan(spark)
        rows = rows if self.date is None else rows.filter(self._among(parts))
        for column in self.cluster:
            if column in keys:
                values = sought.select(f"__{column}").distinct().limit(FEW_VALUES + 1).collect()
                if len(values) <= FEW_VALUES and not (null_safe and any(v[0] is None for v in values)):
                    rows = rows.filter(one_of(column, [v[0] for v in values if v[0] is not None]))
        rows = rows.select(*keys, F.col("_metadata.file_path").alias("__file"))
        held = rows.join(F.broadcast(sought) if small else sought, reduce(lambda a, b: a & b, same), "left_semi").select("__file").distinct()
        found = ["/".join(r[0].split("/")[-2:]) for r in held.limit(MOST_FILES + 1).collect()]
        if len(found) > MOST_FILES:
            return None
        crowded = max(counts, default=0) > FILES_A_PARTITION
        return None if found and (crowded or 2 * len(found) > sum(counts)) else sorted(found)

    def read_files(self, spark: SparkSession, files: Sequence[str]) -> DataFrame:
        """Rows of the given files, which ``files_holding`` named."""
        part = T.StructField(PARTITION_COLUMN, T.DateType())
        schema = T.StructType([*self.file_schema().fields, part])
        if not files:
            return spark.createDataFrame([], schema).drop(PARTITION_COLUMN)
        paths = [f"{self.path.rstrip('/')}/{name}" for name in files]
        return spark.read.schema(schema).option("basePath", self.path).parquet(*paths).drop(PARTITION_COLUMN)

    def replace(self, rows: DataFrame, parts: Sequence[str] | None = None) -> None:
        """Put ``rows`` in the place of the partitions that they fall into, and of ``parts``.

        ``rows`` may be computed from those same partitions. They are written beside the
        table first, and a swap that survives a crash puts them in place. Partitions of
        ``parts`` without rows are removed. The swap goes partition by partition.
        """
        swaps = Swaps(rows.sparkSession, self.path)
        swap = swaps.start()
        written = self._write(rows, f"{self.path}/{swap}")
        swaps.put_partitions(swap, [f"{PARTITION_COLUMN}={p}" for p in parts or ()], written)

    def rewrite(self, rows: DataFrame, files: Sequence[str]) -> None:
        """Put ``rows`` in the place of ``files``; other files of their partitions stay. The
        swap is that of ``replace``, file by file."""
        swaps = Swaps(rows.sparkSession, self.path)
        swap = swaps.start()
        written = self._write(rows, f"{self.path}/{swap}")
        swaps.put_files(swap, files, written)

    def finish_swaps(self, spark: SparkSession) -> None:
        """Finish what a writer that has stopped left behind; else nothing."""
        Swaps(spark, self.path).finish()

    def stored_mark(self, spark: SparkSession, name: str) -> str | int | None:
        """The mark that the last run left beside the table."""
        text = Files(spark, self.path).read(f"{_MARKS}/{name}")
        return None if text is None else json.loads(text)

    def store_mark(self, spark: SparkSession, name: str, mark: str | int | None) -> None:
        if mark is not None:
            Files(spark, self.path).write(f"{_MARKS}/{name}", json.dumps(mark))

    def file_schema(self) -> T.StructType:
        """The declared columns; files do not enforce not-null."""
        return T.StructType([T.StructField(f.name, f.dataType) for f in self.schema.fields])

    def _file_counts(self, spark: SparkSession, parts: Sequence[str]) -> list[int]:
        self.finish_swaps(spark)
        files = Files(spark, self.path)
        there = {*files.names()}
        named = [f"{PARTITION_COLUMN}={p}" for p in (parts if self.date else [NO_DATE])]
        with ThreadPoolExecutor(_LISTERS) as listers:
            return list(listers.map(lambda part: len(files.names(part)), [p for p in named if p in there]))

    def _among(self, parts: Sequence[str]) -> Column:
        days = ", ".join(f"DATE '{p}'" for p in parts)
        return F.expr(f"{PARTITION_COLUMN} IN ({days})") if parts else F.lit(False)

    def _stamped(self) -> list[str]:
        kinds = (T.TimestampType, T.TimestampNTZType)
        return [c for c in self.stamps if c in self.schema.names and isinstance(self.schema[c].dataType, kinds)]

    def _write(self, rows: DataFrame, path: str) -> Written:
        """Write the partitions; the greatest stamps are observed while writing."""
        placed = rows.withColumn(PARTITION_COLUMN, self.partition()).hint("rebalance", PARTITION_COLUMN)
        stamps = self._stamped()
        seen = Observation()
        if stamps:
            greatest = [F.max(_micros(F.col(c), self.schema[c].dataType)).alias(c) for c in stamps]
            placed = placed.observe(seen, *greatest)
        if self.cluster:
            placed = placed.sortWithinPartitions(PARTITION_COLUMN, *self.cluster)
        blooms = {f"parquet.bloom.filter.enabled#{c}": "true" for c in self.cluster} | _BLOOM_SIZES
        placed.write.options(**blooms).option("compression", COMPRESSION).partitionBy(PARTITION_COLUMN).parquet(path)
        return Written(T.StructType(rows.schema.fields).json(), {c: seen.get.get(c) for c in stamps})

    def _scan(self, spark: SparkSession) -> DataFrame:
        self.finish_swaps(spark)
        for older in Swaps(spark, self.path).changes().in_use():
            require_conformable(T.StructType.fromJson(json.loads(older)), self.schema)
        part = T.StructField(PARTITION_COLUMN, T.DateType())
        schema = T.StructType([*self.file_schema().fields, part])
        try:
            return spark.read.schema(schema).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], schema)


def one_of(column: str, values: Sequence[Any]) -> Column:
    """Whether ``column`` is one of a few values, so that a scan can ask Bloom filters."""
    lists = [F.col(column).isin(list(values[i : i + _LISTED])) for i in range(0, len(values), _LISTED)]
    return reduce(lambda a, b: a | b, lists, F.lit(False))


def _micros(column: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column)
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), column)
