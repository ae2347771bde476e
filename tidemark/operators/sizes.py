"""Measured size of a join side, so that only bounded sides are broadcast, and of shuffles."""

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 * 1024 * 1024

#: Rows that a task is given of a shuffle, about, however many there are in all.
PARTITION_ROWS = 100_000

_PARTITIONS = "spark.sql.shuffle.partitions"
_VALUE_OVERHEAD = 16


def row_bytes(schema: T.StructType) -> Column:
    """Bytes that a row with the columns of ``schema`` carries."""

    def width(kind: T.DataType, value):
        if isinstance(kind, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(value), F.lit(0)) + _VALUE_OVERHEAD
        if isinstance(kind, T.ArrayType):
            if isinstance(kind.elementType, (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType)):
                parts = F.aggregate(value, F.lit(0).cast("bigint"), lambda a, v: a + width(kind.elementType, v))
            else:
                parts = F.size(value) * _VALUE_OVERHEAD
            return F.coalesce(parts, F.lit(0)) + _VALUE_OVERHEAD
        if isinstance(kind, T.StructType):
            return reduce(lambda a, b: a + b, [width(f.dataType, value[f.name]) for f in kind.fields], F.lit(_VALUE_OVERHEAD))
        if isinstance(kind, T.MapType):
            return width(T.ArrayType(kind.keyType), F.map_keys(value)) + width(
                T.ArrayType(kind.valueType), F.map_values(value)
            )
        return F.lit(_VALUE_OVERHEAD)

    return reduce(lambda a, b: a + b, [width(f.dataType, F.col(f.name)) for f in schema.fields]).cast("bigint")


def payload_bytes(df: DataFrame) -> int:
    """Bytes the rows of ``df`` carry, from one distributed aggregate."""
    return df.agg(F.sum(row_bytes(df.schema))).first()[0] or 0


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether the rows of ``df`` carry at most ``limit`` bytes, as measured.

    File sizes and the optimizer's estimates prove nothing: files of repeated values unpack to
    many times their size, and rows made by a plan are not in them. A row count, which reads
    no columns, comes first; only where it leaves the matter open the bytes are added up.
    """
    least = df.count() * len(df.columns) * _VALUE_OVERHEAD
    return least <= limit and payload_bytes(df) <= limit


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint when its size allows it."""
    return F.broadcast(df) if fits_broadcast(df, limit) else df


@contextmanager
def shuffles_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Within, shuffles have a partition for every ``PARTITION_ROWS`` of ``rows``, or as many as
    the session asks for, if that is more. So what one task sorts does not grow with the rows.
    Small partitions are put together again by adaptive execution."""
    before = spark.conf.get(_PARTITIONS)
    spark.conf.set(_PARTITIONS, str(max(int(before), -(-rows // PARTITION_ROWS))))
    try:
        yield
    finally:
        spark.conf.set(_PARTITIONS, before)
