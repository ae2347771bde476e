"""Typed projection of raw rows, and tables brought to a new declaration."""

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.errors import ParseException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import SchemaChangeError
from tidemark.functions.typing import typed_column

# Changes of type that keep every value.
_WIDER: dict[type, tuple[type, ...]] = {
    T.ByteType: (T.ShortType, T.IntegerType, T.LongType, T.DoubleType),
    T.ShortType: (T.IntegerType, T.LongType, T.DoubleType),
    T.IntegerType: (T.LongType, T.DoubleType),
    T.FloatType: (T.DoubleType,),
    T.DateType: (T.TimestampNTZType,),
}


def declared(fields: Sequence[Mapping[str, Any]]) -> T.StructType:
    """Schema from ``{name, type, nullable}`` entries; names are lower-cased."""
    return T.StructType(
        [
            T.StructField(f["name"].lower(), _parse_type(f["type"]), f.get("nullable", True))
            for f in fields
        ]
    )


def _parse_type(text: str) -> T.DataType:
    try:
        return T.DataType.fromDDL(text)
    except ParseException as error:
        raise SchemaChangeError(f"unknown type {text!r}") from error


def typed_projection(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the declared fields in declared order, each value typed on its own.

    A value that does not fit becomes null, and so does a field the batch lacks.
    """
    present = {f.name.lower(): f for f in df.schema.fields}

    def column(field: T.StructField):
        found = present.get(field.name.lower())
        if found is None:
            return F.lit(None).cast(field.dataType).alias(field.name)
        return typed_column(F.col(found.name), found.dataType, field.dataType).alias(field.name)

    return df.select(*[column(f) for f in schema.fields])


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The declared columns in declared order; a missing one is an analysis error."""
    return df.select(*[F.col(f.name) for f in schema.fields])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows written under an older declaration, brought to ``schema``.

    Columns that are no longer declared are dropped, missing ones are added as
    nulls, and types are widened. A missing not-null column or a change that could
    lose values raises. Names are compared in lower case.
    """
    require_conformable(df.schema, schema)
    present = {f.name.lower(): f for f in df.schema.fields}

    def column(field: T.StructField):
        name = field.name.lower()
        found = present.get(name)
        value = F.lit(None) if found is None else F.col(found.name)
        kept = found is not None and found.dataType == field.dataType
        return (value if kept else value.cast(field.dataType)).alias(name)

    return df.select(*[column(f) for f in schema.fields])


def require_conformable(old: T.StructType, new: T.StructType) -> None:
    """Raise unless rows of the one declaration can be brought to the other without a loss."""
    present = {f.name.lower(): f.dataType for f in old.fields}
    for field in new.fields:
        name = field.name.lower()
        found = present.get(name)
        if found is None and not field.nullable:
            raise SchemaChangeError(f"new column {name!r} cannot be not null")
        if found is not None and not _same(found, field.dataType) and not _widens(found, field.dataType):
            raise SchemaChangeError(
                f"column {name!r} cannot change from {found.simpleString()} to {field.dataType.simpleString()}"
            )


def _same(old: T.DataType, new: T.DataType) -> bool:
    """Equal but for what may be null, which files do not keep."""
    return old == new or old.simpleString() == new.simpleString()


def _widens(old: T.DataType, new: T.DataType) -> bool:
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType):
        return new.scale == old.scale and new.precision >= old.precision
    return isinstance(new, _WIDER.get(type(old), ()))
