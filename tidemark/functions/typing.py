"""Cast of one column to its declared type, never failing the batch."""

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)

# A failing cast costs an exception per value, so text is tested before it is cast.
_DIGITS = r"\A\s*[+-]?\d+\s*\z"
_NUMBER = r"\A\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*\z"
_JSON_ARRAY = r"\A\s*\["


def typed_column(column: Column, current: T.DataType, declared: T.DataType) -> Column:
    """``column`` as ``declared``; a value that does not fit becomes null.

    Text declared as an array is read as a JSON array. Whole numbers accept text
    such as ``3.7`` and drop the fraction, as a cast from a number would.
    """
    if isinstance(declared, T.ArrayType):
        if isinstance(current, T.ArrayType):
            return column.try_cast(declared)
        text = column.cast("string")
        return F.when(text.rlike(_JSON_ARRAY), F.from_json(text, declared))
    if isinstance(declared, _WHOLE) and isinstance(current, T.StringType):
        return F.when(column.rlike(_DIGITS), column.try_cast(declared)).when(
            column.rlike(_NUMBER), column.try_cast("double").try_cast(declared)
        )
    return column.try_cast(declared)
