"""Scans of raw files, reference files, tables and stored quality metrics."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import MetricsMissingError
from tidemark.sources.arrays import read_arrays

# Fixed value: column that holds the text of a record the reader could not parse.
CORRUPT_COLUMN = "_corrupt_record"

#: Bytes above which a multi-line document is split over tasks.
SPLIT_ABOVE = 32 << 20

# Fixed value: stands in no JSON text, which has no control characters but white space.
_NOWHERE = "\0\1\0\1"

# The first four fields are those of the stored record; older records have
# no others, which are read as null.
METRICS_SCHEMA = T.StructType(
    [
        T.StructField("total_rows", T.LongType()),
        T.StructField("valid_rows", T.LongType()),
        T.StructField("invalid_rows", T.LongType()),
        T.StructField("error_percent", T.DoubleType()),
        T.StructField("corrupt_rows", T.LongType()),
        T.StructField("undated_children", T.LongType()),
    ]
)


def text_schema(schema: T.StructType) -> T.StructType:
    """The declared fields, all as text, plus the column for broken records."""
    names = [f.name for f in schema.fields if f.name != CORRUPT_COLUMN]
    return T.StructType([T.StructField(n, T.StringType()) for n in [*names, CORRUPT_COLUMN]])


def read_raw_json(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    multiline: bool = True,
    split_above: int = SPLIT_ABOVE,
    folder: str | None = None,
) -> DataFrame:
    """Raw records as text columns; a broken document is kept in one column.

    Reading everything as text keeps one bad field from spoiling the other rows
    of its file, and spares the pass that infers a schema. ``typed_projection``
    types the rows. A multi-line document is read by one task, up to ``split_above`` bytes;
    a larger one, which must be an array of records, is split over tasks at the borders of
    its records (``read_arrays``, below ``folder``), and if it is broken only its first record
    is kept. Telling them apart costs a listing of the files.
    """
    declared = text_schema(schema)
    # A document is one line that nothing ends. The reader's own multi-line mode goes back to
    # the file for every number, list or record that is wanted as text.
    whole = {"lineSep": _NOWHERE} if multiline else {}

    def read(paths: str | list[str]) -> DataFrame:
        return (
            spark.read.schema(declared)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
            .options(**whole)
            .json(paths)
        )

    if not multiline:
        return read(path)
    files = spark.read.format("binaryFile").load(path).select("path", "length")
    large = [r.path for r in files.filter(F.col("length") > split_above).collect()]
    if not large:
        return read(path)
    split = read_arrays(spark, large, declared, CORRUPT_COLUMN, folder)
    small = [r.path for r in files.filter(F.col("length") <= split_above).collect()]
    return read(small).unionByName(split) if small else split


def read_delimited(
    spark: SparkSession, path: str, schema: T.StructType, header: bool = True, sep: str = ";"
) -> DataFrame:
    """Reference file with a declared schema; a header that disagrees with it is an error."""
    reader = spark.read.schema(schema).option("header", header).option("sep", sep)
    if header:
        reader = reader.option("enforceSchema", False)
    return reader.csv(path)


def read_table(
    spark: SparkSession, address: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """Table by catalog name, or by folder when the address is a path."""
    df = spark.read.parquet(address) if "/" in address else spark.read.table(address)
    return df.select(*columns) if columns else df


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """All rejected rows, with the union of the columns of every batch and the run date ``ds``."""
    rows = spark.read.option("mergeSchema", True).parquet(path)
    return rows.withColumn("ds", F.col("ds").cast("string"))


def read_metrics_history(spark: SparkSession, path: str) -> DataFrame:
    """One row per run date, with the run date as column ``ds``."""
    schema = T.StructType([*METRICS_SCHEMA.fields, T.StructField("ds", T.StringType())])
    return spark.read.schema(schema).json(path)


def read_metrics(spark: SparkSession, path: str, ds: str) -> DataFrame:
    """Metrics of one run date; none stored is an error."""
    found = read_metrics_history(spark, path).filter(F.col("ds") == ds)
    if found.isEmpty():
        raise MetricsMissingError(f"no quality metrics stored for {ds} in {path}")
    return found
