"""Large JSON arrays, one to a file, read by many tasks.

A file is read as pieces that end at a closing brace, split by byte ranges like any text. How
deep a piece stands, and whether it begins inside of a string, follows from the pieces before
it: first within its range, for either state that the range may begin in, then over the few
ranges of the file. A record ends where the depth comes back to that of the array. Pieces of
one range make its records; what reaches over a border is put together afterwards.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.sizes import broadcast_if_small
from tidemark.staging import staged, work_dir

#: Most characters kept of a large document that is broken.
KEPT = 65_536

# What stands before the first record, before any other, and after the last.
_FIRST, _NEXT = r"^\s*\[\s*\{", r"^\s*,\s*\{"
_EMPTY_END, _END = r"^\s*\[\s*\]\s*$", r"^\s*\]\s*$"

_RANGE = ("file", "range")


def read_arrays(
    spark: SparkSession, paths: list[str], schema: T.StructType, corrupt: str, folder: str | None = None
) -> DataFrame:
    """The records of the files under ``schema``, all columns of which are text; a nested
    value is JSON without blanks.

    A file that is no array of records, or is cut short, or holds a record that cannot be
    read, gives one row instead, with its first record, or ``KEPT`` characters of that, in the
    column ``corrupt``.
    What is written in between lies below ``folder``, else in one of its own, which stays.
    """
    folder = folder or work_dir(spark, "arrays")
    pieces = staged(_measured(_pieces(spark, paths)), "pieces", folder=folder)
    at = staged(_range_states(pieces), "ranges", folder=folder)
    parts = staged(_parts(pieces.join(broadcast_if_small(at), [*_RANGE])), "parts", folder=folder)
    records = staged(_judged(_records(parts, folder), schema, corrupt), "records", folder=folder)
    # A row a file.
    files = parts.groupBy("file").agg(
        F.max("open").alias("open"), F.min_by(F.substring("text", 1, KEPT), F.struct("range", "nth")).alias("beginning")
    )
    wrong = records.groupBy("file").agg(F.bool_or("wrong").alias("wrong"))
    broken = staged(
        files.join(wrong, "file", "left").filter(F.col("open") | F.coalesce("wrong", F.lit(False))).select("file", "beginning"),
        "broken", folder=folder,
    )
    good = records.filter("not tail").join(broadcast_if_small(broken.select("file")), "file", "left_anti")
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields if f.name != corrupt]
    rows = broken.select(*empty, F.col("beginning").alias(corrupt)).select(*schema.names)
    return good.select("record.*").select(*schema.names).unionByName(rows)


def _pieces(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``value`` ends ahead of a closing brace, or at the end of the file."""
    return spark.read.option("lineSep", "}").text(paths).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("range"),
        F.monotonically_increasing_id().alias("place"),
        "value",
    )


def _count(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def _before(what: Column, over, default=0) -> Column:
    return F.coalesce(F.sum(what).over(over.rowsBetween(Window.unboundedPreceding, -1)), F.lit(default))


def _measured(pieces: DataFrame) -> DataFrame:
    """Pieces with ``quotes`` before them in their range, whether they ``turn`` from inside of
    a string to outside or back, and the depth behind them and the brace that follows, for a
    range that begins outside (``depth0``) or inside (``depth1``) of a string."""
    bare = F.regexp_replace("value", r"(?s)\\.", "")
    cut = F.split(bare, '"', -1)
    even, odd = F.filter(cut, lambda _, i: i % 2 == 0), F.filter(cut, lambda _, i: i % 2 == 1)
    apart = [F.array_join(even, ""), F.array_join(odd, "")]
    counted = pieces.withColumns(
        {"turn": (_count(bare, '"') % 2).cast("int")}
        | {f"d{k}": (_count(s, "{[") - _count(s, "}]")).cast("int") for k, s in enumerate(apart)}
    )
    within = Window.partitionBy(*_RANGE).orderBy("place")
    counted = counted.withColumn("quotes", (_before(F.col("turn"), within) % 2).cast("int"))

    def step(begins: int) -> Column:
        inside = (F.col("quotes") + begins) % 2 == 1
        closes = (F.col("quotes") + begins + F.col("turn")) % 2 == 0
        return F.when(inside, F.col("d1")).otherwise(F.col("d0")) - closes.cast("int")

    running = within.rowsBetween(Window.unboundedPreceding, 0)
    return counted.withColumns({f"depth{k}": F.sum(step(k)).over(running) for k in (0, 1)}).drop("d0", "d1")


def _range_states(pieces: DataFrame) -> DataFrame:
    """One row per range: whether it begins inside of a string, how deep, and the file's
    last place. The ranges of a file are few, so one window holds them."""
    ends = pieces.groupBy(*_RANGE).agg(
        F.sum("turn").alias("turns"), F.max("place").alias("last"),
        *[F.max_by(f"depth{k}", "place").alias(f"all{k}") for k in (0, 1)],
    )
    over = Window.partitionBy("file").orderBy("range")
    ends = ends.withColumn("inside", (_before(F.col("turns"), over) % 2).cast("int"))
    deeper = F.when(F.col("inside") == 1, F.col("all1")).otherwise(F.col("all0"))
    ends = ends.withColumns({"above": _before(deeper, over), "final": F.max_by("last", "range").over(Window.partitionBy("file"))})
    return ends.select(*_RANGE, "inside", "above", F.when(F.col("last") == F.col("final"), F.col("last")).alias("final"))


def _parts(pieces: DataFrame) -> DataFrame:
    """The records of each range, or what it has of them: ``ended`` ones end here. A file's
    last piece has no brace behind it; the file is ``open`` if it does not end the array."""
    depth = F.col("above") + F.when(F.col("inside") == 1, F.col("depth1")).otherwise(F.col("depth0"))
    outside = (F.col("quotes") + F.col("inside") + F.col("turn")) % 2 == 0
    tail = F.col("place").eqNullSafe(F.col("final"))
    known = pieces.withColumns({"ends": outside & (depth == 1) & ~tail, "open": tail & ~(outside & (depth == -1)), "tail": tail})
    within = Window.partitionBy(*_RANGE).orderBy("place")
    known = known.withColumn("nth", _before(F.col("ends").cast("int"), within))
    text = F.struct("place", F.when(F.col("tail"), F.col("value")).otherwise(F.concat("value", F.lit("}"))).alias("text"))
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(text)), lambda t: t["text"]), "")
    return known.groupBy(*_RANGE, "nth").agg(
        joined.alias("text"), F.bool_or("ends").alias("ended"), F.bool_or("tail").alias("tail"), F.bool_or("open").alias("open")
    )


def _records(parts: DataFrame, folder: str) -> DataFrame:
    """Whole records: those of one range as they are, others put together by their number."""
    counts = parts.groupBy(*_RANGE).agg(F.count_if("ended").alias("ended_here"))
    over = Window.partitionBy("file").orderBy("range")
    ahead = staged(counts.select(*_RANGE, _before(F.col("ended_here"), over).alias("ahead")), "numbers", folder=folder)
    numbered = parts.join(broadcast_if_small(ahead), [*_RANGE]).withColumn("number", F.col("ahead") + F.col("nth"))
    border = ((F.col("nth") == 0) & (F.col("range") > 0)) | ~F.col("ended")
    whole = numbered.filter(~border).select("file", "number", "text", "tail")
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("range", "text"))), lambda t: t["text"]), "")
    joined = numbered.filter(border).groupBy("file", "number").agg(text.alias("text"), F.bool_or("tail").alias("tail"))
    return whole.unionByName(joined)


def _judged(records: DataFrame, schema: T.StructType, corrupt: str) -> DataFrame:
    first = F.col("number") == 0
    between = F.when(first, F.col("text").rlike(_FIRST)).otherwise(F.col("text").rlike(_NEXT))
    after = F.when(first, F.col("text").rlike(_EMPTY_END)).otherwise(F.col("text").rlike(_END))
    text = F.regexp_replace("text", r"^[\s,\[]+", "")
    record = F.from_json(text, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt})
    read = records.withColumn("record", F.when(~F.col("tail"), record))
    unread = F.col(f"record.{corrupt}").isNotNull() if corrupt in schema.names else F.lit(False)
    wrong = F.when(F.col("tail"), ~after).otherwise(~between | unread)
    return read.select("file", "tail", "record", F.coalesce(wrong, F.lit(True)).alias("wrong"))
