"""Sharding by vector bin packing: bytes, tokens and rows are balanced jointly."""

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.staging import staged

WORD = r"[^\x20\x09-\x0D]+"

#: Fixed value: bytes that every row takes besides its text.
ROW_BYTES = 8


def shard(
    docs: DataFrame,
    shards: int = 24,
    key: str = "doc_id",
    text: str = "text",
    cells_per_shard: int = 256,
    cell_rows: int = 50_000,
    group_share: int = 16,
    weights: Sequence[float] = (0.9, 0.05, 0.05),
) -> DataFrame:
    """``docs`` with ``size``, ``text_crc32``, ``shard`` and ``slot``; shards near equal in bytes.

    Equal texts are a group, the null texts another. Groups are dealt by a hash of the text
    to cells, about ``cells_per_shard`` for each shard, and more where a cell would hold
    over ``cell_rows`` rows; a group larger than a cell is split over several. Cells are
    placed from the largest down, each in the shard where the dot product of its bytes,
    tokens and rows with the shard's residual capacity is highest; ``weights`` are those of
    the three, as shares of the total. Only sums of cells come to the driver, whose number
    does not grow but with rows / ``cell_rows``.

    ``size`` is the text's UTF-8 bytes and 8 more; a null text has none, and the checksum
    of an empty one. Slots count from 0 without gaps: a cell has a range of its shard's
    slots, and its rows stand in the order of checksum, size and key. Equal rows are
    interchangeable. Columns of ``docs`` with one of the names are replaced.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.drop("size", "text_crc32", "shard", "slot").withColumns(
        {
            "size": F.octet_length(whole).cast("long") + ROW_BYTES,
            "text_crc32": F.crc32(whole),
            "__group": F.xxhash64(F.col(text), F.col(text).isNull()),
        }
    )
    tokens = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    groups = staged(
        rows.groupBy("__group")
        .agg(F.sum("size").alias("bytes"), F.sum(tokens).alias("tokens"), F.count(F.lit(1)).alias("rows")),
        "groups",
    )
    total = groups.agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows")).first()
    cells = shards * cells_per_shard + (total["rows"] or 0) // cell_rows
    fair = max(1, (total["bytes"] or 0) // (shards * group_share))
    # The total bounds how many groups can be over either limit, so the list is bounded.
    large = groups.filter(((F.col("bytes") > fair) | (F.col("rows") > cell_rows)) & (F.col("rows") > 1)).select(
        F.col("__group").alias("__large"),
        F.least(
            F.greatest(F.ceil(F.col("bytes") / fair), F.ceil(F.col("rows") / cell_rows)), F.col("rows")
        ).cast("long").alias("__parts"),
    )
    dealt = rows.join(F.broadcast(large), F.col("__group") == F.col("__large"), "left")
    part = F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit(1)), F.coalesce("__parts", F.lit(1)))
    dealt = dealt.withColumn("__cell", F.pmod(F.xxhash64("__group", part), F.lit(cells)))

    sums = dealt.groupBy("__cell").agg(F.sum("size").alias("bytes"), F.sum(tokens).alias("tokens"), F.count(F.lit(1)).alias("rows"))
    loads = sums.toPandas().sort_values(["bytes", "tokens", "rows", "__cell"], ascending=False)
    loads["__shard"] = pack(loads[["bytes", "tokens", "rows"]].to_numpy(float), shards, weights)
    loads["__front"] = loads.groupby("__shard")["rows"].cumsum() - loads["rows"]
    plan = docs.sparkSession.createDataFrame(
        loads[["__cell", "__shard", "__front"]].astype("int64"), "__cell long, __shard long, __front long"
    )
    within = Window.partitionBy("__cell").orderBy("text_crc32", "size", F.col(key).asc_nulls_last(), "__group")
    return (
        dealt.join(F.broadcast(plan), "__cell")
        .withColumn("slot", F.col("__front") + F.row_number().over(within) - 1)
        .withColumn("shard", F.col("__shard").cast("int"))
        .drop("__cell", "__shard", "__front", "__group", "__large", "__parts")
    )


def pack(loads: np.ndarray, bins: int, weights: Sequence[float]) -> np.ndarray:
    """The bin of each load vector, in the order given.

    Each goes where its dot product with the residual capacity is highest; capacity is an
    equal share of the total in every dimension, and ties go to the first bin.
    """
    whole = loads.sum(0)
    shares = loads / np.where(whole > 0, whole, 1) * np.asarray(weights)
    residual = np.tile(shares.sum(0) / bins, (bins, 1)) / np.asarray(weights)
    out = np.zeros(len(loads), np.int64)
    for i, item in enumerate(shares):
        out[i] = np.argmax(residual @ item)
        residual[out[i]] -= item / np.asarray(weights)
    return out


def shard_report(sharded: DataFrame, key: str = "doc_id") -> DataFrame:
    return sharded.select(
        F.col(key).alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
