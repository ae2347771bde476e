"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

Only DataFrame operations. Rows of documents are narrowed to id, source and size and
written once; windows run over sources, over the shards of a source, and over the
documents of a shard, never over all documents.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.staging import staged

WORD = r"[^\x20\x09-\x0D]+"


def sizes(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """``(doc_id, source, size)``; size is the number of words, 0 for a null text."""
    words = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select(F.col(key).alias("doc_id"), F.col(source).cast("string").alias("source"), words.alias("size"))


def targets(sized: DataFrame, weights: Sequence[int] = (1, 2, 3), repeats: int = 3) -> DataFrame:
    """``(source, source_size, rows, weight, target)``, one row per source.

    Sources by code point, null last, weigh ``weights``, repeating. The sum of all sizes
    is shared by weight; no target exceeds ``repeats`` times its source's size, and what is
    above is shared again by weight until none is. That is one level for all sources that
    are not full: sources fill up in the order of limit per weight, so the level follows
    from running sums over the sources.
    """
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(ordered) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), place + 1)
    sources = (
        sized.groupBy("source")
        .agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
        .withColumn("weight", weight)
        .withColumn("most", F.col("source_size") * repeats)
    )
    fill = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    level = (
        F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0))
    ) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    # The first source that its share at the level does not fill sets the level for the rest.
    opens = F.when(F.col("level") * F.col("weight") <= F.col("most"), F.col("nth"))
    return (
        sources.withColumn("level", level)
        .withColumn("nth", F.row_number().over(fill))
        .withColumn("level", F.min_by("level", opens).over(everything))
        .withColumn("target", F.least(F.col("level") * F.col("weight"), F.col("most").cast("double")))
        .select("source", "source_size", "rows", "weight", F.coalesce("target", F.lit(0.0)).alias("target"))
    )


def apportion(parts: DataFrame, group: Sequence[str], share: str, seats: str, order: Sequence[str]) -> DataFrame:
    """``parts`` with ``quota``: the ``seats`` of each group, dealt by Sainte-Lague.

    A seat goes to the part with the highest quotient ``share / (2 * quota + 1)``, ties in
    ``order``. Rounding each part's exact share leaves at most half a seat per part to deal
    or to take back, of which one part sees at most its share of them and one more; so
    only few quotients per part are ranked, not one per seat.
    """
    all_of = Window.partitionBy(*group)
    whole = F.sum(share).over(all_of)
    exact = F.when(whole > 0, F.col(share) / whole * F.col(seats)).otherwise(F.lit(0.0))
    rounded = (
        parts.withColumn("__base", F.floor(exact + 0.5))
        .withColumn("__left", F.col(seats) - F.sum("__base").over(all_of))
        .withColumn("__parts", F.count(F.lit(1)).over(all_of))
        .withColumn("__place", F.row_number().over(all_of.orderBy(*[F.col(c).asc_nulls_last() for c in order])))
        .withColumn(
            "__tries",
            F.when(
                (F.col("__left") != 0) & (whole > 0),
                F.floor(F.col(share) / whole * (F.abs("__left") + F.col("__parts"))) + 2,
            ).otherwise(F.lit(0)),
        )
    )
    seat = F.explode_outer(F.when(F.col("__tries") > 0, F.sequence(F.lit(0).cast("long"), F.col("__tries") - 1)))
    tried = rounded.withColumn("__try", seat).withColumn("__give", F.col("__left") > 0)
    holds = F.when(F.col("__give"), F.col("__base") + F.col("__try")).otherwise(F.col("__base") - F.col("__try") - 1)
    quotient = F.when(holds >= 0, F.col(share) / (holds * 2 + 1))
    tried = tried.withColumn("__rank_by", F.when(F.col("__give"), -quotient).otherwise(quotient))
    # Of equal quotients the first part's seat counts as dealt earlier, so it is taken back later.
    turn = F.when(F.col("__give"), F.col("__place")).otherwise(-F.col("__place"))
    ranked = Window.partitionBy(*group).orderBy(F.col("__rank_by").asc_nulls_last(), turn, "__try")
    moves = F.col("__rank_by").isNotNull() & (F.row_number().over(ranked) <= F.abs("__left"))
    won = tried.withColumn("__move", F.when(moves, F.when(F.col("__give"), 1).otherwise(-1)).otherwise(0))
    return (
        won.groupBy(*parts.columns)
        .agg((F.max("__base") + F.sum("__move")).cast("long").alias("quota"))
    )


def mix(
    docs: DataFrame,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
    weights: Sequence[int] = (1, 2, 3),
    repeats: int = 3,
    block_words: int = 16,
    shard_rows: int = 1024,
    seed: int = 7,
) -> DataFrame:
    """``(doc_id, source, size, source_size, target, taken)``: words the mix takes of each document.

    The targets are cut into blocks of ``block_words`` and dealt to the sources by
    Sainte-Lague; a source's blocks are dealt in the same way to its shards, which hold
    about ``shard_rows`` documents by a seeded digest of the id. Within a shard documents
    stand in seeded order, and the shard's blocks are taken from the front, starting over
    when they exceed its words, up to ``repeats`` times. So a document is taken whole,
    several times, or not, but for one per shard where the blocks end.

    Null sources are one source. Documents without words are not taken. Rows that repeat
    an id are taken on their own. The result depends on ids, sources and sizes alone.

    The shards of one source, a row per ``shard_rows`` documents, stand in one window.
    """
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("doc_id").cast("string")))
    sized = staged(sizes(docs, key, source, text), "sized")
    wanted = targets(sized, weights, repeats).withColumn("shards", F.ceil(F.col("rows") / shard_rows).cast("long"))
    wanted = wanted.withColumn("seats", F.round(F.sum("target").over(Window.partitionBy()) / block_words).cast("long"))
    quotas = staged(apportion(wanted, (), "target", "seats", ("source",)), "quotas")

    number = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    same = sized["source"].eqNullSafe(quotas["source"])
    dealt = (
        sized.join(quotas, same)
        .select("doc_id", sized["source"], "size", "source_size", "target", "quota",
                F.pmod(number, F.col("shards")).alias("shard"), digest.alias("digest"))
    )
    shards = (
        dealt.groupBy("source", "quota", "shard")
        .agg(F.sum("size").alias("shard_size"))
        .withColumnRenamed("quota", "seats")
    )
    shards = apportion(shards, ("source",), "shard_size", "seats", ("shard",))
    shards = staged(
        shards.select(
            F.col("source").alias("of"), F.col("shard").alias("in"), "shard_size",
            F.least(F.col("quota") * block_words, F.col("shard_size") * repeats).alias("words"),
        ),
        "shards",
    )
    inside = Window.partitionBy("source", "shard").orderBy("digest", "doc_id", "size")
    placed = dealt.withColumn("front", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    rounds = F.expr("words div shard_size")
    rest = F.col("words") - rounds * F.col("shard_size") - F.col("front")
    taken = F.when(
        F.col("shard_size") > 0,
        F.col("size") * rounds + F.greatest(F.lit(0), F.least(rest, F.col("size"))),
    ).otherwise(F.lit(0))
    both = F.col("source").eqNullSafe(F.col("of")) & (F.col("shard") == F.col("in"))
    return placed.join(shards, both).select(
        "doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken")
    )
