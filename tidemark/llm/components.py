"""Connected components of a graph that is too large for one machine."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.staging import staged


def components(edges: DataFrame) -> DataFrame:
    """``(id, component)`` for every node of ``edges(a, b)``; the component is its least id.

    Alternates large-star and small-star steps until the edges no longer change: every
    node then hangs directly on the least node of its component. Minima are combined
    before the shuffle, and the joins carry both sides to a fresh shuffle, so that
    adaptive execution may split the edges of a hub. Every round is written to the shared
    folder. Null ends and loops are ignored; an empty graph has no nodes.
    """
    now = _staged(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")))
    state = _state(now)
    while state[0]:
        now = _staged(_small_star(_large_star(now)))
        before, state = state, _state(now)
        if state == before:
            break
    hung = now.select(F.col("u").alias("id"), F.col("v").alias("component"))
    roots = now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return hung.unionByName(roots)


def _staged(edges: DataFrame) -> DataFrame:
    return staged(edges.filter("u > v").distinct(), "edges")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("u"), F.bit_xor(F.xxhash64("u", "v"))).first())


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("least"))


def _with_least(edges: DataFrame) -> DataFrame:
    # Keyed by an expression of the node: the minima are dealt out anew with the edges.
    least = _least(edges).select(F.col("u").cast("string").alias("node"), "least")
    return edges.withColumn("node", F.col("u").cast("string")).join(least, "node")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is hung on the least of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    hung = _with_least(both).filter("v > u")
    return hung.select(F.col("v").alias("u"), F.least("u", "least").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are hung on the least of them."""
    hung = _with_least(edges).select(F.col("v").alias("u"), F.col("least").alias("v"))
    return hung.unionByName(_least(edges).select("u", F.col("least").alias("v")))
