"""Ranked lexical search: dense products of item vocabulary tiles and document impact tiles."""

from collections.abc import Iterator
from dataclasses import dataclass
from math import floor, log
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.portions import portions
from tidemark.llm.text import ALNUM, Words, pieces, words
from tidemark.staging import scratch, staged

#: Most bytes of item terms that are broadcast at once; more are scanned in turns.
BROADCAST_BYTES = 16 << 20
#: Items, documents and vocabulary columns of a tile.
TILE_ITEMS = 64
TILE_DOCS = 512
TILE_COLUMNS = 2048
#: Candidates a task holds before it keeps the best of each item.
PENDING = 100_000

_EXACT = 1 << 53
_IMPACT = 1_000_000  # no impact is greater


def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``(item, rank, key, score)``: the ``k`` documents of highest score for each item.

    Terms are runs of letters and digits, A-Z lower-cased, of whole texts; null texts have
    none. A document's score is the sum, over the item's terms that it holds, of the term's
    weight times its impact in the document; scores are whole numbers and exact. Only scores
    above 0 are ranked; equal ones by ascending ``key``, null last. Items of one id are one
    item with the terms of all their texts, also those without an id; an item without terms
    has no rows, nor has any when there are no documents. Repeated documents are ranked each
    by itself. Other columns of either table are not looked at.

    The items' terms are measured and broadcast, in turns when they are too many. A turn
    counts the terms of its items in every document and writes these counts, from which
    document frequencies follow; then the counts become tiles of impacts, which are
    multiplied with tiles of weights. Every task keeps the ``k`` best of each item, ties
    decided by ``key``, so what is shuffled is ``k`` rows an item and task.
    """
    spark = docs.sparkSession
    kind, item_kind = docs.schema[key], items.schema[item]
    rows = docs.select(key, text)
    schema = T.StructType([T.StructField("item", item_kind.dataType), T.StructField("key", kind.dataType), T.StructField("score", T.LongType())])
    best = spark.createDataFrame([], schema)
    with scratch(spark, "ranking") as folder:
        named = T.StructType([T.StructField("item", item_kind.dataType), T.StructField("term", T.StringType())])
        pairs = staged(items.select(item, item_text).mapInArrow(_item_terms, named).distinct(), "terms", folder=folder)
        size = F.octet_length("term") + 32
        for turn, mine in enumerate(portions(pairs, "item", size, broadcast_bytes)):
            wanted = pairs.filter(mine).toArrow()
            terms, column = np.unique(wanted["term"].to_numpy(), return_inverse=True)
            known = spark.sparkContext.broadcast(terms.tolist())
            counted = staged(rows.mapInArrow(_count_terms(known), _counted(kind)), f"counts-{turn}", folder=folder)
            total = counted.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("words")).first()
            if not total.docs:
                break
            found = counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
            weights = np.zeros(len(terms), np.int64)
            for r in found:
                weights[r["term"]] = floor(1000 * log((2 * total.docs + 2) / (2 * r["count"] + 1)))
            tiles = spark.sparkContext.broadcast(_tiles(wanted["item"], column, weights))
            scored = counted.mapInArrow(_score(tiles, total.docs, total.words, k, schema.names), schema)
            best = best.unionByName(_first(scored, k).drop("rank"))
        out = _first(best, k).select(F.col("item").alias(item), "rank", F.col("key").alias(key), "score")
        return staged(out, "ranked", keep=True)


def _first(scored: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("key"))
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _strings(found: Words) -> pa.Array:
    """The words themselves."""
    length = found.end - found.start
    ends = np.concatenate([[0], np.cumsum(length)])
    at = np.arange(ends[-1]) + np.repeat(found.start - ends[:-1], length)
    return pa.LargeStringArray.from_buffers(len(length), pa.py_buffer(ends), pa.py_buffer(found.data[at].tobytes()))


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, data, offsets in pieces(batch.column(1)):
            found = words(data, offsets, ALNUM)
            names = batch.column(0).take(pa.array(first + found.row))
            yield pa.RecordBatch.from_arrays([names, _strings(found).cast(pa.string())], ["item", "term"])


def _counted(key: T.StructField) -> T.StructType:
    return T.StructType([T.StructField("key", key.dataType), *T.StructType.fromDDL("n long, terms array<int>, counts array<long>").fields])


def _count_terms(known: Any):
    """Documents with terms: how many, and which of the known ones how often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = pa.array(known.value, pa.large_string())
        for batch in batches:
            for first, data, offsets in pieces(batch.column(1)):
                found = words(data, offsets, ALNUM)
                number = pc.fill_null(pc.index_in(_strings(found), terms), -1).to_numpy().astype(np.int64)
                mine = number >= 0
                both, count = np.unique(found.row[mine] * len(terms) + number[mine], return_counts=True)
                n = found.per_row()
                filled = np.flatnonzero(n)
                row = both // max(1, len(terms))
                ends = pa.array(np.concatenate([np.searchsorted(row, filled), [len(row)]]).astype(np.int32))
                columns = [
                    batch.column(0).take(pa.array(first + filled)),
                    pa.array(n[filled], pa.int64()),
                    pa.ListArray.from_arrays(ends, pa.array((both % max(1, len(terms))).astype(np.int32))),
                    pa.ListArray.from_arrays(ends, pa.array(count.astype(np.int64))),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["key", "n", "terms", "counts"])

    return run


@dataclass
class Tile:
    """Some items and the vocabulary that they use, sorted; weights by item and column."""

    items: pa.Array
    vocabulary: np.ndarray
    item: np.ndarray
    column: np.ndarray
    weight: np.ndarray

    def blocks(self) -> Iterator[tuple[int, int, np.ndarray]]:
        """Dense weights of column blocks, so narrow that no sum of products reaches 2^53."""
        most = max(1, int(self.weight.max(initial=0))) * _IMPACT
        width = min(TILE_COLUMNS, (_EXACT - 1) // most)
        for first in range(0, len(self.vocabulary), width):
            mine = (self.column >= first) & (self.column < first + width)
            last = min(first + width, len(self.vocabulary))
            dense = np.zeros((last - first, len(self.items)))
            dense[self.column[mine] - first, self.item[mine]] = self.weight[mine]
            yield first, last, dense


def _tiles(items: pa.ChunkedArray, term: np.ndarray, weights: np.ndarray) -> list[Tile]:
    """``items`` and ``term`` are pairs; terms that no document holds are left out."""
    coded = items.combine_chunks().dictionary_encode(null_encoding="encode")
    owner = coded.indices.to_numpy()
    out = []
    for first in range(0, len(coded.dictionary), TILE_ITEMS):
        mine = (owner >= first) & (owner < first + TILE_ITEMS) & (weights[term] > 0)
        vocabulary, column = np.unique(term[mine], return_inverse=True)
        names = coded.dictionary.slice(first, TILE_ITEMS)
        out.append(Tile(names, vocabulary, owner[mine] - first, column, weights[term[mine]]))
    return out


def impacts(tf: np.ndarray, n: np.ndarray, docs: int, total: int) -> np.ndarray:
    """How much a term counts that occurs ``tf`` times in a document of ``n`` terms."""
    kind = np.int64 if 90 * int(n.max(initial=0)) * docs < 1 << 63 else object
    m = 100 - 90 + (90 * n.astype(kind) * docs) // total
    return ((1_000_000_000 * tf.astype(kind)) // (1000 * tf.astype(kind) + 8 * m)).astype(np.int64)


def _score(tiles: Any, docs: int, total: int, k: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = tiles.value
        held = [_Best(len(t.items), k) for t in known]
        for batch in batches:
            for first in range(0, batch.num_rows, TILE_DOCS):
                part = batch.slice(first, TILE_DOCS)
                sizes = pc.list_value_length(part.column(2)).to_numpy()
                row = np.repeat(np.arange(len(sizes)), sizes)
                term, tf = part.column(2).flatten().to_numpy(), part.column(3).flatten().to_numpy()
                impact = impacts(tf, part.column(1).to_numpy()[row], docs, total)
                for tile, best in zip(known, held):
                    best.take(_product(tile, row, term, impact, len(sizes)), part.column(0))
        for tile, best in zip(known, held):
            kept = best.result()
            if kept is not None and kept.num_rows:
                columns = [tile.items.take(kept["item"].combine_chunks()), kept["key"].combine_chunks(), kept["score"].combine_chunks()]
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def _product(tile: Tile, row: np.ndarray, term: np.ndarray, impact: np.ndarray, rows: int) -> np.ndarray:
    """Scores of a tile of documents for a tile of items."""
    scores = np.zeros((rows, len(tile.items)), np.int64)
    if not len(tile.vocabulary):
        return scores
    column = np.minimum(np.searchsorted(tile.vocabulary, term), len(tile.vocabulary) - 1)
    hit = tile.vocabulary[column] == term
    row, column, impact = row[hit], column[hit], impact[hit]
    for first, last, weights in tile.blocks():
        mine = (column >= first) & (column < last)
        dense = np.zeros((rows, last - first))
        dense[row[mine], column[mine] - first] = impact[mine]
        scores += (dense @ weights).astype(np.int64)
    return scores


class _Best:
    """The best documents of each item of a tile, as far as a task has come."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.least = np.ones(items, np.int64)
        self.pending: list[pa.Table] = []

    def take(self, scores: np.ndarray, keys: pa.Array) -> None:
        """Every document that reaches the least score that may count; ties are all kept."""
        cut = self.least
        if len(scores) > self.k:
            cut = np.maximum(cut, np.partition(scores, len(scores) - self.k, axis=0)[len(scores) - self.k])
        row, item = np.nonzero(scores >= cut)
        if len(row):
            found = {"item": pa.array(item), "score": pa.array(scores[row, item]), "key": keys.take(pa.array(row))}
            self.pending.append(pa.table(found))
            if sum(t.num_rows for t in self.pending) > PENDING:
                self.pending = [self.result()]

    def result(self) -> pa.Table | None:
        if not self.pending:
            return None
        order = [("item", "ascending"), ("score", "descending"), ("key", "ascending")]
        ranked = pa.concat_tables(self.pending).sort_by(order)
        item = ranked["item"].to_numpy()
        place = np.arange(len(item)) - np.searchsorted(item, item)
        kept = ranked.filter(pa.array(place < self.k))
        last = place == self.k - 1
        self.least[item[last]] = np.maximum(self.least[item[last]], ranked["score"].to_numpy()[last])
        return kept
