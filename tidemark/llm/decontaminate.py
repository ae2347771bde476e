"""Benchmark decontamination: a broadcast hash set of normalised test n-grams."""

from collections.abc import Iterator
from functools import reduce
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.portions import portions
from tidemark.llm.text import ALNUM, Words, pieces, tidied, words
from tidemark.staging import staged

#: Most bytes of test windows that are broadcast at once; more are scanned in turns.
BROADCAST_BYTES = 64 << 20

#: Bytes that a window takes in the hash set besides its words.
_OVERHEAD = 400

_WINDOWS = "width int, hash long, item string, words string"
FOUND = "n_words long, hits array<struct<first:int,last:int>>, items array<string>"


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    width: int = 10,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``docs`` with ``n_words``, ``hits`` and ``items``.

    Words are runs of letters and digits, A-Z lower-cased. A window is ``width``
    consecutive words of an item, or all words of a shorter one. ``hits`` are the runs
    ``(first, last)`` of document words inside any occurrence of a window, and ``items``
    the sorted ids, as text, of the items with occurring windows. Null and empty texts
    have no words; an item without words or without an id hits nothing. Repeated documents are
    scanned each by itself, repeated items are one, and without documents there are no rows.
    Columns of
    ``docs`` with one of the three names are replaced.

    The windows are measured first, each with the items that have it. Up to
    ``broadcast_bytes`` of them are broadcast as one hash set, and one pass over the documents
    gives the result. Beyond that the documents are written once, numbered, and scanned in
    turns, each with windows of at most so many bytes without their items; a turn gives only
    numbers, hit words and windows of documents with hits. These are put together, and items
    joined to windows, by shuffles, so that it does not matter how many items share a window.
    Every hit is verified word by word.
    """
    rows = docs.drop("n_words", "hits", "items")
    schema = T.StructType([*rows.schema.fields, *T.StructType.fromDDL(FOUND).fields])
    windows = staged(_windows(benchmark, width, item, item_text), "windows")
    size = F.octet_length("words") + _OVERHEAD
    with_items = windows.agg(F.sum(size + F.octet_length("item"))).first()[0] or 0
    if with_items <= broadcast_bytes:
        known = docs.sparkSession.sparkContext.broadcast(_hash_set(windows.toPandas()))
        return rows.mapInArrow(_scan(known, rows.columns.index(text)), schema)
    return _in_turns(rows, windows, size, broadcast_bytes, text).select(*schema.names)


def _in_turns(rows: DataFrame, windows: DataFrame, size: Column, limit: int, text: str) -> DataFrame:
    numbered = staged(rows.withColumn("__row", F.monotonically_increasing_id()), "numbered")
    one = windows.select("width", "hash", "words").distinct().withColumn("item", F.sha2(F.concat_ws(" ", "width", "words"), 256))
    one = staged(one, "distinct")
    given = numbered.select("__row", text)
    schema = T.StructType.fromDDL(f"__row long, {text} string, {FOUND}")
    counts, parts = None, []
    for mine in portions(one, "hash", size + F.octet_length("item"), limit):
        known = rows.sparkSession.sparkContext.broadcast(_hash_set(one.filter(mine).toPandas()))
        found = given.mapInArrow(_scan(known, 1), schema).drop(text)
        if counts is None:  # the first turn counts the words of all documents
            found = staged(found, "first")
            counts = found.select("__row", "n_words")
        parts.append(staged(found.filter("size(hits) > 0").select("__row", "hits", "items"), "hits"))
    hits = reduce(DataFrame.unionByName, parts)
    named = windows.select("item", F.sha2(F.concat_ws(" ", "width", "words"), 256).alias("window")).distinct()
    items = (
        hits.select("__row", F.explode("items").alias("window")).join(named, "window")
        .groupBy("__row").agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    merged = hits.groupBy("__row").agg(F.array_sort(F.flatten(F.collect_list("hits"))).alias("hits")).mapInPandas(
        _merged, "__row long, hits array<struct<first:int,last:int>>"
    )
    none = {c: F.array().cast(kind) for c, kind in (("hits", "array<struct<first:int,last:int>>"), ("items", "array<string>"))}
    out = numbered.join(counts, "__row").join(merged, "__row", "left").join(items, "__row", "left")
    return out.withColumns({c: F.coalesce(F.col(c), v) for c, v in none.items()})


def _merged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted runs of different turns, those that touch or overlap made one."""
    for batch in batches:
        out = []
        for runs in batch["hits"]:
            first, last = (np.array([r[k] for r in runs], np.int64) for k in ("first", "last"))
            reach = np.maximum.accumulate(last)
            cut = np.concatenate([[0], np.flatnonzero(first[1:] > reach[:-1] + 1) + 1])
            ends = np.append(cut[1:], len(first)) - 1
            out.append([{"first": int(a), "last": int(b)} for a, b in zip(first[cut], reach[ends])])
        yield pd.DataFrame({"__row": batch["__row"], "hits": out})


def contamination_report(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per document: words, hit words, items and whether anything was hit."""
    hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, h: n + h["last"] - h["first"] + 1)
    return found.select(
        F.col(key).alias("doc_id"),
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


def drop_contaminated(found: DataFrame) -> DataFrame:
    """The documents without a hit, as they came."""
    return found.filter(F.size("hits") == 0).drop("n_words", "hits", "items")


def cut_hits(found: DataFrame, text: str = "text") -> DataFrame:
    """The documents with their hit words, and what stands between these, cut out."""
    schema = T.StructType([f for f in found.schema.fields if f.name not in ("n_words", "hits", "items")])
    names, keep = found.columns, schema.names
    at, hits = names.index(text), names.index("hits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            for i, runs in enumerate(batch.column(hits).to_pylist()):
                if runs:
                    texts[i] = _cut(texts[i].encode(), runs)
            columns = [pa.array(texts, batch.column(at).type) if c == text else batch.column(names.index(c)) for c in keep]
            yield pa.RecordBatch.from_arrays(columns, keep)

    return found.mapInArrow(run, schema)


def _cut(data: bytes, runs: list[dict]) -> str:
    mine = words(np.frombuffer(data, np.uint8), np.array([0, len(data)]), ALNUM)
    out, last = [], 0
    for r in runs:
        out.append(data[last : mine.start[r["first"]]])
        last = mine.end[r["last"]]
    return b"".join([*out, data[last:]]).decode()


def _windows(benchmark: DataFrame, width: int, item: str, text: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in pieces(batch.column(1)):
                found = words(data, offsets, ALNUM)
                names = batch.column(0).slice(first, found.rows).to_pylist()
                out = []
                for size, at, value in _item_windows(found, width):
                    for i, h in zip(at, value.view(np.int64)):
                        out.append((size, int(h), names[found.row[i]], _phrase(found, i, size).decode()))
                columns = list(zip(*out)) or [[], [], [], []]
                kinds = (pa.int32(), pa.int64(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["width", "hash", "item", "words"])

    items = benchmark.select(F.col(item).cast("string"), F.col(text)).filter(F.col(item).isNotNull())
    return items.mapInArrow(run, _WINDOWS).distinct()


def _item_windows(found: Words, width: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    yield width, *found.windows(width)
    count, first = found.per_row(), found.first()
    for size in range(1, width):
        at, value = found.windows(size)
        whole = np.isin(at, first[:-1][count == size])
        if whole.any():
            yield size, at[whole], value[whole]


def _phrase(found: Words, i: int, size: int) -> bytes:
    return b" ".join(found.word(k) for k in range(i, i + size))


def _hash_set(windows: pd.DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray, dict[int, dict[bytes, list[str]]]]]:
    """By width: sorted hashes, a bitmap of their leading bits, and what they stand for."""
    sets: dict[int, Any] = {}
    for size, rows in windows.groupby("width"):
        names: dict[int, dict[bytes, list[str]]] = {}
        for h, item, phrase in zip(rows["hash"], rows["item"], rows["words"]):
            names.setdefault(h, {}).setdefault(phrase.encode(), []).append(item)
        known = np.sort(np.array(list(names), np.int64).view(np.uint64))
        bits = min(26, max(12, (64 * len(known)).bit_length()))
        bitmap = np.zeros(1 << bits, bool)
        bitmap[known >> np.uint64(64 - bits)] = True
        sets[int(size)] = known, bitmap, names
    return sets


def _scan(known: Any, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = known.value
        for batch in batches:
            # A piece at a time also on the way back.
            for first, data, offsets in pieces(batch.column(at)):
                found = words(data, offsets, ALNUM)
                items: list[set[str]] = [set() for _ in range(found.rows)]
                cover = np.zeros(len(found.row) + 1, np.int64)
                for size, (hashes, bitmap, names) in sets.items():
                    where, value = found.windows(size)
                    maybe = np.flatnonzero(bitmap[value >> np.uint64(64 - len(bitmap).bit_length() + 1)])
                    place = np.searchsorted(hashes, value[maybe])
                    same = hashes[np.minimum(place, len(hashes) - 1)] == value[maybe]
                    for k in maybe[same]:
                        i = where[k]
                        meant = names[int(value[k].view(np.int64))].get(_phrase(found, i, size))
                        if meant:
                            items[found.row[i]].update(meant)
                            cover[i] += 1
                            cover[i + size] -= 1
                done = [
                    pa.array(found.per_row(), pa.int64()),
                    pa.array(_runs(np.cumsum(cover)[:-1] > 0, found, found.first()), _HITS),
                    pa.array([sorted(x) for x in items], pa.list_(pa.string())),
                ]
                mine = batch.slice(first, found.rows)
                yield pa.RecordBatch.from_arrays([*mine.columns, *done], [*batch.schema.names, "n_words", "hits", "items"])

    return tidied(run)


_HITS = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))


def _runs(hit: np.ndarray, found: Words, begin: np.ndarray) -> list[list[dict]]:
    """Runs of hit words, by row, counted from the row's first word."""
    out: list[list[dict]] = [[] for _ in range(found.rows)]
    at = np.flatnonzero(hit)
    if len(at):
        cut = np.flatnonzero((np.diff(at) > 1) | (np.diff(found.row[at]) > 0)) + 1
        for run in np.split(at, cut):
            row = found.row[run[0]]
            out[row].append({"first": int(run[0] - begin[row]), "last": int(run[-1] - begin[row])})
    return out
