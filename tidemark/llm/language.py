"""Language identification with hyperdimensional profiles of letter trigrams."""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.text import pieces, tidied

#: Classes of letters; 0 stands for what is not a letter.
LETTERS = 64
UNKNOWN = "und"
#: Different trigrams that are bundled at once.
GRAM_BLOCK = 8192

@dataclass(frozen=True)
class Profiles:
    """Unit prototype vectors of the learned languages."""

    names: tuple[str, ...]
    vectors: np.ndarray
    seed: int

    @property
    def width(self) -> int:
        return self.vectors.shape[1]


def learn_profiles(
    docs: DataFrame, text: str = "text", lang: str = "lang", width: int = 512, seed: int = 7
) -> Profiles:
    """Bundle every text of ``docs`` with a language into that language's prototype.

    Bundling is a sum, so trigrams are counted per language on the executors and only the
    counts, at most ``LETTERS`` ** 3 per language, come to the driver. Null texts and null
    languages teach nothing.
    """
    rows = docs.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    counts = (
        rows.filter("text is not null and lang is not null")
        .mapInArrow(tidied(_count), "lang string, gram int, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    names = tuple(sorted(counts["lang"].unique()))
    vectors = np.zeros((len(names), width))
    for k, name in enumerate(names):
        mine = counts[counts["lang"] == name].sort_values("gram")
        vectors[k] = mine["n"].to_numpy(float) @ _bound(mine["gram"].to_numpy(), width, seed)
    norm = np.linalg.norm(vectors, axis=1, keepdims=True)
    return Profiles(names, vectors / np.where(norm > 0, norm, 1), seed)


def identify(docs: DataFrame, profiles: Profiles, text: str = "text", flag: str | None = None) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the cosine with that language (0 to 1).

    A text that is null or has no letter is ``und`` with score 0, as is every text when no
    language was learned. Ties go to the first language by name. A column named ``flag``,
    if any, says whether the text has a letter; ``und`` does not say that, as it may also be
    a language of ``profiles``. Repeated rows are judged alike, and a table without rows gives
    none. Columns of ``docs`` with one of these names are replaced; no column but ``text``
    takes part.
    """
    rows = docs.drop("lang_pred", "score", *[flag] * (flag is not None))
    added = T.StructType.fromDDL("lang_pred string, score double").fields
    if flag is not None:
        added.append(T.StructField(flag, T.BooleanType()))
    schema = T.StructType([*rows.schema.fields, *added])
    at = rows.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _unknown_classes()
        for batch in batches:
            # A piece at a time also on the way back.
            for first, data, offsets in pieces(batch.column(at)):
                size = len(offsets) - 1
                row, gram = _grams(data, offsets, table)
                found, score = _compare(profiles, row, gram, size)
                columns = [pa.array(found, pa.string()), pa.array(score, pa.float64())]
                if flag is not None:
                    columns.append(pa.array(np.bincount(row, minlength=size) > 0, pa.bool_()))
                yield pa.RecordBatch.from_arrays([*batch.slice(first, size).columns, *columns], schema.names)

    return rows.mapInArrow(tidied(run), schema)


def _unknown_classes() -> np.ndarray:
    return np.full(0x110000, -1, np.int8)


def _classes(points: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Class of each code point: a-z keep their own, other letters share the rest.

    ``table`` holds the classes met so far.
    """
    for p in np.unique(points[table[points] < 0]).tolist():
        low = chr(p).lower()[0]
        if not chr(p).isalpha():
            table[p] = 0
        elif "a" <= low <= "z":
            table[p] = ord(low) - ord("a") + 1
        else:
            table[p] = 27 + (ord(low) * 2654435761 >> 8) % (LETTERS - 27)
    return table[points]


def _grams(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and trigram of every letter, with its neighbours in the same text."""
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    before = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(before))
    letters = np.zeros(len(points) + len(offsets) + 1, np.int32)
    place = np.arange(len(points)) + row + 1
    letters[place] = _classes(points, table)
    at = place[letters[place] > 0]
    gram = (letters[at - 1] * LETTERS + letters[at]) * LETTERS + letters[at + 1]
    return row[letters[place] > 0], gram


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = _unknown_classes()
    for batch in batches:
        for first, data, offsets in pieces(batch.column(0)):
            names = np.array(batch.column(1).slice(first, len(offsets) - 1).to_pylist(), object)
            known, which = np.unique(names, return_inverse=True)
            row, gram = _grams(data, offsets, table)
            key, n = np.unique(which[row] * LETTERS**3 + gram, return_counts=True)
            columns = [pa.array(known[key // LETTERS**3], pa.string()), pa.array(key % LETTERS**3, pa.int32()), pa.array(n, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "gram", "n"])


def _bound(grams: np.ndarray, width: int, seed: int) -> np.ndarray:
    """Vectors of trigrams: letter vectors of +-1, permuted by place and multiplied."""
    signs = np.random.default_rng(seed).integers(0, 2, (LETTERS, width), np.int8) * 2 - 1
    signs = signs.astype(np.float32)
    a, b, c = grams // LETTERS**2, grams // LETTERS % LETTERS, grams % LETTERS
    return np.roll(signs, 2, 1)[a] * np.roll(signs, 1, 1)[b] * signs[c]


def _bundle(row: np.ndarray, gram: np.ndarray, rows: int, profiles: Profiles) -> np.ndarray:
    """Sums of the trigrams' vectors by row, a block of different trigrams at a time."""
    known, which = np.unique(gram, return_inverse=True)
    order = np.argsort(which, kind="stable")
    row, which = row[order], which[order]
    cuts = np.searchsorted(which, np.arange(0, len(known) + GRAM_BLOCK, GRAM_BLOCK))
    total = np.zeros((rows, profiles.width), np.float32)
    for low, high, base in zip(cuts[:-1], cuts[1:], range(0, len(known), GRAM_BLOCK)):
        mine = known[base : base + GRAM_BLOCK]
        count = np.bincount(row[low:high] * len(mine) + which[low:high] - base, minlength=rows * len(mine))
        total += count.reshape(rows, -1).astype(np.float32) @ _bound(mine, profiles.width, profiles.seed)
    return total


def _compare(
    profiles: Profiles, row: np.ndarray, gram: np.ndarray, rows: int, chunk: int = 256
) -> tuple[list[str], np.ndarray]:
    score = np.zeros(rows)
    best = np.full(rows, -1)
    if profiles.names and len(gram):
        cuts = np.searchsorted(row, np.arange(0, rows + chunk, chunk))
        for low, high, base in zip(cuts[:-1], cuts[1:], range(0, rows, chunk)):
            if low == high:
                continue
            bundle = _bundle(row[low:high] - base, gram[low:high], chunk, profiles)
            norm = np.linalg.norm(bundle, axis=1)
            has = np.unique(row[low:high] - base)
            cosine = (bundle[has] @ profiles.vectors.T) / np.maximum(norm[has], 1e-9)[:, None]
            best[base + has] = cosine.argmax(1)
            score[base + has] = np.clip(cosine.max(1), 0, 1)
    return [profiles.names[k] if k >= 0 else UNKNOWN for k in best], score
