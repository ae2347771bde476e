"""URL filters: a cascade of Bloom filters that is exact over all keys of a corpus."""

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.text import _scramble
from tidemark.staging import staged

BLOCK, ALLOW = "block", "allow"

#: Rules as ``(host, path, verdict)``.
RULE_SCHEMA = "host string, path string, verdict string"

# The rules of the query.
RULES = (
    ("com", "/", ALLOW),
    ("example.com", "/en/", BLOCK),
    ("www.example.com", "/en/", ALLOW),
    ("net", "/es/", BLOCK),
    ("net", "/fr/", BLOCK),
)

_U = np.uint64


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?`` or ``#``, A-Z lower-cased; else empty."""
    raw = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(raw, upper, upper.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?`` or ``#``; empty without a host."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


@dataclass(frozen=True)
class Cascade:
    """Bloom filters by level: odd levels hold listed keys, even ones false positives."""

    levels: tuple[tuple[np.ndarray, int, int], ...]

    def listed(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Whether each key of the universe is listed: the level that it fails at tells."""
        depth = np.full(len(h1), len(self.levels))
        left = np.arange(len(h1))
        for level, (bits, size, hashes) in enumerate(self.levels):
            place = _places(h1[left], h2[left], level, size, hashes)
            held = (bits[place >> _U(6)] >> (place & _U(63)) & _U(1)).astype(bool).all(1)
            depth[left[~held]] = level
            left = left[held]
        return depth % 2 == 1


def _places(h1: np.ndarray, h2: np.ndarray, level: int, size: int, hashes: int) -> np.ndarray:
    """Bits of each key in the filter of a level, which has its own hash functions."""
    with np.errstate(over="ignore"):
        salt = _U(level * 2 + 1) * _U(0x9E3779B97F4A7C15)
        a, b = _scramble(h1 ^ salt), _scramble(h2 + salt) | _U(1)
        return (a[:, None] + b[:, None] * np.arange(hashes, dtype=_U)[None]) % _U(size)


def build_cascade(keys: DataFrame) -> Cascade:
    """The cascade of ``keys(h1, h2, listed)``, distinct keys of the universe and all listed ones.

    The first level has as many false positives as there are listed keys, about, so every
    later level is small as well: the size follows the listed keys, and the logarithm of
    the universe. Every level is built on the executors, by a union of bits, from the
    keys that pass all levels before; only filters come to the driver.
    """
    counts = keys.agg(F.count_if("listed"), F.count_if(~F.col("listed"))).first()
    listed, other = counts[0], counts[1]
    cascade = Cascade(())
    if not listed:
        return cascade
    rate = min(0.5, listed / max(1, other))
    held, outside, side = listed, other, True
    while held:
        size = max(64, math.ceil(held * math.log2(1 / rate) / math.log(2)))
        hashes = max(1, round(math.log2(1 / rate)))
        mine = keys.filter(F.col("listed") == side)
        rows = mine.mapInArrow(_bits(cascade, size, hashes), "word long, bits long")
        found = rows.groupBy("word").agg(F.bit_or("bits").alias("bits")).toPandas()
        bits = np.zeros(size // 64 + 1, _U)
        bits[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64).view(_U)
        cascade = Cascade((*cascade.levels, (bits, size, hashes)))
        side, rate = not side, 0.5
        rest = keys.filter(F.col("listed") == side).mapInArrow(_passing(cascade), "n long")
        held = rest.agg(F.sum("n")).first()[0] or 0
    return cascade


def _pass(cascade: Cascade, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    keep = np.ones(len(h1), bool)
    for level, (bits, size, hashes) in enumerate(cascade.levels):
        place = _places(h1, h2, level, size, hashes)
        keep &= (bits[place >> _U(6)] >> (place & _U(63)) & _U(1)).astype(bool).all(1)
    return keep


def _hashes(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return tuple(batch.column(k).to_numpy().view(_U) for k in (0, 1))


def _bits(cascade: Cascade, size: int, hashes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h1, h2 = _hashes(batch)
            keep = _pass(cascade, h1, h2)
            place = np.unique(_places(h1[keep], h2[keep], len(cascade.levels), size, hashes))
            word, bit = place >> _U(6), _U(1) << (place & _U(63))
            edge = np.flatnonzero(np.append(True, word[1:] != word[:-1])) if len(word) else []
            bits = np.bitwise_or.reduceat(bit, edge) if len(word) else bit
            yield pa.RecordBatch.from_arrays(
                [pa.array(word[edge].astype(np.int64) if len(word) else [], pa.int64()), pa.array(bits.view(np.int64), pa.int64())],
                ["word", "bits"],
            )

    return run


def _passing(cascade: Cascade):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([int(_pass(cascade, *_hashes(batch)).sum())], pa.int64())], ["n"])

    return run


def filter_urls(pages: DataFrame, rules: DataFrame, url: str = "url", otherwise: str = ALLOW) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``.

    A rule fits its host and all subdomains when the path begins with the rule's; the
    longest that fits wins, written as host and path. Without one ``rule`` is null and the
    verdict ``otherwise``. A url that is null or has no ``://`` has an empty host and path.
    A rule listed with both verdicts blocks; rules with a null or empty host fit nothing.

    The keys of a url are the ends of its host, of as many labels as rules have, each with
    the start of its path, as long as rules have. All distinct keys of all pages are the
    universe; one cascade is built for the blocked and one for the allowed keys, and every
    key of every page is looked up in both, without a join. Repeated pages are judged alike;
    without pages there are no rows, and without rules every page has the verdict
    ``otherwise``. Columns of ``pages`` with one of the four names are replaced.
    """
    rows = pages.drop("host", "path", "rule", "verdict").withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    listed = staged(
        rules.filter("host is not null and path is not null and host <> ''")
        .groupBy(F.concat("host", "path").alias("key"), F.size(F.split("host", r"\.")).alias("labels"), F.char_length("path").alias("length"))
        .agg(F.bool_or(F.col("verdict") == BLOCK).alias("blocked")),
        "rules",
    )
    shapes = [tuple(r) for r in listed.select("labels", "length").distinct().orderBy("labels", "length").collect()]
    keys = _keys(shapes)
    h1, h2 = F.xxhash64("key"), F.xxhash64("key", F.lit(1))
    universe = rows.select(F.explode(keys).alias("k")).select("k.key", F.lit(False).alias("block"), F.lit(False).alias("allow"))
    marked = listed.select("key", F.col("blocked").alias("block"), (~F.col("blocked")).alias("allow"))
    known = staged(
        universe.distinct().unionByName(marked).groupBy("key").agg(F.bool_or("block").alias("block"), F.bool_or("allow").alias("allow"))
        .select(h1.alias("h1"), h2.alias("h2"), "block", "allow"),
        "url-keys",
    )
    cascades = {v: build_cascade(known.select("h1", "h2", F.col(v).alias("listed"))) for v in (BLOCK, ALLOW)}
    hashed = rows.withColumn("__keys", F.transform(keys, lambda k: k["key"])).withColumns(
        {"__h1": F.transform("__keys", lambda k: F.xxhash64(k)), "__h2": F.transform("__keys", lambda k: F.xxhash64(k, F.lit(1)))}
    )
    schema = T.StructType([*rows.schema.fields, *T.StructType.fromDDL("rule string, verdict string").fields])
    return hashed.mapInArrow(_judge(cascades, otherwise), schema)


def _keys(shapes: Sequence[tuple[int, int]]) -> Column:
    """A url's keys, the longest first."""
    labels = F.split("host", r"\.")
    found = []
    for count, length in shapes:
        end = F.array_join(F.slice(labels, -count, count), ".")
        key = F.concat(end, F.substring("path", 1, length))
        fits = (F.col("host") != "") & (F.size(labels) >= count) & (F.char_length("path") >= length)
        found.append(F.when(fits, F.struct((-F.char_length(key)).alias("short"), (-F.char_length(end)).alias("end"), key.alias("key"))))
    if not found:
        return F.array().cast("array<struct<short:int,end:int,key:string>>")
    return F.array_sort(F.array_compact(F.array(*found)))


def _judge(cascades: dict[str, Cascade], otherwise: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, h1, h2 = batch.columns[-3:]
            count = np.diff(keys.offsets.to_numpy())
            owner = np.repeat(np.arange(batch.num_rows), count)
            text = keys.flatten().to_pylist()
            h1, h2 = (x.flatten().to_numpy().view(_U) for x in (h1, h2))
            rule: list[str | None] = [None] * batch.num_rows
            verdict = [otherwise] * batch.num_rows
            blocked = cascades[BLOCK].listed(h1, h2)
            some = np.flatnonzero(blocked | cascades[ALLOW].listed(h1, h2))
            for i in some[::-1].tolist():  # the first of a page comes last
                rule[owner[i]], verdict[owner[i]] = text[i], BLOCK if blocked[i] else ALLOW
            names = [*batch.schema.names[:-3], "rule", "verdict"]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-3], pa.array(rule, pa.string()), pa.array(verdict, pa.string())], names)

    return run


#: DuckDB SQL for the query.
SQL = """
WITH parsed AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
rules(h, p, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
  ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block'))
SELECT page_id, host, path,
  (SELECT h || p FROM rules WHERE (host = h OR suffix(host, '.' || h)) AND starts_with(path, p)
   ORDER BY length(h || p) DESC LIMIT 1) AS rule,
  coalesce((SELECT v FROM rules WHERE (host = h OR suffix(host, '.' || h)) AND starts_with(path, p)
   ORDER BY length(h || p) DESC LIMIT 1), 'allow') AS verdict
FROM parsed
"""
