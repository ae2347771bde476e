"""Embedding near-duplicates: E8 lattice hashing in several tables, verified by cosine."""

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.staging import scratch, staged

#: Rows on one side of a block of a cell.
BLOCK_ROWS = 1000
#: Most messages that one group of cells holds, and most bytes, but for chance.
GROUP_ROWS = 50_000
GROUP_BYTES = 64 << 20

# Rotated coordinates are kept as multiples of this, so that distances are exact sums.
_UNIT = 2.0**-20


def near_duplicates(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    cosine: float = 0.98,
    scale: float = 0.85,
    seed: int = 7,
) -> DataFrame:
    """``(key, n_links, component_id, kept)`` for every row of ``vectors``.

    Two vectors of one label and length link when their cosine is at least ``cosine``. A
    vector that is null, empty or zero, holds null or non-finite components, or has no
    label links with nothing. ``n_links`` counts the other rows linked directly, copies
    included; the component is the least key reachable by links.

    Unit vectors are rotated at random and cut into tables of eight coordinates. The
    squared distance of linked vectors is the sum over the tables, so in one table at
    least it is not above its mean, the table's radius: no link is lost. In every table a
    vector is stored in the cell of the E8 lattice that it is decoded to, and probes all
    cells with a point within the radius; ``scale`` is the lattice's scale as a share of
    the vectors' length in a table. A radius beyond the cells that are looked at, as a
    cosine below about 0.82 has at this scale, is a ValueError.

    1. Only ids and the table's eight coordinates are sent to the cells, which tells the
       vectors that have another within the radius.
    2. Those are sent whole. A pair counts in the first table that has it within the
       radius, by exact integer distances, and is verified by its cosine in double
       precision. Blocks of a cell give link counts and a spanning forest, never pairs.

    Equal vectors of a label are one vector with a weight. A crowded cell is dealt into
    blocks of at most about ``BLOCK_ROWS`` rows a side, and as many groups as hold what is
    then sent. Equal rows are copies of each other; a null key is counted as a link but has
    no component. Rows that repeat a key with another vector are told apart: each has the
    links and the component of its own vector. What is written in between is removed; the
    result is written once and handed back.
    """
    with scratch(vectors.sparkSession, "vectors"):
        found = _near_duplicates(vectors, key, vector, label, cosine, scale, seed)
        return staged(found, "near-duplicates", keep=True)


def _near_duplicates(
    vectors: DataFrame, key: str, vector: str, label: str, cosine: float, scale: float, seed: int
) -> DataFrame:
    radius2 = (2 - 2 * cosine) * (1 + 1e-9) + 1e-9
    _check_reach(math.sqrt(radius2) / scale)
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(label).cast("string").alias("label"), F.col(vector).alias("v"))
    ready = staged(
        rows.mapInArrow(_prepare(seed), "id long, label string, dim int, raw binary, turned binary")
        .withColumns({"k1": F.xxhash64("label", "dim", "raw"), "k2": F.xxhash64("raw", "label", F.lit(1))}),
        "vectors",
    )
    usable = ready.filter("raw is not null")
    classes = staged(
        usable.groupBy("k1", "k2").agg(
            F.min("id").alias("rep"), F.count(F.lit(1)).alias("weight"),
            *[F.any_value(c).alias(c) for c in ("label", "dim", "raw", "turned")],
        ).withColumn("node", F.monotonically_increasing_id()),
        "vector-classes",
    )
    # From here to the links a class goes by its own number, since keys may repeat.
    named = classes.filter("rep is not null").withColumn("rep", F.col("node"))
    shells = _shells()

    near = _in_cells(named.select("rep", "label", "dim", "turned"), shells, radius2, scale, whole=False)
    suspects = staged(near.groupBy("bucket").applyInPandas(_suspects(radius2), "rep long").distinct(), "suspects")
    close = _in_cells(
        named.join(suspects, "rep", "left_semi").select("rep", "label", "dim", "turned", "raw", "weight"),
        shells, radius2, scale, whole=True,
    )
    links = staged(
        close.groupBy("bucket").applyInPandas(_verify(radius2, cosine), "rep long, links long, root long"), "links"
    )
    counted = links.groupBy("rep").agg(F.sum("links").alias("links"))
    labels = components(links.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    named_labels = staged(
        labels.join(classes.select(F.col("node").alias("id"), F.col("rep").alias("key")), "id"), "labels"
    )
    least = named_labels.groupBy("component").agg(F.min("key").alias("least"))
    # Keyed by an expression, so that the rows of a large component may be split.
    inside = named_labels.join(
        least.select(F.col("component").cast("string").alias("of"), "least"), F.col("component").cast("string") == F.col("of")
    )
    found = staged(
        classes.select("k1", "k2", F.col("rep").alias("key"), F.col("node").alias("rep"), "weight")
        .join(counted, "rep", "left")
        .join(inside.select(F.col("id").alias("rep"), "least"), "rep", "left")
        .select("k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
                F.coalesce("least", "key").alias("component")),
        "found",
    )
    alone = ready.filter("raw is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component"))
    linked = usable.select("id", "k1", "k2").join(found, ["k1", "k2"]).select("id", "n_links", "component")
    return alone.unionByName(linked).select(
        F.col("id").alias(key),
        "n_links",
        F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component_id"),
        F.coalesce(F.col("id") == F.col("component"), F.lit(False)).alias("kept"),
    )


def _prepare(seed: int):
    """Usable vectors as bytes, and their rotated unit vectors in whole units."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns: dict[int, np.ndarray] = {}
        for batch in batches:
            raw: list[bytes | None] = []
            turned: list[bytes | None] = []
            dims = []
            names = batch.column(1).to_pylist()
            column = batch.column(2)
            kind = column.type.value_type.to_pandas_dtype()
            for name, entry in zip(names, column):
                values = entry.values if entry.is_valid and name is not None else None
                usable = values is not None and len(values) and not values.null_count
                x = np.asarray(values.to_numpy(zero_copy_only=False), float) if usable else np.zeros(1)
                with np.errstate(over="ignore"):
                    norm = math.sqrt(float(x @ x)) if np.isfinite(x).all() else 0.0
                if not 0 < norm < math.inf:
                    raw.append(None)
                    turned.append(None)
                    dims.append(0)
                    continue
                dim = len(x)
                if dim not in turns:
                    turns[dim] = _rotation(dim, seed)
                y = (x / norm) @ turns[dim]
                raw.append(x.astype(kind).tobytes() if kind == np.float32 else x.tobytes())
                turned.append(np.rint(y / _UNIT).astype(np.int32).tobytes())
                dims.append(dim)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(dims, pa.int32()), pa.array(raw, pa.binary()), pa.array(turned, pa.binary())],
                ["id", "label", "dim", "raw", "turned"],
            )

    return run


def _rotation(dim: int, seed: int) -> np.ndarray:
    """Orthonormal columns of a random matrix, padded to whole tables of eight."""
    wide = -(-dim // 8) * 8
    q, _ = np.linalg.qr(np.random.default_rng([seed, dim]).normal(size=(wide, wide)))
    return q[:dim]


def _check_reach(reach: float) -> None:
    """Cells at squared length 6, which are not among the shells, are 1 / sqrt(2) apart."""
    if reach + 1e-6 >= math.sqrt(0.5):
        raise ValueError(f"a radius of {reach:.4f} lattice units reaches cells that are not probed; raise cosine or scale")


def _widened(radius2: float, dim: int) -> float:
    """A bound of the squared distance after coordinates were rounded to whole units."""
    off = math.sqrt(-(-dim // 8) * 8) * _UNIT
    return (math.sqrt(radius2) + off) ** 2


def _shells() -> np.ndarray:
    """E8 vectors of squared length 2 and 4: all differences to cells that a small ball can reach."""
    points = []
    for choice in (range(-2, 3), (-1.5, -0.5, 0.5, 1.5)):
        grid = np.array(list(itertools.product(choice, repeat=4)))
        square = (grid**2).sum(1)
        for a, s in zip(grid, square):
            fit = grid[(s + square == 2) | (s + square == 4)]
            both = np.hstack([np.tile(a, (len(fit), 1)), fit])
            points.append(both[both.sum(1) % 2 == 0])
    return np.concatenate(points).astype(float)


def _decode(x: np.ndarray) -> np.ndarray:
    """The nearest E8 point: the better of the nearest in D8 and in D8 shifted by a half."""

    def d8(x: np.ndarray) -> np.ndarray:
        near = np.rint(x)
        off = x - near
        worst = np.abs(off).argmax(1)
        odd = np.flatnonzero(near.sum(1) % 2)
        near[odd, worst[odd]] += np.where(off[odd, worst[odd]] >= 0, 1, -1)
        return near

    whole, half = d8(x), d8(x - 0.5) + 0.5
    return np.where((((x - whole) ** 2).sum(1) <= ((x - half) ** 2).sum(1))[:, None], whole, half)


def _reach(z: np.ndarray) -> np.ndarray:
    """The greatest product with a root: at most 1 inside the cell of the origin."""
    a = np.abs(z)
    two = np.sort(a, 1)[:, -2:].sum(1)
    odd = (z < 0).sum(1) % 2 == 1
    return np.maximum(two, a.sum(1) / 2 - np.where(odd, a.min(1), 0))


def _code(points: np.ndarray) -> np.ndarray:
    """Lattice points, doubled, as one number each."""
    return np.ascontiguousarray((points * 2).astype(np.int16).astype(np.int8)).view(np.int64)[:, 0]


def _in_cells(rows: DataFrame, shells: np.ndarray, radius2: float, scale: float, whole: bool) -> DataFrame:
    """Every vector in the cells that store it and those it probes, by table, in blocks."""
    payload = [c for c in rows.columns if c not in ("rep", "label", "dim", "turned")]
    sent = "rep long, label string, dim int, tbl int, code long, probe boolean, block binary"
    if whole:
        sent += ", turned binary, raw binary, weight long"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, mine in batch.groupby("dim"):
                units = np.stack([np.frombuffer(t, np.int32) for t in mine["turned"]])
                tables = units.shape[1] // 8
                size = scale / math.sqrt(tables)
                reach = math.sqrt(_widened(radius2, units.shape[1]) / tables) / size
                _check_reach(reach)
                for low in range(0, len(mine), 512):
                    part = mine.iloc[low : low + 512]
                    for t in range(tables):
                        block = np.ascontiguousarray(units[low : low + 512, 8 * t : 8 * t + 8])
                        x = block * (_UNIT / size)
                        cell = _decode(x)
                        off = x - cell
                        far = (off**2).sum(1)[:, None] + (shells**2).sum(1)[None] - 2 * off @ shells.T
                        i, j = np.nonzero(far <= (1 + reach + 1e-6) ** 2)
                        close = _reach(off[i] - shells[j]) <= 1 + (reach + 1e-6) * math.sqrt(2)
                        i, j = i[close], j[close]
                        n = len(part)
                        who = np.concatenate([np.arange(n), np.arange(n), i])
                        code = np.concatenate([_code(cell), _code(cell), _code(cell[i] + shells[j])])
                        bytes_of = np.array([b.tobytes() for b in block], object)
                        out = pd.DataFrame(
                            {"rep": part["rep"].to_numpy()[who], "label": part["label"].to_numpy()[who], "dim": dim, "tbl": t,
                             "code": code, "probe": np.arange(len(who)) >= n, "block": bytes_of[who]}
                        )
                        for c in ("turned", *payload) if whole else ():
                            out[c] = part[c].to_numpy()[who]
                        yield out

    cells = ["label", "dim", "tbl", "code"]
    messages = staged(rows.mapInPandas(run, sent), "cells")
    held = messages.groupBy(*cells).agg(
        F.count_if(~F.col("probe")).alias("stored"), F.count_if("probe").alias("probing")
    )
    # A cell without a stored row, or with one that only itself probes, has no pair.
    held = held.filter("stored > 0 and probing > 1").select(
        *[F.col(c).cast("string").alias(f"at_{c}") for c in cells],
        "stored",
        "probing",
        F.ceil(F.col("stored") / BLOCK_ROWS).cast("int").alias("rows"),
        F.ceil(F.col("probing") / BLOCK_ROWS).cast("int").alias("columns"),
    )
    same = [F.col(c).cast("string") == F.col(f"at_{c}") for c in cells]
    sent = held.agg(F.sum(F.col("stored") * F.col("columns") + F.col("probing") * F.col("rows"))).first()[0] or 0
    wide = F.lit(64) + sum(F.octet_length(c) for c in ("block", *(("turned", "raw") if whole else ())))
    widest = messages.agg(F.max(wide)).first()[0] or 1
    # Cells fall into groups by chance, so a group is planned to be a third of what it may be.
    buckets = max(8, 3 * sent // max(2 * BLOCK_ROWS, min(GROUP_ROWS, GROUP_BYTES // widest)))

    def others(mine: str, many: str, flag: bool):
        own = F.pmod(F.xxhash64("rep", F.lit(2)), F.col(mine)).cast("int")
        every = F.sequence(F.lit(0), F.col(many) - 1)
        return F.transform(every, lambda k: F.struct(*((k.alias("i"), own.alias("j")) if flag else (own.alias("i"), k.alias("j")))))

    spread = F.when(F.col("probe"), others("columns", "rows", True)).otherwise(others("rows", "columns", False))
    blocks = messages.join(held, same).withColumn("__at", F.explode(spread)).withColumn(
        "cell", F.xxhash64(*cells, "__at.i", "__at.j")
    )
    return blocks.withColumn("bucket", F.pmod("cell", F.lit(buckets))).drop("__at", "rows", "columns", "stored", "probing", "label", "code", *[f"at_{c}" for c in cells])


def _blocks(group: pd.DataFrame) -> Iterator[tuple[pd.DataFrame, pd.DataFrame]]:
    """The stored and the probing rows of each block of a cell."""
    group = group.sort_values("cell", kind="stable")
    cuts = np.flatnonzero(np.diff(group["cell"].to_numpy())) + 1
    for low, high in zip([0, *cuts], [*cuts, len(group)]):
        mine = group.iloc[low:high]
        probe = mine["probe"].to_numpy(bool)
        if probe.any() and not probe.all():
            yield mine[~probe], mine[probe]


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of whole numbers."""
    return (a**2).sum(1)[:, None] + (b**2).sum(1)[None] - 2 * (a @ b.T)


def _within(left: pd.DataFrame, right: pd.DataFrame, radius2: float) -> tuple[np.ndarray, float]:
    """Pairs in order of their ids that are within the radius in this table."""
    dim = int(left["dim"].iloc[0])
    limit = _widened(radius2, dim) / -(-dim // 8) / _UNIT**2
    a, b = (np.stack([np.frombuffer(x, np.int32) for x in side["block"]]).astype(float) for side in (left, right))
    return (_squares(a, b) <= limit) & (left["rep"].to_numpy()[:, None] < right["rep"].to_numpy()[None]), limit


def _suspects(radius2: float):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        found: set[int] = set()
        for left, right in _blocks(group):
            close, _ = _within(left, right, radius2)
            found.update(left["rep"].to_numpy()[close.any(1)].tolist())
            found.update(right["rep"].to_numpy()[close.any(0)].tolist())
        return pd.DataFrame({"rep": np.array(sorted(found), np.int64)})

    return run


def _verify(radius2: float, cosine: float):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        out = []
        for left, right in _blocks(group):
            close, limit = _within(left, right, radius2)
            if not close.any():
                continue
            table = int(left["tbl"].iloc[0])
            a, b = (np.stack([np.frombuffer(x, np.int32) for x in side["turned"]]).astype(float) for side in (left, right))
            for t in range(table):
                close &= _squares(a[:, 8 * t : 8 * t + 8], b[:, 8 * t : 8 * t + 8]) > limit
            kind = np.float32 if len(left["raw"].iloc[0]) == 4 * int(left["dim"].iloc[0]) else np.float64
            x, y = (np.stack([np.frombuffer(v, kind) for v in side["raw"]]).astype(float) for side in (left, right))
            both = (x @ y.T) / (np.sqrt((x**2).sum(1))[:, None] * np.sqrt((y**2).sum(1))[None])
            linked = close & (both >= cosine)
            out.append(_forest(linked, left, right))
        kinds = {"rep": np.int64, "links": np.int64, "root": np.int64}
        return pd.concat(out) if out else pd.DataFrame({c: np.zeros(0, k) for c, k in kinds.items()})

    return run


def _forest(linked: np.ndarray, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """Of each linked row the weight of its links, and the least row reached in this block."""
    a, b = left["rep"].to_numpy(np.int64), right["rep"].to_numpy(np.int64)
    top = np.iinfo(np.int64).max
    root_a, root_b = a.copy(), b.copy()
    while True:
        new_b = np.minimum(root_b, np.where(linked, root_a[:, None], top).min(0))
        new_a = np.minimum(root_a, np.where(linked, new_b[None], top).min(1))
        if (new_a == root_a).all() and (new_b == root_b).all():
            break
        root_a, root_b = new_a, new_b
    links_a, links_b = linked @ right["weight"].to_numpy(np.int64), left["weight"].to_numpy(np.int64) @ linked
    some_a, some_b = linked.any(1), linked.any(0)
    return pd.DataFrame(
        {
            "rep": np.concatenate([a[some_a], b[some_b]]),
            "links": np.concatenate([links_a[some_a], links_b[some_b]]).astype(np.int64),
            "root": np.concatenate([root_a[some_a], root_b[some_b]]),
        }
    )
