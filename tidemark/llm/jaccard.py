"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence."""

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.components import components
from tidemark.llm.text import _PLACE, SPACED, Words, _scramble, pieces, tidied, words
from tidemark.operators.sizes import broadcast_if_small
from tidemark.staging import scratch, staged

#: Bytes of text whose rows are dealt out together.
PIECE_BYTES = 3 << 20
#: Bytes of text that are cut into words at once.
WORDS_BYTES = 1 << 19
#: Bytes of text whose n-grams make up one block of columns.
BLOCK_BYTES = 6 << 20
#: An n-gram in more rows of one piece than this is sent once for the piece.
OFTEN = 32
#: Rows on one side of a block of the verifying product.
BLOCK_ROWS = 512
#: Columns that are multiplied at once.
BLOCK_COLUMNS = 4096

# An entry is sent as 48 bits of an n-gram's hash and a row. The bits above are the block and,
# between block and entry, counts of the sorted entries.
_SENT = np.uint64(48)
_LOW = np.uint64((1 << 48) - 1)
_IDX = np.uint64(0xFFFF)
_BITS = np.uint64(16)


def jaccard_groups(
    docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80
) -> DataFrame:
    """``(key, n_shingles, component_id)``: the documents linked through equal n-grams.

    The set of a document is its distinct runs of ``width`` words; a shorter document has
    its whole sequence as one. Two documents link when 100 * intersection >= ``percent`` *
    union; a component carries the least key in it. Null and empty texts have an empty set
    and are alone. ``key`` is taken to be unique; rows that repeat it with an equal text
    are copies of each other. Other columns of ``docs`` are not read.

    1. The incidence matrix is dealt out in blocks of columns, which gives the document
       frequency of every n-gram; columns with one row cannot contribute and go.
    2. Rows are put together again. Size bounds discard a row when so many of its n-grams
       are its own that no partner can reach the overlap it needs, which leaves documents
       with near copies. The rarest n-grams of the others, as many as the bound allows to
       be missing and one more, tell which of them may link.
    3. Equal sets become one row. How many n-grams a row has ahead of the first that it may
       share bounds its overlaps, and by that the sizes of its partners; rows without a
       partner of such a size go. Rows that may link, directly or through others, are
       multiplied block by block, and overlaps below the bound are dropped. Of a group of
       more than a block every row is first compared with one of them: those that link with
       it are in one component, and only rows that do not are multiplied with all others.

    What is written in between is removed; the result is written once and handed back.
    Memory of a task is set by the size of a block. N-grams are known by hashes of 64 bits,
    however many blocks there are; sets with equal 128-bit sums and sizes are taken to be
    equal.
    """
    with scratch(docs.sparkSession, "jaccard"):
        return staged(_groups(docs, key, text, width, percent), "jaccard-groups", keep=True)


def _groups(docs: DataFrame, key: str, text: str, width: int, percent: int) -> DataFrame:
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(8, int(total // BLOCK_BYTES).bit_length())

    dealt = rows.mapInArrow(tidied(_deal(width, bits)), "block int, batch long, entries binary, often binary, meta binary")
    common = dealt.groupBy("block").applyInPandas(
        tidied(_common(bits)), "block int, batch long, entries binary, counts binary, often binary, meta binary"
    )
    sets = common.groupBy("batch").applyInPandas(
        tidied(_rows(percent, bits)),
        "doc_id long, n_shingles int, s1 long, s2 long, suspect boolean, prefix int, shared binary",
    )
    sets = staged(sets, "shingles")
    suspects = sets.filter("suspect")
    classes = staged(
        suspects.groupBy("s1", "s2").agg(
            F.min("doc_id").alias("rep"),
            F.any_value("n_shingles").alias("n"),
            F.any_value("prefix").alias("prefix"),
            F.any_value("shared").alias("shared"),
        ),
        "classes",
    )
    links = _linked(classes, percent)
    reps = classes.select("s1", "s2", "rep").join(
        components(links).withColumnRenamed("id", "rep"), "rep", "left"
    )
    reps = staged(reps.select("s1", "s2", F.coalesce("component", "rep").alias("component_id")), "groups")
    size = F.col("n_shingles").cast("long").alias("n_shingles")
    alone = sets.filter("not suspect").select("doc_id", size, F.col("doc_id").alias("component_id"))
    return alone.unionByName(
        suspects.select("doc_id", size, "s1", "s2")
        .join(reps, ["s1", "s2"], "left")
        .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    ).withColumnRenamed("doc_id", key)


def _shingles(found: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every run of ``width`` words, or of a shorter row's whole sequence."""
    at, value = found.windows(width)
    parts = [(found.row[at], value)]
    count, first = found.per_row(), found.first()
    for short in range(1, width):
        row = np.flatnonzero(count == short)
        total = np.full(len(row), short, np.uint64)
        for k in range(short):
            total += found.hash[first[row] + k] * _PLACE[k]
        parts.append((row, _scramble(total)))
    return tuple(np.concatenate(x) for x in zip(*parts))


def _deal(width: int, bits: int):
    """Entries of the incidence matrix by block of columns, and a record of each piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        serial = TaskContext.get().partitionId() << 32
        for batch in batches:
            ids = batch.column(0)
            for first, _, offsets in pieces(batch.column(1), PIECE_BYTES):
                size = len(offsets) - 1
                parts = []
                for at, data, borders in pieces(batch.column(1).slice(first, size), WORDS_BYTES):
                    part, hashes = _shingles(words(data, borders, SPACED), width)
                    parts.append((part + at, hashes))
                row, value = (np.concatenate(x) for x in zip(*parts))
                order = np.lexsort((row, value))
                row, value = row[order].astype(np.uint16), value[order]
                other = np.append(True, value[1:] != value[:-1])
                fresh = other.copy()
                fresh[1:] |= row[1:] != row[:-1]
                row, value, other = row[fresh], value[fresh], other[fresh]
                edge = np.flatnonzero(other)
                times = np.diff(np.append(edge, len(value)))
                many = np.repeat(times > OFTEN, times)
                hot, hot_times = value[edge[times > OFTEN]], times[times > OFTEN]
                borders = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
                cuts = [0, *np.searchsorted(value, borders).tolist(), len(value)]
                hot_cuts = [0, *np.searchsorted(hot, borders).tolist(), len(hot)]
                low, hot = value & np.uint64((1 << 64 - bits) - 1), hot & np.uint64((1 << 64 - bits) - 1)
                out, often = [], []
                for k in range(1 << bits):
                    mine = slice(cuts[k], cuts[k + 1])
                    if mine.start == mine.stop:
                        continue
                    much = slice(hot_cuts[k], hot_cuts[k + 1])
                    sent, packed = mine, None
                    if much.start < much.stop:
                        packed = _pack(low=hot[much], times=hot_times[much])
                        often.append((k, (low[mine][many[mine]], row[mine][many[mine]])))
                        sent = np.flatnonzero(~many[mine]) + mine.start
                    out.append((k, serial, _shorten(low[sent], row[sent], bits), packed, None))
                n, s1, s2 = np.zeros(size, np.int64), np.zeros(size, np.uint64), np.zeros(size, np.uint64)
                if len(value):
                    n = np.bincount(row, minlength=size)
                    has = np.flatnonzero(n)
                    edge = np.concatenate([[0], np.cumsum(n[has])[:-1]])
                    whole = value[np.argsort(row, kind="stable")]
                    s1[has] = np.add.reduceat(_scramble(whole + np.uint64(1)), edge)
                    s2[has] = np.add.reduceat(_scramble(whole ^ np.uint64(0xA5A5A5A5A5A5A5A5)), edge)
                mine = ids.slice(first, size)
                meta = _pack(ids=mine.to_numpy(zero_copy_only=False), null=mine.is_null().to_numpy(zero_copy_only=False), n=n, s1=s1, s2=s2, often=often)
                out.append((serial % (1 << bits), serial, None, None, meta))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()))],
                    ["block", "batch", "entries", "often", "meta"],
                )
                serial += 1

    return run


def _pack(**arrays) -> bytes:
    return pickle.dumps(arrays, protocol=5)


def _shorten(low: np.ndarray, row: np.ndarray, bits: int) -> bytes:
    """Entries of one block and piece, sorted by hash: counts by the bits not sent, and the rest."""
    if not len(low):
        return b""
    counts = np.bincount((low >> _SENT).astype(np.int64), minlength=1 << max(0, 16 - bits))
    return counts.astype("<u4").tobytes() + ((low & _LOW) << _BITS | row).astype("<u8").tobytes()


def _lengthen(data: bytes, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes below the block's bits, and rows."""
    if not data:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint16)
    counts = np.frombuffer(data, "<u4", 1 << max(0, 16 - bits))
    sent = np.frombuffer(data, "<u8", offset=counts.nbytes).astype(np.uint64)
    top = np.repeat(np.arange(len(counts), dtype=np.uint64), counts)
    return top << _SENT | sent >> _BITS, (sent & _IDX).astype(np.uint16)


def _common(bits: int):
    """The entries of one block whose n-gram is in two rows or more, with its frequency."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        block = int(group["block"].iloc[0])
        meta = group[group["meta"].notna()]
        rows = group[group["meta"].isna()]
        light = [_lengthen(e, bits) for e in rows["entries"]]
        hot = [pickle.loads(o) if o is not None else None for o in rows["often"]]
        low = [x for x, _ in light] + [h["low"] for h in hot if h]
        result = []
        if low:
            times = [np.ones(len(x), np.int64) for x, _ in light] + [h["times"] for h in hot if h]
            known, which = np.unique(np.concatenate(low), return_inverse=True)
            frequency = np.bincount(which, np.concatenate(times)).astype(np.int64)
            for batch, (mine, row), much in zip(rows["batch"], light, hot):
                df = frequency[np.searchsorted(known, mine)]
                keep = df > 1
                counts = np.minimum(df[keep], 0xFFFF).astype(np.uint16)
                back = None
                if much:
                    df = frequency[np.searchsorted(known, much["low"])]
                    back = _pack(low=much["low"], df=np.minimum(df, 0xFFFF).astype(np.uint16))
                if len(counts) or much:
                    result.append((block, batch, _shorten(mine[keep], row[keep], bits), counts.tobytes(), back, None))
        result += [(block, b, None, None, None, m) for b, m in zip(meta["batch"], meta["meta"])]
        return pd.DataFrame(result, columns=["block", "batch", "entries", "counts", "often", "meta"])

    return run


def _rows(percent: int, bits: int):
    """Rows of one piece: size, sum of the set, and the shared n-grams of those that may link."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        meta = pickle.loads(group["meta"].dropna().iloc[0])
        mine = dict(meta["often"])
        value, row, df = [], [], []
        for block, entries, counts, often in zip(group["block"], group["entries"], group["counts"], group["often"]):
            if entries is None:
                continue
            top = np.uint64(block) << np.uint64(64 - bits)
            parts = [(*_lengthen(entries, bits), np.frombuffer(counts, np.uint16))]
            if often is not None:
                much, (low, at) = pickle.loads(often), mine[block]
                parts.append((low, at, much["df"][np.searchsorted(much["low"], low)]))
            for low, at, d in parts:
                value.append(low | top)
                row.append(at)
                df.append(d)
        n = meta["n"]
        need = (n * percent + 99) // 100
        prefix = n - need + 1
        shared, lead = [None] * len(n), np.zeros(len(n), np.int64)
        suspect = np.zeros(len(n), bool)
        if value:
            value, row, df = np.concatenate(value), np.concatenate(row), np.concatenate(df)
            common = np.bincount(row, minlength=len(n))
            suspect = (n > 0) & (n - common < prefix)
            keep = suspect[row]
            value, row, df = value[keep], row[keep], df[keep]
            order = np.lexsort((value, df, row))
            value = value[order]
            cuts = np.searchsorted(row[order], np.arange(len(n) + 1))
            for i in np.flatnonzero(suspect):
                shared[i] = value[cuts[i] : cuts[i + 1]].tobytes()
            lead = prefix - (n - common)
        ids = pd.array(np.where(meta["null"], 0, meta["ids"]).astype(np.int64), "Int64")
        ids[meta["null"]] = pd.NA
        return pd.DataFrame(
            {
                "doc_id": ids,
                "n_shingles": n.astype(np.int32),
                "s1": meta["s1"].view(np.int64),
                "s2": meta["s2"].view(np.int64),
                "suspect": suspect,
                "prefix": np.where(suspect, lead, 0).astype(np.int32),
                "shared": shared,
            }
        )

    return run


def _linked(classes: DataFrame, percent: int) -> DataFrame:
    """Edges ``(a, b)`` that connect what the product finds linked."""
    common = (F.octet_length("shared") / 8).cast("long").alias("common")
    named = classes.filter("rep is not null").select("rep", "n", "prefix", "shared", common)
    near = staged(components(_may_link(named, percent)), "near")
    sizes = near.groupBy("component").agg(F.count("id").alias("members"), F.min_by("id", F.xxhash64("id")).alias("pivot"))
    rows = near.join(sizes, "component").select(F.col("id").alias("rep"), "component", "members", "pivot")
    rows = staged(named.select("rep", "n", "shared").join(rows, "rep"), "rows")
    small = rows.filter(F.col("members") <= BLOCK_ROWS)
    star = staged(_star(rows.filter(F.col("members") > BLOCK_ROWS), percent), "star")

    counts = star.groupBy("component").agg(F.count_if(~F.col("linked")).alias("free"), F.count_if("linked").alias("held"))
    counts = counts.filter("free > 0").select(
        F.col("component").cast("string").alias("at"),
        F.ceil(F.col("free") / BLOCK_ROWS).cast("int").alias("free"),
        F.ceil(F.col("held") / BLOCK_ROWS).cast("int").alias("held"),
    )
    dealt = star.join(counts, F.col("component").cast("string") == F.col("at"))
    hashed = F.xxhash64("rep", F.lit(3))
    part = F.when(F.col("linked"), F.col("free") + F.pmod(hashed, F.col("held"))).otherwise(F.pmod(hashed, F.col("free"))).cast("int")
    others = F.sequence(F.lit(0), F.when(F.col("linked"), F.col("free")).otherwise(F.col("free") + F.col("held")) - 1)
    pairs = F.transform(others, lambda k: F.struct(F.least("part", k).alias("i"), F.greatest("part", k).alias("j")))
    blocks = dealt.withColumn("part", part).withColumn("pair", F.explode(pairs)).select(
        "rep", "n", "shared", "component", "part", F.col("component").alias("spread"), "pair.i", "pair.j"
    )
    alone = small.select(
        "rep", "n", "shared", "component", F.lit(0).alias("part"),
        F.pmod(F.xxhash64("component"), F.lit(4096)).alias("spread"), F.lit(-1).alias("i"), F.lit(-1).alias("j"),
    )
    found = blocks.unionByName(alone).groupBy("spread", "i", "j").applyInPandas(tidied(_multiply(percent)), "a long, b long")
    return found.unionByName(star.filter("linked and rep <> pivot").select(F.col("rep").alias("a"), F.col("pivot").alias("b")))


def _may_link(named: DataFrame, percent: int) -> DataFrame:
    """Rows that have a rare n-gram in common and sizes that allow a link, each with the least
    of them.

    A row of ``n`` n-grams that shares none ahead of a place has at most the ``c`` from there
    on in common with another, which bounds the other's size by c * (100 + percent) / percent
    - n. Of two rows that link the smaller one allows the larger; such rows are ``open``.
    """

    def leading(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            first = [np.frombuffer(s, np.int64)[:p] for s, p in zip(batch["shared"], batch["prefix"])]
            if first:
                size = [len(f) for f in first]
                yield pd.DataFrame(
                    {
                        "gram": np.concatenate(first),
                        "rep": np.repeat(batch["rep"].to_numpy(np.int64), size),
                        "place": np.concatenate([np.arange(k) for k in size]),
                    }
                )

    def together(rows: DataFrame, found: DataFrame) -> DataFrame:
        # Keyed by an expression: both sides are dealt out anew, so a hot n-gram may be split.
        return rows.join(found.withColumnRenamed("gram", "of"), F.col("gram").bitwiseXOR(F.lit(1)) == F.col("of").bitwiseXOR(F.lit(1))).drop("of")

    grams = named.select("rep", "prefix", "shared").mapInPandas(tidied(leading), "gram long, rep long, place long")
    grams = staged(grams, "grams")
    shared = grams.groupBy("gram").agg(F.count("rep").alias("times")).filter("times > 1").select("gram")
    met = staged(together(grams, shared), "met")
    ahead = met.groupBy("rep").agg(F.min("place").alias("ahead"))
    size = named.select("rep", "n", "common").join(ahead, "rep")
    most = F.floor((F.col("common") - F.col("ahead")) * (100 + percent) / percent).cast("long") - F.col("n")
    size = size.withColumn("most", most).filter(100 * F.col("most") >= percent * F.col("n")).select("rep", "n", "most")
    met = staged(met.select("gram", "rep").join(size, "rep").withColumn("open", F.col("most") >= F.col("n")), "sized")
    # All rows of an n-gram that may link hang on its least open one, which is among them.
    open_rows = met.filter("open").groupBy("gram").agg(
        F.min("n").alias("low"), F.max("most").alias("high"), F.min("rep").alias("least")
    )
    kept = together(met, open_rows).filter("open or (n <= high and most >= low)")
    return kept.filter("rep <> least").select(F.col("rep").alias("a"), F.col("least").alias("b")).distinct()


def _star(rows: DataFrame, percent: int) -> DataFrame:
    """Rows of large groups, and whether they link with their group's pivot."""
    pivots = rows.filter("rep = pivot").select(
        F.col("component").cast("string").alias("at"), F.col("n").alias("pivot_n"), F.col("shared").alias("pivot_shared")
    )
    both = rows.join(broadcast_if_small(pivots), F.col("component").cast("string") == F.col("at")).drop("at", "members")
    schema = T.StructType([*both.drop("pivot_n", "pivot_shared").schema.fields, T.StructField("linked", T.BooleanType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            known: dict[int, np.ndarray] = {}
            linked = []
            for n, shared, component, m, other in zip(*(batch[c] for c in ("n", "shared", "component", "pivot_n", "pivot_shared"))):
                if component not in known:
                    known = {component: np.sort(np.frombuffer(other, np.uint64))}
                pivot, mine = known[component], np.frombuffer(shared, np.uint64)
                at = np.minimum(np.searchsorted(pivot, mine), max(0, len(pivot) - 1))
                overlap = int((pivot[at] == mine).sum()) if len(pivot) else 0
                linked.append(100 * overlap >= percent * (n + m - overlap))
            yield batch.drop(columns=["pivot_n", "pivot_shared"]).assign(linked=linked)

    return both.mapInPandas(tidied(run), schema)


def _multiply(percent: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        edges = []
        for _, rows in group.groupby("component"):
            edges += _links(rows, percent)
        return pd.DataFrame(edges, columns=["a", "b"])

    return run


def _links(rows: pd.DataFrame, percent: int) -> list[tuple[int, int]]:
    """Each linked row with the least row that it reaches within this block."""
    i, j = int(rows["i"].iloc[0]), int(rows["j"].iloc[0])
    if i != j:
        rows = pd.concat([rows[rows["part"] == i], rows[rows["part"] == j]])
    half = int((rows["part"] == i).sum()) if i != j else len(rows)
    sets = [np.frombuffer(s, np.uint64) for s in rows["shared"]]
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    known, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    keep = times[column] > 1
    owner, column = owner[keep], column[keep]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    columns, column = np.unique(column, return_inverse=True)
    cuts = np.searchsorted(column, np.arange(0, len(columns) + BLOCK_COLUMNS, BLOCK_COLUMNS))
    left, right = slice(0, half), slice(half if i != j else 0, len(sets))
    overlap = np.zeros((half, len(sets) - right.start), np.float32)
    for low, high, base in zip(cuts[:-1], cuts[1:], range(0, len(columns), BLOCK_COLUMNS)):
        piece = np.zeros((len(sets), min(BLOCK_COLUMNS, len(columns) - base)), np.float32)
        piece[owner[low:high], column[low:high] - base] = 1
        overlap += piece[left] @ piece[right].T
    n = rows["n"].to_numpy(np.int64)
    o = overlap.astype(np.int64)
    linked = 100 * o >= percent * (n[left][:, None] + n[right][None, :] - o)
    rep = rows["rep"].to_numpy(np.int64)
    label = np.arange(len(sets))
    a, b = np.nonzero(linked)
    b = b + right.start
    order = np.argsort(rep, kind="stable")
    rank = np.empty(len(rep), np.int64)
    rank[order] = np.arange(len(rep))
    label = rank.copy()
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = np.minimum(new, label[order[new]])
        if (new == label).all():
            break
        label = new
    moved = np.flatnonzero(label != rank)
    return [(int(rep[x]), int(rep[order[label[x]]])) for x in moved]
