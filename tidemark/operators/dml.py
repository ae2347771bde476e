"""Keyed upsert, child replacement and keep-latest as DataFrame plans.

Every function returns the rows the table holds afterwards; the jobs write them.
"""

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import MergeKeysError
from tidemark.functions.columns import run_clock


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    *,
    run_ts: datetime | None = None,
    created: str = "created_at",
    updated: str = "updated_at",
    frozen: Sequence[str] = ("id",),
    null_safe: bool = False,
    small_source: bool = False,
    action: str | None = None,
) -> DataFrame:
    """``target`` after merging ``source`` into it on ``keys``.

    A matched row takes every value of the source, nulls included, except its
    keys, ``created`` and ``frozen``; ``updated`` becomes the run time. Other source
    rows are inserted with both stamps set to the run time. A null key matches
    nothing unless ``null_safe``. Two source rows for one target row raise, as MERGE
    does. ``action`` names an optional column telling kept, updated and inserted
    rows apart.

    A ``small_source``, which the caller has measured (``fits_broadcast``), is broadcast:
    matched rows come from a left join and new ones from an anti join, and the target is
    not shuffled. Else target and source are shuffled once each, for a count of the source
    rows per key and one full outer join. Rows whose key has nulls match nothing; they are
    spread by a salt. A target has one row per key, so no other key can be hot.
    """
    if not keys:
        raise MergeKeysError("an upsert needs merge keys")
    columns = target.columns
    stamps = {created, updated}
    changing = [c for c in columns if c not in {*keys, *frozen, *stamps}]
    now = run_clock(run_ts)

    def stamped(column: str) -> Column:
        return now.cast(target.schema[column].dataType).alias(column)

    incoming = source.select(
        *[F.col(c).cast(target.schema[c].dataType).alias(c) for c in columns if c not in stamps]
    )
    overwrites = bool(changing) or updated in columns
    plan = _broadcast_merge if small_source else _shuffled_merge
    joined = plan(target, incoming, keys, changing, null_safe, overwrites)
    matched, new = F.col("__matched"), F.col("__new")

    def merged(column: str) -> Column:
        old = F.col(column)
        if column in stamps:
            fresh = new | (matched & F.lit(column == updated))
            return F.when(fresh, stamped(column)).otherwise(old).alias(column)
        taken = new | matched if column in changing else new
        return F.when(taken, F.col(f"__in_{column}")).otherwise(old).alias(column)

    label = F.when(new, "inserted").when(matched, "updated").otherwise("kept")
    return joined.select(*[merged(c) for c in columns], *([label.alias(action)] if action else []))


def inserted(
    source: DataFrame, schema: T.StructType, run_ts: datetime | None = None, stamps: Sequence[str] = ("created_at", "updated_at")
) -> DataFrame:
    """The rows of ``source`` as ``upsert`` puts them into a table of ``schema`` that holds none."""
    now = run_clock(run_ts)
    return source.select(*[(now if f.name in stamps else F.col(f.name)).cast(f.dataType).alias(f.name) for f in schema.fields])


def _one_match(overwrites: bool) -> Column:
    """Fails where several source rows match one target row, if they would change it."""
    if not overwrites:
        return F.lit(True)
    repeated = F.raise_error(F.lit("several source rows match one target row")).cast("boolean")
    return F.when(F.col("__matched") & (F.col("__rows") > 1), repeated).otherwise(F.lit(True))


def _broadcast_merge(
    target: DataFrame, incoming: DataFrame, keys: Sequence[str], changing: Sequence[str], null_safe: bool, overwrites: bool
) -> DataFrame:
    usable = incoming if null_safe else incoming.dropna(subset=list(keys))
    per_key = usable.groupBy(*[F.col(k).alias(f"__key_{k}") for k in keys]).agg(
        F.count(F.lit(1)).alias("__rows"), *[F.any_value(c).alias(f"__in_{c}") for c in changing]
    )
    same_key = _equal({k: f"__key_{k}" for k in keys}, null_safe)
    rest = target.join(F.broadcast(per_key), same_key, "left").withColumns(
        {"__matched": F.col("__rows").isNotNull(), "__new": F.lit(False)}
    )
    rest = rest.filter(_one_match(overwrites)).drop("__rows", *[f"__key_{k}" for k in keys])
    # What is left of the target's keys is no larger than the source.
    present = target.select(*[F.col(k).alias(f"__key_{k}") for k in keys])
    source_keys = per_key.select(*[F.col(f"__key_{k}").alias(k) for k in keys])
    present = present.join(F.broadcast(source_keys), same_key, "left_semi").distinct()
    inserted = incoming.join(F.broadcast(present), same_key, "left_anti")
    inserted = inserted.select(*[F.col(c).alias(f"__in_{c}") for c in incoming.columns])
    flags = {"__matched": F.lit(False), "__new": F.lit(True)}
    return rest.unionByName(inserted.withColumns(flags), allowMissingColumns=True)


def _shuffled_merge(
    target: DataFrame, incoming: DataFrame, keys: Sequence[str], changing: Sequence[str], null_safe: bool, overwrites: bool
) -> DataFrame:
    def salted(rows: DataFrame, name: str) -> DataFrame:
        if null_safe:
            return rows.withColumn(name, F.lit(0).cast("bigint"))
        usable = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
        plain = [f.name for f in rows.schema.fields if not isinstance(f.dataType, T.MapType)]
        return rows.withColumn(name, F.when(usable, F.lit(0).cast("bigint")).otherwise(F.xxhash64(*plain)))

    per_key = Window.partitionBy(*keys, "__salt")
    # Where nothing would change, repeats are no error: only the first may match.
    rows = F.count(F.lit(1)).over(per_key) if overwrites else F.row_number().over(per_key.orderBy("__salt"))
    counted = salted(incoming, "__salt").withColumn("__rows", rows)
    inside = counted.select(
        *[F.col(c).alias(f"__in_{c}") for c in incoming.columns], F.col("__salt").alias("__in_salt"), "__rows"
    )
    same_key = _equal({k: f"__in_{k}" for k in keys}, null_safe)
    joined = salted(target, "__salt").withColumn("__stored", F.lit(True)).join(
        inside, same_key & (F.col("__salt") == F.col("__in_salt")), "full"
    )
    arrives, stored = F.col("__rows").isNotNull(), F.col("__stored").isNotNull()
    joined = joined.withColumns({"__matched": arrives & stored, "__new": arrives & ~stored})
    single = _one_match(overwrites) if overwrites else ~(F.col("__matched") & (F.col("__rows") > 1))
    return joined.filter(single)


def delete_children(
    children: DataFrame,
    batch: DataFrame,
    keys: Mapping[str, str],
    within: tuple[str, Any, Any] | None = None,
    small_batch: bool = False,
) -> DataFrame:
    """Children whose parent is not in ``batch``; ``keys`` maps child to batch columns.

    ``within`` gives a date column and the bounds of the batch, outside of which no row
    matches. The children are read once.
    """
    parents = batch.select(*[F.col(b).alias(f"__{c}") for c, b in keys.items()]).distinct()
    gone = F.broadcast(parents) if small_batch else parents
    same = _equal({c: f"__{c}" for c in keys}, null_safe=False)
    if within is not None and within[1] is not None and within[2] is not None:
        column, low, high = within
        kind = children.schema[column].dataType
        same = same & F.col(column).between(F.lit(str(low)).cast(kind), F.lit(str(high)).cast(kind))
    return children.join(gone, same, "left_anti")


def explode_children(
    batch: DataFrame,
    keys: Mapping[str, str],
    array: str,
    code: str,
    date: str | None = None,
    run_ts: datetime | None = None,
    stamps: Sequence[str] = (),
) -> DataFrame:
    """One child per array element; null and empty arrays give none.

    Duplicates and null elements stay. ``date`` names a key column that must be
    filled: children without it are left out (``undated_children`` counts them).
    """
    rows = batch.filter(F.col(keys[date]).isNotNull()) if date else batch
    now = run_clock(run_ts)
    return rows.select(
        *[F.col(b).alias(c) for c, b in keys.items()],
        F.explode(array).alias(code),
        *[now.alias(s) for s in stamps],
    )


def undated_counts(arrays: Sequence[tuple[str, str]]) -> list[Column]:
    """Children that ``explode_children`` leaves out for want of a date, by pair of a date
    column and an array, to be aggregated or observed."""
    return [
        F.sum(F.when(F.col(date).isNull(), F.size(F.coalesce(array, F.array())))).alias(f"undated_{i}")
        for i, (date, array) in enumerate(arrays)
    ]


def undated_children(batch: DataFrame, arrays: Sequence[tuple[str, str]]) -> int:
    """How many they are over all pairs, in one pass."""
    if not arrays:
        return 0
    return sum(n or 0 for n in batch.agg(*undated_counts(arrays)).first())


def replace_children(
    children: DataFrame,
    batch: DataFrame,
    keys: Mapping[str, str],
    array: str,
    code: str,
    date: str | None = None,
    run_ts: datetime | None = None,
    within: tuple[str, Any, Any] | None = None,
    small_batch: bool = False,
) -> DataFrame:
    """Children after those of the batch's parents are replaced, as one plan."""
    stamps = [c for c in ("created_at", "updated_at") if c in children.columns]
    kept = delete_children(children, batch, keys, within, small_batch)
    fresh = explode_children(batch, keys, array, code, date, run_ts, stamps)
    return kept.unionByName(fresh.select(*children.columns))


def keep_latest(
    df: DataFrame, keys: Sequence[str], version: str, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """The row with the greatest version per key; ``tiebreak`` decides among equals.

    Spark turns the rank filter into a limit per key ahead of the shuffle, so a
    hot key sends at most one row per task.
    """
    order = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in (version, *tiebreak)])
    ranked = df.withColumn("__rank", F.row_number().over(order))
    return ranked.filter(F.col("__rank") == 1).drop("__rank")


def _equal(pairs: Mapping[str, str], null_safe: bool) -> Column:
    def one(left: str, right: str) -> Column:
        a, b = F.col(left), F.col(right)
        return a.eqNullSafe(b) if null_safe else a == b

    return reduce(lambda a, b: a & b, [one(x, y) for x, y in pairs.items()])
