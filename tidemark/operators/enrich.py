"""Child re-aggregation and dimension enrichment."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.sizes import BROADCAST_BYTES, broadcast_if_small


def restrict_children(
    children: DataFrame, parents: DataFrame, keys: Mapping[str, str], small_parents: bool = False
) -> DataFrame:
    """Child rows whose parent is in ``parents``; ``keys`` maps child to parent columns.

    ``small_parents`` states that the caller has measured the parent keys
    (``fits_broadcast``): the child table is then filtered where it is scanned.
    """
    wanted = _parent_keys(parents, keys)
    return children.join(F.broadcast(wanted) if small_parents else wanted, list(keys), "left_semi")


def child_counts(children: DataFrame, keys: Sequence[str], *codes: str) -> DataFrame:
    """How often each code, or each combination of several, occurs per parent.

    Counts are combined before the shuffle and the shuffle is by parent and code,
    so a parent that holds a large share of all rows is not sent to one task.
    """
    return children.groupBy(*keys, *codes).agg(F.count(F.lit(1)).alias("n"))


def child_lists(
    children: DataFrame,
    keys: Sequence[str] | Mapping[str, str],
    code: str | Mapping[str, str],
    alias: str | None = None,
    parents: DataFrame | None = None,
    small_parents: bool = False,
) -> DataFrame:
    """Per parent the sorted list of its codes, duplicates kept and nulls dropped.

    Several columns of the same children are listed in one pass when ``code`` maps each to
    the name of its list.

    With ``parents`` only their children are listed. A small parent side filters
    the children before they are counted; a large one after, because by then a
    parent has at most one row per code and the join cannot be skewed.

    The list is one value of one row. Where a parent has more codes than a value
    can hold, ``child_counts`` is the same information in bounded rows.
    """
    if parents is not None and small_parents:
        children = restrict_children(children, parents, keys, small_parents=True)
    lists = {code: alias} if isinstance(code, str) else dict(code)
    counted = child_counts(children, list(keys), *lists)
    if parents is not None and not small_parents:
        counted = restrict_children(counted, parents, keys)
    entry = F.struct(*[F.col(c).alias(f"code_{i}") for i, c in enumerate(lists)], "n")
    entries = counted.groupBy(*keys).agg(F.collect_list(entry).alias("entries"))
    return entries.select(*keys, *[_expand(f"code_{i}").alias(name) for i, name in enumerate(lists.values())])


def attach(df: DataFrame, lists: DataFrame, keys: Mapping[str, str]) -> DataFrame:
    """Left join of per-parent values; a parent without any gets null.

    ``keys`` maps the key columns of ``lists`` to those of ``df``.
    """
    renamed = lists.withColumnsRenamed(dict(keys))
    return df.join(renamed, list(keys.values()), "left")


def lookup(
    df: DataFrame,
    dimension: DataFrame,
    on: str,
    key: str,
    columns: Mapping[str, str],
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Left join of dimension columns; an unknown id keeps the row with nulls.

    ``columns`` maps columns of the dimension to their names in the result. The
    dimension is measured and broadcast if it fits; a larger one is shuffled and
    adaptive execution splits hot ids.
    """
    narrow = dimension.select(
        F.col(key).alias(on), *[F.col(c).alias(name) for c, name in columns.items()]
    )
    return df.join(broadcast_if_small(narrow, max_bytes), on, "left")


def _parent_keys(parents: DataFrame, keys: Mapping[str, str]) -> DataFrame:
    return parents.select(*[F.col(p).alias(c) for c, p in keys.items()]).distinct()


def _expand(field: str) -> Column:
    repeated = F.transform("entries", lambda e: F.array_repeat(e[field], e["n"].cast("int")))
    return F.sort_array(F.array_compact(F.flatten(repeated)))
