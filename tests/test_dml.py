import pytest
from conftest import values
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import SparkRuntimeException

from tidemark.errors import MergeKeysError
from tidemark.operators import (
    delete_children,
    explode_children,
    keep_latest,
    replace_children,
    undated_children,
    upsert,
)

TARGET = "id string, k int, v int, created_at timestamp_ntz, updated_at timestamp_ntz"
SOURCE = "id string, k int, v int"
SMALL = pytest.mark.parametrize("small", [False, True])


@SMALL
def test_upsert_updates_inserts_and_keeps(frame, at, small):
    target = frame([("a", 1, 10, at(1), at(1)), ("b", 2, 20, at(1), at(1))], TARGET)
    source = frame([("z", 1, None), ("c", 3, 30)], SOURCE)
    out = upsert(target, source, ["k"], run_ts=at(5), small_source=small, action="action")
    assert values(out) == [
        ("a", 1, None, at(1), at(5), "updated"),
        ("b", 2, 20, at(1), at(1), "kept"),
        ("c", 3, 30, at(5), at(5), "inserted"),
    ]


@SMALL
def test_upsert_null_keys_match_nothing_by_default(frame, at, small):
    target = frame([("a", None, 1, at(1), at(1))], TARGET)
    source = frame([("b", None, 2)], SOURCE)
    plain = upsert(target, source, ["k"], run_ts=at(2), small_source=small)
    assert values(plain, "id", "v") == [("a", 1), ("b", 2)]
    safe = upsert(target, source, ["k"], run_ts=at(2), null_safe=True, small_source=small)
    assert values(safe, "id", "v") == [("a", 2)]


@SMALL
def test_upsert_raises_when_two_source_rows_match_one_target_row(frame, at, small):
    target = frame([("a", 1, 1, at(1), at(1))], TARGET)
    source = frame([("b", 1, 2), ("c", 1, 3)], SOURCE)
    with pytest.raises(SparkRuntimeException, match="several source rows"):
        upsert(target, source, ["k"], run_ts=at(2), small_source=small).collect()


@SMALL
def test_upsert_inserts_unmatched_duplicates(frame, at, small):
    source = frame([("b", 1, 2), ("c", 1, 3)], SOURCE)
    out = upsert(frame([], TARGET), source, ["k"], run_ts=at(2), small_source=small)
    assert values(out, "id", "v") == [("b", 2), ("c", 3)]


def test_upsert_needs_keys(frame):
    with pytest.raises(MergeKeysError):
        upsert(frame([], TARGET), frame([], SOURCE), [])


def test_upsert_without_updatable_columns_only_inserts(frame):
    target = frame([(1, 1)], "k int, j int")
    source = frame([(1, 1), (1, 1), (2, 2)], "k int, j int")
    assert values(upsert(target, source, ["k", "j"])) == [(1, 1), (2, 2)]


def test_upsert_takes_the_types_of_the_target(frame):
    target = frame([], "k bigint, v float")
    out = upsert(target, frame([(1, 2.5)], "k int, v double"), ["k"])
    assert out.dtypes == [("k", "bigint"), ("v", "float")] and values(out) == [(1, 2.5)]


ROWS = st.lists(
    st.tuples(st.integers(0, 6), st.one_of(st.none(), st.integers(0, 3))),
    max_size=6,
    unique_by=lambda r: r[0],
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ROWS, ROWS)
def test_upsert_against_a_dictionary_and_twice_is_once(frame, at, old, new):
    target = frame([(str(k), k, v, at(1), at(1)) for k, v in old], TARGET)
    source = frame([(str(k), k, v) for k, v in new], SOURCE)
    once = upsert(target, source, ["k"], run_ts=at(2))
    expected = {**dict(old), **dict(new)}
    assert {r.k: r.v for r in once.collect()} == expected
    assert once.count() == len(expected)
    assert values(upsert(once, source, ["k"], run_ts=at(2))) == values(once)


CHILDREN = (
    "parent string, code string, day timestamp_ntz, created_at timestamp_ntz, "
    "updated_at timestamp_ntz"
)
BATCH = "id string, day timestamp_ntz, codes array<string>"
KEYS = {"parent": "id", "day": "day"}


def children(frame, at):
    return frame(
        [
            ("a", "old", at(1), at(1), at(1)),
            ("a", "other day", at(9), at(1), at(1)),
            ("b", "old", at(2), at(1), at(1)),
            ("c", "old", at(3), at(1), at(1)),
        ],
        CHILDREN,
    )


def batch(frame, at):
    return frame(
        [
            ("a", at(1), ["x", "x", None]),
            ("b", at(2), []),
            ("d", at(4), ["y"]),
            ("e", None, ["lost", "lost"]),
            ("f", at(4), None),
        ],
        BATCH,
    )


@pytest.mark.parametrize("within", [False, True])
@SMALL
def test_children_are_replaced_per_parent(frame, at, within, small):
    bounds = ("day", at(1), at(4)) if within else None
    out = replace_children(
        children(frame, at),
        batch(frame, at),
        KEYS,
        "codes",
        "code",
        date="day",
        run_ts=at(20),
        within=bounds,
        small_batch=small,
    )
    assert values(out, "parent", "code", "day", "created_at") == [
        ("a", "other day", at(9), at(1)),
        ("a", "x", at(1), at(20)),
        ("a", "x", at(1), at(20)),
        ("a", None, at(1), at(20)),
        ("c", "old", at(3), at(1)),
        ("d", "y", at(4), at(20)),
    ]


def test_undated_children_are_counted(frame, at):
    assert undated_children(batch(frame, at), [("day", "codes")]) == 2
    assert undated_children(frame([], BATCH), [("day", "codes")]) == 0


def test_delete_keeps_undated_children_and_ignores_missing_bounds(frame, at):
    rows = frame([("a", "x", None, at(1), at(1)), ("b", "y", at(2), at(1), at(1))], CHILDREN)
    gone = frame([("a", None, None), ("b", at(2), None)], BATCH)
    for bounds in (None, ("day", None, None), ("day", at(2), at(2))):
        assert values(delete_children(rows, gone, KEYS, bounds), "parent") == [("a",)]


def test_explode_keeps_duplicates_and_nulls(frame, at):
    rows = frame([("a", at(1), ["x", None, "x"]), ("b", at(1), []), ("c", at(1), None)], BATCH)
    out = explode_children(rows, {"parent": "id"}, "codes", "code")
    assert values(out) == [("a", "x"), ("a", "x"), ("a", None)]


LISTS = st.lists(
    st.tuples(st.integers(0, 4), st.lists(st.sampled_from("xyz"), max_size=3)),
    max_size=5,
    unique_by=lambda r: r[0],
)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(LISTS, LISTS)
def test_replacing_children_twice_is_once(frame, at, old, new):
    def rows(lists):
        return frame([(str(k), at(k + 1), v) for k, v in lists], BATCH)

    def load(current, lists):
        return replace_children(current, rows(lists), KEYS, "codes", "code", "day", at(9))

    start = load(frame([], CHILDREN), old)
    once = load(start, new)
    expected = [(str(k), c) for k, v in {**dict(old), **dict(new)}.items() for c in v]
    assert values(once, "parent", "code") == sorted(expected)
    assert values(load(once, new)) == values(once)


def test_keep_latest_takes_the_newest_and_breaks_ties(frame, at):
    df = frame(
        [(1, at(1), 1), (1, at(3), 2), (1, at(3), 3), (2, at(1), 4), (None, at(1), 5), (3, None, 6)],
        "k int, t timestamp_ntz, n int",
    )
    out = keep_latest(df, ["k"], "t", ["n"])
    assert values(out, "k", "n") == [(1, 3), (2, 4), (3, 6), (None, 5)]
    assert values(keep_latest(out, ["k"], "t", ["n"])) == values(out)
