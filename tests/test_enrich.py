from datetime import datetime

import pytest
from conftest import values

from tidemark.operators import (
    attach,
    bounds,
    child_counts,
    child_lists,
    fits_broadcast,
    high_water,
    lookup,
    mark_value,
    newer_than,
    payload_bytes,
    restrict_children,
    since,
)

CHILDREN = "pid int, day int, code string"
ROWS = [(1, 1, "b"), (1, 1, "a"), (1, 1, "b"), (2, 1, None), (3, 1, "c"), (3, 2, "d")]
KEYS = {"pid": "id", "day": "d"}


def test_lists_keep_duplicates_and_drop_nulls(frame):
    out = child_lists(frame(ROWS, CHILDREN), ["pid", "day"], "code", "codes")
    assert values(out) == [
        (1, 1, ["a", "b", "b"]),
        (2, 1, []),
        (3, 1, ["c"]),
        (3, 2, ["d"]),
    ]


def test_several_columns_are_listed_in_one_pass(frame):
    rows = [(1, "b", "x"), (1, "a", "y"), (1, "b", "x"), (1, "b", "y"), (2, None, "z"), (3, None, None)]
    children = frame(rows, "pid int, code string, kind string")
    out = child_lists(children, ["pid"], {"code": "codes", "kind": "kinds"})
    assert out.columns == ["pid", "codes", "kinds"]
    assert values(out) == [(1, ["a", "b", "b", "b"], ["x", "x", "y", "y"]), (2, [], ["z"]), (3, [], [])]


def test_counts_per_code(frame):
    out = child_counts(frame(ROWS, CHILDREN), ["pid"], "code")
    assert values(out) == [(1, "a", 1), (1, "b", 2), (2, None, 1), (3, "c", 1), (3, "d", 1)]


@pytest.mark.parametrize("small", [False, True])
def test_only_children_of_the_given_parents(frame, small):
    parents = frame([(1, 1), (1, 1), (3, 2), (9, 9)], "id int, d int")
    children = frame(ROWS, CHILDREN)
    rows = restrict_children(children, parents, KEYS, small)
    assert values(rows) == [(1, 1, "a"), (1, 1, "b"), (1, 1, "b"), (3, 2, "d")]
    lists = child_lists(children, KEYS, "code", "codes", parents, small)
    assert values(lists) == [(1, 1, ["a", "b", "b"]), (3, 2, ["d"])]


def test_attach_gives_null_to_parents_without_children(frame):
    parents = frame([(1, 1, "p"), (5, 1, "q")], "id int, d int, v string")
    lists = child_lists(frame(ROWS, CHILDREN), KEYS, "code", "codes")
    out = attach(parents, lists, KEYS)
    assert values(out, "id", "v", "codes") == [(1, "p", ["a", "b", "b"]), (5, "q", None)]


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_lookup_keeps_unknown_and_null_ids(frame, limit):
    facts = frame([(1, 10), (2, 99), (3, None)], "id int, dep int")
    dim = frame([(10, "ten", "x"), (11, "eleven", "y")], "id int, name string, more string")
    out = lookup(facts, dim, "dep", "id", {"name": "dep_name"}, max_bytes=limit)
    assert values(out, "id", "dep_name") == [(1, "ten"), (2, None), (3, None)]
    plan = out._jdf.queryExecution().analyzed().toString()
    assert ("broadcast" in plan) is (limit > 0)


def test_payload_bytes_counts_the_text(frame):
    small, large = frame([("a", 1)], "s string, n int"), frame([("a" * 1000, 1)], "s string, n int")
    assert payload_bytes(large) - payload_bytes(small) == 999
    assert payload_bytes(frame([], "s string")) == 0
    assert payload_bytes(frame([([1, 2],), (None,)], "a array<int>")) > 0
    assert not fits_broadcast(large, 500) and fits_broadcast(small, 500)


def test_repeated_values_are_not_taken_for_small(spark, tmp_path):
    path = str(tmp_path / "repeated")
    spark.range(20_000).selectExpr("id % 3 AS id", "repeat('same', 500) AS s").write.parquet(path)
    stored = spark.read.parquet(path)
    written = sum(f.stat().st_size for f in (tmp_path / "repeated").glob("*.parquet"))
    assert written < 1 << 20 and payload_bytes(stored) > 32 << 20
    assert not fits_broadcast(stored, 8 << 20)
    # Rows that the plan makes count too.
    many = spark.range(10).selectExpr("explode(sequence(1, 100000)) AS n")
    assert not fits_broadcast(many, 1 << 20) and fits_broadcast(many, 32 << 20)


def test_high_water_mark(frame, at):
    df = frame([(at(1),), (at(3),), (at(2),), (None,)], "t timestamp_ntz")
    assert mark_value(df, "t") == str(at(3))
    assert mark_value(df.filter("t is null"), "t") is None
    assert mark_value(df.limit(0), "t") is None
    assert high_water(df, "t").columns == ["mark"]
    assert tuple(bounds(df, "t").first()) == (at(1), at(3))


def test_increment_includes_the_mark_and_delta_does_not(frame, at):
    df = frame([(at(1),), (at(2),), (at(2),), (at(3),), (None,)], "t timestamp_ntz")
    assert values(since(df, "t", at(2))) == [(at(2),), (at(2),), (at(3),)]
    assert values(newer_than(df, "t", at(2))) == [(at(3),)]
    assert since(df, "t", None).count() == 4
    assert newer_than(df, "t", None).count() == 5


def test_marks_keep_microseconds(frame):
    moment = datetime(2026, 1, 1, 0, 0, 0, 123456)
    df = frame([(moment,)], "t timestamp_ntz")
    assert since(df, "t", mark_value(df, "t")).count() == 1
    assert newer_than(df, "t", mark_value(df, "t")).count() == 0
