from datetime import datetime

import pytest
from conftest import values
from pyspark.sql import types as T

from tidemark.errors import SchemaChangeError
from tidemark.operators import align, conform, declared, typed_projection


def typed(frame, texts, ddl_type):
    df = frame([(t,) for t in texts], "v string")
    rows = typed_projection(df, T.StructType.fromDDL(f"v {ddl_type}")).collect()
    return [r[0] for r in rows]


def test_whole_numbers_drop_the_fraction_and_reject_the_rest(frame):
    texts = ["7", " 8 ", "-3.7", "1e2", ".5", "x", "", None, "99999999999", "9007199254740993"]
    assert typed(frame, texts, "int") == [7, 8, -3, 100, 0, None, None, None, None, None]
    assert typed(frame, texts[-1:], "bigint") == [9007199254740993]


def test_other_scalars(frame):
    assert typed(frame, ["1.5", "x", None], "double") == [1.5, None, None]
    assert typed(frame, ["2024-01-02 03:04:05", "x"], "timestamp_ntz") == [
        datetime(2024, 1, 2, 3, 4, 5),
        None,
    ]


def test_arrays_come_from_json_text(frame):
    texts = ['["a",null,"a"]', "[]", ' ["b"]', '"a"', "a", '["a"', None]
    assert typed(frame, texts, "array<string>") == [
        ["a", None, "a"],
        [],
        ["b"],
        None,
        None,
        None,
        None,
    ]


def test_typed_arrays_pass_and_missing_columns_are_null(frame):
    df = frame([([1, 2], "dropped")], "a array<int>, other string")
    schema = T.StructType.fromDDL("a array<string>, b int, _corrupt_record string")
    out = typed_projection(df, schema)
    assert out.columns == ["a", "b", "_corrupt_record"]
    assert tuple(out.first()) == (["1", "2"], None, None)


def test_declared_lower_cases_names_and_rejects_unknown_types(spark):
    schema = declared([{"name": "ID", "type": "integer", "nullable": False}, {"name": "n", "type": "string"}])
    assert schema == T.StructType(
        [T.StructField("id", T.IntegerType(), False), T.StructField("n", T.StringType())]
    )
    with pytest.raises(SchemaChangeError, match="wibble"):
        declared([{"name": "x", "type": "wibble"}])


def test_conform_drops_adds_and_widens(frame):
    older = frame([(1, "a", 2.0)], "ID int, gone string, f float")
    schema = T.StructType.fromDDL("f double, id bigint, added string")
    out = conform(older, schema)
    assert out.dtypes == [("f", "double"), ("id", "bigint"), ("added", "string")]
    assert tuple(out.first()) == (2.0, 1, None)


def test_conform_treats_equal_spellings_as_equal(frame):
    df = frame([(1,)], "id int")
    assert conform(df, declared([{"name": "id", "type": "integer"}])).collect() == df.collect()


@pytest.mark.parametrize("old, new", [("bigint", "int"), ("double", "float"), ("string", "int")])
def test_conform_refuses_to_lose_values(frame, old, new):
    df = frame([], f"x {old}")
    with pytest.raises(SchemaChangeError):
        conform(df, T.StructType.fromDDL(f"x {new}"))


def test_conform_refuses_a_new_not_null_column(frame):
    with pytest.raises(SchemaChangeError):
        conform(frame([], "x int"), T.StructType.fromDDL("x int, y int NOT NULL"))


def test_conform_of_an_absent_table(frame):
    out = conform(frame([], "id int, name string"), T.StructType.fromDDL("id bigint, name string"))
    assert out.dtypes == [("id", "bigint"), ("name", "string")] and values(out) == []


def test_align_orders_columns(frame):
    df = frame([(1, "a", True)], "x int, y string, z boolean")
    assert tuple(align(df, T.StructType.fromDDL("y string, x int")).first()) == ("a", 1)
