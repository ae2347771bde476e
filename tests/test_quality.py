import pytest
from conftest import values
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.errors import QualityGateError
from tidemark.operators import (
    clean_rows,
    corrupt,
    enforce_gate,
    error_counts,
    gate,
    in_range,
    not_null,
    null_counts,
    predicate,
    quality_metrics,
    rejected_rows,
    tag,
)

RULES = [corrupt("CORRUPT"), in_range("age", 0, 120, "AGE"), in_range("t", 34.0, 43.0, "TEMP")]
DDL = "age int, t float"


def codes(frame, age, t):
    return tag(frame([(age, t)], DDL), RULES).first()["errors"]


@pytest.mark.parametrize(
    "age, t, expected",
    [
        (0, 34.0, []),
        (120, 43.0, []),
        (-1, 36.6, ["AGE"]),
        (150, 36.6, ["AGE"]),
        (30, 33.0, ["TEMP"]),
        (30, 44.0, ["TEMP"]),
        (200, 50.0, ["AGE", "TEMP"]),
        (None, None, []),
        (30, float("nan"), ["TEMP"]),
    ],
)
def test_ranges(frame, age, t, expected):
    assert codes(frame, age, t) == expected


def test_bounds_take_the_type_of_the_column(frame):
    df = tag(frame([(34.1,)], "t float"), [in_range("t", 34.1, 43.0, "TEMP")])
    assert df.first()["errors"] == []


def test_corrupt_rule_needs_its_column(frame):
    with_column = frame([(30, 36.6, None), (None, None, "{oops")], DDL + ", _corrupt_record string")
    assert [r["errors"] for r in tag(with_column, RULES).collect()] == [[], ["CORRUPT"]]
    assert codes(frame, 30, 36.6) == []


def test_other_rules_and_no_rules(frame):
    df = frame([(None, 1.0)], DDL)
    rules = [not_null("age", "MISSING"), predicate(F.col("t") < 2, "SMALL"), predicate("t > 2", "BIG")]
    assert tag(df, rules).first()["errors"] == ["MISSING", "SMALL"]
    assert tag(df, []).first()["errors"] == []


def test_metrics_and_split(frame, at):
    df = frame([(30, 36.6), (150, 36.6), (30, 50.0), (150, 50.0), (None, None)], DDL)
    tagged = tag(df, RULES)
    assert quality_metrics(tagged).first().asDict() == {
        "total_rows": 5,
        "valid_rows": 2,
        "invalid_rows": 3,
        "corrupt_rows": 0,
        "error_percent": 60.0,
    }
    assert clean_rows(tagged).columns == ["age", "t"]
    assert clean_rows(tagged).count() == 2
    rejected = rejected_rows(tagged, at(2))
    assert rejected.columns == ["age", "t", "errors", "created_at", "rejected_at"]
    assert {r["rejected_at"] for r in rejected.collect()} == {at(2)}
    assert values(error_counts(tagged)) == [("AGE", 2), ("TEMP", 2)]


def test_metrics_of_an_empty_batch(frame):
    row = quality_metrics(tag(frame([], DDL), RULES)).first()
    assert (row.total_rows, row.valid_rows, row.invalid_rows, row.error_percent) == (0, 0, 0, 0.0)


@pytest.mark.parametrize(
    "invalid, total, limit, passes",
    [(0, 10, 5.0, True), (5, 100, 5.0, True), (1251, 25000, 5.0, True), (6, 100, 5.0, False)],
)
def test_gate_compares_the_rounded_percent(spark, invalid, total, limit, passes):
    rows = spark.range(total).select((F.col("id") < invalid).alias("bad"))
    metrics = quality_metrics(tag(rows, [predicate("bad", "BAD")]))
    assert gate(metrics, limit).first()["passed"] is passes
    if passes:
        enforce_gate(metrics.first(), limit)
    else:
        with pytest.raises(QualityGateError):
            enforce_gate(metrics.first(), limit)


def test_null_counts(frame):
    df = frame([(None, 1.0), (1, None), (None, 2.0)], DDL)
    assert values(null_counts(df, ["age", "t"])) == [("age", 2), ("t", 1)]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(
            st.one_of(st.none(), st.integers(-50, 250)),
            st.one_of(st.none(), st.floats(20, 60, width=32)),
        ),
        max_size=20,
    )
)
def test_split_loses_and_repeats_nothing(frame, rows):
    df = frame(rows, DDL)
    tagged = tag(df, RULES)
    bad = sum(
        (a is not None and not 0 <= a <= 120) or (t is not None and not 34 <= t <= 43)
        for a, t in rows
    )
    m = quality_metrics(tagged).first()
    assert (m.total_rows, m.invalid_rows, m.valid_rows) == (len(rows), bad, len(rows) - bad)
    both = clean_rows(tagged).unionByName(rejected_rows(tagged).select("age", "t"))
    assert values(both) == values(df)


def test_a_bound_with_a_fraction_holds_for_whole_numbers(frame):
    df = tag(frame([(0,), (1,), (3,)], "n int"), [in_range("n", 0.5, 2.5, "N")])
    assert [r.errors for r in df.orderBy("n").collect()] == [["N"], [], ["N"]]
