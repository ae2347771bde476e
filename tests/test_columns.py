from datetime import date, datetime

import pytest
from conftest import values
from pyspark.sql import functions as F

from tidemark.functions import (
    guarded_ratio,
    hash_key,
    month_start,
    parse_timestamp,
    run_clock,
)

MOMENT = datetime(2024, 1, 15, 10, 30)
DAY = datetime(2024, 1, 15)


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2024-01-15 10:30:00", MOMENT),
        ("2024-01-15", DAY),
        ("15.01.2024 10:30:00", MOMENT),
        ("15.01.2024", DAY),
        ("2024-01-15T10:30:00", None),
        ("2024-1-5", None),
        ("31.02.2024", None),
        ("2024", None),
        ("2024-01-15\n", None),
        ("2024-01-15 10:30", None),
        ("not a date", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_timestamp(frame, text, expected):
    df = frame([(text,)], "t string")
    assert df.select(parse_timestamp(F.col("t"))).first()[0] == expected


def test_parse_timestamp_keeps_the_wall_clock_in_a_clock_change_gap(spark, frame):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = frame([("10.03.2024 02:30:00",)], "t string")
        parsed = df.select(parse_timestamp(F.col("t")).cast("string")).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert parsed == "2024-03-10 02:30:00"


def test_hash_key_depends_on_every_part_and_marks_missing_ones(frame):
    df = frame(
        [("a", "b"), ("a", "b"), ("a", "c"), (None, None)],
        "x string, y string",
    )
    rows = [r[0] for r in df.select(hash_key(F.col("x"), F.col("y"))).collect()]
    assert rows[0] == rows[1] != rows[2]
    known = df.select(F.md5(F.lit("EMPTY-EMPTY"))).first()[0]
    assert rows[3] == known


def test_hash_key_of_a_timestamp_part(frame):
    df = frame([(MOMENT,), (None,)], "t timestamp_ntz")
    rows = [r[0] for r in df.select(hash_key(F.col("t"))).collect()]
    expected = df.select(F.md5(F.lit("2024-01-15 10:30:00")), F.md5(F.lit("EMPTY"))).first()
    assert rows == list(expected)


@pytest.mark.parametrize(
    "height, weight, expected",
    [
        (175, 75.0, 24.5),
        (170, 65.0, 22.5),
        (0, 70.0, None),
        (170, 0.0, None),
        (-5, 70.0, None),
        (None, 70.0, None),
        (170, None, None),
    ],
)
def test_guarded_ratio(frame, height, weight, expected):
    df = frame([(height, weight)], "h int, w float")
    assert df.select(guarded_ratio(F.col("w"), F.col("h"))).first()[0] == expected


def test_month_start_is_a_date(frame):
    df = frame([(MOMENT,), (None,)], "t timestamp_ntz")
    assert [r[0] for r in df.select(month_start(F.col("t"))).collect()] == [
        date(2024, 1, 1),
        None,
    ]


def test_run_clock_is_the_given_time(frame):
    df = frame([(1,)], "x int").select(run_clock(MOMENT), run_clock())
    fixed, session = df.first()
    assert fixed == MOMENT and session is not None
