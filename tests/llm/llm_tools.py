"""Rows that every operator must take: nulls, empty and long texts, repeats, odd columns."""

import re

import pytest

SF_DIR = "/root/testdata/sf0.001"

LONG = " ".join(f"wort{i % 977} is {i}" for i in range(30_000))
UNBROKEN = "a1é" * 100_000
ZEROS = "0" * 5000 + ".1.2.3 and " + "0" * 6000 + "255.1.0.00 card 4" + "0" * 5000

#: doc_id, text, lang, source
AWKWARD = [
    (1, "The quick brown fox jumps over the lazy dog near the quiet river bank today", "en", "a"),
    (2, "The quick brown fox jumps over the lazy dog near the quiet river bank today", "en", "a"),
    (2, "The quick brown fox jumps over the lazy dog near the quiet river bank today", "en", "a"),
    (3, None, None, None),
    (4, "", "en", "b"),
    (5, " \t\n ", "", "b"),
    (6, "... 123 !!", "de", None),
    (7, LONG, "de", "c"),
    (8, UNBROKEN, None, "c"),
    (12, ZEROS, "en", "c"),
    (None, "der die das und nicht ein schöner Tag für den Fluss", "de", "a"),
    (None, None, "de", "a"),
    (9, "one two", "en", "Z"),
    (10, "one two", "en", "Z"),
    (11, "Ünïcödé ſ K İstanbul \U0001f600 ende", "de", "ä"),
]
#: Columns of other meaning under names that operators use themselves.
CLASHING = (
    "found string, score string, size string, shard string, slot string, hits string, items string, "
    "n_words string, labels string, rule string, host string, lang_pred string, taken string, "
    "component_id string, kind string, bytes string, rows string, rep string, batch string, "
    "id string, label string, block string, text_crc32 string, low string, trigram string"
)
SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="session")
def awkward(spark):
    names = [c.split()[0] for c in CLASHING.split(",")]
    rows = [(*r, *("x" if i % 2 else None for i in range(len(names)))) for r in AWKWARD]
    return spark.createDataFrame(rows, f"{SCHEMA}, {CLASHING}").repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def table(spark):
    return lambda name: spark.read.parquet(f"{SF_DIR}/{name}.parquet")


def folded(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", folded(text))


def alnum(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded(text))


def listed(df, *columns):
    rows = [tuple(r) for r in df.select(*columns).collect()]
    return sorted(rows, key=lambda r: [(v is None, str(v)) for v in r])
