"""Large JSON arrays split over tasks."""

import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import typed_projection
from tidemark.sources import CORRUPT_COLUMN, read_raw_json

DDL = "id bigint, n int, note string, codes array<string>, inner string, _corrupt_record string"


@pytest.fixture
def tiny_ranges(spark):
    """Byte ranges of a few hundred bytes, so that records reach over many of them."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = {n: spark.conf.get(n) for n in names}
    spark.conf.set(names[0], "503b")
    spark.conf.set(names[1], "1b")
    yield
    for n, v in old.items():
        spark.conf.set(n, v)


def rows_of(spark, path, **options):
    schema = T.StructType.fromDDL(DDL)
    typed = typed_projection(read_raw_json(spark, str(path), schema, **options), schema)
    rows = [r.asDict(recursive=True) for r in typed.collect()]
    for r in rows:  # nested values are JSON again, with or without blanks
        r["inner"] = r["inner"] and json.loads(r["inner"])
    return sorted(json.dumps(r, ensure_ascii=False, sort_keys=True) for r in rows)


NOTES = ["", "plain", "}{][", '"', '\\"}', "\\", "\\\\", "line\nbreak", "tab\t}", "},{", "é\U0001f600}", '"},{"id": 9, "note": "', "]", "x" * 700]


def records(n, seed=1):
    rng = random.Random(seed)
    for i in range(n):
        yield {
            "id": i,
            "n": rng.choice([1, 2.5, "bad", None]),
            "note": rng.choice(NOTES) + rng.choice(NOTES),
            "codes": rng.sample(NOTES, rng.randint(0, 3)),
            "inner": {"a": rng.choice(NOTES), "b": [rng.randint(0, 9)] * rng.randint(0, 3)},
            "unknown": {"deep": [{"er": {}}, [], {"}": "{"}]},
        }


@pytest.mark.parametrize("indent, ascii_only", [(None, False), (2, True)])
def test_split_arrays_equal_whole_ones(spark, tmp_path, tiny_ranges, indent, ascii_only):
    for k in range(2):
        text = json.dumps(list(records(40, k)), indent=indent, ensure_ascii=ascii_only)
        (tmp_path / f"{k}.json").write_text(text + "\n" * k)
    whole = rows_of(spark, tmp_path)
    assert rows_of(spark, tmp_path, split_above=0) == whole and len(whole) == 80


@pytest.mark.parametrize(
    "text",
    ["[]", " [ ] \n", '[{"id": 1}]', '[{"id": 1}\n,\n{"id": 2, "note": "}"}]  ', '[{"id": 1, "inner": {}}, {"codes": []}]'],
)
def test_small_arrays(spark, tmp_path, tiny_ranges, text):
    (tmp_path / "a.json").write_text(text)
    assert rows_of(spark, tmp_path, split_above=0) == rows_of(spark, tmp_path)


@pytest.mark.parametrize("cut", ["end", "middle", "comma", "quote", "bracket", "extra", "bare", "twice"])
def test_a_broken_array_is_one_row(spark, tmp_path, tiny_ranges, cut):
    good = list(records(20))
    text = json.dumps(good, ensure_ascii=False)
    middle = text.index('{"id": 15')
    broken = {
        "end": text[:-1],
        "middle": text[: middle + 20],
        "comma": text[: middle - 2] + " " + text[middle:],
        "quote": text[:middle] + '"' + text[middle:],
        "bracket": text[:middle] + "[" + text[middle:],
        "extra": text[:middle] + "7, " + text[middle:],
        "bare": text[:middle] + '{"id": oops}, ' + text[middle:],
        "twice": text + text,
    }[cut]
    (tmp_path / "bad.json").write_text(broken)
    (tmp_path / "good.json").write_text(text)
    schema = T.StructType.fromDDL(DDL)
    got = read_raw_json(spark, str(tmp_path), schema, split_above=0)
    kept = got.filter(F.col(CORRUPT_COLUMN).isNotNull()).collect()
    assert len(kept) == 1 and kept[0].id is None and broken.startswith(kept[0][CORRUPT_COLUMN][:100])
    assert got.filter(F.col(CORRUPT_COLUMN).isNull()).count() == 20


def test_small_and_large_documents_together(spark, tmp_path):
    (tmp_path / "large.json").write_text(json.dumps(list(records(50)), indent=1))
    (tmp_path / "small.json").write_text('{"id": 77}')
    (tmp_path / "cut.json").write_text('[{"id": 78}')
    assert rows_of(spark, tmp_path, split_above=1000) == rows_of(spark, tmp_path)


def test_a_large_array_is_read_by_many_tasks(spark, tmp_path):
    line = json.dumps({"id": 1, "note": "x" * 1000})
    (tmp_path / "a.json").write_text("[" + ",".join([line] * 20_000) + "]")
    pieces = spark.read.option("lineSep", "}").text(str(tmp_path))
    assert pieces.select(F.spark_partition_id()).distinct().count() >= 4
    assert read_raw_json(spark, str(tmp_path), T.StructType.fromDDL(DDL), split_above=1 << 20).count() == 20_000
