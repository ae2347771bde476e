"""Increments, merges and compaction that touch only what changed."""

import json
import re
from datetime import datetime

import pytest
from conftest import values
from oracle import connect, mismatch
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_plans import SF_DIR, plan

from tidemark.errors import MergeKeysError, SchemaChangeError
from tidemark.operators import since, sizes, upsert
from tidemark.operators.incremental import micros
from tidemark.plans import ChildTable, clean, compact_mart, curated, mart_stage, read_mart, run_mart
from tidemark.plans.clean import _replace
from tidemark.plans.mart import MONTH
from tidemark.sinks import merge_into, writers
from tidemark.sources import Table
from tidemark.sources.swaps import Swaps
from tidemark.sources.tables import one_of

DDL = "id bigint, at timestamp_ntz, v string, created_at timestamp_ntz, updated_at timestamp_ntz"


@pytest.fixture
def months(spark, tmp_path):
    """A table of 40 months with three rows each, loaded on the first of January."""
    table = Table(str(tmp_path / "t"), T.StructType.fromDDL(DDL), keys=("id", "at"), date="at")
    rows = spark.range(120).selectExpr(
        "id", "cast(add_months(date'2020-01-15', cast(id div 3 as int)) as timestamp_ntz) AS at", "'old' AS v"
    )
    merge_into(table, rows, datetime(2026, 1, 1))
    return table


def batch(spark, *ids):
    return spark.range(120).filter(F.col("id").isin(*ids)).selectExpr(
        "id", "cast(add_months(date'2020-01-15', cast(id div 3 as int)) as timestamp_ntz) AS at", "'new' AS v"
    )


def parts_read(df):
    found = re.search(r"PartitionFilters: \[(.*?)\]\s*, PushedFilters", plan(df), re.S)
    return sorted(set(re.findall(r"\d{4}-\d\d-\d\d", found[1]))) if found else []


def test_an_increment_reads_the_partitions_that_changed(spark, months):
    mark = datetime(2026, 1, 2)
    merge_into(months, batch(spark, 3, 4, 100), mark)
    read = months.read_since(spark, "updated_at", mark)
    assert parts_read(read) == ["2020-02-01", "2022-10-01"]
    assert values(read, "id") == [(i,) for i in sorted((3, 4, 5, 99, 100, 101), key=lambda i: str(i))]
    cut = since(read, "updated_at", mark)
    assert values(cut) == values(since(months.read(spark), "updated_at", mark)) and cut.count() == 3
    # The mark is included, as text, as a moment and as a number.
    for same in ("2026-01-02 00:00:00", micros(mark)):
        assert months.parts_since(spark, "updated_at", same) == ["2020-02-01", "2022-10-01"]
    assert months.parts_since(spark, "updated_at", mark, strict=True) == []
    assert months.parts_since(spark, "updated_at", datetime(2026, 1, 3)) == []
    assert len(months.parts_since(spark, "updated_at", datetime(2026, 1, 1))) == 40
    # What is not known is read.
    assert months.parts_since(spark, "updated_at", None) is None
    assert months.parts_since(spark, "v", "x") is None
    assert months.read_since(spark, "updated_at", "no moment").count() == 120


def test_the_newest_stamp_is_read_where_it_may_be(spark, months, monkeypatch):
    merge_into(months, batch(spark, 3, 100), datetime(2026, 1, 2))
    asked = []
    read_parts = Table.read_parts
    monkeypatch.setattr(Table, "read_parts", lambda self, spark, parts: asked.append(list(parts)) or read_parts(self, spark, parts))
    assert months.greatest(spark, "updated_at") == "2026-01-02 00:00:00"
    assert months.greatest(spark, "created_at") == "2026-01-01 00:00:00"
    assert asked[0] == ["2020-02-01", "2022-10-01"] and len(asked[1]) == 40
    # The rows that were newest go, file by file; their bound stays.
    files = [f for p in asked[0] for f in [f"part_date={p}/{n}" for n in files_of(months, spark, p)]]
    months.rewrite(months.read(spark).limit(0), files)
    del asked[:]
    assert months.greatest(spark, "updated_at") == "2026-01-01 00:00:00"
    assert [len(a) for a in asked] == [2, 38]
    assert months.greatest(spark, "id") == "119"
    Swaps(spark, months.path)._files.delete("_changes")
    assert months.greatest(spark, "updated_at") == "2026-01-01 00:00:00"


def test_without_a_record_of_changes_everything_is_read(spark, months):
    path = months.path + "/_changes"
    held = json.loads(open(path).read())
    for part in ("2020-01-01", "2021-01-01"):
        del held["parts"][f"part_date={part}"]
    Swaps(spark, months.path)._files.write("_changes", json.dumps(held))
    late = datetime(2026, 2, 1)
    assert months.parts_since(spark, "updated_at", late) == ["2020-01-01", "2021-01-01"]
    # Files that join a partition of unknown rows leave it unknown; rewriting it makes it known.
    merge_into(months, batch(spark, 0).withColumn("id", F.col("id") + 500), datetime(2026, 1, 2), small=True)
    assert "2020-01-01" in months.parts_since(spark, "updated_at", late)
    merge_into(months, batch(spark, 0, 1, 2), datetime(2026, 1, 3), small=False)
    assert months.parts_since(spark, "updated_at", late) == ["2021-01-01"]
    Swaps(spark, months.path)._files.delete("_changes")
    assert months.parts_since(spark, "updated_at", late) is None
    assert months.read_since(spark, "updated_at", late).count() == 121


def test_bounds_are_those_of_the_rows(spark, frame, at, tmp_path):
    table = Table(str(tmp_path / "t"), T.StructType.fromDDL(DDL), keys=("id", "at"), date="at")
    table.replace(frame([(1, at(5), "a", at(7), None)], DDL))
    assert table.parts_since(spark, "created_at", at(7)) == ["2026-01-01"]
    assert table.parts_since(spark, "created_at", at(8)) == []
    assert table.parts_since(spark, "updated_at", at(1)) == []
    table.rewrite(frame([(2, at(6), "b", at(3), at(9))], DDL), [])
    assert table.parts_since(spark, "created_at", at(7)) == ["2026-01-01"]
    assert table.parts_since(spark, "updated_at", at(9)) == ["2026-01-01"]
    table.replace(frame([], DDL), ["2026-01-01"])
    assert table.parts_since(spark, "created_at", at(1)) is None
    zoned = Table(str(tmp_path / "z"), T.StructType.fromDDL("id int, at timestamp_ntz, created_at timestamp"), date="at")
    zoned.replace(spark.sql("SELECT 1 AS id, timestamp_ntz'2026-01-05' AS at, timestamp_micros(1000) AS created_at"))
    assert zoned.parts_since(spark, "created_at", 1000) == ["2026-01-01"]
    assert zoned.parts_since(spark, "created_at", 1001) == []


def files_of(table, spark, part):
    return Swaps(spark, table.path)._files.names(f"part_date={part}")


def test_one_file_of_fifty_is_rewritten(spark, tmp_path):
    table = Table(str(tmp_path / "t"), T.StructType.fromDDL(DDL), keys=("id", "at"), date="at")
    rows = spark.range(500).selectExpr(
        "id", "timestamp_ntz'2026-01-05' AS at", "'old' AS v",
        "timestamp_ntz'2026-01-01' AS created_at", "timestamp_ntz'2026-01-01' AS updated_at",
    )
    rows.withColumn("part_date", F.lit("2026-01-01").cast("date")).repartitionByRange(50, "id").write.partitionBy("part_date").parquet(table.path)
    before = set(files_of(table, spark, "2026-01-01"))
    assert len(before) == 50
    one = rows.filter("id = 123").select("id", "at", F.lit("new").alias("v"))
    merge_into(table, one, datetime(2026, 1, 2), small=True)
    after = set(files_of(table, spark, "2026-01-01"))
    assert len(before - after) == 1 and len(after - before) == 1
    changed = table.read(spark).filter("v = 'new'").collect()
    assert [(r.id, r.created_at, r.updated_at) for r in changed] == [(123, datetime(2026, 1, 1), datetime(2026, 1, 2))]
    assert table.read(spark).count() == 500
    # New keys rewrite nothing; a batch that matches most files rewrites the partition.
    merge_into(table, one.withColumn("id", F.col("id") + 1000), datetime(2026, 1, 3), small=True)
    assert after < set(files_of(table, spark, "2026-01-01"))
    merge_into(table, rows.filter("id % 5 = 0").select("id", "at", F.lit("many").alias("v")), datetime(2026, 1, 4), small=True)
    assert len(files_of(table, spark, "2026-01-01")) < 10
    assert table.read(spark).groupBy("v").count().orderBy("v").collect() == [("many", 100), ("new", 2), ("old", 399)]


@pytest.mark.parametrize("file_by_file", [True, False])
def test_merges_agree_either_way(spark, frame, at, tmp_path, file_by_file):
    table = Table(str(tmp_path / "t"), T.StructType.fromDDL(DDL), keys=("id", "at"), date="at")
    stored = [(i, at(1 + i % 3) if i % 4 else None, "old") for i in range(40)]
    fresh = [(i, at(1 + i % 3) if i % 4 else None, "new") for i in range(30, 50)]
    for n, rows in enumerate((stored[:20], stored[20:], fresh)):
        merge_into(table, frame(rows, "id bigint, at timestamp_ntz, v string"), at(10 + n), small=file_by_file)
    expected = [(i, t, "old", at(10 + (i >= 20)), at(10 + (i >= 20))) for i, t, _ in stored if i < 30 or t is None]
    expected += [(i, t, "new", at(11), at(12)) for i, t, _ in fresh if i < 40 and t is not None]
    expected += [(i, t, "new", at(12), at(12)) for i, t, _ in fresh if i >= 40 or t is None]
    assert sorted(map(str, values(table.read(spark)))) == sorted(map(str, expected))


@pytest.mark.parametrize("after", ["marker", "added", "removed"])
def test_a_file_swap_that_broke_off_is_finished(spark, months, tmp_path, monkeypatch, after):
    with monkeypatch.context() as broken:
        broken.setattr(Swaps, "finish", lambda *_: None)
        held = months.files_holding(batch(spark, 3), {"id": "id", "at": "at"}, ["2020-02-01"])
    merge_into(months, batch(spark, 3).withColumn("id", F.col("id") + 900), datetime(2026, 1, 2), small=True)
    merge_into(months, batch(spark, 3).withColumn("id", F.col("id") + 800), datetime(2026, 1, 2), small=True)
    held = months.files_holding(batch(spark, 3), {"id": "id", "at": "at"}, ["2020-02-01"])
    assert held and len(held) == 1
    with monkeypatch.context() as broken:
        broken.setattr(Swaps, "finish", lambda *_: None)
        merge_into(months, batch(spark, 3), datetime(2026, 1, 3), small=True)
    swaps = Swaps(spark, months.path)
    swap = next(n for n in swaps._files.names() if n.startswith("_swap"))
    todo = json.loads(swaps._files.read(f"{swap}/READY"))
    assert todo["removed"] == held and len(todo["added"]) == 1
    if after != "marker":
        swaps._files.move(f"{swap}/{todo['added'][0]}", todo["added"][0])
    if after == "removed":
        swaps._files.delete(held[0])
    rows = months.read(spark).filter("at = timestamp_ntz'2020-02-15'")
    assert values(rows, "id", "v") == [(3, "new"), (4, "old"), (5, "old"), (803, "new"), (903, "new")]
    assert not [n for n in swaps._files.names() if n.startswith("_swap")]
    assert months.parts_since(spark, "updated_at", datetime(2026, 1, 3)) == ["2020-02-01"]


def test_a_failed_file_swap_changes_nothing(spark, months):
    merge_into(months, batch(spark, 3).withColumn("id", F.col("id") + 900), datetime(2026, 1, 2), small=True)
    before = values(months.read(spark))
    twice = batch(spark, 3).unionByName(batch(spark, 3))
    with pytest.raises(Exception, match="several source rows"):
        merge_into(months, twice, datetime(2026, 1, 3), small=True)
    assert values(months.read(spark)) == before


def test_children_are_replaced_file_by_file(spark, frame, at, tmp_path):
    ddl = "pid string, code string, day timestamp_ntz, created_at timestamp_ntz, updated_at timestamp_ntz"
    table = Table(str(tmp_path / "c"), T.StructType.fromDDL(ddl), date="day", grain="day")
    child = ChildTable(table, {"pid": "id", "day": "at"}, "codes", "code")
    given = "id string, at timestamp_ntz, codes array<string>"
    for n, pid in enumerate("abcd"):
        _replace(frame([(pid, at(1), [pid, "x"])], given), child, True, at(2 + n))
    before = set(files_of(table, spark, "2026-01-01"))
    assert len(before) >= 4
    _replace(frame([("b", at(1), ["new"]), ("e", at(1), [])], given), child, True, at(9))
    after = set(files_of(table, spark, "2026-01-01"))
    assert len(before - after) == 1
    assert values(table.read(spark), "pid", "code") == [(p, c) for p, c in [("a", "a"), ("a", "x"), ("b", "new"), ("c", "c"), ("c", "x"), ("d", "d"), ("d", "x")]]


MART = "id int, t timestamp_ntz, v string, updated_at timestamp_ntz"


def advance(frame, path, rows):
    return run_mart(frame(rows, MART), path, "t", ["id"], ["id"])


def test_compaction_keeps_what_readers_see(spark, frame, at, tmp_path):
    path = str(tmp_path / "mart")
    feb = datetime(2026, 2, 3)
    advance(frame, path, [(i, at(1), "a", at(1)) for i in range(10)] + [(i, feb, "a", at(1)) for i in range(20, 30)] + [(50, None, "a", at(1))])
    advance(frame, path, [(i, at(1), "b", at(2)) for i in range(5)] + [(20, feb, "b", at(2)), (50, None, "b", at(2))])
    schema = mart_stage(frame([], MART), "t").schema
    keys = [MONTH, "id"]
    before = values(read_mart(spark, path, schema, keys))
    stored = spark.read.schema(schema).parquet(path)
    assert stored.count() == 28
    untouched = {p.name for p in (tmp_path / "mart" / "event_month=2026-02-01").iterdir()}
    assert compact_mart(spark, path, schema, keys) == ["", "2026-01-01"]
    stored = spark.read.schema(schema).parquet(path)
    assert stored.filter("event_month = '2026-01-01'").count() == 10
    assert stored.filter("event_month IS NULL").count() == 1
    assert {p.name for p in (tmp_path / "mart" / "event_month=2026-02-01").iterdir()} == untouched
    assert values(read_mart(spark, path, schema, keys)) == before
    # Only months that may have superseded rows are counted again.
    table = Table(path, schema)
    assert table.stored_mark(spark, "waiting-months") == ["2026-02-01"]
    assert compact_mart(spark, path, schema, keys) == []
    advance(frame, path, [(21, feb, "c", at(3)), (1, datetime(2026, 3, 1), "c", at(3))])
    assert table.stored_mark(spark, "waiting-months") == ["2026-02-01", "2026-03-01"]
    assert compact_mart(spark, path, schema, keys, share=0.1) == ["2026-02-01"]
    assert table.stored_mark(spark, "waiting-months") == []
    assert spark.read.schema(schema).parquet(path).count() == 22
    with pytest.raises(MergeKeysError):
        compact_mart(spark, path, schema, ["id"])


@pytest.mark.parametrize("marked", [False, True])
def test_a_stopped_compaction_is_harmless(spark, frame, at, tmp_path, monkeypatch, marked):
    path = str(tmp_path / "mart")
    for v, day in (("a", 1), ("b", 2)):
        advance(frame, path, [(i, at(1), v, at(day)) for i in range(10)])
    schema = mart_stage(frame([], MART), "t").schema
    before = values(read_mart(spark, path, schema, [MONTH, "id"]))
    with monkeypatch.context() as broken:
        if marked:
            broken.setattr(Swaps, "finish", lambda *_: None)
        else:
            broken.setattr(Swaps, "put_partitions", lambda *_: 1 / 0)
        try:
            compact_mart(spark, path, schema, [MONTH, "id"])
        except ZeroDivisionError:
            pass
    assert [n for n in Swaps(spark, path)._files.names() if n.startswith("_swap")]
    assert values(read_mart(spark, path, schema, [MONTH, "id"])) == before
    stored = spark.read.schema(schema).parquet(path).count()
    assert stored == (10 if marked else 20)
    advance(frame, path, [(3, at(1), "c", at(3))])
    assert compact_mart(spark, path, schema, [MONTH, "id"], share=0.05) == ["2026-01-01"]
    assert spark.read.schema(schema).parquet(path).count() == 10
    assert not [n for n in Swaps(spark, path)._files.names() if n.startswith("_swap")]


def test_the_mart_reads_the_partitions_that_changed(spark, months, tmp_path, monkeypatch):
    path = str(tmp_path / "mart")
    assert run_mart(months, path, "at", ["id"], ["id"]) == 120
    merge_into(months, batch(spark, 3, 100), datetime(2026, 1, 2))
    asked = []
    read_parts = Table.read_parts
    monkeypatch.setattr(Table, "read_parts", lambda self, spark, parts: asked.append(list(parts)) or read_parts(self, spark, parts))
    assert run_mart(months, path, "at", ["id"], ["id"]) == 2
    assert asked == [["2020-02-01", "2022-10-01"]]


def declared(path, ddl):
    return Table(str(path / "t"), T.StructType.fromDDL(f"id int, at timestamp_ntz, {ddl}"), keys=("id", "at"), date="at")


@pytest.mark.parametrize(
    "old, new, value",
    [
        ("v int", "v bigint", 7), ("v int", "v double", 7), ("v smallint", "v int", 7), ("v float", "v double", 0.5),
        ("v decimal(5,2)", "v decimal(9,2)", 1), ("v array<int>", "v array<int>", "array(1)"),
    ],
)
def test_files_of_both_declarations_are_read(spark, frame, at, tmp_path, old, new, value):
    older, newer = declared(tmp_path, old), declared(tmp_path, new)
    given = frame([(1, at(1))], "id int, at timestamp_ntz").selectExpr("*", f"cast({value} AS {new[2:]}) AS v")
    merge_into(older, given.withColumn("v", F.col("v").cast(older.schema["v"].dataType)), at(2), small=True)
    merge_into(newer, given.withColumn("id", F.lit(2)), at(3), small=True)
    assert len(files_of(newer, spark, "2026-01-01")) == 2
    assert [r.id for r in newer.read(spark).filter(F.col("v") == F.lit(given.first().v)).orderBy("id").collect()] == [1, 2]


@pytest.mark.parametrize("new", ["v int", "v string", "v double", "w int NOT NULL"])
def test_a_change_that_loses_values_is_refused_before_any_task(spark, frame, at, tmp_path, new, monkeypatch):
    declared(tmp_path, "v bigint").replace(frame([(1, at(1), 5)], "id int, at timestamp_ntz, v bigint"))
    changed = declared(tmp_path, new)
    with pytest.raises(SchemaChangeError, match="cannot"):
        changed.read(spark)
    with pytest.raises(SchemaChangeError, match="cannot"):
        merge_into(changed, frame([(1, at(1), None)], f"id int, at timestamp_ntz, {new.removesuffix(' NOT NULL')}"), at(2))


def test_a_declaration_no_file_has_any_more_is_no_hindrance(spark, frame, at, tmp_path):
    wide, narrow = declared(tmp_path, "v bigint"), declared(tmp_path, "v int")
    feb = datetime(2026, 2, 1)
    wide.replace(frame([(1, at(1), 5), (2, feb, 6)], "id int, at timestamp_ntz, v bigint"))
    narrow.replace(frame([(1, at(1), 5)], "id int, at timestamp_ntz, v int"))
    with pytest.raises(SchemaChangeError):
        narrow.read(spark)
    narrow.replace(frame([(2, feb, 6)], "id int, at timestamp_ntz, v int"))
    assert values(narrow.read(spark), "id", "v") == [(1, 5), (2, 6)]


def scanned(df):
    """Rows that the scan hands on: those of the row groups that were read."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().get("numOutputRows").get().value() for i in range(leaves.size()))


@pytest.mark.parametrize("clustered", [True, False])
def test_bloom_filters_leave_few_row_groups(spark, tmp_path, clustered):
    schema = T.StructType.fromDDL("id string, at timestamp_ntz, v bigint")
    table = Table(str(tmp_path / "t"), schema, keys=("id", "at"), date="at", cluster=("id",) if clustered else ())
    rows = spark.range(8000).selectExpr("md5(cast(id AS string)) AS id", "timestamp_ntz'2026-01-05' AS at", "id AS v")
    for n in range(8):
        merge_into(table, rows.filter(F.col("v") % 8 == n), datetime(2026, 1, 1), small=True)
    assert len(files_of(table, spark, "2026-01-01")) == 8
    few = rows.filter("v IN (16, 24, 11)")
    ids = [r.id for r in few.collect()]
    found = table.read(spark).filter(one_of("id", ids))
    assert scanned(found) == (2000 if clustered else 8000) and found.count() == 3
    assert len(table.files_holding(few, {"id": "id", "at": "at"}, ["2026-01-01"])) == 2
    many = rows.filter("v % 8 < 2").limit(700)
    assert len(table.files_holding(many, {"id": "id", "at": "at"}, ["2026-01-01"])) <= 2
    merge_into(table, few.withColumn("v", F.lit(-1).cast("bigint")), datetime(2026, 1, 2), small=True)
    assert table.read(spark).filter("v = -1").count() == 3 and table.read(spark).count() == 8000


def test_rows_are_sorted_within_files(spark, tmp_path):
    schema = T.StructType.fromDDL("id string, at timestamp_ntz")
    table = Table(str(tmp_path / "t"), schema, date="at", cluster=("id",))
    table.replace(spark.range(3000).selectExpr("md5(cast(id AS string)) AS id", "timestamp_ntz'2026-01-05' + make_interval(0, int(id % 2)) AS at"))
    for part in ("2026-01-01", "2026-02-01"):
        for name in files_of(table, spark, part):
            ids = [r.id for r in spark.read.parquet(f"{table.path}/part_date={part}/{name}").collect()]
            assert ids == sorted(ids) and len(ids) == 1500


def test_null_clustering_keys_are_found_when_nulls_are_equal(spark, frame, at, tmp_path):
    ddl = "k string, at timestamp_ntz, v int"
    table = Table(str(tmp_path / "t"), T.StructType.fromDDL(ddl), keys=("k", "at"), date="at", null_safe=True, cluster=("k",))
    merge_into(table, frame([(None, at(1), 1), ("a", at(1), 2)], ddl), at(2), small=True)
    merge_into(table, frame([("b", at(1), 3)], ddl), at(2), small=True)
    merge_into(table, frame([(None, at(1), 9), ("b", at(1), 8)], ddl), at(3), small=True)
    assert values(table.read(spark), "k", "v") == [("a", 2), ("b", 8), (None, 9)]


@pytest.mark.parametrize("name", ["e3_stored_declaration", "m1_one_file"])
def test_loads_that_fit_no_broadcast_are_merged_by_file(spark, name, monkeypatch):
    hinted = []
    broadcast = F.broadcast
    monkeypatch.setattr(writers, "fits_broadcast", lambda batch: False)
    monkeypatch.setattr(F, "broadcast", lambda df: hinted.append(df) or broadcast(df))
    assert mismatch(spark, connect(SF_DIR), name, SF_DIR) is None
    assert not hinted


def test_a_large_batch_rewrites_the_files_that_hold_its_keys(spark, months):
    merge_into(months, batch(spark, 0, 3).withColumn("id", F.col("id") + 500), datetime(2026, 1, 2), small=False, by_file=True)
    before = {p: set(files_of(months, spark, p)) for p in ("2020-01-01", "2020-02-01")}
    assert [len(names) for names in before.values()] == [2, 2]
    merge_into(months, batch(spark, 3), datetime(2026, 1, 3), small=False, by_file=True)
    assert set(files_of(months, spark, "2020-01-01")) == before["2020-01-01"]
    assert len(before["2020-02-01"] & set(files_of(months, spark, "2020-02-01"))) == 1
    assert values(months.read(spark).filter("v = 'new'"), "id") == [(3,), (500,), (503,)]
    assert months.read(spark).count() == 122


def test_shuffles_of_the_curated_job_follow_the_rows(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(sizes, "PARTITION_ROWS", 500, raising=False)
    staged = curated.staged

    def seen(df, label, **options):
        asked.append((label, int(spark.conf.get("spark.sql.shuffle.partitions"))))
        return staged(df, label, **options)

    monkeypatch.setattr(curated, "staged", seen)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    assert mismatch(spark, connect(SF_DIR), "g1_curated", SF_DIR) is None
    lines = spark.read.parquet(f"{SF_DIR}/lineitem.parquet").count()
    assert dict(asked)["curated"] == -(-lines // 500) > int(before)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


@pytest.mark.parametrize("small", [True, False])
def test_what_meets_no_rows_is_joined_with_none(spark, months, monkeypatch, small):
    def refuse(*_, **__):
        raise AssertionError("there is nothing to join")

    rows = batch(spark, 0, 3).withColumn("at", F.lit("1999-01-05").cast("timestamp_ntz"))
    expected = upsert(months.read(spark).limit(0), rows, months.keys, run_ts=datetime(2026, 1, 2))
    child = ChildTable(
        Table(months.path + "-children", T.StructType.fromDDL("pid bigint, at timestamp_ntz, code string"), date="at"),
        {"pid": "id", "at": "at"}, "codes", "code",
    )
    with monkeypatch.context() as patched:
        patched.setattr(writers, "upsert", refuse)
        patched.setattr(clean, "replace_children", refuse)
        merge_into(months, rows, datetime(2026, 1, 2), small=small)
        arrays = rows.selectExpr("id", "at", "if(id = 0, array('a', null), array()) AS codes")
        _replace(arrays, child, small, datetime(2026, 1, 2))
    assert values(months.read(spark).filter("v = 'new'")) == values(expected)
    assert months.read(spark).count() == 122
    assert [r.code for r in child.table.read(spark).orderBy("code").collect()] == [None, "a"]
    assert all(".zstd." in name for name in files_of(months, spark, "1999-01-01"))
