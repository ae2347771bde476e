import json
import os
import shutil

import pytest
from conftest import values
from pyspark.errors import PySparkException
from pyspark.sql import types as T

from tidemark.errors import MergeKeysError, MetricsMissingError, QuarantineError, TidemarkError
from tidemark.operators import typed_projection
from tidemark.queries import scans
from tidemark.sinks import (
    append_mart,
    merge_into,
    metrics_scope,
    write_metrics,
    write_quarantine,
)
from tidemark.sources import (
    Table,
    read_delimited,
    read_metrics,
    read_metrics_history,
    read_quarantine,
    read_raw_json,
    read_table,
)
from tidemark.files import Files
from tidemark.sources.swaps import Swaps
from tidemark.staging import scratch, staged, work_dir

DDL = "id bigint, n int, w float, codes array<string>, _corrupt_record string"


def read(spark, folder, multiline=True):
    schema = T.StructType.fromDDL(DDL)
    return typed_projection(read_raw_json(spark, f"{folder}/*", schema, multiline), schema)


def test_multi_line_arrays_with_one_bad_field(spark, tmp_path):
    (tmp_path / "a.json").write_text(
        json.dumps(
            [
                {"id": 1, "n": 3.7, "w": 1.5, "codes": ["x", "y"]},
                {"id": 2, "n": "oops", "codes": "not an array"},
                {"id": 3, "codes": [], "unknown": 1},
            ],
            indent=2,
        )
    )
    assert values(read(spark, tmp_path)) == [
        (1, 3, 1.5, ["x", "y"], None),
        (2, None, None, None, None),
        (3, None, None, [], None),
    ]


def test_a_broken_document_is_kept_as_text(spark, tmp_path):
    (tmp_path / "good.json").write_text('[{"id": 1}]')
    (tmp_path / "bad.json").write_text('[{"id": 2')
    rows = {r.id: r._corrupt_record for r in read(spark, tmp_path).collect()}
    assert rows[1] is None and rows[None].startswith('[{"id": 2')


def test_line_delimited(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id": 1, "codes": ["a"]}\n{oops\n{"id": 2}\n')
    rows = values(read(spark, tmp_path, multiline=False), "id", "_corrupt_record")
    assert rows == [(1, None), (2, None), (None, "{oops")]


def test_delimited(spark, tmp_path):
    schema = T.StructType.fromDDL("id int, name string")
    (tmp_path / "a.csv").write_text("id;name\n1;one\nx;two\n;three\n")
    assert values(read_delimited(spark, str(tmp_path / "a.csv"), schema)) == [
        (1, "one"),
        (None, "three"),
        (None, "two"),
    ]
    (tmp_path / "b.csv").write_text("1,one\n")
    plain = read_delimited(spark, str(tmp_path / "b.csv"), schema, header=False, sep=",")
    assert values(plain) == [(1, "one")]
    (tmp_path / "c.csv").write_text("name;id\none;1\n")
    with pytest.raises(Exception, match="does not conform"):
        read_delimited(spark, str(tmp_path / "c.csv"), schema).collect()


def test_read_table_by_name_and_folder(spark, frame, tmp_path):
    frame([(1, "a")], "x int, y string").write.parquet(str(tmp_path / "t"))
    assert read_table(spark, str(tmp_path / "t"), ["y"]).collect() == [("a",)]
    frame([(2,)], "x int").createOrReplaceTempView("by_name")
    assert read_table(spark, "by_name").collect() == [(2,)]


def test_quarantine_batches_may_widen(frame, spark, tmp_path):
    path = str(tmp_path / "q")
    write_quarantine(frame([(1,)], "x int"), path, "2026-01-01")
    write_quarantine(frame([(2, "why")], "x int, y string"), path, "2026-01-02")
    assert values(read_quarantine(spark, path), "x", "y") == [(1, None), (2, "why")]


def test_quarantine_of_a_run_date_is_replaced(frame, spark, tmp_path):
    path = str(tmp_path / "q")
    for rows in ([(1,), (2,)], [(3,)]):
        write_quarantine(frame(rows, "x int"), path, "2026-01-01")
    write_quarantine(frame([(4,)], "x int"), path, "epoch-0000000001")
    assert values(read_quarantine(spark, path), "x", "ds") == [
        (3, "2026-01-01"),
        (4, "epoch-0000000001"),
    ]
    write_quarantine(frame([], "x int"), path, "2026-01-01")
    assert values(read_quarantine(spark, path), "x") == [(4,)]


def test_quarantine_failure_has_its_own_error(frame, tmp_path):
    (tmp_path / "file").write_text("in the way")
    with pytest.raises(QuarantineError):
        write_quarantine(frame([(1,)], "x int"), str(tmp_path / "file" / "q"), "2026-01-01")


METRICS = "total_rows bigint, valid_rows bigint, invalid_rows bigint, error_percent double"


def test_metrics_replace_their_run_date_only(spark, frame, tmp_path):
    path = str(tmp_path / "m")
    write_metrics(frame([(1, 1, 0, 0.0)], METRICS), path, "2026-01-01")
    write_metrics(frame([(2, 1, 1, 50.0)], METRICS), path, "2026-01-02")
    write_metrics(frame([(3, 3, 0, 0.0)], METRICS), path, "2026-01-01")
    assert values(read_metrics_history(spark, path), "ds", "total_rows") == [
        ("2026-01-01", 3),
        ("2026-01-02", 2),
    ]
    assert read_metrics(spark, path, "2026-01-02").first().error_percent == 50.0
    with pytest.raises(MetricsMissingError):
        read_metrics(spark, path, "2026-01-03")


def test_metrics_are_stored_when_the_run_fails(spark, tmp_path):
    path = str(tmp_path / "m")
    with pytest.raises(ZeroDivisionError):
        with metrics_scope(spark, path, "2026-01-01") as record:
            record.total_rows = 7
            raise ZeroDivisionError
    assert read_metrics(spark, path, "2026-01-01").first().total_rows == 7


def test_metrics_failure_does_not_hide_the_outcome(spark, tmp_path):
    (tmp_path / "file").write_text("in the way")
    with metrics_scope(spark, str(tmp_path / "file" / "m"), "2026-01-01") as record:
        record.total_rows = 1


def table(tmp_path, grain="day"):
    schema = T.StructType.fromDDL("k int NOT NULL, t timestamp_ntz, v string")
    return Table(str(tmp_path / "t"), schema, keys=("k",), date="t", grain=grain)


@pytest.mark.parametrize("grain", ["day", "month"])
def test_only_touched_partitions_change(spark, frame, at, tmp_path, grain):
    target = table(tmp_path, grain)
    ddl = "k int, t timestamp_ntz, v string"
    assert target.read(spark).collect() == []
    rows = frame([(1, at(1), "a"), (2, at(2), "b"), (3, None, "c")], ddl)
    target.replace(rows)
    assert target.read(spark).columns == ["k", "t", "v"]
    batch = frame([(9, at(1, 5), "new")], ddl)
    touched = target.read_touched(spark, batch)
    expected = {"day": [(1,)], "month": [(1,), (2,)]}[grain]
    assert values(touched, "k") == expected
    target.replace(touched.unionByName(batch))
    assert values(target.read(spark), "k") == [(1,), (2,), (3,), (9,)]
    undated = frame([(8, None, "x")], ddl)
    assert values(target.read_touched(spark, undated), "k") == [(3,)]
    assert target.read_touched(spark, batch.limit(0)).collect() == []


def test_a_failed_writer_leaves_the_table_as_it_was(spark, frame, at, tmp_path):
    target = table(tmp_path)
    rows = frame([(1, at(1), "a"), (2, at(2), "b")], "k int, t timestamp_ntz, v string")
    target.replace(rows)
    broken = target.read(spark).selectExpr("k", "t", "if(k = 2, raise_error('no'), v) AS v")
    with pytest.raises(PySparkException):
        target.replace(broken)
    assert values(target.read(spark)) == values(rows)


def test_partitions_without_rows_are_removed(spark, frame, at, tmp_path):
    target = table(tmp_path)
    rows = frame([(1, at(1), "a"), (2, at(2), "b")], "k int, t timestamp_ntz, v string")
    target.replace(rows)
    target.replace(rows.filter("k > 2"), target.touched(rows.filter("k = 1")))
    assert values(target.read(spark), "k") == [(2,)]
    parts = [p.name for p in (tmp_path / "t").iterdir() if p.name.startswith("part_date")]
    assert parts == ["part_date=2026-01-02"]


@pytest.mark.parametrize("after", ["marker", "delete", "move"])
def test_a_swap_that_broke_off_is_finished_by_the_next_reader(
    spark, frame, at, tmp_path, monkeypatch, after
):
    target = table(tmp_path)
    ddl = "k int, t timestamp_ntz, v string"
    target.replace(frame([(1, at(1), "a"), (2, at(2), "b"), (3, at(3), "c")], ddl))
    merged = frame([(1, at(1), "A"), (9, at(1), "new"), (2, at(2), "B")], ddl)
    with monkeypatch.context() as broken:
        broken.setattr(Swaps, "finish", lambda *_: None)
        target.replace(merged, ["2026-01-03"])
    folder = tmp_path / "t"
    swap = next(p for p in folder.iterdir() if p.name.startswith("_swap"))
    if after != "marker":
        shutil.rmtree(folder / "part_date=2026-01-01")
    if after == "move":
        (swap / "part_date=2026-01-01").rename(folder / "part_date=2026-01-01")
    assert values(target.read(spark), "k", "v") == [(1, "A"), (2, "B"), (9, "new")]
    assert not [p for p in folder.iterdir() if p.name.startswith("_swap")]


def test_a_mark_is_kept_beside_the_table(spark, tmp_path):
    target = table(tmp_path)
    assert target.stored_mark(spark, "m") is None
    for mark in ("2026-01-01 00:00:00", 5):
        target.store_mark(spark, "m", mark)
        assert target.stored_mark(spark, "m") == mark
    assert target.read(spark).collect() == []


def test_merge_keys_must_hold_the_date(frame, at, tmp_path):
    rows = frame([(1, at(1), "a")], "k int, t timestamp_ntz, v string")
    with pytest.raises(MergeKeysError, match="not a merge key"):
        merge_into(table(tmp_path), rows)


def test_table_reads_files_of_older_declarations(spark, frame, at, tmp_path):
    older = Table(str(tmp_path / "t"), T.StructType.fromDDL("k int, gone int, t timestamp_ntz"), date="t")
    older.replace(frame([(1, 5, at(1))], "k int, gone int, t timestamp_ntz"))
    newer = Table(older.path, T.StructType.fromDDL("k bigint, t timestamp_ntz, added string"), date="t")
    assert newer.read(spark).dtypes == [("k", "bigint"), ("t", "timestamp_ntz"), ("added", "string")]
    assert values(newer.read(spark)) == [(1, at(1), None)]


def test_mart_appends_by_month(spark, frame, tmp_path):
    path = str(tmp_path / "mart")
    ddl = "id int, event_month date"
    for rows in ([(2, "2026-01-01"), (1, "2026-02-01")], [(3, "2026-01-01")]):
        df = frame(rows, "id int, m string").selectExpr("id", "cast(m AS date) AS event_month")
        append_mart(df, path, "event_month", ["id"])
    assert values(spark.read.schema(ddl).parquet(path), "id") == [(1,), (2,), (3,)]


def test_work_folders_lie_in_the_shared_folder(spark, frame):
    root = spark.conf.get("spark.checkpoint.dir")
    a, b = work_dir(spark, "x"), work_dir(spark, "x")
    assert a != b and a.startswith(root)
    df = frame([(1, None)], "x int, y string")
    assert staged(df, "s").collect() == df.collect()


def test_the_folder_of_a_run_goes_with_it(spark, frame):
    with pytest.raises(ZeroDivisionError):
        with scratch(spark, "run") as folder:
            assert staged(frame([(1,)], "x int"), "part", folder=folder).count() == 1
            assert Files(spark, folder).names() == ["part"]
            raise ZeroDivisionError
    assert not Files(spark, folder).exists()


def test_copies_go_with_the_scope_that_they_are_made_in(spark, frame):
    with scratch(spark, "outer") as outer:
        with scratch(spark, "inner") as inner:
            staged(frame([(1,)], "x int"), "part")
            kept = staged(frame([(2,)], "x int"), "result", keep=True)
            assert len(Files(spark, inner).names()) == 1
        assert not Files(spark, inner).exists() and kept.count() == 1
        last = staged(frame([(3,)], "x int"), "result", keep=True)
        assert len(Files(spark, outer).names()) == 1
    assert not Files(spark, outer).exists() and last.count() == 1


def test_work_folders_need_a_shared_folder(monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "local[1]"}.get(key, default)

    class Session:
        conf = Conf()

    monkeypatch.setattr("tidemark.staging._fallback", [])
    with pytest.raises(TidemarkError, match="spark.checkpoint.dir"):
        work_dir(Session(), "x")


def test_documents_are_read_as_the_multi_line_mode_reads_them(spark, tmp_path):
    texts = [
        '[{"id": 1.10, "tags": ["a",  {"b" : 1e2}]},\n {"id": 12345678901234567890.10, "x": 1}]\n', '[{"id": 1},\n {"id": 2',
        '{"id": null,\r\n "tags": []}', "", " \n ", "[]", "[1, 2]", "no json\n", '{"id": 1}\n{"id": 2}', '[{"id": "a\nb"}]', "\ufeff[{\"id\": 3}]",
        '[{"id": "é"}, 5, {"id": true}]',
    ]
    for n, text in enumerate(texts):
        (tmp_path / f"{n}.json").write_bytes(text.encode())
    schema = T.StructType.fromDDL("id string, tags string, _corrupt_record string")
    options = {"multiLine": True, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    expected = spark.read.schema(schema).options(**options).json(str(tmp_path))
    assert values(read_raw_json(spark, str(tmp_path), schema)) == values(expected)


def test_documents_of_a_query_lie_side_by_side(spark):
    folder = scans.prepare_documents(spark, "/root/testdata/sf0.001")
    inside = [n for n in os.listdir(folder.removeprefix("file:")) if n[0] not in "._"]
    assert len(inside) > 1 and all(n.endswith(".txt") for n in inside)
