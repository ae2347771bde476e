"""The jobs end to end on small visit tables."""

import json
from dataclasses import replace
from datetime import datetime
from pathlib import Path

import pytest
from conftest import values
from pyspark.errors import PySparkException
from pyspark.sql import Row
from pyspark.sql import types as T

from tidemark.errors import NothingToDo, NotNullError, QualityGateError
from tidemark.plans import Visits, load_reference, read_mart, run_curated, run_mart
from tidemark.sinks import QualityRecord
from tidemark.sources import Table, read_metrics, read_quarantine
from tidemark.streaming import clean_arrivals


def visit(n, date, age=30, temperature=36.6, symptoms=(), chronic=()):
    return {
        "id": n,
        "visit_date": date,
        "age": age,
        "temperature": temperature,
        "snils": f"person {n}",
        "disease_code": "I10",
        "height": 175,
        "weight": 75.0,
        "symptoms_code": list(symptoms),
        "chronic_diseases": list(chronic),
    }


FIVE_ROWS = [
    visit(1, "2026-01-15 10:30:00", symptoms=["R05", "R50"], chronic=["E11"]),
    visit(2, "2026-01-15", age=150, symptoms=["R05"]),
    visit(3, "2026-01-15", temperature=45.0, chronic=["E11"]),
    visit(4, "not a date", symptoms=["R51"]),
    visit(5, "16.01.2026 08:00:00", symptoms=["R21"]),
]


def load(spark, root, visits, records, ds, run_ts):
    folder = root / "raw" / ds
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "batch.json").write_text(json.dumps(records, indent=1))
    return visits.load_raw(spark, f"{root}/raw", ds, run_ts, multiline=True)


def test_clean_job_on_five_rows(spark, at, tmp_path):
    visits = Visits(str(tmp_path), limit_percent=50.0)
    record = load(spark, tmp_path, visits, FIVE_ROWS, "2026-01-20", at(20))
    assert (record.total_rows, record.valid_rows, record.invalid_rows, record.error_percent) == (
        5,
        3,
        2,
        40.0,
    )
    stored = read_metrics(spark, visits.clean_job.metrics, "2026-01-20").first()
    assert (stored.error_percent, stored.undated_children, record.undated_children) == (40.0, 1, 1)
    delivered = sum(len(r["symptoms_code"]) + len(r["chronic_diseases"]) for r in FIVE_ROWS if r["id"] in (1, 4, 5))
    placed = sum(c.table.read(spark).count() for c in visits.clean_job.children)
    assert placed + record.undated_children == delivered
    rejected = read_quarantine(spark, visits.clean_job.quarantine)
    assert values(rejected, "id", "errors", "rejected_at") == [
        (2, ["INVALID_AGE"], at(20)),
        (3, ["INVALID_TEMPERATURE"], at(20)),
    ]
    rows = visits.clean.read(spark)
    assert values(rows, "snils", "visit_date", "bmi", "created_at") == [
        ("person 1", datetime(2026, 1, 15, 10, 30), 24.5, at(20)),
        ("person 4", None, 24.5, at(20)),
        ("person 5", datetime(2026, 1, 16, 8), 24.5, at(20)),
    ]
    symptoms, chronic = (c.table.read(spark) for c in visits.clean_job.children)
    assert values(symptoms, "symptoms_code") == [("R05",), ("R21",), ("R50",)]
    assert values(chronic, "chronic_diseases") == [("E11",)]
    ids = {r.snils: r.id for r in rows.collect()}
    assert values(symptoms.filter("symptoms_code = 'R21'"), "visit_id") == [(ids["person 5"],)]


def test_clean_job_over_three_days(spark, at, tmp_path):
    visits = Visits(str(tmp_path), limit_percent=50.0)
    symptoms = visits.symptoms
    dated = [r for r in FIVE_ROWS if r["id"] != 4]
    load(spark, tmp_path, visits, dated, "2026-01-20", at(20))

    # A corrected visit without symptoms empties its day; a new visit fills another.
    corrected = [
        visit(1, "15.01.2026 10:30:00", age=31, symptoms=["R05", "R50"], chronic=["E11"]),
        visit(5, "2026-01-16 08:00:00"),
        visit(6, "2026-01-17", symptoms=["R05"]),
    ]
    load(spark, tmp_path, visits, corrected, "2026-01-21", at(21))
    rows = visits.clean.read(spark)
    assert values(rows, "snils", "age", "created_at", "updated_at") == [
        ("person 1", 31, at(20), at(21)),
        ("person 5", 30, at(20), at(21)),
        ("person 6", 30, at(21), at(21)),
    ]
    assert values(symptoms.read(spark), "symptoms_code", "visit_date") == [
        ("R05", datetime(2026, 1, 15, 10, 30)),
        ("R05", datetime(2026, 1, 17)),
        ("R50", datetime(2026, 1, 15, 10, 30)),
    ]

    # The same batch again changes nothing but stamps.
    tables = (visits.clean, symptoms, visits.chronic)
    before = [values(t.read(spark).drop("created_at", "updated_at")) for t in tables]
    load(spark, tmp_path, visits, corrected, "2026-01-22", at(22))
    assert [values(t.read(spark).drop("created_at", "updated_at")) for t in tables] == before

    # Two rows for one stored visit fail the run and change nothing.
    before = [values(t.read(spark)) for t in tables]
    twice = [visit(1, "2026-01-15 10:30:00"), visit(1, "15.01.2026 10:30:00")]
    with pytest.raises(PySparkException, match="several source rows"):
        load(spark, tmp_path, visits, twice, "2026-01-23", at(23))
    assert [values(t.read(spark)) for t in tables] == before
    assert read_metrics(spark, visits.clean_job.metrics, "2026-01-23").first().total_rows == 2


def test_gate_stops_before_any_table_but_after_quarantine_and_metrics(spark, at, tmp_path):
    visits = Visits(str(tmp_path))
    with pytest.raises(QualityGateError, match="40.00%"):
        load(spark, tmp_path, visits, FIVE_ROWS, "2026-01-20", at(20))
    assert visits.clean.read(spark).count() == 0
    assert read_quarantine(spark, visits.clean_job.quarantine).count() == 2
    assert read_metrics(spark, visits.clean_job.metrics, "2026-01-20").first().invalid_rows == 2


def test_a_stopped_run_leaves_one_copy_in_the_quarantine_and_no_folder(spark, at, tmp_path):
    visits = Visits(str(tmp_path))
    work = Path(spark.conf.get("spark.checkpoint.dir")) / "tidemark"
    before = set(work.iterdir()) if work.exists() else set()
    for _ in range(2):
        with pytest.raises(QualityGateError):
            load(spark, tmp_path, visits, FIVE_ROWS, "2026-01-20", at(20))
    assert read_quarantine(spark, visits.clean_job.quarantine).count() == 2
    assert set(work.iterdir()) == before


def test_the_gate_rounds_a_tie_to_the_nearer(spark):
    record = QualityRecord()
    record.take(Row(total_rows=20_000, valid_rows=18_999, invalid_rows=1_001, corrupt_rows=0))
    assert record.error_percent == 5.0


def test_null_keys_merge_when_the_table_says_so(spark, at, tmp_path):
    visits = Visits(str(tmp_path), limit_percent=50.0)
    undated = [visit(4, "not a date")]
    for job, expected in ((visits.clean_job, 2), (replace(visits.clean_job, clean=replace(visits.clean, path=f"{tmp_path}/safe", null_safe=True)), 1)):
        visits.clean_job = job
        for day in (20, 21):
            load(spark, tmp_path, visits, undated, f"2026-01-{day}", at(day))
        assert job.clean.read(spark).count() == expected


def test_a_carried_mark_passes_over_no_late_commit(spark, at, tmp_path):
    visits = with_directories(spark, tmp_path)
    job = replace(visits.curated_job, carry_mark=True)
    load(spark, tmp_path, visits, [visit(1, "2026-01-15")], "2026-01-20", at(20))
    run_curated(spark, job, at(25))
    # Stamped before the curated run, committed after it.
    load(spark, tmp_path, visits, [visit(2, "2026-01-16")], "2026-01-21", at(22))
    run_curated(spark, job, at(26))
    assert values(visits.curated.read(spark), "snils") == [("person 1",), ("person 2",)]


def test_an_empty_batch_is_no_failure(spark, at, tmp_path):
    visits = Visits(str(tmp_path), limit_percent=50.0)
    record = load(spark, tmp_path, visits, [], "2026-01-20", at(20))
    assert record.total_rows == 0
    assert read_metrics(spark, visits.clean_job.metrics, "2026-01-20").first().error_percent == 0.0


def test_streaming_arrivals_load_each_file_once(spark, tmp_path):
    visits = Visits(str(tmp_path), limit_percent=50.0)
    raw = tmp_path / "arrivals"
    raw.mkdir()
    checkpoint = str(tmp_path / "checkpoint")
    (raw / "a.json").write_text(json.dumps(FIVE_ROWS))
    clean_arrivals(spark, str(raw), checkpoint, visits.clean_job, multiline=True)
    (raw / "b.json").write_text(json.dumps([visit(7, "2026-01-18", symptoms=["R05"])]))
    clean_arrivals(spark, str(raw), checkpoint, visits.clean_job, multiline=True)
    clean_arrivals(spark, str(raw), checkpoint, visits.clean_job, multiline=True)
    assert values(visits.clean.read(spark), "snils") == [
        ("person 1",),
        ("person 4",),
        ("person 5",),
        ("person 7",),
    ]
    assert read_quarantine(spark, visits.clean_job.quarantine).count() == 2


def with_directories(spark, root, **options):
    visits = Visits(str(root), limit_percent=50.0, **options)
    (root / "departments.csv").write_text("id;name\n1;Cardiology\n2;Surgery\n")
    (root / "professions.csv").write_text("id;name\n100;Baker\n")
    visits.load_references(spark, f"{root}/departments.csv", f"{root}/professions.csv")
    return visits


def test_curated_job(spark, at, tmp_path):
    visits = with_directories(spark, tmp_path)
    first = [
        dict(
            visit(1, "2026-01-15", symptoms=["b", "a", "b"], chronic=["z"]),
            department_id=1,
            profession_id=100,
        ),
        dict(visit(2, "2026-01-16"), department_id=9),
    ]
    load(spark, tmp_path, visits, first, "2026-01-20", at(20))
    assert visits.advance_curated(spark, at(20, 1)) == 2
    lists = ("snils", "symptoms_list", "chronic_list", "department_name", "profession_name")
    assert values(visits.curated.read(spark), *lists) == [
        ("person 1", ["a", "b", "b"], ["z"], "Cardiology", "Baker"),
        ("person 2", None, None, None, None),
    ]
    # The mark is when the curated rows were made, so nothing older is read again.
    with pytest.raises(NothingToDo):
        visits.advance_curated(spark, at(20, 2))
    later = [dict(visit(3, "2026-02-01"), department_id=2)]
    load(spark, tmp_path, visits, later, "2026-01-21", at(21))
    assert visits.advance_curated(spark, at(21, 1)) == 1
    assert values(visits.curated.read(spark), "snils", "created_at", "department_name") == [
        ("person 1", at(20, 1), "Cardiology"),
        ("person 2", at(20, 1), None),
        ("person 3", at(21, 1), "Surgery"),
    ]
    assert visits.advance_mart(spark) == 3 and visits.advance_mart(spark) == 0
    assert values(visits.read_mart(spark), "snils") == [("person 1",), ("person 2",), ("person 3",)]


def test_corrected_parents_reach_the_curated_table_by_their_update(spark, at, tmp_path):
    visits = Visits(str(tmp_path))
    load(spark, tmp_path, visits, [visit(1, "2026-01-15")], "2026-01-20", at(20))
    visits.advance_curated(spark, at(20, 1))
    load(spark, tmp_path, visits, [visit(1, "2026-01-15", age=31)], "2026-01-21", at(21))
    with pytest.raises(NothingToDo):
        visits.advance_curated(spark, at(21, 1))
    assert values(visits.curated.read(spark), "age") == [(30,)]
    run_curated(spark, replace(visits.curated_job, mark="updated_at"), at(21, 1))
    assert values(visits.curated.read(spark), "age", "created_at") == [(31, at(20, 1))]


def test_two_increments_equal_one(spark, at, tmp_path):
    records = [
        visit(n, f"2026-0{1 + n % 3}-{1 + n:02d}", age=20 + n, symptoms=["R05"] * (n % 3), chronic=["E11"] * (n % 2))
        for n in range(24)
    ]
    tables = []
    for name, batches in (("one", [records]), ("two", [records[:16], records[16:]])):
        root = tmp_path / name
        root.mkdir()
        visits = Visits(str(root))
        for n, batch in enumerate(batches):
            load(spark, root, visits, batch, f"2026-06-0{n + 1}", at(20 + n))
            visits.advance_curated(spark, at(20 + n, 1))
        tables.append(values(visits.curated.read(spark).drop("created_at", "updated_at")))
    assert len(tables[0]) == 24 and tables[0] == tables[1]


MART = "id int, visit_date timestamp_ntz, v string, updated_at timestamp_ntz"
MART_READ = MART + ", event_month date"


def test_mart_keeps_the_newest_and_takes_only_newer_rows(spark, frame, at, tmp_path):
    path = str(tmp_path / "mart")

    def run(rows):
        return run_mart(
            frame(rows, MART), path, "visit_date", ["id"], ["id", "visit_date", "updated_at"]
        )

    def rows():
        mart = read_mart(spark, path, T.StructType.fromDDL(MART_READ), ["event_month", "id"])
        return values(mart, "id", "v")

    assert run([(1, at(1), "a", at(1)), (2, at(1), "b", at(2))]) == 2
    assert run([(1, at(1), "late", at(2)), (2, at(1), "new", at(3)), (3, at(1), "c", at(4))]) == 2
    assert rows() == [(1, "a"), (2, "new"), (3, "c")]
    assert run([(2, at(1), "new", at(3))]) == 0
    # A null is reported once, by the run that appends it, and keeps no newer row out.
    with pytest.raises(NotNullError, match="id: 1"):
        run([(None, at(1), "x", at(9)), (4, at(1), "d", at(10))])
    assert rows() == [(1, "a"), (2, "new"), (3, "c"), (4, "d"), (None, "x")]
    assert run([(None, at(1), "x", at(9)), (5, at(1), "e", at(11))]) == 1


def test_reference_load_updates_inserts_and_checks(spark, tmp_path):
    table = Table(
        f"{tmp_path}/dim", T.StructType.fromDDL("id int NOT NULL, name string NOT NULL"), ("id",)
    )

    def run(text):
        (tmp_path / "dim.csv").write_text("id;name\n" + text)
        load_reference(spark, str(tmp_path / "dim.csv"), table)

    run("1;one\n2;two\n")
    run("2;zwei\n3;drei\n")
    assert values(table.read(spark)) == [(1, "one"), (2, "zwei"), (3, "drei")]
    with pytest.raises(NotNullError):
        run("x;bad\n")
    assert table.read(spark).count() == 3
