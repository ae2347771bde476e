"""What the physical plans must look like to hold at scale."""

import contextlib
import io
import re

import pytest
from pyspark.sql import DataFrameWriter
from tidemark.operators import child_lists, delete_children, keep_latest, replace_children, since, upsert
from tidemark.queries import QUERIES, jobs
from tidemark.queries.registry import LOADED_UNTIL, REDELIVERED_FROM
from tidemark.sources import Table

SF_DIR = "/root/testdata/sf0.001"


def plan(df, mode="simple"):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode)
    return text.getvalue()


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


EAGER = {
    "s1_json_scan", "s1_json_broken", "s1_json_multiline", "s1_json_split", "s2_csv_scan", "s6_metrics_history",
    "k1_quarantine", "m3_mart_append", "b1_clean_job", "b2_clean_reload", "k2_clean_counts",
    "k3_stopped_run", "g1_curated", "g2_curated_increment", "f4_empty_increment", "d1_mart",
    "d1_mart_undated", "m4_ref_load", "e5_day_partitions", "e5_far_partitions", "v1_visits",
    "i2_zoned_marks", "i2_changed_partitions", "m1_one_file", "w1_compacted", "i1_mark_of_changed", "e3_stored_declaration",
}
LAZY = sorted(set(QUERIES) - EAGER)


@pytest.mark.parametrize("name", LAZY)
def test_no_query_multiplies_rows_or_leaves_the_jvm(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python"):
        assert bad not in text


def test_keep_latest_limits_each_key_before_the_shuffle(spark):
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    text = plan(keep_latest(events, ["user_id"], "ts", ["event_id"]))
    final, partial = text.index("Final"), text.index("Partial")
    assert final < text.index("Exchange hashpartitioning") < partial


def test_child_codes_are_counted_before_the_shuffle(spark, no_broadcast):
    lines = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    text = plan(child_lists(lines, ["l_orderkey"], "l_returnflag", "flags"))
    assert text.index("Exchange hashpartitioning(l_orderkey") < text.rindex(
        "Exchange hashpartitioning(l_orderkey"
    )
    assert re.search(r"Exchange hashpartitioning\(l_orderkey#\d+L, l_returnflag#\d+", text)
    assert "partial_count" in text[text.rindex("Exchange") :]
    assert "ReadSchema: struct<l_orderkey:bigint,l_returnflag:string>" in text


def test_a_small_batch_is_merged_without_shuffling_the_target(spark, no_broadcast):
    orders = spark.read.parquet(f"{SF_DIR}/orders.parquet")
    batch = orders.filter("o_orderkey < 5")
    merged = plan(upsert(orders, batch, ["o_orderkey"], small_source=True))
    assert "SortMergeJoin" not in merged
    assert {"LeftOuter", "LeftSemi", "LeftAnti"} <= set(re.findall(r"Left\w+", merged))
    children = orders.selectExpr("o_orderkey AS pid", "o_orderstatus AS code")
    arrays = batch.selectExpr("o_orderkey", "array(o_orderstatus) AS codes")
    replaced = plan(
        replace_children(children, arrays, {"pid": "o_orderkey"}, "codes", "code", small_batch=True)
    )
    assert "SortMergeJoin" not in replaced


def test_the_mark_reaches_the_scan(spark):
    orders = spark.read.parquet(f"{SF_DIR}/orders.parquet")
    text = plan(since(orders, "o_orderdate", "2000-01-01").select("o_orderkey"))
    assert "GreaterThanOrEqual(o_orderdate" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in text


@pytest.fixture
def tiny_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_only_touched_partitions_are_read_at_any_batch_size(spark, tmp_path, tiny_broadcast):
    days = spark.range(240).selectExpr(
        "id", "cast(add_months(date'2004-01-15', cast(id as int)) as timestamp_ntz) AS at"
    )
    table = Table(str(tmp_path / "t"), days.schema, date="at")
    table.replace(days)
    touched = table.read_touched(spark, days.filter("id in (3, 200)"))
    assert sorted(r.id for r in touched.collect()) == [3, 200]
    assert re.search(r"PartitionFilters: .*part_date#\d+ IN \(2004-04-01,2020-09-01\)", plan(touched))
    assert "Exchange" not in plan(touched)


def test_a_large_batch_is_merged_with_one_shuffle_of_each_side(spark, no_broadcast):
    orders = spark.read.parquet(f"{SF_DIR}/orders.parquet")
    text = plan(upsert(orders, orders.filter("o_orderkey < 500"), ["o_orderkey", "o_orderdate"]))
    assert text.count("Exchange hashpartitioning") == 2
    assert text.count("FileScan") == 2


def test_children_are_read_once_to_be_deleted(spark, no_broadcast):
    children = spark.read.parquet(f"{SF_DIR}/lineitem.parquet").select("l_orderkey", "l_shipdate")
    batch = spark.read.parquet(f"{SF_DIR}/orders.parquet").select("o_orderkey", "o_orderdate")
    keys = {"l_orderkey": "o_orderkey", "l_shipdate": "o_orderdate"}
    text = plan(delete_children(children, batch, keys, ("l_shipdate", "1995-01-01", "1996-01-01")))
    assert text.count("FileScan") == 2 and text.count("l_orderkey") and "Union" not in text


def test_the_raw_files_of_both_batches_are_made_in_one_pass(spark, monkeypatch):
    written, loaded = [], []
    text = DataFrameWriter.text

    def write(writer, path):
        written.append(plan(writer._df))
        return text(writer, path)

    monkeypatch.setattr(DataFrameWriter, "text", write)
    monkeypatch.setattr(jobs, "_load", lambda spark, job, raw, ds, at: loaded.append(spark.read.text(raw)))
    jobs._two_batches(spark, SF_DIR)
    assert [p.count("/lineitem.parquet") for p in written] == [1]
    orders = spark.read.parquet(f"{SF_DIR}/orders.parquet")
    cuts = (f"o_orderdate < '{LOADED_UNTIL}'", f"o_orderdate >= '{REDELIVERED_FROM}'")
    assert [raw.count() for raw in loaded] == [orders.filter(cut).count() + 1 for cut in cuts]
    assert [raw.filter("value = '{\"id\": MIDDLE EAST'").count() for raw in loaded] == [1, 1]
