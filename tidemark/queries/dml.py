"""Keyed upsert, child replacement and keep-latest.

The target of an upsert is the orders table as of its last load; the batch delivers
the last two years of it again, corrected, together with everything newer.
"""

from pyspark.sql import functions as F

from tidemark.operators import (
    delete_children,
    fits_broadcast,
    keep_latest,
    replace_children,
    upsert,
)
from tidemark.queries.registry import LOADED_UNTIL, REDELIVERED_FROM, RUN_TS, load, query
from tidemark.sinks import merge_into
from tidemark.sources import Table
from tidemark.staging import work_dir


def _loaded(orders):
    return orders.filter(F.col("o_orderdate") < F.lit(LOADED_UNTIL).cast("timestamp_ntz"))


def _redelivered(orders):
    return orders.filter(F.col("o_orderdate") >= F.lit(REDELIVERED_FROM).cast("timestamp_ntz"))


_MERGED = f"""
    WITH t AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '{LOADED_UNTIL}'),
         s AS (SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice + 1 AS o_totalprice,
                      nullif(o_orderstatus, 'P') AS o_orderstatus
               FROM orders WHERE o_orderdate >= TIMESTAMP '{REDELIVERED_FROM}')
    SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey,
           coalesce(t.o_orderdate, s.o_orderdate) AS o_orderdate,
           CASE WHEN s.o_orderkey IS NULL THEN t.o_custkey ELSE s.o_custkey END AS o_custkey,
           CASE WHEN s.o_orderkey IS NULL THEN t.o_totalprice ELSE s.o_totalprice END AS o_totalprice,
           CASE WHEN s.o_orderkey IS NULL THEN t.o_orderstatus ELSE s.o_orderstatus END
               AS o_orderstatus,
           CASE WHEN t.o_orderkey IS NULL THEN TIMESTAMP '2026-01-01 00:00:00'
                ELSE t.o_orderdate END AS created_at,
           CASE WHEN s.o_orderkey IS NULL THEN t.o_orderdate
                ELSE TIMESTAMP '2026-01-01 00:00:00' END AS updated_at,
           CASE WHEN t.o_orderkey IS NULL THEN 'inserted' WHEN s.o_orderkey IS NULL THEN 'kept'
                ELSE 'updated' END AS action
    FROM t FULL JOIN s ON t.o_orderkey = s.o_orderkey AND t.o_orderdate = s.o_orderdate
"""


def _merge(spark, sf_dir, measure):
    orders = load(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderdate", "o_custkey", "o_totalprice", "o_orderstatus"
    )
    target = _loaded(orders).withColumns(
        {"created_at": F.col("o_orderdate"), "updated_at": F.col("o_orderdate")}
    )
    source = _redelivered(orders).withColumns(
        {
            "o_totalprice": F.col("o_totalprice") + 1,
            "o_orderstatus": F.nullif(F.col("o_orderstatus"), F.lit("P")),
        }
    )
    return upsert(
        target,
        source,
        ["o_orderkey", "o_orderdate"],
        run_ts=RUN_TS,
        small_source=measure and fits_broadcast(source),
        action="action",
    )


@query("m1_upsert", _MERGED)
def m1_upsert(spark, sf_dir):
    return _merge(spark, sf_dir, measure=False)


@query("m1_upsert_measured", _MERGED)
def m1_upsert_measured(spark, sf_dir):
    """The same merge, broadcasting the batch when its measured size allows it."""
    return _merge(spark, sf_dir, measure=True)


_CHILDREN = """
    SELECT l_orderkey AS parent_id, o_orderdate AS parent_date, l_returnflag AS code,
           o_orderdate AS created_at, o_orderdate AS updated_at
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""


def _children(spark, sf_dir):
    dates = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    lines = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag")
    return lines.join(dates, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").alias("parent_id"),
        F.col("o_orderdate").alias("parent_date"),
        F.col("l_returnflag").alias("code"),
        F.col("o_orderdate").alias("created_at"),
        F.col("o_orderdate").alias("updated_at"),
    )


_KEYS = {"parent_id": "o_orderkey", "parent_date": "o_orderdate"}


@query(
    "m2_child_replace",
    f"""
    SELECT * FROM ({_CHILDREN}) WHERE parent_date < TIMESTAMP '{REDELIVERED_FROM}'
    UNION ALL
    SELECT o_orderkey, o_orderdate, unnest(string_split(o_orderpriority, '-')),
           TIMESTAMP '2026-01-01 00:00:00', TIMESTAMP '2026-01-01 00:00:00'
    FROM orders
    WHERE o_orderdate >= TIMESTAMP '{REDELIVERED_FROM}' AND o_orderstatus = 'O'
    """,
)
def m2_child_replace(spark, sf_dir):
    codes = (
        F.when(F.col("o_orderstatus") == "O", F.split("o_orderpriority", "-"))
        .when(F.col("o_orderstatus") == "P", F.array().cast("array<string>"))
        .alias("codes")
    )
    batch = _redelivered(load(spark, sf_dir, "orders")).select("o_orderkey", "o_orderdate", codes)
    return replace_children(
        _children(spark, sf_dir),
        batch,
        _KEYS,
        array="codes",
        code="code",
        date="parent_date",
        run_ts=RUN_TS,
    )


@query(
    "m2a_child_delete",
    f"""
    SELECT * FROM ({_CHILDREN})
    WHERE parent_id NOT IN (SELECT o_orderkey FROM orders
                            WHERE o_orderdate >= TIMESTAMP '{REDELIVERED_FROM}'
                              AND o_orderstatus = 'O')
    """,
)
def m2a_child_delete(spark, sf_dir):
    orders = load(spark, sf_dir, "orders")
    batch = _redelivered(orders).filter(F.col("o_orderstatus") == "O")
    low, high = batch.agg(F.min("o_orderdate"), F.max("o_orderdate")).first()
    return delete_children(
        _children(spark, sf_dir), batch, _KEYS, within=("parent_date", low, high)
    )


@query(
    "w1_keep_latest",
    """
    SELECT event_id, ts, user_id, event_type, value, props
    FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type
                               ORDER BY ts DESC, event_id DESC) = 1
    """,
)
def w1_keep_latest(spark, sf_dir):
    events = load(spark, sf_dir, "events")
    return keep_latest(events, ["user_id", "event_type"], "ts", ["event_id"])


def _days(spark, sf_dir):
    events = load(spark, sf_dir, "events").select("event_id", "ts", "value")
    path = f"{work_dir(spark, 'days')}/events"
    table = Table(path, events.schema, keys=("event_id", "ts"), date="ts", grain="day")
    table.replace(events)
    return events, table


@query(
    "e5_day_partitions",
    """
    SELECT event_id, ts, CASE WHEN ts >= TIMESTAMP '2024-01-20 00:00:00' THEN value + 1
                              ELSE value END AS value
    FROM events
    """,
)
def e5_day_partitions(spark, sf_dir):
    """A table partitioned by day; a batch of corrections rewrites only its own days."""
    events, table = _days(spark, sf_dir)
    late = events.filter(F.col("ts") >= F.lit("2024-01-20").cast("timestamp_ntz"))
    merge_into(table, late.withColumn("value", F.col("value") + 1))
    return table.read(spark)


@query(
    "e5_far_partitions",
    """
    SELECT event_id, ts, CASE WHEN CAST(ts AS DATE) IN ('2024-01-02', '2024-01-28')
                              THEN value + 1 ELSE value END AS value
    FROM events
    """,
)
def e5_far_partitions(spark, sf_dir):
    """A batch that touches two days far apart reads and rewrites those two, also when it
    is too large to broadcast."""
    events, table = _days(spark, sf_dir)
    far = events.filter(F.col("ts").cast("date").cast("string").isin("2024-01-02", "2024-01-28"))
    merge_into(table, far.withColumn("value", F.col("value") + 1), small=False)
    return table.read(spark)
