"""What a change costs: increments, merges and compaction that touch only what changed."""

from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import SchemaChangeError
from tidemark.plans import compact_mart, mart_stage, run_mart
from tidemark.plans.mart import MONTH
from tidemark.queries.registry import LOADED_UNTIL, load, query
from tidemark.sinks import merge_into
from tidemark.sources import Table
from tidemark.staging import work_dir

_ORDERS = (
    "id bigint, order_date timestamp_ntz, price double, "
    "created_at timestamp_ntz, updated_at timestamp_ntz"
)

# The two months that are delivered again.
_AGAIN = "date_trunc('month', o_orderdate) IN (DATE '1996-02-01', DATE '1997-11-01')"


def _orders_table(root: str) -> Table:
    return Table(f"{root}/orders", T.StructType.fromDDL(_ORDERS), keys=("id", "order_date"), date="order_date")


def _orders(spark, sf_dir):
    return load(spark, sf_dir, "orders").selectExpr("o_orderkey AS id", "o_orderdate AS order_date", "o_totalprice AS price")


@query(
    "i2_changed_partitions",
    f"""
    SELECT o_orderkey AS id, o_orderdate AS order_date,
           o_totalprice + CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS price,
           TIMESTAMP '2026-01-02 00:00:00' AS created_at,
           CASE WHEN o_orderkey % 3 = 0 THEN TIMESTAMP '2026-01-03 00:00:00'
                ELSE TIMESTAMP '2026-01-02 00:00:00' END AS updated_at
    FROM orders WHERE {_AGAIN}
    """,
)
def i2_changed_partitions(spark, sf_dir):
    """What an increment reads after two months were delivered again: those, before it is cut
    by the mark."""
    table = _orders_table(work_dir(spark, "changed"))
    orders = _orders(spark, sf_dir)
    merge_into(table, orders, datetime(2026, 1, 2))
    again = orders.filter(_AGAIN.replace("o_orderdate", "order_date")).filter("id % 3 = 0")
    merge_into(table, again.withColumn("price", F.col("price") + 1), datetime(2026, 1, 3))
    return table.read_since(spark, "updated_at", datetime(2026, 1, 3))


@query(
    "m1_one_file",
    f"""
    SELECT o_orderkey AS id, o_orderdate AS order_date,
           o_totalprice + CASE WHEN o_orderkey % 8 = 5 AND {_AGAIN} THEN 1 ELSE 0 END AS price,
           o_orderkey % 4 = 1 AND {_AGAIN} AS moved
    FROM orders
    """,
)
def m1_one_file(spark, sf_dir):
    """Four loads leave their rows in files of their own in every month; a merge into one
    load's rows in two months rewrites its files there, and no others."""
    table = _orders_table(work_dir(spark, "one-file"))
    orders = _orders(spark, sf_dir)
    for load_number in range(4):
        merge_into(table, orders.filter(F.col("id") % 4 == load_number), datetime(2026, 1, 1 + load_number), by_file=True)

    def places():
        rows = spark.read.schema(table.file_schema()).parquet(table.path)
        return rows.select("id", F.col("_metadata.file_name").alias("file"))

    before = places().groupBy("file").agg(F.min("id").alias("any_id")).collect()
    again = orders.filter(_AGAIN.replace("o_orderdate", "order_date")).filter("id % 8 = 5")
    merge_into(table, again.withColumn("price", F.col("price") + 1), datetime(2026, 1, 9), by_file=True)
    old = spark.createDataFrame([(r.file, True) for r in before], "old_file string, stays boolean")
    now = places().join(old, F.col("file") == F.col("old_file"), "left").select("id", F.col("stays").isNull().alias("moved"))
    return table.read(spark).select("id", "order_date", "price").join(now, "id")


@query(
    "w1_compacted",
    f"""
    WITH mark AS (SELECT max(o_orderdate) AS m FROM orders WHERE o_orderdate < TIMESTAMP '{LOADED_UNTIL}'),
    later AS (
        SELECT *, CAST(date_trunc('month', o_orderdate) AS DATE) AS event_month,
               CASE WHEN o_orderstatus = 'O' THEN o_orderdate + INTERVAL 365 DAY ELSE o_orderdate END AS corrected_at
        FROM orders CROSS JOIN mark),
    versions AS (
        SELECT o_orderkey AS id, o_orderdate AS order_date, o_orderdate AS updated_at, event_month
        FROM later WHERE o_orderdate < TIMESTAMP '{LOADED_UNTIL}'
        UNION ALL SELECT o_orderkey, o_orderdate, corrected_at, event_month FROM later WHERE corrected_at > m),
    ranked AS (
        SELECT *, row_number() OVER (PARTITION BY id ORDER BY updated_at DESC) AS r FROM versions),
    months AS (
        SELECT event_month, count(*) FILTER (WHERE r > 1) > 0.2 * count(*) AS crowded FROM ranked GROUP BY 1)
    SELECT id, order_date, updated_at, event_month
    FROM ranked JOIN months USING (event_month) WHERE r = 1 OR NOT crowded
    """,
)
def w1_compacted(spark, sf_dir):
    """The rows a mart stores after corrections were appended and months in which over a
    fifth of the rows were superseded were compacted."""
    path = work_dir(spark, "compacted")
    date, later = F.col("o_orderdate"), F.col("o_orderdate") + F.expr("INTERVAL '365' DAY")
    orders = load(spark, sf_dir, "orders")
    plain = [F.col("o_orderkey").alias("id"), date.alias("order_date")]
    first = orders.filter(date < F.lit(LOADED_UNTIL).cast("timestamp_ntz")).select(*plain, date.alias("updated_at"))
    corrected = F.when(F.col("o_orderstatus") == "O", later).otherwise(date)
    second = orders.select(*plain, corrected.alias("updated_at"))
    for curated in (first, second):
        run_mart(curated, path, "order_date", ["id"], ["id", "order_date", "updated_at"])
    schema = mart_stage(first, "order_date").schema
    compact_mart(spark, path, schema, [MONTH, "id"])
    return spark.read.schema(schema).parquet(path)


@query(
    "e3_stored_declaration",
    """
    SELECT o_orderkey AS id, o_orderdate AS order_date, CAST(CAST(o_custkey AS INT) AS BIGINT) AS cust,
           CASE WHEN o_orderkey % 4 = 3 THEN CAST(o_custkey AS DOUBLE) + 0.5
                ELSE CAST(o_custkey AS DOUBLE) END AS price,
           CASE WHEN o_orderkey % 4 = 3 THEN o_orderstatus END AS status,
           'column ''cust'' cannot change from bigint to int; column ''price'' cannot change from int to string'
               AS refused
    FROM orders
    """,
)
def e3_stored_declaration(spark, sf_dir):
    """A table written under one declaration and then under a wider one, whose files lie side
    by side in every month; declarations that would lose values are refused."""
    path = f"{work_dir(spark, 'declared')}/orders"

    def table(ddl: str) -> Table:
        schema = T.StructType.fromDDL(f"id bigint, order_date timestamp_ntz, {ddl}")
        return Table(path, schema, keys=("id", "order_date"), date="order_date")

    older, newer = table("cust int, price int, gone string"), table("cust bigint, price double, status string")
    orders = load(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    plain = [key.alias("id"), F.col("o_orderdate").alias("order_date"), F.col("o_custkey").cast("int").alias("cust")]
    first = orders.filter(key % 4 != 3).select(*plain, F.col("o_custkey").cast("int").alias("price"), F.lit("x").alias("gone"))
    second = orders.filter(key % 4 == 3).select(*plain, (F.col("o_custkey") + 0.5).alias("price"), F.col("o_orderstatus").alias("status"))
    merge_into(older, first, datetime(2026, 1, 1), by_file=True)
    merge_into(newer, second, datetime(2026, 1, 2), by_file=True)
    refused = []
    for narrower in (table("cust int, price double, status string"), table("cust bigint, price string, status string")):
        try:
            narrower.read(spark)
        except SchemaChangeError as error:
            refused.append(str(error))
    return newer.read(spark).withColumn("refused", F.lit("; ".join(refused)))


@query(
    "i1_mark_of_changed",
    f"""
    SELECT '2026-01-03 00:00:00' AS mark, count(DISTINCT date_trunc('month', o_orderdate)) AS partitions
    FROM orders WHERE {_AGAIN}
    """,
)
def i1_mark_of_changed(spark, sf_dir):
    """The newest stamp of a table, and how many partitions had to be read for it."""
    table = _orders_table(work_dir(spark, "newest"))
    orders = _orders(spark, sf_dir)
    merge_into(table, orders, datetime(2026, 1, 2))
    merge_into(table, orders.filter(_AGAIN.replace("o_orderdate", "order_date")), datetime(2026, 1, 3))
    mark = table.greatest(spark, "updated_at")
    read = table.partitions_of(table.read_since(spark, "updated_at", mark))
    return read.agg(F.lit(mark).alias("mark"), F.count("*").alias("partitions"))
