"""Semi-joins, child lists, dimensions and distinct keys."""

from pyspark.sql import functions as F

from tidemark.operators import attach, child_lists, lookup, restrict_children
from tidemark.queries.registry import LOADED_UNTIL, load, query


def _recent_orders(spark, sf_dir):
    return load(spark, sf_dir, "orders").filter(
        F.col("o_orderdate") >= F.lit(LOADED_UNTIL).cast("timestamp_ntz")
    )


@query(
    "j1_semi_children",
    f"""
    SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag FROM lineitem
    WHERE l_orderkey IN (SELECT o_orderkey FROM orders
                         WHERE o_orderdate >= TIMESTAMP '{LOADED_UNTIL}')
    """,
)
def j1_semi_children(spark, sf_dir):
    lines = load(spark, sf_dir, "lineitem")
    rows = restrict_children(lines, _recent_orders(spark, sf_dir), {"l_orderkey": "o_orderkey"})
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")


@query(
    "a1_collect",
    """
    SELECT l_orderkey, array_to_string(list(l_returnflag ORDER BY l_returnflag), ',') AS flags
    FROM lineitem GROUP BY 1
    """,
)
def a1_collect(spark, sf_dir):
    lists = child_lists(load(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_returnflag", "flags")
    return lists.withColumn("flags", F.array_join("flags", ","))


@query(
    "j2_left_lists",
    """
    SELECT o_orderkey, o_totalprice, flags
    FROM orders LEFT JOIN (
        SELECT l_orderkey, array_to_string(list(l_returnflag ORDER BY l_returnflag), ',') AS flags
        FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey
    """,
)
def j2_left_lists(spark, sf_dir):
    lists = child_lists(load(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_returnflag", "flags")
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    rows = attach(orders, lists, {"l_orderkey": "o_orderkey"})
    return rows.withColumn("flags", F.array_join("flags", ","))


@query(
    "j3_broadcast_dims",
    """
    SELECT o_orderkey, c_name AS customer_name, n_name AS nation_name
    FROM orders
    LEFT JOIN customer ON nullif(o_custkey, 0) = c_custkey
    LEFT JOIN nation ON c_nationkey = n_nationkey
    """,
)
def j3_broadcast_dims(spark, sf_dir):
    customer = load(spark, sf_dir, "customer")
    orders = load(spark, sf_dir, "orders").select(
        "o_orderkey", F.nullif(F.col("o_custkey"), F.lit(0)).alias("cust")
    )
    placed = lookup(
        orders, customer, "cust", "c_custkey", {"c_name": "customer_name", "c_nationkey": "nation"}
    )
    nation = load(spark, sf_dir, "nation")
    rows = lookup(placed, nation, "nation", "n_nationkey", {"n_name": "nation_name"})
    return rows.select("o_orderkey", "customer_name", "nation_name")


@query("a5_distinct_keys", "SELECT DISTINCT o_custkey, o_orderdate FROM orders")
def a5_distinct_keys(spark, sf_dir):
    return load(spark, sf_dir, "orders").select("o_custkey", "o_orderdate").distinct()
