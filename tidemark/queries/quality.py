"""Rule tagging, metrics, split and gate."""

from pyspark.sql import functions as F

from tidemark.operators import (
    clean_rows,
    error_counts,
    gate,
    in_range,
    null_counts,
    predicate,
    quality_metrics,
    rejected_rows,
    tag,
)
from tidemark.queries.registry import RUN_TS, load, query

EVENT_RULES = [
    predicate("value < 1", "LOW"),
    predicate("value > 100", "HIGH"),
]

_BAD = "(value < 1 OR value > 100)"
_CODES = "CASE WHEN value < 1 THEN 'LOW' WHEN value > 100 THEN 'HIGH' ELSE '' END"


def _tagged(spark, sf_dir):
    return tag(load(spark, sf_dir, "events"), EVENT_RULES)


@query("q1_tag", f"SELECT event_id, event_type, value, {_CODES} AS errors FROM events")
def q1_tag(spark, sf_dir):
    return _tagged(spark, sf_dir).select(
        "event_id", "event_type", "value", F.array_join("errors", ",").alias("errors")
    )


@query(
    "q3_metrics",
    f"""
    SELECT count(*) AS total_rows,
           count(*) FILTER (WHERE NOT {_BAD}) AS valid_rows,
           count(*) FILTER (WHERE {_BAD}) AS invalid_rows,
           CAST(0 AS BIGINT) AS corrupt_rows,
           round(count(*) FILTER (WHERE {_BAD}) / count(*)::DOUBLE * 100, 2) AS error_percent
    FROM events
    """,
)
def q3_metrics(spark, sf_dir):
    return quality_metrics(_tagged(spark, sf_dir))


@query("q4_clean", f"SELECT * FROM events WHERE NOT {_BAD}")
def q4_clean(spark, sf_dir):
    return clean_rows(_tagged(spark, sf_dir))


@query(
    "q5_rejected",
    f"""
    SELECT event_id, ts, user_id, event_type, value, props, {_CODES} AS errors,
           TIMESTAMP '2026-01-01 00:00:00' AS created_at,
           TIMESTAMP '2026-01-01 00:00:00' AS rejected_at
    FROM events WHERE {_BAD}
    """,
)
def q5_rejected(spark, sf_dir):
    rows = rejected_rows(_tagged(spark, sf_dir), RUN_TS)
    return rows.withColumn("errors", F.array_join("errors", ","))


@query(
    "q6_gate",
    f"""
    WITH m AS (SELECT round(count(*) FILTER (WHERE {_BAD}) / count(*)::DOUBLE * 100, 2) AS p
               FROM events)
    SELECT p AS error_percent, 5.0::DOUBLE AS limit_percent, p <= 5.0 AS passed FROM m
    """,
)
def q6_gate(spark, sf_dir):
    return gate(quality_metrics(_tagged(spark, sf_dir)), 5.0)


@query(
    "q7_error_counts",
    f"SELECT {_CODES} AS code, count(*) AS rows FROM events WHERE {_BAD} GROUP BY 1",
)
def q7_error_counts(spark, sf_dir):
    return error_counts(_tagged(spark, sf_dir))


@query(
    "q8_not_null",
    """
    SELECT 'o_orderkey' AS column_name, count(*) FILTER (WHERE o_orderkey IS NULL) AS null_rows FROM orders
    UNION ALL
    SELECT 'o_orderdate', count(*) FILTER (WHERE o_orderdate IS NULL) FROM orders
    UNION ALL
    SELECT 'o_orderstatus', count(*) FILTER (WHERE nullif(o_orderstatus, 'P') IS NULL) FROM orders
    """,
)
def q8_not_null(spark, sf_dir):
    orders = load(spark, sf_dir, "orders").withColumn(
        "o_orderstatus", F.nullif(F.col("o_orderstatus"), F.lit("P"))
    )
    return null_counts(orders, ["o_orderkey", "o_orderdate", "o_orderstatus"])


@query(
    "q1_range_int",
    """
    SELECT l_orderkey, l_linenumber, l_quantity,
           CASE WHEN CAST(l_quantity AS INT) < 1.5 OR CAST(l_quantity AS INT) > 48.5
                THEN 'QUANTITY' ELSE '' END AS errors
    FROM lineitem
    """,
)
def q1_range_int(spark, sf_dir):
    """Bounds with a fraction on a column of whole numbers."""
    lines = load(spark, sf_dir, "lineitem").withColumn("quantity", F.col("l_quantity").cast("int"))
    tagged = tag(lines, [in_range("quantity", 1.5, 48.5, "QUANTITY")])
    return tagged.select(
        "l_orderkey", "l_linenumber", "l_quantity", F.array_join("errors", ",").alias("errors")
    )
