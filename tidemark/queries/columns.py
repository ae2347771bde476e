"""Typed projection, column expressions and schema conformance."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import guarded_ratio, hash_key, month_start, parse_timestamp
from tidemark.operators import align, conform, explode_children, typed_projection
from tidemark.queries.registry import load, query


@query(
    "p1_cast",
    """
    SELECT event_id,
           TRY_CAST(ts AS TIMESTAMP) AS ts,
           CAST(NULL AS INT) AS event_type,
           CAST(floor(value) AS INT) AS value,
           CAST(json_extract_string(props, '$.k') AS INT) AS k,
           event_type || ',' || user_id AS labels,
           CAST(NULL AS VARCHAR) AS broken,
           CAST(NULL AS DOUBLE) AS absent
    FROM events
    """,
)
def p1_cast(spark, sf_dir):
    events = load(spark, sf_dir, "events")
    raw = events.select(
        F.col("event_id").cast("string"),
        F.col("ts").cast("string"),
        "event_type",
        F.col("value").cast("string"),
        F.get_json_object("props", "$.k").alias("k"),
        F.to_json(F.array("event_type", F.col("user_id").cast("string"))).alias("labels"),
        F.col("event_type").alias("broken"),
    )
    schema = T.StructType.fromDDL(
        "event_id bigint, ts timestamp_ntz, event_type int, value int, k int, "
        "labels array<string>, broken array<string>, absent double"
    )
    typed = typed_projection(raw, schema)
    return typed.withColumns({c: F.array_join(c, ",") for c in ("labels", "broken")})


@query(
    "p2_multi_ts",
    """
    SELECT o_orderkey,
           CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderdate END AS order_date
    FROM orders
    """,
)
def p2_multi_ts(spark, sf_dir):
    orders = load(spark, sf_dir, "orders")
    return orders.select("o_orderkey", parse_timestamp(rendered_date()).alias("order_date"))


def rendered_date():
    """Order dates in the four accepted layouts and one that is not, by priority."""
    layouts = {
        "1-URGENT": "yyyy-MM-dd HH:mm:ss",
        "2-HIGH": "yyyy-MM-dd",
        "3-MEDIUM": "dd.MM.yyyy HH:mm:ss",
        "4-NOT SPECIFIED": "dd.MM.yyyy",
        "5-LOW": "yyyy-MM-dd'T'HH:mm:ss",
    }
    return F.coalesce(
        *[
            F.when(F.col("o_orderpriority") == priority, F.date_format("o_orderdate", layout))
            for priority, layout in layouts.items()
        ]
    )


@query(
    "p3_hash_key",
    """
    SELECT o_orderkey,
           md5(concat_ws('-', CAST(o_orderdate AS VARCHAR), CAST(o_custkey AS VARCHAR),
                         coalesce(nullif(o_orderpriority, '5-LOW'), 'EMPTY'))) AS id
    FROM orders
    """,
)
def p3_hash_key(spark, sf_dir):
    priority = F.nullif(F.col("o_orderpriority"), F.lit("5-LOW"))
    return load(spark, sf_dir, "orders").select(
        "o_orderkey", hash_key(F.col("o_orderdate"), F.col("o_custkey"), priority).alias("id")
    )


@query(
    "p4_ratio",
    """
    SELECT p_partkey,
           CASE WHEN p_size - 1 > 0 AND p_retailprice > 0
                THEN round(p_retailprice / pow((p_size - 1) / 100::DOUBLE, 2), 1) END AS ratio
    FROM part
    """,
)
def p4_ratio(spark, sf_dir):
    return load(spark, sf_dir, "part").select(
        "p_partkey", guarded_ratio(F.col("p_retailprice"), F.col("p_size") - 1).alias("ratio")
    )


@query(
    "p5_align",
    "SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, c_acctbal FROM customer",
)
def p5_align(spark, sf_dir):
    renamed = load(spark, sf_dir, "customer").withColumnsRenamed(
        {"c_custkey": "id", "c_name": "name", "c_mktsegment": "segment"}
    )
    schema = T.StructType.fromDDL("id bigint, name string, segment string, c_acctbal double")
    return align(renamed, schema)


@query(
    "p7_month",
    "SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS order_month FROM orders",
)
def p7_month(spark, sf_dir):
    return load(spark, sf_dir, "orders").select(
        "o_orderkey", month_start(F.col("o_orderdate")).alias("order_month")
    )


@query(
    "p8_explode",
    """
    SELECT doc_id, lang, line
    FROM (SELECT doc_id, lang, unnest(string_split(text, chr(10))) AS line FROM documents)
    WHERE line <> ''
    """,
)
def p8_explode(spark, sf_dir):
    lines = F.filter(F.split("text", "\n"), lambda line: line != "")
    documents = load(spark, sf_dir, "documents").select("doc_id", "lang", lines.alias("lines"))
    return explode_children(
        documents, {"doc_id": "doc_id", "lang": "lang"}, array="lines", code="line"
    )


@query(
    "e4_conform",
    """
    SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal,
           CAST(NULL AS VARCHAR) AS c_phone
    FROM customer
    """,
)
def e4_conform(spark, sf_dir):
    older = load(spark, sf_dir, "customer").withColumnRenamed("c_name", "C_NAME")
    schema = T.StructType.fromDDL(
        "c_custkey bigint, c_name string, c_nationkey bigint, c_acctbal double, c_phone string"
    )
    return conform(older, schema)
