"""Sources, sinks and increments."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import (
    bounds,
    corrupt,
    high_water,
    in_range,
    mark_value,
    newer_than,
    quality_metrics,
    rejected_rows,
    since,
    tag,
    typed_projection,
)
from tidemark.plans import mart_delta, mart_stage
from tidemark.queries.quality import EVENT_RULES
from tidemark.queries.registry import LOADED_UNTIL, RUN_TS, load, query
from tidemark.sinks import append_mart, write_metrics, write_quarantine
from tidemark.sources import (
    read_delimited,
    read_metrics_history,
    read_quarantine,
    read_raw_json,
    read_table,
)
from tidemark.staging import staged, work_dir

EVENTS = (
    "event_id bigint, ts timestamp_ntz, user_id int, event_type string, value double, props string"
)


@query(
    "s1_json_scan",
    """
    SELECT event_id, ts, CAST(user_id AS INT) AS user_id, event_type, value, props FROM events
    """,
)
def s1_json_scan(spark, sf_dir):
    path = work_dir(spark, "raw-events")
    events = load(spark, sf_dir, "events")
    events.write.option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").json(path)
    schema = T.StructType.fromDDL(EVENTS)
    return typed_projection(read_raw_json(spark, path, schema, multiline=False), schema)


@query(
    "s1_json_broken",
    """
    WITH written AS (
        SELECT *, '{"event_id": ' || event_id || ', "user_id": "' || user_id || '", "tags": ' ||
               CASE WHEN event_type = 'view' THEN '"none"'
                    ELSE '["' || event_type || '", "all"]' END ||
               CASE WHEN event_type = 'error' THEN '' ELSE '}' END AS line
        FROM events)
    SELECT CASE WHEN event_type <> 'error' THEN event_id END AS event_id,
           CASE WHEN event_type <> 'error' THEN CAST(user_id AS INT) END AS user_id,
           CASE WHEN event_type NOT IN ('error', 'view') THEN event_type || ',all' END AS tags,
           CASE WHEN event_type = 'error' THEN line END AS _corrupt_record,
           CASE WHEN event_type = 'error' THEN 'CORRUPT' ELSE '' END AS errors
    FROM written
    """,
)
def s1_json_broken(spark, sf_dir):
    """Records cut short are kept as text, and one bad field spoils only itself."""
    path = work_dir(spark, "broken-events")
    kind = F.col("event_type")
    tags = F.when(kind == "view", F.lit('"none"')).otherwise(
        F.concat(F.lit('["'), kind, F.lit('", "all"]'))
    )
    load(spark, sf_dir, "events").select(
        F.concat(
            F.lit('{"event_id": '),
            F.col("event_id"),
            F.lit(', "user_id": "'),
            F.col("user_id"),
            F.lit('", "tags": '),
            tags,
            F.when(kind == "error", "").otherwise("}"),
        )
    ).write.text(path)
    schema = T.StructType.fromDDL(
        "event_id bigint, user_id int, tags array<string>, _corrupt_record string"
    )
    raw = read_raw_json(spark, path, schema, multiline=False)
    tagged = tag(typed_projection(raw, schema), [corrupt("CORRUPT")])
    return tagged.withColumns({c: F.array_join(c, ",") for c in ("tags", "errors")})


@query(
    "s1_json_multiline",
    """
    WITH written AS (
        SELECT event_id // 200 AS doc, event_id, user_id, event_type,
               '{"event_id": ' || event_id || ', "user_id": "' || user_id || '", "tags": ["' ||
               event_type || '"]}' AS line
        FROM events)
    SELECT event_id, CAST(user_id AS INT) AS user_id, event_type AS tags,
           NULL::VARCHAR AS _corrupt_record
    FROM written WHERE doc % 4 <> 1
    UNION ALL
    SELECT NULL, NULL, NULL,
           '[' || string_agg(line, ',' || chr(10) || ' ' ORDER BY event_id) || chr(10)
    FROM written WHERE doc % 4 = 1 GROUP BY doc
    """,
)
def s1_json_multiline(spark, sf_dir):
    """A folder of documents, each one array over several lines; every fourth is cut short
    and kept as text."""
    return run_documents(spark, prepare_documents(spark, sf_dir))


def prepare_documents(spark, sf_dir) -> str:
    path = work_dir(spark, "array-events")
    doc = F.expr("event_id div 200")
    lines = F.array_sort(F.collect_list(F.struct("event_id", _event_line().alias("line"))))["line"]
    (
        load(spark, sf_dir, "events")
        .groupBy(doc.alias("doc"))
        .agg(F.concat(F.lit("["), F.array_join(lines, ",\n ")).alias("open"))
        .select("doc", F.concat("open", F.when(F.col("doc") % 4 == 1, "").otherwise("]")).alias("value"))
        .select("value")
        .write.option("maxRecordsPerFile", 1)  # a document a file
        .text(path)
    )
    return path


def run_documents(spark, path: str):
    schema = _event_schema()
    typed = typed_projection(read_raw_json(spark, path, schema), schema)
    return typed.withColumn("tags", F.array_join("tags", ","))


def _event_schema():
    return T.StructType.fromDDL("event_id bigint, user_id int, tags array<string>, _corrupt_record string")


def _event_line():
    return F.concat(
        F.lit('{"event_id": '), F.col("event_id"), F.lit(', "user_id": "'), F.col("user_id"),
        F.lit('", "tags": ["'), F.col("event_type"), F.lit('"]}'),
    )


@query(
    "s1_json_split",
    """
    SELECT event_id, CAST(user_id AS INT) AS user_id, event_type || ',}"{[' AS tags,
           NULL::VARCHAR AS _corrupt_record FROM events
    UNION ALL
    SELECT NULL, NULL, NULL, '[' || '{"event_id": ' || event_id || ', "user_id": "' || user_id ||
           '", "tags": ["' || event_type || '", "}\\"{["]}'
    FROM events WHERE event_id = (SELECT min(event_id) FROM events)
    """,
)
def s1_json_split(spark, sf_dir):
    """Two arrays of all events, read in byte ranges of 64 kB; the second is cut short. Braces
    and quotes in their texts end nothing."""
    path = work_dir(spark, "one-array")
    line = F.regexp_replace(_event_line(), r'"\]\}$', r'", "}\\"{["]}')
    events = load(spark, sf_dir, "events")
    first, last = events.agg(F.min("event_id"), F.max("event_id")).first()
    opened = F.concat(F.when(F.col("event_id") == first, "[").otherwise(","), line)
    closed = F.concat(opened, F.when(F.col("event_id") == last, "]").otherwise(""))
    for name, value in (("whole", closed), ("cut", opened)):
        events.orderBy("event_id").coalesce(1).select(value.alias("value")).write.text(f"{path}/{name}")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        schema = _event_schema()
        typed = typed_projection(read_raw_json(spark, f"{path}/*", schema, split_above=0), schema)
        return staged(typed.withColumn("tags", F.array_join("tags", ",")), "split")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@query("s2_csv_scan", "SELECT CAST(c_custkey AS INT) AS id, c_name AS name FROM customer")
def s2_csv_scan(spark, sf_dir):
    path = work_dir(spark, "reference-file")
    directory = load(spark, sf_dir, "customer").selectExpr("c_custkey AS id", "c_name AS name")
    directory.write.option("header", True).option("sep", ";").csv(path)
    return read_delimited(spark, path, T.StructType.fromDDL("id int, name string"))


@query("s3_table_scan", "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders")
def s3_table_scan(spark, sf_dir):
    return read_table(
        spark, f"{sf_dir}/orders.parquet", ["o_orderkey", "o_orderdate", "o_totalprice"]
    )


@query(
    "s5_mart_stage",
    "SELECT *, CAST(date_trunc('month', o_orderdate) AS DATE) AS event_month FROM orders",
)
def s5_mart_stage(spark, sf_dir):
    return mart_stage(load(spark, sf_dir, "orders"), "o_orderdate")


@query(
    "s6_metrics_history",
    """
    SELECT strftime(ts, '%Y-%m-%d') AS ds,
           count(*) AS total_rows,
           count(*) FILTER (WHERE NOT coalesce(value < 1 OR value > 100, false)) AS valid_rows,
           count(*) FILTER (WHERE value < 1 OR value > 100) AS invalid_rows,
           round(count(*) FILTER (WHERE value < 1 OR value > 100) / count(*)::DOUBLE * 100, 2)
               AS error_percent,
           CAST(0 AS BIGINT) AS corrupt_rows, CAST(0 AS BIGINT) AS undated_children
    FROM events GROUP BY 1
    """,
)
def s6_metrics_history(spark, sf_dir):
    path = work_dir(spark, "metrics")
    events = load(spark, sf_dir, "events").withColumn("ds", F.col("ts").cast("date"))
    write_metrics(quality_metrics(tag(events, EVENT_RULES), by=["ds"]), path)
    return read_metrics_history(spark, path)


@query(
    "k1_quarantine",
    """
    SELECT 'events' AS ds, event_id AS id, NULL AS amount,
           CASE WHEN value < 1 THEN 'LOW' ELSE 'HIGH' END AS errors,
           TIMESTAMP '2026-01-01 00:00:00' AS rejected_at
    FROM events WHERE value < 1 OR value > 100
    UNION ALL
    SELECT 'orders', o_orderkey, o_totalprice,
           'PRICE', TIMESTAMP '2026-01-01 00:00:00'
    FROM orders WHERE o_totalprice < 5000 OR o_totalprice > 495000
    """,
)
def k1_quarantine(spark, sf_dir):
    """Batches of different columns, one of them stored twice."""
    path = work_dir(spark, "quarantine")
    events = tag(load(spark, sf_dir, "events"), EVENT_RULES)
    rejected = rejected_rows(events, RUN_TS).selectExpr("event_id AS id", "errors", "rejected_at")
    orders = tag(
        load(spark, sf_dir, "orders"), [in_range("o_totalprice", 5000, 495000, "PRICE")]
    )
    for rows, ds in (
        (rejected, "events"),
        (
            rejected_rows(orders, RUN_TS).selectExpr(
                "o_orderkey AS id", "o_totalprice AS amount", "errors", "rejected_at"
            ),
            "orders",
        ),
        (rejected, "events"),
    ):
        write_quarantine(rows, path, ds)
    return read_quarantine(spark, path).withColumn("errors", F.array_join("errors", ","))


@query("i1_high_water", "SELECT max(ts) AS mark FROM events")
def i1_high_water(spark, sf_dir):
    return high_water(load(spark, sf_dir, "events"), "ts")


@query(
    "i2_since",
    f"""
    SELECT * FROM orders
    WHERE o_orderdate >= (SELECT max(o_orderdate) FROM orders
                          WHERE o_orderdate < TIMESTAMP '{LOADED_UNTIL}')
    """,
)
def i2_since(spark, sf_dir):
    orders = load(spark, sf_dir, "orders")
    loaded = orders.filter(F.col("o_orderdate") < F.lit(LOADED_UNTIL).cast("timestamp_ntz"))
    return since(orders, "o_orderdate", mark_value(loaded, "o_orderdate"))


@query(
    "i2_zoned_marks",
    """
    SELECT event_id, 'since' AS cut FROM events
    WHERE ts >= (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-15 00:00:00')
    UNION ALL
    SELECT event_id, 'newer' FROM events
    WHERE ts > (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-15 00:00:00')
    """,
)
def i2_zoned_marks(spark, sf_dir):
    """Marks on a column with a time zone, in a session of another zone than the process."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        events = load(spark, sf_dir, "events")
        moments = events.select("event_id", F.col("ts").cast("timestamp").alias("at"), "ts")
        loaded = moments.filter(F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz"))
        mark = mark_value(loaded, "at")
        cuts = [
            cut(moments, "at", mark).select("event_id", F.lit(name).alias("cut"))
            for name, cut in (("since", since), ("newer", newer_than))
        ]
        # Planned while the zone holds.
        return staged(cuts[0].unionByName(cuts[1]), "zoned")
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@query(
    "i3_mart_delta",
    """
    SELECT * FROM events
    WHERE ts > (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-15 00:00:00')
    """,
)
def i3_mart_delta(spark, sf_dir):
    events = load(spark, sf_dir, "events")
    return mart_delta(events, _mart_events(events), "ts")


@query("a4_bounds", "SELECT min(o_orderdate) AS low, max(o_orderdate) AS high FROM orders")
def a4_bounds(spark, sf_dir):
    return bounds(load(spark, sf_dir, "orders"), "o_orderdate")


@query(
    "m3_mart_append",
    """
    SELECT event_id, ts, event_type, value,
           CAST(date_trunc('month', ts) AS DATE) AS event_month
    FROM events
    """,
)
def m3_mart_append(spark, sf_dir):
    path = work_dir(spark, "mart")
    events = mart_stage(
        load(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value"), "ts"
    )
    loaded = _mart_events(events)
    append_mart(loaded, path, "event_month", ["event_id"])
    stored = spark.read.schema(events.schema).parquet(path)
    append_mart(newer_than(events, "ts", mark_value(stored, "ts")), path, "event_month", ["event_id"])
    return spark.read.schema(events.schema).parquet(path)


def _mart_events(events):
    return events.filter(F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz"))
