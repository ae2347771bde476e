"""The jobs end to end, over the test tables in the roles of their layers."""

from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import NothingToDo, NotNullError, QualityGateError
from tidemark.functions import guarded_ratio, hash_key, parse_timestamp
from tidemark.operators import child_lists, corrupt, in_range
from tidemark.plans import (
    ChildTable,
    CleanJob,
    CuratedJob,
    Visits,
    load_reference,
    read_mart,
    run_clean,
    run_curated,
    run_mart,
    visit_rules,
)
from tidemark.queries.columns import rendered_date
from tidemark.queries.registry import LOADED_UNTIL, REDELIVERED_FROM, RUN_TS, load, query
from tidemark.sinks import merge_into
from tidemark.sources import Table, read_metrics_history, read_quarantine, read_raw_json
from tidemark.staging import work_dir

_NOW = "TIMESTAMP '2026-01-01 00:00:00'"

CURATED_ORDERS = (
    "id bigint, order_date timestamp_ntz, cust bigint, status string, price double, "
    "flag_list array<string>, status_list array<string>, customer_name string, "
    "segment string, created_at timestamp_ntz, updated_at timestamp_ntz"
)


def _lists_sql(column: str) -> str:
    return (
        f"(SELECT l_orderkey, array_to_string(list({column} ORDER BY {column}), ',') AS codes "
        "FROM lineitem GROUP BY 1)"
    )


@query(
    "g1_curated",
    f"""
    WITH mark AS (SELECT max(o_orderdate) AS m FROM orders
                  WHERE o_orderdate < TIMESTAMP '{LOADED_UNTIL}')
    SELECT o_orderkey AS id, o_orderdate AS order_date, o_custkey AS cust,
           o_orderstatus AS status, o_totalprice AS price,
           CASE WHEN o_orderdate >= m THEN f.codes END AS flag_list,
           CASE WHEN o_orderdate >= m THEN s.codes END AS status_list,
           CASE WHEN o_orderdate >= m THEN c_name END AS customer_name,
           CASE WHEN o_orderdate >= m THEN c_mktsegment END AS segment,
           CASE WHEN o_orderdate < TIMESTAMP '{LOADED_UNTIL}' THEN o_orderdate
                ELSE {_NOW} END AS created_at,
           CASE WHEN o_orderdate >= m THEN {_NOW} ELSE o_orderdate END AS updated_at
    FROM orders CROSS JOIN mark
    LEFT JOIN {_lists_sql('l_returnflag')} f ON f.l_orderkey = o_orderkey
    LEFT JOIN {_lists_sql('l_linestatus')} s ON s.l_orderkey = o_orderkey
    LEFT JOIN customer ON c_custkey = o_custkey
    """,
)
def g1_curated(spark, sf_dir):
    """The curated table, loaded up to a date under an older declaration without lists
    and names, brought to the current one and then advanced by the next increment."""
    orders = _order_parents(spark, sf_dir, F.col("o_orderdate"))
    job = _curated_job(spark, sf_dir, "order-increment")
    job.parents.replace(orders)
    loaded = orders.filter(F.col("created_at") < F.lit(LOADED_UNTIL).cast("timestamp_ntz"))
    Table(job.curated.path, orders.schema, date="order_date").replace(loaded)
    run_curated(spark, job, RUN_TS)
    return _listed(job.curated.read(spark))


def _listed(rows):
    return rows.withColumns({c: F.array_join(c, ",") for c in ("flag_list", "status_list")})


def _order_parents(spark, sf_dir, stamp):
    return load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderdate").alias("order_date"),
        F.col("o_custkey").alias("cust"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("price"),
        stamp.alias("created_at"),
        stamp.alias("updated_at"),
    )


def _curated_job(spark, sf_dir, label: str, **options) -> CuratedJob:
    """Orders with the lists of their lines and the name of their customer; lines and
    customers are read where they are."""
    root = work_dir(spark, label)
    schema = T.StructType.fromDDL(CURATED_ORDERS)
    names = ("id", "order_date", "cust", "status", "price", "created_at", "updated_at")
    parents = T.StructType([f for f in schema.fields if f.name in names])
    lines = Table(f"{sf_dir}/lineitem.parquet", load(spark, sf_dir, "lineitem").schema)
    customers = Table(f"{sf_dir}/customer.parquet", load(spark, sf_dir, "customer").schema)
    return CuratedJob(
        parents=Table(f"{root}/parents", parents, keys=("id", "order_date"), date="order_date"),
        children=[
            (lines, {"l_orderkey": "id"}, "l_returnflag", "flag_list"),
            (lines, {"l_orderkey": "id"}, "l_linestatus", "status_list"),
        ],
        dimensions=[
            (customers, "cust", "c_custkey", {"c_name": "customer_name", "c_mktsegment": "segment"}),
        ],
        curated=Table(f"{root}/curated", schema, keys=("id", "order_date"), date="order_date"),
        **options,
    )


_REDELIVERED = f"o_orderdate >= TIMESTAMP '{REDELIVERED_FROM}'"
_LOADED = f"o_orderdate < TIMESTAMP '{LOADED_UNTIL}'"


@query(
    "g2_curated_increment",
    f"""
    SELECT o_orderkey AS id, o_orderdate AS order_date, o_custkey AS cust, o_orderstatus AS status,
           CASE WHEN {_REDELIVERED} THEN o_totalprice + 1 ELSE o_totalprice END AS price,
           f.codes AS flag_list, s.codes AS status_list, c_name AS customer_name,
           c_mktsegment AS segment,
           CASE WHEN {_LOADED} THEN TIMESTAMP '2026-01-02 00:00:00'
                ELSE TIMESTAMP '2026-01-04 00:00:00' END AS created_at,
           CASE WHEN {_REDELIVERED} THEN TIMESTAMP '2026-01-04 00:00:00'
                ELSE TIMESTAMP '2026-01-02 00:00:00' END AS updated_at
    FROM orders
    LEFT JOIN {_lists_sql('l_returnflag')} f ON f.l_orderkey = o_orderkey
    LEFT JOIN {_lists_sql('l_linestatus')} s ON s.l_orderkey = o_orderkey
    LEFT JOIN customer ON c_custkey = o_custkey
    """,
)
def g2_curated_increment(spark, sf_dir):
    """Two runs of the curated job: between them, two years are delivered again, corrected,
    with all that is newer. The increment is cut by the parents' update time, as read."""
    job = _curated_job(spark, sf_dir, "two-increments", mark="updated_at", carry_mark=True)
    first = _order_parents(spark, sf_dir, F.col("o_orderdate"))
    date = F.col("order_date")
    job.parents.replace(first.filter(date < F.lit(LOADED_UNTIL).cast("timestamp_ntz")))
    run_curated(spark, job, datetime(2026, 1, 2))
    again = first.filter(date >= F.lit(REDELIVERED_FROM).cast("timestamp_ntz"))
    merge_into(job.parents, again.withColumn("price", F.col("price") + 1), datetime(2026, 1, 3))
    run_curated(spark, job, datetime(2026, 1, 4))
    return _listed(job.curated.read(spark))


@query(
    "f4_empty_increment",
    """
    SELECT 1 AS run, 'loaded' AS outcome, count(*) AS n FROM orders
    UNION ALL SELECT 2, 'nothing to do', count(*) FROM orders
    """,
)
def f4_empty_increment(spark, sf_dir):
    """A second run with nothing new says so, and leaves the table as it is."""
    job = _curated_job(spark, sf_dir, "no-increment")
    job.parents.replace(_order_parents(spark, sf_dir, F.col("o_orderdate")))
    rows = []
    for run in (1, 2):
        try:
            run_curated(spark, job, RUN_TS)
            outcome = "loaded"
        except NothingToDo:
            outcome = "nothing to do"
        held = job.curated.read(spark)
        rows.append(held.agg(F.lit(run).alias("run"), F.lit(outcome).alias("outcome"), F.count("*").alias("n")))
    return rows[0].unionByName(rows[1])


@query(
    "b1_clean_job",
    f"""
    WITH typed AS (
        SELECT *, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderdate END AS order_date,
               CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_orderdate AS VARCHAR)
                    ELSE 'EMPTY' END AS date_text
        FROM orders WHERE o_totalprice BETWEEN 5000 AND 495000),
    clean AS (
        SELECT *, md5(concat_ws('-', date_text, CAST(o_custkey AS VARCHAR), o_orderpriority)) AS id
        FROM typed),
    children AS (
        SELECT id, order_date,
               string_agg(l_returnflag, '' ORDER BY l_returnflag) AS flags,
               string_agg(l_linestatus, '' ORDER BY l_linestatus) AS statuses
        FROM clean JOIN lineitem ON l_orderkey = o_orderkey
        WHERE order_date IS NOT NULL GROUP BY ALL)
    SELECT clean.id, clean.order_date, CAST(o_custkey AS VARCHAR) AS customer,
           o_orderpriority AS priority, o_totalprice AS price, CAST(o_custkey AS INT) AS size,
           CASE WHEN o_custkey > 0
                THEN round(o_totalprice / pow(o_custkey / 100::DOUBLE, 2), 1) END AS ratio,
           {_NOW} AS created_at, {_NOW} AS updated_at, flags, statuses
    FROM clean LEFT JOIN children
        ON clean.id = children.id AND clean.order_date = children.order_date
    """,
)
def b1_clean_job(spark, sf_dir):
    return run_orders(spark, prepare_orders(spark, sf_dir))


def prepare_orders(spark, sf_dir) -> str:
    """The raw files of the clean job, apart from the job itself."""
    root = work_dir(spark, "clean-job")
    _raw_orders(spark, sf_dir, F.col("o_custkey")).write.json(f"{root}/raw")
    return f"{root}/raw"


def run_orders(spark, raw: str):
    job = _clean_job(work_dir(spark, "clean-tables"))
    _load(spark, job, raw, "2026-01-01", RUN_TS)
    return _with_lists(spark, job)


def _raw_orders(spark, sf_dir, customer):
    lines = load(spark, sf_dir, "lineitem")
    raw = load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        rendered_date().alias("order_date"),
        customer.cast("string").alias("customer"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_totalprice").alias("price"),
        F.col("o_custkey").alias("size"),
        F.col("o_orderdate").alias("placed"),
        F.col("o_orderstatus").alias("status"),
    )
    lists = child_lists(lines, ["l_orderkey"], {"l_returnflag": "flags", "l_linestatus": "statuses"})
    return raw.join(lists.withColumnRenamed("l_orderkey", "id"), "id", "left")


def _clean_job(root: str, limit_percent: float = 5.0, most: float = 495000) -> CleanJob:
    def shape(df):
        dated = df.withColumn("order_date", parse_timestamp(F.col("order_date")))
        keys = [F.col("order_date"), F.col("customer"), F.col("priority")]
        return dated.withColumns(
            {
                "id": hash_key(*keys),
                "ratio": guarded_ratio(F.col("price"), F.col("size")),
            }
        )

    def child(alias: str) -> ChildTable:
        schema = T.StructType.fromDDL(
            "parent_id string, code string, order_date timestamp_ntz, "
            "created_at timestamp_ntz, updated_at timestamp_ntz"
        )
        table = Table(f"{root}/{alias}", schema, date="order_date")
        return ChildTable(table, {"parent_id": "id", "order_date": "order_date"}, alias, "code")

    return CleanJob(
        raw_schema=T.StructType.fromDDL(
            "id bigint, order_date string, customer string, priority string, price double, "
            "size int, flags array<string>, statuses array<string>, _corrupt_record string"
        ),
        rules=[corrupt("BROKEN"), in_range("price", 5000, most, "PRICE")],
        limit_percent=limit_percent,
        shape=shape,
        clean=Table(
            f"{root}/clean",
            T.StructType.fromDDL(
                "id string, order_date timestamp_ntz, customer string, priority string, "
                "price double, size int, ratio double, "
                "created_at timestamp_ntz, updated_at timestamp_ntz"
            ),
            keys=("order_date", "customer", "priority"),
            date="order_date",
        ),
        children=[child("flags"), child("statuses")],
        quarantine=f"{root}/quarantine",
        metrics=f"{root}/metrics",
    )


def _load(spark, job: CleanJob, raw: str, ds: str, run_ts: datetime) -> None:
    run_clean(read_raw_json(spark, raw, job.raw_schema, multiline=False), job, ds, run_ts)


def _with_lists(spark, job: CleanJob):
    rows = job.clean.read(spark)
    for table in job.children:
        codes = child_lists(
            table.table.read(spark), ["parent_id", "order_date"], "code", table.array
        )
        codes = codes.withColumn(table.array, F.array_join(table.array, ""))
        rows = rows.join(
            codes.withColumnRenamed("parent_id", "id"), ["id", "order_date"], "left"
        )
    return rows


def _two_batches(spark, sf_dir) -> CleanJob:
    """What is loaded first; then two years of it again, corrected, with all that is newer.
    Each has one record cut short. In the second, orders not finished have lost their lines."""
    job = _clean_job(work_dir(spark, "reload-tables"))
    raw = prepare_batches(spark, sf_dir)
    for day in (1, 2):
        _load(spark, job, f"{raw}/batch={day}", f"2026-01-0{day}", datetime(2026, 1, day))
    return job


def prepare_batches(spark, sf_dir) -> str:
    """The raw files of both batches, from one pass over the tables."""
    root = work_dir(spark, "reload")
    raw = _raw_orders(spark, sf_dir, F.col("o_orderkey"))
    first = F.col("placed") < F.lit(LOADED_UNTIL).cast("timestamp_ntz")
    second = F.col("placed") >= F.lit(REDELIVERED_FROM).cast("timestamp_ntz")
    batches = F.array_compact(F.array(F.when(first, 1), F.when(second, 2)))
    again = F.col("batch") == 2
    rows = raw.withColumn("batch", F.explode(batches)).withColumns(
        {"price": F.when(again, F.col("price") + 1).otherwise(F.col("price"))}
        | {c: F.when(~again | (F.col("status") == "F"), F.col(c)) for c in ("flags", "statuses")}
    )
    fields = [c for c in rows.columns if c not in {"placed", "status", "batch"}]
    lines = rows.select("batch", F.to_json(F.struct(*fields)).alias("value"))
    broken = load(spark, sf_dir, "region").agg(F.concat(F.lit('{"id": '), F.max("r_name")).alias("value"))
    broken = broken.withColumn("batch", F.explode(F.array(F.lit(1), F.lit(2))))
    lines.unionByName(broken).write.partitionBy("batch").text(f"{root}/raw")
    return f"{root}/raw"


_BATCHES = f"""
    WITH lists AS (
        SELECT l_orderkey, string_agg(l_returnflag, '' ORDER BY l_returnflag) AS flags,
               string_agg(l_linestatus, '' ORDER BY l_linestatus) AS statuses, count(*) AS n
        FROM lineitem GROUP BY 1),
    source AS (
        SELECT *, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderdate END AS order_date
        FROM orders LEFT JOIN lists ON l_orderkey = o_orderkey),
    first AS (SELECT *, o_totalprice AS price, flags AS f, statuses AS s, n AS children
              FROM source WHERE {_LOADED}),
    second AS (SELECT *, o_totalprice + 1 AS price,
                      CASE WHEN o_orderstatus = 'F' THEN flags END AS f,
                      CASE WHEN o_orderstatus = 'F' THEN statuses END AS s,
                      CASE WHEN o_orderstatus = 'F' THEN n END AS children
               FROM source WHERE {_REDELIVERED})
"""
_FITS = "price BETWEEN 5000 AND 495000"


@query(
    "b2_clean_reload",
    f"""
    {_BATCHES},
    a AS (SELECT * FROM first WHERE {_FITS}),
    b AS (SELECT * FROM second WHERE {_FITS}),
    rows AS (
        SELECT coalesce(b.o_orderkey, a.o_orderkey) AS o_orderkey,
               coalesce(b.order_date, a.order_date) AS order_date,
               coalesce(b.o_orderpriority, a.o_orderpriority) AS priority,
               coalesce(b.price, a.price) AS price, coalesce(b.o_custkey, a.o_custkey) AS cust,
               CASE WHEN a.o_orderkey IS NULL THEN 2 ELSE 1 END AS made,
               CASE WHEN b.o_orderkey IS NULL THEN 1 ELSE 2 END AS changed,
               CASE WHEN b.o_orderkey IS NULL THEN a.f ELSE b.f END AS flags,
               CASE WHEN b.o_orderkey IS NULL THEN a.s ELSE b.s END AS statuses
        FROM a FULL JOIN b ON a.o_orderkey = b.o_orderkey AND a.order_date = b.order_date)
    SELECT md5(concat_ws('-', coalesce(CAST(order_date AS VARCHAR), 'EMPTY'),
                         CAST(o_orderkey AS VARCHAR), priority)) AS id,
           order_date, CAST(o_orderkey AS VARCHAR) AS customer, priority, price,
           CAST(cust AS INT) AS size,
           CASE WHEN cust > 0 THEN round(price / pow(cust / 100::DOUBLE, 2), 1) END AS ratio,
           TIMESTAMP '2025-12-31 00:00:00' + made * INTERVAL 1 DAY AS created_at,
           TIMESTAMP '2025-12-31 00:00:00' + changed * INTERVAL 1 DAY AS updated_at,
           CASE WHEN order_date IS NOT NULL THEN flags END AS flags,
           CASE WHEN order_date IS NOT NULL THEN statuses END AS statuses
    FROM rows
    """,
)
def b2_clean_reload(spark, sf_dir):
    """Two runs of the clean job. Undated orders match nothing, so they are added again;
    their lines cannot be placed in a day and are left out."""
    return _with_lists(spark, _two_batches(spark, sf_dir))


@query(
    "k2_clean_counts",
    f"""
    {_BATCHES},
    runs AS (SELECT '2026-01-01' AS ds, price, order_date, children FROM first
             UNION ALL SELECT '2026-01-02', price, order_date, children FROM second)
    SELECT ds, count(*) + 1 AS total_rows, count(*) FILTER (WHERE {_FITS}) AS valid_rows,
           count(*) FILTER (WHERE NOT {_FITS}) + 1 AS invalid_rows,
           round((count(*) FILTER (WHERE NOT {_FITS}) + 1) / (count(*) + 1)::DOUBLE * 100, 2)
               AS error_percent,
           CAST(1 AS BIGINT) AS corrupt_rows,
           CAST(coalesce(sum(2 * children) FILTER (WHERE {_FITS} AND order_date IS NULL), 0)
                AS BIGINT) AS undated_children
    FROM runs GROUP BY ds
    """,
)
def k2_clean_counts(spark, sf_dir):
    """What the two runs stored about themselves: each had one broken record."""
    job = _two_batches(spark, sf_dir)
    return read_metrics_history(spark, job.metrics)


@query(
    "k3_stopped_run",
    """
    SELECT '2026-01-01' AS ds, count(*) AS total_rows,
           count(*) FILTER (WHERE o_totalprice BETWEEN 5000 AND 100000) AS valid_rows,
           count(*) FILTER (WHERE NOT o_totalprice BETWEEN 5000 AND 100000) AS invalid_rows,
           round(count(*) FILTER (WHERE NOT o_totalprice BETWEEN 5000 AND 100000)
                 / count(*)::DOUBLE * 100, 2) AS error_percent,
           CAST(0 AS BIGINT) AS corrupt_rows, CAST(0 AS BIGINT) AS undated_children,
           CAST(0 AS BIGINT) AS rows_loaded,
           count(*) FILTER (WHERE NOT o_totalprice BETWEEN 5000 AND 100000) AS quarantined
    FROM orders
    """,
)
def k3_stopped_run(spark, sf_dir):
    """A run that the gate stops, twice: its metrics and rejected rows are stored once."""
    raw = prepare_orders(spark, sf_dir)
    job = _clean_job(work_dir(spark, "stopped"), most=100000)
    for _ in range(2):
        try:
            _load(spark, job, raw, "2026-01-01", RUN_TS)
        except QualityGateError:
            pass
    loaded = job.clean.read(spark).agg(F.count("*").alias("rows_loaded"))
    rejected = read_quarantine(spark, job.quarantine).groupBy("ds").agg(F.count("*").alias("quarantined"))
    stored = read_metrics_history(spark, job.metrics).join(rejected, "ds")
    return stored.withColumn("rows_loaded", F.lit(loaded.first()[0]).cast("bigint"))


@query(
    "d1_mart",
    f"""
    WITH mark AS (SELECT max(o_orderdate) AS m FROM orders
                  WHERE o_orderdate < TIMESTAMP '{LOADED_UNTIL}'),
    later AS (
        SELECT *, CASE WHEN o_orderstatus = 'O' THEN o_orderdate + INTERVAL 365 DAY
                       ELSE o_orderdate END AS corrected_at
        FROM orders CROSS JOIN mark)
    SELECT o_orderkey AS id, o_orderdate AS order_date,
           CASE WHEN corrected_at > m THEN o_totalprice + 1 ELSE o_totalprice END AS price,
           CASE WHEN corrected_at > m THEN corrected_at ELSE o_orderdate END AS updated_at,
           CAST(date_trunc('month', o_orderdate) AS DATE) AS event_month
    FROM later
    """,
)
def d1_mart(spark, sf_dir):
    """A mart loaded up to a date, then advanced: open orders were corrected a year after
    they were placed, and those corrections replace the rows the mart already has."""
    path = work_dir(spark, "orders-mart")
    orders = load(spark, sf_dir, "orders")
    price, date = F.col("o_totalprice"), F.col("o_orderdate")
    plain = [F.col("o_orderkey").alias("id"), date.alias("order_date")]
    before = orders.filter(date < F.lit(LOADED_UNTIL).cast("timestamp_ntz")).select(
        *plain, price.alias("price"), date.alias("updated_at")
    )
    later = date + F.expr("INTERVAL '365' DAY")
    after = orders.select(
        *plain,
        (price + 1).alias("price"),
        F.when(F.col("o_orderstatus") == "O", later).otherwise(date).alias("updated_at"),
    )
    for curated in (before, after):
        run_mart(curated, path, "order_date", ["id"], ["id", "order_date", "updated_at"])
    schema = T.StructType([*after.schema.fields, T.StructField("event_month", T.DateType())])
    return read_mart(spark, path, schema, ["event_month", "id"])


@query(
    "d1_mart_undated",
    f"""
    SELECT o_orderkey AS id, order_date, o_totalprice AS price, o_orderdate AS updated_at,
           CAST(date_trunc('month', order_date) AS DATE) AS event_month,
           (SELECT count(*) FROM orders WHERE o_orderpriority = '5-LOW') AS reported
    FROM (SELECT *, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderdate END AS order_date
          FROM orders)
    """,
)
def d1_mart_undated(spark, sf_dir):
    """Rows without a date are reported by the run that appends them, and keep no newer
    rows out: each of two runs appends its rows."""
    path = work_dir(spark, "undated-mart")
    dated = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderdate"))
    orders = load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), dated.alias("order_date"),
        F.col("o_totalprice").alias("price"), F.col("o_orderdate").alias("updated_at"),
    )
    before = orders.filter(F.col("updated_at") < F.lit(LOADED_UNTIL).cast("timestamp_ntz"))
    reported = 0
    for curated in (before, orders):
        try:
            run_mart(curated, path, "order_date", ["id"], ["id", "order_date", "updated_at"])
        except NotNullError as error:
            reported += int(str(error).removeprefix("order_date: "))
    schema = T.StructType([*orders.schema.fields, T.StructField("event_month", T.DateType())])
    rows = read_mart(spark, path, schema, ["event_month", "id"])
    return rows.withColumn("reported", F.lit(reported).cast("bigint"))


@query(
    "m4_ref_load",
    """
    SELECT CAST(coalesce(c_custkey, s_suppkey) AS INT) AS id, coalesce(c_name, s_name) AS name
    FROM supplier FULL JOIN customer ON c_custkey = s_suppkey
    """,
)
def m4_ref_load(spark, sf_dir):
    """A directory first filled with suppliers, then loaded with customers by id."""
    root = work_dir(spark, "directory")
    schema = T.StructType.fromDDL("id int NOT NULL, name string NOT NULL")
    directory = Table(f"{root}/directory", schema, keys=("id",))
    for name, prefix in (("supplier", "s_supp"), ("customer", "c_cust")):
        rows = load(spark, sf_dir, name).select(
            F.col(f"{prefix}key").alias("id"), F.col(f"{name[0]}_name").alias("name")
        )
        rows.write.option("header", True).option("sep", ";").csv(f"{root}/{name}")
        load_reference(spark, f"{root}/{name}", directory)
    return directory.read(spark)


@query(
    "v1_visits",
    f"""
    WITH visits AS (
        SELECT *, date_trunc('second', ts) AS moment, CAST(user_id % 100 AS INT) AS age,
               CAST(150 + user_id % 40 AS INT) AS height, CAST(40 + user_id % 50 AS FLOAT) AS weight
        FROM events WHERE user_id % 100 <= 96)
    SELECT md5(concat_ws('-', strftime(moment, '%Y-%m-%d %H:%M:%S'), CAST(event_id AS VARCHAR),
                         event_type)) AS id,
           moment AS visit_date, age, CAST(user_id % 2 + 1 AS INT) AS gender_id,
           CAST(user_id AS INT) AS profession_id, CAST(event_id % 200 AS INT) AS doctor_id,
           CAST(user_id % 30 AS INT) AS department_id, CAST(event_id AS VARCHAR) AS snils,
           height, weight,
           CAST(round(weight / pow(height / 100::DOUBLE, 2), 1) AS FLOAT) AS bmi,
           CAST(36.6 AS FLOAT) AS temperature, CAST(NULL AS INT) AS bp_systolic,
           CAST(NULL AS INT) AS bp_diastolic, event_type AS disease_code,
           CAST(NULL AS VARCHAR) AS blood_type, CAST(value AS FLOAT) AS lab_hemoglobin,
           CAST(NULL AS FLOAT) AS lab_leukocytes, CAST(NULL AS FLOAT) AS lab_glucose,
           CAST(NULL AS FLOAT) AS lab_cholesterol,
           CASE WHEN event_type > 'p' THEN event_type || ',x' ELSE 'a,' || event_type END
               AS symptoms_list,
           CASE WHEN user_id % 2 = 0 THEN event_type END AS chronic_list,
           n_name AS department_name, c_name AS profession_name,
           {_NOW} AS created_at, {_NOW} AS updated_at,
           CAST(date_trunc('month', moment) AS DATE) AS event_month
    FROM visits LEFT JOIN nation ON n_nationkey = user_id % 30
    LEFT JOIN customer ON c_custkey = user_id
    """,
)
def v1_visits(spark, sf_dir):
    return run_visits(spark, prepare_visits(spark, sf_dir))


def prepare_visits(spark, sf_dir) -> str:
    """Raw files in which events are the visits, customers the professions and nations the
    departments."""
    root = work_dir(spark, "visits")
    for name, key, label in (("nation", "n_nationkey", "n_name"), ("customer", "c_custkey", "c_name")):
        rows = load(spark, sf_dir, name).select(F.col(key).alias("id"), F.col(label).alias("name"))
        rows.write.option("header", True).option("sep", ";").csv(f"{root}/{name}")
    user, kind = F.col("user_id"), F.col("event_type")
    visits = load(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("visit_date"),
        (user % 100).alias("age"),
        (user % 2 + 1).alias("gender_id"),
        user.alias("profession_id"),
        (F.col("event_id") % 200).alias("doctor_id"),
        (user % 30).alias("department_id"),
        F.col("event_id").cast("string").alias("snils"),
        (user % 40 + 150).alias("height"),
        (user % 50 + 40).alias("weight"),
        F.lit(36.6).alias("temperature"),
        kind.alias("disease_code"),
        F.col("value").alias("lab_hemoglobin"),
        F.array(kind, F.when(kind > "p", "x").otherwise("a")).alias("symptoms_code"),
        F.when(user % 2 == 0, F.array(kind)).otherwise(F.array()).alias("chronic_diseases"),
    )
    visits.write.json(f"{root}/raw/2026-01-01")
    return root


def run_visits(spark, root: str):
    """Every layer of the visit tables, up to the mart."""
    visits = Visits(work_dir(spark, "visit-tables"), rules=visit_rules(ages=(0, 96)))
    visits.load_references(spark, f"{root}/nation", f"{root}/customer")
    visits.load_raw(spark, f"{root}/raw", "2026-01-01", RUN_TS)
    visits.advance_curated(spark, RUN_TS)
    visits.advance_mart(spark)
    lists = {c: F.array_join(c, ",") for c in ("symptoms_list", "chronic_list")}
    return visits.read_mart(spark).withColumns(lists)
