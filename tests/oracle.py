"""Runs a query and its SQL on the same tables and compares schema and rows."""

import datetime
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def _value(v):
    if isinstance(v, datetime.date) and not isinstance(v, datetime.datetime):
        return v.isoformat()
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted(([_value(r[i]) for i in order] for r in rows), key=_key)


def mismatch(spark, con, name, sf_dir):
    """None when both sides agree, else a short description."""
    df = entry.queries()[name](spark, sf_dir)
    names, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    wanted_names, wanted = rows_of(columns, result.fetchall())
    if names != wanted_names:
        return f"columns {names} != {wanted_names}"
    if len(got) != len(wanted):
        return f"{len(got)} rows != {len(wanted)} rows"
    different = [(a, b) for a, b in zip(got, wanted) if a != b]
    if different:
        return f"{len(different)} of {len(got)} rows differ, first {different[0]}"
    kinds = [
        (n, a, b)
        for n, a, b in zip(names, *map(_kinds, (got, wanted)))
        if a and b and a != b
    ]
    return f"types differ: {kinds}" if kinds else None


def _kinds(rows):
    width = len(rows[0]) if rows else 0
    return [
        {type(r[i]).__name__ for r in rows if r[i] is not None} for i in range(width)
    ]


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    sf_dir = sys.argv[1]
    wanted = sys.argv[2:] or list(entry.oracle_sql())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    for name in wanted:
        start = time.time()
        try:
            problem = mismatch(spark, con, name, sf_dir)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
            if os.environ.get("TRACE"):
                raise
        print(f"{name:20s} {time.time() - start:6.2f}s {problem or 'ok'}", flush=True)
