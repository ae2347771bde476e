"""Queries over the test tables, each with the SQL that gives the same rows."""

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# State of a target at its last load, and the first day its next batch delivers.
LOADED_UNTIL = "2000-01-01"
REDELIVERED_FROM = "1998-01-01"
RUN_TS = datetime(2026, 1, 1)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
