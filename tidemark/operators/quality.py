"""Row rules, quality metrics, the clean/rejected split and the quality gate."""

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import QualityGateError
from tidemark.functions.columns import run_clock
from tidemark.sources.readers import CORRUPT_COLUMN

ERRORS = "errors"


@dataclass(frozen=True)
class Rule:
    """A code, and the condition under which a row violates the rule.

    A condition that is null counts as not violated.
    """

    code: str
    violated: Callable[[DataFrame], Column]


def in_range(column: str, low: float, high: float, code: str) -> Rule:
    """Valid from ``low`` to ``high``, both included; null is valid, NaN is not.

    Against a float column the bounds are floats: 34.1 as a float is not 34.1 as a double.
    No other type narrows them: 0 is below a bound of 0.5 in a column of whole numbers.
    """

    def violated(df: DataFrame) -> Column:
        value = F.col(column)
        single = isinstance(df.schema[column].dataType, T.FloatType)
        least, most = (F.lit(b).cast("float") if single else F.lit(b) for b in (low, high))
        return (value < least) | (value > most)

    return Rule(code, violated)


def not_null(column: str, code: str) -> Rule:
    return Rule(code, lambda df: F.col(column).isNull())


def corrupt(code: str, column: str = CORRUPT_COLUMN) -> Rule:
    """The reader could not parse the record; holds for none if the column is absent."""
    return Rule(code, lambda df: F.col(column).isNotNull() if column in df.columns else F.lit(False))


def predicate(violated: str | Column, code: str) -> Rule:
    """Any condition, as a column or as SQL text."""
    return Rule(code, lambda df: F.expr(violated) if isinstance(violated, str) else violated)


def tag(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``errors``: the codes of the violated rules, in rule order."""
    slots = [F.when(rule.violated(df), F.lit(rule.code)) for rule in rules]
    codes = F.array_compact(F.array(*slots)) if slots else F.array().cast("array<string>")
    return df.withColumn(ERRORS, codes)


def quality_counts(tagged: DataFrame) -> list[Column]:
    """Total, valid, invalid and corrupt rows, to be aggregated, or observed while the rows
    are on their way to somewhere else."""
    broken = F.col(CORRUPT_COLUMN).isNotNull() if CORRUPT_COLUMN in tagged.columns else F.lit(False)
    bad = F.size(ERRORS) > 0
    return [
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(~bad).alias("valid_rows"),
        F.count_if(bad).alias("invalid_rows"),
        F.count_if(broken).alias("corrupt_rows"),
    ]


def quality_metrics(tagged: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Total, valid, invalid and corrupt rows and the error percent, in one aggregate.

    The percent rounds a tie up; a run takes the counts and rounds as ``QualityRecord`` says.
    """
    counted = tagged.groupBy(*by).agg(*quality_counts(tagged))
    share = F.col("invalid_rows").cast("double") / F.col("total_rows") * 100
    percent = F.when(F.col("total_rows") > 0, F.round(share, 2)).otherwise(F.lit(0.0))
    return counted.withColumn("error_percent", percent)


def clean_rows(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.size(ERRORS) == 0).drop(ERRORS)


def rejected_rows(tagged: DataFrame, run_ts: datetime | None = None) -> DataFrame:
    """Rejected rows keep their codes and get the time of the rejection."""
    now = run_clock(run_ts)
    return (
        tagged.filter(F.size(ERRORS) > 0)
        .withColumn("created_at", now)
        .withColumn("rejected_at", now)
    )


def gate(metrics: DataFrame, limit_percent: float) -> DataFrame:
    """Whether the rounded error percent stays within the limit."""
    limit = F.lit(float(limit_percent))
    return metrics.select(
        "error_percent",
        limit.alias("limit_percent"),
        (F.col("error_percent") <= limit).alias("passed"),
    )


def enforce_gate(metrics: Row, limit_percent: float) -> None:
    if metrics["error_percent"] > limit_percent:
        raise QualityGateError(
            f"{metrics['error_percent']:.2f}% of the rows were rejected, "
            f"{limit_percent}% are allowed"
        )


def error_counts(tagged: DataFrame) -> DataFrame:
    """Rows per violated rule."""
    return (
        tagged.select(F.explode(ERRORS).alias("code"))
        .groupBy("code")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls per checked column, one row each, from one aggregate."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot([], list(columns), "column_name", "null_rows")
