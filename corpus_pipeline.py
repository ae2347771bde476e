"""A training corpus from raw documents, stage by stage.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor kept.
All but the last return the columns of ``documents``. ``run`` applies them one after the
other, writing what each returns to the shared folder and reading it again.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.files import Files
from tidemark.llm.decontaminate import drop_contaminated, find_contamination
from tidemark.llm.jaccard import jaccard_groups
from tidemark.llm.language import identify, learn_profiles
from tidemark.llm.mixing import mix
from tidemark.llm.sharding import shard
from tidemark.staging import scratch, staged, work_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language; null texts and texts without a letter go.

    The profiles are learned from all documents that name their language. Short texts of
    low score stay: a score tells languages apart, not good texts from bad ones. So do
    texts with letters when no document names its language, or when one is named ``und``.
    """
    found = identify(docs, learn_profiles(docs), flag="__letters")
    return found.filter("__letters").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of copies and near copies the document with the least id.

    Rows that repeat that id are reduced to one of equal text.
    """
    groups = jaccard_groups(docs).groupBy("doc_id").agg(
        F.bool_or(F.col("doc_id") != F.col("component_id")).alias("gone"), (F.count(F.lit(1)) > 1).alias("repeated")
    )
    # Written, so that Spark knows its size and need not move the texts when it is small.
    fate = staged(groups.filter("gone or repeated").withColumnRenamed("doc_id", "__id"), "fate")
    rows = docs.join(fate, F.col("doc_id").eqNullSafe(F.col("__id")), "left").filter("not coalesce(gone, false)")
    repeated = F.coalesce("repeated", F.lit(False))
    single = rows.filter(~repeated).select(*docs.columns)
    return single.unionByName(rows.filter(repeated).select(*docs.columns).dropDuplicates(["doc_id", "text"]))


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item.

    Null and empty texts have no passage and stay. Without items all documents stay, and
    without documents there are none.
    """
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return drop_contaminated(find_contamination(docs, benchmark)).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it, to the nearest whole document.

    A source above its target loses documents, and one below it repeats them. Null sources
    are one source; documents without words, null texts among them, are not taken. Rows that
    share an id are repeated alike. Without documents there are none.
    """
    mixed = mix(docs).select(
        F.col("doc_id").alias("__id"), F.when(F.col("size") > 0, F.round(F.col("taken") / F.col("size"))).cast("int").alias("__times")
    )
    times = mixed.groupBy("__id").agg(F.max("__times").alias("__times")).filter("__times > 0")
    rows = docs.join(times, F.col("doc_id").eqNullSafe(F.col("__id")))
    return rows.withColumn("__copy", F.explode(F.sequence(F.lit(1), "__times"))).select(*docs.columns)


def deal_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with the shard and slot that each is written to.

    Null texts weigh nothing and are dealt like others. Without documents there are no rows.
    """
    return shard(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language", identify_language),
    ("near_copies", drop_near_copies),
    ("benchmark", drop_benchmark_leaks),
    ("mix", mix_sources),
    ("shards", deal_shards),
]

#: SQL can neither bundle hyperdimensional vectors nor pack bins; a test compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sharded corpus. Each stage's documents are written, and removed when those of the
    next are there; the last stage reads what the one before it left."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        folder = work_dir(spark, name)
        with scratch(spark, f"{name}-parts"):
            docs = staged(stage(spark, docs, sf_dir), name, folder=folder)
        if before:
            Files(spark, before).delete()
        before = folder
    return STAGES[-1][1](spark, docs, sf_dir)
