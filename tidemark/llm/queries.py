"""The training-data operators over the test tables, each with its production parameters."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import oracles, urls
from tidemark.llm.conversations import conversations_report, format_conversations
from tidemark.llm.decontaminate import contamination_report, find_contamination
from tidemark.llm.embeddings import near_duplicates
from tidemark.llm.jaccard import jaccard_groups
from tidemark.llm.language import identify, learn_profiles
from tidemark.llm.licenses import scan_licenses
from tidemark.llm.mixing import mix
from tidemark.llm.personal import find_personal, personal_report, train
from tidemark.llm.ranking import rank_documents
from tidemark.llm.secrets import scan_secrets, secrets_report
from tidemark.llm.sharding import shard, shard_report
from tidemark.llm.whitening import fit_whitening, whiten, whitening_report

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {
    "op1_near_duplicate_vectors": oracles.OP1,
    "op2_mix_sources": oracles.OP2,
    "op4_url_filter": oracles.OP4,
    "op6_jaccard_join": oracles.OP6,
    "op9_decontaminate": oracles.OP9,
    "op12_ranked_search": oracles.OP12,
}


def _query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets_report(scan_secrets(_table(spark, sf_dir, "documents").select("doc_id", "text")))


@_query
def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups(_table(spark, sf_dir, "documents"))


@_query
def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(_table(spark, sf_dir, "documents")).drop("source")


@_query
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.drop("text")


@_query
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 3 == 1
    docs = _table(spark, sf_dir, "documents").withColumn("held_out", held_out)
    profiles = learn_profiles(docs.filter("not held_out"))
    return identify(docs.select("doc_id", "held_out", "text"), profiles).drop("text")


@_query
def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return contamination_report(find_contamination(docs, _table(spark, sf_dir, "benchmark")))


@_query
def op8_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_report(shard(_table(spark, sf_dir, "documents").select("doc_id", "text")))


@_query
def op1_near_duplicate_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "embeddings"))


@_query
def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(urls.RULES), urls.RULE_SCHEMA)
    return urls.filter_urls(_table(spark, sf_dir, "pages").select("page_id", "url"), rules).drop("url")



@_query
def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return personal_report(find_personal(docs, train(docs)))


@_query
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@_query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return whitening_report(whiten(vectors, fit_whitening(vectors)))


@_query
def op11_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], given.schema)
    return conversations_report(format_conversations(given.unionByName(added)))
