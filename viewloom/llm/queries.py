"""One query for each operator, over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewloom.llm import language, quality
from viewloom.llm.ann import nearest
from viewloom.llm.collocations import collocations
from viewloom.llm.decontaminate import contamination
from viewloom.llm.mixing import mix_sources
from viewloom.llm.near_dedup import near_duplicate_groups
from viewloom.llm.pivots import top_inner_products
from viewloom.llm.quotes import reply_conversations
from viewloom.llm.ranked_search import search
from viewloom.llm.secret_scan import KINDS, count_of, scan_secrets, spans
from viewloom.llm.substring_dedup import remove_repeated_passages
from viewloom.llm.suffix_dedup import remove_repeated_strings


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where("vec_id % 100 = 0"), k=10)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return language.predict(documents, language.train(documents))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_passages(table(spark, sf_dir, "documents"), window=50, with_text=False).drop("kept")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"), weights=(1, 2, 3), most=3).drop("doc", "key")


def op5_chat_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reply_conversations(table(spark, sf_dir, "conversations"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        *[count_of(kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(spans(base_only=True), 256).alias("base_sha256"),
        spans(base_only=False).alias("spans"),
    )


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_groups(table(spark, sf_dir, "documents"), percent=85)


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_strings(table(spark, sf_dir, "documents"), length=400, with_text=False).drop("kept")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return quality.score_quality(documents, quality.train(documents, table(spark, sf_dir, "labels")))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=13, one_in=20)


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"), least=30, longest=4, subsumed=80, most=2000)


def op13_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return top_inner_products(vectors, vectors.where("vec_id % 100 = 0"), k=10, scale=1024)


QUERIES = {
    "op1_ann": op1_ann,
    "op2_language_id": op2_language_id,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_mixing": op4_mixing,
    "op5_chat_quotes": op5_chat_quotes,
    "op6_secret_scan": op6_secret_scan,
    "op7_near_dedup": op7_near_dedup,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_quality": op9_quality,
    "op10_decontaminate": op10_decontaminate,
    "op11_ranked_search": op11_ranked_search,
    "op12_collocations": op12_collocations,
    "op13_exact_top_k": op13_exact_top_k,
}
