"""A training corpus from raw documents, stage by stage; each stage's rows are the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewloom.llm import quality
from viewloom.llm.decontaminate import clean_documents
from viewloom.llm.mixing import mixed_documents
from viewloom.llm.near_dedup import one_of_each
from viewloom.llm.secret_scan import mask_secrets
from viewloom.llm.shared import Staging

#: Stages send texts to Python in batches of about so many bytes, unless the session sets another size. Spark's own 64 MiB
#: are buffers outside the heap, of which the allocator of each task thread keeps some from stage to stage.
BATCH_BYTES = 4 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

#: Gradient-boosted trees, minhash groups and decoding layers have no SQL; tests compare with plain forms.
ORACLE_SQL = None


def _bounded_batches(spark: SparkSession) -> None:
    if BATCH_SETTING not in spark.conf.getAll:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learnt from the labels of documents not held out, does not reject."""
    _bounded_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep_good(docs.select(*COLUMNS), quality.train(docs, labels), threshold=0.3)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id."""
    _bounded_batches(spark)
    return one_of_each(docs.select(*COLUMNS), percent=85)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold less of the benchmark's passages than would contaminate them."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return clean_documents(docs.select(*COLUMNS), benchmark, window=13, one_in=20)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked; n_chars follows the text."""
    _bounded_batches(spark)
    masked = mask_secrets(docs.select(*COLUMNS), "[secret]")
    return masked.withColumn("n_chars", F.length("text").cast("long"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with the number of copies of each."""
    return mixed_documents(docs.select(*COLUMNS), weights=(1, 2, 3), most=3)


STAGES = [
    ("quality classifier", quality_classifier),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("secret scans", secret_scan),
    ("mixing sources to target weights", mixing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; what each returns is written and read again."""
    staging = Staging(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staging.write(stage(spark, docs, sf_dir), name.split()[0])
    return docs
