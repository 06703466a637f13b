"""A training-data pipeline of five stages; each is written as Parquet and read again by the next."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from wordmill.llm import bpe, decontam, exact_dedup, langid, simhash
from wordmill.session import ensure_checkpoint_dir, load_table


#: Texts travel between Spark and Python in Arrow batches of this size where the session leaves Spark's 64 MB.
BATCH_BYTES = "8m"
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def _in_small_batches(docs: DataFrame) -> DataFrame:
    """``docs``; its session's tasks hold a few MB of texts at once rather than 10,000 rows."""
    conf = docs.sparkSession.conf
    if conf.get(_BATCH_CONF, "67108864b") in ("67108864b", "64m", "64MB"):
        conf.set(_BATCH_CONF, BATCH_BYTES)
    return docs


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or that fit their likeliest language worse than held-out texts do, go."""
    return langid.drop_rejected(_in_small_batches(docs))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the largest doc_id stays."""
    return exact_dedup.drop_exact_duplicates(_in_small_batches(docs))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of fingerprints (3-word shingles, 2 bits) the smallest doc_id stays."""
    return simhash.drop_near_duplicates(_in_small_batches(docs), width=3, radius=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontam.drop_contaminated(_in_small_batches(docs), load_table(spark, sf_dir, "benchmark"))


def bpe_codes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the encoded and decoded text."""
    return bpe.round_trip(_in_small_batches(docs), public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("language_id", language_id), ("exact_dedup", exact_dedup_stage), ("simhash_dedup", simhash_dedup),
          ("decontamination", decontamination), ("bpe", bpe_codes)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; between stages the rows go through the shared folder."""
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = load_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{k}-{name}")
            docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return docs


#: The first stage learns models and runs EM, which SQL can't express; tests hold stages against brute force.
ORACLE_SQL = None
