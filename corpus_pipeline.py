"""The corpus pipeline: five stages over documents, each written as Parquet and read again by the next.

Rejected documents go, of equal texts and of near copies one stays, sources are mixed to target weights, and what is
left is encoded. Every stage but the last returns the columns it was given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from assayspark.llm import exact_dedup, near_dedup, queries, quality_rules, source_mix
from assayspark.llm.common import small_batches
from assayspark.session import settle


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return quality_rules.keep_good(docs, queries.fitted_ratio(spark, sf_dir, docs))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return exact_dedup.keep_first(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return near_dedup.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return source_mix.mixed(docs, *queries.mix_columns(), plan=queries.MIX)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return queries.coded(docs)


STAGES = [
    ("quality_rules", quality),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("source_mix", mix),
    ("byte_bpe", encode),
]

ORACLE_SQL = None  # the quality ratio, the near-copy search and the encoder have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
