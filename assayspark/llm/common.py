"""Small helpers of the operators: tables, row numbers, bounded label samples."""

from __future__ import annotations

import functools
import pickle
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Shared:
    """A value sent to every task once. It is pickled with its class, so tasks don't need this package."""

    def __init__(self, spark: SparkSession, value: object):
        self._sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    @property
    def value(self):
        return pickle.loads(self._sent.value)


BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Texts go to Python workers in batches of a few megabytes, so that a worker's memory stays bounded."""
    spark.conf.set(BATCH, "4m")


def query(name: str, sql: str | None = None) -> Callable:
    def register(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            small_batches(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def remainder(doc_id: str | Column, by: int) -> Column:
    """crc32 of the id as text, modulo `by`; a null id counts as empty text."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % by


def order_key(doc_id: str | Column, seed: str) -> Column:
    """A seeded order of ids as hex text: the same on any partitioning and in SQL."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(c.cast("string"), F.lit(""))).cast("binary"))


def bounded_ids(labels: DataFrame, doc_id: str, most: int, seed: str) -> DataFrame:
    """At most `most` distinct ids, the first in a seeded order: a table whose size is bounded by its parameter."""
    ids = labels.select(F.col(doc_id).alias("id")).where("id is not null").distinct()
    return ids.orderBy(order_key("id", seed), "id").limit(most)
