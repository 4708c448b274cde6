"""Feature tables: per-row functions, token counts, hashed bits, and their vector forms."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from assayspark.functions import molecule, structure as st
from assayspark.functions.literals import let
from assayspark.session import settle

Registry = dict[str, tuple[Callable[[str], object], str]]

_TYPES = {"double": DoubleType(), "int": IntegerType(), "bigint": LongType(), "string": StringType()}


def choose_features(
    registry: Registry, features: Sequence[str] | None, categories: dict[str, Sequence[str]] | None = None
) -> Registry:
    """The asked part of the registry, in the asked order; an unknown name raises.

    A name of `categories` stands for the features it lists.
    """
    if features is None:
        return registry
    named = [f for name in features for f in (categories or {}).get(name, [name])]
    unknown = [f for f in named if f not in registry]
    if unknown:
        raise ValueError(f"unknown features: {', '.join(unknown)}; there are: {', '.join(registry)}")
    return {f: registry[f] for f in named}


def feature_job(
    df: DataFrame,
    column: str,
    registry: Registry,
    features: Sequence[str] | None = None,
    keep_invalid: bool = False,
    categories: dict[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Add one column per registered function of `column`, computed in Arrow batches.

    `registry` maps a name to (function, type). A failure in a row nulls all its features, and rows
    with a null anywhere are dropped unless `keep_invalid`. Only `column` travels to Python.
    """
    chosen = choose_features(registry, features, categories)
    functions = [(name, fn) for name, (fn, _) in chosen.items()]
    schema = StructType([StructField(name, _TYPES[kind]) for name, (_, kind) in chosen.items()])

    def one(value: str) -> tuple:
        try:
            return tuple(fn(value) for _, fn in functions)
        except Exception:  # whatever a caller's function raises, the row is invalid
            return (None,) * len(functions)

    @F.pandas_udf(schema)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for values in batches:
            yield pd.DataFrame([one(v) for v in values], columns=schema.names)

    made = df.withColumn("_made", run(F.col(column))).select(*df.columns, "_made.*")
    return made if keep_invalid else made.na.drop("any")


def with_token_counts(df: DataFrame, structure: str = "structure") -> DataFrame:
    made = df.withColumn("_counts", st.token_counts(F.col(structure)))
    return made.select(*df.columns, "_counts.*")


def per_structure(df: DataFrame, structure: str, text: Column | None = None, **columns: Callable[[Column], Column]) -> DataFrame:
    """Add columns that follow from a structure's molecular graph, each made by a function of the graph.

    A structure is read once, however many rows have it: distinct texts are spread over all tasks and settled, and rows get
    their columns by a join that the runtime splits where one structure has very many rows. `text` is the part to be read.
    """
    spark = df.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    texts = df.where(F.col(structure).isNotNull()).select(F.col(structure).alias("_s"), (F.col(structure) if text is None else text).alias("_t"))
    texts = texts.distinct().repartition(4 * tasks, "_s")
    made = texts.select("_s", let(molecule.graph(F.col("_t")), lambda g: F.struct(*[f(g).alias(name) for name, f in columns.items()])).alias("_made"))
    made = settle(made, "structures")
    return df.join(made, F.col(structure) == F.col("_s"), "left").select(*df.columns, *[f"_made.{name}" for name in columns])


def with_hashed_bits(
    df: DataFrame, text: str = "structure", output: str = "bits", n_bits: int = 2048, window: int = 4, kind: str = "hashed"
) -> DataFrame:
    """Add the on-bits of every row; rows without any on-bit are dropped."""
    if kind != "hashed":
        raise ValueError(f"unknown kind of fingerprint: {kind}")
    return non_zero(df.withColumn(output, st.hashed_bits(F.col(text), n_bits, window)), output)


def non_zero(df: DataFrame, bits: str) -> DataFrame:
    return df.where(F.size(bits) > 0)


def dense_vector(values: Column) -> Column:
    """Array of numbers to a dense vector column."""
    return array_to_vector(values.cast("array<double>"))


def bits_to_vector(df: DataFrame, bits: str, output: str, n_bits: int) -> DataFrame:
    """On-bits to sparse 0/1 vectors of length n_bits, on the JVM and in bit order."""
    words = "_words"
    model = CountVectorizerModel.from_vocabulary(
        [str(i) for i in range(n_bits)], inputCol=words, outputCol=output, minTF=0.0
    ).setBinary(True)
    return model.transform(df.withColumn(words, F.col(bits).cast("array<string>"))).drop(words)


def vector_to_bits(vector: Column) -> Column:
    """Positions of the non-zero elements."""
    values = vector_to_array(vector)
    at = F.transform(values, lambda v, i: F.when(v != 0, i).otherwise(F.lit(-1)))
    return F.filter(at, lambda i: i >= 0)


def join_features(base: DataFrame, features: DataFrame, key: str) -> DataFrame:
    """Features to their base rows by key; rows without features are dropped."""
    return base.join(features, key)
