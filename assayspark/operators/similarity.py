"""Nearest training neighbour by Tanimoto similarity of on-bit sets.

Equal fingerprints are collapsed first. Two sets can only reach similarity t if they share a bit
among the first a - ceil(t a) + 1 of their a bits in a common order; with the rarest bits first,
few sets share one. A bit that many training sets share is split into chunks of bounded size. Sets are
compared as packed words by counting common bits, and the pairs that reach the threshold are reduced to
the best neighbour per query within the task, before anything is shuffled.

Where bits are so common that this would meet about as many pairs as there are, blocks of sets are compared
whole, as arrays, size by size: sizes too far apart are passed over, and between two sizes the most common bits win.
Both ways are exact and give the same rows.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from assayspark.functions.literals import numbers
from assayspark.session import settle

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # tasks need numpy and Arrow but not this package

# Sets per bit and chunk.
CHUNK = 10_000

# A pair met by a shared bit costs about as much as this many in blocks.
JOINED_COST = 8
BLOCK_ROWS = 1 << 15
TILE = 1 << 18  # pairs compared at once


def tanimoto(common: Column, a: Column, b: Column) -> Column:
    return F.try_divide(common, a + b - common)


def packed(bits: Column, n_bits: int) -> Column:
    """On-bits as whole numbers of 64 bits each."""

    def word(w: Column) -> Column:
        own = F.filter(bits, lambda b: F.floor(b / 64) == w)
        one = F.lit(1).cast("bigint")
        return F.aggregate(own, F.lit(0).cast("bigint"), lambda acc, b: acc.bitwiseOR(F.call_function("shiftleft", one, (b % 64).cast("int"))))

    return F.transform(F.sequence(F.lit(0), F.lit((n_bits - 1) // 64)), word)


def _by_rarity(bits: Column, frequency: list[int]) -> Column:
    """The bits in ascending (frequency, bit)."""
    counts = numbers(frequency, "bigint")
    ranked = F.transform(F.array_distinct(bits), lambda b: F.struct(F.get(counts, b).alias("f"), b.alias("b")))
    return F.transform(F.sort_array(ranked), lambda r: r["b"])


def _prefix(ordered: Column, threshold: float) -> Column:
    # The small slack keeps sets whose bound is a whole number up to rounding.
    size = F.size(ordered)
    return F.slice(ordered, 1, size - F.ceil(size * threshold - 1e-9).cast("int") + 1)


def _per_bit(prefixes: DataFrame) -> dict[int, int]:
    """Sets by bit; at most n_bits counts are read back."""
    return {r["bit"]: r["count"] for r in prefixes.groupBy("bit").count().collect()}


def _chunks(counts: dict[int, int], n_bits: int, chunk: int) -> Column:
    """Number of chunks of the row's bit."""
    parts = [1] * n_bits
    for bit, n in counts.items():
        parts[bit] = -(-n // chunk)
    return F.get(numbers(parts, "int"), F.col("bit"))


def _tasks(df: DataFrame) -> int:
    """Comparing sets costs far more than moving them: small partitions must not be merged."""
    spark = df.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def _words(column: pa.Array) -> np.ndarray:
    """Packed sets, a row of whole numbers a word."""
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    return np.ascontiguousarray(flat.reshape(len(column), -1).T)


def _runs(sorted_sizes: np.ndarray) -> list[tuple[int, int, int]]:
    """(size, first, last) of the runs of equal sizes."""
    at = np.flatnonzero(np.diff(sorted_sizes, prepend=-1, append=-1))
    return [(int(sorted_sizes[i]), int(i), int(j)) for i, j in zip(at[:-1], at[1:])]


def _in_blocks(left: DataFrame, right: DataFrame, threshold: float, asked: int, known: int) -> DataFrame:
    """(q, similarity, neighbour): the best of every block of training sets for each query that reaches the threshold.

    left: q, a; right: t, b, neighbour. A task holds a block of either side."""
    tasks = _tasks(left)
    least = math.isqrt(4 * tasks) + 1  # blocks a side, so that all tasks have work
    parts = [max(-(-n // BLOCK_ROWS), min(least, -(-n // 64)), 1) for n in (asked, known)]
    keys = ["left_part", "right_part"]

    def dealt(rows: DataFrame, words: str, own: int) -> DataFrame:
        rows = rows.withColumn(keys[own], F.pmod(F.xxhash64(words), F.lit(parts[own])).cast("int"))
        rows = rows.withColumn(keys[1 - own], F.explode(F.sequence(F.lit(0), F.lit(parts[1 - own] - 1))))
        return rows.repartition(max(tasks, min(parts[0] * parts[1], 8 * tasks)), *keys).groupBy(*keys)

    def compare(queries: pa.Table, training: pa.Table) -> pa.Table:
        queries = queries.take(pc.sort_indices(queries, [("a", "ascending")]))
        # of one size the smallest neighbour comes first
        training = training.take(pc.sort_indices(training, [("b", "ascending"), ("neighbour", "ascending")], null_placement="at_start"))
        place = np.empty(len(training), np.int64)
        place[pc.sort_indices(training, [("neighbour", "ascending")], null_placement="at_start").to_numpy()] = np.arange(len(training))
        q, t = (_words(x.column(c)) if len(x) else np.zeros((0, 0), np.uint64) for x, c in ((queries, "q"), (training, "t")))
        best, found = np.full(len(queries), -1.0), np.full(len(queries), -1)
        sizes = _runs(training.column("b").to_numpy())
        for a, q0, q1 in _runs(queries.column("a").to_numpy()):
            for b, t0, t1 in sizes:
                if min(a, b) < max(a, b) * threshold - 1e-6:
                    continue
                for u in range(t0, t1, 1 << 12):
                    v = min(t1, u + (1 << 12))
                    step = max(1, TILE // (v - u))
                    for x in range(q0, q1, step):
                        y = min(q1, x + step)
                        common = np.bitwise_count(q[0, x:y, None] & t[0, u:v])
                        if len(q) > 1:
                            common = common.astype(np.uint16 if 64 * len(q) < 1 << 16 else np.uint32)
                            for w in range(1, len(q)):
                                common += np.bitwise_count(q[w, x:y, None] & t[w, u:v])
                        at = common.argmax(axis=1)
                        most = common[np.arange(y - x), at].astype(np.int64)
                        score, at = most / (a + b - most), at + u
                        old = found[x:y]
                        better = (score > best[x:y]) | ((score == best[x:y]) & (place[at] < place[old]))
                        best[x:y] = np.where(better, score, best[x:y])
                        found[x:y] = np.where(better, at, old)
        hit = np.flatnonzero((best >= threshold) & (found >= 0))
        return pa.table({"q": queries.column("q").take(pa.array(hit)), "similarity": pa.array(best[hit]), "neighbour": training.column("neighbour").take(pa.array(found[hit]))})

    schema = f"q array<bigint>, similarity double, neighbour {dict(right.dtypes)['neighbour']}"
    return dealt(left, "q", 0).cogroup(dealt(right, "t", 1)).applyInArrow(compare, schema)


def nearest_neighbours(
    queries: DataFrame,
    training: DataFrame,
    threshold: float,
    n_bits: int,
    query_id: str = "id",
    training_id: str = "id",
    bits: str = "bits",
    chunk: int = CHUNK,
) -> DataFrame:
    """Per query (id, neighbour, similarity, in_domain).

    `similarity` and `neighbour` (the smallest id of the best) are given where some training set
    reaches the threshold, and `in_domain` says whether one does.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be above 0 and at most 1")
    known = settle(
        training.where(F.size(bits) > 0)
        .groupBy(F.sort_array(F.array_distinct(bits)).alias("_t"))
        .agg(F.min(training_id).alias("neighbour"))
        .withColumn("t", packed(F.col("_t"), n_bits)),
        "training",
    )
    asked = settle(
        queries.select(F.col(query_id).alias("id"), F.sort_array(F.array_distinct(bits)).alias("_q")).withColumn(
            "q", packed(F.col("_q"), n_bits)
        ),
        "queries",
    )

    frequency = [0] * n_bits
    for bit, n in known.select(F.explode("_t").alias("b")).groupBy("b").count().collect():  # at most n_bits rows
        frequency[bit] = n

    def prefixes(rows: DataFrame, own: str, words: str, size: str, place: str, *keep: str) -> DataFrame:
        ordered = rows.select(words, F.size(own).alias(size), _prefix(_by_rarity(F.col(own), frequency), threshold).alias("_p"), *keep)
        return ordered.select(words, size, F.posexplode("_p").alias(place, "bit"), *keep)

    right = prefixes(known, "_t", "t", "b", "j", "neighbour")
    left = prefixes(asked.where(F.size("_q") > 0).select("_q", "q").distinct(), "_q", "q", "a", "i")

    left_counts, right_counts = _per_bit(left), _per_bit(right)
    sets = asked.where(F.size("_q") > 0).select("q", F.size("_q").alias("a")).distinct()
    n_asked, n_known = sets.count(), known.count()
    met = sum(n * right_counts.get(bit, 0) for bit, n in left_counts.items())
    if met * JOINED_COST > n_asked * n_known:
        pairs = _in_blocks(sets, known.select("t", F.size("_t").alias("b"), "neighbour"), threshold, n_asked, n_known)
    else:
        pairs = _by_bits(left, right, left_counts, right_counts, n_bits, threshold, chunk, _tasks(queries))
    best = (
        pairs.groupBy("q")
        .agg(F.min(F.struct((-F.col("similarity")).alias("away"), "neighbour")).alias("best"))
        .select("q", (-F.col("best.away")).alias("similarity"), "best.neighbour")
    )
    return asked.join(best, "q", "left").select(
        "id", "neighbour", "similarity", F.col("similarity").isNotNull().alias("in_domain")
    )


def _by_bits(
    left: DataFrame, right: DataFrame, left_counts: dict[int, int], right_counts: dict[int, int], n_bits: int, threshold: float, chunk: int, tasks: int
) -> DataFrame:
    """(q, similarity, neighbour) of the pairs that share a bit of their prefixes and reach the threshold.

    Both sides of a shared bit are cut into chunks, and every chunk meets every chunk of the other side."""
    left_parts, right_parts = _chunks(left_counts, n_bits, chunk), _chunks(right_counts, n_bits, chunk)
    keys = ["bit", "left_part", "right_part"]
    left = left.withColumn("left_part", F.pmod(F.hash("q"), left_parts)).withColumn(
        "right_part", F.explode(F.sequence(F.lit(0), right_parts - 1))
    ).repartition(tasks, *keys)
    right = right.withColumn("right_part", F.pmod(F.hash("t"), right_parts)).withColumn(
        "left_part", F.explode(F.sequence(F.lit(0), left_parts - 1))
    ).repartition(tasks, *keys)

    a, b, i, j = F.col("a"), F.col("b"), F.col("i"), F.col("j")
    # A pair has at most this bit and what is left of the shorter rest from its first common bit on; at a later one the
    # bound may drop it, as it was kept before. A pair met twice changes no minimum.
    most = F.least(a - i, b - j)
    needed = (a + b) * F.lit(threshold / (1 + threshold)) - F.lit(1e-9)
    common = F.aggregate(F.zip_with("q", "t", lambda x, y: F.bit_count(x.bitwiseAND(y))), F.lit(0), lambda acc, n: acc + n)
    return (
        left.join(right, keys)
        .where(most >= needed)
        .select("q", "neighbour", tanimoto(common, a, b).alias("similarity"))
        .where(F.col("similarity") >= threshold)
    )
