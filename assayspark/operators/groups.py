"""Rankings, shares, frequent keys, and choices on small curves."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from assayspark.session import numbered


def ranked(df: DataFrame, value: str) -> Column:
    """The value to rank by: NaN counts as null, which ranks last."""
    c = F.col(value)
    return F.when(~F.isnan(c), c) if dict(df.dtypes)[value] in ("double", "float") else c


def top_n(df: DataFrame, value: str, n: int, ties: Sequence[str]) -> DataFrame:
    """The n rows with the largest value; each task keeps n rows."""
    return df.orderBy(ranked(df, value).desc_nulls_last(), *ties).limit(n)


def sort_desc(df: DataFrame, value: str, ties: Sequence[str]) -> DataFrame:
    return df.orderBy(ranked(df, value).desc_nulls_last(), *ties)


def sort_abs(df: DataFrame, value: str, ties: Sequence[str]) -> DataFrame:
    return df.orderBy(F.abs(ranked(df, value)).desc_nulls_last(), *ties)


def numbered_rows(ordered: DataFrame, rank: str = "rank") -> DataFrame:
    """A sorted table with each row's place from 1: tasks of the sort count their own rows, so no task gets them all."""
    return numbered(ordered, rank).withColumn(rank, F.col(rank) + 1)


def top_n_per_group(
    df: DataFrame, by: Sequence[str], value: str, n: int, ties: Sequence[str], rank: str = "rank"
) -> DataFrame:
    """The n rows with the largest value of every group, with their rank.

    The rank filter sits directly on the window, so each task keeps n rows per group before the
    shuffle and a hot group sends no more than that.
    """
    order = Window.partitionBy(*by).orderBy(ranked(df, value).desc_nulls_last(), *ties)
    rows = df.na.drop("any", subset=list(by))
    return rows.withColumn(rank, F.row_number().over(order)).where(F.col(rank) <= n)


def sorted_keys(df: DataFrame, by: str) -> DataFrame:
    return df.select(by).na.drop().distinct().orderBy(by)


def share_of_total(sizes: DataFrame, count: str = "n") -> DataFrame:
    """Add `percent` of the whole; the total is a scalar subquery, not a one-partition window."""
    total = sizes.agg(F.sum(count).alias("t")).scalar()
    return sizes.withColumn("percent", F.lit(100.0) * F.col(count) / total)


def share_of_group(df: DataFrame, by: Sequence[str], key: str) -> DataFrame:
    """Rows per (group, key) and percent of the group.

    The totals are a second, partial aggregation of the counts and come back in a join, so the keys
    of a group are never gathered in one task.
    """
    sizes = df.na.drop("any", subset=list(by)).groupBy(*by, key).agg(F.count("*").alias("n"))
    totals = sizes.groupBy(*by).agg(F.sum("n").alias("_total"))
    return sizes.join(totals, list(by)).withColumn("percent", F.lit(100.0) * F.col("n") / F.col("_total")).drop("_total")


def frequent_keys(df: DataFrame, key: str, n: int = 10) -> DataFrame:
    """The n most frequent keys; the empty key takes part in the cut and is dropped after it."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count("*").alias("n"))
        .orderBy(F.col("n").desc(), key)
        .limit(n)
        .where(F.col(key) != "")
    )


def frequent_keys_per_group(df: DataFrame, by: str, key: str, n: int = 5) -> DataFrame:
    """The n most frequent keys of every group with percent of the group; the empty key as above."""
    rows = df.where(F.col(by).isNotNull())
    sizes = rows.where(F.col(key).isNotNull()).groupBy(by, key).agg(F.count("*").alias("n"))
    totals = rows.groupBy(by).agg(F.count("*").alias("_total"))
    order = Window.partitionBy(by).orderBy(F.col("n").desc(), key)
    top = sizes.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= n)
    return (
        top.where(F.col(key) != "")
        .join(totals, by)
        .select(by, key, "n", (F.lit(100.0) * F.col("n") / F.col("_total")).alias("percent"))
    )


def elbow(curve: DataFrame, k: str = "k", cost: str = "inertia") -> DataFrame:
    """First inner k whose drop from k-1 is more than twice the drop to k+1; 0 if there is none.

    The curve has one row per k, so one partition holds it.
    """
    w = Window.orderBy(k)
    before = F.lag(cost).over(w) - F.col(cost)
    after = F.col(cost) - F.lead(cost).over(w)
    return (
        curve.select(F.col(k), before.alias("before"), after.alias("after"))
        .agg(F.coalesce(F.min(F.when(F.col("before") > 2 * F.col("after"), F.col(k))), F.lit(0)).cast("int").alias("elbow"))
    )


def best_k(curve: DataFrame, k: str = "k", score: str = "silhouette") -> DataFrame:
    """The k of the largest score, ties to the smallest k; null and NaN scores don't count."""
    return curve.where(ranked(curve, score).isNotNull()).agg(
        F.max_by(k, F.struct(F.col(score), -F.col(k))).cast("int").alias("best_k")
    )
