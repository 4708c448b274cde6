"""Exact quantiles by brackets: one path for groups of every size, and no task that holds or sorts a whole group.

A bounded sketch per group, merged by partial aggregation, brackets every wanted rank between two values. One more pass
counts the rows below each bracket and collapses those inside to distinct values; only they are put in order. A bracket
holds under a thousandth of a large group, and a group of at most `limit` rows is its own bracket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from assayspark.functions.activity import no_nan

# Rows up to which a group is its own bracket; results don't depend on it.
GROUP_LIMIT = 10_000
ACCURACY = 10_000


def values_of(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, _value) with null keys, null and NaN values dropped."""
    return df.select(*keys, no_nan(F.col(value).cast("double")).alias("_value")).na.drop("any")


def group_quantiles(
    df: DataFrame,
    keys: list[str],
    value: str,
    quantiles: dict[str, float],
    count: str | None = None,
    limit: int = GROUP_LIMIT,
    accuracy: int = ACCURACY,
) -> DataFrame:
    """Per group, linearly interpolated quantiles: {output column: fraction}. `keys` may be empty.

    Groups without values have no row.
    """
    fractions = [float(q) for q in quantiles.values()]
    # A sketch misses a rank by at most n / accuracy, and the wanted ranks lie within two of fraction * n.
    margin = 2 / accuracy + 2 / (limit + 1)
    ends = [e for q in fractions for e in (max(q - margin, 0.0), min(q + margin, 1.0))]
    by = keys or ["_all"]
    rows = values_of(df, keys, value) if keys else values_of(df, keys, value).withColumn("_all", F.lit(0))

    sketched = rows.groupBy(*by).agg(
        F.count("*").alias("_total"),
        F.min("_value").alias("_min"),
        F.max("_value").alias("_max"),
        F.percentile_approx("_value", F.array(*[F.lit(e) for e in ends]), F.lit(accuracy)).alias("_ends"),
    )

    def bracket(i: int) -> Column:
        whole = F.col("_total") <= limit
        low = F.when(whole | F.lit(ends[2 * i] <= 0), F.col("_min")).otherwise(F.get("_ends", F.lit(2 * i)))
        high = F.when(whole | F.lit(ends[2 * i + 1] >= 1), F.col("_max")).otherwise(F.get("_ends", F.lit(2 * i + 1)))
        at = F.lit(fractions[i]) * (F.col("_total") - 1)
        return F.struct(F.lit(i).alias("i"), low.alias("low"), high.alias("high"), at.alias("at"))

    brackets = sketched.select(*by, F.col("_total"), F.array(*[bracket(i) for i in range(len(fractions))]).alias("_brackets"))
    inside = F.exists("_brackets", lambda b: F.col("_value").between(b["low"], b["high"]))
    below = [F.sum((F.col("_value") < F.get("_brackets", F.lit(i))["low"]).cast("long")).alias(f"_b{i}") for i in range(len(fractions))]
    cells = (
        rows.join(brackets, by)
        .groupBy(*by, "_total", "_brackets", F.when(inside, F.col("_value")).alias("_value"))
        .agg(F.count("*").alias("_n"), *below)
    )
    group = Window.partitionBy(*by)
    before = F.array(*[F.sum(f"_b{i}").over(group) for i in range(len(fractions))])
    held = cells.withColumn("_before", before).where("_value is not null").select(
        *by, "_total", "_value", "_n", "_before", F.explode("_brackets").alias("_b")
    )
    held = held.where(F.col("_value").between(F.col("_b.low"), F.col("_b.high")))
    order = Window.partitionBy(*by, "_b.i").orderBy("_value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = F.get("_before", F.col("_b.i")) + F.sum("_n").over(order)
    at = F.col("_b.at")
    found = held.withColumn("_upto", upto).groupBy(*by, "_total", F.col("_b.i").alias("_i"), at.alias("_at")).agg(
        F.min(F.when(F.col("_upto") > F.floor(at), F.col("_value"))).alias("_low"),
        F.min(F.when(F.col("_upto") > F.ceil(at), F.col("_value"))).alias("_high"),
    )
    exact = F.col("_low") + (F.col("_high") - F.col("_low")) * (F.col("_at") - F.floor("_at"))
    out = found.groupBy(*by, "_total").agg(
        *[F.max(F.when(F.col("_i") == i, exact)).alias(name) for i, name in enumerate(quantiles)]
    )
    return out.select(*keys, *quantiles, *([F.col("_total").alias(count)] if count else []))


def approximate_quantiles(
    df: DataFrame, keys: list[str], value: str, quantiles: dict[str, float], accuracy: int = ACCURACY
) -> DataFrame:
    """Per group, quantiles from a bounded sketch; one shuffle of sketches, no exactness."""
    return values_of(df, keys, value).groupBy(*keys).agg(
        *[F.percentile_approx("_value", float(q), accuracy).alias(n) for n, q in quantiles.items()]
    )
