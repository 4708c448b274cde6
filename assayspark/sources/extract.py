"""Activity extracts: filtered scan, ordered limit, freshness-gated snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

EXTRACT_COLUMNS = ("molecule_id", "structure", "standard_value")


def activity_extract(
    table: DataFrame,
    target: str,
    measurement: str = "IC50",
    units: str = "nM",
    columns: tuple[str, ...] = EXTRACT_COLUMNS,
) -> DataFrame:
    """Rows of one target, measurement and unit; the three equalities reach a Parquet scan."""
    return table.where(
        (F.col("target") == target) & (F.col("standard_type") == measurement) & (F.col("units") == units)
    ).select(*columns)


def first_records(table: DataFrame, order: str, n: int) -> DataFrame:
    """The first n records in source order, `order` being a unique ordinal."""
    return table.orderBy(order).limit(n)


def fresh_rows(table: DataFrame, fetched_at: str, as_of: Column, days: int = 30) -> DataFrame:
    """Rows fetched less than `days` before `as_of`."""
    return table.where(
        (F.col(fetched_at) > as_of - F.expr(f"interval {int(days)} days")) & (F.col(fetched_at) <= as_of)
    )


def age_in_days(fetched_at: Column, as_of: Column) -> Column:
    """Age of a snapshot in days, with its fraction."""
    return (F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(fetched_at.cast("timestamp"))) / F.lit(86_400e6)


def latest_snapshot(
    table: DataFrame, keys: list[str], fetched_at: str, as_of: Column, days: int = 30
) -> DataFrame:
    """All rows of the newest fresh snapshot of every key (target, measurement, unit).

    The newest time per key is a partial aggregate, so a hot key costs one row per map task. The
    rows then meet that small table in a join which the runtime broadcasts or splits by size.
    """
    fresh = fresh_rows(table, fetched_at, as_of, days)
    newest = fresh.groupBy(*keys).agg(F.max(fetched_at).alias(fetched_at))
    return fresh.join(newest, [*keys, fetched_at], "left_semi")


def latest_by_key(table: DataFrame, keys: list[str], fetched_at: str, tie: str) -> DataFrame:
    """The newest single row of every key, ties broken by the larger `tie`."""
    newest = Window.partitionBy(*keys).orderBy(F.col(fetched_at).desc(), F.col(tie).desc())
    return table.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank")
