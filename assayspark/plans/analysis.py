"""Whole runs: from a raw extract to clusters, maps and reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from assayspark.operators import clean, cluster, features as ft
from assayspark.plans import reports
from assayspark.sources import extract


def compounds(
    raw: DataFrame, target: str, measurement: str = "IC50", units: str = "nM", limit: int | None = None, order: str = "ord"
) -> DataFrame:
    """(molecule_id, structure, p) of one target: extract, clean, collapse duplicates."""
    rows = extract.activity_extract(raw, target, measurement, units, (order, *extract.EXTRACT_COLUMNS))
    if limit is not None:
        rows = extract.first_records(rows, order, limit)
    return clean.remove_duplicates(clean.with_log_activity(rows), order).select("molecule_id", "structure", "p")


def fingerprints(table: DataFrame, n_bits: int = 2048, window: int = 4, kind: str = "hashed") -> DataFrame:
    """The compounds with on-bits and a sparse vector; rows without bits are dropped."""
    made = ft.with_hashed_bits(table, "structure", "bits", n_bits, window, kind)
    return ft.bits_to_vector(made, "bits", "features", n_bits)


def cluster_run(table: DataFrame, k: int = 5, value: str = "p", features: str = "features", **options) -> dict[str, DataFrame]:
    """k-means over the table with its reports and the most active rows of every cluster."""
    from assayspark.operators import groups, stats

    labelled, _, cost = cluster.kmeans(table, features, k, **options)
    return {
        "table": labelled,
        "sizes": stats.group_sizes(labelled, "cluster"),
        "stats": stats.group_stats(labelled, ["cluster"], value),
        "representatives": groups.top_n_per_group(labelled, ["cluster"], value, 3, ["molecule_id"]),
    }


def space_report(
    df: DataFrame, features: str, key: str, value: str, cluster_column: str = "cluster", subcluster: str = "subcluster"
) -> dict[str, DataFrame]:
    """The 2-D map, and the map of the largest cluster by subcluster where both labels exist."""
    present = [c for c in (cluster_column, subcluster) if c in df.columns]
    parts = {"map": cluster.map_2d(df, features, [key, value, *present])}
    if len(present) == 2:
        parts["largest"] = cluster.map_largest_cluster(df, features, [key, value, *present], cluster_column)
    return parts


def first_table(spark: SparkSession, candidates: Sequence[str]) -> DataFrame | None:
    """The first of the Parquet tables that exists, or None."""
    from pyspark.errors import AnalysisException

    for path in candidates:
        try:
            return spark.read.parquet(path)
        except AnalysisException:
            continue
    return None


# The tables of a run, the richest first, by what they are read for.
RUN_TABLES = {
    "base": ("activity", "clustered", "properties"),
    "properties": ("properties", "clustered"),
    "clustered": ("subclustered", "clustered"),
    "vectors": ("fingerprints",),
}


def analyse_run(spark: SparkSession, folder: str, value: str, key: Sequence[str], **options) -> dict[str, dict[str, DataFrame]]:
    """`analyse` over what a run left in a folder: for each use the first of its tables that exists."""
    found = {use: first_table(spark, [f"{folder.rstrip('/')}/{name}" for name in names]) for use, names in RUN_TABLES.items()}
    if found["base"] is None:
        raise ValueError(f"{folder} has none of {', '.join(RUN_TABLES['base'])}")
    return analyse(found.pop("base"), value, key, **found, **options)


def analyse(
    base: DataFrame,
    value: str,
    key: Sequence[str],
    properties: DataFrame | None = None,
    clustered: DataFrame | None = None,
    vectors: DataFrame | None = None,
    features: str = "features",
    exclude: Sequence[str] = reports.LABEL_COLUMNS,
) -> dict[str, dict[str, DataFrame]]:
    """Every report the tables at hand allow.

    Maps come from the clustered table, else from the vectors; the property table stands in for the
    base table where it is given.
    """
    described = properties if properties is not None else base
    out = {
        "activity": reports.activity_report(base, value),
        "property": reports.property_report(described, exclude),
    }
    related = reports.property_activity_report(described, value, exclude=exclude, key=key)
    if related is not None:
        out["property_activity"] = related
    if clustered is not None:
        out["cluster"] = reports.cluster_report(clustered, value)
    mapped = clustered if clustered is not None else vectors
    if mapped is not None:
        out["space"] = space_report(mapped, features, key[0], value)
        out["landscape"] = {"points": cluster.landscape_3d(mapped, features, key[0], value)}
    return out
