"""Reports: one call gives a dictionary of small or lazy DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from assayspark.functions import activity as act
from assayspark.operators import clean, groups, stats
from assayspark.session import settle

# The names a table may use for the roles of the rule check and of the summary.
RULE_NAMES = (
    {"mw": "MW", "logp": "LogP", "hbd": "HBD", "hba": "HBA"},
    {"mw": "MolWt", "logp": "MolLogP", "hbd": "NumHDonors", "hba": "NumHAcceptors"},
)
SUMMARY_NAMES = (
    ("MW", "LogP", "TPSA", "RotBonds"),
    ("MolWt", "MolLogP", "TPSA", "NumRotatableBonds"),
)
LABEL_COLUMNS = ("molecule_id", "structure", "p", "cluster", "subcluster", "violations")


def activity_report(df: DataFrame, value: str = "p", bins: int = 20) -> dict[str, DataFrame]:
    """Statistics, histogram, density and classes of one column, which is written once and read by all."""
    df = settle(df.select(value), "report")
    return {
        "stats": stats.global_stats(df, value),
        "histogram": stats.histogram_equal(df, value, bins),
        "density": stats.density(df, value),
        "classes": stats.class_distribution(df, value),
    }


def summary_properties(df: DataFrame, exclude: Sequence[str] = LABEL_COLUMNS) -> list[str]:
    """The four summary properties: the first name set present in full, else the first four numeric columns."""
    for names in SUMMARY_NAMES:
        if all(n in df.columns for n in names):
            return list(names)
    return clean.numeric_columns(df, exclude, 4)


def property_report(
    df: DataFrame,
    exclude: Sequence[str] = LABEL_COLUMNS,
    rule_columns: dict[str, str] | None = None,
    first: int = 12,
) -> dict[str, DataFrame]:
    """Histogram and density per property and the rule check; `table` has `violations` added.

    Without a full set of rule columns the rule check is left out.
    """
    properties = clean.numeric_columns(df, exclude, first)
    df = settle(df, "report")
    shapes = stats.column_shapes(df, properties)
    parts = {f"histogram:{p}": t for p, t in stats.histograms_auto(df, properties, shapes).items()}
    parts |= {f"density:{p}": stats.density(df, p, shape=shapes[p]) for p in properties}
    summary = summary_properties(df, exclude)
    if summary:
        x = {p: act.no_nan(F.col(p).cast("double")) for p in summary}
        rows = [
            F.struct(
                F.lit(p).alias("property"),
                F.count(x[p]).alias("n"),
                F.avg(x[p]).alias("mean"),
                F.stddev_samp(x[p]).alias("std"),
                F.min(x[p]).alias("min"),
                F.max(x[p]).alias("max"),
            ).alias(f"s{i}")
            for i, p in enumerate(summary)
        ]
        parts["summary"] = df.agg(*rows).select(F.inline(F.array(*[F.col(f"s{i}") for i in range(len(rows))])))
    roles = rule_columns or clean.resolve_aliases(df, RULE_NAMES)
    if roles:
        violations = act.violation_count(roles)
        parts["table"] = df.withColumn("violations", violations)
        parts["violations"] = stats.violation_distribution(df, violations)
    else:
        parts["table"] = df
    return parts


def property_activity_report(
    df: DataFrame,
    value: str = "p",
    properties: Sequence[str] | None = None,
    exclude: Sequence[str] = LABEL_COLUMNS,
    key: Sequence[str] = ("molecule_id",),
    matrix_columns: int = 15,
    focus: int = 10,
    lines: int = 6,
    panel: int = 3,
) -> dict[str, DataFrame] | None:
    """Correlations, trends, matrices and the pair panel. None when there are fewer than 5 properties.

    Choosing the strongest properties reads back one short row per property, never data rows.
    """
    numeric = clean.numeric_columns(df, [*exclude, value])
    if len(numeric) < 5:
        return None
    chosen = list(properties or numeric)
    df = settle(df.select(*dict.fromkeys([*key, *chosen, *numeric, value])), "report")
    found = stats.correlation_with(df, list(dict.fromkeys([*chosen, *numeric])), value)
    rows = found.collect()
    correlations = df.sparkSession.createDataFrame([r for r in rows if r.property in chosen], found.schema)
    ranked = [r.property for r in rows if r.property in chosen]
    overall = [r.property for r in rows if r.property in numeric][:focus]
    full = stats.correlation_matrix(df, [*numeric, value])

    def among(columns: Sequence[str]) -> DataFrame:
        return full.where(F.col("col_a").isin(list(columns)) & F.col("col_b").isin(list(columns)))

    return {
        "correlations": correlations,
        "trends": stats.trend_lines(df, ranked[:lines], value),
        "matrix": among([*numeric[:matrix_columns], value]),
        "focus_matrix": among([*overall, value]),
        "full_matrix": full,
        "lines": correlations.select(F.format_string("%s: r = %.3f", "property", "r").alias("line")),
        "pairs": stats.pair_panel(df, key, [*ranked[:panel], value]),
        "diagonal": stats.panel_diagonal(df, [*ranked[:panel], value]),
    }


def cluster_report(
    df: DataFrame, value: str = "p", cluster: str = "cluster", subcluster: str | None = "subcluster", smallest: int = 10
) -> dict[str, DataFrame]:
    """Sizes, statistics and box numbers per cluster, and per subcluster of the eligible clusters.

    All clusters are handled by one grouping on (cluster, subcluster), not one job each.
    """
    clean.require_columns(df, [cluster])
    df = settle(df.select(*[c for c in (cluster, subcluster, value) if c in df.columns]), "report")
    parts = {
        "sizes": stats.group_sizes(df, cluster),
        "stats": stats.group_stats(df, [cluster], value),
        "box": stats.box_numbers(df, cluster, value),
    }
    if subcluster and subcluster in df.columns:
        eligible = stats.eligible_groups(df, cluster, smallest, subcluster).select(cluster)
        parts["subcluster_stats"] = stats.group_stats(df, [cluster, subcluster], value).join(eligible, cluster, "left_semi")
        both = F.struct(cluster, subcluster)
        box = stats.box_numbers(df.join(eligible, cluster, "left_semi").withColumn("_both", both), "_both", value)
        parts["subcluster_box"] = box.select(f"_both.{cluster}", f"_both.{subcluster}", *[c for c in box.columns if c != "_both"])
    return parts


def key_report(df: DataFrame, subcluster: str, key: str, overall: int = 10, per_group: int = 5) -> dict[str, DataFrame]:
    return {
        "overall": groups.frequent_keys(df, key, overall),
        "per_subcluster": groups.frequent_keys_per_group(df, subcluster, key, per_group),
    }


def top_report(df: DataFrame, subcluster: str, value: str, ties: Sequence[str], n: int = 20) -> dict[str, DataFrame]:
    return {
        "overall": groups.top_n(df, value, n, ties),
        "per_subcluster": groups.top_n_per_group(df, [subcluster], value, n, ties),
    }
