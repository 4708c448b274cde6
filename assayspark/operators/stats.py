"""Distributions, group statistics, box numbers, densities and correlations."""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import combinations

from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame, Row, Window, functions as F

from assayspark.functions import activity as act
from assayspark.functions.activity import no_nan
from assayspark.operators.quantiles import group_quantiles, values_of

# Edges of the activity histogram.
ACTIVITY_EDGES = (3.0, 4.0, 5.0, 6.0, 7.0, 8.0, 9.0, 10.0)


def _number(df: DataFrame, value: str) -> Column:
    return no_nan(F.col(value).cast("double"))


def _numbers(start: int, stop: int, name: str, df: DataFrame) -> DataFrame:
    """A table of the whole numbers start..stop, for zero-filling; its size is an argument, not data."""
    return df.sparkSession.range(start, stop + 1, 1, 1).select(F.col("id").cast("int").alias(name))


def global_stats(df: DataFrame, value: str) -> DataFrame:
    """n, min, max, mean, sample deviation and exact median, in one row."""
    x = _number(df, value)
    median = group_quantiles(df, [], value, {"median": 0.5}).first()
    return df.agg(
        F.count(x).alias("n"),
        F.min(x).alias("min"),
        F.max(x).alias("max"),
        F.avg(x).alias("mean"),
        F.stddev_samp(x).alias("std"),
    ).withColumn("median", F.lit(median[0] if median else None).cast("double"))


def group_stats(df: DataFrame, by: Sequence[str], value: str, digits: int | None = None) -> DataFrame:
    """count, mean, sample deviation, min and max per group; null groups are left out."""
    x = _number(df, value)
    stats = (
        df.na.drop("any", subset=list(by))
        .groupBy(*by)
        .agg(
            F.count(x).alias("count"),
            F.avg(x).alias("mean"),
            F.stddev_samp(x).alias("std"),
            F.min(x).alias("min"),
            F.max(x).alias("max"),
        )
    )
    if digits is not None:
        for c in ("mean", "std", "min", "max"):
            stats = stats.withColumn(c, F.bround(c, digits))
    return stats


def group_sizes(df: DataFrame, by: str) -> DataFrame:
    return df.where(F.col(by).isNotNull()).groupBy(by).agg(F.count("*").alias("n")).orderBy(by)


def distinct_count(df: DataFrame, column: str, approximate: bool = False) -> DataFrame:
    """Distinct non-null values; the approximate form shuffles one sketch per task."""
    if approximate:
        return df.agg(F.approx_count_distinct(column).alias("n"))
    return df.select(column).na.drop().distinct().agg(F.count("*").alias("n"))


def largest_group(df: DataFrame, by: str) -> DataFrame:
    """The most frequent group, ties to the smallest key."""
    return group_sizes(df, by).orderBy(F.col("n").desc(), by).limit(1)


def class_distribution(df: DataFrame, value: str) -> DataFrame:
    """Rows and percent per activity class, empty classes included, percent of all classed rows."""
    classes = F.array(*[F.struct(F.lit(i).alias("ord"), F.lit(c).alias("class")) for i, c in enumerate(act.CLASS_NAMES)])
    domain = _numbers(0, 0, "one", df).select(F.inline(classes))
    sizes = (
        df.select(act.activity_class(F.col(value)).alias("class"))
        .na.drop()
        .groupBy("class")
        .agg(F.count("*").alias("n"))
    )
    n = F.coalesce(F.col("n"), F.lit(0))
    return domain.join(sizes, "class", "left").select("ord", "class", n.alias("n"), _percent(n))


def _percent(n: Column) -> Column:
    """Percent of the whole, for tables with one row per class of a fixed domain."""
    return F.try_divide(F.lit(100.0) * n, F.sum(n).over(Window.partitionBy())).alias("percent")


def violation_distribution(df: DataFrame, violations: Column, most: int = 4) -> DataFrame:
    """Rows and percent for 0..most violations, zeros included."""
    sizes = df.select(violations.alias("violations")).groupBy("violations").agg(F.count("*").alias("n"))
    n = F.coalesce(F.col("n"), F.lit(0))
    return _numbers(0, most, "violations", df).join(sizes, "violations", "left").select(
        "violations", n.alias("n"), _percent(n)
    )


def _filled(bins: DataFrame, sizes: DataFrame, low: Column, high: Column) -> DataFrame:
    return bins.join(sizes, "bin", "left").select(
        "bin", low.alias("low"), high.alias("high"), F.coalesce("n", F.lit(0)).alias("n")
    )


def histogram_edges(df: DataFrame, value: str, edges: Sequence[float] = ACTIVITY_EDGES) -> DataFrame:
    """Counts between given ascending edges; bins are half open but the last, which is closed.

    Values outside the edges are not counted.
    """
    x = _number(df, value)
    cuts = F.array(*[F.lit(float(e)) for e in edges])
    last = len(edges) - 1
    inside = df.where((x >= float(edges[0])) & (x <= float(edges[-1])))
    at = F.least(F.size(F.filter(cuts, lambda e: e <= x)), F.lit(last)) - 1
    sizes = inside.groupBy(at.alias("bin")).agg(F.count("*").alias("n"))
    return _filled(_numbers(0, last - 1, "bin", df), sizes, F.get(cuts, F.col("bin")), F.get(cuts, F.col("bin") + 1))


def column_shapes(df: DataFrame, columns: Sequence[str]) -> dict[str, Row]:
    """Range, number, mean and deviation of each column, and the number of rows, from one pass.

    One short row per column is read back: it lays out the bins or the grid.
    """
    shapes = []
    for i, c in enumerate(columns):
        x = _number(df, c)
        shapes.append(
            F.struct(
                F.min(x).alias("lo"),
                F.max(x).alias("hi"),
                F.count(x).alias("n"),
                F.count("*").alias("rows"),
                F.avg(x).alias("mean"),
                F.stddev_samp(x).alias("std"),
            ).alias(f"s{i}")
        )
    return dict(zip(columns, df.agg(*shapes).first()))


def stacked(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Long form (property, value), one row per row and column; a narrow projection."""
    cells = [F.struct(F.lit(c).alias("property"), _number(df, c).alias("value")) for c in columns]
    return df.select(F.inline(F.array(*cells)))


def _equal_histogram(df: DataFrame, value: str, bins: int, lo: float, hi: float) -> DataFrame:
    """Counts in equal bins over [lo, hi], the last one closed; a single value sits in a unit range."""
    start = lo - 0.5 if lo == hi else lo
    width = 1.0 / bins if lo == hi else (hi - lo) / bins
    x = _number(df, value)
    at = F.least(F.floor((x - F.lit(start)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    sizes = df.where(x.isNotNull()).groupBy(at.alias("bin")).agg(F.count("*").alias("n"))
    b = F.col("bin")
    return _filled(
        _numbers(0, bins - 1, "bin", df),
        sizes,
        F.lit(start) + b * F.lit(width),
        F.lit(start) + (b + 1) * F.lit(width),
    )


def _no_bins(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([], "bin int, low double, high double, n bigint")


def histogram_equal(df: DataFrame, value: str, bins: int = 20) -> DataFrame:
    """Counts in `bins` equal bins over the value's range."""
    r = column_shapes(df, [value])[value]
    return _equal_histogram(df, value, bins, r.lo, r.hi) if r.n else _no_bins(df)


def auto_bins(df: DataFrame, shapes: dict[str, Row]) -> dict[str, int]:
    """Bins per column: the bin width is the smaller of the Sturges and Freedman-Diaconis widths.

    The quartiles of all columns come from one long table. Columns without values are left out.
    """
    long = stacked(df, list(shapes))
    quarters = group_quantiles(long, ["property"], "value", {"q1": 0.25, "q3": 0.75}).collect()
    bins = {}
    for q in quarters:
        r = shapes[q.property]
        spread = r.hi - r.lo
        widths = [spread / (math.log2(r.n) + 1), 2 * (q.q3 - q.q1) / r.n ** (1 / 3)]
        bins[q.property] = math.ceil(spread / min(w for w in widths if w > 0)) if spread > 0 else 1
    return bins


def histogram_auto(df: DataFrame, value: str) -> DataFrame:
    """Histogram with the automatic number of bins, empty bins included."""
    return histograms_auto(df, [value])[value]


def histograms_auto(
    df: DataFrame, columns: Sequence[str], shapes: dict[str, Row] | None = None
) -> dict[str, DataFrame]:
    shapes = shapes or column_shapes(df, columns)
    bins = auto_bins(df, shapes)
    return {
        c: _equal_histogram(df, c, bins[c], r.lo, r.hi) if c in bins else _no_bins(df) for c, r in shapes.items()
    }


def density(df: DataFrame, value: str, points: int = 200, cut: float = 3.0, shape: Row | None = None) -> DataFrame:
    """Gaussian density on an even grid that reaches `cut` bandwidths past the data (Scott bandwidth).

    Each task adds up its share of every grid point, so one row per grid point and task is shuffled. Fewer than two distinct values give no rows.
    """
    r = shape or column_shapes(df, [value])[value]
    h = (r["std"] or 0.0) * r.n ** -0.2 if r.n else 0.0
    if not h:
        return df.sparkSession.createDataFrame([], "point int, x double, density double")
    low = r.lo - cut * h
    step = (r.hi - r.lo + 2 * cut * h) / (points - 1)
    x = F.lit(low) + F.col("point") * F.lit(step)
    away = (x - F.col("_value")) / F.lit(h)
    return (
        values_of(df, [], value)
        .select("_value", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))
        .groupBy("point")
        .agg(F.sum(F.exp(F.lit(-0.5) * away * away)).alias("w"))
        .select("point", x.alias("x"), (F.col("w") / F.lit(r.n * h * math.sqrt(2 * math.pi))).alias("density"))
    )


def box_numbers(df: DataFrame, by: str, value: str) -> DataFrame:
    """Per group: quartiles, whiskers at the furthest value within 1.5 quartile ranges, outlier count."""
    quarters = group_quantiles(df, [by], value, {"q1": 0.25, "median": 0.5, "q3": 0.75}, count="n")
    inside = F.col("_value").between(*_fences())
    return (
        values_of(df, [by], value)
        .join(quarters, by)
        .groupBy(by, "n", "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col("_value"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("_value"))).alias("whisker_high"),
            F.count(F.when(~inside, 1)).alias("outliers"),
        )
    )


def _fences() -> tuple[Column, Column]:
    reach = (F.col("q3") - F.col("q1")) * 1.5
    return F.col("q1") - reach, F.col("q3") + reach


def box_outliers(df: DataFrame, by: str, value: str) -> DataFrame:
    """The rows outside their group's whiskers."""
    quarters = group_quantiles(df, [by], value, {"q1": 0.25, "q3": 0.75})
    return df.join(quarters, by).where(~_number(df, value).between(*_fences())).drop("q1", "q3")


def eligible_groups(
    df: DataFrame, by: str, smallest: int, subgroup: str | None = None, warn_below: int = 50
) -> DataFrame:
    """Groups of at least `smallest` rows (and more than one subgroup), with a small-size warning flag."""
    rows = df.where(F.col(by).isNotNull())
    if subgroup is None:
        sizes = rows.groupBy(by).agg(F.count("*").alias("n"))
    else:
        # Two steps keep a hot group's subgroups apart until they are one row each.
        sizes = (
            rows.groupBy(by, subgroup)
            .agg(F.count("*").alias("m"))
            .groupBy(by)
            .agg(F.sum("m").alias("n"), F.count(subgroup).alias("subgroups"))
            .where("subgroups > 1")
        )
    return sizes.where(F.col("n") >= smallest).withColumn("small", F.col("n") < warn_below)


def safe_corr(x: Column, y: Column) -> Column:
    """Pearson r over rows where both are present; null when either is constant."""
    both = x.isNotNull() & y.isNotNull()
    a, b = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


def correlation_with(df: DataFrame, properties: Sequence[str], target: str) -> DataFrame:
    """Pearson r of every property with the target, strongest first; one pass over the table."""
    y = _number(df, target)
    one = df.agg(*[safe_corr(_number(df, p), y).alias(p) for p in properties])
    r = F.col("r")
    return (
        one.select(F.inline(F.array(*[F.struct(F.lit(p).alias("property"), F.col(f"`{p}`").alias("r")) for p in properties])))
        .withColumn("abs_r", F.abs(r))
        .orderBy(F.col("abs_r").desc_nulls_last(), "property")
    )


def strongest(correlations: DataFrame, n: int = 10) -> DataFrame:
    return correlations.orderBy(F.col("abs_r").desc_nulls_last(), "property").limit(n)


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Long form (col_a, col_b, r) of the pairwise-complete Pearson matrix, both triangles and diagonal.

    A first pass finds ranges, means and gaps. One more pass takes the products of columns without
    gaps as vectors, and one the pairs with gaps, if any. What comes back depends on the number of
    columns only. Constant columns have null correlations.
    """
    shapes = column_shapes(df, columns)
    varied = [c for c in columns if shapes[c].n and shapes[c].lo < shapes[c].hi]
    full = [c for c in varied if shapes[c].n == shapes[c].rows]
    r: dict[tuple[str, str], float | None] = {(c, c): 1.0 for c in varied}
    pairs = list(combinations(full, 2))
    if pairs:
        vector = array_to_vector(F.array(*[F.col(c).cast("double") for c in full])).alias("v")
        matrix = Correlation.corr(df.select(vector), "v").first()[0].toArray()
        r |= {(a, b): float(matrix[full.index(a), full.index(b)]) for a, b in pairs}
    gaps = [(a, b) for a, b in combinations(varied, 2) if (a, b) not in r]
    if gaps:
        found = df.agg(*[safe_corr(_number(df, a), _number(df, b)) for a, b in gaps]).first()
        r |= dict(zip(gaps, found))
    cells = [(a, b, r.get((a, b), r.get((b, a)))) for a in columns for b in columns]
    return df.sparkSession.createDataFrame(cells, "col_a string, col_b string, r double")


def wide_matrix(long: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The long matrix with one column per property, rows in the same order."""
    rank = F.array_position(F.array(*[F.lit(c) for c in columns]), F.col("col_a"))
    return long.groupBy("col_a").pivot("col_b", list(columns)).agg(F.first("r")).orderBy(rank)


def trend_line(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares line of y on x; nulls when x is constant."""
    a, b = _number(df, x), _number(df, y)
    return df.agg(
        F.regr_count(b, a).alias("n"),
        F.regr_slope(b, a).alias("slope"),
        F.regr_intercept(b, a).alias("intercept"),
        F.regr_r2(b, a).alias("r2"),
    )


def trend_lines(df: DataFrame, properties: Sequence[str], target: str) -> DataFrame:
    """The trend of the target on every property, in one pass."""
    y = _number(df, target)

    def line(p: str) -> Column:
        x = _number(df, p)
        return F.struct(
            F.lit(p).alias("property"),
            F.regr_slope(y, x).alias("slope"),
            F.regr_intercept(y, x).alias("intercept"),
            F.regr_r2(y, x).alias("r2"),
        )

    return df.agg(*[line(p).alias(f"l{i}") for i, p in enumerate(properties)]).select(
        F.inline(F.array(*[F.col(f"l{i}") for i in range(len(properties))]))
    )


def pair_panel(df: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Long form (key, col_a, col_b, a, b) of every pair of the columns; a narrow projection."""
    cells = [
        F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), _number(df, a).alias("a"), _number(df, b).alias("b"))
        for a, b in combinations(columns, 2)
    ]
    return df.select(*key, F.inline(F.array(*cells)))


def panel_diagonal(df: DataFrame, columns: Sequence[str], points: int = 200) -> DataFrame:
    """Long form (property, point, x, density): the diagonal of the pair panel. Constant columns have no rows."""
    shapes = column_shapes(df, columns)
    out = None
    for c in columns:
        part = density(df, c, points, shape=shapes[c]).select(F.lit(c).alias("property"), "point", "x", "density")
        out = part if out is None else out.unionByName(part)
    return out


def regression_metrics(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """n, RMSE, R2 and MAE, for the whole table or per group, as plain aggregates; rows with a null or NaN don't count."""
    y = _number(df, actual)
    error = y - _number(df, predicted)
    rows = df.where(error.isNotNull())
    return rows.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (1 - F.try_divide(F.sum(error * error), F.count("*") * F.var_pop(y))).alias("r2"),
        F.avg(F.abs(error)).alias("mae"),
    )
