"""The same operators over a column with planted NaN and nulls: NaN counts as null everywhere."""

from __future__ import annotations

from pyspark.sql import functions as F

from assayspark.operators import groups, stats
from assayspark.plans import reports
from workload.properties import KEYS, KEYS_SQL, ROW, ROW_SQL
from workload.registry import props, q6, query, rounded

EDGE = "edge as (select *, case when l_orderkey % 17 = 0 or l_orderkey % 19 = 0 then null else pic50 - 6 end as x from props)"


def edge(spark, sf):
    x = F.when(F.col("l_orderkey") % 17 == 0, float("nan")).when(F.col("l_orderkey") % 19 != 0, F.col("pic50") - 6)
    return props(spark, sf).withColumn("x", x)


@query("top_n_edge", f"with {EDGE} select {KEYS_SQL}, {q6('x')} as x from (select * from edge order by x desc nulls last, {ROW_SQL} limit 20)", "props")
def top_n_edge(spark, sf):
    return rounded(groups.top_n(edge(spark, sf), "x", 20, ROW).select(*KEYS, "x"), "x")


@query(
    "top_n_group_edge",
    f"""with {EDGE} select {KEYS_SQL}, cluster, {q6('x')} as x, cast(rank as int) as rank from
    (select *, row_number() over (partition by cluster order by x desc nulls last, {ROW_SQL}) as rank from edge) where rank <= 3""",
    "props",
)
def top_n_group_edge(spark, sf):
    top = groups.top_n_per_group(edge(spark, sf), ["cluster"], "x", 3, ROW)
    return rounded(top.select(*KEYS, "cluster", "x", "rank"), "x")


@query("sort_desc_edge", f"with {EDGE} select {KEYS_SQL}, {q6('x')} as x, row_number() over (order by x desc nulls last, {ROW_SQL}) as rank from edge", "props")
def sort_desc_edge(spark, sf):
    """Every row with its place, those without a number last."""
    rows = groups.numbered_rows(groups.sort_desc(edge(spark, sf), "x", ROW), "rank")
    return rounded(rows.select(*KEYS, F.nanvl("x", F.lit(None)).alias("x"), "rank"), "x")


@query("sort_abs_edge", f"with {EDGE} select {KEYS_SQL}, {q6('x')} as x, row_number() over (order by abs(x) desc nulls last, {ROW_SQL}) as rank from edge", "props")
def sort_abs_edge(spark, sf):
    """Every row with its place, those without a number last."""
    rows = groups.numbered_rows(groups.sort_abs(edge(spark, sf), "x", ROW), "rank")
    return rounded(rows.select(*KEYS, F.nanvl("x", F.lit(None)).alias("x"), "rank"), "x")


@query(
    "best_k_edge",
    """with curve as (select l_linenumber as k, case when l_linenumber = 2 then null else avg(l_tax) end as score from props group by 1)
    select cast(k as int) as best_k from curve where score is not null order by score desc, k limit 1""",
    "props",
)
def best_k_edge(spark, sf):
    curve = props(spark, sf).groupBy(F.col("l_linenumber").alias("k")).agg(F.avg("l_tax").alias("score"))
    return groups.best_k(curve.withColumn("score", F.when(F.col("k") == 2, float("nan")).otherwise(F.col("score"))), "k", "score")


@query(
    "box_outliers_edge",
    f"""with {EDGE}, w as (select *, l_extendedprice * l_tax * (x - x + 1) as v from edge),
    q as (select cluster, quantile_cont(v, 0.25) as q1, quantile_cont(v, 0.75) as q3 from w group by 1)
    select {KEYS_SQL}, w.cluster, {q6('v')} as v from w join q using (cluster)
    where v < q1 - (q3 - q1) * 1.5 or v > q3 + (q3 - q1) * 1.5""",
    "props",
)
def box_outliers_edge(spark, sf):
    x = F.col("x")
    rows = edge(spark, sf).withColumn("v", F.col("l_extendedprice") * F.col("l_tax") * (x - x + 1))
    return rounded(stats.box_outliers(rows.select(*KEYS, "cluster", "v"), "cluster", "v"), "v")


@query(
    "regression_metrics_edge",
    f"""with {EDGE} select cluster, count(*) as n, {q6('sqrt(avg(pow(x - f, 2)))')} as rmse,
    {q6('1 - sum(pow(x - f, 2)) / (count(*) * var_pop(x))')} as r2, {q6('avg(abs(x - f))')} as mae
    from (select *, molwt / 300 - 1 as f from edge) where x is not null group by 1""",
    "props",
)
def regression_metrics_edge(spark, sf):
    rows = edge(spark, sf).withColumn("f", F.expr("molwt / 300 - 1"))
    return rounded(stats.regression_metrics(rows, "x", "f", ["cluster"]), "rmse", "r2", "mae")


@query(
    "report_property_edge",
    f"""with {EDGE} select 'x' as property, count(x) as n, {q6('avg(x)')} as mean, {q6('stddev_samp(x)')} as std,
    {q6('min(x)')} as min, {q6('max(x)')} as max from edge""",
    "props",
)
def report_property_edge(spark, sf):
    parts = reports.property_report(edge(spark, sf).select("x"))
    return rounded(parts["summary"], "mean", "std", "min", "max")


PANEL = ("molwt", "mollogp", "tpsa")


@query(
    "pair_panel_diagonal",
    " union all ".join(
        f"""select * from (with shape as (select count({c}) as n, min({c}) as lo, max({c}) as hi,
          pow(count({c}), -0.2) * stddev_samp({c}) as h from props),
        grid as (select cast(i as int) as point, lo - 3 * h + i * (hi - lo + 6 * h) / 199 as x from range(200) t(i), shape),
        counted as (select {c} as v, count(*) as c from props group by 1)
        select '{c}' as property, point, {q6('any_value(x)')} as x,
          {q6('sum(c * exp(-0.5 * pow((x - v) / h, 2))) / any_value(n * h * sqrt(2 * pi()))')} as density
        from grid, counted, shape group by point)"""
        for c in PANEL
    ),
    "props",
)
def pair_panel_diagonal(spark, sf):
    """The densities on the diagonal of the pair panel."""
    return rounded(stats.panel_diagonal(props(spark, sf), PANEL), "x", "density")
