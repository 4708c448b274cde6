"""Queries over a property table with clusters, subclusters and keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from assayspark.functions import activity as act
from assayspark.operators import clean, groups, stats
from assayspark.plans import reports
from workload.registry import props, q6, query, r6, rounded, table

RULE_COLUMNS = {"mw": "molwt", "logp": "mollogp", "hbd": "hbd", "hba": "hba"}
PROPERTIES = ("molwt", "mollogp", "hbd", "hba", "tpsa", "const_col")
ROW = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
    "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
)
ROW_SQL = ", ".join(ROW)
KEYS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
KEYS_SQL = ", ".join(KEYS)
VIOLATIONS = "(molwt > 500)::int + (mollogp > 5)::int + (hbd > 5)::int + (hba > 10)::int"
STATS = ", ".join(f"{q6(e)} as {n}" for n, e in (
    ("mean", "avg(pic50)"), ("std", "stddev_samp(pic50)"), ("min", "min(pic50)"), ("max", "max(pic50)"),
))


def corr_sql(a: str, b: str) -> str:
    return f"case when isnan(corr({a}, {b})) then null else (round(corr({a}, {b}), 6) + 0e0) end"


@query(
    "range_half_open",
    f"select {KEYS_SQL}, {q6('pic50')} as pic50 from props where subcluster = 0 and pic50 >= 5 and pic50 < 10",
    "props",
)
def range_half_open(spark, sf):
    rows = props(spark, sf).where((F.col("subcluster") == 0) & act.in_half_open_range(F.col("pic50"), 5.0, 10.0))
    return rounded(rows.select(*KEYS, "pic50"), "pic50")


@query("one_group", f"select {KEYS_SQL}, cluster from props where cluster = 3", "props")
def one_group(spark, sf):
    return props(spark, sf).where("cluster = 3").select(*KEYS, "cluster")


@query(
    "rule_violations",
    f"""select {KEYS_SQL}, (molwt > 500)::int as mw_over_500, (mollogp > 5)::int as logp_over_5,
    (hbd > 5)::int as hbd_over_5, (hba > 10)::int as hba_over_10, {VIOLATIONS} as violations from props""",
    "props",
)
def rule_violations(spark, sf):
    return props(spark, sf).select(
        *KEYS,
        *[flag.alias(name) for name, flag in act.violation_flags(RULE_COLUMNS).items()],
        act.violation_count(RULE_COLUMNS).alias("violations"),
    )


VIOLATION_SIZES = f"sizes as (select {VIOLATIONS} as violations, count(*) as n from props group by 1)"
VIOLATION_SHARE = f"""select cast(v as int) as violations, coalesce(n, 0) as n,
  {q6('100e0 * coalesce(n, 0) / (select sum(n) from sizes)')} as percent
  from range(5) t(v) left join sizes on v = violations"""


@query("violation_distribution", f"with {VIOLATION_SIZES} {VIOLATION_SHARE}", "props")
def violation_distribution(spark, sf):
    return rounded(stats.violation_distribution(props(spark, sf), act.violation_count(RULE_COLUMNS)), "percent")


@query(
    "group_stats",
    f"select cluster, subcluster, count(pic50) as count, {STATS} from props group by all",
    "props",
)
def group_stats(spark, sf):
    return rounded(stats.group_stats(props(spark, sf), ["cluster", "subcluster"], "pic50"), "mean", "std", "min", "max")


@query("group_sizes", "select cluster, count(*) as n from props group by 1", "props")
def group_sizes(spark, sf):
    return stats.group_sizes(props(spark, sf), "cluster")


@query(
    "distinct_count",
    "select 'l_partkey' as column, count(distinct l_partkey) as n from props "
    "union all select 'scaffold', count(distinct scaffold) from props",
    "props",
)
def distinct_count(spark, sf):
    rows = props(spark, sf)
    return stats.distinct_count(rows, "l_partkey").select(F.lit("l_partkey").alias("column"), "n").unionByName(
        stats.distinct_count(rows, "scaffold").select(F.lit("scaffold").alias("column"), "n")
    )


@query(
    "largest_group",
    "select subcluster, count(*) as n from props group by 1 order by n desc, subcluster limit 1",
    "props",
)
def largest_group(spark, sf):
    return stats.largest_group(props(spark, sf), "subcluster")


@query(
    "density_grid",
    f"""with shape as (select count(pic50) as n, min(pic50) as lo, max(pic50) as hi,
      pow(count(pic50), -0.2) * stddev_samp(pic50) as h from props),
    grid as (select cast(i as int) as point, lo - 3 * h + i * (hi - lo + 6 * h) / 199 as x from range(200) t(i), shape),
    counted as (select pic50 as v, count(*) as c from props group by 1)
    select point, {q6('any_value(x)')} as x,
      {q6('sum(c * exp(-0.5 * pow((x - v) / h, 2))) / any_value(n * h * sqrt(2 * pi()))')} as density
    from grid, counted, shape group by point""",
    "props",
)
def density_grid(spark, sf):
    return rounded(stats.density(props(spark, sf), "pic50"), "x", "density")




@query(
    "box_numbers",
    f"""with q as (select cluster, count(*) as n, quantile_cont(pic50, 0.25) as q1, median(pic50) as median,
      quantile_cont(pic50, 0.75) as q3 from props group by 1),
    r as (select props.cluster, n, q1, median, q3, pic50,
      pic50 >= q1 - (q3 - q1) * 1.5 and pic50 <= q3 + (q3 - q1) * 1.5 as ok from props join q using (cluster))
    select cluster, n, {q6('q1')} as q1, {q6('median')} as median, {q6('q3')} as q3,
      {q6('min(pic50) filter (where ok)')} as whisker_low, {q6('max(pic50) filter (where ok)')} as whisker_high,
      count(*) filter (where not ok) as outliers from r group by cluster, n, q1, median, q3""",
    "props",
)
def box_numbers(spark, sf):
    return rounded(
        stats.box_numbers(props(spark, sf), "cluster", "pic50"), "q1", "median", "q3", "whisker_low", "whisker_high"
    )


@query(
    "box_outliers",
    f"""with q as (select cluster, quantile_cont(l_extendedprice * l_tax, 0.25) as q1,
      quantile_cont(l_extendedprice * l_tax, 0.75) as q3 from props group by 1)
    select {KEYS_SQL}, props.cluster, {q6('l_extendedprice * l_tax')} as v from props join q using (cluster)
    where l_extendedprice * l_tax < q1 - (q3 - q1) * 1.5 or l_extendedprice * l_tax > q3 + (q3 - q1) * 1.5""",
    "props",
)
def box_outliers(spark, sf):
    rows = props(spark, sf).withColumn("v", F.col("l_extendedprice") * F.col("l_tax"))
    return rounded(stats.box_outliers(rows.select(*KEYS, "cluster", "v"), "cluster", "v"), "v")


@query(
    "property_corr",
    "select * from ("
    + " union all ".join(
        f"select '{p}' as property, {corr_sql(p, 'pic50')} as r, abs({corr_sql(p, 'pic50')}) as abs_r from props"
        for p in PROPERTIES
    )
    + ")",
    "props",
)
def property_corr(spark, sf):
    return rounded(stats.correlation_with(props(spark, sf), PROPERTIES, "pic50"), "r", "abs_r")


@query(
    "corr_top",
    "select * from ("
    + " union all ".join(
        f"select '{p}' as property, {corr_sql(p, 'pic50')} as r, abs({corr_sql(p, 'pic50')}) as abs_r from props"
        for p in PROPERTIES
    )
    + ") order by abs_r desc nulls last, property limit 3",
    "props",
)
def corr_top(spark, sf):
    found = stats.correlation_with(props(spark, sf), PROPERTIES, "pic50")
    return rounded(stats.strongest(found, 3), "r", "abs_r")


MATRIX = ("molwt", "mollogp", "hbd", "hba", "tpsa", "const_col", "pic50")


def _matrix_sql(columns):
    rows = []
    for a in columns:
        for b in columns:
            if a == b:
                r = f"case when stddev_pop({a}) > 0 then 1e0 end"
            else:
                r = corr_sql(*sorted((a, b), key=list(columns).index))
            rows.append(f"select '{a}' as col_a, '{b}' as col_b, {r} as r from props")
    return " union all ".join(rows)


@query("corr_matrix", _matrix_sql(MATRIX), "props")
def corr_matrix(spark, sf):
    return rounded(stats.correlation_matrix(props(spark, sf), MATRIX), "r")


@query(
    "corr_matrix_wide",
    f"with m as ({_matrix_sql(MATRIX[:5])}) select col_a, "
    + ", ".join(f"max(r) filter (where col_b = '{c}') as {c}" for c in MATRIX[:5])
    + " from m group by col_a",
    "props",
)
def corr_matrix_wide(spark, sf):
    columns = MATRIX[:5]
    return rounded(stats.wide_matrix(stats.correlation_matrix(props(spark, sf), columns), columns), *columns)


@query(
    "trend_line",
    f"""select regr_count(pic50, molwt) as n, {q6('regr_slope(pic50, molwt)')} as slope,
    {q6('regr_intercept(pic50, molwt)')} as intercept, {q6('regr_r2(pic50, molwt)')} as r2 from props""",
    "props",
)
def trend_line(spark, sf):
    return rounded(stats.trend_line(props(spark, sf), "molwt", "pic50"), "slope", "intercept", "r2")


@query(
    "pair_panel",
    " union all ".join(
        f"select {KEYS_SQL}, '{a}' as col_a, '{b}' as col_b, {q6(a)} as a, {q6(b)} as b from props"
        for a, b in (("molwt", "mollogp"), ("molwt", "tpsa"), ("molwt", "pic50"), ("mollogp", "tpsa"), ("mollogp", "pic50"), ("tpsa", "pic50"))
    ),
    "props",
)
def pair_panel(spark, sf):
    return rounded(stats.pair_panel(props(spark, sf), KEYS, ("molwt", "mollogp", "tpsa", "pic50")), "a", "b")


@query(
    "eligible_groups",
    """select l_suppkey, sum(m) as n, count(subcluster) as subgroups, sum(m) < 50 as small from
    (select l_suppkey, subcluster, cast(count(*) as bigint) as m from props group by all) group by 1
    having sum(m) >= 20 and count(subcluster) > 1""".replace("sum(m) as n", "cast(sum(m) as bigint) as n"),
    "props",
)
def eligible_groups(spark, sf):
    return stats.eligible_groups(props(spark, sf), "l_suppkey", 20, "subcluster")


@query(
    "k_by_size",
    """select l_suppkey, count(*) as n, cast(case when count(*) < 60 then 2 when count(*) < 150 then 3
    when count(*) < 300 then 4 when count(*) < 600 then 5 else 6 end as int) as k,
    cast(least(10, greatest(2, count(*) // 10)) as int) as largest_k from props group by 1""",
    "props",
)
def k_by_size(spark, sf):
    sizes = stats.group_sizes(props(spark, sf), "l_suppkey")
    n = F.col("n")
    return sizes.select(
        "l_suppkey", "n", act.subgroup_count_rule(n).alias("k"), act.largest_subgroup_count(n).alias("largest_k")
    )


PREDICTED = "5e0 + molwt / 300"


@query(
    "regression_metrics",
    f"""select cluster, count(*) as n, {q6('sqrt(avg(pow(pic50 - f, 2)))')} as rmse,
    {q6('1 - sum(pow(pic50 - f, 2)) / (count(*) * var_pop(pic50))')} as r2, {q6('avg(abs(pic50 - f))')} as mae
    from (select *, {PREDICTED} as f from props) group by 1""",
    "props",
)
def regression_metrics(spark, sf):
    rows = props(spark, sf).withColumn("f", F.expr(PREDICTED))
    return rounded(stats.regression_metrics(rows, "pic50", "f", ["cluster"]), "rmse", "r2", "mae")


@query(
    "pred_actual",
    f"select {KEYS_SQL}, {q6('pic50')} as actual, {q6(PREDICTED)} as predicted from props",
    "props",
)
def pred_actual(spark, sf):
    rows = props(spark, sf).select(*KEYS, F.col("pic50").alias("actual"), F.expr(PREDICTED).alias("predicted"))
    return rounded(rows, "actual", "predicted")


@query(
    "class_summary",
    f"""with sizes as (select case when f < 6 then 'Low' when f < 7 then 'Moderate' when f < 8 then 'High' else 'Very High' end
      as class, count(*) as n from (select {PREDICTED} as f from props) group by 1),
    classes(ord, class) as (values (0, 'Low'), (1, 'Moderate'), (2, 'High'), (3, 'Very High'))
    select ord, class, coalesce(n, 0) as n, {q6('100e0 * coalesce(n, 0) / (select sum(n) from sizes)')} as percent
    from classes left join sizes using (class)""",
    "props",
)
def class_summary(spark, sf):
    return rounded(stats.class_distribution(props(spark, sf).withColumn("f", F.expr(PREDICTED)), "f"), "percent")


# Rankings. Rows have no short key, so ties are broken on all base columns.


@query(
    "top_n_group",
    f"""select {KEYS_SQL}, cluster, {q6('pic50')} as pic50, cast(rank as int) as rank from
    (select *, row_number() over (partition by cluster order by pic50 desc, {ROW_SQL}) as rank from props) where rank <= 3""",
    "props",
)
def top_n_group(spark, sf):
    top = groups.top_n_per_group(props(spark, sf), ["cluster"], "pic50", 3, ROW)
    return rounded(top.select(*KEYS, "cluster", "pic50", "rank"), "pic50")


@query(
    "top_n_subgroup",
    f"""select {KEYS_SQL}, cluster, subcluster, {q6('pic50')} as pic50, cast(rank as int) as rank from
    (select *, row_number() over (partition by cluster, subcluster order by pic50 desc, {ROW_SQL}) as rank from props)
    where rank <= 20""",
    "props",
)
def top_n_subgroup(spark, sf):
    top = groups.top_n_per_group(props(spark, sf), ["cluster", "subcluster"], "pic50", 20, ROW)
    return rounded(top.select(*KEYS, "cluster", "subcluster", "pic50", "rank"), "pic50")


@query(
    "top_n",
    f"select {KEYS_SQL}, {q6('pic50')} as pic50 from (select * from props order by pic50 desc, {ROW_SQL} limit 20)",
    "props",
)
def top_n(spark, sf):
    return rounded(groups.top_n(props(spark, sf), "pic50", 20, ROW).select(*KEYS, "pic50"), "pic50")


@query("sort_desc", f"select {KEYS_SQL}, {q6('pic50')} as pic50, row_number() over (order by pic50 desc nulls last, {ROW_SQL}) as rank from props", "props")
def sort_desc(spark, sf):
    """Every row with its place in the order."""
    return rounded(groups.numbered_rows(groups.sort_desc(props(spark, sf), "pic50", ROW), "rank").select(*KEYS, "pic50", "rank"), "pic50")


@query("sort_abs", f"select {KEYS_SQL}, {q6('pic50 - 6')} as d, row_number() over (order by abs(pic50 - 6) desc nulls last, {ROW_SQL}) as rank from props", "props")
def sort_abs(spark, sf):
    rows = props(spark, sf).withColumn("d", F.col("pic50") - 6)
    return rounded(groups.numbered_rows(groups.sort_abs(rows, "d", ROW), "rank").select(*KEYS, "d", "rank"), "d")


@query("sorted_keys", "select distinct subcluster from props", "props")
def sorted_keys(spark, sf):
    return groups.sorted_keys(props(spark, sf), "subcluster")


@query(
    "share_of_group",
    f"""select cluster, scaffold, count(*) as n,
    {q6('100e0 * count(*) / sum(count(*)) over (partition by cluster)')} as percent from props group by cluster, scaffold""",
    "props",
)
def share_of_group(spark, sf):
    return rounded(groups.share_of_group(props(spark, sf), ["cluster"], "scaffold"), "percent")


@query(
    "share_of_total",
    f"""select scaffold, count(*) as n, {q6('100e0 * count(*) / sum(count(*)) over ()')} as percent from props group by all""",
    "props",
)
def share_of_total(spark, sf):
    return rounded(groups.share_of_total(stats.group_sizes(props(spark, sf), "scaffold")), "percent")


KEY_OVERALL = "select * from (select scaffold, count(*) as n from props group by 1 order by n desc, scaffold limit 10) where scaffold <> ''"
KEY_GROUP = f"""select subcluster, scaffold, n, {q6('100e0 * n / total')} as percent from
  (select subcluster, scaffold, n, sum(n) over (partition by subcluster) as total,
     row_number() over (partition by subcluster order by n desc, scaffold) as rk
   from (select subcluster, scaffold, count(*) as n from props group by all)) where rk <= 5 and scaffold <> ''"""


@query("key_frequency", KEY_OVERALL, "props")
def key_frequency(spark, sf):
    return groups.frequent_keys(props(spark, sf), "scaffold")


@query("key_frequency_group", KEY_GROUP, "props")
def key_frequency_group(spark, sf):
    return rounded(groups.frequent_keys_per_group(props(spark, sf), "subcluster", "scaffold"), "percent")


@query(
    "key_report",
    f"select -1 as subcluster, scaffold, n from ({KEY_OVERALL}) union all select subcluster, scaffold, n from ({KEY_GROUP})",
    "props",
)
def key_report(spark, sf):
    parts = reports.key_report(props(spark, sf), "subcluster", "scaffold")
    return parts["overall"].select(F.lit(-1).alias("subcluster"), "scaffold", "n").unionByName(
        parts["per_subcluster"].select("subcluster", "scaffold", "n")
    )


@query(
    "top_report",
    f"""select 'overall' as part, {KEYS_SQL}, {q6('pic50')} as pic50 from (select * from props order by pic50 desc, {ROW_SQL} limit 20)
    union all select concat('subcluster ', subcluster), {KEYS_SQL}, {q6('pic50')} from
    (select *, row_number() over (partition by subcluster order by pic50 desc, {ROW_SQL}) as rank from props) where rank <= 20""",
    "props",
)
def top_report(spark, sf):
    parts = reports.top_report(props(spark, sf), "subcluster", "pic50", ROW)
    overall = parts["overall"].select(F.lit("overall").alias("part"), *KEYS, "pic50")
    per = parts["per_subcluster"].select(F.concat(F.lit("subcluster "), "subcluster").alias("part"), *KEYS, "pic50")
    return rounded(overall.unionByName(per), "pic50")


# Choices on a curve derived from the table: one point per line number.

CURVE = "curve as (select l_linenumber as k, sum(l_quantity) / pow(l_linenumber, 2) as inertia, avg(l_tax) as silhouette from props group by 1)"


def _curve(spark, sf):
    k = F.col("l_linenumber").alias("k")
    return props(spark, sf).groupBy(k).agg(
        F.sum("l_quantity").alias("q"), F.avg("l_tax").alias("silhouette")
    ).select("k", (F.col("q") / F.pow("k", F.lit(2))).alias("inertia"), "silhouette")


@query(
    "elbow",
    f"""with {CURVE}, steps as (select k, lag(inertia) over (order by k) - inertia as before,
    inertia - lead(inertia) over (order by k) as after from curve)
    select cast(coalesce(min(k) filter (where before > 2 * after), 0) as int) as elbow from steps""",
    "props",
)
def elbow(spark, sf):
    return groups.elbow(_curve(spark, sf))


@query("best_k", f"with {CURVE} select k as best_k from curve order by silhouette desc, k limit 1", "props")
def best_k(spark, sf):
    return groups.best_k(_curve(spark, sf))


@query(
    "union_reports",
    f"""select 'cluster' as part, cluster as id, count(pic50) as count, {STATS} from props group by cluster
    union all select 'subcluster', subcluster, count(pic50), {STATS} from props group by subcluster""",
    "props",
)
def union_reports(spark, sf):
    rows = props(spark, sf)
    out = [
        stats.group_stats(rows, [by], "pic50").select(F.lit(by).alias("part"), F.col(by).alias("id"), "count", "mean", "std", "min", "max")
        for by in ("cluster", "subcluster")
    ]
    return rounded(out[0].unionByName(out[1]), "mean", "std", "min", "max")


@query(
    "split",
    """select o_orderkey, ('0x' || substr(md5(cast(o_orderkey as varchar)), 1, 8))::bigint % 5 = 0 as is_test,
    cast((('0x' || substr(md5(cast(o_orderkey as varchar)), 1, 8))::bigint // 5) % 5 as int) as fold from orders""",
)
def split(spark, sf):
    from assayspark.operators import models

    return models.with_split(table(spark, sf, "orders"), "o_orderkey").select("o_orderkey", "is_test", "fold")


@query(
    "semi_restrict",
    "select doc_id, n_chars from documents where doc_id in (select doc_id from labels where quality = 1)",
)
def semi_restrict(spark, sf):
    good = table(spark, sf, "labels").where("quality = 1")
    return table(spark, sf, "documents").select("doc_id", "n_chars").join(good, "doc_id", "left_semi")


# Reports: parts of one dictionary, stacked to (part, key, value).


@query(
    "report_property",
    f"""with {VIOLATION_SIZES}, share as ({VIOLATION_SHARE}), summary(part, key, value) as (
      {' union all '.join(f"select 'mean', '{p}', avg({p}) from props union all select 'max', '{p}', cast(max({p}) as double) from props" for p in ('molwt', 'mollogp', 'hbd', 'hba'))})
    select part, key, {q6('value')} as value from summary union all select 'violations', cast(violations as varchar), cast(n as double) from share""",
    "props",
)
def report_property(spark, sf):
    rows = props(spark, sf).select("molwt", "mollogp", "hbd", "hba", "tpsa", "pic50")
    parts = reports.property_report(rows, exclude=("pic50",), rule_columns=RULE_COLUMNS)
    summary = parts["summary"].selectExpr("stack(2, 'mean', mean, 'max', max) as (part, value)", "property as key")
    violations = parts["violations"].selectExpr("'violations' as part", "cast(violations as string) as key", "double(n) as value")
    return rounded(summary.unionByName(violations), "value").select("part", "key", "value")


@query(
    "report_property_histogram",
    f"""with span as (select min(molwt) as lo, max(molwt) as hi, count(molwt) as n, quantile_cont(molwt, 0.25) as q1,
      quantile_cont(molwt, 0.75) as q3 from props),
    shape as (select lo, hi, cast(ceil((hi - lo) / least((hi - lo) / (log2(n) + 1),
      (q3 - q1) * 2 / pow(n, 1e0 / 3))) as int) as k from span),
    hits as (select cast(least(floor((molwt - lo) / ((hi - lo) / k)), k - 1) as int) as bin from props, shape),
    bins as (select cast(i as int) as bin, lo + i * ((hi - lo) / k) as low, lo + (i + 1) * ((hi - lo) / k) as high
      from shape, unnest(range(k)) t(i))
    select bin, {q6('low')} as low, {q6('high')} as high, count(hits.bin) as n
    from bins left join hits using (bin) group by all""",
    "props",
)
def report_property_histogram(spark, sf):
    return rounded(stats.histogram_auto(props(spark, sf), "molwt"), "low", "high")


@query(
    "report_property_activity",
    "select 'r' as part, property as key, r as value from ("
    + " union all ".join(f"select '{p}' as property, {corr_sql(p, 'pic50')} as r from props" for p in PROPERTIES)
    + ") union all "
    + " union all ".join(
        f"select 'slope', '{p}', case when isnan(regr_slope(pic50, {p})) then null else {q6(f'regr_slope(pic50, {p})')} end from props"
        for p in PROPERTIES
    ),
    "props",
)
def report_property_activity(spark, sf):
    rows = props(spark, sf).select(*KEYS, *PROPERTIES, "pic50")
    parts = reports.property_activity_report(rows, "pic50", PROPERTIES, exclude=KEYS, key=KEYS)
    r = parts["correlations"].select(F.lit("r").alias("part"), F.col("property").alias("key"), F.col("r").alias("value"))
    slopes = parts["trends"].select(F.lit("slope").alias("part"), F.col("property").alias("key"), F.col("slope").alias("value"))
    return rounded(r.unionByName(slopes), "value")


@query(
    "report_cluster",
    f"""select cluster, subcluster, count(pic50) as n, {q6('avg(pic50)')} as mean, {q6('quantile_cont(pic50, 0.25)')} as q1,
    {q6('median(pic50)')} as median, {q6('quantile_cont(pic50, 0.75)')} as q3 from props
    where cluster in (select cluster from props group by 1 having count(*) >= 10 and count(distinct subcluster) > 1)
    group by all""",
    "props",
)
def report_cluster(spark, sf):
    parts = reports.cluster_report(props(spark, sf), "pic50")
    found = parts["subcluster_stats"].join(parts["subcluster_box"].drop("n"), ["cluster", "subcluster"])
    return rounded(
        found.select("cluster", "subcluster", F.col("count").alias("n"), "mean", "q1", "median", "q3"),
        "mean", "q1", "median", "q3",
    )
