"""Queries over measured activities: extract, clean, collapse, classify."""

from __future__ import annotations

from pyspark.sql import functions as F

from assayspark.functions import activity as act, structure as st
from assayspark.operators import clean, groups, stats
from assayspark.plans import reports
from assayspark.session import new_path
from assayspark.sources import extract, files
from workload.registry import activity_raw, props, q6, query, r6, rounded, structures, table

AS_OF = "timestamp '2024-01-20 00:00:00'"
KEY = "case when strpos(structure, '.') > 0 then substr(structure, 1, strpos(structure, '.') - 1) else structure end"


def cleaned(spark, sf):
    return clean.with_log_activity(activity_raw(spark, sf)).select(
        "ord", "molecule_id", "structure", "target", "units", "p"
    )


# The three duplicate stages as SQL, after `clean`.
EXACT = "exact_rows as (select molecule_id, structure, p, min(ord) as ord from clean group by all)"
BY_ID = "by_id as (select molecule_id, arg_min(structure, ord) as structure, median(p) as p from exact_rows group by 1)"
BY_KEY = (
    f"by_key as (select min(molecule_id) as molecule_id, arg_min(structure, molecule_id) as structure, "
    f"median(p) as p from by_id group by {KEY})"
)
CLASS = "case when p < 6 then 'Low' when p < 7 then 'Moderate' when p < 8 then 'High' else 'Very High' end"
CLASSES = "classes(ord, class) as (values (0, 'Low'), (1, 'Moderate'), (2, 'High'), (3, 'Very High'))"


@query(
    "activity_classes_of_target",
    f"""with target_rows as (select * from clean where target = 'T1' and units = 'nM'),
    {EXACT.replace('from clean', 'from target_rows')}, {BY_ID}, {BY_KEY}, {CLASSES},
    sizes as (select {CLASS} as class, count(*) as n, avg(p) as mean_p from by_key group by 1)
    select class, coalesce(n, 0) as n, {q6('100e0 * coalesce(n, 0) / (select sum(n) from sizes)')} as percent,
      {q6('mean_p')} as mean_p from classes left join sizes using (class)""",
    "activity_raw", "clean",
)
def activity_classes_of_target(spark, sf):
    """For one target, how many distinct compounds fall in each activity class?"""
    rows = activity_raw(spark, sf).where("target = 'T1' and units = 'nM'")
    compounds = clean.remove_duplicates(clean.with_log_activity(rows))
    share = stats.class_distribution(compounds, "p")
    means = compounds.groupBy(act.activity_class(F.col("p")).alias("class")).agg(F.avg("p").alias("mean_p"))
    return rounded(share.join(means, "class", "left").select("class", "n", "percent", "mean_p"), "percent", "mean_p")


@query(
    "activity_extract",
    "select molecule_id, structure, standard_value from activity_raw "
    "where target = 'T1' and standard_type = 'click' and units = 'nM'",
    "activity_raw",
)
def activity_extract(spark, sf):
    return extract.activity_extract(activity_raw(spark, sf), "T1", "click", "nM")


@query(
    "limited_extract",
    "select ord, molecule_id, structure, standard_value from activity_raw "
    "where target = 'T1' and standard_type = 'click' and units = 'nM' order by ord limit 200",
    "activity_raw",
)
def limited_extract(spark, sf):
    rows = extract.activity_extract(
        activity_raw(spark, sf), "T1", "click", "nM", ("ord", *extract.EXTRACT_COLUMNS)
    )
    return extract.first_records(rows, "ord", 200)


@query(
    "fresh_snapshot",
    f"""with fresh as (select * from activity_raw where fetched_at > {AS_OF} - interval 30 days and fetched_at <= {AS_OF})
    select ord, molecule_id, target, standard_type, units from fresh
    qualify row_number() over (partition by molecule_id, standard_type, units order by fetched_at desc, ord desc) = 1""",
    "activity_raw",
)
def fresh_snapshot(spark, sf):
    fresh = extract.fresh_rows(activity_raw(spark, sf), "fetched_at", F.expr(AS_OF))
    return extract.latest_by_key(fresh, ["molecule_id", "standard_type", "units"], "fetched_at", "ord").select(
        "ord", "molecule_id", "target", "standard_type", "units"
    )


@query(
    "snapshot_day",
    f"""with daily as (select *, date_trunc('day', fetched_at) as snapshot from activity_raw),
    newest as (select target, standard_type, units, max(snapshot) as snapshot from daily
      where snapshot > {AS_OF} - interval 30 days and snapshot <= {AS_OF} group by all)
    select ord, target, standard_type, units from daily semi join newest using (target, standard_type, units, snapshot)""",
    "activity_raw",
)
def snapshot_day(spark, sf):
    daily = activity_raw(spark, sf).withColumn("snapshot", F.date_trunc("day", "fetched_at"))
    return extract.latest_snapshot(
        daily, ["target", "standard_type", "units"], "snapshot", F.expr(AS_OF)
    ).select("ord", "target", "standard_type", "units")


@query(
    "not_null",
    "select ord, standard_value from activity_raw where standard_value is not null and structure is not null",
    "activity_raw",
)
def not_null(spark, sf):
    return activity_raw(spark, sf).where("standard_value is not null and structure is not null").select(
        "ord", "standard_value"
    )


@query(
    "drop_any_null",
    "select molecule_id, structure, standard_value from activity_raw where molecule_id is not null "
    "and structure is not null and standard_value is not null",
    "activity_raw",
)
def drop_any_null(spark, sf):
    return activity_raw(spark, sf).select("molecule_id", "structure", "standard_value").na.drop("any")


@query("to_number", "select ord, try_cast(standard_value as double) as v from activity_raw", "activity_raw")
def to_number(spark, sf):
    return activity_raw(spark, sf).select("ord", act.to_number(F.col("standard_value")).alias("v"))


@query(
    "range_open",
    "select ord, try_cast(standard_value as double) as v from activity_raw "
    "where try_cast(standard_value as double) > 0 and try_cast(standard_value as double) < 1e7",
    "activity_raw",
)
def range_open(spark, sf):
    return to_number(spark, sf).where(act.in_open_range(F.col("v")))


@query("log_activity", f"select ord, {q6('p')} as p from clean", "activity_raw", "clean")
def log_activity(spark, sf):
    return rounded(cleaned(spark, sf).select("ord", "p"), "p")


@query(
    "log_activity_units",
    f"""select ord, {q6('''-log10(try_cast(standard_value as double) * case units when 'nM' then 1e-9
      when 'uM' then 1e-6 when 'pM' then 1e-12 end)''')} as p from activity_raw
    where try_cast(standard_value as double) > 0 and try_cast(standard_value as double) < 1e7""",
    "activity_raw",
)
def log_activity_units(spark, sf):
    rows = activity_raw(spark, sf).withColumn("v", act.to_number(F.col("standard_value")))
    kept = rows.where(act.in_open_range(F.col("v")))
    return kept.select("ord", r6(act.log_activity_in(F.col("v"), F.col("units"))).alias("p"))


@query("activity_class", f"select ord, {CLASS} as class from clean", "activity_raw", "clean")
def activity_class(spark, sf):
    return cleaned(spark, sf).select("ord", act.activity_class(F.col("p")).alias("class"))


@query(
    "valid_rejected",
    """select ord, standard_value, case when standard_value is null then 'no value'
      when try_cast(standard_value as double) is null then 'not a number'
      when not (try_cast(standard_value as double) > 0 and try_cast(standard_value as double) < 1e7) then 'out of range'
      end as error from activity_raw""",
    "activity_raw",
)
def valid_rejected(spark, sf):
    return _checked(spark, sf).select("ord", "standard_value", "error")


def _checked(spark, sf):
    number = act.to_number(F.col("standard_value"))
    return clean.split_valid(
        activity_raw(spark, sf),
        {
            "no value": F.col("standard_value").isNull(),
            "not a number": number.isNull(),
            "out of range": ~act.in_open_range(number),
        },
    )


@query(
    "rejected_summary",
    """with bad as (select standard_value as v, case when standard_value is null then 'no value'
        when try_cast(standard_value as double) is null then 'not a number' else 'out of range' end as error
      from activity_raw where try_cast(standard_value as double) is null
        or not (try_cast(standard_value as double) > 0 and try_cast(standard_value as double) < 1e7)),
    top as (select coalesce(v, '') as v, error from bad order by v, error limit 5)
    select (select count(*) from bad) as errors, (select count(*) from bad) - 5 as more,
      string_agg(concat(v, ': ', error), '; ' order by v, error) as first from top""",
    "activity_raw",
)
def rejected_summary(spark, sf):
    rows = _checked(spark, sf).withColumn("standard_value", F.coalesce("standard_value", F.lit("")))
    row = clean.error_summary(rows, "standard_value")
    return row.select(
        "errors", "more", F.expr("array_join(transform(first_errors, e -> concat(e.value, ': ', e.error)), '; ')").alias("first")
    )


@query(
    "dedupe_exact",
    f"with {EXACT} select molecule_id, structure, {q6('p')} as p, ord from exact_rows",
    "activity_raw", "clean",
)
def dedupe_exact(spark, sf):
    return rounded(clean.drop_exact(cleaned(spark, sf), ["molecule_id", "structure", "p"], "ord"), "p")


@query(
    "dedupe_by_id",
    f"with {EXACT}, {BY_ID} select molecule_id, structure, {q6('p')} as p from by_id",
    "activity_raw", "clean",
)
def dedupe_by_id(spark, sf):
    exact = clean.drop_exact(cleaned(spark, sf), ["molecule_id", "structure", "p"], "ord")
    return rounded(clean.collapse_by_id(exact), "p")


@query(
    "dedupe_by_structure",
    f"with {EXACT}, {BY_ID}, {BY_KEY} select molecule_id, structure, {q6('p')} as p from by_key",
    "activity_raw", "clean",
)
def dedupe_by_structure(spark, sf):
    return rounded(clean.remove_duplicates(cleaned(spark, sf)).select("molecule_id", "structure", "p"), "p")


@query(
    "dedupe_stages",
    f"""with {EXACT}, {BY_ID} select 0 as step, 'start' as stage, count(*) as remaining from clean
    union all select 1, 'exact', count(*) from exact_rows union all select 2, 'id', count(*) from by_id
    union all select 3, 'structure', count(distinct {KEY}) from by_id""",
    "activity_raw", "clean",
)
def dedupe_stages(spark, sf):
    return clean.duplicate_counts(cleaned(spark, sf))


@query(
    "global_stats",
    f"""select count(p) as n, {q6('min(p)')} as min, {q6('max(p)')} as max, {q6('avg(p)')} as mean,
    {q6('stddev_samp(p)')} as std, {q6('median(p)')} as median from clean""",
    "activity_raw", "clean",
)
def global_stats(spark, sf):
    return rounded(stats.global_stats(cleaned(spark, sf), "p"), "min", "max", "mean", "std", "median")


@query(
    "class_distribution",
    f"""with {CLASSES}, sizes as (select {CLASS} as class, count(*) as n from clean group by 1)
    select ord, class, coalesce(n, 0) as n, {q6('100e0 * coalesce(n, 0) / (select sum(n) from sizes)')} as percent
    from classes left join sizes using (class)""",
    "activity_raw", "clean",
)
def class_distribution(spark, sf):
    return rounded(stats.class_distribution(cleaned(spark, sf), "p"), "percent")


EDGE_BINS = """bins as (select cast(i as int) as bin, 3e0 + i as low, 4e0 + i as high from range(7) t(i)),
  hits as (select case when p = 10 then 6 else cast(floor(p) as int) - 3 end as bin from clean where p >= 3 and p <= 10)"""


@query(
    "histogram_edges",
    f"""with {EDGE_BINS} select bin, low, high, count(hits.bin) as n from bins left join hits using (bin) group by all""",
    "activity_raw", "clean",
)
def histogram_edges(spark, sf):
    return stats.histogram_edges(cleaned(spark, sf), "p")


EQUAL = """span as (select min(p) as lo, max(p) as hi from clean),
  hits as (select cast(least(floor((p - lo) / ((hi - lo) / 20)), 19) as int) as bin from clean, span),
  bins as (select cast(i as int) as bin, lo + i * ((hi - lo) / 20) as low, lo + (i + 1) * ((hi - lo) / 20) as high
    from range(20) t(i), span)"""


@query(
    "histogram_equal",
    f"""with {EQUAL} select bin, {q6('low')} as low, {q6('high')} as high, count(hits.bin) as n
    from bins left join hits using (bin) group by all""",
    "activity_raw", "clean",
)
def histogram_equal(spark, sf):
    return rounded(stats.histogram_equal(cleaned(spark, sf), "p"), "low", "high")


@query(
    "histogram_auto",
    f"""with span as (select min(p) as lo, max(p) as hi, count(p) as n, quantile_cont(p, 0.25) as q1,
      quantile_cont(p, 0.75) as q3 from clean),
    shape as (select lo, hi, cast(ceil((hi - lo) / least((hi - lo) / (log2(n) + 1),
      (q3 - q1) * 2 / pow(n, 1e0 / 3))) as int) as k from span),
    hits as (select cast(least(floor((p - lo) / ((hi - lo) / k)), k - 1) as int) as bin from clean, shape),
    bins as (select cast(i as int) as bin, lo + i * ((hi - lo) / k) as low, lo + (i + 1) * ((hi - lo) / k) as high
      from shape, unnest(range(k)) t(i))
    select bin, {q6('low')} as low, {q6('high')} as high, count(hits.bin) as n
    from bins left join hits using (bin) group by all""",
    "activity_raw", "clean",
)
def histogram_auto(spark, sf):
    return rounded(stats.histogram_auto(cleaned(spark, sf), "p"), "low", "high")


@query(
    "row_loss",
    """select count(*) as before, count(v) filter (where v > 0 and v < 1e7) as kept,
      count(*) - count(v) filter (where v > 0 and v < 1e7) as lost
    from (select try_cast(standard_value as double) as v from activity_raw)""",
    "activity_raw",
)
def row_loss(spark, sf):
    rows = to_number(spark, sf)
    return clean.row_loss(rows, act.in_open_range(F.col("v")))


@query(
    "report_activity",
    f"""with {EQUAL}, {CLASSES}, sizes as (select {CLASS} as class, count(*) as n from clean group by 1)
    select 'class' as part, class as label, cast(coalesce(n, 0) as double) as value from classes left join sizes using (class)
    union all select 'bin', cast(bin as varchar), cast(count(hits.bin) as double)
      from bins left join hits using (bin) group by bin
    union all (with d(label, value) as (select 'n', cast(count(p) as double) from clean
      union all select 'mean', {q6('avg(p)')} from clean union all select 'std', {q6('stddev_samp(p)')} from clean
      union all select 'median', {q6('median(p)')} from clean union all select 'min', {q6('min(p)')} from clean
      union all select 'max', {q6('max(p)')} from clean) select 'stat', label, value from d)""",
    "activity_raw", "clean",
)
def report_activity(spark, sf):
    parts = reports.activity_report(cleaned(spark, sf), "p")
    stat = parts["stats"].selectExpr(
        "stack(6, 'n', double(n), 'mean', mean, 'std', std, 'median', median, 'min', min, 'max', max) as (label, value)"
    )
    return (
        parts["classes"].select(F.lit("class").alias("part"), F.col("class").alias("label"), F.col("n").cast("double").alias("value"))
        .unionByName(parts["histogram"].select(F.lit("bin").alias("part"), F.col("bin").cast("string").alias("label"), F.col("n").cast("double").alias("value")))
        .unionByName(stat.select(F.lit("stat").alias("part"), "label", r6("value").alias("value")))
    )


@query(
    "all_but",
    "select * exclude (fetched_at, standard_type, structure) from activity_raw",
    "activity_raw",
)
def all_but(spark, sf):
    return clean.all_but(activity_raw(spark, sf), ["fetched_at", "structure"], prefixes=["standard_t"])


@query("structure_key", f"select id, {KEY} as key from structures", "structures")
def structure_key(spark, sf):
    return structures(spark, sf).select("id", st.structure_key(F.col("structure")).alias("key"))


@query(
    "row_labels",
    f"""select ord, concat_ws('<br>', molecule_id, printf('p: %.2f', p), case when target <> 'T0' then concat('Target: ', target) end)
    as label from clean""",
    "activity_raw", "clean",
)
def row_labels(spark, sf):
    target = F.when(F.col("target") != "T0", F.concat(F.lit("Target: "), "target"))
    return cleaned(spark, sf).select(
        "ord", act.row_label([F.col("molecule_id"), F.format_string("p: %.2f", "p"), target]).alias("label")
    )


# Files: written to the shared folder, read back, compared with the tables they came from.


@query(
    "csv_roundtrip",
    "select ord, molecule_id, structure, standard_value from activity_raw",
    "activity_raw",
)
def csv_roundtrip(spark, sf):
    path = new_path(spark, "csv")
    rows = activity_raw(spark, sf).select("ord", "molecule_id", "structure", "standard_value")
    files.write_table(rows, path, "csv")
    return files.read_csv(spark, path, rows.schema)


@query(
    "text_lines",
    r"""select value from (select unnest(string_split_regex(text, '\r\n|\n|\r')) as line from documents),
    (select 1), lateral (select regexp_replace(line, '^\s+|\s+$', '', 'g') as value) where length(value) > 0""",
)
def text_lines(spark, sf):
    path = new_path(spark, "text")
    table(spark, sf, "documents").select("text").write.text(path)
    return files.read_lines(spark, path)


@query(
    "text_report",
    """select printf('%s: r = %.3f', molecule_id, median(p)) as value from clean group by molecule_id""",
    "activity_raw", "clean",
)
def text_report(spark, sf):
    from assayspark.operators.quantiles import group_quantiles

    path = new_path(spark, "report")
    medians = group_quantiles(cleaned(spark, sf), ["molecule_id"], "p", {"m": 0.5})
    files.write_report(medians.select(F.format_string("%s: r = %.3f", "molecule_id", "m").alias("line")), "line", path)
    return spark.read.text(path)


@query(
    "run_partition",
    f"select ord, {q6('p')} as p, 'T1' as run_id from clean where target = 'T1'",
    "activity_raw", "clean",
)
def run_partition(spark, sf):
    path = new_path(spark, "runs")
    rows = cleaned(spark, sf)
    files.write_table(rows.select("ord", "p", F.col("target").alias("run_id")), path, partition_by=["run_id"])
    return rounded(files.read_run(spark, path, "T1").select("ord", "p", "run_id"), "p")


@query("file_inventory")
def file_inventory(spark, sf):
    found = files.file_inventory(spark, sf, "*.parquet")
    return files.run_inventory(
        found, r"/([^/]+)/[^/]+\.parquet$", {"has_raw": r"/events\.", "has_features": r"/part\.", "has_vectors": r"/embeddings\."}
    )


@query(
    "run_ages",
    f"""select strftime(fetched_at, '%Y%m%d') as run_id, count(*) as n,
    {q6("min((epoch_us(" + AS_OF + ") - epoch_us(fetched_at)) / 86400e6)")} as age_days from activity_raw group by 1""",
    "activity_raw",
)
def run_ages(spark, sf):
    age = extract.age_in_days(F.col("fetched_at"), F.expr(AS_OF))
    return (
        activity_raw(spark, sf)
        .groupBy(files.run_id_of(F.col("fetched_at")).alias("run_id"))
        .agg(F.count("*").alias("n"), r6(F.min(age)).alias("age_days"))
    )


@query("preview", "select * from orders order by o_orderkey limit 5")
def preview(spark, sf):
    return extract.first_records(table(spark, sf, "orders"), "o_orderkey", 5)
