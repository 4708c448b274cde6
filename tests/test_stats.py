import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from assayspark.operators import groups, quantiles, stats

NAN = float("nan")


def table(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def numbers(spark, values, parts=4):
    return spark.createDataFrame([(v,) for v in values], "v double").repartition(parts)


@pytest.mark.parametrize("limit", [5, 100_000])
@pytest.mark.parametrize("parts", [1, 13])
def test_quantiles_with_a_hot_group(spark, limit, parts):
    """A third and more of all rows in one group, ties included; sliced and plain paths agree."""
    rng = random.Random(1)
    rows = [("hot", rng.choice([rng.gauss(5, 2), 5.0, 6.0])) for _ in range(4000)]
    rows += [(f"g{i % 900}", float(i % 7)) for i in range(4000)] + [("one", 3.0), ("nan", NAN), (None, 1.0)]
    df = table(spark, rows, "g string, v double").repartition(parts)
    wanted = {"q1": 0.25, "m": 0.5, "q3": 0.75, "lo": 0.0, "hi": 1.0}
    got = {r.g: r for r in quantiles.group_quantiles(df, ["g"], "v", wanted, "n", limit).collect()}
    by = {}
    for g, v in rows:
        if g is not None and not math.isnan(v):
            by.setdefault(g, []).append(v)
    assert set(got) == set(by)
    for g, vs in by.items():
        assert got[g].n == len(vs)
        assert [got[g][c] for c in wanted] == pytest.approx([float(np.quantile(vs, q)) for q in wanted.values()])


@pytest.mark.parametrize("limit", [5, 100_000])
def test_quantiles_of_a_whole_column(spark, limit):
    values = [math.exp(random.Random(i).gauss(0, 3)) for i in range(3000)]
    row = quantiles.group_quantiles(numbers(spark, values), [], "v", {"m": 0.5, "q": 0.1}, limit=limit).first()
    assert [row.m, row.q] == pytest.approx([np.quantile(values, 0.5), np.quantile(values, 0.1)])


def test_approximate_quantiles(spark):
    df = table(spark, [("a", float(i)) for i in range(1001)], "g string, v double")
    assert quantiles.approximate_quantiles(df, ["g"], "v", {"m": 0.5}).first().m == pytest.approx(500, abs=2)


def test_global_stats_edges(spark):
    one = stats.global_stats(numbers(spark, [2.0]), "v").first()
    assert (one.n, one.mean, one.std, one["median"]) == (1, 2.0, None, 2.0)
    none = stats.global_stats(numbers(spark, []), "v").first()
    assert none.n == 0 and none["median"] is None
    mixed = stats.global_stats(numbers(spark, [1.0, NAN, None, 3.0]), "v").first()
    assert (mixed.n, mixed["max"], mixed["median"]) == (2, 3.0, 2.0)


def test_histogram_edges(spark):
    df = numbers(spark, [2.9, 3.0, 3.999, 4.0, 9.0, 10.0, 10.1, NAN, None])
    assert {r.bin: r.n for r in stats.histogram_edges(df, "v").collect()} == {0: 2, 1: 1, 2: 0, 3: 0, 4: 0, 5: 0, 6: 2}


def test_histograms_against_numpy(spark):
    rng = np.random.default_rng(3)
    values = rng.normal(6, 1, 700).tolist()
    df = numbers(spark, values)
    for bins, got in ((20, stats.histogram_equal(df, "v", 20)), ("auto", stats.histogram_auto(df, "v"))):
        counts, edges = np.histogram(values, bins=bins)
        rows = got.orderBy("bin").collect()
        assert [r.n for r in rows] == counts.tolist()
        assert [r.low for r in rows] == pytest.approx(edges[:-1].tolist())


def test_histograms_of_odd_columns(spark):
    assert stats.histogram_equal(numbers(spark, []), "v").count() == 0
    assert stats.histogram_auto(numbers(spark, []), "v").count() == 0
    flat = stats.histogram_equal(numbers(spark, [5.0] * 4), "v", 4).orderBy("bin").collect()
    assert sum(r.n for r in flat) == 4 and flat[0].low == 4.5 and flat[-1].high == 5.5
    assert [r.n for r in stats.histogram_auto(numbers(spark, [5.0] * 4), "v").collect()] == [4]


def test_density(spark):
    rng = np.random.default_rng(5)
    values = np.round(rng.normal(6, 1, 300), 1)
    got = stats.density(numbers(spark, values.tolist()), "v", 50).orderBy("point").collect()
    h = len(values) ** -0.2 * values.std(ddof=1)
    grid = np.linspace(values.min() - 3 * h, values.max() + 3 * h, 50)
    want = np.exp(-0.5 * ((grid[:, None] - values) / h) ** 2).sum(axis=1) / (len(values) * h * math.sqrt(2 * math.pi))
    assert [r.x for r in got] == pytest.approx(grid.tolist())
    assert [r.density for r in got] == pytest.approx(want.tolist())
    assert stats.density(numbers(spark, [1.0]), "v").count() == 0


def test_box_numbers(spark):
    rows = [("a", float(v)) for v in (1, 2, 3, 4, 5, 100)] + [("b", 7.0)]
    df = table(spark, rows, "g string, v double")
    got = {r.g: r for r in stats.box_numbers(df, "g", "v").collect()}
    a = got["a"]
    assert (a.n, a.q1, a["median"], a.q3, a.whisker_low, a.whisker_high, a.outliers) == (6, 2.25, 3.5, 4.75, 1.0, 5.0, 1)
    assert (got["b"].whisker_low, got["b"].outliers) == (7.0, 0)
    assert [r.v for r in stats.box_outliers(df, "g", "v").collect()] == [100.0]


def test_distributions_keep_empty_classes(spark):
    got = {r["class"]: (r.n, r.percent) for r in stats.class_distribution(numbers(spark, [5.0, 5.5, 9.0, NAN, None]), "v").collect()}
    assert got["Low"][0] == 2 and got["Moderate"] == (0, 0.0) and got["Very High"][1] == pytest.approx(100 / 3)
    assert {r["class"]: r.percent for r in stats.class_distribution(numbers(spark, []), "v").collect()}["Low"] is None
    rows = stats.violation_distribution(numbers(spark, [0.0, 2.0]), F.col("v").cast("int")).orderBy("violations").collect()
    assert [r.n for r in rows] == [1, 0, 1, 0, 0]


def test_correlations(spark):
    rows = [(1.0, 2.0, 5.0, None), (2.0, 1.0, 5.0, 1.0), (3.0, 5.0, 5.0, 3.0), (4.0, 4.5, 5.0, 2.0), (5.0, NAN, 5.0, 6.0)]
    df = table(spark, rows, "y double, a double, c double, g double")
    got = {r.property: r.r for r in stats.correlation_with(df, ["a", "c", "g"], "y").collect()}
    assert got["c"] is None
    assert got["a"] == pytest.approx(np.corrcoef([1, 2, 3, 4], [2, 1, 5, 4.5])[0, 1])
    assert got["g"] == pytest.approx(np.corrcoef([2, 3, 4, 5], [1, 3, 2, 6])[0, 1])
    m = {(r.col_a, r.col_b): r.r for r in stats.correlation_matrix(df, ["y", "a", "c", "g"]).collect()}
    assert m["a", "y"] == m["y", "a"] == pytest.approx(got["a"])
    assert m["a", "g"] == pytest.approx(np.corrcoef([1, 5, 4.5], [1, 3, 2])[0, 1])
    assert m["c", "c"] is None and m["y", "y"] == 1.0 and m["c", "y"] is None
    wide = stats.wide_matrix(stats.correlation_matrix(df, ["y", "a"]), ["y", "a"])
    assert wide.columns == ["col_a", "y", "a"] and [r.col_a for r in wide.collect()] == ["y", "a"]


def test_trend_of_constant_is_null(spark):
    df = table(spark, [(1.0, 2.0, 5.0), (2.0, 4.0, 5.0)], "x double, y double, c double")
    line = stats.trend_line(df, "x", "y").first()
    assert (line.slope, line.intercept) == pytest.approx((2.0, 0.0))
    assert stats.trend_line(df, "c", "y").first().slope is None


def test_metrics(spark):
    df = table(spark, [(1.0, 1.5), (2.0, 2.0), (4.0, 3.0), (None, 1.0)], "y double, f double")
    row = stats.regression_metrics(df, "y", "f").first()
    assert (row.n, row.rmse, row.mae) == (3, pytest.approx(math.sqrt(1.25 / 3)), pytest.approx(0.5))
    assert row.r2 == pytest.approx(1 - 1.25 / np.var([1, 2, 4]) / 3)


def test_eligible_groups(spark):
    rows = [(g, i % 2 if g != "flat" else 0) for g, n in (("a", 9), ("b", 10), ("c", 60), ("flat", 30)) for i in range(n)]
    df = table(spark, rows, "g string, s int")
    assert {r.g for r in stats.eligible_groups(df, "g", 10).collect()} == {"b", "c", "flat"}
    got = {r.g: r.small for r in stats.eligible_groups(df, "g", 10, "s").collect()}
    assert got == {"b": True, "c": False}


def test_rankings_break_ties_by_key(spark):
    df = table(spark, [("a", 1, 5.0), ("a", 2, 5.0), ("a", 3, 6.0), ("b", 4, None), ("b", 5, 1.0), (None, 6, 9.0)], "g string, id int, v double")
    top = groups.top_n_per_group(df, ["g"], "v", 2, ["id"])
    assert sorted((r.g, r.rank, r.id) for r in top.collect()) == [("a", 1, 3), ("a", 2, 1), ("b", 1, 5), ("b", 2, 4)]
    assert [r.id for r in groups.top_n(df, "v", 3, ["id"]).collect()] == [6, 3, 1]
    assert [r.g for r in groups.sorted_keys(df, "g").collect()] == ["a", "b"]


def test_frequent_keys_drop_empty_after_the_cut(spark):
    rows = [("g", k) for k, n in (("", 5), ("x", 4), ("y", 4), ("z", 1)) for _ in range(n)]
    df = table(spark, rows, "s string, k string")
    assert [(r.k, r.n) for r in groups.frequent_keys(df, "k", 3).orderBy("k").collect()] == [("x", 4), ("y", 4)]
    got = groups.frequent_keys_per_group(df, "s", "k", 2).collect()
    assert [(r.k, r.n) for r in got] == [("x", 4)] and got[0].percent == pytest.approx(400 / 14)
    shares = {r.k: r.percent for r in groups.share_of_group(df, ["s"], "k").collect()}
    assert sum(shares.values()) == pytest.approx(100)


def test_curve_choices(spark):
    bend = table(spark, [(1, 100.0, None), (2, 50.0, 0.4), (3, 45.0, 0.6), (4, 41.0, 0.6)], "k int, inertia double, silhouette double")
    assert groups.elbow(bend).first()[0] == 2 and groups.best_k(bend).first()[0] == 3
    flat = table(spark, [(k, 100.0 - 10 * k, None) for k in range(1, 5)], "k int, inertia double, silhouette double")
    assert groups.elbow(flat).first()[0] == 0 and groups.best_k(flat).first()[0] is None


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans(spark):
    """Filters reach the scan, rankings are cut before the shuffle, and no Python runs."""
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    top = groups.top_n_per_group(df.where("l_tax > 0.05"), ["l_suppkey"], "l_quantity", 3, ["l_orderkey"])
    text = plan(top)
    assert "WindowGroupLimit" in text and "GreaterThan(l_tax,0.05)" in text and "Python" not in text
    text = plan(stats.group_stats(df, ["l_suppkey"], "l_quantity"))
    assert "partial_" in text and "ReadSchema: struct<l_suppkey:bigint,l_quantity:double>" in text
    assert "TakeOrderedAndProject" in plan(groups.top_n(df, "l_quantity", 5, ["l_orderkey"]))
