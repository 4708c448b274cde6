import math

import pytest
from pyspark.sql import functions as F

from assayspark.functions import activity as act, structure as st
from assayspark.operators import clean

NAN = float("nan")


def values(df, column):
    return [r[column] for r in df.collect()]


def test_number_text(spark):
    df = spark.createDataFrame([("1.5",), (" 2 ",), ("n/a",), ("NaN",), (None,), ("",)], "s string")
    assert values(df.select(act.to_number(F.col("s")).alias("v")), "v") == [1.5, 2.0, None, None, None, None]


def test_open_range_excludes_bounds_null_and_nan(spark):
    df = spark.createDataFrame([(0.0,), (1e7,), (5.0,), (-1.0,), (None,), (NAN,)], "v double")
    assert values(df.where(act.in_open_range(F.col("v"))), "v") == [5.0]


def test_class_edges(spark):
    edges = [5.999999999, 6.0, 6.999999999, 7.0, 7.999999999, 8.0, None, NAN, -1.0, 100.0]
    df = spark.createDataFrame([(e,) for e in edges], "p double")
    assert values(df.select(act.activity_class(F.col("p")).alias("c")), "c") == [
        "Low", "Moderate", "Moderate", "High", "High", "Very High", None, None, "Low", "Very High",
    ]


def test_units(spark):
    df = spark.createDataFrame([(10.0, "nM"), (10.0, "uM"), (10.0, "μM"), (10.0, "pM"), (10.0, "kg")], "v double, u string")
    got = values(df.select(act.log_activity_in(F.col("v"), F.col("u")).alias("p")), "p")
    assert got[:4] == pytest.approx([8.0, 5.0, 5.0, 11.0]) and got[4] is None


def test_violations_are_strict_and_skip_null(spark):
    df = spark.createDataFrame([(500.0, 5.0, 5, 10), (500.1, 5.1, 6, 11), (None, NAN, 6, None)], "a double, b double, c int, d int")
    names = {"mw": "a", "logp": "b", "hbd": "c", "hba": "d"}
    assert values(df.select(act.violation_count(names).alias("n")), "n") == [0, 4, 1]


def test_label_skips_missing_parts(spark):
    df = spark.createDataFrame([("a", None), ("b", "x")], "i string, t string")
    assert values(df.select(act.row_label([F.col("i"), F.col("t")]).alias("l")), "l") == ["a", "b<br>x"]


def test_size_rules(spark):
    sizes = [9, 59, 60, 149, 150, 299, 300, 599, 600]
    df = spark.createDataFrame([(n,) for n in sizes], "n bigint")
    assert values(df.select(act.subgroup_count_rule(F.col("n")).alias("k")), "k") == [2, 2, 3, 3, 4, 4, 5, 5, 6]
    assert values(df.select(act.largest_subgroup_count(F.col("n")).alias("k")), "k") == [2, 5, 6, 10, 10, 10, 10, 10, 10]


ROWS = [
    (1, "b", "CC", 5.0), (2, "a", "CC", 6.0), (3, "a", "CN", 7.0), (4, "a", "CC", 6.0),
    (5, "a", "CC", 6.5), (6, "c", "CO", 4.0), (7, None, "CO", 4.0),
]


@pytest.mark.parametrize("limit", [1, 1000])
@pytest.mark.parametrize("parts", [1, 16])
def test_three_stages(spark, limit, parts):
    """The same result whether groups are small or cut into slices, on any partitioning."""
    df = spark.createDataFrame(ROWS, "ord int, molecule_id string, structure string, p double").repartition(parts)
    exact = clean.drop_exact(df, ["molecule_id", "structure", "p"], "ord")
    assert exact.count() == 6
    by_id = {r.molecule_id: (r.structure, r.p) for r in clean.collapse_by_id(exact, limit=limit).collect()}
    assert by_id == {"a": ("CC", 6.5), "b": ("CC", 5.0), "c": ("CO", 4.0)}
    got = {r.molecule_id: (r.structure, r.p) for r in clean.remove_duplicates(df, limit=limit).collect()}
    assert got == {"a": ("CC", 5.75), "c": ("CO", 4.0)}
    counts = {r.stage: r.remaining for r in clean.duplicate_counts(df).collect()}
    assert counts == {"start": 7, "exact": 6, "id": 3, "structure": 2}


def test_first_structure_follows_source_order(spark):
    df = spark.createDataFrame([(2, "a", "X", 1.0), (1, "a", None, 2.0), (3, "a", "Y", 3.0)], "ord int, molecule_id string, structure string, p double")
    row = clean.collapse_by_id(df).first()
    assert (row.structure, row.p) == ("X", 2.0)


def test_empty_and_all_null(spark):
    empty = spark.createDataFrame([], "ord int, molecule_id string, structure string, p double")
    assert clean.remove_duplicates(empty).count() == 0
    raw = spark.createDataFrame([(1, "a", "C", None)], "ord int, molecule_id string, structure string, standard_value string")
    assert clean.with_log_activity(raw).count() == 0


def test_errors_keep_rows_and_count(spark):
    df = spark.createDataFrame([(f"bad{i}",) for i in range(7)] + [("1",)], "s string")
    checked = clean.split_valid(df, {"not a number": act.to_number(F.col("s")).isNull()})
    assert checked.count() == 8 and checked.where("error is null").count() == 1
    row = clean.error_summary(checked, "s").first()
    assert (row.errors, row.more) == (7, 2)
    assert [f.value for f in row.first_errors] == [f"bad{i}" for i in range(5)]


def test_columns(spark):
    df = spark.createDataFrame([(1, 2.0, "x", 3.0)], "a int, MW double, s string, LogP double")
    with pytest.raises(ValueError, match="b, c"):
        clean.require_columns(df, ["a", "b", "c"])
    assert clean.all_but(df, ["s"], prefixes=["MW", "LogP"]).columns == ["a"]
    assert clean.numeric_columns(df, ["a"], 1) == ["MW"]
    assert clean.resolve_aliases(df, [{"x": "nope"}, {"x": "MW"}]) == {"x": "MW"}
    assert clean.resolve_aliases(df, [{"x": "nope"}]) is None


def test_observed_rows(spark):
    df, seen = clean.counted(spark.range(10), "before")
    assert df.where("id > 3").count() == 6
    assert seen.get["rows"] == 10


TOKENS = {
    # structure: heavy, hetero, rings, halogens, aromatic
    "c1ccccc1": (6, 0, 1, 0, 6),
    "C[C@@H](N)C(=O)O": (6, 3, 0, 0, 0),
    "C%10CCCCC%10": (6, 0, 1, 0, 0),
    "[13CH4]": (1, 0, 0, 0, 0),
    "[H]O[H]": (1, 1, 0, 0, 0),
    "c1cc[nH]c1Br": (6, 2, 1, 1, 5),
    "[Na+].[Cl-]": (2, 2, 0, 1, 0),
    "C1CC2CCC1C2": (7, 0, 2, 0, 0),
    "": (0, 0, 0, 0, 0),
}


def test_token_counts(spark):
    df = spark.createDataFrame([(s,) for s in TOKENS], "s string")
    rows = df.select("s", st.token_counts(F.col("s")).alias("c")).select("s", "c.*").collect()
    assert {r.s: (r.heavy_atoms, r.hetero_atoms, r.ring_count, r.halogens, r.aromatic_atoms) for r in rows} == TOKENS
    weights = {r.s: r.heavy_weight for r in rows}
    assert weights["c1ccccc1"] == pytest.approx(6 * 12.011)
    assert spark.createDataFrame([(None,)], "s string").select(st.token_counts(F.col("s")).alias("c")).first().c is None


def brute_bits(text, n_bits, window):
    import hashlib

    grams = {text[i : i + window] for i in range(len(text) - window + 1)}
    return sorted({int(hashlib.md5(g.encode()).hexdigest()[:8], 16) % n_bits for g in grams})


def test_hashed_bits_against_brute_force(spark):
    texts = ["", "abc", "abcd", "CCCCCCCC", "c1ccccc1N(C)C", "naïve\ntext 😀 with 😀😀 marks", "x" * 5000 + "yz"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = values(df.select(st.hashed_bits(F.col("t"), 512, 4).alias("b")), "b")
    assert got == [brute_bits(t, 512, 4) for t in texts]


def test_hashed_bits_of_whole_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text")
    for r in df.select("text", st.hashed_bits(F.col("text"), 512, 4).alias("b")).limit(40).collect():
        assert r.b == brute_bits(r.text, 512, 4)


def test_structure_key(spark):
    cases = {"CC.Cl": "CC", "Cl.CC": "Cl", "C[C@@H](N)O": "C[CH](N)O", "F/C=C\\F": "FC=CF", "": "", "C.CC.CO": "CC"}
    df = spark.createDataFrame([(s,) for s in cases], "s string")
    assert dict(zip(cases, values(df.select(st.structure_key(F.col("s")).alias("k")), "k"))) == cases


def test_log_activity_matches_formula(spark):
    df = spark.createDataFrame([(v,) for v in (1.0, 37.5, 9e6)], "v double")
    got = values(df.select(act.log_activity(F.col("v")).alias("p")), "p")
    assert got == pytest.approx([9 - math.log10(v) for v in (1.0, 37.5, 9e6)])
