import datetime as dt

import pytest
from pyspark.sql import functions as F

from assayspark.session import forget_settled, new_path, settle, shared_folder
from assayspark.sources import extract, files


def test_extract_pushes_filters_and_prunes(spark):
    path = new_path(spark, "raw")
    rows = [(i, f"M{i}", "C", "1", "IC50" if i % 2 else "Ki", "nM", f"T{i % 3}", "x") for i in range(30)]
    schema = "ord int, molecule_id string, structure string, standard_value string, standard_type string, units string, target string, other string"
    spark.createDataFrame(rows, schema).write.parquet(path)
    got = extract.activity_extract(spark.read.parquet(path), "T1")
    plan = got._jdf.queryExecution().executedPlan().toString()
    for f in ("EqualTo(target,T1)", "EqualTo(standard_type,IC50)", "EqualTo(units,nM)"):
        assert f in plan
    assert "other" not in plan and got.count() == 5
    kept = extract.activity_extract(spark.read.parquet(path), "T1", columns=("ord", "molecule_id"))
    assert [r.ord for r in extract.first_records(kept, "ord", 2).collect()] == [1, 7]


def test_snapshots(spark):
    day = lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(days=n)
    rows = [("a", 1, day(0)), ("a", 2, day(10)), ("a", 3, day(10)), ("a", 4, day(50)), ("b", 5, day(1)), ("c", 6, day(-40))]
    df = spark.createDataFrame(rows, "k string, id int, at timestamp")
    as_of = F.lit(day(20))
    got = extract.latest_snapshot(df, ["k"], "at", as_of)
    assert sorted(r.id for r in got.collect()) == [2, 3, 5]
    newest = extract.latest_by_key(extract.fresh_rows(df, "at", as_of), ["k"], "at", "id")
    assert sorted(r.id for r in newest.collect()) == [3, 5]


def test_text_and_csv(spark):
    path = new_path(spark, "text")
    spark.createDataFrame([(" CC \t",), ("",), ("\t \r",), ("CN",)], "value string").coalesce(1).write.text(path)
    assert sorted(r.value for r in files.read_lines(spark, path).collect()) == ["CC", "CN"]
    assert files.structure_column(["id", "Canonical_SMILES", "smiles2"]) == "Canonical_SMILES"
    assert files.structure_column(["id", "b"]) == "id"
    table = spark.createDataFrame([(1, "a,b"), (2, None)], "i int, s string")
    path = new_path(spark, "csv")
    files.write_table(table, path, "csv")
    assert sorted(files.read_csv(spark, path, table.schema).collect()) == sorted(table.collect())


def test_runs_and_inventory(spark):
    path = new_path(spark, "runs")
    files.write_run(spark.range(3), path, "20240101")
    files.write_run(spark.range(5), path, "20240102")
    files.write_run(spark.range(4), path, "20240101")
    assert files.read_run(spark, path, "20240101").count() == 4 and files.read_run(spark, path, "20240102").count() == 5
    plan = files.read_run(spark, path, "20240101")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_id" in plan
    found = files.run_inventory(files.file_inventory(spark, path, "*.parquet"), r"run_id=(\d+)/", {"has_part": "part-", "has_model": "model"})
    rows = {r.run_id: r for r in found.collect()}
    assert set(rows) == {"20240101", "20240102"} and rows["20240101"].has_part and not rows["20240101"].has_model
    with pytest.raises(ValueError, match="run_id"):
        files.write_run(spark.range(1), path, "")


def test_settled_tables_are_in_the_shared_folder(spark):
    df = settle(spark.range(3).withColumn("x", F.array(F.lit(1))))
    assert shared_folder(spark) in df.inputFiles()[0] and df.count() == 3
    assert settle(spark.createDataFrame([], "a int")).count() == 0
    kept = new_path(spark, "kept")
    spark.range(2).write.parquet(kept)
    assert forget_settled(spark) >= 2 and forget_settled(spark) == 0
    assert spark.read.parquet(kept).count() == 2


def test_run_ids_and_ages(spark):
    df = spark.sql("select timestamp '2024-03-05 12:00:00' as t")
    row = df.select(files.run_id_of(F.col("t")).alias("r"), extract.age_in_days(F.col("t"), F.expr("timestamp '2024-03-07 00:00:00'")).alias("a")).first()
    assert row.r == "20240305" and row.a == 1.5
