import numpy as np
import pytest
from pyspark.sql import functions as F

from assayspark.operators import features as ft, models, stats
from assayspark.plans import analysis, reports
from assayspark.plans.scoring import Predictor
from assayspark.session import new_path

FOREST = {"numTrees": 10, "maxDepth": 6, "featureSubsetStrategy": "all"}
BOOSTED = {"maxIter": 5, "maxDepth": 3, "stepSize": 0.3}
GRID = {"rf": {"numTrees": [5], "maxDepth": [2, 5]}, "gbt": {"maxIter": [5], "maxDepth": [2, 3]}}


@pytest.fixture(scope="module")
def planted(spark):
    rng = np.random.default_rng(2)
    x = rng.uniform(-1, 1, (300, 4))
    rows = [(i, int(i % 3) if i < 290 else 7, float(7 + 1.5 * r[0]), [float(v) for v in r]) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "id bigint, cluster int, p double, x array<double>")
    return df.withColumn("features", ft.dense_vector(F.col("x"))).withColumn("subcluster", F.lit(0)).cache()


def test_split(spark):
    df = models.with_split(spark.range(5000), "id")
    tests = {r.id for r in df.where("is_test").collect()}
    again = models.with_split(spark.range(5000).repartition(13), "id")
    assert {r.id for r in again.where("is_test").collect()} == tests and 900 < len(tests) < 1100
    folds = [r["count"] for r in df.where("not is_test").groupBy("fold").count().collect()]
    assert len(folds) == 5 and min(folds) > 650


def test_models_beat_the_mean(spark, planted):
    rows = []
    for kind, settings in (("rf", FOREST), ("gbt", BOOSTED)):
        model, metrics, pairs = models.build_model(planted, "id", kind=kind, settings=settings)
        assert metrics.first().r2 > 0.8 and pairs.count() == metrics.first().n
        top = models.top_weights(models.feature_weights(model, ["a", "b", "c", "d"]), 2).collect()
        assert top[-1].feature == "a" and len(top) == 2 and top[0].weight <= top[1].weight
        rows.append(metrics)
    best = models.compare_models(rows).collect()
    assert best[0].rmse <= best[1].rmse
    with pytest.raises(ValueError, match="svm"):
        models.build_model(planted, "id", kind="svm")


def test_model_per_cluster(spark, planted):
    report, fitted = models.model_per_cluster(planted, "id", settings=FOREST)
    rows = {r.cluster: r for r in report.collect()}
    assert set(rows) == set(fitted) == {0, 1, 2} and all(r.r2 > 0.5 and r.n_compounds > 90 for r in rows.values())
    none, fitted = models.model_per_cluster(planted, "id", settings=FOREST, smallest=10_000)
    assert none.count() == 0 and not fitted


def test_subcluster_model(spark, planted):
    model, summary, pairs = models.build_subcluster_model(
        planted, "id", 0, 6.0, 8.0, settings={"rf": FOREST, "gbt": BOOSTED}, grids=GRID
    )
    row = summary.first()
    assert row.n_compounds == planted.where("p >= 6 and p < 8").count() == row.train_size + row.test_size
    assert row.best_model in ("rf", "xgb") and set(row.best_params) <= {"numTrees", "maxDepth", "maxIter"}
    found = {r.model: r for r in stats.regression_metrics(pairs, "actual", "prediction", ["model"]).collect()}
    assert set(found) == {"rf", "gbt", "optimized"} and found["rf"].rmse == pytest.approx(row.rf_rmse)
    gain = models.improvement(summary).first()
    first = min(row.rf_rmse, row.xgb_rmse)
    assert gain.rmse_gain == pytest.approx(first - row.optimized_rmse)


def test_save_and_load(spark, planted):
    model, _, _ = models.build_model(planted, "id", settings=FOREST)
    path = new_path(spark, "model")
    models.save_model(model, path)
    a = {r.id: r.prediction for r in models.predictions(model, planted).collect()}
    b = {r.id: r.prediction for r in models.predictions(models.load_model(path), planted).collect()}
    assert a == b


@pytest.fixture(scope="module")
def predictor(spark):
    rows = [(f"M{i}", "C" * (4 + i % 9) + ("N" if i % 2 else "O") * (1 + i % 4), 5.0 + i % 4) for i in range(60)]
    table = spark.createDataFrame(rows, "molecule_id string, structure string, p double")
    made = analysis.fingerprints(table, 256)
    model, _, _ = models.build_model(made, "molecule_id", settings=FOREST)
    return Predictor(spark, model, 256), table


def test_predictor(spark, predictor):
    p, table = predictor
    got = p.predict(["CCCCCO", "CC", None, "CCCCNNNN"]).collect()
    assert {r.structure for r in got} == {"CCCCCO", "CCCCNNNN"}
    assert got[0].prediction >= got[1].prediction and all(r["class"] for r in got)
    assert p.predict("CCCCCO").count() == 1 and p.predict(["C"]).count() == 0
    errors = {r.structure: r.error for r in p.rejected(["CC", None]).collect()}
    assert errors == {"CC": "structure too short", None: "no structure"}
    assert p.errors(["CC"]).first().errors == 1
    parts = p.report(table.select("structure"))
    assert parts["strongest"].count() == 15 and parts["classes"].agg(F.sum("n")).first()[0] == 60
    assert "pIC50: " in parts["table"].first().label


@pytest.mark.parametrize("kind", ["csv", "parquet", "txt"])
def test_screen(spark, predictor, kind):
    p, table = predictor
    path = f"{new_path(spark, 'library')}.{kind}"
    rows = table.select(F.col("molecule_id").alias("name"), F.col("structure").alias("Canonical_SMILES"))
    if kind == "txt":
        rows.select(F.concat(F.lit("  "), "Canonical_SMILES", F.lit("\t"))).write.text(path)
    else:
        rows.write.option("header", True).format(kind).save(path)
    got = p.screen(path, new_path(spark, "screen"), 7)
    assert got["all"].count() == 60 and got["top"].count() == 7
    assert got["top"].agg(F.min("prediction")).first()[0] >= sorted((r.prediction for r in got["all"].collect()))[-7]


def test_applicability(spark, predictor):
    p, table = predictor
    known = table.select(F.col("molecule_id").alias("id"), "structure")
    asked = spark.createDataFrame([("a", "CCCCCO"), ("b", "XYZXYZ")], "id string, structure string")
    got = {r.id: r for r in p.applicability(asked, known, 0.5).collect()}
    assert got["a"].in_domain and got["a"].similarity > 0.5 and not got["b"].in_domain


def test_compounds_and_cluster_run(spark):
    raw = [
        (i, f"M{i % 30}", "C" * (4 + i % 30) + ".Cl" * (i % 2), str(10 + i), "IC50", "nM", "T1" if i % 4 else "T2")
        for i in range(200)
    ]
    df = spark.createDataFrame(
        raw, "ord int, molecule_id string, structure string, standard_value string, standard_type string, units string, target string"
    )
    found = analysis.compounds(df, "T1")
    assert found.columns == ["molecule_id", "structure", "p"] and 0 < found.count() <= 30
    assert analysis.compounds(df, "T1", limit=1).count() == 1
    run = analysis.cluster_run(analysis.fingerprints(found, 128), 3, restarts=2)
    assert run["sizes"].agg(F.sum("n")).first()[0] == found.count()
    assert run["representatives"].where("rank > 3").count() == 0


def test_reports(spark, planted):
    wide = planted.select("id", "p", "cluster", "subcluster", *[F.get("x", F.lit(i)).alias(f"f{i}") for i in range(4)])
    assert reports.property_activity_report(wide.drop("f3"), "p", exclude=("id", "cluster", "subcluster"), key=["id"]) is None
    more = wide.withColumn("MW", F.lit(510.0)).withColumn("LogP", F.lit(1.0)).withColumn("HBD", F.lit(1)).withColumn("HBA", F.lit(20))
    parts = reports.property_report(more, exclude=("id", "p", "cluster", "subcluster"))
    assert parts["violations"].where("violations = 2").first().n == 300 and "violations" in parts["table"].columns
    assert reports.summary_properties(more.withColumn("TPSA", F.lit(1.0)).withColumn("RotBonds", F.lit(1))) == ["MW", "LogP", "TPSA", "RotBonds"]
    parts = reports.property_activity_report(more, "p", exclude=("id", "cluster", "subcluster"), key=["id"])
    assert parts["correlations"].first().property == "f0" and parts["lines"].first().line == "f0: r = 1.000"
    assert parts["pairs"].count() == 300 * 6
    parts = reports.cluster_report(planted, "p")
    assert parts["box"].count() == 4 and parts["subcluster_stats"].count() == 0
    assert analysis.first_table(spark, ["/nowhere/a", "/root/testdata/sf0.001/part.parquet"]).count() > 0
    assert analysis.first_table(spark, ["/nowhere/a"]) is None


@pytest.mark.parametrize(
    "name",
    "model_global importances top_weights model_pairs model_per_cluster grid_search model_best model_roundtrip score score_report screen".split(),
)
def test_registered_fits_are_whole(spark, monkeypatch, name):
    """No registered query passes settings or a grid of its own."""
    from workload import QUERIES

    class Seen(Exception):
        pass

    def fitted(*rows, **given):
        raise Seen({k: v for k, v in given.items() if k in ("settings", "grid", "grids")})

    for f in ("build_model", "model_per_cluster", "grid_search", "build_subcluster_model"):
        monkeypatch.setattr(models, f, fitted)
    with pytest.raises(Seen) as seen:
        QUERIES[name](spark, "/root/testdata/sf0.001")
    assert seen.value.args[0] == {}


def test_kinds_fitted_together_are_those_fitted_alone(spark, planted):
    settings = {"rf": FOREST, "gbt": BOOSTED}
    fitted, metrics, pairs = models.build_model(planted, "id", kind=("rf", "gbt"), settings=settings)
    both = metrics.collect()
    assert both == sorted(both, key=lambda r: r.rmse) and {r.model for r in both} == set(fitted) == {"rf", "gbt"}
    for r in both:
        model, alone, own = models.build_model(planted, "id", kind=r.model, settings=settings[r.model])
        assert alone.first().rmse == pytest.approx(r.rmse) and alone.first().n == r.n
        assert sorted(own.collect()) == sorted(pairs.where(F.col("model") == r.model).drop("model").collect())
        assert list(model.weights) == pytest.approx(list(fitted[r.model].weights))
