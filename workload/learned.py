"""Queries that fit and apply models. Fits are rows-only; tests hold their trees against brute force."""

from __future__ import annotations

from pyspark.sql import functions as F

from assayspark.operators import cluster, features, groups, models, stats
from assayspark.plans import analysis
from assayspark.plans.scoring import Predictor
from assayspark.session import new_path, settle
from workload.measures import cleaned
from workload.registry import activity_raw, bits, props, query, structures, table
from workload.vectors import vectors


def property_rows(spark, sf):
    """The property table as vectors, keyed by a hash of the whole row."""
    rows = props(spark, sf)
    key = F.md5(F.to_json(F.struct(*table(spark, sf, "lineitem").columns)).cast("binary")).alias("id")
    x = F.array("molwt", "mollogp", "hbd", "hba", "tpsa")
    return rows.select(key, "pic50", "cluster", "subcluster", features.dense_vector(x).alias("features"))


def fingerprinted(spark, sf):
    """Compounds of all targets with hashed bits as vectors."""
    from assayspark.operators import clean

    rows = clean.remove_duplicates(cleaned(spark, sf)).select("molecule_id", "structure", "p")
    return analysis.fingerprints(rows, 2048)


@query("model_global")
def model_global(spark, sf):
    return models.build_model(property_rows(spark, sf), "id", "pic50", kind=("rf", "gbt"), keep=False)[1]


@query("importances")
def importances(spark, sf):
    model, _, _ = models.build_model(property_rows(spark, sf), "id", "pic50")
    return models.feature_weights(model, ["molwt", "mollogp", "hbd", "hba", "tpsa"])


@query("top_weights")
def top_weights(spark, sf):
    model, _, _ = models.build_model(vectors(spark, sf), "id", "pic50")
    return models.top_weights(models.feature_weights(model), 15)


@query("model_pairs")
def model_pairs(spark, sf):
    return models.build_model(vectors(spark, sf), "id", "pic50", keep=False)[2]


@query("model_per_cluster")
def model_per_cluster(spark, sf):
    return models.model_per_cluster(property_rows(spark, sf), "id", target="pic50", keep=False)[0]


@query("grid_search")
def grid_search(spark, sf):
    train = models.with_split(vectors(spark, sf).select("id", "pic50", "features"), "id").where("not is_test")
    return models.grid_search(train, "rf", "pic50")[2]


@query("model_best")
def model_best(spark, sf):
    return models.build_subcluster_model(property_rows(spark, sf), "id", 0, target="pic50")[1]


@query("model_roundtrip")
def model_roundtrip(spark, sf):
    """Predictions of the saved model, read back, next to those of the one in memory."""
    rows = vectors(spark, sf)
    model, _, _ = models.build_model(rows, "id", "pic50")
    path = new_path(spark, "model")
    models.save_model(model, path)
    again = models.predictions(models.load_model(path), rows).select("id", F.col("prediction").alias("again"))
    return models.predictions(model, rows).select("id", "prediction").join(again, "id")


def _predictor(spark, sf):
    model, _, _ = models.build_model(fingerprinted(spark, sf), "molecule_id", "p")
    return Predictor(spark, model, 2048)


@query("score")
def score(spark, sf):
    return _predictor(spark, sf).predict(structures(spark, sf))


@query("score_report")
def score_report(spark, sf):
    return _predictor(spark, sf).report(structures(spark, sf))["classes"]


@query("screen")
def screen(spark, sf):
    library = new_path(spark, "library")
    structures(spark, sf).select(F.col("structure").alias("canonical_SMILES")).write.parquet(library + ".parquet")
    return _predictor(spark, sf).screen(library + ".parquet", new_path(spark, "screen"), 50)["top"]


@query("applicability")
def applicability(spark, sf):
    known = fingerprinted(spark, sf).select(F.col("molecule_id").alias("id"), "structure")
    asked = structures(spark, sf).select(F.col("id").cast("string").alias("id"), "structure")
    return Predictor(spark, None, 2048).applicability(asked, known, 0.5)


@query("cluster_run")
def cluster_run(spark, sf):
    return analysis.cluster_run(fingerprinted(spark, sf), 5)["representatives"].select(
        "molecule_id", "structure", "p", "cluster", "rank"
    )


@query("report_space")
def report_space(spark, sf):
    rows = vectors(spark, sf).withColumn("subcluster", F.col("id").cast("int") % 3)
    return analysis.space_report(rows, "features", "id", "pic50")["largest"]


@query("report_all")
def report_all(spark, sf):
    """The rows of every part of a whole run over the clustered vectors."""
    rows = vectors(spark, sf).withColumn("subcluster", F.col("id").cast("int") % 3)
    described = rows.select("id", "pic50", "cluster", *[F.get("x", F.lit(i)).alias(f"f{i}") for i in range(6)])
    found = analysis.analyse(
        rows, "pic50", ["id"], described, rows, exclude=("id", "pic50", "cluster", "subcluster")
    )
    out = None
    for report, parts in found.items():
        for part, made in parts.items():
            row = made.agg(F.count("*").alias("rows")).select(F.lit(report).alias("report"), F.lit(part).alias("part"), "rows")
            out = row if out is None else out.unionByName(row)
    return out
