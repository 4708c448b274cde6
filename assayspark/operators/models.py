"""Regression models: split, fit, tune, compare, explain, save, score.

Fits read a feature vector column and grow trees level by level (`trees`); the split and the folds are hashes of the row
key. Trees don't depend on the scale of a column, so vectors need no scaling.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product

from pyspark.sql import DataFrame, SparkSession, functions as F

from assayspark.functions.activity import in_half_open_range
from assayspark.functions.structure import text_hash
from assayspark.operators import groups, stats, trees
from assayspark.operators.trees import Boosted, Fit, Forest, TreeModel
from assayspark.session import settle

SEED = 42

# Settings of the two kinds of model, for the global fit and for the fits on a part.
FOREST = {"numTrees": 100, "maxDepth": None, "minInstancesPerNode": 1, "minSamplesSplit": 2}
BOOSTED_GLOBAL = {"maxIter": 200, "stepSize": 0.1, "maxDepth": 6, "subsamplingRate": 0.8, "columnRate": 0.8}
BOOSTED_PART = {"maxIter": 100, "stepSize": 0.3, "maxDepth": 6, "subsamplingRate": 1.0, "columnRate": 1.0}

# The search grids, 81 and 243 points (a depth of None has no limit).
FULL_GRID = {
    "rf": {"numTrees": [100, 200, 300], "maxDepth": [None, 10, 20], "minSamplesSplit": [2, 5, 10], "minInstancesPerNode": [1, 2, 4]},
    "gbt": {
        "maxIter": [100, 200, 300], "maxDepth": [3, 5, 7], "stepSize": [0.01, 0.05, 0.1],
        "subsamplingRate": [0.8, 0.9, 1.0], "columnRate": [0.8, 0.9, 1.0],
    },
}

_NAMES = {
    "rf": {"numTrees": "trees", "maxDepth": "depth", "minInstancesPerNode": "min_leaf", "minSamplesSplit": "min_split"},
    "gbt": {"maxIter": "trees", "maxDepth": "depth", "stepSize": "rate", "subsamplingRate": "rows", "columnRate": "columns"},
}


def plan(kind: str, settings: dict) -> Forest | Boosted:
    """The plan of a fit from settings by their usual names."""
    if kind not in _NAMES:
        raise ValueError(f"unknown kind of model: {kind}")
    given = {k: v for k, v in settings.items() if not (k == "featureSubsetStrategy" and v == "all")}
    if unknown := set(given) - set(_NAMES[kind]):
        raise ValueError(f"unknown settings of {kind}: {sorted(unknown)}")
    return (Forest if kind == "rf" else Boosted)(**{_NAMES[kind][k]: v for k, v in given.items()})


def with_split(df: DataFrame, key: str, folds: int = 5) -> DataFrame:
    """Add `is_test` (one row in five) and `fold`, both from a hash of the key.

    The same row gets the same place under any partitioning, on any run and on any engine.
    """
    h = text_hash(F.col(key).cast("string"))
    return df.withColumn("is_test", h % 5 == 0).withColumn("fold", (F.floor(h / 5) % folds).cast("int"))


def prepared(df: DataFrame, key: str, target: str, features: str, part: str | None = None, folds: int = 5) -> tuple[DataFrame, list]:
    """Settled rows for fits (key, actual, row, part, y, seed, is_test, fold, bins), and the cuts between bins.

    Rows of equal bins lie together. The key is kept for test rows, the only ones whose predictions are given by key.
    """
    y = F.col(target).cast("double")
    rows = df.select(F.col(key).alias("key"), y.alias("actual"), (F.col(part).cast("int") if part else F.lit(0)).alias("part"), F.col(features).alias("features"))
    if "is_test" in df.columns and "fold" in df.columns:
        rows = df.select(F.col(key).alias("key"), y.alias("actual"), (F.col(part).cast("int") if part else F.lit(0)).alias("part"), F.col(features).alias("features"), "is_test", "fold")
    else:
        rows = with_split(rows, "key", folds)
    rows = rows.where("actual is not null and not isnan(actual) and features is not null and part is not null")
    cuts = trees.cuts_of(rows, "key", "features")
    rows = rows.withColumns(
        {
            "y": F.round(F.col("actual") / trees.UNIT).cast("long"),
            "seed": F.xxhash64(F.col("key").cast("string")),
            "row": F.monotonically_increasing_id(),
        }
    ).withColumn("key", F.when(F.col("is_test"), F.col("key")))
    return trees.binned(rows, cuts, "features", ["key", "actual", "row", "part", "y", "seed", "is_test", "fold"], ["part", "bins"]), cuts


def predictions(model: TreeModel, df: DataFrame) -> DataFrame:
    return model.transform(df)


def _pairs(rows: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Predictions of rows held out, next to what was measured."""
    return rows.select(F.col("key").alias(key), "part", "actual", "row").join(found, "row").drop("row")


def build_model(
    df: DataFrame,
    key: str,
    target: str = "p",
    features: str = "features",
    kind: str | Sequence[str] = "rf",
    settings: dict | None = None,
    seed: int = SEED,
    keep: bool = True,
) -> tuple[TreeModel | dict[str, TreeModel] | None, DataFrame, DataFrame]:
    """One model of the whole table: (model, metrics on the held-out rows, actual and predicted).

    Held-out rows are predicted while the trees grow; without `keep` the trees are not written, and the model is None.
    Several kinds are fitted together, over the same binned rows: then models and `settings` go by kind, metrics come
    best first, and pairs have a column `model`.
    """
    kinds = [kind] if isinstance(kind, str) else list(kind)
    given = {kind: settings} if isinstance(kind, str) else settings or {}
    fits = [Fit(plan(k, given.get(k) or (FOREST if k == "rf" else BOOSTED_GLOBAL)), seed=seed) for k in kinds]
    rows, cuts = prepared(df.select(key, target, features), key, target, features)
    results, bases, tops = trees.run(rows, fits, cuts, keep)
    pairs = _pairs(rows, trees.held_out(results, fits, bases), key)
    models = {k: trees.model_of(results, i, f, cuts, features, bases, tops) for i, (k, f) in enumerate(zip(kinds, fits))} if keep else None
    if isinstance(kind, str):
        pairs = pairs.select(key, "actual", "prediction")
        metrics = stats.regression_metrics(pairs, "actual", "prediction").select(F.lit(kind).alias("model"), "*")
        return models and models[kind], metrics, pairs
    pairs = pairs.select(F.element_at(F.array(*[F.lit(k) for k in kinds]), F.col("fit") + 1).alias("model"), key, "actual", "prediction")
    return models, stats.regression_metrics(pairs, "actual", "prediction", ["model"]).orderBy("rmse", "model"), pairs


def compare_models(reports: Sequence[DataFrame]) -> DataFrame:
    """Metric rows of several models, best first."""
    out = reports[0]
    for report in reports[1:]:
        out = out.unionByName(report)
    return out.orderBy("rmse", "model")


def feature_weights(model: TreeModel, names: Sequence[str] | None = None) -> DataFrame:
    """(feature, weight) of a fitted model."""
    named = names or [f"bit_{i}" for i in range(len(model.weights))]
    rows = [(n, float(w)) for n, w in zip(named, model.weights)]
    return SparkSession.active().createDataFrame(rows, "feature string, weight double")


def top_weights(weights: DataFrame, n: int = 15) -> DataFrame:
    """The n largest weights, smallest of them first."""
    return groups.top_n(weights, "weight", n, ["feature"]).orderBy("weight", F.col("feature").desc())


def model_per_cluster(
    df: DataFrame,
    key: str,
    cluster: str = "cluster",
    target: str = "p",
    features: str = "features",
    kind: str = "rf",
    settings: dict | None = None,
    smallest: int = 20,
    seed: int = SEED,
    keep: bool = True,
) -> tuple[DataFrame, dict[int, TreeModel]]:
    """One model per cluster of at least `smallest` rows: ((cluster, n_compounds, r2, rmse), models).

    All clusters grow together, in the same aggregates and tasks. Without `keep` there are metrics but no models.
    """
    chosen = plan(kind, settings or (FOREST if kind == "rf" else BOOSTED_PART))
    rows, cuts = prepared(df.select(key, cluster, target, features), key, target, features, cluster)
    sizes = stats.eligible_groups(df, cluster, smallest).orderBy(cluster).collect()  # one row per cluster
    fits = [Fit(chosen, int(s[cluster]), seed=seed) for s in sizes]
    known = df.sparkSession.createDataFrame([(int(s[cluster]), s.n) for s in sizes], "cluster int, n_compounds bigint")
    if not fits:
        return known.selectExpr("*", "double(null) as r2", "double(null) as rmse"), {}
    results, bases, tops = trees.run(rows, fits, cuts, keep)
    pairs = _pairs(rows, trees.held_out(results, fits, bases), key).withColumnRenamed("part", "cluster")
    metrics = stats.regression_metrics(pairs, "actual", "prediction", ["cluster"]).select("cluster", "r2", "rmse")
    models = {f.part: trees.model_of(results, i, f, cuts, features, bases, tops) for i, f in enumerate(fits)} if keep else {}
    return known.join(metrics, "cluster", "left"), models


def nested_fits(kind: str, grid: dict[str, list], folds: int, seed: int = SEED, base: dict | None = None) -> tuple[list[Fit], list[tuple[dict, int]]]:
    """The fits that a grid needs, and for each point of the grid its settings and which fit and variant answer it.

    The first trees of a large fit are those of a small one, a deep tree cut at a depth is the tree of that depth, and one
    cut at small nodes is the tree that doesn't split them, so only the largest of each is fitted; what changes the trees
    themselves (leaf sizes, rates, shares, a boosted depth) is fitted anew.
    """
    cut = ("numTrees", "maxDepth", "minSamplesSplit") if kind == "rf" else ("maxIter",)
    fixed = {k: v for k, v in (base or {}).items() if k not in grid}
    own = [k for k in grid if k not in cut]
    largest = {k: None if None in grid[k] else (min if k == "minSamplesSplit" else max)(grid[k]) for k in grid if k in cut}
    fits, points = [], []
    for values in product(*(grid[k] for k in own)):
        settings = fixed | dict(zip(own, values))
        some = [settings | dict(zip([k for k in grid if k in cut], v)) for v in product(*(grid[k] for k in grid if k in cut))]
        plans = [plan(kind, s) for s in some]
        variants = tuple((p.trees, p.depth, p.min_split) if kind == "rf" else (p.trees, None, 2) for p in plans)
        for j, s in enumerate(some):
            points.append(({k: s[k] for k in grid}, len(fits) * len(variants) + j))
        fits.append((plan(kind, settings | largest), variants))
    order = {tuple(v): i for i, v in enumerate(product(*grid.values()))}
    points.sort(key=lambda p: order[tuple(p[0][k] for k in grid)])
    return [Fit(p, 0, fold, variants, seed) for p, variants in fits for fold in range(folds)], points


def _search(rows: DataFrame, cuts: list, kind: str, grid: dict, folds: int, seed: int) -> list[tuple[dict, float]]:
    """(settings, mean over the folds of the mean squared error) of every point of the grid, in the grid's order."""
    base = FOREST if kind == "rf" else BOOSTED_PART
    fits, points = nested_fits(kind, grid, folds, seed, base)
    results, bases, _ = trees.run(rows, fits, cuts)
    found = trees.held_out(results, fits, bases).join(rows.select("row", "actual"), "row")
    each = found.groupBy("fit", "variant").agg(F.avg((F.col("actual") - F.col("prediction")) ** 2).alias("mse"))
    each = each.groupBy(F.floor(F.col("fit") / folds).cast("int").alias("fit"), "variant").agg(F.avg("mse").alias("mse")).collect()  # a row a point
    mse = {(r.fit, r.variant): r.mse for r in each}
    width = len(fits[0].asked())
    return [(settings, mse.get((at // width, at % width), float("nan"))) for settings, at in points]


def grid_search(
    train: DataFrame,
    kind: str,
    target: str = "p",
    features: str = "features",
    grid: dict[str, list] | None = None,
    folds: int = 5,
    seed: int = SEED,
    key: str = "id",
) -> tuple[TreeModel, dict[str, str], DataFrame]:
    """Cross-validated search by mean squared error over `fold`: (best model, its settings, all scores).

    `train` has a `fold` column, see `with_split`. Of equal points the first is best.
    """
    rows, cuts = prepared(train.withColumn("is_test", F.lit(False)), key, target, features)
    best, scores = _searched(rows, cuts, kind, grid, folds, seed)
    fits = [Fit(plan(kind, (FOREST if kind == "rf" else BOOSTED_PART) | best), seed=seed)]
    results, bases, tops = trees.run(rows, fits, cuts, True)
    model = trees.model_of(results, 0, fits[0], cuts, features, bases, tops)
    return model, {k: str(v) for k, v in best.items()}, scores


def _searched(rows: DataFrame, cuts: list, kind: str, grid: dict | None, folds: int, seed: int) -> tuple[dict, DataFrame]:
    found = _search(rows.where("not is_test"), cuts, kind, grid or FULL_GRID[kind], folds, seed)
    best = min(range(len(found)), key=lambda i: (found[i][1] != found[i][1], found[i][1]))
    scores = rows.sparkSession.createDataFrame([({k: str(v) for k, v in c.items()}, float(m)) for c, m in found], "params map<string,string>, mse double")
    return found[best][0], scores


SUMMARY_SCHEMA = """subcluster_id int, min_pic50 double, max_pic50 double, n_compounds bigint, train_size bigint,
  test_size bigint, rf_r2 double, rf_rmse double, xgb_r2 double, xgb_rmse double, best_model string,
  optimized_r2 double, optimized_rmse double, best_params map<string,string>"""


def build_subcluster_model(
    df: DataFrame,
    key: str,
    subcluster_id: int = 0,
    low: float = 5.0,
    high: float = 10.0,
    subcluster: str = "subcluster",
    target: str = "p",
    features: str = "features",
    settings: dict[str, dict] | None = None,
    grids: dict[str, dict[str, list]] | None = None,
    folds: int = 5,
    seed: int = SEED,
) -> tuple[TreeModel, DataFrame, DataFrame]:
    """Both kinds of model on one subcluster and range, then a search on the better one.

    Gives (tuned model, one summary row, predictions of all three on the held-out rows). Columns
    named xgb hold the boosted trees.
    """
    settings = settings or {"rf": FOREST, "gbt": BOOSTED_PART}
    chosen = df.where((F.col(subcluster) == subcluster_id) & in_half_open_range(F.col(target), low, high))
    rows, cuts = prepared(chosen.select(key, target, features), key, target, features, folds=folds)

    def fitted(names: dict[str, Forest | Boosted], keep: bool) -> tuple[TreeModel | None, DataFrame]:
        fits = [Fit(p, seed=seed) for p in names.values()]
        results, bases, tops = trees.run(rows, fits, cuts, keep)
        names_of = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("fit") + 1).alias("model")
        pairs = _pairs(rows, trees.held_out(results, fits, bases), key).select(names_of, key, "actual", "prediction")
        return (trees.model_of(results, 0, fits[0], cuts, features, bases, tops) if keep else None), pairs

    _, pairs = fitted({kind: plan(kind, settings[kind]) for kind in ("rf", "gbt")}, False)
    metrics = {r.model: r for r in stats.regression_metrics(pairs, "actual", "prediction", ["model"]).collect()}
    best = min(metrics, key=lambda m: (metrics[m].rmse, m))
    params, _ = _searched(rows, cuts, best, (grids or {}).get(best), folds, seed)
    tuned, tuned_pairs = fitted({"optimized": plan(best, (FOREST if best == "rf" else BOOSTED_PART) | params)}, True)
    final = stats.regression_metrics(tuned_pairs, "actual", "prediction").first()
    sizes = {r.is_test: r["count"] for r in rows.groupBy("is_test").count().collect()}
    row = (
        subcluster_id, low, high, sum(sizes.values()), sizes.get(False, 0), sizes.get(True, 0),
        metrics["rf"].r2, metrics["rf"].rmse, metrics["gbt"].r2, metrics["gbt"].rmse,
        "rf" if best == "rf" else "xgb", final.r2, final.rmse, {k: str(v) for k, v in params.items()},
    )
    summary = df.sparkSession.createDataFrame([row], SUMMARY_SCHEMA)
    return tuned, summary, pairs.unionByName(tuned_pairs)


def improvement(summary: DataFrame) -> DataFrame:
    """How much the tuned model gains on the better first fit."""
    better = F.col("best_model") == "rf"
    return summary.select(
        "subcluster_id",
        (F.when(better, F.col("rf_rmse")).otherwise(F.col("xgb_rmse")) - F.col("optimized_rmse")).alias("rmse_gain"),
        (F.col("optimized_r2") - F.when(better, F.col("rf_r2")).otherwise(F.col("xgb_r2"))).alias("r2_gain"),
    )


def save_model(model: TreeModel, path: str) -> None:
    model.save(path)


def load_model(path: str) -> TreeModel:
    return TreeModel.load(SparkSession.active(), path)
