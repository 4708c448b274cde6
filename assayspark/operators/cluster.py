"""Standardise, cluster, choose k, and project."""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, cloudpickle
from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, ElementwiseProduct
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, GroupedData, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from assayspark.functions import activity as act
from assayspark.functions.literals import numbers
from assayspark.operators import groups

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # tasks need numpy and Arrow but not this package

SEED = 42
RESTARTS = 10
BLOCK_BYTES = 1 << 25
TILE = 1 << 18  # distances held at once


def _summary(df: DataFrame, features: str) -> tuple[int, np.ndarray, np.ndarray]:
    """Rows, column means and population deviations of a vector column, in one pass."""
    made = Summarizer.metrics("count", "mean", "variance").summary(F.col(features))
    s = df.where(F.col(features).isNotNull()).select(made.alias("s")).first().s
    n = int(s["count"])
    return n, s["mean"].toArray(), np.sqrt(s["variance"].toArray() * (max(n - 1, 0) / max(n, 1)))


def column_moments(df: DataFrame, features: str) -> DataFrame:
    """(pos, mean, std): column means and population deviations of a vector column."""
    s = df.select(Summarizer.metrics("count", "mean", "variance").summary(F.col(features)).alias("s"))
    n = F.col("s.count")
    return s.select(
        F.posexplode(F.arrays_zip(vector_to_array("s.mean").alias("m"), vector_to_array("s.variance").alias("v"))), n.alias("n")
    ).select("pos", F.col("col.m").alias("mean"), F.sqrt(F.col("col.v") * (F.col("n") - 1) / F.col("n")).alias("std"))


def scaler(df: DataFrame, features: str, output: str) -> ElementwiseProduct:
    """A stage that divides every column by its population deviation; constant columns become 0.

    Without centring, sparse vectors stay sparse, and distances and variances are the same.
    """
    _, _, std = _summary(df, features)
    factor = np.divide(1.0, std, out=np.zeros_like(std), where=std > 0)
    return ElementwiseProduct(scalingVec=Vectors.dense(factor), inputCol=features, outputCol=output)


def zscore(df: DataFrame, features: str, output: str) -> DataFrame:
    """Add an array of z-scores by population deviation; constant columns become 0."""
    _, mean, std = _summary(df, features)
    m, s = numbers(mean.tolist()), numbers(std.tolist())
    z = F.transform(
        vector_to_array(features),
        lambda v, i: F.when(F.get(s, i) > 0, (v - F.get(m, i)) / F.get(s, i)).otherwise(F.lit(0.0)),
    )
    return df.withColumn(output, z)


def kmeans(
    df: DataFrame,
    features: str,
    k: int,
    output: str = "cluster",
    seed: int = SEED,
    restarts: int = RESTARTS,
    standardise: bool = True,
    max_iter: int = 300,
    tolerance: float = 1e-4,
    parallelism: int = 4,
    kept: bool = False,
) -> tuple[DataFrame, PipelineModel, float]:
    """The best of several k-means runs: (labelled table, model, inertia).

    Vectors are kept on the executors unless the caller has done so (`kept`), and some runs go side
    by side. The solver by rows takes any start, also one with fewer than k distinct centres. A run ends when the squared
    moves of all centres add up to `tolerance` at most, on vectors of unit variance. The model
    scales and labels new rows too.
    """
    stages = [scaler(df, features, "_scaled")] if standardise else []
    column = "_scaled" if standardise else features
    base = PipelineModel(stages)
    vectors = base.transform(df).select(column)
    if not kept:
        vectors = vectors.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        move = math.sqrt(tolerance / k)

        def fit(s: int) -> KMeansModel:
            return KMeans(
                k=k, seed=s, initMode="k-means||", maxIter=max_iter, tol=move, featuresCol=column, predictionCol=output,
                solver="row",
            ).fit(vectors)

        with ThreadPoolExecutor(parallelism) as pool:
            fits = list(pool.map(fit, range(seed, seed + restarts)))
        best = min(fits, key=lambda m: m.summary.trainingCost)
        cost = float(best.summary.trainingCost)
    finally:
        if not kept:
            vectors.unpersist()
    model = PipelineModel([*stages, best])
    return attach_label(df, model), model, cost


def attach_label(df: DataFrame, model: PipelineModel) -> DataFrame:
    return model.transform(df).drop("_scaled")


def group_centres(df: DataFrame, features: str, label: str) -> DataFrame:
    """(label, centre): the mean vector of every group."""
    return df.groupBy(label).agg(Summarizer.mean(F.col(features)).alias("centre"))


def assign_centres(df: DataFrame, features: str, centres: DataFrame, label: str, largest: int = 1_000_000) -> DataFrame:
    """Add `nearest` (ties to the smaller label) and `distance` for a small table of centres.

    The centres travel as one literal, after a check that labels times width stay within `largest`.
    """
    first = centres.first()
    width = first["centre"].size if first else 0
    known = centres.orderBy(label).limit(largest // max(width, 1) + 1).collect()
    if len(known) * width > largest:
        raise ValueError(f"more than {largest // width} centres of {width} values are too many to send to every task")
    ids = [row[label] for row in known]
    x = vector_to_array(features)

    def distance(centre: list[float]) -> Column:
        gaps = F.zip_with(F.col("_x"), numbers(centre), lambda a, b: (a - b) * (a - b))
        return F.aggregate(gaps, F.lit(0.0), lambda acc, v: acc + v)

    away = F.array(*[distance(row["centre"].toArray().tolist()) for row in known])
    nearest = F.array_position(F.col("_d"), F.array_min("_d")) - 1
    return (
        df.withColumn("_x", x)
        .withColumn("_d", away)
        .withColumn("nearest", F.get(F.lit(ids), nearest.cast("int")))
        .withColumn("distance", F.sqrt(F.array_min("_d")))
        .drop("_x", "_d")
    )


def inertia(df: DataFrame, features: str, label: str) -> DataFrame:
    """Sum of squared distances to the group means for given labels, from one pass of group variances."""
    s = df.groupBy(label).agg(Summarizer.metrics("count", "variance").summary(F.col(features)).alias("s"))
    spread = F.aggregate(vector_to_array("s.variance"), F.lit(0.0), lambda acc, v: acc + v)
    return s.agg(F.sum((F.col("s.count") - 1) * spread).alias("inertia"))


def silhouette_squared(df: DataFrame, features: str, label: str) -> float | None:
    """Mean silhouette under squared Euclidean distance; linear in the rows. None below two labels."""
    if len(df.select(label).distinct().limit(2).collect()) < 2:
        return None
    rows = df.withColumn("_label", F.col(label).cast("double"))
    return ClusteringEvaluator(featuresCol=features, predictionCol="_label").evaluate(rows)


def _block_count(rows: int, width: int, tasks: int, labels: int = 1) -> int:
    """Blocks of at most `BLOCK_BYTES`, as are their sums by label, and at least so many that all tasks have pairs of them."""
    return max(1, -(-rows * max(8 * width, 16 * labels) // BLOCK_BYTES), min(-(-rows // 500), math.isqrt(4 * tasks)))


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Euclidean distances; close pairs, where the product loses digits, are taken from differences."""
    size = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)
    square = x @ y.T
    square *= -2.0
    square += size
    size *= 1e-5
    near, at = np.nonzero(square <= size)
    for i in range(0, len(near), 1 << 16):
        n, t = near[i : i + (1 << 16)], at[i : i + (1 << 16)]
        square[n, t] = ((x[n] - y[t]) ** 2).sum(axis=1)
    return np.sqrt(square, out=square)


def silhouette_exact(df: DataFrame, key: str, features: str, label: str, block_rows: int | None = None) -> DataFrame:
    """(key, label, silhouette) under Euclidean distance.

    The measure needs every distance, so its work is quadratic: it is meant for the rows of one
    cluster. Rows are cut into blocks (of 32 MB unless their rows are given); a task holds two blocks, each pair of which
    meets once and serves both, and gives one sum per row and label, never a pair. So a row is sent once a block.
    """
    rows = df.select(F.col(key).alias("id"), F.col(label).alias("label"), vector_to_array(features).alias("x"))
    counted, spark = rows.agg(F.count("*").alias("n"), F.max(F.size("x")).alias("width"), F.approx_count_distinct("label").alias("labels")).first(), df.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    blocks = max(1, -(-counted.n // block_rows)) if block_rows else _block_count(counted.n, counted.width or 1, tasks, counted.labels)
    cut = rows.withColumn("own", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))

    def dealt(name: str, other: str, places: Column) -> GroupedData:
        made = cut.withColumnRenamed("own", name).withColumn(other, F.explode(places))
        return made.repartition(max(tasks, min(4 * tasks, blocks * (blocks + 1) // 2)), "first", "second").groupBy("first", "second")

    left = dealt("first", "second", F.sequence("first", F.lit(blocks - 1)))
    right = dealt("second", "first", F.sequence(F.lit(0), F.col("second")))

    def sums(keys: tuple, a: pa.Table, b: pa.Table) -> pa.Table:
        if not len(a) or not len(b):
            return pa.Table.from_batches([], out)
        sides, same = [], keys[0].as_py() == keys[1].as_py()
        for table in (a, b):
            coded = table.column("label").combine_chunks().dictionary_encode(null_encoding="encode")
            codes = coded.indices.to_numpy()
            by_label = np.argsort(codes, kind="stable")
            x = table.column("x").combine_chunks()
            x = x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)[by_label]
            n = np.bincount(codes, minlength=len(coded.dictionary))
            sides.append((table.take(pa.array(by_label)), x, coded.dictionary, n, np.cumsum(n) - n))
        middle = sides[1][1].mean(axis=0)  # distances stay as they are, products keep more digits
        x, y = sides[0][1] - middle, sides[1][1] - middle
        starts = [s[4] for s in sides]
        totals = [np.zeros((len(x), len(starts[1]))), np.zeros((len(y), len(starts[0])))]
        label_of = np.repeat(np.arange(len(starts[0])), sides[0][3])
        step = max(1, TILE // len(y))
        for i in range(0, len(x), step):
            d = _distances(x[i : i + step], y)
            totals[0][i : i + step] = np.add.reduceat(d, starts[1], axis=1)
            if not same:
                here, begin = np.unique(label_of[i : i + step], return_index=True)
                totals[1][:, here] += np.add.reduceat(d, begin, axis=0).T
        made = []
        for (table, rows_, _, _, _), (_, _, names, n, _), total in ((sides[0], sides[1], totals[0]), (sides[1], sides[0], totals[1]))[: 1 if same else 2]:
            each, across = np.repeat(np.arange(len(rows_)), len(names)), np.tile(np.arange(len(names)), len(rows_))
            made.append(
                pa.table(
                    [table.column("id").take(pa.array(each)), table.column("label").take(pa.array(each)), names.take(pa.array(across)), pa.array(total.ravel()), pa.array(n[across].astype(np.int64))],
                    out.names,
                ).cast(out)
            )
        return pa.concat_tables(made)

    id_type, label_type = (dict(rows.dtypes)[c] for c in ("id", "label"))
    schema = f"id {id_type}, label {label_type}, other {label_type}, total double, n bigint"
    out = to_arrow_schema(_parse_datatype_string(schema))
    per_label = (
        left.cogroup(right)
        .applyInArrow(sums, schema)
        .groupBy("id", "label", "other")
        .agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    )
    own = F.col("label") == F.col("other")
    a, b = F.col("a"), F.col("b")
    return (
        per_label.groupBy("id", "label")
        .agg(
            F.max(F.when(own, F.try_divide("total", F.col("n") - 1))).alias("a"),
            F.min(F.when(~own, F.col("total") / F.col("n"))).alias("b"),
        )
        .select(
            F.col("id").alias(key),
            F.col("label").alias(label),
            # A row alone in its group scores 0.
            F.coalesce(F.try_divide(b - a, F.greatest(a, b)), F.lit(0.0)).alias("silhouette"),
        )
    )


def k_curve(
    df: DataFrame,
    features: str,
    largest: int,
    seed: int = SEED,
    restarts: int = RESTARTS,
    key: str | None = None,
    measure: str = "squared euclidean",
) -> DataFrame:
    """(k, inertia, silhouette) for k = 1..largest on standardised vectors; each k is fitted once.

    The silhouette is squared Euclidean, which is linear in the rows, unless `measure` asks for
    "euclidean", which needs a key and is quadratic: it is meant for the rows of one cluster.
    """
    if measure not in ("squared euclidean", "euclidean") or (measure == "euclidean" and key is None):
        raise ValueError("measure is 'squared euclidean', or 'euclidean' with a key")
    stage = scaler(df, features, "_vector")
    columns = [key] if key else []
    vectors = stage.transform(df).select(*columns, "_vector").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n = vectors.count()
        # One group: rows times the number of columns that vary.
        curve = [(1, float(n * np.count_nonzero(stage.getScalingVec().toArray())), None, measure)]
        for k in range(2, min(largest, n - 1) + 1):
            labelled, _, cost = kmeans(vectors, "_vector", k, "_k", seed, restarts, standardise=False, kept=True)
            if measure == "euclidean":
                score = silhouette_exact(labelled, key, "_vector", "_k").agg(F.avg("silhouette")).first()[0]
            else:
                score = silhouette_squared(labelled, "_vector", "_k")
            curve.append((k, cost, score, measure))
    finally:
        vectors.unpersist()
    return df.sparkSession.createDataFrame(curve, "k int, inertia double, silhouette double, measure string")


def k_report(df: DataFrame, features: str, max_clusters: int = 10, **options) -> tuple[DataFrame, DataFrame]:
    """(curve, choice): the choice has the elbow, the best silhouette, the size rule and `recommended`.

    The size rule is what is recommended.
    """
    n = df.count()
    largest = max(1, min(max_clusters, n - 1))
    curve = k_curve(df, features, largest, **options)
    bend, best = groups.elbow(curve).first()[0], groups.best_k(curve).first()[0]
    found = df.sparkSession.createDataFrame([(n, bend, best)], "n bigint, elbow int, best_k int")
    rule = act.subgroup_count_rule(F.col("n"))
    return curve, found.withColumns({"rule": rule, "recommended": rule})


def subcluster(
    df: DataFrame,
    features: str,
    target: int,
    k: int | None = None,
    cluster: str = "cluster",
    output: str = "subcluster",
    **options,
) -> tuple[DataFrame, PipelineModel | None, float]:
    """Cluster again inside one cluster, scaled on its own rows; k by the size rule when not given.

    An empty cluster gives an empty table and no model; k never exceeds the number of rows.
    """
    rows = df.where(F.col(cluster) == target)
    n = rows.count()
    if n == 0:
        return rows.withColumn(output, F.lit(None).cast("int")), None, 0.0
    if k is None:
        k = df.sparkSession.range(1).select(act.subgroup_count_rule(F.lit(n))).first()[0]
    k = min(k, n)
    if k < 2:
        return rows.withColumn(output, F.lit(0)), None, 0.0
    return kmeans(rows, features, k, output, **options)


def project(
    df: DataFrame, features: str, k: int, prefix: str = "pc", keep: Sequence[str] = (), standardise: bool = True
) -> tuple[DataFrame, list[float]]:
    """(kept columns and k centred principal components, explained variance shares).

    The signs are fixed by making each component's largest loading positive; k is capped at the
    numbers of rows and columns. Vectors are not centred, so sparse ones stay sparse: the projection
    of the mean is subtracted instead.
    """
    n, mean, std = _summary(df, features)
    k = min(k, n, len(mean))
    column, rows = features, df
    if standardise:
        factor = np.divide(1.0, std, out=np.zeros_like(std), where=std > 0)
        rows = ElementwiseProduct(scalingVec=Vectors.dense(factor), inputCol=features, outputCol="_scaled").transform(df)
        column, mean = "_scaled", mean * factor
    model = PCA(k=k, inputCol=column, outputCol="_pc").fit(rows)
    loadings = model.pc.toArray()
    signs = np.sign(loadings[np.abs(loadings).argmax(axis=0), range(k)])
    shift = loadings.T @ mean
    made = model.transform(rows).withColumn("_pc", vector_to_array("_pc"))
    parts = [
        ((F.get("_pc", F.lit(i)) - F.lit(float(shift[i]))) * F.lit(float(signs[i]))).alias(f"{prefix}{i + 1}")
        for i in range(k)
    ]
    return made.select(*keep, *parts), [float(v) for v in model.explainedVariance.toArray()]


def map_2d(df: DataFrame, features: str, keep: Sequence[str]) -> DataFrame:
    """(kept columns, x, y): the first two principal components."""
    table, _ = project(df, features, 2, keep=keep)
    table = table.withColumnRenamed("pc1", "x")
    return table.withColumnRenamed("pc2", "y") if "pc2" in table.columns else table.withColumn("y", F.lit(0.0))


def map_largest_cluster(df: DataFrame, features: str, keep: Sequence[str], cluster: str = "cluster") -> DataFrame:
    """The 2-D map of the whole table, restricted to its largest cluster (ties to the smallest)."""
    from assayspark.operators.stats import largest_group

    largest = largest_group(df, cluster).first()
    table = map_2d(df, features, [*keep, cluster] if cluster not in keep else keep)
    return table.where(F.col(cluster) == largest[cluster]) if largest else table.limit(0)


def landscape_3d(
    df: DataFrame, features: str, key: str, value: str, labels: Sequence[str] = ("cluster", "subcluster")
) -> DataFrame:
    """(key, pc1, pc2, pc3, value, text, size) for a 3-D plot; needs at least 10 features."""
    width = df.select(F.size(vector_to_array(features)).alias("w")).first()
    if width is None or width.w < 10:
        raise ValueError("a landscape needs at least 10 features")
    present = [c for c in labels if c in df.columns]
    table, _ = project(df, features, 3, keep=[key, value, *present])
    parts = [F.col(key).cast("string"), F.format_string("pIC50: %.2f", F.col(value))]
    parts += [F.concat(F.lit(f"{c.capitalize()}: "), F.col(c).cast("string")) for c in present]
    return table.withColumn("text", act.row_label(parts)).withColumn(
        "size", act.marker_size(F.lit(df.count()))
    )
