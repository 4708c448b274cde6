"""The tree builder: splits against brute force, aggregates against tasks, nested grids against fit by fit."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from assayspark.operators import features as ft, models, tree_kernel as kernel, trees
from assayspark.operators.trees import Boosted, Fit, Forest
from assayspark.session import new_path


def brute(bins, y, w, min_leaf, min_split, depth):
    """A tree by trying every split of every node."""
    bins, y, w = bins[w > 0], y[w > 0], w[w > 0]
    best = None
    if depth > 0 and len(set(y.tolist())) > 1 and len(y) >= min_split:
        for c in range(bins.shape[1]):
            for b in sorted(set(bins[:, c].tolist()))[:-1]:
                left = bins[:, c] <= b
                if min(left.sum(), (~left).sum()) < min_leaf:
                    continue
                score = float((w * y)[left].sum()) ** 2 / w[left].sum() + float((w * y)[~left].sum()) ** 2 / w[~left].sum()
                if best is None or score > best[0]:
                    best = (score, c, b)
    if best is None:
        return float(np.round((w * y).sum() / w.sum())), len(y)
    left = bins[:, best[1]] <= best[2]
    sides = [brute(bins[x], y[x], w[x], min_leaf, min_split, depth - 1) for x in (left, ~left)]
    return best[1], best[2], *sides


def nested(tree, i=0):
    if tree.column[i] < 0:
        return float(tree.value[i]), int(tree.rows[i])
    return int(tree.column[i]), int(tree.cut[i]), nested(tree, tree.left[i]), nested(tree, tree.left[i] + 1)


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("cells", [1, 1 << 21])
def test_grow_equals_brute_force(seed, cells, monkeypatch):
    monkeypatch.setattr(kernel, "CELLS", cells)
    rng = np.random.default_rng(seed)
    for _ in range(60):
        n, columns = rng.integers(1, 50), rng.integers(1, 5)
        bins = rng.integers(0, rng.integers(1, 12), (n, columns)).astype(np.uint8)
        y = rng.integers(-900, 900, n) if seed % 2 else rng.integers(0, 3, n)
        w = rng.integers(0, 3, n)
        w[0] = 1
        depth, leaf, split = int(rng.choice([0, 2, 1000])), int(rng.integers(1, 4)), int(rng.choice([2, 7]))
        tree = kernel.grow(bins, y, w, depth, leaf, split)
        assert nested(tree) == brute(bins, y, w, leaf, split, depth)
        whole = kernel.grow(bins, y, w, kernel.NO_LIMIT, leaf)
        assert (tree.value[tree.reach(bins)] == whole.value[whole.reach(bins, depth, split)]).all()  # a cut tree is the smaller tree


def plain_boosting(x, y, rounds, depth, rate, l2):
    """Boosting by trying every split, in whole units, over raw values."""

    def tree(rows, g, d):
        step = float(np.round(rate * g[rows].sum() / (len(rows) + l2)))
        best = None
        if d:
            for c in range(x.shape[1]):
                for v in sorted(set(x[rows, c].tolist()))[:-1]:
                    a, b = rows[x[rows, c] <= v], rows[x[rows, c] > v]
                    score = g[a].sum() ** 2 / (len(a) + l2) + g[b].sum() ** 2 / (len(b) + l2)
                    if best is None or score > best[0]:
                        best = (score, a, b)
        if best is None or best[0] - g[rows].sum() ** 2 / (len(rows) + l2) <= 0:
            return {int(r): step for r in rows}
        return tree(best[1], g, d - 1) | tree(best[2], g, d - 1)

    now = np.full(len(y), int(round(y.sum() / len(y))))
    for _ in range(rounds):
        steps = tree(np.arange(len(y)), (y - now).astype(float), depth)
        now = now + np.array([int(steps[i]) for i in range(len(y))])
    return now


def test_boosting_equals_a_plain_one():
    rng = np.random.default_rng(1)
    x, y = rng.integers(0, 9, (60, 3)).astype(np.uint8), rng.integers(-(10**6), 10**6, 60)
    trees_, said = Boosted(7, 3, 0.3).booster(42).fit(x, y, np.arange(60), 7, 9, int(round(y.sum() / 60)), x, (2, 7))
    assert len(trees_) == 7
    for rounds in (2, 7):
        assert (said[rounds] == plain_boosting(x, y, rounds, 3, 0.3, 1.0)).all()


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(5)
    x = np.column_stack([rng.normal(size=400), rng.integers(0, 4, 400), rng.normal(size=400), np.zeros(400)])
    y = 6 + x[:, 0] + 0.5 * (x[:, 1] == 2) + 0.1 * rng.normal(size=400)
    rows = [(i, float(v), int(i % 3), [float(a) for a in r]) for i, (v, r) in enumerate(zip(y, x))]
    rows += [(1000, None, 0, [0.0] * 4), (1001, float("nan"), 0, [0.0] * 4), (1002, 6.0, 1, None), (1003, 6.0, 1, [float("nan"), 1.0, 0.0, 0.0]), (0, rows[0][1], 0, rows[0][3])]
    df = spark.createDataFrame(rows, "id long, p double, cluster int, x array<double>")
    return df.withColumn("features", F.when(F.col("x").isNotNull(), ft.dense_vector(F.col("x")))).repartition(5).cache()


@pytest.fixture(scope="module")
def prepared(table):
    return models.prepared(table, "id", "p", "x", "cluster")


FITS = [
    Fit(Forest(5), 0, None, ((5, None, 2), (3, 4, 2), (5, 2, 2), (2, None, 30))),
    Fit(Forest(3, 6, 2, 5), 1),
    Fit(Boosted(4, 3, 0.3, 0.8, 0.8), 2, None, ((2, None, 2), (4, None, 2))),
    Fit(Boosted(2, 2, 0.5), 0, 1),
    Fit(Forest(4), 1, 2),
]


def answers(prepared, few):
    rows, cuts = prepared
    results, bases, tops = trees.run(rows, FITS, cuts, True, few)
    said = {(r.fit, r.variant, r["row"]): r.prediction for r in trees.held_out(results, FITS, bases).collect()}
    weights = [trees.model_of(results, i, f, cuts, "x", bases, tops).weights for i, f in enumerate(FITS)]
    return said, weights, (results, bases, tops)


@pytest.mark.parametrize("few", [40])
def test_aggregates_make_the_trees_of_tasks(spark, table, prepared, few):
    """Nodes beyond `few` rows are split by aggregates: the same predictions, weights and saved models as in tasks."""
    said, weights, kept = answers(prepared, None)
    large, large_weights, (results, bases, tops) = answers(prepared, few)
    assert tops and large == said and len(said) > 150
    for a, b in zip(weights, large_weights):
        assert a == pytest.approx(b)
    for i in (0, 2):
        model = trees.model_of(results, i, FITS[i], prepared[1], "x", bases, tops)
        whole = trees.model_of(kept[0], i, FITS[i], prepared[1], "x", kept[1], kept[2])
        path = new_path(spark, "trees")
        model.save(path)
        a, b, c = ({(r.id, str(r.x)): r.prediction for r in m.transform(table).collect()} for m in (model, whole, trees.TreeModel.load(spark, path)))
        assert a == b == c and a[1002, "None"] is None and all(v is not None for k, v in a.items() if k[0] != 1002)


def test_held_out_rows_are_what_the_model_says(table, prepared):
    rows, cuts = prepared
    said, _, (results, bases, tops) = answers(prepared, None)
    model = trees.model_of(results, 0, FITS[0], cuts, "x", bases, tops)
    again = {r.id: r.prediction for r in model.transform(table.where("cluster = 0")).collect()}
    held = rows.where("part = 0 and is_test").select("key", "row").collect()
    assert held and all(said[0, 0, r["row"]] == pytest.approx(again[r.key], abs=1e-9) for r in held)


def test_blocks_and_chunks_of_a_prediction(table, prepared, monkeypatch):
    _, _, (results, bases, tops) = answers(prepared, 25)
    model = trees.model_of(results, 0, FITS[0], prepared[1], "x", bases, tops)
    want = sorted((r.id, r.prediction) for r in model.transform(table).where("p is not null").collect())
    monkeypatch.setattr(trees, "BLOCK_NODES", 3)
    monkeypatch.setattr(trees, "CHUNK_ROWS", 50)
    got = sorted((r.id, r.prediction) for r in model.transform(table).where("p is not null").collect())
    assert str(got) == str(want)


@pytest.mark.parametrize(
    "kind,grid",
    [
        ("rf", {"numTrees": [2, 4], "maxDepth": [None, 3], "minSamplesSplit": [2, 12], "minInstancesPerNode": [1, 3]}),
        ("gbt", {"maxIter": [2, 5], "maxDepth": [2, 3], "stepSize": [0.3], "subsamplingRate": [0.8, 1.0], "columnRate": [0.7]}),
    ],
)
def test_nested_grid_equals_fit_by_fit(table, kind, grid):
    train = models.with_split(table.select("id", "p", "features"), "id")
    best, params, scores = models.grid_search(train, kind, grid=grid)
    rows, cuts = models.prepared(train.withColumn("is_test", F.lit(False)), "id", "p", "features")
    found = {tuple(sorted(r.params.items())): r.mse for r in scores.collect()}
    names = list(grid)
    points = list(models.product(*grid.values()))
    assert len(found) == len(points)
    fits = [Fit(models.plan(kind, dict(zip(names, p))), 0, fold) for p in points for fold in range(5)]
    results, bases, _ = trees.run(rows, fits, cuts)
    said = trees.held_out(results, fits, bases).join(rows.select("row", "actual"), "row")
    each = {r.fit: r.mse for r in said.groupBy("fit").agg(F.avg((F.col("actual") - F.col("prediction")) ** 2).alias("mse")).collect()}
    for i, p in enumerate(points):
        mean = np.mean([each[5 * i + fold] for fold in range(5)])
        assert found[tuple(sorted((n, str(v)) for n, v in zip(names, p)))] == pytest.approx(mean, rel=1e-9)
    assert found[tuple(sorted(params.items()))] == min(found.values()) and best.plan.trees == int(params[names[0]])


def test_registered_grids_have_all_points():
    for kind, points, fits in (("rf", 81, 3), ("gbt", 243, 81)):
        made, answers_ = models.nested_fits(kind, models.FULL_GRID[kind], 5)
        assert len(answers_) == points and len(made) == 5 * fits and len({a for _, a in answers_}) == points


def test_nothing_to_fit(spark, table):
    model, metrics, pairs = models.build_model(table.where("false"), "id", settings={"numTrees": 2})
    assert pairs.count() == 0 and metrics.first().n == 0
    assert model.transform(table.where("false")).count() == 0
    with pytest.raises(ValueError, match="unknown settings"):
        models.build_model(table, "id", settings={"trees": 2})


def test_repeated_rows_are_rows_of_their_own(spark, table):
    twice = table.unionByName(table)
    _, _, pairs = models.build_model(twice, "id", settings={"numTrees": 2}, keep=False)
    _, _, once = models.build_model(table, "id", settings={"numTrees": 2}, keep=False)
    assert pairs.count() == 2 * once.count()


def test_predictions_are_added_up_in_tasks(prepared):
    """A row held out is sent once a block and fit, not once a tree; a block has a run of trees, so few fits."""
    rows, cuts = prepared
    fits = [Fit(Forest(12), 0, fold, ((12, None, 2), (6, 3, 2))) for fold in range(3)]
    results, bases, _ = trees.run(rows, fits, cuts, blocks=3)
    sent = {r.fit: r.n for r in results.where("row is not null").groupBy("fit").agg(F.count("*").alias("n")).collect()}
    held = {r.fold: r.n for r in rows.where("part = 0 and not is_test").groupBy("fold").agg(F.count("*").alias("n")).collect()}
    assert sent == {fold: held[fold] for fold in range(3)}
    alone = trees.run(rows, fits[:1], cuts, blocks=1)
    said = {(r.variant, r["row"]): r.prediction for r in trees.held_out(results, fits, bases).where("fit = 0").collect()}
    assert said == {(r.variant, r["row"]): r.prediction for r in trees.held_out(alone[0], fits[:1], alone[1]).collect()}


@pytest.mark.parametrize("wave", [1, 1 << 30])
def test_cells_make_the_trees_of_rows(spark, wave, monkeypatch):
    """Many rows with few different bins are added up by cell: the same predictions, weights and models, and no row is dealt to a tree."""
    rng = np.random.default_rng(8)
    x = np.column_stack([rng.integers(0, 5, 900), rng.integers(0, 3, 900), rng.integers(0, 2, 900)])
    y = 6 + x[:, 0] * 0.3 - 0.5 * (x[:, 1] == 2) + 0.2 * rng.integers(0, 3, 900) * x[:, 2]
    df = spark.createDataFrame([(i, float(v), i % 2, [float(a) for a in r]) for i, (v, r) in enumerate(zip(y, x))], "id long, p double, cluster int, x array<double>")
    rows, cuts = models.prepared(df, "id", "p", "x", "cluster")
    fits = [
        Fit(Forest(5), 0, None, ((5, None, 2), (3, 4, 2), (5, 2, 2), (2, None, 30))),
        Fit(Forest(4, 6, 3, 9), 1, 2),
        Fit(Boosted(6, 3, 0.3, 0.8, 0.8), 1, None, ((2, None, 2), (6, None, 2))),
        Fit(Boosted(3, 2, 0.5), 0, 1),
    ]

    def never(*_):
        raise AssertionError("rows dealt to the trees")

    def answers(few):
        results, bases, tops = trees.run(rows, fits, cuts, True, few)
        said = {(r.fit, r.variant, r["row"]): r.prediction for r in trees.held_out(results, fits, bases).collect()}
        made = [trees.model_of(results, i, f, cuts, "x", bases, tops) for i, f in enumerate(fits)]
        return said, [m.weights for m in made], [{r.id: r.prediction for r in m.transform(df).collect()} for m in made]

    whole = answers(None)
    for f in ("_large_forests", "_large_boosted"):
        monkeypatch.setattr(trees, f, never)
    monkeypatch.setattr(trees, "WAVE_BYTES", wave)
    monkeypatch.setattr(trees, "CELL_BYTES", 1000)
    monkeypatch.setattr(trees, "COLLAPSED_ROWS", 64)
    said, weights, models_ = answers(100)
    assert said == whole[0] and len(said) > 500 and models_ == whole[2]
    for a, b in zip(weights, whole[1]):
        assert a == pytest.approx(b)


def test_clusters_of_repeated_bins_grow_from_cells(spark, monkeypatch):
    """A cluster that fits a task but has twice as many rows as different bins is not dealt to its trees either."""
    df = spark.range(1200).selectExpr("id", "cast(id % 3 as int) as cluster", "5 + id % 7 * 0.5 + id % 5 * 0.1 as p", "array(cast(id % 7 as double), id % 2) as x")
    report, _ = models.model_per_cluster(df, "id", features="x", settings={"numTrees": 4}, keep=False)
    want = {r.cluster: r for r in report.collect()}

    def never(*_):
        raise AssertionError("rows sent to every block of trees")

    monkeypatch.setattr(trees, "MANY_ROWS", 200)
    monkeypatch.setattr(trees, "_whole", never)
    report, _ = models.model_per_cluster(df, "id", features="x", settings={"numTrees": 4}, keep=False)
    assert {r.cluster: r for r in report.collect()} == want and len(want) == 3
