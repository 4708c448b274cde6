import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from assayspark.operators import cluster, features as ft, similarity


def frame(spark, x, labels=None):
    rows = [(i, int(labels[i]) if labels is not None else 0, [float(v) for v in row]) for i, row in enumerate(x)]
    df = spark.createDataFrame(rows, "id bigint, cluster int, x array<double>")
    return df.withColumn("features", ft.dense_vector(F.col("x")))


def blobs(n=60, k=3, d=6, seed=1, spread=0.3):
    rng = np.random.default_rng(seed)
    labels = np.arange(n) % k
    return rng.normal(0, spread, (n, d)) + 4 * rng.normal(0, 1, (k, d))[labels], labels


def brute_nearest(queries, training, threshold):
    out = {}
    for qid, q in queries:
        q, best = set(q), None
        for tid, t in training:
            t = set(t)
            if not q or not t:
                continue
            s = len(q & t) / len(q | t)
            if s >= threshold and (best is None or (-s, tid) < best):
                best = (-s, tid)
        out[qid] = (None, None) if best is None else (best[1], -best[0])
    return out


@pytest.mark.parametrize("threshold", [0.3, 0.5, 0.75, 1.0])
@pytest.mark.parametrize("chunk", [3, 10_000])
def test_nearest_against_brute_force(spark, threshold, chunk):
    """Copies, near copies of one set in a third of all rows, common bits, empty sets, ties."""
    rng = random.Random(7)
    base = rng.sample(range(128), 20)

    def one(i):
        if i % 3 == 0:
            return sorted({*rng.sample(base, rng.choice([17, 18, 19, 20])), *rng.sample(range(128), rng.choice([0, 1]))})
        if i % 17 == 0:
            return []
        return sorted(rng.sample([0, 1, 2, *range(128)], rng.randint(1, 25)))

    training = [(i, sorted(set(one(i)))) for i in range(150)]
    queries = [(i, sorted(set(one(i)))) for i in range(90)] + [(90, training[5][1]), (91, [127, 126])]
    schema = "id bigint, bits array<int>"
    got = similarity.nearest_neighbours(
        spark.createDataFrame(queries, schema), spark.createDataFrame(training, schema), threshold, 128, chunk=chunk
    ).collect()
    want = brute_nearest(queries, training, threshold)
    assert {r.id: r.neighbour for r in got} == {i: w[0] for i, w in want.items()}
    for r in got:
        assert r.in_domain == (want[r.id][0] is not None)
        assert r.similarity == (pytest.approx(want[r.id][1]) if r.in_domain else None)


@pytest.mark.parametrize("threshold", [0.2, 0.4, 0.55])
@pytest.mark.parametrize("n_bits", [64, 130])
def test_common_bits_are_compared_in_blocks(spark, monkeypatch, threshold, n_bits):
    """Sets that share most bits go in whole blocks, each pair once, and give what brute force gives; ids may be texts."""
    rng = random.Random(3)

    def one(i):
        return [] if i % 29 == 0 else sorted({*range(4), *rng.sample(range(n_bits), rng.randint(1, n_bits // 2))})

    training = [(f"T{i % 190}", one(i)) for i in range(200)]
    training += [("Z", training[3][1]), ("B", training[3][1])]
    queries = [(f"Q{i}", one(i)) for i in range(120)] + [("Q120", training[3][1]), ("Q121", training[7][1])]
    schema = "id string, bits array<int>"

    def joined(*_):
        raise AssertionError("pairs met once for every common bit")

    monkeypatch.setattr(similarity, "_by_bits", joined)
    got = similarity.nearest_neighbours(
        spark.createDataFrame(queries, schema), spark.createDataFrame(training, schema), threshold, n_bits
    ).collect()
    want = brute_nearest(queries, training, threshold)
    assert {r.id: (r.neighbour, r.similarity) for r in got} == want and len(got) == len(queries)


def test_feature_job(spark):
    df = spark.createDataFrame([(1, "12"), (2, "x"), (3, None), (4, "5")], "id int, s string")
    registry = {"n": (lambda s: int(s), "int"), "half": (lambda s: int(s) / 2, "double"), "boom": (lambda s: 1 / 0, "double")}
    got = ft.feature_job(df, "s", registry, ["half", "n"])
    assert got.columns == ["id", "s", "half", "n"]
    assert [(r.id, r.half, r.n) for r in got.orderBy("id").collect()] == [(1, 6.0, 12), (4, 2.5, 5)]
    kept = ft.feature_job(df, "s", registry, keep_invalid=True).collect()
    assert len(kept) == 4 and all(r.n is None for r in kept)
    assert ft.feature_job(df, "s", registry, ["numbers"], categories={"numbers": ["n", "half"]}).columns == ["id", "s", "n", "half"]
    with pytest.raises(ValueError, match="nope"):
        ft.feature_job(df, "s", registry, ["nope"])
    with pytest.raises(ValueError, match="circular"):
        ft.with_hashed_bits(df, "s", kind="circular")


def test_bits_and_vectors(spark):
    df = spark.createDataFrame([(1, [0, 2, 10]), (2, []), (3, [15])], "id int, bits array<int>")
    made = ft.bits_to_vector(df, "bits", "v", 16)
    assert [r.v.size for r in made.collect()] == [16] * 3
    back = made.select("id", ft.vector_to_bits(F.col("v")).alias("b")).orderBy("id").collect()
    assert [r.b for r in back] == [[0, 2, 10], [], [15]]
    assert ft.non_zero(df, "bits").count() == 2


def test_moments_and_zscores(spark):
    x, _ = blobs()
    x[:, 2] = 5.0
    df = frame(spark, x)
    rows = cluster.column_moments(df, "features").orderBy("pos").collect()
    assert [r["std"] for r in rows] == pytest.approx(x.std(axis=0).tolist(), abs=1e-12)
    z = np.array([r.z for r in cluster.zscore(df, "features", "z").orderBy("id").collect()])
    std = x.std(axis=0)
    want = np.where(std > 1e-12, (x - x.mean(axis=0)) / np.where(std > 1e-12, std, 1), 0)
    assert np.allclose(z, want)


def brute_silhouette(x, labels):
    d = np.sqrt(((x[:, None] - x) ** 2).sum(-1))
    out = []
    for i, l in enumerate(labels):
        own = (labels == l) & (np.arange(len(x)) != i)
        if not own.any():
            out.append(0.0)
            continue
        a = d[i, own].mean()
        b = min(d[i, labels == m].mean() for m in set(labels) - {l})
        out.append((b - a) / max(a, b))
    return out


@pytest.mark.parametrize("block", [7, 2000])
def test_silhouette_in_blocks(spark, block):
    x, labels = blobs(41, spread=2.0)
    labels = labels.copy()
    labels[0] = 9  # alone in its group
    got = cluster.silhouette_exact(frame(spark, x, labels), "id", "features", "cluster", block).orderBy("id").collect()
    assert [r.silhouette for r in got] == pytest.approx(brute_silhouette(x, labels))


@pytest.mark.parametrize("shift", [0.0, 1e4])
def test_silhouette_sends_a_row_once_a_block(spark, monkeypatch, shift):
    """Pairs of blocks meet once and serve both sides, so half as many are sent; no digit is lost for copies or far from 0."""
    x, labels = blobs(600, spread=1.0)
    x = x + shift
    x[300:320] = x[0:20]
    df = frame(spark, x, labels).withColumn("id", F.concat(F.lit("r"), "id"))
    for blocks in (1, 6):
        monkeypatch.setattr(cluster, "_block_count", lambda *_: blocks)
        made = cluster.silhouette_exact(df, "id", "features", "cluster")
        got = {r.id: r.silhouette for r in made.collect()}
        assert [got[f"r{i}"] for i in range(600)] == pytest.approx(brute_silhouette(x, labels), abs=1e-9)
    monkeypatch.undo()
    assert cluster._block_count(600_000, 64, 24) <= 20 and cluster._block_count(1000, 64, 24) == 2
    assert cluster._block_count(10**6, 2048, 24) * cluster.BLOCK_BYTES >= 10**6 * 2048 * 8


def test_silhouette_needs_two_labels(spark):
    x, _ = blobs(6)
    assert cluster.silhouette_squared(frame(spark, x), "features", "cluster") is None


def test_kmeans_finds_blobs(spark):
    x, labels = blobs()
    labelled, model, cost = cluster.kmeans(frame(spark, x).drop("cluster"), "features", 3, restarts=3)
    found = {r.id: r.cluster for r in labelled.collect()}
    groups = {l: {found[i] for i in range(len(x)) if labels[i] == l} for l in range(3)}
    assert all(len(g) == 1 for g in groups.values()) and len(set.union(*groups.values())) == 3
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    want = sum(((z[labels == l] - z[labels == l].mean(axis=0)) ** 2).sum() for l in range(3))
    assert cost == pytest.approx(want)
    again = cluster.attach_label(frame(spark, x).drop("cluster"), model)
    assert {r.id: r.cluster for r in again.collect()} == found


def test_inertia_and_assignment(spark):
    x, labels = blobs(30)
    df = frame(spark, x, labels)
    want = sum(((x[labels == l] - x[labels == l].mean(axis=0)) ** 2).sum() for l in range(3))
    assert cluster.inertia(df, "features", "cluster").first()[0] == pytest.approx(want)
    centres = cluster.group_centres(df, "features", "cluster")
    got = cluster.assign_centres(df, "features", centres, "cluster").collect()
    assert all(r.nearest == r.cluster for r in got)
    with pytest.raises(ValueError, match="too many"):
        cluster.assign_centres(df, "features", centres, "cluster", largest=5)


def test_k_report(spark):
    x, _ = blobs(45, spread=0.2)
    curve, choice = cluster.k_report(frame(spark, x), "features", 5, restarts=2, key="id", measure="euclidean")
    rows = curve.orderBy("k").collect()
    assert rows[0].inertia == pytest.approx(45 * 6) and rows[0].silhouette is None
    assert all(a.inertia >= b.inertia * 0.99 for a, b in zip(rows, rows[1:]))
    row = choice.first()
    assert (row.n, row.best_k, row.rule, row.recommended) == (45, 3, 2, 2)
    squared = cluster.k_curve(frame(spark, x), "features", 2, restarts=1).orderBy("k").collect()[1]
    assert squared.measure == "squared euclidean" and -1 <= squared.silhouette <= 1


def test_subcluster_edges(spark):
    x, labels = blobs(30)
    df = frame(spark, x, labels)
    empty, model, _ = cluster.subcluster(df, "features", 99)
    assert empty.count() == 0 and "subcluster" in empty.columns and model is None
    few, _, _ = cluster.subcluster(df.where("id in (0, 3)"), "features", 0, k=5, restarts=1)
    assert few.count() == 2
    made, _, _ = cluster.subcluster(df, "features", 1, restarts=1)
    assert made.count() == 10 and made.select("subcluster").distinct().count() == 2


def test_projection_against_numpy(spark):
    x, _ = blobs(40)
    x = x + 3
    table, shares = cluster.project(frame(spark, x), "features", 3, keep=["id"])
    got = np.array([[r.pc1, r.pc2, r.pc3] for r in table.orderBy("id").collect()])
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    w, v = np.linalg.eigh(np.cov(z.T))
    v = v[:, ::-1][:, :3]
    v = v * np.sign(v[np.abs(v).argmax(axis=0), range(3)])
    assert np.allclose(got, z @ v, atol=1e-8)
    assert shares == pytest.approx((w[::-1][:3] / w.sum()).tolist()) and sum(shares) <= 1 + 1e-9
    capped, _ = cluster.project(frame(spark, x), "features", 50)
    assert len(capped.columns) == 6


def test_maps(spark):
    x, labels = blobs(31, d=12)
    df = frame(spark, x, labels).withColumn("p", F.col("id").cast("double"))
    table = cluster.map_largest_cluster(df, "features", ["id"])
    assert {r.id % 3 for r in table.collect()} == {0} and table.columns == ["id", "cluster", "x", "y"]
    points = cluster.landscape_3d(df, "features", "id", "p").orderBy("id").collect()
    assert len(points) == 31 and points[1].text == "1<br>pIC50: 1.00<br>Cluster: 1" and points[0].size == 8
    with pytest.raises(ValueError, match="10 features"):
        cluster.landscape_3d(frame(spark, blobs()[0]).withColumn("p", F.lit(1.0)), "features", "id", "p")
