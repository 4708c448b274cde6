"""Near-duplicates: the similarity by definition, signatures that estimate it, classes against all pairs, the edge cases."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from assayspark.llm import near_dedup
from assayspark.llm.components import components
from assayspark.llm.words import Words

SCHEMA = "doc_id long, text string, key string, _n int"


def shingles(t):
    w = (t or "").encode().lower().split()
    return Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else [])


def by_definition(a, b):
    both = set(a) | set(b)
    return sum(1 / sum(max(a[y] / a[x], b[y] / b[x]) for y in both) for x in a.keys() & b.keys())


def corpus(seed=4):
    rng = random.Random(seed)
    rows = []
    for _ in range(12):
        base = [f"w{rng.randrange(60)}" for _ in range(rng.randrange(5, 120))]
        for _ in range(rng.randrange(1, 6)):
            copy = [w if rng.random() > 0.01 else "new" for w in base] + ["tail"] * rng.randrange(3)
            rows.append(" ".join(copy))
    rows += ["a b c", "A  B\nc", "a b d", None, "", "  ", "rep eat " * 300, "rep eat " * 299, "rep " * 8]
    return [(i, t, "x", 1) for i, t in enumerate(rows)] + [(None, rows[0], "x", 1), (3, rows[3], "x", 1)]


def test_similarity_is_probability_jaccard():
    column = pa.array([t for _, t, *_ in corpus()])
    words = Words(column, lower=True)
    hashes, owner, weights = near_dedup.weighted(words, 5)
    cut = np.searchsorted(owner, np.arange(len(column) + 1))
    sets = [(hashes[i:j], weights[i:j]) for i, j in zip(cut[:-1], cut[1:])]
    plain = [shingles(t) for t in column.to_pylist()]
    for i in range(0, len(sets), 3):
        for j in range(len(sets)):
            assert near_dedup.similarity(sets[i], sets[j]) == pytest.approx(by_definition(plain[i], plain[j]), abs=1e-9)
    every = np.ones((len(sets), len(sets)), bool)
    got = set(near_dedup.alike(sets, sets, every, 0.8))
    assert got == {(i, j) for i in range(len(sets)) for j in range(len(sets)) if by_definition(plain[i], plain[j]) >= 0.8}


def test_signatures_estimate_it():
    rng = random.Random(0)
    base = [f"w{rng.randrange(30)}" for _ in range(200)]
    texts = [" ".join(base), " ".join(base[:180] + ["x"] * 20), " ".join(base[:100])]
    words = Words(pa.array(texts))
    signature = near_dedup.signatures(*near_dedup.weighted(words, 1), len(texts), 4096)
    sets = [Counter((w,) for w in t.split()) for t in texts]
    for i, j in ((0, 1), (0, 2), (1, 2)):
        assert (signature[i] == signature[j]).mean() == pytest.approx(by_definition(sets[i], sets[j]), abs=0.03)
    assert (near_dedup.signatures(*near_dedup.weighted(Words(pa.array(["", "a"])), 5), 2, 8)[0] == 0).all()


@pytest.mark.parametrize("members", [2, 256])
def test_classes_against_all_pairs(spark, members):
    data = corpus()
    docs = spark.createDataFrame(data, SCHEMA).repartition(3)
    sets = [shingles(t) for _, t, *_ in data]
    parent = list(range(len(data)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(data)):
        for j in range(i):
            if sets[i] and by_definition(sets[i], sets[j]) >= 0.8:
                parent[root(i)] = root(j)
    classes = {}
    for i in range(len(data)):
        classes.setdefault(root(i), []).append(data[i][0])
    want = sorted((str(d), str(min((x for x in c if x is not None), default=None)), len(c)) for c in classes.values() for d in c)
    settings = near_dedup.Settings(members=members)
    got = near_dedup.classes(docs, settings=settings).collect()
    assert sorted((str(r["doc_id"]), str(r["class_id"]), r["class_size"]) for r in got) == want
    assert sum(r["kept"] for r in got) == len(classes)
    if members == 256:
        kept = near_dedup.keep_one(docs)
        assert kept.columns == docs.columns and kept.count() == len(classes)


def test_empty(spark):
    assert near_dedup.classes(spark.createDataFrame([], SCHEMA)).collect() == []


def test_components(spark):
    rng = random.Random(7)
    chain = [(i, i + 1) for i in range(0, 60)]
    star = [(1000, 1000 + i) for i in range(1, 40)]
    links = chain + star + [(5, 5), (2000, 2001), (2001, 2000)]
    rng.shuffle(links)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {i: 0 for i in range(61)} | {1000 + i: 1000 for i in range(40)} | {2000: 2000, 2001: 2000}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
