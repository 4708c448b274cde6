"""Exact dedup: composable fingerprints, collisions told apart, equality with grouping by text, the edge cases."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from assayspark.llm import exact_dedup

SCHEMA = "doc_id long, text string, fp string, _sha string"


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def rows(seed=2):
    rng = random.Random(seed)
    base = ["".join(rng.choice("ab é\t\n 日") for _ in range(rng.randrange(60))) for _ in range(40)]
    made = base + [b.replace(" ", "\n\t") for b in base[:20]] + [None, "", " ", "\n", "long " * 50000, "long\n" * 50000, "long " * 49999]
    out = [(i, t, "x", None) for i, t in enumerate(made)]
    return out + [(None, base[0], "y", "z"), (None, "only here", "y", "z"), (5, made[5], "x", None), (5, "other text", "x", None)]


def test_every_row_against_grouping_by_text(spark):
    data = rows()
    groups = defaultdict(list)
    for i, t, *_ in data:
        groups[norm(t)].append(i)
    docs = spark.createDataFrame(data, SCHEMA).repartition(4)
    got = exact_dedup.decide(docs).collect()
    assert len(got) == len(data)
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    kept = defaultdict(int)
    for r in got:
        ids = by_sha[r["text_sha256"]]
        first = min((i for i in ids if i is not None), default=None)
        assert (r["keep_id"], r["group_size"]) == (first, len(ids))
        if r["kept"]:
            assert r["doc_id"] == first
            kept[r["text_sha256"]] += 1
    assert set(kept.values()) == {1} and len(kept) == len(groups)
    stay = exact_dedup.keep_first(docs)
    assert stay.columns == docs.columns
    assert sorted(norm(r["text"]) for r in stay.collect()) == sorted(groups)
    assert exact_dedup.decide(docs.limit(0)).collect() == [] and exact_dedup.keep_first(docs.limit(0)).collect() == []


@pytest.mark.parametrize("chunk", [1, 3, 64, 1 << 16])
def test_chunks_compose(chunk):
    column = pa.array([norm(t) for _, t, *_ in rows() if t is None or len(t) < 1000] + ["x" * 5000])
    data, offs = exact_dedup.normalised(column)
    want = []
    for a, b in zip(offs[:-1], offs[1:]):
        total = (0, 0)
        for byte in data[a:b].tolist():
            total = exact_dedup.combine(total, (byte + 1, byte + 1), 1)
        want.append((total[0] << 31) | total[1])
    assert exact_dedup.fingerprints(data, offs, chunk).tolist() == want


def test_collisions_are_seen_and_split(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "ab"), (2, "cd"), (3, "ab"), (4, "zz"), (5, "zz")], "doc_id long, text string")
    same = docs.select(F.when(F.col("doc_id") < 4, 7).otherwise(8).cast("long").alias("fp"), F.lit(2).cast("long").alias("n_bytes"), "text")
    groups = same.groupBy("fp", "n_bytes").count()
    for total in (1, 10**9):  # hot groups and others
        assert [r["fp"] for r in exact_dedup.collisions(same, groups, total, chunk=1).collect()] == [7]


def test_white_space_runs_end_at_rows():
    data, offs = exact_dedup.normalised(pa.array(["a \n", " b", None, "\t", "c"]))
    assert [data[a:b].tobytes() for a, b in zip(offs[:-1], offs[1:])] == [b"a ", b" b", b"", b" ", b"c"]
    assert np.diff(offs).tolist() == [2, 2, 0, 1, 1]
