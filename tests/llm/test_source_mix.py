"""Mixing: the tree by hand, prefixes against a sort, the edge cases."""

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from assayspark.llm import source_mix

SCHEMA = "doc_id long, text string, lang string, source string, domain string, tokens string"


def mixed(docs, plan, run=source_mix.decide):
    return run(docs, F.col("domain"), F.col("lang"), F.col("source"), F.col("doc_id"), F.col("text"), plan)


def corpus(seed=6):
    rng = random.Random(seed)
    rows = []
    for i in range(300):
        big = rng.random() < 0.5
        leaf = ("d0", "en", "s0") if big else (rng.choice(["d0", "d1", None]), rng.choice(["en", "fr"]), rng.choice(["s0", "s1", None]))
        n = rng.choice([0, 1, 5, 40])
        rows.append((i, " ".join("w" * (1 + i % 3) for _ in range(n)), leaf[1], leaf[2], leaf[0], "x"))
    rows += [(7, "a b c", "en", "s0", "d0", "x"), (None, "a b", "en", "s0", "d0", "x"), (None, None, "en", "s0", "d0", "x"), (900, None, "xx", "none", "d9", "x")]
    return rows


def by_hand(rows, plan):
    """Water levels found by trying: a child below its share gives the rest to its siblings, round after round."""
    tokens = defaultdict(int)
    for r in rows:
        tokens[r[4], r[2], r[3]] += len((r[1] or "").split())
    def pour(nodes, budget, depth):
        level = source_mix.LEAF[depth]
        names = sorted({n[depth] for n in nodes}, key=str)
        cap = {c: sum(tokens[n] for n in nodes if n[depth] == c) * plan.epochs for c in names}
        weight = {c: plan.weights.get(level, {}).get(c, 1) for c in names}
        given, open_, left = {}, set(names), budget
        while open_:
            share = {c: left * weight[c] / sum(weight[x] for x in open_) if weight[c] else 0 for c in open_}
            full = {c for c in open_ if weight[c] and cap[c] <= share[c] + 1e-9}
            if not full:
                given |= share
                break
            for c in full:
                given[c] = cap[c]
                left -= cap[c]
            open_ -= full
        out = {}
        for c in names:
            inner = [n for n in nodes if n[depth] == c]
            out |= {inner[0]: given[c]} if depth == 2 else pour(inner, given[c], depth + 1)
        return out
    return tokens, pour(list(tokens), int(sum(tokens.values()) * plan.share), 0)


@pytest.mark.parametrize("digits, share, epochs", [(3, 0.8, 2), (1, 0.8, 2), (1, 0.5, 1), (3, 1.5, 3), (1, 5.0, 2)])
def test_targets_and_prefixes(spark, digits, share, epochs):
    rows = corpus()
    plan = source_mix.Plan(share, epochs, "s", {"domain": {"d0": 3, "d9": 5}, "language": {"fr": 2}}, digits)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    tokens, target = by_hand(rows, plan)
    got = mixed(docs, plan).collect()
    assert len(got) == len(rows)
    copies = defaultdict(list)
    for r in got:
        leaf = (r["domain"], r["language"], r["source"])
        assert abs(r["target_tokens"] - target[leaf]) <= 1
        copies[leaf, r["doc_id"]].append((r["n_tokens"], r["copies"], r["target_tokens"]))
    for leaf in tokens:
        own = {k[1]: v for k, v in copies.items() if k[0] == leaf}
        goal = next(iter(own.values()))[0][2]
        whole = goal // tokens[leaf] if tokens[leaf] else 0
        rest = goal - whole * tokens[leaf]
        place = lambda i: hashlib.md5(f"s:{whole}:{'' if i is None else i}".encode()).hexdigest()
        total = 0
        for i in sorted(own, key=place):
            total += sum(n for n, _, _ in own[i])
            assert {c for _, c, _ in own[i]} == {whole + (rest > 0 and total <= rest)}
    rows_out = mixed(docs, plan, source_mix.mixed)
    assert rows_out.columns == docs.columns and rows_out.count() == sum(r["copies"] for r in got)


def test_many_leaves_take_the_other_join(spark):
    rows, leaves = corpus(), None
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("domain", "lang as language", "source", "doc_id")
    leaves = docs.groupBy(*source_mix.LEAF).count()
    a, b = (source_mix.by_leaf(docs, leaves, most).select("r.doc_id", "l.count") for most in (100_000, 1))
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect())) and a.count() == len(rows)


def test_empty(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert mixed(docs, source_mix.Plan()).collect() == [] and mixed(docs, source_mix.Plan(), source_mix.mixed).collect() == []
