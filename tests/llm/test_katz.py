"""Katz backoff against a plain model over dictionaries, its normalisation, and the edge cases."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from assayspark.llm import katz, packed
from assayspark.llm.common import remainder

SCHEMA = "doc_id long, text string, lang string"


class Plain:
    """The same model by definition: dictionaries over whole n-grams."""

    def __init__(self, texts, order, cutoff=5):
        self.memo, self.sums = {}, {}
        self.order, self.d, self.grams = order, {}, {n: Counter() for n in range(1, order + 1)}
        for t in texts:
            tokens = ["<s>"] + self.tokens(t)
            for i in range(1, len(tokens)):
                for n in range(1, order + 1):
                    if i - n + 1 >= 0:
                        self.grams[n][tuple(tokens[i - n + 1 : i + 1])] += 1
        for n in range(1, order + 1):
            times = np.zeros(cutoff + 2)
            for c in self.grams[n].values():
                if c <= cutoff + 1:
                    times[c] += 1
            self.d[n] = katz.good_turing(times, cutoff)
        self.words = {g[0] for g in self.grams[1]}
        self.after = {n: {} for n in range(2, order + 1)}
        for n in range(2, order + 1):
            for g in self.grams[n]:
                self.after[n].setdefault(g[:-1], []).append(g[-1])  # every n-gram is there once
        self.total = sum(self.grams[1].values())

    @staticmethod
    def tokens(t):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        return low.encode().split() + ["</s>"]

    def kept(self, n, c):
        return (self.d[n][c] if c < len(self.d[n]) else 1.0) * c

    def p(self, word, history):
        if (word, history) not in self.memo:
            self.memo[word, history] = self.fresh(word, history)
        return self.memo[word, history]

    def whole(self, history):
        """Divisor, seen mass and what the shorter history leaves outside, once per history."""
        if history not in self.sums:
            n = len(history) + 1
            words = self.after[n][history] if n > 1 else [g[0] for g in self.grams[1]]
            counts = [self.grams[n][(*history, w)] for w in words]
            below = 1 - sum(self.p(w, history[1:]) for w in words) if n > 1 else 1.0
            seen, total = sum(self.kept(n, c) for c in counts), sum(counts)
            self.sums[history] = (total if total - seen > 1e-9 else total + 1, seen, below)
        return self.sums[history]

    def fresh(self, word, history):
        n = len(history) + 1
        if n > 1 and history not in self.after[n]:
            return self.p(word, history[1:])
        whole, seen, below = self.whole(history)
        c = self.grams[n].get((*history, word), 0)
        if below <= 1e-12:
            return self.kept(n, c) / seen if c else 0.0
        if c:
            return self.kept(n, c) / whole
        return (whole - seen) / whole / below * (self.p(word, history[1:]) if n > 1 else 1.0)

    def score(self, t):
        tokens, total = ["<s>"] + self.tokens(t), 0.0
        for i in range(1, len(tokens)):
            total += math.log10(self.p(tokens[i], tuple(tokens[max(0, i - self.order + 1) : i])))
        return total


def corpus(n=140, seed=3):
    rng = random.Random(seed)
    words = [f"w{int(rng.paretovariate(0.7)) % 400}" for _ in range(4000)] + ["É", "The", "the"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randrange(0, 40))), "x") for i in range(n)]
    return rows + [(n, None, None), (n + 1, "", "x"), (n + 1, "", "x"), (None, "The\tTHE\n the", "x"), (n + 2, " ".join(rng.choices(words, k=3000)), "x")]


@pytest.mark.parametrize("order, hot", [(1, 200), (2, 200), (2, 10**9), (3, 200), (3, 10**9)])
def test_scores_are_those_of_the_plain_model(spark, order, hot):
    rows = corpus()
    docs = spark.createDataFrame(rows, SCHEMA)
    got = katz.score(docs.repartition(3), remainder("doc_id", 7) != 2, settings=katz.Settings(order=order, hot=hot, block_tokens=700)).collect()
    keep = {r["doc_id"]: r["t"] for r in docs.select("doc_id", (remainder("doc_id", 7) != 2).alias("t")).collect()}
    model = Plain([t for i, t, _ in rows if keep[i]], order)
    vocabulary = len(model.words)
    assert len(got) == len(rows)
    want = {i: t for i, t, _ in rows}
    for r in got:
        tokens = Plain.tokens(want[r["doc_id"]])
        counts = [model.grams[1].get((w,), 0) for w in tokens]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(tokens), sum(c > 0 for c in counts), model.total)
        assert r["base_score"] == pytest.approx(sum(math.log10((c + 1) / (model.total + vocabulary + 1)) for c in counts), rel=1e-9, abs=1e-9)
        assert r["score"] == pytest.approx(model.score(want[r["doc_id"]]), rel=1e-8, abs=1e-9)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_every_history_adds_up_to_one(order):
    model = Plain([t for _, t, _ in corpus(60)], order)
    events = [*model.words, "never seen"]
    histories = [()] + [h for n in model.after for h in list(model.after[n])[:40]]
    for h in histories:
        assert sum(model.p(w, h) for w in events) == pytest.approx(1, abs=1e-9)


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "a b", "x"), (2, None, "x")], SCHEMA)
    for r in katz.score(docs, F.lit(False)).collect():
        assert (r["score"], r["n_known"], r["train_tokens"]) == (0.0, 0, 0)
    assert katz.score(docs.limit(0), F.lit(True)).collect() == []


def test_arrays_survive_packing():
    for a in (np.zeros(0, np.int64), np.arange(5), np.array([1.5, -2]), np.array([3, 250], np.uint8)):
        (b,) = packed.unpack(packed.pack(a))
        assert b.dtype == a.dtype and (a == b).all()
