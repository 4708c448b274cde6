"""Spelling variants against a plain build over all pairs, and the search scheme against edit distances of random words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from assayspark.llm import spelling


def near(a, b):
    """Exactly one inserted, deleted or replaced letter."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def plain(docs):
    n = Counter()
    for doc_id, text in docs:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            n[run] += 1
    n = {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}
    close = {w: [v for v in n if near(w, v)] for w in n}
    form = {}
    for w, others in close.items():
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 10 * n[w] else None
    def root(w):
        while form[w]:
            w = form[w]
        return w
    return sorted((w, form[w], root(w), n[w], len(close[w]), n[form[w]] if form[w] else None) for w in n)


def found(spark, docs, **more):
    df = spark.createDataFrame([(d, t, "x", 3, "y") for d, t in docs], "doc_id long, text string, word string, n int, side string").repartition(4)
    made = spelling.variants(df, **more)
    assert made.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(map(tuple, made.collect()))


def corpus(seed):
    pick = random.Random(seed)
    stems = ["interesting", "interlinked", "internal", "Étrangère", "ÉCOLESÿx", "aaaaaaaa", "abababab", "x" * 300, "inter×nes", "sevenon", "eightone"]
    docs = []
    for d in range(120):
        words = []
        for _ in range(60):
            w = pick.choice(stems)
            if pick.random() < 0.4:
                at = pick.randrange(len(w))
                w = pick.choice([w[:at] + w[at + 1 :], w[:at] + pick.choice("aexé") + w[at:], w[:at] + pick.choice("aexÉ") + w[at + 1 :]])
            words.append(w.upper() if pick.random() < 0.1 else w)
        docs.append((d, pick.choice([" ", "\n", "1", "-"]).join(words)))
    return docs + docs[:20] + [(None, "interesting internal interesting"), (500, None), (501, ""), (502, "short 12 中文")]


@pytest.mark.parametrize("part", [20_000, 25])
def test_equals_all_pairs(spark, part):
    """With parts of 25 words, shards are cut and every question goes to several parts."""
    docs = corpus(part)
    got, want = found(spark, docs, part=part), plain(docs)
    assert got == want
    assert any(r[1] for r in got) and any(r[1] and r[2] != r[1] for r in got) and len(got) > 200


def test_words_that_share_a_beginning_or_nothing(spark):
    pick = random.Random(4)
    words = sorted({"common" + "".join(pick.choice("ab") for _ in range(8)) for _ in range(300)})
    docs = [(i, " ".join(words)) for i in range(3)]
    assert found(spark, docs, part=40) == plain(docs)


def test_empty_tables(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, "only words that differ greatly"), (2, None)]) == []


def test_counting_hands_on_what_it_holds(spark, monkeypatch):
    monkeypatch.setattr(spelling, "KEPT", 2)
    docs = corpus(9)[:10]
    df = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    got = {r["word"]: r["n"] for r in spelling.counts(df).collect()}
    assert {w: k for w, k in got.items() if k >= 2} == {r[0]: r[3] for r in plain(docs)}


@pytest.mark.parametrize("letters", ["ab", "abcdefghéÿ"])
def test_index_finds_every_pair_once(letters):
    pick = random.Random(letters)
    words = sorted({"".join(pick.choice(letters) for _ in range(pick.randint(1, 9))) for _ in range(400)})
    raw = [w.encode("latin-1") for w in words]
    index = spelling.Index(raw)
    asks = raw + [w + b"z" for w in raw[:50]]
    halves = np.array([len(w) // 2 for w in asks])
    got = sorted(zip(*(x.tolist() for x in index.near(asks, halves))))
    want = sorted((i, j) for i, a in enumerate(asks) for j, b in enumerate(raw) if near(a, b) and a[: halves[i]] == b[: halves[i]])
    assert got == want and len(got) > 50


def test_suffix_order_is_that_of_rotations():
    text = np.array([0, 1, 1, 2, 0, 1, 1, 1, 0, 2] * 3 + [2])
    rotations = [tuple(np.roll(text, -i)) for i in range(len(text))]
    assert [rotations[i] for i in spelling.suffix_order(text, 3)] == sorted(rotations)
