"""Quality rules against plain Python: the base statistics, the ratio over unhashed n-grams, the edge cases."""

import math
import random
import re
from collections import Counter

import pytest

from assayspark.llm import quality_rules

SCHEMA = "doc_id long, text string, quality string"  # a column named like the operator's own


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines, seen, dup = (text or "").split("\n"), set(), 0
    for x in lines:
        if re.search(r"[^\x20\x09-\x0D]", x):
            dup += x in seen
            seen.add(x)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered))


def grams(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return [(w,) for w in words] + list(zip(words, words[1:]))


def rows(seed=1):
    rng = random.Random(seed)
    made = [" ".join(rng.choice(["ab", "é#", "c|d", "Zz", "日本", "x" * 9]) + str(rng.randrange(4)) for _ in range(rng.randrange(120))) for _ in range(30)]
    made += ["a b c\n a b c\na b c\n\n\n\n", "", None, "x " * 5000, "\x0b\x0c \t", "one", "a\r\na\r\nb", "w " * 49 + "w", " ".join(f"w{i}" for i in range(50))]
    return [(i, t, "x") for i, t in enumerate(made)] + [(3, made[3], "x"), (None, made[4], None)]


def test_statistics_and_ratio(spark):
    data = rows()
    docs = spark.createDataFrame(data, SCHEMA).repartition(3)
    trusted = spark.createDataFrame([(i,) for i in range(0, 40, 3)], "doc_id long")
    buckets = 1 << 22
    ratio = quality_rules.fit_ratio(docs, trusted, buckets=buckets)
    raw, target = Counter(), Counter()
    for i, t, _ in data:
        raw.update(grams(t))
        if i is not None and i < 40 and i % 3 == 0:
            target.update(grams(t))
    n_raw, n_target = sum(raw.values()) + buckets, sum(target.values()) + buckets
    got = quality_rules.measure(docs, ratio, into="m").select("doc_id", "text", "m.*").collect()
    assert len(got) == len(data)
    for r in got:
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == plain(r["text"])
        own = grams(r["text"])
        want = sum(math.log((target[g] + 1) / n_target) - math.log((raw[g] + 1) / n_raw) for g in own) / max(len(own), 1)
        assert r["ratio"] == pytest.approx(want, abs=1e-6)
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert r["kept"] == (not r["base_failed"] and r["ratio"] >= ratio.threshold)


def test_filter_keeps_columns_and_all_passing_rows(spark):
    data = rows()
    docs = spark.createDataFrame(data, SCHEMA)
    nothing = quality_rules.fit_ratio(docs, docs.select("doc_id").limit(0), buckets=64)
    kept = quality_rules.keep_good(docs, nothing)
    assert kept.columns == docs.columns
    want = [r for r in data if plain(r[1])[0] >= 50 and 100 * plain(r[1])[4] <= 50 * plain(r[1])[0]]
    key = lambda r: (str(r[0]), r[1])
    assert sorted(map(tuple, kept.collect()), key=key) == sorted(want, key=key)
    assert quality_rules.keep_good(docs.limit(0), nothing).collect() == []


def test_slices_change_nothing():
    import pyarrow as pa

    from assayspark.llm.words import Words, slices

    texts = pa.array([t for _, t, _ in rows()])
    whole = Words(texts)
    parts = [Words(texts[s:e]) for s, e in slices(texts, 300)]
    assert [h for p in parts for h in p.hash.tolist()] == whole.hash.tolist()
    assert [n for p in parts for n in p.lengths().tolist()] == [plain(t)[0] for t in texts.to_pylist()]
    assert (Words(pa.array(["ABC é"]), lower=True).hash == Words(pa.array(["abc é"])).hash).all()


def test_every_trusted_document_counts(spark):
    n = 20_500
    docs = spark.range(n).selectExpr("id as doc_id", "concat('w', id % 2) as text")
    ratio = quality_rules.fit_ratio(docs, docs.select("doc_id").unionByName(docs.select("doc_id").limit(9)))
    assert ratio.weights == pytest.approx(0, abs=1e-12)  # all are trusted, so the target is the raw corpus
