"""Repeated passages: planted ones are found wherever they stand, short shared lines and clean texts stay."""

import random

import numpy as np
import pyarrow as pa
import pytest

from assayspark.llm import passages
from assayspark.llm.words import Words

SCHEMA = "doc_id long, text string, node string"


def text(rng, n):
    return [f"{rng.choice('bcdfgh')}{rng.randrange(5000)}" for _ in range(n)]


def planted(seed=5):
    rng = random.Random(seed)
    shared = [text(rng, n) for n in (51, 60, 75, 120)]
    line = text(rng, 13)
    rows, want = [], {}
    for i in range(120):
        words = text(rng, rng.randrange(30, 200))
        if i % 10 < 4:
            at = rng.randrange(len(words))
            words = words[:at] + shared[i % 10] + words[at:]
            want[i] = i % 10
        elif i % 10 == 4:
            words = line + words
        rows.append((i, (" " if i % 2 else "\n").join(words).replace(" ", "  \t", i % 3), "x"))
    return rows, want, shared


def test_planted_passages_are_found(spark):
    rows, want, shared = planted()
    got = passages.find(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    texts = {i: t.split() for i, t, _ in rows}
    assert {r["doc_id"] for r in got} == {i for i in want if i >= 10}  # the first of each stays
    for r in got:
        assert r["kept_doc_id"] == want[r["doc_id"]] == min(r["kept_doc_ids"])
        assert {want[i] for i in r["kept_doc_ids"]} == {want[r["doc_id"]]}
        span = texts[r["doc_id"]][r["start"] : r["end"]]
        assert len(span) == r["n_words"] >= 20
        # a piece at an edge may reach a word or two beyond, being similar enough
        assert len(set(span) & set(shared[want[r["doc_id"]]])) >= 0.8 * len(span)


def test_near_pieces_join_one_cluster(spark):
    rng = random.Random(1)
    words = text(rng, 400)
    changed = [w if k % 100 else "other" for k, w in enumerate(words)]
    rows = [(1, " ".join(words), "x"), (2, " ".join(changed), "x")]
    got = passages.find(spark.createDataFrame(rows, SCHEMA), settings=passages.Settings(reach=40)).collect()
    exact = passages.find(spark.createDataFrame(rows, SCHEMA), settings=passages.Settings(reach=40, threshold=1.0)).collect()
    assert sum(r["n_words"] for r in got) > sum(r["n_words"] for r in exact)
    assert {r["doc_id"] for r in got} == {2}


def test_edges(spark):
    rng = random.Random(2)
    long = " ".join(text(rng, 60))
    rows = [(None, long, "x"), (7, long, "x"), (7, long, "x"), (3, None, "x"), (4, "", "x"), (5, "a b", "x"), (6, "a b", "x"), (8, "z " * 3000, "x")]
    got = passages.find(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r["doc_id"] or 0, r["n_words"], r["kept_doc_id"]) for r in got) == [(0, 60, 7), (7, 60, 7)]
    assert passages.find(spark.createDataFrame([], SCHEMA)).collect() == []


def test_pieces_are_cut_by_the_words_around(spark):
    rng = random.Random(3)
    shared, words = text(rng, 80), [Words(pa.array([" ".join(text(rng, k))])) for k in (0, 7)]
    cuts = []
    for k in (0, 7, 33):
        w = Words(pa.array([" ".join(text(rng, k) + shared + text(rng, k))]))
        cuts.append({int(c) - k for c in passages.cut(w, 5) if 5 <= c - k < 74})
    assert cuts[0] == cuts[1] == cuts[2] and len(cuts[0]) >= 3 and len(words) == 2


def test_tune_reaches_the_recall():
    for threshold, recall, most in ((0.8, 0.99, 3), (0.8, 0.99, 64), (0.5, 0.9, 64)):
        bands, rows = passages.tune(threshold, recall, most)
        assert bands * rows <= most and 1 - (1 - threshold**rows) ** bands >= recall
    assert passages.tune(0.8, 0.99, 10) == (5, 2)
    assert passages.tune(0.45, 0.97, 32) == (16, 2) == (passages.Settings.bands, passages.Settings.rows)


def test_removal_keeps_the_rest():
    assert passages.removed_from("a b  c\nd e", [(1, 3)]) == "a d e"
    assert passages.removed_from("a b", [(0, 2)]) == "" and passages.removed_from(None, []) == ""


@pytest.mark.parametrize("reach", [3, 5])
def test_pieces_tile_the_texts(reach):
    rng = random.Random(9)
    column = pa.array(["", *(" ".join(text(rng, n)) for n in (1, 2, 50, 300)), None, "x x x x x x"])
    words = Words(column)
    lengths, _, keys = passages.sketch(words, passages.cut(words, reach), passages.Settings(reach=reach))
    assert lengths.sum() == len(words.hash) and (lengths > 0).all() and keys.shape == (len(lengths), passages.Settings.bands)
    assert np.bincount(words.owner[passages.cut(words, reach)], minlength=7)[0] == 0


def test_edited_passages_are_removed_whole(spark):
    rng = random.Random(11)
    rows, shared = [], {}
    for k in range(30):
        n = 50 + k
        passage = text(rng, n)
        middle = [["other"], [], ["other", passage[n // 2]]][k % 3]  # a word changed, left out or put in
        edited = passage[: n // 2] + middle + passage[n // 2 + 1 :]
        at = 20 + k
        rows.append((k, " ".join(text(rng, at) + passage + text(rng, 40)), "x"))
        rows.append((100 + k, " ".join(text(rng, 30) + edited + text(rng, at)), "x"))
        shared[100 + k] = (30, 30 + len(edited))
    got = passages.find(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    assert all(r["kept_doc_id"] == r["doc_id"] - 100 for r in got)
    whole = [r["doc_id"] for r in got if r["start"] <= shared[r["doc_id"]][0] and r["end"] >= shared[r["doc_id"]][1]]
    assert len(whole) >= 27 and len(set(whole)) == len(whole)


def test_runs_alike():
    hashed = lambda words: Words(pa.array([" ".join(words)])).hash
    rng = random.Random(12)
    a = text(rng, 60)
    b = text(rng, 7) + a[:30] + ["other"] + a[31:] + text(rng, 9)
    assert passages.alike(hashed(b), hashed(a), 5, 0.8) == [(7, 67)]
    assert sorted(passages.alike(hashed(b), hashed(a), 5, 0.9)) == [(7, 37), (38, 67)]
    assert passages.alike(hashed(a[30:] + a[:30]), hashed(a), 5, 0.8) in ([(0, 30)], [(30, 60)])  # one order only
    assert passages.alike(hashed(a[:4]), hashed(a), 5, 0.8) == []
    assert passages.alike(hashed(["z"] * 40), hashed(["z"] * 40), 5, 0.8) == [(0, 40)]


def edited_pairs(seed, sizes):
    """A source and a copy with 1 to 4 words changed, in different surroundings, and where the copy stands."""
    rng, rows, at = random.Random(seed), [], {}
    for k, n in enumerate(sizes):
        passage = text(rng, n)
        copy = list(passage)
        for e in rng.sample(range(n), 1 + k % min(4, max(1, n // 50))):
            copy[e] = "other"
        before = rng.randrange(10, 60)
        rows.append((k, " ".join(text(rng, rng.randrange(10, 60)) + passage + text(rng, 30)), "x"))
        rows.append((1000 + k, " ".join(text(rng, before) + copy + text(rng, 30)), "x"))
        at[1000 + k] = (before, before + n)
    return rows, at


def share_found(rows, at, got):
    """Of the similar runs that a comparison of whole texts gives, how many are removed to four fifths or more."""
    hashed = {i: Words(pa.array([t])).hash for i, t, _ in rows}
    spans, found, wanted = {}, 0, 0
    for r in got:
        spans.setdefault(r["doc_id"], set()).update(range(r["start"], r["end"]))
    for i in at:
        for s, e in passages.alike(hashed[i], hashed[i - 1000], 5, 0.8):
            if e - s >= 20:
                wanted += 1
                found += len(spans.get(i, set()) & set(range(s, e))) >= 0.8 * (e - s)
    return found / wanted


def test_recall_of_edited_passages_against_all_words(spark):
    rows, at = edited_pairs(21, [50 + 5 * (k % 51) for k in range(150)])
    got = passages.find(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    assert share_found(rows, at, got) >= 0.9
    assert {r["doc_id"] for r in got} <= set(at)


def test_bands_find_the_edited_passages(spark):
    rows, at = edited_pairs(22, [50 + k % 30 for k in range(60)])
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert share_found(rows, at, passages.find(df).collect()) >= 0.9
    off = passages.find(df, settings=passages.Settings(bands=1, rows=40))  # no two different paragraphs meet
    assert share_found(rows, at, off.collect()) < 0.5


def test_rows_without_ids_are_documents_of_their_own(spark):
    rng = random.Random(23)
    shared = text(rng, 80)
    rows = [(None, " ".join(text(rng, 10 + k) + shared), "x") for k in range(40)]
    got = passages.find(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert len(got) == len({r["row"] for r in got}) == 39 and {r["kept_doc_id"] for r in got} == {None}
    assert all(75 <= r["n_words"] <= 95 for r in got)


def joined(links):
    """A function that names the component of a node."""
    into = {}

    def top(x):
        while into.setdefault(x, x) != x:
            x = into[x]
        return x

    for a, b in links:
        into[top(a)] = top(b)
    return top


@pytest.mark.parametrize("threshold", [0.8, 0.5])
def test_a_bucket_loses_no_link(spark, threshold):
    """All pairs of one bucket that a comparison links are connected, those that repeat words too."""
    rng = random.Random(31)
    settings = passages.Settings(threshold=threshold, members=8)
    line, shared = text(rng, 8), text(rng, 25)
    rows = [text(rng, 12) + [line, shared[k % 9 :], ["z"] * (4 + k % 5), ["x", "y"] * (2 + k % 4)][k % 4] + text(rng, 12) for k in range(60)]
    rows += [line[:4] + ["z"] * k + line[4:] + text(rng, 9) for k in (4, 5, 6, 7)]
    assert passages.runs_prove(settings) == (threshold == 0.8)
    data = [" ".join(r).encode() + b" " for r in rows]
    words = spark.createDataFrame([(k, bytearray(d)) for k, d in enumerate(data)], "node long, bytes binary")
    hits = spark.createDataFrame([(1, k) for k in range(len(rows))], "key long, node long")
    near = passages.run_links(hits, words, settings)
    got = {(r["a"], r["b"]) for r in near.unionByName(passages.repeat_links(hits, words, near, settings)).collect()}
    a, b = np.nonzero(~np.eye(len(rows), dtype=bool))
    runs = passages.aligned_rows(pa.array([data[i] for i in a]), pa.array([data[i] for i in b]), settings.size, threshold)
    right = np.unique(runs[runs[:, 2] - runs[:, 1] >= 10, 0])
    want = {(min(p), max(p)) for p in zip(a[right].tolist(), b[right].tolist())}
    top, true = joined(got), joined(want)
    assert len(want) > 100 and all(top(x) == top(y) for x, y in want) and all(true(x) == true(y) for x, y in got)
    alone = {r["a"] for r in near.collect()} | {r["b"] for r in near.collect()}
    assert {x for p in want for x in p} - alone  # some are found by comparison only


def test_rows_of_a_bucket_grow_with_its_paragraphs(spark):
    """Different paragraphs of one bucket meet only what a repetition calls for: 4,000 give not four times the rows of 2,000 or more."""

    def rows(n):
        placed = spark.range(n).selectExpr("1L as key", "1L as gram", "id as node", "id as component", "id % 1000 = 0 as again")
        return passages._cells(placed, passages.Settings(members=64)).count()

    few, many = rows(2000), rows(4000)
    assert 2000 <= few and many <= 2.2 * few and many < 3 * 4000
    assert rows(900) <= 3 * 900


def test_links_need_a_common_bucket(spark):
    rng = random.Random(33)
    shared = text(rng, 30)
    words = spark.createDataFrame([(k, bytearray(" ".join(shared + text(rng, 5)).encode() + b" ")) for k in range(4)], "node long, bytes binary")
    hits = spark.createDataFrame([(1, 0), (1, 2), (2, 1), (2, 3)], "key long, node long")
    assert {tuple(r) for r in passages.run_links(hits, words, passages.Settings()).collect()} == {(0, 2), (1, 3)}


def test_band_keys_meet_whole_and_packed(spark, monkeypatch):
    """Packed keys give the paragraphs that a grouping of one row a key gives, in few rows, and a common key does not crowd a shard."""
    monkeypatch.setattr(passages, "DEALT", 2000)
    rng, shards = random.Random(41), 5
    signed = lambda h: int(np.uint64(h).view(np.int64))
    some = [signed(rng.getrandbits(64)) for _ in range(40000)]
    rows, pairs = [], set()
    for k in range(6000):
        keys = [rng.choice(some), rng.choice(some), some[0]] if k % 10 else []
        rows += [(k, bytearray(np.array(keys, np.int64).tobytes()))] * (1 + k % 3)  # exact copies are one
        pairs |= {(key, k) for key in keys}
    rng.shuffle(rows)
    made = spark.createDataFrame(rows, "u long, bands0 binary").repartition(4)
    times = {}
    for key, _ in pairs:
        times[key] = times.get(key, 0) + 1
    got = {tuple(r) for r in passages.buckets(made, "bands0", shards).distinct().collect()}
    assert got == {(key, u) for key, u in pairs if times[key] > 1} and len(got) > 7000
    dealt = passages.dealt_keys(made, "bands0", shards).collect()
    assert len(dealt) <= 1000 < 3 * len(rows)
    here = [r for r in dealt if r["kind"] != passages.FOUND and some[0] in np.frombuffer(r["keys"], np.int64)]
    assert len({r["shard"] for r in here}) == 1 and len(here) <= 40
    assert passages.buckets(made.where("u < 0"), "bands0", 1).collect() == []


@pytest.mark.parametrize("reach", [1, 3, 20])
def test_cuts_are_the_least_pairs_around(reach):
    rng = random.Random(42)
    column = pa.array(["", "a", "b c", None, " ".join(rng.choice("xyz") for _ in range(200)), *(" ".join(text(rng, n)) for n in (1, 19, 20, 21, 150))])
    words = Words(column)
    h, want = passages.windows(words.hash, 2), []
    for s, e in zip(words.starts[:-1].tolist(), words.starts[1:].tolist()):
        v = h[s:e].tolist()[:-1] + [2**64 - 1]
        want += [s + i for i in range(e - s) if i == 0 or (all(v[k] > v[i] for k in range(max(0, i - reach), i)) and all(v[k] >= v[i] for k in range(i, min(e - s, i + reach + 1))))]
    assert passages.cut(words, reach).tolist() == want
    assert passages.cut(Words(pa.array([], pa.string())), reach).tolist() == []


def test_common_places_and_times():
    rng = np.random.default_rng(43)
    keys = rng.integers(0, 50, 300).astype(np.uint64)
    seen, want = {}, []
    for k in keys.tolist():
        want.append((k, seen.setdefault(k, 0)))
        seen[k] += 1
    timed = passages._timed(keys).tolist()
    assert len(set(timed)) == 300 == len(set(zip(want, timed)))
    assert dict(zip(want, timed)) == dict(zip(want, passages._timed(keys[:200]).tolist() + timed[200:]))
    a, b = rng.permutation(1000)[:400].astype(np.uint64), rng.permutation(1000)[:600].astype(np.uint64)
    i, j = passages._common(a, b)
    assert (np.diff(i) > 0).all() and (a[i] == b[j]).all() and len(i) == len(np.intersect1d(a, b))
    assert [len(x) for x in passages._common(a[:0], b)] == [0, 0] and len(passages._timed(keys[:0])) == 0


def test_a_large_component_is_split(spark):
    """The join that gives the spans of a component its first document takes a large one in several tasks."""
    made = [(1, 1, 0, 0, 0, 40, 0, 40)]
    made += [(k, k, 1, 1, 0, 40, 0, 40) for k in range(2, 6000)]  # copies of what row 1 loses: one component
    made += [(k, k, k - 1, k - 1, 0, 40, 0, 40) for k in range(10001, 12000, 2)]
    ranges = spark.createDataFrame(made, "row long, doc_id long, kept long, other_row long, start int, end int, other_start int, other_end int")
    ranges = ranges.select(passages.RANGE)
    asked = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "20", "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {k: spark.conf.get(k, None) for k in asked}
    try:
        for k, v in asked.items():
            spark.conf.set(k, v)
        found = passages.clustered(ranges, passages.Settings())
        got = {r["doc_id"]: (r["kept_doc_ids"], r["cluster_doc_id"]) for r in found.collect()}
        assert got == {k: ([0], 0) for k in range(1, 6000)} | {k: ([k - 1], k - 1) for k in range(10001, 12000, 2)}
        assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
