"""The prefix trie against a plain build, and subtree totals against recursion on trees of many shapes."""

import hashlib
import random
import zlib

import pytest

from assayspark.llm import prefix_trie


def plain(rows):
    """rows: (conv_id, turn, role, text) -> a tuple a node."""
    own = {}
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for r in sorted((r for r in rows if r[0] is not None), key=key):
        own.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    made = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        made[c] = own.get(c - c % 5, [])[:h] + own[c][h:]
    members, ended = {}, {}
    for c, path in made.items():
        for d in range(len(path) + 1):
            members.setdefault(tuple(path[:d]), []).append(c)
        ended.setdefault(tuple(path), []).append(c)
    kids = {}
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    totals = {}
    for p in sorted(members, key=len, reverse=True):
        below = [totals[k] for k in kids.get(p, [])]
        saved = (len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0
        totals[p] = (sum(b[0] for b in below) or 1, saved + sum(b[1] for b in below))
    return sorted(
        (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids.get(p, [])), *totals[p],
         hashlib.sha256(",".join(map(str, sorted(ended.get(p, [])))).encode()).hexdigest())
        for p, m in members.items()
    )


def found(spark, rows, extra=True):
    schema = "conv_id long, turn long, role string, text string" + (", depth int, node string, parent int, s0 string" if extra else "")
    df = spark.createDataFrame([(*r, *([7, "x", 1, "y"] if extra else [])) for r in rows], schema)
    made = prefix_trie.trie(df.repartition(3))
    assert made.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(map(tuple, made.collect()), key=lambda r: (r[0], r[1]))


def test_nulls_ties_repeats_and_clashing_columns(spark):
    pick = random.Random(3)
    rows = []
    for c in [*range(0, 40), 1000, 1001]:
        if c % 10 == 5:
            continue  # a missing base: its followers may be left without turns
        for t in range(pick.randint(1, 12)):
            rows.append((c, None if t == 0 and c % 7 == 0 else t, pick.choice(["user", None, ""]), pick.choice(["a", "", None, "é" * 3, "long " * 500])))
    rows += rows[:9]  # repeated rows are turns of their own
    rows += [(None, 1, "user", "nobody"), (3, 2, "user", "tie"), (3, 2, "assistant", "tie"), (3, 2, "user", "tia")]
    assert found(spark, rows) == plain(rows)


def test_a_conversation_with_most_rows(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "STRETCH", 16)
    rows = [(10, t, "user", f"turn {t}") for t in range(120)] + [(c, t, "user", f"turn {t}") for c in range(11, 60) for t in range(9)]
    assert found(spark, rows, extra=False) == plain(rows)


def test_no_conversations(spark):
    assert found(spark, []) == []
    assert found(spark, [(None, 1, "user", "x")]) == []


@pytest.mark.parametrize("shape", ["path", "star", "broom", "random", "two roots"])
def test_subtree_totals(spark, shape):
    n, pick = 90, random.Random(shape)
    up = {
        "path": lambda i: i - 1,
        "star": lambda i: 0,
        "broom": lambda i: i - 1 if i < 45 else 44,
        "random": lambda i: pick.randrange(max(0, i - 20), i),
        "two roots": lambda i: None if i == 45 else i - 1,
    }[shape]
    parent = {0: None} | {i: up(i) for i in range(1, n)}
    worth = {i: pick.randrange(100) for i in range(n)}
    want = dict(worth)
    for i in range(n - 1, 0, -1):
        if parent[i] is not None:
            want[parent[i]] += want[i]
    tree = spark.createDataFrame([(i * 7, None if p is None else p * 7, worth[i]) for i, p in parent.items()], "node long, parent long, w long")
    got = {r["node"] // 7: r["w"] for r in prefix_trie.subtree_totals(tree, ["w"]).collect()}
    assert got == want
