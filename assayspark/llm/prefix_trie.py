"""The prefix trie of rebuilt conversations, its subtree totals found by parallel tree contraction.

A conversation c starts with the first h turns of conversation c - c % 5 (h = crc32 of the decimal c, modulo 9) and goes on
with its own turns after its first h. Every distinct sequence of first turns is a node. Positions and prefix fingerprints are
running sums over bounded stretches of turns, so a conversation that holds most rows is spread over many tasks.

Subtree totals come from rounds of joins. Rake: nodes without children hand their totals to their parents and go. Compress:
of nodes with a single child an independent set is spliced out (a coin a node and round), the child carries what the node
had to its new parent. Every round removes all leaves and in the mean a quarter of every chain, so the number of rounds is
logarithmic whatever the shape. Spliced nodes are expanded at the end: each points to the child it had, those pointers are
doubled until they reach a raked node, whose total is known.

Turns are ordered by turn (null first), then role and text; null role and text are empty, repeated rows are turns of their
own. Rows without conv_id belong to no conversation and are left out. An empty table gives no rows. Other columns are ignored.
Two sequences are the same node if 128 bits of sums of their turns' hashes agree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from assayspark.session import settle

STRETCH = 4096  # turns that one task of a running sum handles together
KEY = ["depth", "s0", "s1", "s2", "s3"]  # a prefix: its number of turns and the sums of their hashes


def _running(rows: DataFrame, of: str, by: str, at: str, values: list[str]) -> DataFrame:
    """Running sums of values within `of` by `at`, of any length: stretches `by` first, then their totals."""
    stretch = Window.partitionBy(of, by)
    before = Window.partitionBy(of).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)  # a row a stretch
    totals = rows.groupBy(of, by).agg(*[F.sum(v).alias(v) for v in values])
    totals = totals.select(of, by, *[F.coalesce(F.sum(v).over(before), F.lit(0).cast("long")).alias(f"_{v}") for v in values])
    inside = stretch.orderBy(at).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.select("*", *[F.sum(v).over(inside).alias(f"_in_{v}") for v in values]).join(totals, [of, by])


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, at (from 1), u, v (128 bits of role and text), size (bytes of the text)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text"))
    ordered = rows.orderBy("conv_id", F.col("turn").asc_nulls_first(), "role", "text")
    digest = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"), 256)
    rows = ordered.select("conv_id", digest.alias("digest"), F.octet_length("text").cast("long").alias("size"), F.monotonically_increasing_id().alias("place"))
    rows = rows.withColumns({"u": F.xxhash64(F.lit(1), "digest"), "v": F.xxhash64(F.lit(2), "digest")}).drop("digest")
    rows = settle(rows, "trie-turns").withColumns({"task": F.shiftright("place", 33), "one": F.lit(1).cast("long")})
    return _running(rows, "conv_id", "task", "place", ["one"]).select("conv_id", (F.col("_one") + F.col("_in_one")).alias("at"), "u", "v", "size")


def shared_turns(conv_id: str | Column) -> Column:
    c = F.col(conv_id) if isinstance(conv_id, str) else conv_id
    return F.crc32(c.cast("string").cast("binary")) % 9


def rebuilt(own: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The turns of the rebuilt conversations (conv_id, depth, u, v, size), and (conv_id, n_turns) of all, turnless ones too."""
    base = (F.col("conv_id") - F.col("conv_id") % 5).alias("base")
    convs = own.groupBy("conv_id").agg(F.max("at").alias("n_own"))
    lengths = convs.select(F.col("conv_id").alias("base"), F.col("n_own").alias("n_base"))
    convs = convs.select("*", base, shared_turns("conv_id").alias("h")).join(lengths, "base", "left")
    taken = F.least("h", F.coalesce("n_base", F.lit(0).cast("long")))
    convs = settle(convs.select("conv_id", "base", "h", "n_own", taken.alias("taken")), "trie-convs")
    first = own.where("at <= 8").select(F.col("conv_id").alias("base"), "at", "u", "v", "size")
    first = first.join(convs.where("taken > 0"), "base").where("at <= taken").select("conv_id", F.col("at").alias("depth"), "u", "v", "size")
    # what a conversation's own turns move by is joined once a stretch, not once a turn: no conversation is one join group
    rest = own.withColumns({"stretch": F.floor(F.col("at") / STRETCH), "h": shared_turns("conv_id")}).where("at > h").drop("h")
    moved = convs.select("conv_id", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("n_own") / STRETCH))).alias("stretch"), (F.col("taken") - F.col("h")).alias("by"))
    rest = rest.join(moved, ["conv_id", "stretch"]).select("conv_id", (F.col("at") + F.col("by")).alias("depth"), "u", "v", "size")
    n_turns = F.col("taken") + F.greatest(F.col("n_own") - F.col("h"), F.lit(0).cast("long"))
    return first.unionByName(rest), convs.select("conv_id", n_turns.alias("n_turns"))


def prefixes(rows: DataFrame) -> DataFrame:
    """Each turn with the key of the prefix that it ends and, as p_..., of the prefix before it."""
    low = F.lit(0xFFFFFFFF).cast("long")
    h = [F.xxhash64(F.lit(seed), "u", "v", "depth") for seed in (3, 4)]
    parts = [f(x) for x in h for f in (lambda x: x.bitwiseAND(low), lambda x: F.shiftrightunsigned(x, 32))]
    rows = rows.select("conv_id", "depth", "size", F.floor(F.col("depth") / STRETCH).alias("stretch"), *[p.alias(f"s{i}") for i, p in enumerate(parts)])
    rows = settle(_running(rows, "conv_id", "stretch", "depth", KEY[1:]), "trie-prefixes")
    upto = {s: F.col(f"_{s}") + F.col(f"_in_{s}") for s in KEY[1:]}
    before = [(upto[s] - F.col(s)).alias(f"p_{s}") for s in KEY[1:]]
    return rows.select("conv_id", "size", "depth", *[x.alias(s) for s, x in upto.items()], (F.col("depth") - 1).alias("p_depth"), *before)


def ends(rows: DataFrame, lengths: DataFrame) -> DataFrame:
    """Key of a node and the digest of the ids that end there. Ids are joined in pieces by range, so a node where very many
    conversations end is spread over tasks; a task then only streams its pieces through one hash."""
    last = lengths.where("n_turns > 0").select("conv_id", F.col("n_turns").alias("depth"))
    found = rows.select("conv_id", *KEY).join(last, ["conv_id", "depth"]).select(*KEY, "conv_id")
    found = found.unionByName(lengths.where("n_turns = 0").select(*[F.lit(0).cast("long").alias(k) for k in KEY], "conv_id"))
    schema = pa.schema([*[(k, pa.int64()) for k in KEY], ("first", pa.int64()), ("ids", pa.string())])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = list(zip(*[batch.column(k).to_pylist() for k in KEY]))
            ids = batch.column("conv_id").to_pylist()
            cuts = [i for i in range(len(ids)) if i == 0 or keys[i] != keys[i - 1]] + [len(ids)]
            out = [(*keys[a], ids[a], ",".join(map(str, ids[a:b]))) for a, b in zip(cuts[:-1], cuts[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out) if out else [[]] * 7, schema)], schema=schema)

    pieces = settle(found, "trie-ends").repartitionByRange(*KEY, "conv_id").sortWithinPartitions(*KEY, "conv_id")
    pieces = pieces.mapInArrow(join, ", ".join(f"{k} long" for k in KEY) + ", first long, ids string")
    made = pa.schema([*[(k, pa.int64()) for k in KEY], ("ends_sha256", pa.string())])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            done = []
            for *own, ids in zip(*[batch.column(k).to_pylist() for k in [*KEY, "ids"]]):
                if own != key:
                    if key is not None:
                        done.append((*key, state.hexdigest()))
                    key, state = own, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*done), made)], schema=made)
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip([*key, state.hexdigest()], made)], schema=made)

    pieces = pieces.repartition(*KEY).sortWithinPartitions(*KEY, "first")
    return pieces.mapInArrow(digest, ", ".join(f"{k} long" for k in KEY) + ", ends_sha256 string")


def subtree_totals(tree: DataFrame, values: list[str], node: str = "node", parent: str = "parent") -> DataFrame:
    """node and, for each value, its sum over the node's subtree. `tree` has a row a node; roots have a null parent.

    An empty tree gives no rows. Nodes must be distinct, parents must be nodes, and there must be no circle.
    """
    zero = F.lit(0).cast("long")
    kids = tree.where(F.col(parent).isNotNull()).groupBy(F.col(parent).alias("node")).agg(F.count("*").alias("left"))
    live = tree.select(F.col(node).alias("node"), F.col(parent).alias("parent"), *[F.col(v).cast("long").alias(v) for v in values], *[zero.alias(f"c_{v}") for v in values])
    live = settle(live.join(kids, "node", "left").withColumns({"left": F.coalesce("left", zero), "dice": F.xxhash64("node")}), "contract-0")
    raked, spliced, turn = [], [], 0
    while not live.isEmpty():
        turn += 1
        raked.append(live.where("left = 0").select("node", *values))
        # rake: what leaves hand up; what is left below each parent then
        leaf = F.col("left") == 0
        given = [F.sum(F.when(leaf, F.col(v) + F.col(f"c_{v}")).otherwise(zero)).alias(f"g_{v}") for v in values]
        below = live.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(
            *given, F.count(F.when(~leaf, 1)).alias("left"), F.max(F.when(~leaf, F.col("node"))).alias("only")
        )
        coin = F.col("dice") % 2 == 0  # thrown anew each round, by rows and not by a literal: rounds then share their compiled plans
        rest = live.where("left > 0").drop("left").join(below, "node")
        rest = rest.select("node", "parent", *[(F.col(v) + F.col(f"g_{v}")).alias(v) for v in values], *[f"c_{v}" for v in values], "left", "dice", "only", ((F.col("left") == 1) & F.col("parent").isNotNull() & coin).alias("heads"))
        rest = settle(rest, f"rake-{turn}")
        # compress: a node with one child goes if its coin says so and its parent's doesn't
        above = rest.where("heads").select(F.col("node").alias("parent"), F.lit(True).alias("held"))
        go = rest.where("heads").join(above, "parent", "left").where("held is null")
        go = settle(go.select(F.col("only").alias("node"), F.col("node").alias("gone"), F.col("parent").alias("up"), *[F.col(v).alias(f"a_{v}") for v in values], *[(F.col(f"c_{v}") + F.col(v)).alias(f"add_{v}") for v in values]), f"splice-{turn}")
        rest = rest.join(go.select(F.col("gone").alias("node")), "node", "left_anti").join(go, "node", "left")
        held = F.col("up").isNotNull()
        spliced.append(rest.where(held).select(F.col("gone").alias("node"), F.col("node").alias("to"), *[(F.col(f"a_{v}") + F.col(f"c_{v}")).alias(v) for v in values]))
        live = settle(rest.select("node", F.coalesce("up", "parent").alias("parent"), *values, *[(F.col(f"c_{v}") + F.coalesce(f"add_{v}", zero)).alias(f"c_{v}") for v in values], "left", F.xxhash64("dice").alias("dice")), f"contract-{turn}")
    if not raked:
        return tree.select(F.col(node).alias("node"), *[F.col(v).cast("long").alias(v) for v in values])
    totals, jumps = raked[0], spliced[0]
    for more in raked[1:]:
        totals = totals.unionByName(more)
    for more in spliced[1:]:
        jumps = jumps.unionByName(more)
    # expand: a spliced node's total is its own sum and the total of the child it had, which went in a later round;
    # doubling a pointer halves the rounds that are left between the two
    jumps = settle(jumps, "expand")
    for _ in range(max(turn - 1, 0).bit_length()):
        ahead = jumps.select(F.col("node").alias("to"), F.col("to").alias("next"), *[F.col(v).alias(f"n_{v}") for v in values])
        jumps = jumps.join(ahead, "to", "left").select("node", F.coalesce("next", "to").alias("to"), *[(F.col(v) + F.coalesce(f"n_{v}", zero)).alias(v) for v in values])
        jumps = settle(jumps, "expand")
    ended = totals.select(F.col("node").alias("to"), *[F.col(v).alias(f"n_{v}") for v in values])
    grown = jumps.join(ended, "to").select("node", *[(F.col(v) + F.col(f"n_{v}")).alias(v) for v in values])
    return totals.unionByName(grown)


def trie(conversations: DataFrame) -> DataFrame:
    """A row a node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    rows, lengths = rebuilt(turns(conversations))
    lengths = settle(lengths, "trie-lengths")
    rows = prefixes(rows)
    zero = F.lit(0).cast("long")
    nodes = rows.groupBy(*KEY).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min("size").alias("size"), *[F.min(f"p_{k}").alias(f"p_{k}") for k in KEY])
    root = lengths.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    root = root.select(*[F.lit(0).cast("long").alias(k) for k in KEY], "conv_id", "n_convs", zero.alias("size"), *[F.lit(None).cast("long").alias(f"p_{k}") for k in KEY])
    nodes = settle(nodes.unionByName(root).withColumn("node", F.monotonically_increasing_id()), "trie-nodes")
    up = nodes.select(*[F.col(k).alias(f"p_{k}") for k in KEY], F.col("conv_id").alias("parent_conv_id"), F.col("node").alias("parent"))
    nodes = nodes.join(up, [f"p_{k}" for k in KEY], "left").drop(*[f"p_{k}" for k in KEY])
    kids = nodes.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    nodes = settle(nodes.join(kids, "node", "left").withColumn("n_children", F.coalesce("n_children", zero)), "trie-nodes")
    own = nodes.select("node", "parent", (F.col("n_children") == 0).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("size")).alias("saved_tokens"))
    totals = subtree_totals(own, ["n_leaves", "saved_tokens"])
    found = nodes.join(totals, "node").join(ends(rows, lengths), KEY, "left")
    empty = F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256")
    return found.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", empty)
