"""Near-duplicate documents by ProbMinHash over weighted word shingles, banding and exact verification.

A text's weighted set holds its windows of five lower-case words and how often each occurs (a shorter text is one
window). Every shingle starts a Poisson process whose rate is its weight; arrivals fall into slots at random, each slot
keeps its first arrival, and a process ends once it lies behind all slots. Two texts agree in a slot with the
probability Jaccard similarity of their sets. Bands of slots propose pairs; the exact probability Jaccard decides.

Texts of the same words are one node from the start. In a bucket every node is compared with the most central node;
then nodes outside the bucket's largest component are compared with those of other components, in bounded blocks inside
tasks: pairs are looked at there and only links come out. Pairs inside one component need no proof, so a large group of
copies costs one comparison each. Classes are the connected components of the proven links.

Null and empty texts (no words) are in classes of their own. The class id is the smallest doc_id of the class (null ids
come last); of rows that repeat an id and its words, one is kept. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from assayspark.llm.components import components
from assayspark.llm.words import Words, mix, shingles, slices
from assayspark.session import settle


@dataclass(frozen=True)
class Settings:
    """Bands x rows slots; at similarity 0.8 a pair is proposed with probability 1 - (1 - 0.8^rows)^bands = 0.996."""

    size: int = 5
    threshold: float = 0.8
    bands: int = 24
    rows: int = 7
    members: int = 256  # texts that a side of one comparison holds, about
    sets: bool = False  # compare plain sets: every shingle weighs 1 however often it occurs


def text_keys(words: Words) -> np.ndarray:
    """A 128-bit fingerprint of each text's sequence of words, as (texts, 2) numbers."""
    place = np.arange(len(words.hash)) - np.repeat(words.starts[:-1], words.lengths())
    out = np.zeros((len(words), 2), np.uint64)
    for k in range(2):
        with np.errstate(over="ignore"):
            run = np.zeros(len(words.hash) + 1, np.uint64)
            np.cumsum(mix(words.hash + mix(place, 21 + k), 31 + k), out=run[1:])
            out[:, k] = mix(run[words.starts[1:]] - run[words.starts[:-1]] + words.lengths().astype(np.uint64))
    return out


def weighted(words: Words, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingle, text and weight of every distinct shingle of every text, by text and shingle."""
    hashes, owner = shingles(words, size)
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    return hashes[at], owner[at], np.diff(np.append(at, len(hashes))).astype(float)


def signatures(hashes: np.ndarray, owner: np.ndarray, weights: np.ndarray, texts: int, slots: int) -> np.ndarray:
    """The shingle that comes first in each slot, (texts, slots); 0 for texts without shingles."""
    first = np.full(texts * slots, np.inf)
    winner = np.zeros(texts * slots, np.uint64)
    latest = np.full(texts, np.inf)  # the last of a text's first arrivals: later ones change nothing
    time = np.zeros(len(hashes))
    turn = 0
    while len(hashes):
        u = mix(hashes, 1000 + 2 * turn)
        time = time - np.log(((u >> np.uint64(11)).astype(float) + 0.5) / (1 << 53)) / weights
        live = time < latest[owner]
        hashes, owner, weights, time = hashes[live], owner[live], weights[live], time[live]
        slot = (mix(hashes, 1001 + 2 * turn) % np.uint64(slots)).astype(np.int64)
        at = owner * slots + slot
        np.minimum.at(first, at, time)
        won = first[at] == time
        winner[at[won]] = hashes[won]
        if turn < 8 or turn % 8 == 0:
            still = np.unique(owner)
            latest[still] = first.reshape(texts, slots)[still].max(axis=1)
        turn += 1
    return winner.reshape(texts, slots)


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per text and band."""
    out = np.zeros((len(signature), bands), np.uint64)
    with np.errstate(over="ignore"):
        for b in range(bands):
            total = np.full(len(signature), b, np.uint64)
            for r in range(rows):
                total = mix(total * np.uint64(0x9E3779B97F4A7C15) + signature[:, b * rows + r])
            out[:, b] = total
    return out


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """The probability Jaccard similarity of two weighted sets, each sorted hashes and their weights."""
    both = np.union1d(a[0], b[0])
    if not len(a[0]) or not len(b[0]):
        return 0.0
    wa, wb = np.zeros(len(both)), np.zeros(len(both))
    wa[np.searchsorted(both, a[0])] = a[1]
    wb[np.searchsorted(both, b[0])] = b[1]
    with np.errstate(divide="ignore"):
        ratio = np.where(wb > 0, wa / np.where(wb > 0, wb, 1), np.inf)
    order = np.argsort(ratio, kind="stable")
    sorted_ratio = ratio[order]
    below = np.concatenate([[0], np.cumsum(wb[order])])  # b's weight among the k smallest ratios
    above = np.concatenate([np.cumsum(wa[order][::-1])[::-1], [0]])  # a's weight beyond them
    common = (wa > 0) & (wb > 0)
    r = ratio[common]
    k = np.searchsorted(sorted_ratio, r, "right")
    return float(np.sum(wa[common] / (above[k] + r * below[k])))


_SKETCH = StructType([StructField("key", BinaryType()), StructField("n_words", LongType()), StructField("bands", ArrayType(LongType()))])


def _sketch(settings: Settings):
    slots = settings.bands * settings.rows

    @F.arrow_udf(_SKETCH)
    def sketch(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            parts = []
            for s, e in slices(column):
                words = Words(column[s:e], lower=True)
                bands = band_keys(signatures(*weighted(words, settings.size), e - s, slots), settings.bands, settings.rows)
                offsets = pa.array(np.arange(e - s + 1) * settings.bands, pa.int32())
                parts.append(
                    pa.StructArray.from_arrays(
                        [
                            pa.array([k.tobytes() for k in text_keys(words)], pa.binary()),
                            pa.array(words.lengths()),
                            pa.ListArray.from_arrays(offsets, pa.array(bands.ravel().view(np.int64))),
                        ],
                        ["key", "n_words", "bands"],
                    )
                )
            yield pa.concat_arrays(parts) if parts else pa.array([], pa.struct([("key", pa.binary()), ("n_words", pa.int64()), ("bands", pa.list_(pa.int64()))]))

    return sketch


@F.arrow_udf(BinaryType())
def words_key(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The fingerprint of a text's lower-case words."""
    for column in batches:
        keys = [k.tobytes() for s, e in slices(column) for k in text_keys(Words(column[s:e], lower=True))]
        yield pa.array(keys, pa.binary())


DENSE = 1 << 22  # entries that the tables of shared shingles of a block may have


def _shared(left: list[tuple], right: list[tuple]) -> np.ndarray | None:
    """Numbers of common hashes of all pairs as one product of 0/1 tables, or None where those would be too large."""
    hashes = np.concatenate([h for h, _ in [*left, *right]])
    known, column = np.unique(hashes, return_inverse=True)
    if len(known) * max(len(left), len(right)) > DENSE or len(left) * len(right) < 64:
        return None
    row = np.repeat(np.arange(len(left) + len(right)), [len(h) for h, _ in [*left, *right]])
    table = np.zeros((len(left) + len(right), len(known)), np.float32)
    table[row, column] = 1
    return table[: len(left)] @ table[len(left) :].T


def alike(left: list[tuple], right: list[tuple], allowed: np.ndarray, threshold: float) -> Iterator[tuple[int, int]]:
    """The allowed pairs of sets that are similar enough, by position.

    Sets without repeats have the plain Jaccard similarity, from the number of common hashes. For others the sum of the
    smaller shares bounds the similarity from above; only what it leaves needs the full formula.
    """
    if not left or not right or not allowed.any():
        return
    hashes = np.concatenate([h for h, _ in right])
    weights = np.concatenate([w for _, w in right])
    sizes = np.array([len(h) for h, _ in right])
    plain = np.array([len(h) == w.sum() for h, w in right])
    simple = np.array([len(h) == w.sum() for h, w in left])[:, None] & plain[None, :]
    own_sizes = np.array([len(h) for h, _ in left])
    least = threshold - 1e-12
    both = _shared(left, right)
    if both is not None:
        near = allowed & simple & (both > 0) & (both >= least * (own_sizes[:, None] + sizes[None, :] - both))
        yield from zip(*map(np.ndarray.tolist, np.nonzero(near)))
        allowed = allowed & ~simple & (both > 0)
    totals = np.array([max(w.sum(), 1.0) for _, w in right])
    owner = np.repeat(np.arange(len(right)), sizes)
    share = weights / totals[owner]
    for i in np.flatnonzero(allowed.any(axis=1)):
        own, weight = left[i]
        if not len(own):
            continue
        at = np.minimum(np.searchsorted(own, hashes), len(own) - 1)
        hit = own[at] == hashes
        common = np.bincount(owner[hit], minlength=len(right))
        bound = np.bincount(owner[hit], np.minimum(share[hit], weight[at[hit]] / weight.sum()), len(right))
        near = common >= least * (sizes + len(own) - common)
        for j in np.flatnonzero(allowed[i] & (bound >= threshold - 1e-9)):
            if near[j] if simple[i, j] else similarity(left[i], right[j]) >= least:
                yield int(i), int(j)


def _cell_links(cell: pa.Table, sets: list[tuple], settings: Settings) -> Iterator[tuple[int, int]]:
    """The links of one cell, whose rows have these sets."""
    side, nodes, component = (cell.column(c).to_numpy() for c in ("side", "node", "component"))
    a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    allowed = component[a][:, None] != component[b][None, :]
    band = cell.column("band")[0].as_py()
    if band > 0:
        bands = np.array(cell.column("bands").to_pylist(), np.int64)
        for earlier in range(band):
            allowed &= bands[a, earlier][:, None] != bands[b, earlier][None, :]
    for i, j in alike([sets[i] for i in a], [sets[i] for i in b], allowed, settings.threshold):
        yield nodes[a[i]], nodes[b[j]]


def verified(cells: DataFrame, texts: DataFrame, settings: Settings) -> DataFrame:
    """The links (a, b) between the two sides of each cell. cells: cell, band, side, node, component; texts: node, text, bands.

    Nodes of different components are compared if they share the cell's band and no earlier one, so a pair that meets in
    several buckets is compared once; in cells with band -1 all are. Cells come to a task one after the other; a task
    holds whole cells of a few megabytes at a time.
    """
    rows = cells.join(texts, "node").repartition("cell").sortWithinPartitions("cell")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            names = held.column("cell").to_pylist()
            whole = names.index(names[-1])  # the last cell may go on in the next batch
            if whole:
                yield from found(held.slice(0, whole))
                held = held.slice(whole)
        if held is not None:
            yield from found(held)

    def found(table: pa.Table) -> Iterator[pa.RecordBatch]:
        names = table.column("cell").to_pylist()
        begins = [0, *(i for i in range(1, len(names)) if names[i] != names[i - 1]), len(names)]
        column = table.column("text").combine_chunks()
        column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
        size, at = np.cumsum([0, *column.fill_null("").to_pandas().str.len()]), 0
        links: list[tuple[int, int]] = []
        while at < len(begins) - 1:
            to = at + 1
            while to < len(begins) - 1 and size[begins[to + 1]] - size[begins[at]] <= 2 << 20:
                to += 1
            first, last = begins[at], begins[to]
            hashes, owner, weights = weighted(Words(column[first:last], lower=True), settings.size)
            cut = np.searchsorted(owner, np.arange(last - first + 1))
            weights = np.ones(len(weights)) if settings.sets else weights
            sets = [(hashes[i:j], weights[i:j]) for i, j in zip(cut[:-1], cut[1:])]
            for k in range(at, to):
                i, j = begins[k], begins[k + 1]
                links += _cell_links(table.slice(i, j - i), sets[i - first : j - first], settings)
            at = to
        if links:
            yield pa.RecordBatch.from_pydict({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([x for _, x in links], pa.int64())})

    return rows.mapInArrow(compare, "a long, b long")


def _star_cells(stars: DataFrame, settings: Settings) -> DataFrame:
    """Pairs (a, b) as cells of one a and about `members` of its partners: a travels once a cell instead of once a pair."""
    many = stars.groupBy("a").agg(F.count("*").alias("n"))
    part = F.pmod(F.xxhash64("b"), F.ceil(F.col("n") / settings.members))
    dealt = stars.join(many, "a").select("a", "b", part.alias("part"))
    cell, band = F.concat_ws(":", "a", "part").alias("cell"), F.lit(-1).alias("band")
    centres = dealt.select("a", "part").distinct().select(cell, band, F.lit(0).alias("side"), F.col("a").alias("node"))
    partners = dealt.select(cell, band, F.lit(1).alias("side"), F.col("b").alias("node"))
    return centres.unionByName(partners).withColumn("component", F.col("node"))


def _bucket_cells(placed: DataFrame, settings: Settings) -> DataFrame:
    """Buckets of several components as cells: blocks of the nodes outside the largest one against blocks of all nodes.

    placed: bucket, band, node, component. A block holds about `members` nodes, so a cell stays bounded.
    """
    sizes = placed.groupBy("bucket", "component").agg(F.count("*").alias("n"))
    main = sizes.groupBy("bucket").agg(F.max(F.struct("n", "component")).alias("m"), F.sum("n").alias("all"), F.count("*").alias("parts"))
    main = main.where("parts > 1").select("bucket", F.col("m.component").alias("main"), "all", (F.col("all") - F.col("m.n")).alias("outside"))
    rows = placed.join(main, "bucket")
    blocks_a, blocks_b = F.ceil(F.col("outside") / settings.members), F.ceil(F.col("all") / settings.members)
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    left = rows.where("component <> main").withColumn("i", F.pmod(F.xxhash64("node"), blocks_a)).withColumn("j", every(blocks_b))
    right = rows.withColumn("j", F.pmod(F.xxhash64("node"), blocks_b)).withColumn("i", every(blocks_a))
    cell = F.concat_ws(":", "bucket", "i", "j").alias("cell")
    sides = [d.select(cell, "band", F.lit(k).alias("side"), "node", "component") for k, d in enumerate((left, right))]
    return sides[0].unionByName(sides[1])


def linked(hits: DataFrame, texts: DataFrame, settings: Settings) -> DataFrame:
    """Links (a, b) that join all similar nodes of each bucket. hits: bucket, band, node, n (nodes of the bucket); texts: node, text, bands."""
    degree = hits.groupBy("node").agg(F.sum("n").alias("degree"))
    hits = hits.join(degree, "node")
    centre = hits.groupBy("bucket").agg(F.max(F.struct("degree", (-F.col("node")).alias("least"))).alias("c"))
    hits = settle(hits.join(centre, "bucket").select("bucket", "band", "node", (-F.col("c.least")).alias("a")), "hits")
    stars = hits.where("a <> node").select("a", F.col("node").alias("b")).distinct()
    links = settle(verified(_star_cells(stars, settings), texts, settings), "near")
    so_far = components(links)
    placed = settle(hits.join(so_far, "node", "left").select("bucket", "band", "node", F.coalesce("component", "node").alias("component")), "placed")
    return links.unionByName(verified(_bucket_cells(placed, settings), texts, settings))


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """doc_id, class_id, class_size, kept of every row, and the key of its words."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    sketched = rows.select("doc_id", _sketch(settings)(F.col("text")).alias("s")).select("doc_id", "s.*")
    sketched = settle(sketched.withColumn("row", F.monotonically_increasing_id()), "sketches")
    # A text without words is a node of its own; other rows of the same words are one node, its first row.
    shared = F.when(F.col("n_words") > 0, F.col("key"))
    first = sketched.where("n_words > 0").groupBy("key").agg(F.min("row").alias("node"))
    nodes = sketched.where("n_words > 0").join(first, F.col("row") == first["node"], "left_semi").select(
        F.col("row").alias("node"), "doc_id", "key", "bands"
    )
    hits = nodes.select("node", F.posexplode("bands").alias("band", "bucket"))
    crowded = hits.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    hits = settle(hits.join(crowded, "bucket"), "buckets")
    wanted = nodes.join(hits.select("node").distinct(), "node", "left_semi").select("node", "key", "bands", F.col("doc_id").alias("wanted_id"))
    found = rows.join(wanted, rows["doc_id"].eqNullSafe(wanted["wanted_id"])).where(words_key(F.col("text")) == F.col("key"))
    texts = settle(found.groupBy("node").agg(F.first("text").alias("text"), F.first("bands").alias("bands")), "texts")

    found = components(linked(hits, texts, settings))

    placed = sketched.withColumn("shared", shared).join(first.select(F.col("key").alias("shared"), "node"), "shared", "left")
    placed = placed.select("doc_id", "key", "row", F.coalesce("node", "row").alias("node")).join(found, "node", "left")
    placed = placed.select("doc_id", "key", "row", F.coalesce("component", "node").alias("component"))
    stays = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("first")
    sizes = placed.groupBy("component").agg(stays, F.count("*").alias("class_size"))
    return placed.join(sizes, "component").select(
        "doc_id", F.col("first.doc_id").alias("class_id"), "class_size", (F.col("first.row") == F.col("row")).alias("kept"), "key"
    )


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """One row of each class, with its own columns."""
    stays = classes(docs, doc_id, text, settings).where("kept").select(F.col("doc_id").alias("_id"), F.col("key").alias("_kept_key")).distinct()
    taken = {c.lower() for c in docs.columns}
    key, n = "_key", "_n"
    while key in taken:
        key += "_"
    while n in taken:
        n += "_"
    rows = docs.withColumn(key, words_key(F.col(text)))
    one = rows.withColumn(n, F.row_number().over(Window.partitionBy(doc_id, key).orderBy(F.lit(1)))).where(F.col(n) == 1)
    same = one[doc_id].eqNullSafe(stays["_id"]) & (one[key] == stays["_kept_key"])
    return one.join(stays, same, "left_semi").select(*docs.columns)
