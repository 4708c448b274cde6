"""Repeated passages across documents: MinHash banding of paragraphs, exact verification, removals by components.

A paragraph is a run of about 2 * `reach` + 1 words. Paragraphs begin where a pair of words has the smallest hash among
its `reach` neighbours on either side, so where they are cut depends on the words around alone, not on line ends: a
passage pasted into the middle of a line is cut like its source, but for its edges, where a paragraph also holds words
of its surroundings. Paragraphs of the same words are one node. The windows of five words of a paragraph are its set;
bands of MinHash values propose pairs of different paragraphs. `tune` picks the fewest hashes that reach the wanted
recall; the default bands find paragraphs of which less than half is shared, as those at the edges of a passage are.

In a bucket of equal band keys the paragraphs that share an unbroken run of at least `least` / 2 words are linked to the
first of them; two paragraphs are linked if they hold runs of that many words whose windows have the wanted Jaccard
similarity. Only where one of the two repeats words can they be linked without such an unbroken run (`runs_prove`): those
are compared, in bounded blocks inside tasks, as long as they are in different components.

The order of occurrences is by doc_id (nulls last), then row and place. What a paragraph shares with an earlier one that
it is linked to, or equal to, is removed if that stands in another row: the words of both are compared from one
paragraph before to one behind, by windows of five words shared in the same order, and the longest runs whose Jaccard
similarity reaches the threshold go whole, with the edited words inside. So the first occurrence of a cluster always
stays. Only runs of at least `least` words together are removed, so short shared lines stay. Removed spans that repeat
one another are clusters, the connected components of these links. Spans are word numbers, the end exclusive.

Texts are read once, into a table of paragraphs with their words; all later steps join on the number of the row
and of the paragraph. Null and empty texts have no paragraphs; rows that repeat an id, or have none, are documents of
their own. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import functools
import math
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from assayspark.llm.components import components
from assayspark.llm.words import Words, bytes_of, mix, slices, windows
from assayspark.session import numbered, settle

RANGE = ["row", "doc_id", "kept", "other_row", "start", "end", "other_start", "other_end"]
PACKED = {"compression": "zstd"}
AT_ONCE = 8  # bands that meet at a time, for the sake of the disk
DEALT = 1 << 19  # band keys that are ordered at once, about


def tune(threshold: float, recall: float, most: int = 64) -> tuple[int, int]:
    """Bands and rows: the most selective rows, and the bands for them, that propose similar pairs with this recall within `most` hashes."""
    found = (most, 1)
    for rows in range(1, most + 1):
        # all rows of a band agree with probability threshold ** rows
        bands = math.ceil(math.log(1 - recall) / math.log1p(-(threshold**rows))) if threshold**rows < 1 else 1
        if bands * rows <= most:
            found = (bands, rows)
        else:
            break
    return found


@dataclass(frozen=True)
class Settings:
    reach: int = 20
    least: int = 20
    size: int = 5
    threshold: float = 0.8
    bands: int = 16  # tune(0.45, 0.97, most=32)
    rows: int = 2
    members: int = 256  # paragraphs that a side of one comparison holds, about


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every `width` values in a row."""
    size = 1
    while 2 * size <= width:
        values, size = np.minimum(values[:-size], values[size:]), 2 * size
    return np.minimum(values[: len(values) - width + size], values[width - size :])


def cut(words: Words, reach: int) -> np.ndarray:
    """The first word of each paragraph; paragraphs tile the texts."""
    h = windows(words.hash, 2)
    h[np.flatnonzero(words.left() == 1)] = np.uint64(0xFFFFFFFFFFFFFFFF)  # the last word has no pair
    apart = np.full(len(h) + reach * (words.texts + 1), 0xFFFFFFFFFFFFFFFF, np.uint64)  # so that no text sees another
    at = np.arange(len(h)) + reach * (words.owner + 1)
    apart[at] = h
    least = _least(apart, reach)
    begins = (h < least[at - reach]) & (h <= least[at + 1])
    begins[words.starts[:-1][words.lengths() > 0]] = True
    return np.flatnonzero(begins)


def runs_of(hashes: np.ndarray, size: int) -> np.ndarray:
    """As `windows`, for word hashes, which are mixed already: a polynomial of them."""
    total = np.zeros(len(hashes), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(min(size, len(hashes))):
            total[: len(hashes) - k] = total[: len(hashes) - k] * np.uint64(0xD6E8FEB86659FD93) + hashes[k:]
    return mix(total)


def sketch(words: Words, first: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Length, fingerprint and band keys (paragraphs, bands) of the paragraphs that begin at `first`."""
    n = len(words.hash)
    lengths = np.diff(np.append(first, n))
    place = np.arange(n) - np.repeat(first, lengths)
    with np.errstate(over="ignore"):
        run = np.zeros(n + 1, np.uint64)
        np.cumsum(mix(words.hash + mix(place, 21), 31), out=run[1:])
        u = mix(run[np.append(first, n)[1:]] - run[first] + lengths.astype(np.uint64)).view(np.int64)
    shingle = runs_of(words.hash, settings.size)
    beyond = np.where(place + settings.size <= np.repeat(lengths, lengths), np.uint64(0), np.uint64(0xFFFFFFFFFFFFFFFF))
    odd = mix(np.arange(settings.bands * settings.rows, dtype=np.uint64), 50) | np.uint64(1)
    keys, value = np.zeros((len(first), settings.bands), np.uint64), np.empty(n, np.uint64)
    for b in range(settings.bands if n else 0):
        total = np.full(len(first), b, np.uint64)
        for r in range(settings.rows):
            np.multiply(shingle, odd[b * settings.rows + r], out=value)  # windows are well mixed, so a factor gives another order
            np.bitwise_or(value, beyond, out=value)
            low = np.minimum.reduceat(value, first)
            total = mix(total + np.where(lengths >= settings.size, low, u.view(np.uint64)))
        keys[:, b] = total
    return lengths, u, keys.view(np.int64)


def _timed(keys: np.ndarray) -> np.ndarray:
    """Keys that also say how often the same one came before."""
    order = np.argsort(keys)
    held = keys[order]
    same = np.append(False, held[1:] == held[:-1])[: len(keys)]
    same[:-1] |= same[1:]
    some = np.sort(order[same])  # places of keys that come more than once
    some = some[np.argsort(keys[some], kind="stable")]
    new = np.append(True, keys[some][1:] != keys[some][:-1])[: len(some)]
    start = np.flatnonzero(new)
    times = np.zeros(len(keys), np.uint64)
    times[some] = np.arange(len(some)) - np.repeat(start, np.diff(np.append(start, len(some))))
    with np.errstate(over="ignore"):
        return mix(keys + mix(times, 23), 33)


def _common(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places in `a` of what stands in both, rising, and its places in `b`. Nothing stands twice in one of them."""
    both = np.concatenate([a, b])
    order = np.argsort(both)
    held = both[order]
    at = np.flatnonzero(held[1:] == held[:-1])
    i, j = np.minimum(order[at], order[at + 1]), np.maximum(order[at], order[at + 1]) - len(a)
    order = np.argsort(i)
    return i[order], j[order]


def _rising(values: np.ndarray) -> np.ndarray:
    """Places of a longest rising part of the values."""
    tops: list[int] = []
    ends: list[int] = []
    before = np.full(len(values), -1)
    for k, v in enumerate(values.tolist()):
        at = bisect_left(tops, v)
        before[k] = ends[at - 1] if at else -1
        tops[at : at + 1], ends[at : at + 1] = [v], [k]
    out, k = [], ends[-1] if ends else -1
    while k >= 0:
        out.append(k)
        k = int(before[k])
    return np.array(out[::-1], np.int64)


def aligned(words: np.ndarray, others: np.ndarray, size: int, threshold: float) -> list[tuple[int, int, int, int]]:
    """Runs of `words` whose windows have at least this Jaccard similarity with a run of `others`, the longest first, and that run."""
    if min(len(words), len(others)) < size:
        return []
    own, other = (_timed(runs_of(w, size)[: len(w) - size + 1]) for w in (words, others))
    return _similar(*_common(own, other), size, threshold)


def _similar(i: np.ndarray, j: np.ndarray, size: int, threshold: float) -> list[tuple[int, int, int, int]]:
    """The runs of `aligned` from the places of common windows, rising in `i`."""
    if (np.diff(j) < 0).any():
        kept = _rising(j)
        i, j = i[kept], j[kept]
    if not len(i):
        return []
    broken = np.flatnonzero((np.diff(i) != 1) | (np.diff(j) != 1))
    first, last = np.append(0, broken + 1), np.append(broken, len(i) - 1)
    p, q = first[:, None], last[None, :]
    shared, long, wide = q - p + 1, i[q] - i[p] + 1, j[q] - j[p] + 1
    right = (shared > 0) & (shared >= threshold * (long + wide - shared) - 1e-9)
    long = np.where(right, long, 0)
    out, todo = [], [(0, len(first))]
    while todo:
        s, e = todo.pop()
        if s == e:
            continue
        a, b = divmod(int(long[s:e, s:e].argmax()), e - s)  # one block alone is always right
        begin, end = first[s + a], last[s + b]
        out.append((int(i[begin]), int(i[end]) + size, int(j[begin]), int(j[end]) + size))
        todo += [(s, s + a), (s + b + 1, e)]
    return out


def alike(words: np.ndarray, others: np.ndarray, size: int, threshold: float) -> list[tuple[int, int]]:
    """The runs of `words` that are aligned with runs of `others`."""
    return [(s, e) for s, e, _, _ in aligned(words, others, size, threshold)]


def _blocks(numbers: np.ndarray, told: np.ndarray) -> pa.Array:
    """The bytes of the rows that are told, empty bytes for the others."""
    ends = np.append(0, np.cumsum(told * (numbers.shape[1] * numbers.itemsize))).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(told), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(numbers[told]))])


def paragraphs(docs: DataFrame, settings: Settings) -> DataFrame:
    """row, doc_id, number, last, start, n (words), u (the fingerprint), bytes and band keys of each paragraph. docs: doc_id, text."""
    parts = range(0, settings.bands, AT_ONCE)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for s, e in slices(batch.column("text")):
                words = Words(batch.column("text")[s:e], lower=True)
                first = cut(words, settings.reach)
                lengths, u, keys = sketch(words, first, settings)
                owner = words.owner[first]
                count = np.bincount(owner, minlength=e - s)
                number = np.arange(len(first)) - np.repeat(np.cumsum(count) - count, count)
                long = lengths >= settings.size  # shorter ones are known by all their words
                bands = [_blocks(keys[:, at : at + AT_ONCE], long) for at in parts]
                data, ends = words.data, np.append(words.first[first], len(words.data))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row + owner), batch.column("doc_id")[s:e].take(pa.array(owner)), pa.array(number, pa.int32()),
                        pa.array(number == count[owner] - 1), pa.array(first - words.starts[owner], pa.int32()), pa.array(lengths, pa.int32()),
                        pa.array(u), pa.array([data[i:j].tobytes() + b" " for i, j in zip(ends[:-1], words.last[np.append(first, len(words.last))[1:] - 1])], pa.binary()),
                        *bands,
                    ],
                    ["row", "doc_id", "number", "last", "start", "n", "u", "bytes", *(f"bands{at}" for at in parts)],
                )
                row += e - s

    kinds = "row long, doc_id long, number int, last boolean, start int, n int, u long, bytes binary"
    return docs.mapInArrow(read, ", ".join([kinds, *(f"bands{at} binary" for at in parts)]))


def _words(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The word hashes of a column of bytes and the n + 1 offsets of its rows."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    words = Words(column.fill_null(b""), lower=True)
    return words.hash, words.starts


def _keys(hashes: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The place of every whole window within its row and a key that tells its row and how often it came there before."""
    lengths = np.diff(starts)
    row = np.repeat(np.arange(len(lengths)), lengths)
    place = np.arange(len(hashes)) - starts[row]
    whole = place + size <= lengths[row]
    with np.errstate(over="ignore"):
        return np.flatnonzero(whole), _timed(mix(runs_of(hashes, size)[whole] + mix(row[whole], 41)))


def aligned_rows(own: pa.Array, other: pa.Array, size: int, threshold: float) -> np.ndarray:
    """`aligned` for all rows of two columns of bytes: row, start, end, other start, other end. Rows with one common block need no search."""
    (a, a_starts), (b, b_starts) = _words(own), _words(other)
    (a_at, a_keys), (b_at, b_keys) = _keys(a, a_starts, size), _keys(b, b_starts, size)
    i, j = _common(a_keys, b_keys)
    i, j = a_at[i], b_at[j]
    row = np.searchsorted(a_starts, i, "right") - 1
    if not len(row):
        return np.zeros((0, 5), np.int64)
    new = np.append(True, row[1:] != row[:-1])
    first, last = np.flatnonzero(new), np.append(np.flatnonzero(new)[1:], len(row)) - 1
    broken = np.append(False, (np.diff(i) != 1) | (np.diff(j) != 1)) & ~new
    plain = np.add.reduceat(broken, first, dtype=np.int64) == 0
    f, e, r = first[plain], last[plain], row[first[plain]]
    out = [np.stack([r, i[f] - a_starts[r], i[e] + size - a_starts[r], j[f] - b_starts[r], j[e] + size - b_starts[r]], axis=1)]
    runs = []
    for r, f, e in zip(row[first[~plain]].tolist(), first[~plain].tolist(), (last[~plain] + 1).tolist()):
        runs += [(r, *x) for x in _similar(i[f:e] - a_starts[r], j[f:e] - b_starts[r], size, threshold)]
    return np.concatenate([*out, np.array(runs, np.int64).reshape(-1, 5)])


def need(settings: Settings) -> int:
    """Words that two paragraphs must share in one similar run."""
    return max(settings.size, math.ceil(settings.least / 2))


def runs_prove(settings: Settings) -> bool:
    """Whether paragraphs that repeat nothing are linked only if they share an unbroken run of `need` words.

    Between two blocks of common windows lie at least three others, unless `size` - 1 words that both hold occur twice in
    one of the two. Blocks shorter than such a run are then too few for the gaps between them.
    """
    most = need(settings) - settings.size
    return 3 * settings.threshold > 2 * most * (1 - settings.threshold) + 1e-6


def grams(words: DataFrame, length: int) -> DataFrame:
    """node, gram, again: the different runs of `length` words of each paragraph, and which occur in it more than once."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, starts = _words(batch.column("bytes"))
            lengths = np.diff(starts)
            row = np.repeat(np.arange(len(lengths)), lengths)
            whole = np.arange(len(hashes)) - starts[row] + length <= lengths[row]
            gram, row = runs_of(hashes, length)[whole], row[whole]
            order = np.lexsort((gram, row))
            gram, row = gram[order], row[order]
            first = np.flatnonzero(np.append(True, (gram[1:] != gram[:-1]) | (row[1:] != row[:-1]))[: len(gram)])
            again = np.diff(np.append(first, len(gram))) > 1
            yield pa.RecordBatch.from_arrays([batch.column("node").take(pa.array(row[first])), pa.array(gram[first].view(np.int64)), pa.array(again)], ["node", "gram", "again"])

    return words.select("node", "bytes").mapInArrow(read, "node long, gram long, again boolean")


def _once(rows: DataFrame, group: list[str], told_by: list[str]) -> DataFrame:
    """Of the groups of the same nodes, two at least, one."""
    members = [F.bit_xor(F.xxhash64(*told_by, F.lit(k))).alias(f"x{k}") for k in (0, 1)]
    sizes = rows.groupBy(group).agg(F.count("*").alias("n"), *members).where("n > 1")
    sizes = sizes.groupBy("n", "x0", "x1")
    if len(group) == 1:
        return sizes.agg(F.min(group[0]).alias(group[0])).select(group)
    return sizes.agg(F.min(F.struct(*group)).alias("g")).select("g.*")


def run_links(hits: DataFrame, words: DataFrame, settings: Settings) -> DataFrame:
    """Links (a, b), a before b, that join the paragraphs which share a bucket and a run of `need` words. hits: key, node.

    Each paragraph is linked to the first that holds the run in one of its buckets, and that one to the first of the
    paragraph's other buckets, so there are about as many links as paragraphs and runs, however large a bucket is.
    """
    runs = grams(words, need(settings)).select("node", "gram")
    kept = settle(_once(runs, ["gram"], ["node"]), "runs")
    held = settle(runs.join(kept, "gram").join(hits, "node"), "held")
    least = held.groupBy("key", "gram").agg(F.min("node").alias("a"), F.max("node").alias("last")).where("a < last").drop("last")
    met = held.join(least, ["key", "gram"]).select("gram", "node", "a").distinct()
    best = F.min("a").over(Window.partitionBy("gram", "node"))  # a row a bucket of the paragraph at most
    return met.select(best.alias("best"), "a", "node").select(F.col("best").alias("a"), F.explode(F.array("a", "node")).alias("b")).where("a < b").distinct()


def _cells(placed: DataFrame, settings: Settings) -> DataFrame:
    """Groups of several components as cells of bounded blocks; one of the two of each pair is marked `again`.

    placed: key, gram, node, component, again. Outside the largest component the marked nodes meet all, the others the
    marked ones of the largest.
    """
    group, marked = ["key", "gram"], F.sum(F.col("again").cast("long"))
    sizes = placed.groupBy(*group, "component").agg(F.count("*").alias("n"), marked.alias("marked"))
    main = sizes.groupBy(group).agg(F.max(F.struct("n", "component", "marked")).alias("m"), F.sum("n").alias("n"), F.sum("marked").alias("marked"), F.count("*").alias("parts"))
    main = main.where("parts > 1 and marked > 0").withColumn("out", F.col("n") - F.col("m.n")).withColumn("marked_out", F.col("marked") - F.col("m.marked"))
    blocks = lambda n: F.ceil(n / settings.members)
    marks = F.struct(F.lit(1).alias("part"), blocks(F.col("marked_out")).alias("is"), blocks(F.col("n")).alias("js"))
    rest = F.struct(F.lit(0).alias("part"), blocks(F.col("out") - F.col("marked_out")).alias("is"), blocks(F.col("m.marked")).alias("js"))
    main = main.select(*group, F.col("m.component").alias("main"), F.explode(F.array(marks, rest)).alias("p")).select(*group, "main", "p.*").where("is > 0 and js > 0")
    rows = placed.join(main, group).withColumn("outside", F.col("component") != F.col("main"))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    left = rows.where("outside and again = (part = 1)").withColumn("i", F.pmod(F.xxhash64("node"), "is")).withColumn("j", every("js"))
    right = rows.where("part = 1 or (again and not outside)").withColumn("j", F.pmod(F.xxhash64("node"), "js")).withColumn("i", every("is"))
    cell = F.concat_ws(":", *group, "part", "i", "j").alias("cell")
    sides = [d.select(cell, F.lit(k).alias("side"), "node", "component") for k, d in enumerate((left, right))]
    return sides[0].unionByName(sides[1])


def repeat_links(hits: DataFrame, words: DataFrame, near: DataFrame, settings: Settings) -> DataFrame:
    """The links (a, b) that `run_links` can not tell, by comparison. hits: key, node; words: node, bytes; near: a, b.

    Those are between paragraphs that share a bucket and `size` - 1 words which one of them repeats; where runs prove
    nothing, all of a bucket.
    """
    if runs_prove(settings):
        held = grams(words, settings.size - 1)
        twice = settle(held.where("again").select("gram").distinct(), "twice")
        held = settle(held.join(twice, "gram"), "repeats")
        placed = held.join(_once(held, ["gram"], ["node", "again"]), "gram").join(hits, "node")
    else:
        placed = hits.select("key", "node", F.lit(0).cast("long").alias("gram"), F.lit(True).alias("again"))
    so_far = near.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("component"))
    placed = placed.join(so_far, "node", "left").withColumn("component", F.coalesce("component", "node"))
    placed = settle(placed, "placed")
    cells = _cells(placed.join(_once(placed, ["key", "gram"], ["node", "again"]), ["key", "gram"]), settings)
    # a similar run of `need` words has at least so many common windows
    fewest = max(1, math.ceil(settings.threshold * (need(settings) - settings.size + 1) - 1e-9))

    def compare(cell: pa.Table) -> pa.Table:
        cell = cell.sort_by([("node", "ascending")]).combine_chunks()
        side, nodes, component = (cell.column(c).to_numpy().copy() for c in ("side", "node", "component"))
        column = cell.column("bytes").combine_chunks()
        column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
        hashes, starts = _words(column)
        row = np.repeat(np.arange(len(nodes)), np.diff(starts))
        whole = np.arange(len(hashes)) - starts[row] + settings.size <= np.diff(starts)[row]
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        row, window = row[whole], runs_of(hashes, settings.size)[whole]
        known = np.intersect1d(window[side[row] == 0], window[side[row] == 1])
        both = np.isin(window, known)
        table = np.zeros((len(nodes), len(known)), np.float32)  # how often a common window stands in a paragraph
        np.add.at(table, (row[both], np.searchsorted(known, window[both])), 1)
        near = table[left] @ table[right].T >= fewest
        out = [np.zeros((0, 2), np.int64)]
        for at in range(0, len(left), 16):
            some = left[at : at + 16]
            k, other = np.nonzero(near[at : at + 16] & (component[some][:, None] != component[right][None, :]))
            if len(k):
                k, other = some[k], right[other]
                runs = aligned_rows(column.take(pa.array(k)), column.take(pa.array(other)), settings.size, settings.threshold)
                linked = np.unique(runs[runs[:, 2] - runs[:, 1] >= settings.least / 2, 0])
                for i, j in zip(k[linked].tolist(), other[linked].tolist()):
                    if component[i] != component[j]:
                        out.append(np.sort(nodes[[i, j]])[None, :])
                        component[component == component[j]] = component[i]
        out = np.concatenate(out)
        return pa.table({"a": pa.array(out[:, 0]), "b": pa.array(out[:, 1])})

    return cells.join(words, "node").groupBy("cell").applyInArrow(compare, "a long, b long")


def _grouped(keys: np.ndarray, us: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Both ordered by key, and of each different key where it begins, how often it comes and whether with different `us`."""
    order = np.argsort(keys)
    keys, us = keys[order], us[order]
    start = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    differ = np.minimum.reduceat(us, start) != np.maximum.reduceat(us, start) if len(keys) else np.zeros(0, bool)
    return keys, us, start, np.diff(np.append(start, len(keys))), differ


LONE, KNOWN, FOUND = range(3)


def dealt_keys(made: DataFrame, bands: str, shards: int) -> DataFrame:
    """shard, kind, keys, us: band keys and their paragraphs, many a row, dealt by the size of the key. made: u, bands.

    Of a key that already has different paragraphs among those read together only the key itself goes to its shard (KNOWN);
    the paragraphs go anywhere (FOUND), so a shard gets a key at most once for each such reading.
    """
    edges = np.array([(k << 64) // shards - (1 << 63) for k in range(1, shards)], np.int64)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, turn = [], 0, TaskContext.get().partitionId()

        def dealt() -> pa.RecordBatch:
            nonlocal turn
            keys, us, start, times, differ = _grouped(*(np.concatenate(x) for x in zip(*held)))
            rows = []
            for kind, k, v in ((LONE, keys[start[~differ]], us[start[~differ]]), (KNOWN, keys[start[differ]], us[:0])):
                at = np.concatenate([[0], np.searchsorted(k, edges), [len(k)]])
                rows += [(s, kind, k[a:b].tobytes(), v[a:b].tobytes()) for s, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())) if a < b]
            more = np.repeat(differ, times)
            k, v = keys[more], us[more]
            for at in range(0, len(k), 1 << 16):
                rows.append((turn % shards, FOUND, k[at : at + (1 << 16)].tobytes(), v[at : at + (1 << 16)].tobytes()))
                turn += 1
            columns = list(zip(*rows))
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.binary()), pa.array(columns[3], pa.binary())],
                ["shard", "kind", "keys", "us"],
            )

        for batch in batches:
            keys, ends = bytes_of(batch.column(bands))
            held.append((keys.view(np.int64).copy(), np.repeat(batch.column("u").to_numpy(), np.diff(ends) // 8)))
            size += len(held[-1][0])
            if size >= DEALT:
                yield dealt()
                held, size = [], 0
        if size:
            yield dealt()

    return made.select("u", bands).mapInArrow(deal, "shard int, kind int, keys binary, us binary")


def buckets(made: DataFrame, bands: str, shards: int) -> DataFrame:
    """key, u: the paragraphs of every band key that different paragraphs have; the same row may come again. made: u, bands."""

    def meet(shard: pa.Table) -> pa.Table:
        kinds = shard.column("kind").to_numpy()
        numbers = lambda column: np.frombuffer(b"".join(column.to_pylist()), np.int64)
        keys, us = ([numbers(shard.column(c).filter(pa.array(kinds == k))) for k in (LONE, KNOWN, FOUND)] for c in ("keys", "us"))
        k, v, start, times, differ = _grouped(keys[LONE], us[LONE])
        more = np.repeat(differ | np.isin(k[start], keys[KNOWN]), times)
        return pa.table({"key": pa.array(np.append(k[more], keys[FOUND])), "u": pa.array(np.append(v[more], us[FOUND]))})

    return dealt_keys(made, bands, shards).groupBy("shard").applyInArrow(meet, "key long, u long")


def links(made: DataFrame, firsts: DataFrame, settings: Settings) -> DataFrame:
    """Similar nodes (a, b): paragraphs that share a band key and hold similar runs. firsts: u, first."""
    shards = math.ceil(made.count() * min(settings.bands, AT_ONCE) / DEALT) or 1
    parts = [settle(buckets(made, f"bands{at}", shards).distinct(), "hits") for at in range(0, settings.bands, AT_ONCE)]
    hits = functools.reduce(DataFrame.unionByName, parts)
    # nodes are numbered in the order of their first occurrence
    nodes = settle(numbered(firsts.join(hits.select("u").distinct(), "u").orderBy("first", "u"), "node"), "nodes")
    at = nodes.select("node", F.col("first.row").alias("row"), F.col("first.number").alias("number"))
    words = settle(made.select("row", "number", "bytes").join(at, ["row", "number"]).select("node", "bytes"), "words", **PACKED)
    hits = settle(hits.join(nodes.select("u", "node"), "u").select("key", "node"), "placed")
    hits = settle(hits.join(_once(hits, ["key"], ["node"]), "key"), "buckets")
    near = settle(run_links(hits, words, settings), "near")
    near = near.unionByName(repeat_links(hits, words, near, settings)).distinct()
    known = lambda n: nodes.select(F.col("node").alias(n), F.col("u").alias(f"{n}_u"))
    return settle(near.join(known("a"), "a").join(known("b"), "b").select(F.col("a_u").alias("a"), F.col("b_u").alias("b")), "links")


AROUND = (-1, 0, 1)


def _around(asked: DataFrame, row: str, number: str, *more: str) -> DataFrame:
    """row, number of each asked paragraph, the one before and the one behind."""
    return asked.select(*more, F.col(row).alias("row"), F.explode(F.array(*(F.col(number) + k for k in AROUND))).alias("number"))


def shared_runs(asked: DataFrame, made: DataFrame, settings: Settings) -> DataFrame:
    """What asked paragraphs share with earlier ones: the columns of RANGE. asked: row, doc_id, number, kept, other_row, other_number."""
    asked = settle(asked.withColumn("id", F.monotonically_increasing_id()), "asked")
    wanted = _around(asked, "row", "number").unionByName(_around(asked, "other_row", "other_number")).distinct()
    texts = settle(made.select("row", "number", "start", "bytes").join(wanted, ["row", "number"]), "texts", **PACKED)
    sides = [_around(asked.withColumn("side", F.lit(k)), *at, "id", "side").join(texts, ["row", "number"]) for k, at in enumerate((("row", "number"), ("other_row", "other_number")))]
    parts = sides[0].unionByName(sides[1]).groupBy("id").agg(F.sort_array(F.collect_list(F.struct("side", "number", "start", "bytes"))).alias("parts"))  # at most six
    stretch = []
    for k, into in enumerate(("", "other_")):
        part = F.filter("parts", functools.partial(lambda k, p: p["side"] == k, k))
        words = F.array_join(F.transform(part, lambda p: p["bytes"].cast("string")), "").cast("binary")
        stretch += [part[0]["start"].alias(f"{into}start"), words.alias(f"{into}bytes")]
    rows = asked.select("id", "row", "doc_id", "kept", "other_row").join(parts.select("id", *stretch), "id")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = aligned_rows(batch.column("bytes"), batch.column("other_bytes"), settings.size, settings.threshold)
            at, own, other = pa.array(runs[:, 0]), batch.column("start").to_numpy(), batch.column("other_start").to_numpy()
            taken = [batch.column(c).take(at) for c in RANGE[:4]]
            places = runs[:, 1:] + np.stack([own, own, other, other], axis=1)[runs[:, 0]]
            yield pa.RecordBatch.from_arrays([*taken, *(pa.array(places[:, k], pa.int32()) for k in range(4))], RANGE)

    return rows.mapInArrow(compare, "row long, doc_id long, kept long, other_row long, start int, end int, other_start int, other_end int")


def clustered(ranges: DataFrame, settings: Settings) -> DataFrame:
    """Spans of at least `least` words, the ranges of a row that overlap or touch as one, and where their words stay.

    A range whose other place is itself removed links two spans. The components of these links are the clusters; what
    such a range repeats stays in the first document of its cluster.
    """
    own = Window.partitionBy("row").orderBy("start", "end", "other_row", "other_start")
    reached = F.max("end").over(own.rowsBetween(Window.unboundedPreceding, -1))
    ranges = ranges.withColumn("new", F.when(F.col("start") <= reached, 0).otherwise(1))
    ranges = settle(ranges.withColumn("run", F.sum("new").over(own.rowsBetween(Window.unboundedPreceding, 0))), "ranges")
    spans = ranges.groupBy("row", "doc_id", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    spans = spans.withColumn("n_words", (F.col("end") - F.col("start")).cast("long")).where(F.col("n_words") >= settings.least)
    spans = settle(spans.withColumn("span", F.monotonically_increasing_id()), "spans")

    parts = ranges.join(spans.select("row", "run", "span"), ["row", "run"]).select("span", "kept", "other_row", "other_start", "other_end")
    gone = spans.select(F.col("row").alias("gone_row"), F.col("start").alias("from"), F.col("end").alias("to"), F.col("span").alias("near"))
    overlap = F.least("to", "other_end") - F.greatest("from", "other_start")
    inside = (F.col("other_row") == F.col("gone_row")) & (2 * overlap > F.col("other_end") - F.col("other_start"))  # so in one span at most
    parts = settle(parts.join(gone, inside, "left").select("span", "near", "kept"), "parts")
    found = components(parts.where("near is not null"), "span", "near")
    parts = parts.join(found.withColumnRenamed("node", "span"), "span", "left").withColumn("component", F.coalesce("component", "span"))
    # settled, so that the join reads two shuffles and the runtime can split a large component
    first = settle(parts.where("near is null").groupBy("component").agg(F.min("kept").alias("cluster_doc_id")), "firsts")
    kept = parts.join(first, "component", "left").groupBy("span").agg(
        F.sort_array(F.collect_set(F.when(F.col("near").isNull(), F.col("kept")).otherwise(F.col("cluster_doc_id")))).alias("kept_doc_ids"),
        F.first("cluster_doc_id").alias("cluster_doc_id"),
    )
    kept = kept.withColumn("kept_doc_id", F.array_min("kept_doc_ids"))
    return spans.drop("run").join(kept, "span").drop("span")


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """Spans to remove: row, doc_id, start, end, n_words, kept_doc_ids (where their words stay), kept_doc_id, the first of
    them, and cluster_doc_id, the first document of their cluster."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    made = paragraphs(rows, settings)
    plain = {f"parquet.enable.dictionary#{c}": "false" for c in made.columns if c in ("u", "bytes") or c.startswith("bands")}  # hardly a value comes twice
    made = settle(made, "paragraphs", **PACKED, **plain)
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row", "number", "start").alias("first")
    firsts = settle(made.groupBy("u").agg(F.min(place).alias("first"), F.min("row").alias("low"), F.max("row").alias("high")), "firsts")
    near = links(made, firsts.select("u", "first"), settings)
    both = near.unionByName(near.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()

    again = firsts.where("low <> high").select("u").unionByName(both.select(F.col("a").alias("u"))).distinct()
    nodes = settle(firsts.join(again, "u").select("u", "first"), "nodes")
    places = made.select("row", "doc_id", "number", "last", "start", (F.col("start") + F.col("n")).alias("end"), "u")
    places = settle(places.join(nodes, "u"), "places")

    # an equal paragraph of an earlier row goes whole; only around the ends of a chain of such is more compared
    equal = places.where(F.col("row") != F.col("first.row")).select(
        "row", "doc_id", "number", "last", "start", "end", F.col("first.doc_id").alias("kept"), F.col("first.row").alias("other_row"),
        F.col("first.number").alias("other_number"), F.col("first.start").alias("other_start"),
        (F.col("first.start") + F.col("end") - F.col("start")).alias("other_end"),
    )
    chain = Window.partitionBy("row").orderBy("number")
    before, behind = (F.coalesce(f("number").over(chain), F.lit(-9)) - F.col("number") for f in (F.lag, F.lead))
    open_end = ((F.col("number") > 0) & (before != -1)) | (~F.col("last") & (behind != 1))
    asked = ["row", "doc_id", "number", "kept", "other_row", "other_number"]
    ends = equal.withColumn("open_end", open_end).where("open_end").select(asked)
    # of two linked paragraphs the later one is compared with the earlier one
    other = nodes.select(F.col("u").alias("b"), F.col("first").alias("other"))
    pairs = places.where(F.col("row") == F.col("first.row")).join(both.withColumnRenamed("a", "u"), "u").join(other, "b")
    pairs = pairs.where((F.col("other.row") != F.col("row")) & (F.col("other") < F.col("first")))
    later = pairs.select(
        "row", "doc_id", "number", F.col("other.doc_id").alias("kept"), F.col("other.row").alias("other_row"), F.col("other.number").alias("other_number")
    )
    return clustered(equal.select(RANGE).unionByName(shared_runs(ends.unionByName(later), made, settings)), settings)


def removed_from(text: str | None, spans: list[tuple[int, int]]) -> str:
    """A text without the words of its spans; what stays keeps its own white space."""
    import re

    out, at = [], 0
    words = list(re.finditer(r"[^\x20\x09-\x0D]+", text or ""))
    for start, end in sorted(spans):
        out.append((text or "")[at : words[start].start()])
        at = words[end].start() if end < len(words) else len(text or "")
    return "".join(out) + (text or "")[at:]
