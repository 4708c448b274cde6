"""Exact dedup by composable polynomial fingerprints, with a chunkwise comparison of what has equal fingerprints.

Each run of white space counts as one space and null as empty text. A text's bytes b_0 .. b_(n-1) have the fingerprint
sum of (b_i + 1) * base^(n-1-i) modulo a prime, for two primes. Hashes of chunks combine by length: the hash of x + y is
hash(x) * base^len(y) + hash(y). So chunks of a huge text are hashed apart and the chunk size changes nothing.

Rows with equal fingerprints and lengths are then compared chunk by chunk: per group and chunk, the smallest and the
largest chunk must agree. Both are partial aggregates, so a group that holds a third of all rows sends one chunk per task.
Groups that differ (collisions) are told apart by SHA-256.

The row with the smallest doc_id stays; a null doc_id comes after all others. Of rows that repeat the same doc_id and
text, one stays. Empty tables give empty results; other columns pass through `keep_first` untouched.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from assayspark.llm.words import SPACES, bytes_of, slices
from assayspark.session import settle

# The primes and the bases of the two fingerprints.
PRIMES = (2_147_483_647, 2_147_483_629)
BASES = (1_000_003, 1_822_845_947)
CHUNK = 1 << 16


def _chunk_powers(chunk: int) -> list[np.ndarray]:
    made = []
    for p, base in zip(PRIMES, BASES):
        powers, x = np.empty(chunk, np.int64), 1
        for i in range(chunk):
            powers[i] = x
            x = x * base % p
        made.append(powers)
    return made


_POWERS: dict[int, list[np.ndarray]] = {}


def combine(left: tuple[int, int], right: tuple[int, int], right_bytes: int) -> tuple[int, int]:
    """The hash pair of x + y from those of x and y."""
    return tuple((a * pow(base, right_bytes, p) + b) % p for a, b, p, base in zip(left, right, PRIMES, BASES))


def normalised(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets with each run of white space as one space."""
    data, offs = bytes_of(column)
    space = np.zeros(256, bool)
    space[list(SPACES)] = True
    is_space = space[data]
    keep = np.ones(len(data), bool)
    keep[1:] = ~(is_space[1:] & is_space[:-1])
    keep[offs[(offs > 0) & (offs < len(data))]] = True  # a run doesn't reach over the end of a row
    before = np.zeros(len(data) + 1, np.int64)
    np.cumsum(keep, out=before[1:])
    return np.where(is_space, np.uint8(32), data)[keep], before[offs]


def fingerprints(data: np.ndarray, offs: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
    """One 62-bit number per row, from the hashes of its chunks."""
    powers = _POWERS.setdefault(chunk, _chunk_powers(chunk)) if chunk not in _POWERS else _POWERS[chunk]
    lengths = np.diff(offs)
    pieces = np.maximum(-(-lengths // chunk), 1)
    row = np.repeat(np.arange(len(lengths)), pieces)
    number = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    begin = offs[row] + number * chunk
    end = np.minimum(begin + chunk, offs[row + 1])
    out = np.zeros(len(lengths), np.int64)
    filled = end > begin
    exponent = np.repeat(end[filled], (end - begin)[filled]) - 1 - np.arange(len(data))
    hashes = np.zeros((2, len(row)), np.int64)
    for k, p in enumerate(PRIMES):
        terms = powers[k][exponent] * (data.astype(np.int64) + 1)
        if len(terms):
            hashes[k][filled] = np.add.reduceat(terms, begin[filled]) % p
    single = pieces[row] == 1
    out[row[single]] = (hashes[0][single] << 31) | hashes[1][single]
    for r in np.flatnonzero(pieces > 1):
        own = np.flatnonzero(row == r)
        total = (int(hashes[0][own[0]]), int(hashes[1][own[0]]))
        for c in own[1:]:
            total = combine(total, (int(hashes[0][c]), int(hashes[1][c])), int(end[c] - begin[c]))
        out[r] = (total[0] << 31) | total[1]
    return out


DIGEST = StructType([StructField("fp", LongType()), StructField("n_bytes", LongType()), StructField("sha", BinaryType())])


@F.arrow_udf(DIGEST)
def digest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Fingerprint, length and SHA-256 of normalised texts."""
    for column in batches:
        fp, n, sha = [], [], []
        for s, e in slices(column):
            data, offs = normalised(column[s:e])
            view = memoryview(data)
            fp.append(fingerprints(data, offs))
            n.append(np.diff(offs))
            sha += [hashlib.sha256(view[a:b]).digest() for a, b in zip(offs[:-1], offs[1:])]
        none = np.zeros(0, np.int64)
        yield pa.StructArray.from_arrays(
            [pa.array(np.concatenate([none, *fp])), pa.array(np.concatenate([none, *n])), pa.array(sha, pa.binary())], ["fp", "n_bytes", "sha"]
        )


def collisions(rows: DataFrame, groups: DataFrame, total: int, chunk: int = CHUNK, parts: int = 64) -> DataFrame:
    """The (fp, n_bytes) groups whose texts are not all the same. rows: fp, n_bytes, text; groups: those of two rows or more, with their `count`.

    Groups of over a thousandth of all rows, which are under a thousand, are broadcast; their rows are dealt over `parts`.
    """
    key = ["fp", "n_bytes"]
    hot = groups.where(F.col("count") * 1000 > total).select(*key, F.lit(True).alias("hot"))
    part = F.when(F.col("hot"), F.pmod(F.monotonically_increasing_id(), F.lit(parts).cast("long"))).otherwise(F.lit(0).cast("long"))
    dealt = rows.join(F.broadcast(hot), key, "left").withColumn("part", part)
    wanted = groups.join(F.broadcast(hot), key, "left").select(
        *key, F.explode(F.when(F.col("hot"), F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).otherwise(F.array(F.lit(0).cast("long")))).alias("part")
    )
    suspects = dealt.join(wanted, [*key, "part"], "left_semi")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s, e in slices(b.column("text")):
                data, offs = normalised(b.column("text")[s:e])
                lengths = np.diff(offs)
                pieces = np.maximum(-(-lengths // chunk), 1)
                row = np.repeat(np.arange(e - s), pieces)
                number = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                cuts = np.append(offs[row] + number * chunk, offs[-1]).astype(np.int32)
                texts = pa.Array.from_buffers(pa.binary(), len(row), [None, pa.py_buffer(cuts), pa.py_buffer(data)])
                at = pa.array(row + s)
                yield pa.RecordBatch.from_arrays(
                    [b.column("fp").take(at), b.column("n_bytes").take(at), pa.array(number), texts], ["fp", "n_bytes", "number", "chunk"]
                )

    chunks = suspects.select("fp", "n_bytes", "text").mapInArrow(cut, "fp long, n_bytes long, number long, chunk binary")
    ends = chunks.groupBy("fp", "n_bytes", "number").agg(F.min("chunk").alias("low"), F.max("chunk").alias("high"))
    return ends.where("low <> high").select("fp", "n_bytes").distinct()


def decide(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row, and the fingerprint it was grouped by.

    Texts are read twice; fingerprints are written once to the shared folder. No text is grouped, only its fingerprint.
    """
    read = docs.select(F.col(doc_id).alias("doc_id"), digest(F.col(text)).alias("d"))
    rows = settle(read.select("doc_id", "d.*", F.monotonically_increasing_id().alias("row")), "fingerprints")
    groups = rows.groupBy("fp", "n_bytes").count().where("count > 1")
    texts = docs.select(F.col(text).alias("text"), digest(F.col(text)).alias("d")).select("d.fp", "d.n_bytes", "text")
    bad = collisions(texts, groups, rows.count()).withColumn("collides", F.lit(True))
    rows = rows.join(bad, ["fp", "n_bytes"], "left").withColumn("part", F.when(F.col("collides"), F.col("sha"))).drop("collides")
    rows = rows.withColumn("key", F.xxhash64(F.coalesce("part", F.lit(b""))))
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")
    kept = rows.groupBy("fp", "n_bytes", "key").agg(F.min(first).alias("first"), F.count("*").alias("group_size"))
    return rows.join(kept, ["fp", "n_bytes", "key"]).select(
        "doc_id", F.col("first.doc_id").alias("keep_id"), "group_size", (F.col("first.row") == F.col("row")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"), "fp", "n_bytes",
    )


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with their own columns."""
    stays = decide(docs, doc_id, text).where("kept").select(F.col("doc_id").alias("_id"), F.unhex("text_sha256").alias("_sha")).distinct()
    clash = {c.lower() for c in docs.columns}
    names = []
    for base in ("_sha", "_n"):
        while base in clash:
            base += "_"
        names.append(base)
    sha, n = names
    rows = docs.withColumn(sha, digest(F.col(text))["sha"])
    one = rows.withColumn(n, F.row_number().over(Window.partitionBy(doc_id, sha).orderBy(F.lit(1)))).where(F.col(n) == 1)
    same = one[doc_id].eqNullSafe(stays["_id"]) & (one[sha] == stays["_sha"])
    return one.join(stays, same, "left_semi").select(*docs.columns)
