"""Quality rules: text statistics, and a hashed n-gram log-likelihood ratio between a trusted target and the raw corpus.

Words and pairs of words hash into a fixed number of buckets. Two multinomials over the buckets, one of trusted
documents and one of all documents, give every document the mean of log(target / raw) over its n-grams. A document
passes if that mean is at least `threshold`; nothing is sampled when documents are judged.

Null text counts as empty; a document without words has ratio 0 and fails by its length. Repeated rows are judged
alike, an empty table gives an empty result, and columns of other names pass through untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from assayspark.llm.common import Shared
from assayspark.llm.words import SPACES, Words, as_bytes, mix, slices, text_sums, windows

SYMBOLS = b"#*$%&|<>"  # fixed values: the characters that count as symbols
CONTINUED = bytes(range(0x80, 0xC0))  # UTF-8 bytes that continue a code point


@dataclass(frozen=True)
class Ratio:
    """The fitted ratio: one log(target / raw) per bucket, 8 bytes each, so its size is fixed by `buckets`."""

    weights: np.ndarray
    threshold: float


def _buckets(words: Words, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text of every word and of every pair of neighbours in one text."""
    pair = words.left() >= 2
    grams = np.concatenate([mix(words.hash, 2), windows(words.hash, 2)[pair]])
    return (grams % np.uint64(buckets)).astype(np.int64), np.concatenate([words.owner, words.owner[pair]])


def fit_ratio(
    docs: DataFrame, trusted: DataFrame, doc_id: str = "doc_id", text: str = "text", buckets: int = 1 << 16,
    smoothing: float = 1.0, threshold: float = -0.1,
) -> Ratio:
    """Count n-grams of all documents (raw) and of all trusted ones (target), one pass.

    `trusted` has the ids of trusted documents. They meet the texts by a shuffle at every size, as they grow with the
    corpus. Each task adds up its counts before one shuffle of at most `buckets` rows a task; the driver gets `buckets` rows.
    """
    chosen = trusted.select(F.col(doc_id).alias("id")).where("id is not null").distinct().withColumn("trusted", F.lit(True))
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    rows = rows.join(chosen.hint("merge"), "id", "left").select(F.coalesce("trusted", F.lit(False)).alias("trusted"), "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, buckets), np.int64)
        for b in batches:
            trusted_row = np.array(b.column("trusted").to_pylist(), bool)
            for s, e in slices(b.column("text")):
                bucket, owner = _buckets(Words(b.column("text")[s:e]), buckets)
                total[0] += np.bincount(bucket, minlength=buckets)
                total[1] += np.bincount(bucket[trusted_row[s:e][owner]], minlength=buckets)
        used = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_pydict({"bucket": used.astype(np.int32), "raw": total[0][used], "target": total[1][used]})

    counted = rows.mapInArrow(count, "bucket int, raw long, target long")
    found = counted.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toPandas()
    raw, target = np.full(buckets, smoothing), np.full(buckets, smoothing)
    raw[found["bucket"]] += found["raw"]
    target[found["bucket"]] += found["target"]
    weights = np.log(target / target.sum()) - np.log(raw / raw.sum())
    if not found["target"].sum():
        weights[:] = 0.0  # nothing is trusted: the ratio says nothing
    return Ratio(weights, threshold)


def ratios(words: Words, weights: np.ndarray) -> np.ndarray:
    """The mean log ratio of each text's n-grams, 0 without words."""
    bucket, owner = _buckets(words, len(weights))
    n = np.bincount(owner, minlength=len(words))
    return text_sums(weights[bucket], owner, len(words)) / np.maximum(n, 1)


def repeated_words(words: Words, window: int = 3) -> np.ndarray:
    """For each text, its words that lie in a window of `window` words found at least twice in that text."""
    n = len(words.hash)
    whole = np.flatnonzero(words.left() >= window)
    with np.errstate(over="ignore"):
        key = mix(windows(words.hash, window)[whole] + mix(words.owner[whole], 5))  # windows of other texts differ
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(key), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    for k in range(window):
        covered[whole[twice] + k] = True
    return np.bincount(words.owner[covered], minlength=len(words))


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


MEASURED = {
    "n_words": pa.int64(), "word_chars": pa.int64(), "n_symbols": pa.int64(), "n_dup_lines": pa.int64(),
    "n_repeat_words": pa.int64(), "ratio": pa.float64(), "base_failed": pa.bool_(), "kept": pa.bool_(),
}


def judge(column: pa.Array, fitted: Ratio) -> pa.StructArray:
    """The statistics and verdicts of whole texts."""
    words, texts = Words(column), [as_bytes(x) for x in column.to_pylist()]
    n, repeats, lr = words.lengths(), repeated_words(words), ratios(words, fitted.weights)
    failed = (n < 50) | (100 * repeats > 50 * n)
    values = [
        n,
        [len(t.translate(None, SPACES + CONTINUED)) for t in texts],
        [len(t) - len(t.translate(None, SYMBOLS)) for t in texts],
        [repeated_lines(t) for t in texts],
        repeats,
        lr,
        failed,
        ~failed & (lr >= fitted.threshold),
    ]
    return pa.StructArray.from_arrays([pa.array(v, t) for v, t in zip(values, MEASURED.values())], list(MEASURED))


def measure(docs: DataFrame, ratio: Ratio, text: str = "text", into: str = "quality") -> DataFrame:
    """Add a struct column `into` with the statistics, the ratio and the verdicts of each row's whole text."""
    model = Shared(docs.sparkSession, ratio)

    @F.arrow_udf(from_arrow_schema(pa.schema(list(MEASURED.items()))))
    def judged(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        fitted = model.value
        for column in batches:
            yield pa.concat_arrays([judge(column[s:e], fitted) for s, e in slices(column)] or [judge(column, fitted)])

    return docs.withColumn(into, judged(F.col(text)))


def keep_good(docs: DataFrame, ratio: Ratio, text: str = "text") -> DataFrame:
    """The rows that pass, with their own columns."""
    into = "quality"
    while into in docs.columns:
        into += "_"
    return measure(docs, ratio, text, into).where(F.col(f"{into}.kept")).select(*docs.columns)
