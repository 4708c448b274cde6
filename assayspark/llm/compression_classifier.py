"""A quality classifier from compressed sizes: zstandard dictionaries of good and of bad labelled text.

A text is cut into blocks and each block is compressed with either dictionary. What the good dictionary saves against the
bad one, as a share of both sizes, is the difference; a logistic curve fitted on other labelled rows turns it into the
probability that the label is 1. The curve also sees the logarithm of the good size per byte and its square: text that
repeats itself leaves both dictionaries nothing to save, and only that number tells it from ordinary text.

Fitting reads a bounded sample of labelled rows: per label at most `per_label` rows, half for the dictionaries and half
for the curve, of each at most `sample_chars` characters from a seeded place. Scoring compresses every whole text.
Null text counts as empty; empty text has no difference and a size of one per byte. With one label only, or none,
the score is the share of good labels (0.5 without any). Empty tables give empty results; other columns pass through.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType

from assayspark.llm.common import Shared, bounded_ids, order_key
from assayspark.llm.words import bytes_of


@dataclass(frozen=True)
class Settings:
    per_label: int = 3000
    sample_chars: int = 8192
    dictionary_bytes: int = 1 << 16
    block: int = 4096
    level: int = 3


@dataclass(frozen=True)
class Classifier:
    """Two dictionaries of at most `dictionary_bytes` and the curve: intercept and slopes."""

    good: bytes
    bad: bytes
    raw: bool  # dictionaries of plain content, for samples too small to train on
    intercept: float
    slopes: tuple[float, float, float]
    settings: Settings


def _dictionaries(good: list[bytes], bad: list[bytes], settings: Settings) -> tuple[bytes, bytes, bool]:
    try:
        made = [zstandard.train_dictionary(settings.dictionary_bytes, s, level=settings.level, steps=4, d=8, k=256).as_bytes() for s in (good, bad)]
        return made[0], made[1], False
    except zstandard.ZstdError:
        return b"\n".join(good)[-settings.dictionary_bytes :], b"\n".join(bad)[-settings.dictionary_bytes :], True


class Sizes:
    """Compressed sizes inside a task."""

    def __init__(self, good: bytes, bad: bytes, raw: bool, settings: Settings):
        kind = zstandard.DICT_TYPE_RAWCONTENT if raw else zstandard.DICT_TYPE_FULLDICT
        self.block, self.compress = settings.block, []
        for content in (good, bad):
            d = zstandard.ZstdCompressionDict(content, dict_type=kind) if content else None
            if d:
                d.precompute_compress(settings.level)
            made = zstandard.ZstdCompressor(level=settings.level, dict_data=d, write_content_size=False, write_dict_id=False)
            self.compress.append(made.compress)

    def features(self, text: memoryview) -> tuple[float, float, float]:
        """(bad - good) / (bad + good) over all blocks, log(good / bytes) and its square."""
        good, bad = self.compress
        g = b = 0
        for at in range(0, len(text), self.block):
            part = text[at : at + self.block]
            g += len(good(part))
            b += len(bad(part))
        size = math.log((g + 1) / (len(text) + 1))
        return ((b - g) / (b + g) if g else 0.0), size, size * size


def _curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, tuple[float, ...]]:
    """Weighted logistic regression on standardised features with a small ridge, by Newton steps."""
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    rows = np.column_stack([np.ones(len(x)), (x - mean) / scale])
    beta, ridge = np.zeros(rows.shape[1]), 1e-3 * np.eye(rows.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(rows @ beta, -30, 30)))
        slope = rows.T @ (weight * (y - p)) - ridge @ beta
        bend = (rows * (weight * p * (1 - p))[:, None]).T @ rows + ridge
        step = np.clip(np.linalg.solve(bend, slope), -2, 2)
        beta = beta + step
        if np.abs(step).max() < 1e-9:
            break
    slopes = beta[1:] / scale
    return float(beta[0] - slopes @ mean), tuple(map(float, slopes))


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", settings: Settings = Settings()) -> Classifier:
    """Learn from `labels` (doc_id, label 0 or 1); the caller leaves out rows that are held out."""
    known = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("label")).where("id is not null and label in (0, 1)")
    shares = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    chosen = None
    for value in (0, 1):
        part = bounded_ids(known.where(F.col("label") == value), "id", settings.per_label, "compress").withColumn("label", F.lit(value))
        chosen = part if chosen is None else chosen.unionByName(part)
    n = settings.sample_chars
    spare = F.greatest(F.length("text") - n, F.lit(0)) + 1
    begin = (F.conv(F.substring(order_key("id", "begin"), 1, 8), 16, 10).cast("long") % spare + 1).cast("int")
    rows = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")).join(F.broadcast(chosen), "id")
    rows = rows.select("id", "label", F.col("text").substr(begin, F.lit(n)).alias("text"), order_key("id", "half").alias("place"))
    rows = rows.groupBy("id", "label", "place").agg(F.min("text").alias("text"))  # one row an id, however often it is there
    got = sorted(rows.collect(), key=lambda r: (r["place"], r["id"], r["text"]))
    by = {v: [r["text"].encode("utf-8", "surrogatepass") for r in got if r["label"] == v] for v in (0, 1)}
    total = sum(shares.values())
    if not by[0] or not by[1]:
        share = min(max(shares.get(1, 0) / total, 1e-3), 1 - 1e-3) if total else 0.5
        return Classifier(b"", b"", True, float(np.log(share / (1 - share))), (0.0, 0.0, 0.0), settings)
    good, bad, raw = _dictionaries([t for t in by[1][::2] if t], [t for t in by[0][::2] if t], settings)
    sizes = Sizes(good, bad, raw, settings)
    x, y, weight = [], [], []
    for value in (0, 1):
        rest = by[value][1::2] or by[value]
        x += [sizes.features(memoryview(t)) for t in rest]
        y += [value] * len(rest)
        weight += [shares[value] / len(rest)] * len(rest)  # the sample counts as much as its label does
    weight = np.array(weight) * len(x) / sum(weight)
    return Classifier(good, bad, raw, *_curve(np.array(x), np.array(y, float), weight), settings)


def score(docs: DataFrame, model: Classifier, text: str | Column = "text", into: str = "score") -> DataFrame:
    """Add the score, from 0 to 1, of each row's whole text."""
    shared = Shared(docs.sparkSession, model)

    @F.arrow_udf(DoubleType())
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = shared.value
        sizes = Sizes(m.good, m.bad, m.raw, m.settings)
        for column in batches:
            data, offs = bytes_of(column)
            view = memoryview(data)
            x = np.array([sizes.features(view[a:b]) for a, b in zip(offs[:-1], offs[1:])]).reshape(-1, 3)
            yield pa.array(1 / (1 + np.exp(-np.clip(m.intercept + x @ np.array(m.slopes), -500, 500))), pa.float64())

    return docs.withColumn(into, scored(F.col(text) if isinstance(text, str) else text))
