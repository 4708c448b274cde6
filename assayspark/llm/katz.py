"""Katz backoff language model: Good-Turing discounted n-gram counts and exactly normalised backoff weights.

Tokens are the lower-case words (A-Z only) of a text, then one end. P(w | h) is d * c(h, w) / c(h) where the n-gram was seen in
training, else alpha(h) * P(w | shorter h), down to single words; the mass that discounting frees at that level is the
one unknown word's. alpha(h) is what the seen words leave, over what the shorter history leaves outside them, so the
probabilities after every history add up to one over the training words, the end and the unknown word.

Data flow, per level one exchange: texts are read once into blocks of about `block_tokens` tokens. A block sends its distinct
n-grams, packed, to buckets by history; a bucket adds up counts, writes its part of the model's table, and sends each block
the counts of what it asked for and the sums of its histories. Every block then evaluates its tokens recursively. What
is sent is distinct per block, so a word or pair that makes up a third of all tokens is sent once a block; a history
with over a 200th of all tokens is dealt by history and word over all buckets and its sums, of under 200 such
histories, are added up and broadcast. Tables lie in the shared folder, partitioned by kind.

Words are known by 64-bit fingerprints. Null text counts as empty, which is the end alone. doc_id is an integer or
null; repeated rows are scored alike and train as often as they appear. Without training rows every score is 0. An
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from assayspark.llm.common import Shared
from assayspark.llm.packed import pack, unpack
from assayspark.llm.words import Words, mix, slices
from assayspark.session import discard, new_path, released

END, START, UNKNOWN = 0, -2, -1  # numbers of the end, of the place before a text, and of words not seen in training
TOKENS, ASKED, ANSWER, MODEL, HOT = range(5)  # kinds of rows
ROW = "to long, kind int, level int, source long, payload binary, sums array<double>"


@dataclass(frozen=True)
class Settings:
    order: int = 2
    cutoff: int = 5  # counts above it are not discounted
    block_tokens: int = 600_000
    hot: int = 200


@dataclass
class Level:
    """What tasks must know of a fitted level: a few numbers, and the sums of at most `hot` histories."""

    discounts: np.ndarray
    hot: dict[int, np.ndarray] = field(default_factory=dict)


def steps(history: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted n-grams as steps: from history to history, and from word to word within one history."""
    step = word.copy()
    same = history[1:] == history[:-1]
    step[1:][same] -= word[:-1][same]
    return np.diff(history, prepend=0), step


def walked(history: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of `steps`."""
    if not len(history):
        return history, word
    first = history != 0
    first[0] = True
    run = np.cumsum(word)
    base = (run - word)[first]
    return np.cumsum(history), run - base[np.cumsum(first) - 1]


def good_turing(times: np.ndarray, cutoff: int) -> np.ndarray:
    """Discounts of the counts 0 to `cutoff`, from how many n-grams have the counts 0 to `cutoff` + 1.

    Where the counts of counts give none between 0 and 1, as in very small or odd corpora, half a count is taken off.
    """
    d = np.ones(cutoff + 1)
    share = (cutoff + 1) * times[cutoff + 1] / times[1] if times[1] else 1.0
    for r in range(1, cutoff + 1):
        made = ((r + 1) * times[r + 1] / (r * times[r]) - share) / (1 - share) if times[r] and share < 1 else 0.0
        d[r] = made if 0 < made < 1 else 1 - 0.5 / r
    return d


def shares(sums: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Divisor and backoff weight of histories; sums: n-grams with the counts 1 to k, tokens of larger counts, lower probability of all seen."""
    k = len(d) - 1
    r = np.arange(1, k + 1)
    total = sums[:, :k] @ r + sums[:, k]
    seen = sums[:, :k] @ (r * d[1:]) + sums[:, k]
    below = 1 - sums[:, k + 1]
    free = total - seen
    divisor = np.where(free > 1e-9, total, total + 1)  # no count was small enough to discount: one more is set free
    free = divisor - seen
    full = below <= 1e-12  # every word was seen after it
    divisor = np.where(full, seen, divisor)
    with np.errstate(divide="ignore", invalid="ignore"):
        alpha = np.where(full, 0.0, free / divisor / below)
    none = total == 0
    return np.where(none, 1.0, divisor), np.where(none, 1.0, alpha)


def _rows(rows: list[tuple]) -> pa.Table:
    names = ["to", "kind", "level", "source", "payload", "sums"]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.list_(pa.float64())]
    columns = list(zip(*rows)) if rows else [[]] * 6
    return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], names)


def blocks(docs: DataFrame, buckets: int, settings: Settings) -> DataFrame:
    """Blocks of tokens, and the words that each asks for. docs: doc_id, text, train."""

    def made(parts: list[tuple], block: int) -> pa.Table:
        words = np.concatenate([p[0] for p in parts])
        lengths, train = np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts])
        ids, no_id = np.concatenate([p[3] for p in parts]), np.concatenate([p[4] for p in parts])
        known, local = np.unique(words, return_inverse=True)
        counts = np.bincount(local[np.repeat(train, lengths)], minlength=len(known))
        bucket = (mix(known, 3) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")  # the answers come back by bucket
        place = np.empty(len(known), np.int64)
        place[order] = np.arange(len(known))
        rows = [(block, TOKENS, 0, block, pack(place[local].astype(np.int32), lengths, train.astype(np.uint8), ids, no_id.astype(np.uint8)), None)]
        cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
        for b in np.flatnonzero(np.diff(cut)):
            own = order[cut[b] : cut[b + 1]]
            rows.append((int(b), ASKED, 1, block, pack(known[own], counts[own]), None))
        return _rows(rows)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, parts, tokens = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            ids, train = batch.column("doc_id"), np.array(batch.column("train").to_pylist(), bool)
            no_id = np.array(ids.is_null().to_pylist(), bool)
            numbers = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for s, e in slices(batch.column("text")):
                words = Words(batch.column("text")[s:e], lower=True)
                parts.append((words.hash, words.lengths(), train[s:e], numbers[s:e], no_id[s:e]))
                tokens += len(words.hash) + e - s
                if tokens >= settings.block_tokens:
                    yield from made(parts, block).to_batches()
                    block, parts, tokens = block + 1, [], 0
        if parts:
            yield from made(parts, block).to_batches()

    return docs.mapInArrow(read, ROW)


def _counted(buckets: int, settings: Settings, total: float):
    """Add up a bucket's n-grams. Level 1 asks (word, count), others (history, word, count, lower probability by code)."""
    k = settings.cutoff

    def reduce(group: pa.Table) -> pa.Table:
        asked = [unpack(p) for p in group.column("payload").to_pylist()]
        sources, level = group.column("source").to_pylist(), group.column("level")[0].as_py()
        bucket = group.column("to")[0].as_py()
        sizes = [len(a[0]) for a in asked]
        cuts = np.cumsum([0, *sizes])
        if level == 1:
            word, count = (np.concatenate([a[i] for a in asked]) for i in range(2))
            keys, index = np.unique(word, return_inverse=True)
        else:
            grams = [walked(a[0], a[1]) for a in asked]
            history, word = (np.concatenate([g[i] for g in grams]) for i in range(2))
            count = np.concatenate([a[2] for a in asked])
            lower = np.concatenate([a[3][a[4]] for a in asked])
            order = np.lexsort((word, history))
            new = np.ones(len(order), bool)
            new[1:] = (history[order][1:] != history[order][:-1]) | (word[order][1:] != word[order][:-1])
            index = np.empty(len(order), np.int64)
            index[order] = np.cumsum(new) - 1
            keys = order[new]
        counts = np.bincount(index, count, len(keys)).astype(np.int64)
        number = np.full(len(keys), UNKNOWN, np.int64)
        ranked = np.argsort(-counts, kind="stable")[: int((counts > 0).sum())]
        number[ranked] = np.arange(1, len(ranked) + 1) * buckets + bucket  # frequent n-grams have small numbers; 0 is the end
        rows = []
        small = np.bincount(np.minimum(counts, k + 2), minlength=k + 3)[: k + 2].astype(float)
        if level == 1:
            for at, source in enumerate(sources):
                own = index[cuts[at] : cuts[at + 1]]
                rows.append((source, ANSWER, 1, bucket, pack(number[own], counts[own]), None))
            model = pack(keys[ranked], number[ranked], counts[ranked])
        else:
            h, w, low = history[keys], word[keys], lower[keys]
            first = np.ones(len(h), bool)
            first[1:] = h[1:] != h[:-1]
            which = np.cumsum(first) - 1
            sums = np.zeros((int(first.sum()), k + 2))
            for r in range(1, k + 1):
                sums[:, r - 1] = np.bincount(which, counts == r, len(sums))
            sums[:, k] = np.bincount(which, np.where(counts > k, counts, 0), len(sums))
            sums[:, k + 1] = np.bincount(which, np.where(counts > 0, low, 0.0), len(sums))
            for at, source in enumerate(sources):
                own = index[cuts[at] : cuts[at + 1]]
                mine = which[own]
                begins = np.ones(len(mine), bool)
                begins[1:] = mine[1:] != mine[:-1]
                answer = [number[own]] if level < settings.order else [np.zeros(0, np.int64)]
                rows.append((source, ANSWER, level, bucket, pack(*answer, counts[own], *sums[mine[begins], : k + 1].astype(np.int64).T, sums[mine[begins], k + 1]), None))
            histories = h[first]
            for i in np.flatnonzero(np.isin(histories, list(hot_histories))):
                rows.append((int(histories[i]), HOT, level, bucket, None, sums[i].tolist()))
            seen = counts > 0
            model = pack(*steps(h[seen], w[seen]), counts[seen], *([number[seen]] if level < settings.order else []))
        rows.append((bucket, MODEL, level, bucket, model, [float(counts.sum()), float((counts > 0).sum()), *small[1:]]))
        return _rows(rows)

    hot_histories: set[int] = set()

    def with_hot(histories: set[int]):
        hot_histories.update(histories)
        return reduce

    return with_hot


class Block:
    """A block's tokens with what the buckets answered, level by level."""

    def __init__(self, group: pa.Table, levels: list[Level], known: dict, settings: Settings, buckets: int):
        self.settings, self.buckets, self.levels, self.known = settings, buckets, levels, known
        self.answers: dict[int, dict[int, list[np.ndarray]]] = {}
        for kind, level, source, payload in zip(*(group.column(c).to_pylist() for c in ("kind", "level", "source", "payload"))):
            if kind == TOKENS:
                self.number = source
                local, lengths, train, self.ids, self.no_id = unpack(payload)
            else:
                self.answers.setdefault(level, {})[source] = unpack(payload)
        got = [self.answers.get(1, {})[b] for b in sorted(self.answers.get(1, {}))]
        number = np.concatenate([np.zeros(0, np.int64), *[g[0] for g in got]])[local]
        count = np.concatenate([np.zeros(0, np.int64), *[g[1] for g in got]])[local]
        n = len(lengths)
        ends = np.cumsum(lengths + 1) - 1
        self.owner = np.repeat(np.arange(n), lengths + 1)
        is_end = np.zeros(len(self.owner), bool)
        is_end[ends] = True
        self.word, self.count = np.full(len(is_end), END, np.int64), np.full(len(is_end), known["ends"], np.int64)
        self.word[~is_end], self.count[~is_end] = number, count
        self.train = train.astype(bool)[self.owner]
        self.begins = ends - lengths
        d = levels[0].discounts
        divisor, unknown = known["divisor"], known["unknown"]
        c = self.count
        self.p = np.where(c > 0, np.where(c < len(d), d[np.minimum(c, len(d) - 1)], 1.0) * c / divisor, unknown)
        self.log = np.log10(self.p)
        # the history of level 2 is the word before
        self.history = np.concatenate([[START], self.word[:-1]]) if len(self.word) else self.word
        self.weight = np.concatenate([[known["ends"]], self.count[:-1]]) if len(self.word) else self.count
        self.history[self.begins], self.weight[self.begins] = START, known["ends"]

    def grams(self) -> tuple[np.ndarray, ...]:
        """The distinct (history, word) of tokens whose history was seen, by bucket, and each token's place among them."""
        at = np.flatnonzero((self.history != UNKNOWN) & (self.weight > 0))
        h, w = self.history[at], self.word[at]
        hot = self.weight[at] * self.settings.hot > self.known["tokens"]
        with np.errstate(over="ignore"):
            spread = mix(h, 4) + np.where(hot, mix(w, 5), np.uint64(0))
        bucket = (mix(spread, 6) % np.uint64(self.buckets)).astype(np.int64)
        order = np.lexsort((w, h, bucket))
        new = np.ones(len(order), bool)
        new[1:] = (h[order][1:] != h[order][:-1]) | (w[order][1:] != w[order][:-1])
        place = np.empty(len(order), np.int64)
        place[order] = np.cumsum(new) - 1
        return at, place, order[new], bucket[order[new]]

    def ask(self, level: int) -> pa.Table:
        at, place, first, bucket = self.grams()
        count = np.bincount(place[self.train[at]], minlength=len(first))
        h, w, low = self.history[at][first], self.word[at][first], self.p[at][first]
        cut, rows = np.searchsorted(bucket, np.arange(self.buckets + 1)), []
        for b in np.flatnonzero(np.diff(cut)):
            own = slice(cut[b], cut[b + 1])
            values, code = np.unique(low[own], return_inverse=True)  # few probabilities, many n-grams
            rows.append((int(b), ASKED, level, self.number, pack(*steps(h[own], w[own]), count[own], values, code.astype(np.int32)), None))
        return _rows(rows)

    def climb(self, level: int) -> None:
        """From the probabilities of the level below to this one's."""
        at, place, first, bucket = self.grams()
        got = [self.answers.get(level, {})[b] for b in sorted(self.answers.get(level, {}))]
        d, k = self.levels[level - 1].discounts, self.settings.cutoff
        counts = np.concatenate([np.zeros(0, np.int64), *[g[1] for g in got]])
        h = self.history[at][first]
        begins = np.ones(len(h), bool)
        begins[1:] = (h[1:] != h[:-1]) | (bucket[1:] != bucket[:-1])
        sums = np.concatenate([np.zeros((0, k + 2)), *[np.stack(g[2:], 1) for g in got if len(g[2])]])
        hot, own = self.levels[level - 1].hot, h[begins]
        for i in np.flatnonzero(np.isin(own, list(hot))):
            sums[i] = hot[int(own[i])]
        divisor, alpha = (x[np.cumsum(begins) - 1] for x in shares(sums, d))
        c = counts[place]
        discounted = np.where(c < len(d), d[np.minimum(c, len(d) - 1)], 1.0) * c / divisor[place]
        with np.errstate(divide="ignore"):
            self.p[at] = np.where(c > 0, discounted, alpha[place] * self.p[at])
            self.log[at] = np.log10(self.p[at])
        if level < self.settings.order:  # histories of the next level: the n-gram that ends one token before
            numbers = np.concatenate([np.zeros(0, np.int64), *[g[0] for g in got]])
            gram, weight = np.full(len(self.word), UNKNOWN, np.int64), np.zeros(len(self.word), np.int64)
            gram[at], weight[at] = numbers[place], c
            self.history, self.weight = np.concatenate([[UNKNOWN], gram[:-1]]), np.concatenate([[0], weight[:-1]])
            self.history[self.begins], self.weight[self.begins] = UNKNOWN, 0  # only one token is before a text

    def scores(self) -> pa.Table:
        n = len(self.ids)
        total, vocabulary = self.known["tokens"], self.known["vocabulary"]
        base = np.log10((self.count + 1) / (total + vocabulary + 1))
        return pa.table({
            "doc_id": pa.array(self.ids, pa.int64(), mask=self.no_id.astype(bool)),
            "n_tokens": np.bincount(self.owner, minlength=n),
            "n_known": np.bincount(self.owner[self.count > 0], minlength=n),
            "train_tokens": np.full(n, total, np.int64),
            "base_score": np.bincount(self.owner, base, n),
            "score": np.bincount(self.owner, self.log, n),
        })


def _stored(df: DataFrame, path: str) -> DataFrame:
    with released(df.sparkSession):
        df.write.partitionBy("kind", "level").parquet(path)
    return df.sparkSession.read.schema(ROW).parquet(path)


def score(docs: DataFrame, train: Column, doc_id: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score of every row; the model learns from rows where `train` holds."""
    spark: SparkSession = docs.sparkSession
    buckets = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), F.coalesce(train, F.lit(False)).alias("train"))
    path = new_path(spark, "katz-blocks")
    made = _stored(blocks(rows, buckets, settings), path)
    ends = docs.where(train).count()
    k, levels, known = settings.cutoff, [], {"ends": ends}
    held, asked = [made.where(F.col("kind") == TOKENS)], made.where(F.col("kind") == ASKED)
    hot: set[int] = set()
    for level in range(1, settings.order + 1):
        reduce = _counted(buckets, settings, float(known.get("tokens", 0)))(hot)
        table = _stored(asked.groupBy("to").applyInArrow(reduce, ROW), new_path(spark, f"katz-level{level}"))
        if level == 1:
            discard(spark, f"{path}/kind={ASKED}")  # answered
        stats = table.where(F.col("kind") == MODEL).select(F.posexplode("sums").alias("at", "n")).groupBy("at").agg(F.sum("n").alias("n"))
        found = np.zeros(k + 3)
        for r in stats.collect():  # k + 3 numbers
            found[r["at"]] = r["n"]
        times = np.concatenate([[0], found[2:]])
        if level == 1:
            times[ends if 0 < ends <= k + 1 else 0] += 1  # the end is a token like others
            tokens, vocabulary = found[0] + ends, found[1] + (ends > 0)
            d = good_turing(times, k)
            sums = np.array([[*times[1 : k + 1], tokens - times[1 : k + 1] @ np.arange(1, k + 1), 0.0]])
            divisor, unknown = shares(sums, d)
            known |= {"tokens": int(tokens), "vocabulary": int(vocabulary), "divisor": float(divisor[0]), "unknown": float(unknown[0]) if tokens else 1.0}
            levels.append(Level(d))
        else:
            heavy = table.where(F.col("kind") == HOT).select("to", F.posexplode("sums").alias("at", "n")).groupBy("to", "at").agg(F.sum("n").alias("n"))
            sums_of: dict[int, np.ndarray] = {}
            for r in heavy.collect():  # under `hot` histories, k + 2 numbers each
                sums_of.setdefault(r["to"], np.zeros(k + 2))[r["at"]] = r["n"]
            levels.append(Level(good_turing(times, k), sums_of))
        held.append(table.where(F.col("kind") == ANSWER))
        together = held[0]
        for part in held[1:]:
            together = together.unionByName(part)
        together = together.drop("sums")
        state = Shared(spark, (list(levels), dict(known)))
        if level < settings.order:
            hot = _hot_histories(table, level, known, settings)

            asked = together.groupBy("to").applyInArrow(_after(level, state, settings, buckets, ask=True), ROW)
    finish = _after(settings.order, state, settings, buckets, ask=False)
    return together.groupBy("to").applyInArrow(finish, "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def _after(level: int, state: Shared, settings: Settings, buckets: int, ask: bool):
    """What a block does once `level` is answered: ask for the next one, or score its texts."""

    def run(group: pa.Table) -> pa.Table:
        block = Block(group, *state.value, settings, buckets)
        for below in range(2, level + 1):
            block.climb(below)
        return block.ask(level + 1) if ask else block.scores()

    return run


def _hot_histories(table: DataFrame, level: int, known: dict, settings: Settings) -> set[int]:
    """Numbers of n-grams that make up over 1 / `hot` of the tokens: fewer than `hot`, found in the model's table."""

    def heavy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for payload in batch.column("payload").to_pylist():
                arrays = unpack(payload)
                number, count = (arrays[1], arrays[2]) if level == 1 else (arrays[3], arrays[2])
                yield pa.RecordBatch.from_pydict({"number": pa.array(number[count * settings.hot > known["tokens"]], pa.int64())})

    found = table.where((F.col("kind") == MODEL) & (F.col("level") == level)).select("payload").mapInArrow(heavy, "number long")
    hot = {r["number"] for r in found.collect()}
    if level == 1 and known["ends"] * settings.hot > known["tokens"]:
        hot |= {START}
    return hot
