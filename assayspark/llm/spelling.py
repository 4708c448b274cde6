"""Spelling variants of the words of a corpus, found by a search scheme over bidirectional FM-indexes.

Two words at one insertion, deletion or replacement from each other agree on all of one half. The scheme has two searches:
match the first half exactly and extend to the right with one error, or match the second half and extend to the left; the
second is the first over reversed words. A search keeps the suffix-rank intervals of its pattern in an index of the delimited
vocabulary and in one of its reversal in step, so it grows in either direction: from the half's last letter back to the
delimiter before it, then over the other half to the delimiter after it.

Words are dealt into shards by side, length and as many first letters as any half that could match them has (at least
three); a word asks the shards of its own length and of one more and one less. Each task builds the index of a bounded part
of the shards, and shards of more words than one part are cut into parts that each get all questions, so nothing depends on
how words share beginnings. Every near pair is found by exactly one search in one part, and what leaves a task is a row a word.

Runs are counted over whole texts. Null text has no words, a null doc_id counts as empty text in the hash, repeated rows
count every time, an empty table gives no rows, other columns are ignored. Of near words alike in count the smallest in
code-point order is the form.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from assayspark.llm.words import slices
from assayspark.session import settle

LEAST = 7  # code points of a word
PART = 20_000  # words of one index
KEPT = 200_000  # words that a task counts before it hands them on
TOGETHER = 8_192  # questions that are searched side by side


def counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", every: int = 31) -> DataFrame:
    """word, n: runs of letters of at least `LEAST` code points after lower-casing A-Z; of runs whose hash `every` divides, one letter goes."""
    runs = re.compile("[A-Za-zÀ-ÿ]{%d,}" % LEAST)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(known.keys(), pa.string()), pa.array(known.values(), pa.int64())], ["word", "n"])
            known.clear()
            return out

        known: Counter[str] = Counter()
        for batch in batches:
            for start, end in slices(batch.column(1), 1 << 20):
                for own, content in zip(batch.column(0)[start:end].to_pylist(), batch.column(1)[start:end].to_pylist()):
                    seed = zlib.crc32(f"{own or ''}:".encode())
                    for run, n in Counter(runs.findall((content or "").encode().lower().decode())).items():
                        h = zlib.crc32(run.encode(), seed)
                        if h % every == 0:
                            gone = h % len(run)
                            run = run[:gone] + run[gone + 1 :]
                            if len(run) < LEAST:
                                continue
                        known[run] += n
                    if len(known) > KEPT:
                        yield rows()
        yield rows()

    found = docs.select(F.col(doc_id).cast("string").alias("doc_id"), F.col(text).alias("text")).mapInArrow(count, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


class Ranks:
    """A wavelet matrix: how many of the symbols before a place are smaller than, or equal to, a given one."""

    def __init__(self, symbols: np.ndarray, size: int):
        self.shifts = range(max(1, int(size - 1).bit_length()))[::-1]
        self.ones, self.zeros = [], []
        for shift in self.shifts:
            bits = (symbols >> shift) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bits)]).astype(np.int32))
            self.zeros.append(int(len(bits) - bits.sum()))
            symbols = np.concatenate([symbols[bits == 0], symbols[bits == 1]])
        first = np.cumsum(np.bincount(symbols, minlength=size)) - np.bincount(symbols, minlength=size)
        start = self._down(np.zeros(size, np.int64), np.zeros(size, np.int64), np.arange(size))[0]
        self.shift_to = first - start  # from places in the lowest level to suffix ranks

    def _down(self, lo: np.ndarray, hi: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        less = np.zeros(len(lo), np.int64)
        for shift, ones, zeros in zip(self.shifts, self.ones, self.zeros):
            up = ((symbol >> shift) & 1).astype(bool)
            a, b = ones[lo], ones[hi]
            less += np.where(up, (hi - b) - (lo - a), 0)
            lo, hi = np.where(up, zeros + a, lo - a), np.where(up, zeros + b, hi - b)
        return lo, hi, less

    def extend(self, lo: np.ndarray, size: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The interval of each pattern with a symbol more: (first rank, size, how many rows have a smaller symbol there)."""
        a, b, less = self._down(lo, lo + size, symbol)
        return a + self.shift_to[symbol], b - a, less

    def children(self, lo: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All symbols that occur: (number of the pattern, symbol, first rank, size, less)."""
        of, hi, symbol, less = np.arange(len(lo)), lo + size, np.zeros(len(lo), np.int64), np.zeros(len(lo), np.int64)
        for shift, ones, zeros in zip(self.shifts, self.ones, self.zeros):
            a, b = ones[lo], ones[hi]
            low = (hi - b) - (lo - a)
            at0, at1 = np.flatnonzero(low > 0), np.flatnonzero(b > a)
            of = np.concatenate([of[at0], of[at1]])
            symbol = np.concatenate([symbol[at0], symbol[at1] | 1 << shift])
            less = np.concatenate([less[at0], less[at1] + low[at1]])
            lo, hi = np.concatenate([(lo - a)[at0], (zeros + a)[at1]]), np.concatenate([(hi - b)[at0], (zeros + b)[at1]])
        return of, symbol, lo + self.shift_to[symbol], hi - lo, less


def suffix_order(symbols: np.ndarray, size: int) -> np.ndarray:
    """The rotations of the text in order: by their first symbols packed into one number, then by doubling."""
    n, bits = len(symbols), max(1, int(size - 1).bit_length())
    length = 62 // bits
    key = np.zeros(n, np.int64)
    for i in range(length):
        key = key << bits | np.roll(symbols, -i)
    while True:
        order = np.argsort(key, kind="stable")
        new = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
        if new[-1] == n - 1:
            return order
        rank = np.empty(n, np.int64)
        rank[order] = new
        key, length = rank * n + np.roll(rank, -length), 2 * length


class Index:
    """A bidirectional FM-index of distinct words, each between delimiters; words are Latin-1 bytes in order."""

    def __init__(self, words: list[bytes]):
        raw = np.frombuffer(b"\x00" + b"\x00".join(words), np.uint8)
        known = np.unique(raw)
        self.code = np.full(256, -1, np.int64)
        self.code[known] = np.arange(len(known))
        text = self.code[raw]
        self.length = len(text)
        self.order = suffix_order(text, len(known))
        self.left = Ranks(text[self.order - 1], len(known))
        back = text[::-1]
        self.right = Ranks(back[suffix_order(back, len(known)) - 1], len(known))
        self.word_at = np.cumsum(text == 0) - 1

    def near(self, words: list[bytes], halves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(question, word of the index) of all pairs that agree on the first `halves` letters and differ by one error after them."""
        raw = self.code[np.frombuffer(b"".join(words), np.uint8)] if words else np.zeros(0, np.int64)
        sizes = np.array([len(w) for w in words], np.int64)
        letters = np.append(raw, -2)  # what ends the last word
        begin = np.cumsum(sizes) - sizes
        # the first half, from its last letter to the delimiter before it
        q, at = np.arange(len(words)), halves - 1
        f, r, n = np.zeros(len(q), np.int64), np.zeros(len(q), np.int64), np.full(len(q), self.length, np.int64)
        matched = []
        while len(q):
            c = np.where(at >= 0, letters[begin[q] + np.maximum(at, 0)], 0)
            ok = c >= 0
            q, at, f, r, n, c = q[ok], at[ok], f[ok], r[ok], n[ok], c[ok]
            f, n, less = self.left.extend(f, n, c)
            r, at = r + less, at - 1
            over = (at < -1) & (n > 0)
            matched.append((q[over], f[over], r[over], n[over]))
            go = (at >= -1) & (n > 0)
            q, at, f, r, n = q[go], at[go], f[go], r[go], n[go]
        if not matched:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        q, f, r, n = (np.concatenate(x) for x in zip(*matched))
        at = halves[q]
        # the other half: patterns without an error so far, and patterns (e...) that have had theirs
        e = tuple(np.zeros(0, np.int64) for _ in range(5))
        found = []
        while len(q) or len(e[0]):
            if len(q):
                inside = at < sizes[q]
                want = np.where(inside, letters[begin[q] + at], -2)
                after = np.where(at + 1 < sizes[q], letters[np.minimum(begin[q] + at + 1, len(raw))], -2)
                of, c, r2, n2, less = self.right.children(r, n)
                f2 = f[of] + less
                wrong = (c != want[of]) & (c > 0)
                swap = wrong & inside[of]
                gone = np.flatnonzero(inside & (after != want))  # of a run of equal letters the last goes, so each word is met once
                e = tuple(
                    np.concatenate(x)
                    for x in zip(
                        e,
                        (q[of[wrong]], f2[wrong], r2[wrong], n2[wrong], at[of[wrong]]),
                        (q[of[swap]], f2[swap], r2[swap], n2[swap], at[of[swap]] + 1),
                        (q[gone], f[gone], r[gone], n[gone], at[gone] + 1),
                    )
                )
                right = (c == want[of]) & inside[of]
                q, f, r, n, at = q[of[right]], f2[right], r2[right], n2[right], at[of[right]] + 1
            eq, ef, er, en, ea = e
            inside = ea < sizes[eq]
            c = np.where(inside, letters[np.minimum(begin[eq] + ea, len(raw))], 0)
            ok = c >= 0
            eq, ef, er, en, ea, c, inside = eq[ok], ef[ok], er[ok], en[ok], ea[ok], c[ok], inside[ok]
            er, en, less = self.right.extend(er, en, c)
            ef = ef + less
            over = ~inside & (en > 0)
            found.append((eq[over], self.word_at[self.order[ef[over]]]))
            go = inside & (en > 0)
            e = (eq[go], ef[go], er[go], en[go], ea[go] + 1)
        return tuple(np.concatenate(x) for x in zip(*found))


def search(part: pa.Table) -> pa.Table:
    """The near words of each question of one part: word, n_near, best_n, best (largest n, then first in code-point order)."""
    side = part.column("side")[0].as_py()
    asks = np.array(part.column("asks").to_pylist(), bool)
    spelled, n = part.column("spelled").to_pylist(), np.array(part.column("n").to_pylist(), np.int64)
    held = sorted((spelled[i].encode("latin-1"), int(n[i])) for i in np.flatnonzero(~asks))
    asked = sorted({spelled[i].encode("latin-1") for i in np.flatnonzero(asks)})
    best: dict[bytes, list] = {}
    if held:
        index = Index([w for w, _ in held])
        for start in range(0, len(asked), TOGETHER):
            some = asked[start : start + TOGETHER]
            first = np.array([len(w) // 2 if side == 0 else len(w) - len(w) // 2 for w in some], np.int64)
            for i, j in zip(*(x.tolist() for x in index.near(some, first))):
                w, (v, count) = some[i], held[j]
                half = len(w) // 2
                if side and w[len(w) - half :] == v[len(v) - half :]:
                    continue  # the first half agrees too: the other side has this pair
                v = v[::-1] if side else v
                known = best.setdefault(w, [0, 0, b""])
                known[0] += 1
                if (-count, v) < (-known[1], known[2]):
                    known[1:] = [count, v]
    names = [(w[::-1] if side else w).decode("latin-1") for w in best]
    return pa.table(
        {
            "word": pa.array(names, pa.string()),
            "n_near": pa.array([x[0] for x in best.values()], pa.int64()),
            "best_n": pa.array([x[1] for x in best.values()], pa.int64()),
            "best": pa.array([x[2].decode("latin-1") for x in best.values()], pa.string()),
        }
    )


def near_words(words: DataFrame, part: int = PART) -> DataFrame:
    """word, n_near, best_n, best of each word that has near ones. `words` (word, n) must be distinct Latin-1 words."""
    total = words.count()
    sides = F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("word").alias("spelled")), F.struct(F.lit(1).alias("side"), F.reverse("word").alias("spelled")))).alias("both")
    rows = words.select("n", sides).select("both.side", "both.spelled", "n", F.length("both.spelled").alias("size"))
    shard = F.xxhash64("side", "size", F.expr("substring(spelled, 1, div(size - 1, 2))"))
    held = rows.select("side", "spelled", "n", F.lit(False).alias("asks"), shard.alias("shard"))
    asks = rows.withColumn("size", F.explode(F.array(F.col("size") - 1, F.col("size"), F.col("size") + 1)))
    asks = asks.select("side", "spelled", "n", F.lit(True).alias("asks"), shard.alias("shard"))
    # shards of more words than one index takes are cut; every cut gets all that is asked of the shard
    large = held.groupBy("shard").count().where(F.col("count") > part).select("shard", (F.floor(F.col("count") / part) + 1).alias("cuts"))
    large = settle(large, "spelling-large")
    held = held.join(large, "shard", "left").withColumn("cut", F.expr("pmod(xxhash64(spelled), coalesce(cuts, 1))"))
    asks = asks.join(large, "shard", "left").withColumn("cut", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("cuts", F.lit(1)) - 1)))
    parts = 2 * total // part + 1
    both = held.unionByName(asks).withColumn("part", F.pmod(F.xxhash64("shard", "cut"), F.lit(parts)))
    found = both.select("side", "part", "asks", "spelled", "n").groupBy("side", "part").applyInArrow(search, "word string, n_near long, best_n long, best string")
    first = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("word")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), first.alias("first")).select("word", "n_near", (-F.col("first.less")).alias("best_n"), F.col("first.word").alias("best"))


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = 2, times: int = 10, part: int = PART) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word that occurs at least `least` times; a form occurs `times` as often."""
    words = settle(counts(docs, doc_id, text).where(F.col("n") >= least), "spelling-words")
    rows = words.join(near_words(words, part), "word", "left").withColumn("formed", F.col("best_n") >= F.col("n") * times)
    form = lambda c: F.when(F.col("formed"), F.col(c))
    rows = settle(rows.select("word", form("best").alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), form("best_n").alias("form_n")), "spelling-forms")
    # every step multiplies n, so a chain of forms is short: doubling ends once all pointers stand at words without a form
    steps = settle(rows.where("form is not null").select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        steps = settle(steps.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        if steps.where("moved").isEmpty():
            break
        steps = steps.drop("moved")
    return rows.join(steps.select("word", "root"), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
