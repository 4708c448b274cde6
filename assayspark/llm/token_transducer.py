"""Token counts by compiled finite-state transducers, without making the tokens.

Two deterministic transducers read a text. The first reads classes of characters and emits where pre-tokens begin; it has a
dozen states, is compiled whole, and runs over all chunks of a batch side by side: each chunk gives its map from entry state
to exit state, a parallel prefix scan composes the maps, and so every chunk's true entry state is known. The second reads
bytes and emits numbers of tokens. Its states are the ways in which what was read can still be cut into tokens: the last
token, the place in the vocabulary's trie, and how many tokens more than in the shortest way. Two tokens may stand side by
side only if no merge would cross their border, so at most one way survives a whole pre-token. These states are made when
first met, which changes nothing in results; they start anew at every pre-token, so lanes that begin at pre-tokens run side
by side and their counts are summed by text.

Counts are those of a byte-level BPE file of the `tokenizers` library at its defaults: added tokens in a text count as one
and cut it. Null text counts like empty text: no bytes, no tokens. Repeated rows count alike, an empty table gives an empty
result, other columns pass through untouched. Texts are read whole; one pre-token of any length is one lane.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from assayspark.llm.common import Shared
from assayspark.llm.words import bytes_of, slices

CHUNK = 128  # characters of a chunk of the first transducer
LANE = 256  # bytes after which a lane of the second ends at the next pre-token
AHEAD = 32  # tokens that a node may still become if ways there are to be told apart by what can follow
FEW = 24  # lanes left over are followed one by one
NEVER = 1 << 60  # the rank of a merge that doesn't exist
MOST_STATES = 1 << 16  # states that a task remembers before it starts anew: a bound on memory, not on results

# Classes of characters. Fixed values of the pre-token pattern: the contractions are 's 't 're 've 'm 'll 'd.
CLASSES = "letter number space blank other quote end s r v l e".split()
LETTER, NUMBER, SPACE, BLANK, OTHER, QUOTE, END = range(7)
BY_LETTER = {"s": 7, "t": 7, "m": 7, "d": 7, "r": 8, "v": 9, "l": 10, "e": 11}
COMPLETED_BY = {"r": 11, "v": 11, "l": 10}  # the letter's class that completes a contraction of two letters
STATES = "start letters numbers others space blank spaces blanks quote r v l".split()


@dataclass(frozen=True)
class Vocabulary:
    """What tasks need: classes of all characters, tokens, merges as (left, right) -> made in the order of rank, added tokens."""

    classes: np.ndarray
    tokens: list[bytes]
    merges: list[tuple[int, int, int]]
    added: list[str]


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level files: printable bytes for themselves, the others from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def character_classes() -> np.ndarray:
    """The class of every code point, told apart by the library's own pattern engine, whose Unicode tables decide."""
    from tokenizers import Regex, normalizers

    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    found = np.full(0x110000, BLANK, np.uint8)
    for start in range(0, len(every), 1 << 14):
        some = "".join(every[start : start + (1 << 14)])
        for kind, others in ((LETTER, r"\P{L}"), (NUMBER, r"\P{N}"), (OTHER, r"[\s\p{L}\p{N}]")):
            kept = normalizers.Replace(Regex(others), "").normalize_str(some)
            found[np.frombuffer(kept.encode("utf-32-le"), np.uint32)] = kind
    found[ord(" ")], found[ord("'")] = SPACE, QUOTE
    for letter, kind in BY_LETTER.items():
        found[ord(letter)] = kind
    return found


def load(path: str) -> Vocabulary:
    """Read a byte-level BPE file of the `tokenizers` library on the driver; what the transducers don't cover is refused."""
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    model, before = file["model"], file["pre_tokenizer"]
    plain = model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
    if not plain or file["normalizer"] or before["type"] != "ByteLevel" or before["add_prefix_space"] or not before.get("use_regex", True):
        raise ValueError(f"not a plain byte-level BPE file: {path}")
    added = file["added_tokens"]
    if any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError(f"added tokens that look at their surroundings: {path}")
    letters = byte_letters()
    special = {t["content"] for t in added}
    tokens = [b""] * (max(model["vocab"].values()) + 1)
    for token, i in model["vocab"].items():
        tokens[i] = b"" if token in special else bytes(letters[c] for c in token)
    merges = []
    for pair in model["merges"]:
        left, right = pair if isinstance(pair, list) else pair.split(" ")
        merges.append((model["vocab"][left], model["vocab"][right], model["vocab"][left + right]))
    if len({made for _, _, made in merges}) < len(merges):
        raise ValueError(f"a token with two merges: {path}")
    return Vocabulary(character_classes(), tokens, merges, [t["content"] for t in added])


def begin_machine() -> tuple[np.ndarray, np.ndarray]:
    """The first transducer: next state, and what a character says of beginnings (1: one at it, 2: one at the character before)."""
    number = {s: i for i, s in enumerate(STATES)}
    runs = {"letters": {LETTER, 7, 8, 9, 10, 11}, "numbers": {NUMBER}, "others": {OTHER, QUOTE}}
    run_of = {c: s for s, kinds in runs.items() for c in kinds}

    def fresh(c: int) -> tuple[str, int]:
        """A pre-token begins at the character."""
        if c == END:
            return "start", 0
        return {SPACE: "space", BLANK: "blank", QUOTE: "quote"}.get(c, run_of.get(c)), 1

    def read(state: str, c: int) -> tuple[str, int]:
        if state in runs:
            return (state, 0) if c in runs[state] else fresh(c)
        if state in ("space", "blank", "spaces", "blanks"):
            if c in (SPACE, BLANK):
                return ("spaces" if c == SPACE else "blanks"), 0
            if c == END:
                return "start", 0
            cut = 2 if state in ("spaces", "blanks") else 0  # of several blanks the last stands apart
            if state in ("space", "spaces"):
                return run_of[c], cut  # and a space goes with what follows
            after, said = fresh(c)
            return after, cut | said
        if state == "quote":
            if c == 7:
                return "start", 0
            if c in (8, 9, 10):
                return {8: "r", 9: "v", 10: "l"}[c], 0
            return ("others", 0) if c in runs["others"] else fresh(c)
        if state in COMPLETED_BY:
            if c == COMPLETED_BY[state]:
                return "start", 0
            after, said = read("letters", c)  # no contraction: the quote stood alone, letters began after it
            return after, said | 2
        return fresh(c)

    table = [[read(s, c) for c in range(len(CLASSES))] for s in STATES]
    return np.array([[number[s] for s, _ in row] for row in table], np.int64), np.array([[e for _, e in row] for row in table], np.uint8)


def beginnings(classes: np.ndarray, machine: tuple[np.ndarray, np.ndarray], chunk: int = CHUNK) -> np.ndarray:
    """Which characters begin a pre-token. Texts follow one another, each closed by END; the last class is END."""
    after, says = (t.ravel() for t in machine)
    kinds = len(CLASSES)
    lanes = -(-len(classes) // chunk)
    read = np.full(lanes * chunk, END, np.uint8)
    read[: len(classes)] = classes
    read = np.ascontiguousarray(read.reshape(lanes, chunk).T)
    # the map of each chunk; once all entry states of all chunks have met, one column says it
    maps = np.tile(np.arange(len(STATES)), (lanes, 1))
    for t in range(chunk):
        maps = after[maps * kinds + read[t][:, None]]
        if t % 8 == 7 and maps.shape[1] > 1 and (maps == maps[:, :1]).all():
            maps = maps[:, :1]
    maps = np.broadcast_to(maps, (lanes, len(STATES))).copy()
    step = 1
    while step < lanes:  # the scan: each map follows that of `step` chunks before
        maps[step:] = np.take_along_axis(maps[step:], maps[:-step].copy(), axis=1)
        step *= 2
    state = np.concatenate([[0], maps[:-1, 0]])
    said = np.empty((chunk, lanes), np.uint8)
    for t in range(chunk):
        at = state * kinds + read[t]
        said[t], state = says[at], after[at]
    said = said.T.ravel()[: len(classes)]
    out = (said & 1).astype(bool)
    out[:-1] |= said[1:] > 1
    return out


class Counter:
    """The second transducer, with its states made when first met. The driver sends it to tasks with the first state alone."""

    def __init__(self, vocabulary: Vocabulary):
        self.machine, self.classes = begin_machine(), vocabulary.classes
        self.added = re.compile("|".join(map(re.escape, sorted(vocabulary.added, key=len, reverse=True)))) if vocabulary.added else None
        self.merged: dict[int, dict[int, int]] = {}  # left part -> right part -> rank
        for i, (a, b, _) in enumerate(vocabulary.merges):
            self.merged.setdefault(a, {})[b] = i
        self.parts = {made: (a, b, i) for i, (a, b, made) in enumerate(vocabulary.merges)}
        self.rights = [self._edges(i, True) for i in range(len(vocabulary.tokens))]
        self.lefts = [self._edges(i, False) for i in range(len(vocabulary.tokens))]
        self.step: dict[int, int] = {}  # node << 8 | byte -> node of the trie, 0 the root
        self.token = [-1]
        for i, t in enumerate(vocabulary.tokens):
            if t and self._whole(i):
                node = 0
                for b in t:
                    child = self.step.get(node << 8 | b)
                    if child is None:
                        child = self.step[node << 8 | b] = len(self.token)
                        self.token.append(-1)
                    node = child
                self.token[node] = i
        self._ahead()
        self.forget()

    def _ahead(self) -> None:
        """The tokens that a node of the trie can still become, where they are few."""
        below: list[list[int] | None] = [[] if t < 0 else [t] for t in self.token]
        for at in reversed(self.step):  # children are made after their parents
            up, child = at >> 8, self.step[at]
            if up and below[up] is not None:
                both = below[child]
                below[up] = None if both is None or len(both) + len(below[up]) > AHEAD else below[up] + both
        below[0] = None
        self.below = below
        self.open: dict[tuple[int, int], int | None] = {}
        self.alike: dict[tuple[int, tuple[int, ...]], int] = {}

    def _seen_from(self, last: int, node: int) -> int | None:
        """What of the last token matters at a node: None if nothing can follow there, -1 if all can, else one token for all
        that let the same follow."""
        known = self.open.get((last, node), 0)
        if known == 0:
            follow = tuple(t for t in self.below[node] if self._beside(last, t))
            known = -1 if len(follow) == len(self.below[node]) else last if follow else None
            if known is not None and known >= 0:
                known = self.alike.setdefault((node, follow), last)
            self.open[last, node] = known
        return known

    def forget(self) -> None:
        self.ways: list[tuple[tuple[int, int, int], ...]] = []
        self.number: dict[tuple, int] = {}
        self.after = np.full((1 << 10, 256), -1, np.int32)
        self.given = np.zeros((1 << 10, 256), np.int16)
        self.final = np.zeros(1 << 10, np.int64)
        self._state(((-1, 0, 0),))

    def _state(self, ways: tuple[tuple[int, int, int], ...]) -> int:
        i = self.number.get(ways)
        if i is None:
            i = self.number[ways] = len(self.ways)
            self.ways.append(ways)
            if i == len(self.after):
                self.after = np.concatenate([self.after, np.full_like(self.after, -1)])
                self.given = np.concatenate([self.given, np.zeros_like(self.given)])
                self.final = np.concatenate([self.final, np.zeros_like(self.final)])
            self.final[i] = next((n for _, node, n in ways if node == 0), 0)
        return i

    def _edges(self, token: int, right: bool) -> list:
        """What stands at one edge of a token while it is put together, each with the rank of the merge that takes it up:
        at the right what may be merged with it and at which rank, at the left the tokens."""
        out, until, t = [], NEVER, token
        while True:
            if not right:
                out.append((t, until))
            elif t in self.merged:
                out.append((self.merged[t], until))
            if t not in self.parts:
                return out
            a, b, until = self.parts[t]
            t = b if right else a

    def _crossed(self, left: int, right: int) -> int:
        """The first merge that would join the edges of two neighbours before each is complete, or the two; NEVER if none."""
        found = NEVER
        for merged, x_until in self.rights[left]:
            for y, y_until in self.lefts[right]:
                r = merged.get(y, NEVER)
                if r < x_until and r <= y_until and r < found:  # merges go by rank and, at the same rank, from the left
                    found = r
        return found

    def _whole(self, token: int) -> bool:
        """Whether a token's own bytes give that token."""
        if token not in self.parts:
            return True
        a, b, made = self.parts[token]
        return self._crossed(a, b) == made and self._whole(a) and self._whole(b)

    def _beside(self, left: int, right: int) -> bool:
        return left < 0 or self._crossed(left, right) == NEVER

    def move(self, state: int, byte: int) -> int:
        """Make the transition of a state by a byte."""
        ways, ended = [], None
        for last, node, n in self.ways[state]:
            child = self.step.get(node << 8 | byte)
            if child is None:
                continue
            seen = last if last < 0 or self.below[child] is None else self._seen_from(last, child)
            if seen is None:
                continue
            ways.append((seen, child, n))
            token = self.token[child]
            if token >= 0 and ended is None and self._beside(last, token):
                ended = (token, 0, n + 1)
        if ended:
            ways.append(ended)
        least = min(n for _, _, n in ways)
        to = self._state(tuple((last, node, n - least) for last, node, n in ways))
        self.after[state, byte], self.given[state, byte] = to, least
        return to

    def _pieces(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Texts cut at added tokens: (bytes, offsets of the pieces, text of each piece, added tokens of each text)."""
        n = len(offsets) - 1
        added = np.zeros(n, np.int64)
        blob = data.tobytes()
        if self.added is None or not self.added.search(blob.decode()):
            return data, offsets, np.arange(n), added
        pieces, of = [], []
        for i in range(n):
            parts = self.added.split(blob[offsets[i] : offsets[i + 1]].decode())
            added[i] = len(parts) - 1
            pieces += [p.encode() for p in parts]
            of += [i] * len(parts)
        return np.frombuffer(b"".join(pieces), np.uint8), np.concatenate([[0], np.cumsum([len(p) for p in pieces])]), np.array(of), added

    def _begin(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where pre-tokens begin, as places of bytes."""
        at = np.flatnonzero((data & 0xC0) != 0x80)
        kinds = self.classes[np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)]
        text = np.searchsorted(offsets, at, side="right") - 1
        place = np.arange(len(at)) + text  # a close after each text that ends before
        stream = np.full(len(at) + len(offsets), END, np.uint8)
        stream[place] = kinds
        return at[beginnings(stream, self.machine)[place]]

    def count(self, column: pa.Array) -> np.ndarray:
        """The number of tokens of each text."""
        data, offsets, of, counts = self._pieces(*bytes_of(column))
        if not len(data):
            return counts
        if len(self.ways) > MOST_STATES:
            self.forget()
        begins = self._begin(data, offsets)
        flag = np.zeros(len(data), bool)
        flag[begins] = True
        later = np.searchsorted(begins, np.arange(0, len(data), LANE))
        starts = np.unique(np.concatenate([offsets[:-1][np.diff(offsets) > 0], begins[later[later < len(begins)]]]))
        sizes = np.diff(np.append(starts, len(data)))
        long_first = np.argsort(-sizes, kind="stable")
        starts, sizes = starts[long_first], sizes[long_first]
        state, made = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        longest = -np.sort(-sizes)
        live, t = len(starts), 0
        while True:
            live = int(np.searchsorted(-longest[:live], -t, side="left"))  # lanes of more than t bytes
            if live <= FEW:
                break
            at = starts[:live] + t
            byte, now = data[at], state[:live]
            new = flag[at]
            made[:live] += np.where(new, self.final[now], 0)
            now = np.where(new, 0, now)
            to = self.after[now, byte]
            if (to < 0).any():
                missing = np.flatnonzero(to < 0)
                for s, b in set(zip(now[missing].tolist(), byte[missing].tolist())):
                    self.move(s, b)
                to = self.after[now, byte]
            made[:live] += self.given[now, byte]
            state[:live] = to
            t += 1
        for lane in range(live):
            state[lane], made[lane] = self._follow(int(state[lane]), int(made[lane]), data, flag, int(starts[lane]) + t, int(starts[lane] + sizes[lane]))
        made += self.final[state]
        piece = np.searchsorted(offsets, starts, side="right") - 1
        np.add.at(counts, of[piece], made)
        return counts

    def _follow(self, state: int, made: int, data: np.ndarray, flag: np.ndarray, start: int, end: int) -> tuple[int, int]:
        """The rest of one lane, byte by byte."""
        after, given = self.after, self.given
        for byte, new in zip(data[start:end].tolist(), flag[start:end].tolist()):
            if new:
                made += int(self.final[state])
                state = 0
            to = after.item(state, byte)
            if to < 0:
                to = self.move(state, byte)
                after, given = self.after, self.given
            made += given.item(state, byte)
            state = to
        return state, made


def count_tokens(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", into: str = "n_tokens") -> DataFrame:
    """Add the number of tokens of each row's whole text."""
    shared = Shared(docs.sparkSession, Counter(vocabulary))

    @F.arrow_udf("long")
    def tokens(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = shared.value
        for column in batches:
            parts = [pa.array(counter.count(column[s:e])) for s, e in slices(column, 1 << 21)]
            yield pa.concat_arrays(parts) if parts else pa.array([], pa.int64())

    return docs.withColumn(into, tokens(F.col(text)))
