"""Counts of the compiled transducers against the library itself, and their parts against plain readings."""

import random

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from assayspark.llm import queries, token_transducer as tt

PATH = queries.tokenizer_file("byte_bpe_50k.json")
ODD = [
    "", None, " ", "  a", "\n\n x", "日本語テキスト😀 naïve", "a" * 5000, "0" * 3000, "\x00\x01", "<|endoftext|>", "a <|endoftext|> b<|endoftext|><|endoftext|>  ",
    "it's we'll I'VE 're 'r 'rx 'l 'll'v 've' ' s", "x  \t\n  y", "　x ", "'" * 20, " " * 1000 + "a", "'r", "'l", "abc'", "a'b", "!'s", " 's", "  a \u0085b",
    "̀á 1٢²½Ⅷ", "<|endoftext", "|>", "ab" * 4000 + " end", "՘ ֋౜", "\U0010ffff",
]


@pytest.fixture(scope="module")
def known():
    return tt.load(PATH)


@pytest.fixture(scope="module")
def library():
    made = Tokenizer.from_file(PATH)
    return lambda texts: [len(e.ids) for e in made.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def mixed(seed, n):
    pick = random.Random(seed)
    parts = ["a", "b", "the", " ", "  ", "\n", "'", "'s", "re", "ll", "1", "23", "é", "ß", "日", "!", "...", "\t", "e", "r", "v", "l", "in", "ing", "ation", "<|endoftext|>", "​", "̀"]
    return ["".join(pick.choice(parts) for _ in range(pick.randint(1, 40))) for _ in range(n)]


@pytest.mark.parametrize("seed", range(3))
def test_odd_texts(known, library, seed):
    texts = ODD + mixed(seed, 2000)
    assert tt.Counter(known).count(pa.array(texts, pa.string())).tolist() == library(texts)


def test_documents_and_every_token(known, library):
    texts = pq.read_table("/root/testdata/sf0.001/documents.parquet")["text"].to_pylist()
    texts += [t.decode() for t in known.tokens[::7] if t.decode(errors="ignore").encode() == t]
    assert tt.Counter(known).count(pa.array(texts)).tolist() == library(texts)


def test_bounds_on_memory_change_nothing(known, library, monkeypatch):
    for name, value in (("MOST_STATES", 5), ("LANE", 3), ("FEW", 0), ("AHEAD", 1)):
        monkeypatch.setattr(tt, name, value)
    counter, texts = tt.Counter(known), mixed(7, 300) + ODD
    got = [counter.count(pa.array(texts[i : i + 50], pa.string())).tolist() for i in range(0, len(texts), 50)]
    assert sum(got, []) == library(texts)
    monkeypatch.setattr(tt, "FEW", 1 << 40)  # all lanes one by one
    assert tt.Counter(known).count(pa.array(texts, pa.string())).tolist() == library(texts)


@pytest.mark.parametrize("chunk", [1, 2, 5, 128])
def test_beginnings_do_not_depend_on_chunks(known, chunk):
    """Entry states come from the scan alone: chunks of a character cut every run, contraction and blank."""
    machine = tt.begin_machine()
    split = ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
    for text in mixed(5, 300):
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        classes = np.append(known.classes[points], tt.END)
        got = np.flatnonzero(tt.beginnings(classes, machine, chunk)).tolist()
        assert got == [start for _, (start, _) in split(text)]


def test_classes_are_those_of_the_pre_tokenizer(known):
    split = ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
    some = [*range(0x3000), *range(0xA000, 0xD800, 7), *range(0xE000, 0x110000, 211)]
    for probe, kinds in (("a", {tt.LETTER, 7, 8, 9, 10, 11}), ("1", {tt.NUMBER}), ("!", {tt.OTHER, tt.QUOTE})):
        ends = dict(at for _, at in split("".join(f"{probe}{chr(c)}\n" for c in some)))
        assert [ends.get(3 * i) == 3 * i + 2 for i in range(len(some))] == [int(known.classes[c]) in kinds for c in some]


def test_other_files_are_refused(tmp_path):
    import json

    with open(PATH, encoding="utf-8") as f:
        file = json.load(f)
    for change in ({"normalizer": {"type": "NFC"}}, {"pre_tokenizer": file["pre_tokenizer"] | {"add_prefix_space": True}}):
        path = tmp_path / "other.json"
        path.write_text(json.dumps(file | change))
        with pytest.raises(ValueError):
            tt.load(str(path))


def test_columns_pass_through(spark, known, library):
    docs = spark.createDataFrame([(i, t, "x", 5) for i, t in enumerate(ODD)] * 2, "doc_id long, text string, tokens string, n_bytes int").repartition(3)
    rows = tt.count_tokens(docs, known).collect()
    assert rows[0].__fields__ == ["doc_id", "text", "tokens", "n_bytes", "n_tokens"] and len(rows) == 2 * len(ODD)
    want = library(ODD)
    assert all(r["n_tokens"] == want[r["doc_id"]] for r in rows)
    assert tt.count_tokens(docs.limit(0), known).collect() == []


def test_query(spark, library):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    want = dict(zip(texts, library(texts.values())))
    for r in queries.QUERIES["op11_token_transducer"](spark, sf).collect():
        text = texts.pop(r["doc_id"]) or ""
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), want[r["doc_id"]], want[r["doc_id"]] > 1024)
    assert not texts
