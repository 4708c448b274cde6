"""Byte-level BPE against tiktoken over the same ranks, and the exact round trip."""

import base64

import pyarrow.parquet as pq
import pytest
import tiktoken

from assayspark.llm import byte_bpe, queries

ODD = [
    "", None, " ", "  a", "\n\n x", "日本語テキスト😀 naïve", "a" * 5000, "0" * 3000, "\x00\x01", "<unk> <|endoftext|> ▁x", "ÀÁ" * 100,
    "it's we'll  \t\n  x", "ǘ ​﻿", "　x", " " * 1000,
]


@pytest.fixture(scope="module")
def known():
    return queries.vocabulary()


@pytest.fixture(scope="module")
def reference():
    with open(f"{queries.TOKENIZERS}/byte_bpe_multi_50k.tiktoken", "rb") as f:
        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=queries.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_equal_the_reference(known, reference):
    texts = pq.read_table("/root/testdata/sf0.001/documents.parquet")["text"].to_pylist() + ODD
    coder = byte_bpe.Coder(known)
    ids = coder.encode(texts)
    assert ids.to_pylist() == [reference.encode_ordinary(t or "") for t in texts]
    assert coder.decode(ids).to_pylist() == [(t or "").encode() for t in texts]


def test_forgetting_changes_nothing(known, reference, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHED", 3)
    coder = byte_bpe.Coder(known)
    for t in ODD:
        assert coder.encode([t]).to_pylist() == [reference.encode_ordinary(t or "")]


def test_every_token_decodes_to_itself(known):
    import pyarrow as pa

    coder = byte_bpe.Coder(known)
    some = list(range(0, len(known.tokens), 37))
    assert coder.decode(pa.array([[i] for i in some], pa.list_(pa.int32()))).to_pylist() == [known.tokens[i] for i in some]
    assert coder.decode(pa.array([None, [], [0]], pa.list_(pa.int32()))).to_pylist() == [None, b"", known.tokens[0]]


def test_columns_pass_through(spark, known, reference):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(ODD)], "doc_id long, text string, decoded_ string").repartition(3)
    rows = byte_bpe.decode(byte_bpe.encode(docs, known), known).collect()
    assert rows[0].__fields__ == ["doc_id", "text", "decoded_", "ids", "decoded"]
    for r in rows:
        assert list(r["ids"]) == reference.encode_ordinary(ODD[r["doc_id"]] or "") and bytes(r["decoded"]) == (ODD[r["doc_id"]] or "").encode()
    assert byte_bpe.encode(docs.limit(0), known).collect() == []
