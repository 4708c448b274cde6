"""Every registered query of the operators: against its SQL, or with the columns and rows its contract asks for."""

import pytest

from assayspark.llm import queries
from check import compare, connect

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1": ["doc_id", "held_out", "score", "predicted"],
    "op2": ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score", "held_out"],
    "op7": ["doc_id", "class_id", "class_size", "kept"],
    "op8": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "ratio", "base_failed", "kept"],
    "op10": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op11": ["doc_id", "n_bytes", "n_tokens", "over_limit"],
}


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_against_sql(spark, name):
    from __spark_entry__ import oracle_sql

    assert oracle_sql()[name] == queries.ORACLES[name]
    result = compare(spark, connect(SF), SF, name)
    assert result.startswith("equal"), result


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES) - {"op4_paragraph_minhash"}))
def test_a_row_per_document(spark, name):
    made = queries.QUERIES[name](spark, SF)
    assert made.columns == COLUMNS[name.split("_")[0]]
    want = [r[0] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()]
    assert sorted(r[0] for r in made.select("doc_id").collect()) == sorted(want)
