"""Perspective rotation: a dialogue by hand, spans that cut out the speaker's words, long conversations, the edge cases."""

from collections import defaultdict

from pyspark.sql import functions as F

from assayspark.llm import perspectives

SCHEMA = "conv_id long, turn long, role string, text string, speaker string"


def test_a_dialogue_by_hand(spark):
    rows = [(1, 1, "ann", "hi", "x"), (1, 0, "system", "be kind", "x"), (1, 2, "bob b", "yo <|im_end|>", "x"), (1, 3, "ann", "bye", "x"), (1, 3, "ann", "bye", "x")]
    got = {r["speaker"]: r for r in perspectives.rotate(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert set(got) == {"ann", "bob b"}
    assert got["ann"]["rendered"] == (
        "<|im_start|>system\nbe kind<|im_end|>\n<|im_start|>assistant\nhi<|im_end|>\n"
        "<|im_start|>user name=bob_b\nyo < |im_end|><|im_end|>\n<|im_start|>assistant\nbye<|im_end|>\n"
    )
    assert (got["ann"]["n_messages"], got["ann"]["n_trained"], got["bob b"]["n_trained"]) == (4, 2, 1)
    for who, said in (("ann", ["hi<|im_end|>", "bye<|im_end|>"]), ("bob b", ["yo < |im_end|><|im_end|>"])):
        assert [got[who]["rendered"][s["start"] : s["end"]] for s in got[who]["spans"]] == said


def test_null_rows_ties_and_odd_conversations(spark):
    rows = [(None, 0, "a", "n", "x"), (None, 1, "b", None, "x"), (2, None, "a", "late", "x"), (2, 0, None, "who", "x"), (3, 0, "system", "alone", "x"), (4, 0, "z", "é😀", "x")]
    got = perspectives.rotate(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r["conv_id"] or 0, r["speaker"], r["example"], r["n_messages"]) for r in got if r["example"] is not None) == [
        (0, "a", 0, 2), (0, "b", 0, 2), (2, "a", 0, 1), (4, "z", 0, 1),
    ]
    late = [r for r in got if r["example"] is None]
    assert len(late) == 1 and late[0]["rendered"] == "<|im_start|>assistant\nlate<|im_end|>\n"
    assert next(r for r in got if r["conv_id"] == 2 and r["example"] == 0)["rendered"].startswith("<|im_start|>user name=unknown\nwho")
    for r in got:
        assert all(r["rendered"][s["start"] : s["end"]].endswith("<|im_end|>") for s in r["spans"])
    assert perspectives.rotate(spark.createDataFrame([], SCHEMA)).collect() == []


def test_long_conversations_and_crowded_turns(spark):
    rows = [(1, i, f"p{i % 3}", f"t{i}", "x") for i in range(300)] + [(2, 5, "a", f"same turn {i}", "x") for i in range(200)] + [(2, 5, "b", "end", "x")]
    got = perspectives.rotate(spark.createDataFrame(rows, SCHEMA), most=50).collect()
    seen = defaultdict(int)
    for r in got:
        assert r["n_messages"] <= 100 and r["n_trained"] == len(r["spans"])
        seen[r["conv_id"], r["speaker"]] += r["n_messages"]
    assert seen == {(1, "p0"): 300, (1, "p1"): 300, (1, "p2"): 300, (2, "a"): 201, (2, "b"): 201}
    first = next(r for r in got if (r["conv_id"], r["speaker"], r["example"], r["part"]) == (1, "p1", 1, 0))
    assert "t63<" not in first["rendered"] and "\nt64<" in first["rendered"]


def test_no_python_on_the_main_path(spark):
    plan = perspectives.rotate(spark.createDataFrame([(1, 0, "a", "b", "x")], SCHEMA))._jdf.queryExecution().toString()
    assert "ArrowEval" not in plan and "BatchEval" not in plan and "InPandas" not in plan


def test_repeats_do_not_crowd_and_parts_are_contiguous(spark):
    rows = spark.range(8 * 1000).selectExpr("1L as conv_id", "id % 8 as turn", "concat('p', id % 2) as role", "concat('t', id % 8) as text")
    got = perspectives.rotate(rows).collect()
    assert sorted((r["speaker"], r["part"], r["n_messages"]) for r in got) == [("p0", 0, 8), ("p1", 0, 8)]
    data = [(c, i // 4, f"p{i % 3}", f"t{i:03}", "x") for c in (None, 1) for i in range(230) for _ in range(2)]
    made = spark.createDataFrame(data, SCHEMA).repartition(5)
    whole = {(r["conv_id"], r["speaker"]): r["rendered"] for r in perspectives.rotate(made).collect()}
    parts = defaultdict(list)
    for r in sorted(perspectives.rotate(made, most=50).collect(), key=lambda r: r["part"]):
        parts[r["conv_id"], r["speaker"]].append(r)
    assert {k: "".join(r["rendered"] for r in v) for k, v in parts.items()} == whole and len(whole) == 6
    assert all([r["n_messages"] for r in v] == [50] * 4 + [30] for v in parts.values())


def test_crowded_conversation_equals_the_sql(spark):
    """5,000 different messages of one example, each several times: contiguous parts, offsets from 0 in each, as in the SQL."""
    import duckdb
    import pandas as pd

    from assayspark.llm import queries

    rows = [(7, i // 100, ("user", "assistant", "guest")[i % 3], f"text {i:05d} <|im_start|>") for i in range(5000)]
    rows += rows[:900] + [(7, 70, "user", "late"), (8, 0, "system", "s"), (8, 1, "user", None), (8, 1, "user", None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = perspectives.rotate(df.repartition(5))
    spans = F.array_join(F.transform("spans", lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string"))), " ")
    made = made.withColumn("spans", spans)
    con = duckdb.connect()
    con.register("given", pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]))
    con.execute("create view conversations as select conv_id::bigint as conv_id, turn::bigint as turn, role, text from given")
    cur = con.execute(queries.ORACLES["op5_perspectives"])
    names = [d[0] for d in cur.description]
    got = sorted(map(tuple, made.select(*names).collect()))
    assert got == sorted(map(tuple, cur.fetchall())) and {r[names.index("part")] for r in got} == {0, 1}
