"""Multi-party chat formatting by perspective rotation, by DataFrame operations only.

For every participant of a conversation the dialogue is rendered once with that speaker as the assistant. Other
speakers are users with their name, system turns stay as they are, and the spans to train on are those of the assistant:
its text and the end marker behind it, as character offsets into the rendered text (end exclusive).

A dialogue is rendered in examples of `turns` turn numbers each, so an example stays bounded however long a
conversation is. Messages are ordered by turn, then role and text. Rows that repeat a message wholly count once. Should
an example then hold over `most` messages, its parts are the first `most` in that order, the next, and so on.

A speaker is any role but the system's. Null roles speak as `unknown` users and have no perspective of their own; null
texts are empty; null turns come in an example of their own behind all others; null conversation ids form one
conversation. A conversation without speakers gives no rows, and so does an empty table. Markers inside texts and names
are broken by a space, so that a text cannot end its own turn. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from assayspark.session import numbered

BEGIN, END = "<|im_start|>", "<|im_end|>\n"
SYSTEM = "system"


def _safe(c: Column) -> Column:
    return F.replace(c, F.lit("<|im_"), F.lit("< |im_"))


def _rendered(messages: Column, speaker: Column) -> Column:
    """Head, text and whether to train on it, of each message."""

    def one(m: Column) -> Column:
        mine = m["role"].eqNullSafe(speaker)
        name = F.regexp_replace(_safe(F.coalesce(m["role"], F.lit("unknown"))), r"\s+", "_")
        head = F.when(mine, F.lit(f"{BEGIN}assistant\n")).when(m["role"] == SYSTEM, F.lit(f"{BEGIN}system\n"))
        return F.struct(
            head.otherwise(F.concat(F.lit(f"{BEGIN}user name="), name, F.lit("\n"))).alias("head"),
            _safe(m["text"]).alias("text"),
            mine.alias("mine"),
        )

    return F.transform(messages, one)


def _spans(parts: Column) -> Column:
    """Offsets of the trained parts: a running length over the messages."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(acc: Column, m: Column) -> Column:
        begin = acc["at"] + F.length(m["head"])
        text_end = begin + F.length(m["text"])
        span = F.struct(begin.alias("start"), (text_end + len(END) - 1).alias("end"))
        return F.struct(
            (text_end + len(END)).alias("at"),
            F.when(m["mine"], F.array_append(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"),
        )

    return F.aggregate(parts, start, step, lambda acc: acc["spans"])


def examples(
    turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", per_example: int = 64, most: int = 4096,
) -> DataFrame:
    """conv_id, example, part and messages (turn, role, text) in order. One shuffle of the texts, but for crowded examples."""
    rows = turns.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).cast("long").alias("turn"), F.col(role).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    rows = rows.withColumn("example", F.floor(F.col("turn") / per_example))
    crowded = rows.groupBy("conv_id", "example").agg(F.count("*").alias("n")).where(F.col("n") > most)
    crowded = crowded.select(F.col("conv_id").alias("c"), F.col("example").alias("e"))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & F.col("example").eqNullSafe(F.col("e"))
    many = numbered(rows.join(crowded, same, "left_semi").distinct().orderBy("conv_id", "example", "turn", "role", "text"), "place")
    first = many.groupBy(F.col("conv_id").alias("c"), F.col("example").alias("e")).agg(F.min("place").alias("first"))
    many = many.join(first, same).withColumn("part", F.floor((F.col("place") - F.col("first")) / most)).select(*rows.columns, "part")
    rows = rows.join(crowded, same, "left_anti").withColumn("part", F.lit(0).cast("long")).unionByName(many)
    message = F.struct("turn", "role", "text")
    grouped = rows.groupBy("conv_id", "example", "part").agg(F.collect_set(message).alias("messages"))
    return grouped.withColumn("messages", F.array_sort("messages"))


def rotate(
    turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", per_example: int = 64, most: int = 4096,
) -> DataFrame:
    """conv_id, speaker, example, part, n_messages, n_trained, rendered, spans for every speaker of every conversation."""
    speakers = turns.select(F.col(conv_id).alias("c"), F.col(role).alias("speaker")).where(F.col("speaker") != SYSTEM).distinct()
    shown = examples(turns, conv_id, turn, role, text, per_example, most).join(speakers, F.col("conv_id").eqNullSafe(F.col("c")))
    parts = shown.withColumn("parts", _rendered(F.col("messages"), F.col("speaker")))
    return parts.select(
        "conv_id", "speaker", "example", "part",
        F.size("parts").alias("n_messages"),
        F.size(F.filter("parts", lambda m: m["mine"])).alias("n_trained"),
        F.array_join(F.transform("parts", lambda m: F.concat(m["head"], m["text"], F.lit(END))), "").alias("rendered"),
        _spans(F.col("parts")).alias("spans"),
    )
