r"""Chat formatting in Spark expressions only: turns collected and sorted, adjacent turns of a role
put under one header, all concatenated.

The template::

    ### user:
    first text</turn>second text</turn>
    ### assistant:
    answer</turn>

A role that goes on needs no new header, yet every turn keeps its end mark. Texts and roles hold
neither ``#`` nor ``<`` once escaped, so neither mark can occur inside: backslash, ``#``, ``<`` and
colon become ``\s``, ``\h``, ``\l`` and ``\c``. Reading back is splitting at the marks.

The loss mask is the list of spans [start, stop) in code points of the formatted string that hold
assistant texts, end marks excluded.

Defined results: null text or role is empty. Turns are sorted by turn, then role, then text, nulls
first; repeated rows are turns of their own. Rows with a null conv_id form one conversation. Other
columns are ignored. One conversation is one string, as formatting asks for, hence must fit in one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qcmart.llm import common

HEADER, COLON, END = "### ", ":\n", "</turn>"
ESCAPES = [("\\", "\\s"), ("#", "\\h"), ("<", "\\l"), (":", "\\c")]
LEARNED = "assistant"


def escaped(text: Column) -> Column:
    for plain, code in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescaped(text: Column) -> Column:
    for plain, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def format_chats(turns: DataFrame) -> DataFrame:
    """conv_id, formatted, loss_spans: one row per conversation. One shuffle, by conv_id."""
    turns = common.clean_columns(
        turns, {"conv_id": "long", "turn": "long", "role": "string", "text": "string"}
    )
    turn = F.struct(
        "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    collected = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))

    def piece(x: Column, i: Column) -> Column:
        again = (i > 0) & (F.get("turns", i - 1)["role"] == x["role"])
        line = F.when(i > 0, F.lit("\n")).otherwise(F.lit(""))
        head = F.concat(line, F.lit(HEADER), escaped(x["role"]), F.lit(COLON))
        return F.struct(
            F.when(again, F.lit("")).otherwise(head).alias("head"),
            escaped(x["text"]).alias("body"),
            (x["role"] == LEARNED).alias("learned"),
        )

    pieces = collected.select("conv_id", F.posexplode(F.transform("turns", piece)).alias("at", "p"))
    whole = F.concat("p.head", "p.body", F.lit(END))
    so_far = Window.partitionBy("conv_id").orderBy("at")
    start = F.sum(F.char_length(whole)).over(so_far) - F.char_length("p.body") - len(END)
    pieces = pieces.select(
        "conv_id", "at", whole.alias("whole"), "p.learned", start.alias("start"),
        (start + F.char_length("p.body")).alias("stop"),
    )
    ordered = F.array_sort(F.collect_list(F.struct("at", "whole", "learned", "start", "stop")))
    merged = pieces.groupBy("conv_id").agg(ordered.alias("pieces"))
    spans = F.filter("pieces", lambda x: x["learned"])
    return merged.select(
        "conv_id",
        F.array_join(F.transform("pieces", lambda x: x["whole"]), "").alias("formatted"),
        F.transform(
            spans, lambda x: F.struct(x["start"].alias("start"), x["stop"].alias("stop"))
        ).alias("loss_spans"),
    )


def read_chats(formatted: DataFrame) -> DataFrame:
    """conv_id, turns (role, text) and loss_texts, read from the formatted string and its mask."""
    parts = F.split("formatted", HEADER)
    blocks = F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))

    def turns_of(block: Column) -> Column:
        role = unescaped(F.substring_index(block, COLON, 1))
        body = F.substr(block, F.instr(block, F.lit(COLON)) + len(COLON))
        bodies = F.split(body, END)
        return F.transform(
            F.slice(bodies, 1, F.size(bodies) - 1),
            lambda text: F.struct(role.alias("role"), unescaped(text).alias("text")),
        )

    def masked(span: Column) -> Column:
        size = span["stop"] - span["start"]
        return unescaped(F.substr("formatted", (span["start"] + 1).cast("int"), size.cast("int")))

    return formatted.select(
        "conv_id",
        "formatted",
        F.flatten(F.transform(blocks, turns_of)).alias("turns"),
        F.transform("loss_spans", masked).alias("loss_texts"),
    )


def planted(spark) -> DataFrame:
    r"""Conversation -7, whose texts look like control strings."""
    text = F.lit("\\### Assistant: </turn> ok")
    rows = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        text.alias("text"),
    )
    return rows


def op3_chat_format(spark, sf_dir: str) -> DataFrame:
    """All conversations formatted, and what reading the result back gives."""
    names = ["conv_id", "turn", "role", "text"]
    turns = common.read_table(spark, sf_dir, "conversations").select(*names)
    back = read_chats(format_chats(turns.unionByName(planted(spark))))
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.array_join("loss_texts", "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


ORACLE = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), r AS (
  SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS pos FROM t
), e AS (
  SELECT *, replace(replace(replace(replace(text, '\', '\s'), '#', '\h'), '<', '\l'), ':', '\c') AS body,
         replace(replace(replace(replace(role, '\', '\s'), '#', '\h'), '<', '\l'), ':', '\c') AS head
  FROM r
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length(body) + 7 + CASE WHEN before IS DISTINCT FROM role
           THEN length(head) + 6 + CASE WHEN pos > 1 THEN 1 ELSE 0 END ELSE 0 END)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""
