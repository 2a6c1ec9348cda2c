"""Preference pairs from two conversations: shared turns once as prompt, the rest as masked completions.

The turns of both conversations are numbered in order. Turns are compared position by position (role and text,
null equal to null); the longest common prefix becomes the prompt, rendered once; what follows in each
conversation is its completion. A completion's mask is the list of character spans that count for the loss: the texts of assistant
turns with the end marker, not the role headers and not other roles.

Defined results: a null role is `unknown`, a null text empty; turns of equal number are ordered by role and
text; repeated rows are repeated turns; a null turn comes first; a conversation without a
partner has an empty other side and no prompt; a null conversation id makes a pair of its own; other columns
are ignored. One conversation is one output row, so its turns must fit one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stocktide.llm.common import bind

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
TRAINED_ROLE = "assistant"


def rendered(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), turn["role"], F.lit("\n"), turn["text"], F.lit(CLOSE))


def _completion(turns: Column) -> Column:
    """Struct of a completion's text and the spans of it that are trained on."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(acc: Column, turn: Column) -> Column:
        head = acc["at"] + F.length(F.lit(OPEN)) + F.length(turn["role"]) + 1
        end = head + F.length(turn["text"]) + F.length(F.lit(CLOSE))
        span = F.array(F.struct(head.cast("int").alias("start"), end.cast("int").alias("end")))
        spans = F.when(turn["role"] == TRAINED_ROLE, F.concat(acc["spans"], span)).otherwise(acc["spans"])
        return F.struct(end.cast("int").alias("at"), spans.alias("spans"))

    spans = F.aggregate(turns, start, step)["spans"]
    return F.struct(F.array_join(F.transform(turns, rendered), "").alias("text"), spans.alias("spans"))


def format_pairs(turns: DataFrame) -> DataFrame:
    """One row per `pair` of turns (`pair`, `chosen` boolean, `conv_id`, `turn`, `role`, `text`)."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("unknown")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = turns.select("pair", "chosen", "conv_id", "turn", role.alias("role"), text.alias("text")).repartition("pair")
    order = Window.partitionBy("pair", "chosen").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    turn = F.struct("role", "text")
    side = lambda yes: F.max(F.when(F.col("chosen") == yes, turn))
    name = lambda yes: F.max(F.when(F.col("chosen") == yes, F.col("conv_id")))
    places = rows.withColumn("no", F.row_number().over(order)).groupBy("pair", "no").agg(
        side(True).alias("a"), side(False).alias("b"), name(True).alias("a_id"), name(False).alias("b_id")
    )
    # A place that one side doesn't have, or fills otherwise, ends the prefix.
    differs = F.when(~F.coalesce(F.col("a") == F.col("b"), F.lit(False)), F.col("no"))
    pairs = places.groupBy("pair").agg(
        F.sort_array(F.collect_list(F.struct("no", "a", "b"))).alias("turns"), F.min(differs).alias("end"),
        F.count("*").alias("n"), F.max("a_id").alias("chosen_id"), F.max("b_id").alias("rejected_id"),
    )
    prefix = (F.coalesce(F.col("end") - 1, F.col("n"))).cast("int")
    shared = F.filter("turns", lambda t: t["no"] <= prefix)
    after = lambda s: F.transform(F.filter("turns", lambda t: (t["no"] > prefix) & t[s].isNotNull()), lambda t: t[s])
    return pairs.select(
        "pair", "chosen_id", "rejected_id", prefix.alias("prompt_turns"),
        F.array_join(F.transform(shared, lambda t: rendered(t["a"])), "").alias("prompt"),
        bind(after("a"), _completion).alias("chosen"), bind(after("b"), _completion).alias("rejected"),
    )


def paired_by_number(conversations: DataFrame) -> DataFrame:
    """Turns of conversations 2k (chosen) and 2k + 1 (rejected) as pair k."""
    conv = F.col("conv_id").cast("long")
    return conversations.select(
        F.floor(conv / 2).cast("long").alias("pair"), (F.pmod(F.coalesce(conv, F.lit(0)), F.lit(2)) == 0).alias("chosen"),
        conv.alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text",
    )


def spelled_spans(spans: Column) -> Column:
    """Spans as text: start-end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string"))), ",")
