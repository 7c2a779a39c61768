"""Preference formatting: common turns once as prompt, the rest as paired, masked completions.

DataFrame functions only.  A conversation is one value: its turns are gathered
into one array, as its rendered form is one string anyway.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick

#: Fixed format of a rendered turn: header, text, end mark.
HEAD, AFTER_ROLE, END = "<|", "|>\n", "<|end|>\n"
TURNS = "array<struct<turn:bigint,role:string,text:string>>"


def _turns(side: DataFrame, name: str) -> DataFrame:
    """pair_id and its turns as array<struct<turn, role, text>>, sorted; nulls of role and text become empty."""
    rows = pick(side, "pair_id", "turn", "role", "text").where("pair_id is not null")
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.groupBy("pair_id").agg(F.array_sort(F.collect_list(turn)).alias(name))


def _rendered(turns):
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit(HEAD), t["role"], F.lit(AFTER_ROLE), t["text"], F.lit(END))), "")


def _trained_spans(turns, role: str):
    """``start:end`` of every text by ``role`` with its end mark, in code points of the rendered turns, joined by commas."""
    step = F.aggregate(
        turns, F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("spans")),
        lambda acc, t: F.struct(
            (acc["at"] + F.length(t["role"]) + F.length(t["text"]) + len(HEAD + AFTER_ROLE + END)).alias("at"),
            F.when(t["role"] == role, F.array_append(acc["spans"], F.concat_ws(
                ":", (acc["at"] + F.length(t["role"]) + len(HEAD + AFTER_ROLE)).cast("string"),
                (acc["at"] + F.length(t["role"]) + F.length(t["text"]) + len(HEAD + AFTER_ROLE + END)).cast("string"))))
            .otherwise(acc["spans"]).alias("spans")))
    return F.array_join(step["spans"], ",")


def format_preferences(chosen: DataFrame, rejected: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """One row per pair_id of either side: pair_id, n_common, prompt, chosen, rejected, chosen_spans, rejected_spans.

    Both inputs are turns (pair_id, turn, role, text).  The prompt renders the
    longest run of first turns equal in role and text; ``chosen`` and
    ``rejected`` render what follows on each side.  Spans are the parts of a
    completion to train on (texts of ``trained_role``); everything else,
    the prompt included, is masked.  Turns are in the order of (turn, role,
    text), a null turn first, and repeated turn rows are kept each.  A pair
    missing on one side has no common turns and an empty completion there;
    equal sides give two empty completions.  Rows without pair_id are left out.
    """
    both = _turns(chosen, "c").join(_turns(rejected, "r"), "pair_id", "full")
    turns = lambda c: F.coalesce(F.col(c).cast(TURNS), F.array().cast(TURNS)).alias(c)
    both = both.select("pair_id", turns("c"), turns("r"))
    same = F.zip_with("c", "r", lambda a, b: F.coalesce((a["role"] == b["role"]) & (a["text"] == b["text"]), F.lit(False)))
    differs = F.array_position(same, False)
    both = both.withColumn("n_common", F.when(differs > 0, differs - 1).otherwise(F.size("c").cast("long")))
    rest = lambda c: F.slice(c, F.col("n_common").cast("int") + 1, F.greatest(F.size(c) - F.col("n_common").cast("int"), F.lit(0)))
    both = both.withColumn("p", F.slice("c", F.lit(1), F.col("n_common").cast("int"))) \
        .withColumn("c", rest("c")).withColumn("r", rest("r"))
    return both.select("pair_id", "n_common", _rendered("p").alias("prompt"), _rendered("c").alias("chosen"), _rendered("r").alias("rejected"),
                       _trained_spans("c", trained_role).alias("chosen_spans"), _trained_spans("r", trained_role).alias("rejected_spans"))


def swapped_replies(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(chosen, rejected) turns made of one table of conversations (conv_id, turn, role, text).

    Chosen is each conversation as it is; rejected is the same conversation
    whose last assistant turn has the text of the last assistant turn of its
    neighbour (the conv_id that differs in the lowest bit).  Where the
    neighbour has none, rejected lacks that turn; a conversation without
    assistant turns is equal on both sides.  Ties of the last turn go to the
    text that sorts last.
    """
    rows = pick(turns, "conv_id", "turn", "role", "text").where("conv_id is not null")
    rows = rows.withColumn("conv_id", F.col("conv_id").cast("long")).withColumn("turn", F.col("turn").cast("long"))
    last = rows.where("role = 'assistant'").groupBy("conv_id").agg(F.max(F.struct("turn", F.coalesce("text", F.lit("")).alias("text"))).alias("last"))
    swap = last.select("conv_id", F.col("last.turn").alias("last_turn")).join(
        last.select(F.col("conv_id").bitwiseXOR(F.lit(1).cast("long")).alias("conv_id"), F.col("last.text").alias("other")), "conv_id", "left")
    chosen = rows.withColumnRenamed("conv_id", "pair_id")
    mine = F.col("turn").eqNullSafe(F.col("last_turn")) & F.coalesce(F.col("role") == "assistant", F.lit(False))
    rejected = rows.join(swap, "conv_id", "left").where(~(mine & F.col("other").isNull())).select(
        F.col("conv_id").alias("pair_id"), "turn", "role", F.when(mine, F.col("other")).otherwise(F.col("text")).alias("text"))
    return chosen, rejected
