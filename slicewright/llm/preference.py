"""Preference formatting: one prompt, a chosen and a rejected completion.

The longest common prefix of turns (equal role and text) of the two conversations is rendered
once as the prompt; what follows is rendered for either side, with a mask of runs that says
which characters are trained on: the texts of assistant turns and the marks that end them.

A conversation is one row of arrays, as its rendering is one string; turns are gathered once,
by conversation.  :func:`swapped_replies` makes a pair of every conversation: the rejected side
has another conversation's last reply in place of its own.

Defined results
  null role or text: as empty; null turn: first; turns with one number: by role, then text;
  a pair that lacks either conversation isn't formed; equal conversations: all turns are
  prompt, both completions empty; empty table: empty result; other columns are ignored;
  repeated pairs: each is returned; turns with a null conversation are left out.
  :func:`swapped_replies`: a conversation without a reply gets the other's behind its turns; one
  whose partner is missing, or has no reply, gets an empty reply.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRAINED = "assistant"


def _header(turn: Column) -> Column:
    return F.concat(F.lit("<|"), turn["role"], F.lit("|>\n"))


def _body(turn: Column) -> Column:
    return F.concat(turn["text"], F.lit("<|end|>\n"))


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_header(t), _body(t))), "")


def mask(turns: Column, trained: str = TRAINED) -> Column:
    """Runs ``trained*length`` over the rendered characters, e.g. ``0*14,1*120``."""
    run = lambda t: F.concat(
        F.lit("0*"), F.length(_header(t)).cast("string"),
        F.when(t["role"] == trained, F.lit(",1*")).otherwise(F.lit(",0*")), F.length(_body(t)).cast("string"),
    )
    return F.array_join(F.transform(turns, run), ",")


def gathered(conversations: DataFrame, conv: str = "conv_id") -> DataFrame:
    """(conv, turns): each conversation's turns in order."""
    turn = F.struct(
        "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    return (
        conversations.filter(F.col(conv).isNotNull())
        .groupBy(F.col(conv).alias("conv")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    )


def format_pairs(conversations: DataFrame, pairs: DataFrame, conv: str = "conv_id") -> DataFrame:
    """``pairs`` (pair_id, chosen_id, rejected_id) with prompt, chosen, rejected and masks."""
    turns = gathered(conversations, conv)
    return formatted(
        pairs.select("pair_id", "chosen_id", "rejected_id")
        .join(turns.select(F.col("conv").alias("chosen_id"), F.col("turns").alias("c")), "chosen_id")
        .join(turns.select(F.col("conv").alias("rejected_id"), F.col("turns").alias("r")), "rejected_id")
    )


def formatted(both: DataFrame) -> DataFrame:
    """Rows (pair_id, chosen_id, rejected_id, c, r), where c and r are the turns of either side,
    with prefix_turns, prompt, completions and masks in place of the turns."""
    same = F.zip_with(
        "c", "r",
        lambda x, y: x.isNotNull() & y.isNotNull() & (x["role"].eqNullSafe(y["role"])) & (x["text"].eqNullSafe(y["text"])),
    )
    differs = F.array_position(same, False)
    prefix = F.when(differs > 0, differs - 1).otherwise(F.size("c")).cast("int")
    rest = lambda side: F.slice(side, F.col("prefix_turns") + 1, F.size(side))
    return both.withColumn("prefix_turns", prefix).select(
        "pair_id", "chosen_id", "rejected_id", "prefix_turns",
        render(F.slice("c", F.lit(1), F.col("prefix_turns"))).alias("prompt"),
        render(rest("c")).alias("chosen"), render(rest("r")).alias("rejected"),
        mask(rest("c")).alias("chosen_mask"), mask(rest("r")).alias("rejected_mask"),
    )


def neighbours(conversations: DataFrame, conv: str = "conv_id") -> DataFrame:
    """Pairs of conversations 2n (chosen) and 2n + 1 (rejected)."""
    half = F.shiftright(F.col(conv), 1)
    return (
        conversations.filter(F.col(conv).isNotNull()).groupBy(half.alias("pair_id"))
        .agg(F.min(conv).alias("chosen_id"), F.max(conv).alias("rejected_id"))
        .filter("chosen_id < rejected_id")
    )


def swapped_replies(conversations: DataFrame, conv: str = "conv_id") -> DataFrame:
    """Every conversation as chosen side (pair_id and chosen_id are its id), formatted against
    itself with the last reply of its neighbour (2n for 2n + 1, and the other way round) in
    place of its own last one; rejected_id is the neighbour, if there is one."""
    turns = gathered(conversations, conv)
    place = F.array_max(F.transform("turns", lambda t, i: F.when(t["role"] == TRAINED, i)))
    told = turns.select("conv", "turns", place.alias("place"))
    reply = F.when(F.col("place").isNotNull(), F.get("turns", F.col("place"))["text"])
    donors = told.select(F.col("conv").alias("donor"), F.col("conv").bitwiseXOR(F.lit(1)).alias("conv"), reply.alias("reply"))
    both = told.join(donors, "conv", "left").withColumn("reply", F.coalesce("reply", F.lit("")))
    other = lambda turn: F.struct(turn.alias("turn"), F.lit(TRAINED).alias("role"), F.col("reply").alias("text"))
    swapped = F.when(
        F.col("place").isNotNull(),
        F.transform("turns", lambda t, i: F.when(i == F.col("place"), other(t["turn"])).otherwise(t)),
    ).otherwise(F.concat("turns", F.array(other(F.get("turns", F.lit(0))["turn"]))))
    return formatted(both.select(
        F.col("conv").alias("pair_id"), F.col("conv").alias("chosen_id"), F.col("donor").alias("rejected_id"),
        F.col("turns").alias("c"), swapped.alias("r"),
    ))
