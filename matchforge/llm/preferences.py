"""Preference formatting: a shared prompt and two masked completions per pair.

A pair is two conversations, chosen and rejected. Their longest common prefix of turns
(same role and text) is rendered once as the prompt; the turns behind it become the two
completions, and only what the assistant says in a completion bears loss.

The first turn that differs is a minimum per pair over joined turns, so no conversation
is compared by walking through it in one place. A pair's texts meet in one row only at
the end, where they are the result.

Cases: turns without pair, side or turn number take no part; a null role or text is
equal to another null and renders as empty; turns that repeat a number are put in order of
role and text and renumbered; a pair that lacks a side has no row; if one side is the
beginning of the other its completion is empty; two equal sides have the whole as prompt
and ``identical`` true; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchforge.llm.common import pick

# Fixed values of the template.
TURN_START, TURN_BREAK, TURN_END = "<|turn|>", "\n", "<|end|>\n"
SPEAKER = "assistant"


def _header(role: Column) -> Column:
    return F.concat(F.lit(TURN_START), F.coalesce(role, F.lit("")), F.lit(TURN_BREAK))


def _body(text: Column) -> Column:
    return F.concat(F.coalesce(text, F.lit("")), F.lit(TURN_END))


def format_preferences(turns: DataFrame, speaker: str = SPEAKER) -> DataFrame:
    """From ``pair_id``, ``side`` (chosen or rejected), ``turn``, ``role`` and ``text``: a row per pair.

    ``prompt``; ``prompt_turns``; ``chosen`` and ``rejected`` (rendered turns behind the
    prompt); ``chosen_mask`` and ``rejected_mask``: spans (start, end) of characters of the
    completion that bear loss; ``identical``.
    """
    rows = pick(turns, "pair_id", "side", "turn", "role", "text").where(
        "pair_id is not null and turn is not null and side in ('chosen', 'rejected')")
    order = Window.partitionBy("pair_id", "side").orderBy("turn", "role", "text")
    rows = rows.withColumn("turn", F.row_number().over(order))
    side = lambda name: rows.where(F.col("side") == name).select(
        "pair_id", "turn", "role", "text", F.lit(True).alias("here"))
    a, b = side("chosen").alias("a"), side("rejected").alias("b")
    same = F.col("a.role").eqNullSafe(F.col("b.role")) & F.col("a.text").eqNullSafe(F.col("b.text"))
    both = a.join(b, ["pair_id", "turn"], "full").select(
        "pair_id", "turn", F.col("a.role").alias("role_a"), F.col("a.text").alias("text_a"),
        F.col("b.role").alias("role_b"), F.col("b.text").alias("text_b"), same.alias("same"),
        F.struct(F.col("a.here").isNotNull().alias("a"), F.col("b.here").isNotNull().alias("b")).alias("has"))
    matching = F.col("same") & F.col("has.a") & F.col("has.b")
    fork = F.min(F.when(~matching, F.col("turn")))
    piece = lambda s: F.when(F.col(f"has.{s}"), F.struct(
        "turn", F.col(f"role_{s}").alias("role"), F.col(f"text_{s}").alias("text")))
    whole = both.groupBy("pair_id").agg(
        fork.alias("fork"), F.max("turn").alias("last"), F.sort_array(F.collect_list(piece("a"))).alias("turns_a"),
        F.sort_array(F.collect_list(piece("b"))).alias("turns_b")).where("size(turns_a) > 0 and size(turns_b) > 0")
    whole = whole.withColumn("fork", F.coalesce("fork", F.col("last") + 1))
    render = lambda some: F.concat_ws("", F.transform(some, lambda t: F.concat(_header(t["role"]), _body(t["text"]))))
    behind = lambda s: F.filter(f"turns_{s}", lambda t: t["turn"] >= F.col("fork"))

    def mask(some: Column) -> Column:
        """Spans of the speaker's bodies, by a running length over the completion's turns."""
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

        def add(state, t):
            begin = state["at"] + F.length(_header(t["role"]))
            end = begin + F.length(_body(t["text"]))
            span = F.array(F.struct(begin.alias("start"), end.alias("end")))
            spans = F.when(t["role"] == speaker, F.concat(state["spans"], span)).otherwise(state["spans"])
            return F.struct(end.alias("at"), spans.alias("spans"))

        return F.aggregate(some, start, add, lambda state: state["spans"])

    return whole.select(
        "pair_id", (F.col("fork") - 1).cast("long").alias("prompt_turns"),
        render(F.filter("turns_a", lambda t: t["turn"] < F.col("fork"))).alias("prompt"),
        render(behind("a")).alias("chosen"), mask(behind("a")).alias("chosen_mask"),
        render(behind("b")).alias("rejected"), mask(behind("b")).alias("rejected_mask"),
        (F.col("fork") > F.col("last")).alias("identical"))


def neighbour_pairs(conversations: DataFrame) -> DataFrame:
    """Preference pairs made from plain conversations, as turns of both sides.

    Chosen is a conversation up to its last assistant turn; rejected is the same with
    that turn's text taken from the neighbour (ids 2k and 2k + 1), which answers another
    question, or empty if the neighbour has no reply. Conversations without a reply make no pair.
    """
    rows = pick(conversations, "conv_id", "turn", "role", "text").where("conv_id is not null and turn is not null")
    replies = rows.where(F.col("role") == SPEAKER)
    last = replies.groupBy("conv_id").agg(F.max(F.struct("turn", "text")).alias("r"))
    last = last.select("conv_id", F.col("r.turn").alias("reply_turn"), F.col("r.text").alias("reply"))
    other = last.select(F.col("conv_id").bitwiseXOR(F.lit(1)).alias("conv_id"), F.col("reply").alias("other_reply"))
    ends = last.select("conv_id", "reply_turn").join(other, "conv_id", "left")
    used = rows.join(ends, "conv_id").where(F.col("turn") <= F.col("reply_turn"))
    sides = F.explode(F.array(F.lit("chosen"), F.lit("rejected")))
    swapped = (F.col("side") == "rejected") & (F.col("turn") == F.col("reply_turn")) & (F.col("role") == SPEAKER)
    return used.withColumn("side", sides).select(
        F.col("conv_id").alias("pair_id"), "side", "turn", "role",
        F.when(swapped, F.coalesce("other_reply", F.lit(""))).otherwise(F.col("text")).alias("text"))
