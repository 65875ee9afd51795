"""Preference formatting: shared prompts and masked completions.

Chosen and rejected conversations that belong to one pair agree up to some
turn.  That longest common prefix is rendered once, as the prompt; what follows
is rendered for either side.  Only assistant turns after the prompt carry loss.
Every turn has its place in its part's rendered text, and the stretch of it that
is learned: the text and the end mark, without the role's header.

It is all joins and aggregates over turns: a conversation is never gathered
into one row or one window, so its length does not matter.  Places are running
totals of lengths, in blocks of turns.

Definitions: turns order by ``turn``; an exact repeat of a turn counts once; a
null role or text is empty.  Where a turn number has several different rows,
the turn is the set of them; they stand one after another by a digest of role
and text (rows whose 60 bits agree begin at one place).  The prefix ends before
the first turn that is not the same on both sides; if there is none, everything
is prompt.  Turns without a pair id or number take no part.  Places count code
points from 0.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.prefix import running_total_non_null
from .common import materialize

# Turns that one window sums; two levels of this span all turn numbers.
BLOCK_TURNS = 1 << 21


def header(role: Column) -> Column:
    """What stands before a turn's text."""
    return F.concat(F.lit("<|"), role, F.lit("|>\n"))


def render(role: Column, text: Column) -> Column:
    """One turn in the chat template."""
    return F.concat(header(role), text, F.lit("<|end|>\n"))


def _turns(side: DataFrame) -> DataFrame:
    return side.select(
        F.col("pair_id").cast("long").alias("pair_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")) \
        .where("pair_id is not null and turn is not null")


def _before(sizes: DataFrame, keys: list[str], by: str, out: str) -> DataFrame:
    """``sizes`` with the chars of a key's earlier rows; ``by`` is unique within a key."""
    total = running_total_non_null(sizes, keys, by, "chars", out, BLOCK_TURNS)
    return total.select(*keys, by, (F.col(out) - F.col("chars")).alias(out))


def _with_places(rows: DataFrame) -> DataFrame:
    """``rows`` (pair_id, part, turn, place, chars) with ``span_start``."""
    part, turn = ["pair_id", "part"], ["pair_id", "part", "turn"]
    sizes = rows.groupBy(*turn).agg(F.sum("chars").alias("chars"), F.count(F.lit(1)).alias("n"))
    begins = _before(sizes, part, "turn", "begin")
    # Only turns of several rows need an order within the turn.
    several = rows.select(*turn, "place", "chars").join(sizes.where("n > 1").select(*turn), turn, "left_semi")
    ahead = _before(several.groupBy(*turn, "place").agg(F.sum("chars").alias("chars")), turn, "place", "ahead")
    return rows.join(begins, turn).join(ahead, [*turn, "place"], "left") \
        .withColumn("span_start", F.col("begin") + F.coalesce("ahead", F.lit(0)))


def format_pairs(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """Rendered turns of every pair.

    Both sides need pair_id, turn, role, text; pairs that lack a side are left
    out.  Returns pair_id, part (prompt, chosen, rejected), turn, role,
    rendered, loss_mask (1 where the completion is learned), span_start and
    span_end (the turn's place in its part's rendered turns, one after another),
    learn_start and learn_end (what is learned of it; null where nothing is).
    The turns are written once and read again for their places.
    """
    sides = _turns(chosen).withColumn("side", F.lit(1)).union(_turns(rejected).withColumn("side", F.lit(2)))
    # Which sides have a turn: 1, 2, or 3 for both.
    turns = sides.groupBy("pair_id", "turn", "role", "text").agg(F.bit_or("side").alias("sides"))
    pairs = turns.groupBy("pair_id").agg(
        F.min(F.when(F.col("sides") < 3, F.col("turn"))).alias("split"),
        F.bit_or("sides").alias("has")).where("has = 3").select("pair_id", "split")
    placed = turns.join(pairs, "pair_id").withColumn(
        "in_prompt", F.coalesce(F.col("turn") < F.col("split"), F.lit(True)))
    part = F.when(F.col("in_prompt"), F.array(F.lit("prompt"))).otherwise(F.array_compact(F.array(
        F.when(F.col("sides") != 2, F.lit("chosen")), F.when(F.col("sides") != 1, F.lit("rejected")))))
    role, text = F.col("role"), F.col("text")
    digest = F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text))
    rows = placed.select(
        "pair_id", F.explode(part).alias("part"), "turn", "role", render(role, text).alias("rendered"),
        F.char_length(render(role, text)).cast("long").alias("chars"),
        F.conv(F.substring(digest, 1, 15), 16, 10).cast("long").alias("place"))
    learned = (F.col("part") != "prompt") & (F.col("role") == "assistant")
    start, end = F.col("span_start"), F.col("span_start") + F.col("chars")
    return _with_places(materialize(rows, "preference-turns")).select(
        "pair_id", "part", "turn", "role", "rendered", learned.cast("int").alias("loss_mask"),
        start, end.alias("span_end"),
        F.when(learned, start + F.char_length(header(role))).alias("learn_start"), F.when(learned, end).alias("learn_end"))


def swapped_replies(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs from plain conversations: chosen is the conversation, rejected has
    its last assistant turn replaced by that of its neighbour (the id with the
    last bit flipped), or by an empty one where there is no such neighbour.
    The pair id is the conversation's.  Conversations without an assistant turn
    make no pair."""
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("pair_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")) \
        .where("pair_id is not null and turn is not null")
    last = turns.where("role = 'assistant'").groupBy("pair_id").agg(
        F.max(F.struct("turn", "text")).alias("last")).select("pair_id", F.col("last.turn").alias("last"),
                                                              F.col("last.text").alias("reply"))
    other = last.select(F.col("pair_id").bitwiseXOR(F.lit(1)).alias("pair_id"), F.col("reply").alias("other"))
    swap = last.join(other, "pair_id", "left").select("pair_id", "last", F.coalesce("other", F.lit("")).alias("other"))
    chosen = turns.join(swap.select("pair_id"), "pair_id")
    at_swap = (F.col("turn") == F.col("last")) & (F.col("role") == "assistant")
    rejected = turns.join(swap, "pair_id").select(
        "pair_id", "turn", "role", F.when(at_swap, F.col("other")).otherwise(F.col("text")).alias("text"))
    return chosen, rejected
