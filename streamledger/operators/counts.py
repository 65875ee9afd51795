"""Counting operators (A1-A5).

All of them are ``groupBy().agg(count/sum)``: Spark runs a partial aggregate
in every map task before the exchange, so a word that holds a third of all
tokens still sends only one partial row per map task to its reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamledger.functions.text import (
    java_length, space_tokens, text_lines, whitespace_tokens)
from streamledger.operators.prefix import running_total_non_null

# Width of the batch-id blocks used for running counts, and how far batch ids
# may go before blocks of blocks would pay (operators.prefix).
BATCH_BLOCK = 1 << 20
BATCH_SPAN = 1 << 40


def tokens(df: DataFrame, col: str = "value", keep: Sequence[str] = (),
           tokenizer=whitespace_tokens) -> DataFrame:
    """P1 (default) or P2 flattened: one row per token, column ``word``."""
    return df.select(*keep, F.explode(tokenizer(col)).alias("word"))


def word_count(df: DataFrame, col: str = "value", by: Sequence[str] = ()) -> DataFrame:
    """A1: ``flatMap(split).map((_, 1)).reduceByKey(_ + _)`` -> (by..., word, n)."""
    return tokens(df, col, by).groupBy(*by, "word").agg(F.count(F.lit(1)).alias("n"))


def record_count(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """A3 / A4: rows per group (or in total when ``by`` is empty)."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


def token_lengths(df: DataFrame, col: str = "value") -> DataFrame:
    """S6 -> P2 -> P4 -> P5: lines, space tokens, one (total, num) per token."""
    lines = df.select(F.explode(text_lines(col)).alias("line"))
    toks = lines.select(F.explode(space_tokens("line")).alias("token"))
    return toks.select(java_length("token").alias("total"), F.lit(1).cast("bigint").alias("num"))


def length_summary(records: DataFrame) -> DataFrame:
    """A4 + A5: token count, total length and average length in one pass."""
    return records.agg(
        F.count(F.lit(1)).alias("num"),
        F.coalesce(F.sum("total"), F.lit(0)).cast("bigint").alias("total"),
        (F.sum("total") / F.count(F.lit(1))).alias("avg_len"),
    )


def running_word_count_update(batch_counts: DataFrame, block: int = BATCH_BLOCK) -> DataFrame:
    """A2, ``update`` output: for each batch, the words it touched with their
    cumulative count.  ``batch_counts`` = (batch_id, word, n) from A1.

    Cumulative sums per word use the two-level running total, so a word seen
    in every batch is still spread over many tasks.
    """
    # tokens are never null (split yields no null elements): one branch
    return running_total_non_null(batch_counts, ["word"], "batch_id", "n", "total", block, BATCH_SPAN).select(
        "batch_id", "word", F.col("total").alias("n"))


def running_word_count_complete(batch_counts: DataFrame) -> DataFrame:
    """A2, ``complete`` output (the reference's ``updateStateByKey``): the
    table of every word seen so far, as it stands after the last batch.  Every
    batch replaces it; none of its earlier states is kept."""
    return batch_counts.groupBy("word").agg(F.sum("n").alias("n"))
