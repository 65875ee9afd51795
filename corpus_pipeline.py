"""Cleaning a document corpus: five stages, each one of the llm operators.

Every stage takes (spark, docs, sf_dir) and works on all the rows its
predecessor kept.  All but the last return the columns of ``documents``:

1. toxicity: documents predicted toxic go.
2. simhash: of every group of near copies one row stays: the smallest id (rows
   without one come last), among equal ids the smallest text.
3. suffix: strings of 100 bytes that start earlier elsewhere are cut out of the
   texts (a character cut in two goes as a whole); ``n_chars`` follows the text.
   A document with nothing left stays, with an empty text.
4. leaks: documents that hold a ten-word window of a benchmark item go.
5. mixing: how many words of each document a mix by source takes.

Every row is a document of its own, also without an id or with another row's:
stages 2 and 4 write their input once with a number for each row and decide by
that.  An empty table passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamledger.llm.common import free_name, materialize, table
from streamledger.llm.leaks import drop_contaminated
from streamledger.llm.mixing import mix
from streamledger.llm.simhash import drop_near_duplicates
from streamledger.llm.suffix import remove_repeats
from streamledger.llm.toxicity import drop_toxic, train


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8, trained on these documents' labels."""
    return drop_toxic(docs, train(docs, table(spark, sf_dir, "labels")))


def simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: three-word shingles, two bits."""
    return drop_near_duplicates(docs, shingle=3, max_bits=2)


def suffix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: 100 bytes."""
    others = [c for c in docs.columns if c not in ("text", "n_chars")]
    null = free_name(docs, "null")
    marked = docs.withColumn(null, F.col("text").isNull())
    cut = remove_repeats(marked, length=100, with_text=True, carry=(*others, null))
    text = F.when(~F.col("carried_" + null), F.col("kept_text"))
    size = F.char_length(F.coalesce(text, F.lit("")))
    return cut.select(*(
        text.alias(c) if c == "text" else size.cast(docs.schema[c].dataType).alias(c) if c == "n_chars"
        else F.col("carried_" + c).alias(c) for c in docs.columns))


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: ten words."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"), window=10)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: weights 5, 2, 1, one and a half times all words."""
    return mix(docs, weights=(5, 2, 1), share=1.5, most=2)


STAGES = [("toxicity", toxicity), ("simhash", simhash), ("suffix", suffix), ("leaks", leaks), ("mixing", mixing)]

# Training, links and suffix arrays have no SQL form; tests compare the stages
# with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written as Parquet
    and read again as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
