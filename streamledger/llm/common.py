"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir

# One task's working set: texts are handled in blocks of about this size.
BLOCK_BYTES = 4 << 20
# Rows of text in an Arrow batch.
BATCH_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, read by Spark so that any store it knows will do."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage,
    and survives the loss of any executor."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_freed(spark: SparkSession):
    """Shuffle files of what runs inside go when it ends.  Otherwise they stay,
    beside all that is written later, until the driver next collects garbage.
    Only for writes: a frame that is run again would be shuffled again."""
    conf, key = spark.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    held = conf.get(key, None)
    conf.set(key, "true")
    try:
        yield
    finally:
        if held is None:
            conf.unset(key)
        else:
            conf.set(key, held)


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def numbered(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """``df`` with a number for each row, written so that it never changes, and
    the name of that column."""
    row = free_name(df, "row")
    return materialize(df.withColumn(row, F.monotonically_increasing_id()), label), row


def small_batches(df: DataFrame, rows: int = BATCH_ROWS) -> DataFrame:
    """``df``, after lowering the session's Arrow batch size to ``rows``: a batch
    of texts is held by the JVM and by Python at once, and texts may be long."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    held = int(conf.get(key))
    if held <= 0 or held > rows:
        conf.set(key, str(rows))
    return df


def utf8(column: str) -> Column:
    """A text column as UTF-8 bytes; null stays null."""
    return F.col(column).cast("string").cast("binary")


def total_bytes(df: DataFrame, column: str) -> int:
    """Bytes of a text column over all rows."""
    return df.agg(F.sum(F.octet_length(F.col(column)))).first()[0] or 0


def blocks_for(n_bytes: int, block: int = BLOCK_BYTES) -> int:
    """How many blocks of about ``block`` bytes hold ``n_bytes``."""
    return max(1, -(-n_bytes // block))
