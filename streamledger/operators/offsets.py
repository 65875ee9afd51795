"""The offset table and its operators.

The reference keeps offsets in four client-side stores (a ZooKeeper tree, a
wide HBase row, tall HBase rows, a SQL table).  Here they are one append-only
table ``OFFSETS_LOG`` (group_id, topic, partition, offset, batch_id) with
DataFrame operators over it; the other layouts are views of it (O7).
Offset tables are bounded by (groups x partitions x batches), not by the data.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import lru_cache

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streamledger.schemas import PARTITION_KEY
from streamledger.sources.log import topic_set


def batch_ranges(batch: DataFrame, by: Iterable[str] = ()) -> DataFrame:
    """O1: the consumed range of every partition in a batch.

    ``[min(offset), max(offset) + 1)``.  A partition with no message in the
    batch has no row (the reference shows a zero-length range).
    """
    keys, spans = _range_columns(batch.sparkSession.sparkContext)
    return batch.groupBy(*by, *keys).agg(*spans)


@lru_cache(maxsize=4)
def _range_columns(sc: SparkContext) -> tuple[list[Column], list[Column]]:
    """Made once: a stream asks for them in every batch, and each takes the gateway
    a dozen calls."""
    return ([F.col(c) for c in PARTITION_KEY],
            [F.min("offset").alias("from_offset"), (F.max("offset") + 1).alias("until_offset")])


def commit_rows(ranges: DataFrame, group_id: str, batch_id: Column | int) -> DataFrame:
    """O3: rows to append to ``OFFSETS_LOG`` for a batch's ranges."""
    bid = batch_id if isinstance(batch_id, Column) else F.lit(batch_id)
    return ranges.select(
        F.lit(group_id).alias("group_id"), *PARTITION_KEY,
        F.col("until_offset").alias("offset"), bid.cast("bigint").alias("batch_id"))


def current_offsets(offsets_log: DataFrame, group_id: str,
                    topics: str | Iterable[str] | None = None) -> DataFrame:
    """O2 + O6: next offset per partition for a group (and topics).

    Typed equality on ``group_id`` and ``topic`` reaches the parquet scan; the
    latest commit wins (``max_by`` has a partial aggregate, so a partition
    with a long history is combined map-side).
    """
    log = offsets_log.where(F.col("group_id") == group_id)
    if topics is not None:
        log = log.where(F.col("topic").isin(topic_set(topics)))
    return log.groupBy("group_id", *PARTITION_KEY).agg(
        F.max_by("offset", "batch_id").alias("offset"))


VERDICTS = ("commit", "skip", "raise")


def guard(ranges: DataFrame, current: DataFrame) -> DataFrame:
    """Verdict of a guarded commit, one per range.

    ``commit`` when the stored offset equals the range start (or nothing is
    stored); ``skip`` when it already equals the range end (a replayed batch);
    ``raise`` otherwise (stale or gapped).  ``current`` must hold at most one
    row per partition (as ``current_offsets`` returns).
    """
    cur = current.select(*PARTITION_KEY, F.col("offset").alias("stored"))
    j = ranges.join(cur, PARTITION_KEY, "left")
    start = F.coalesce(F.col("stored"), F.col("from_offset"))
    verdict = (F.when(start == F.col("from_offset"), "commit")
               .when(F.col("stored") == F.col("until_offset"), "skip")
               .otherwise("raise"))
    return j.select(*ranges.columns, "stored", verdict.alias("verdict"))


def range_verdict(from_offset: int, until_offset: int, stored: int | None) -> str:
    """O4 for one range held on the driver (bounded offset metadata); the
    same rule as ``guard``."""
    if (from_offset if stored is None else stored) == from_offset:
        return "commit"
    if stored == until_offset:
        return "skip"
    return "raise"


def combine_verdicts(verdicts: list[str]) -> str:
    """One verdict for a batch: no ranges -> ``empty``; all ``commit`` ->
    ``commit``; all ``skip`` -> ``skip``; anything else (a ``raise``, or a mix
    of skip and commit) -> ``raise``."""
    if not verdicts:
        return "empty"
    if all(v == "commit" for v in verdicts):
        return "commit"
    if all(v == "skip" for v in verdicts):
        return "skip"
    return "raise"


def batch_verdict(verdicts: DataFrame) -> str:
    """``combine_verdicts`` over a ``guard`` result (one row per partition)."""
    return combine_verdicts([r[0] for r in verdicts.select("verdict").collect()])


def seed_missing(partitions: DataFrame, current: DataFrame, group_id: str,
                 start: int = 0) -> DataFrame:
    """Seed rows (offset ``start``) for partitions with no stored offset."""
    missing = partitions.select(*PARTITION_KEY).distinct().join(
        current.select(*PARTITION_KEY), PARTITION_KEY, "left_anti")
    return missing.select(
        F.lit(group_id).alias("group_id"), *PARTITION_KEY,
        F.lit(start).cast("bigint").alias("offset"))


# --- O7 layouts -----------------------------------------------------------

def to_tall(current: DataFrame) -> DataFrame:
    """Tall rows: rowkey ``topic_partition`` with topic, partition, offset."""
    return current.select(
        F.concat_ws("_", "topic", F.col("partition").cast("string")).alias("rowkey"),
        "topic", "partition", "offset")


TALL_KEY = r"^(.*)_(\d+)$"


def tall_key_parts(rowkey) -> tuple[Column, Column]:
    """(topic, partition) of a ``topic_partition`` key; the partition is the
    digits after the *last* underscore, since topic names may contain ``_``."""
    c = F.col(rowkey) if isinstance(rowkey, str) else rowkey
    return (F.regexp_extract(c, TALL_KEY, 1).alias("topic"),
            F.regexp_extract(c, TALL_KEY, 2).cast("int").alias("partition"))


def from_tall(tall: DataFrame, group_id: str) -> DataFrame:
    """Parse tall rows back.  Tall rows carry no group, so it is an argument."""
    return tall.select(F.lit(group_id).alias("group_id"), *tall_key_parts("rowkey"),
                       "offset")


def to_path(current: DataFrame) -> DataFrame:
    """Path tree: ``topic/group/partition`` -> offset as text."""
    return current.select(
        F.concat_ws("/", "topic", "group_id", F.col("partition").cast("string")).alias("path"),
        F.col("offset").cast("string").alias("data"))


def from_path(paths: DataFrame) -> DataFrame:
    """Parse paths back, anchored at the end (group ids contain no ``/``)."""
    rx = r"^(.*)/([^/]*)/(\d+)$"
    return paths.select(
        F.regexp_extract("path", rx, 2).alias("group_id"),
        F.regexp_extract("path", rx, 1).alias("topic"),
        F.regexp_extract("path", rx, 3).cast("int").alias("partition"),
        F.col("data").cast("bigint").alias("offset"))


def write_path_tree(current: DataFrame, folder: str) -> None:
    """The path tree as stored files: one small file for each partition, in
    ``topic=<t>/group_id=<g>/partition=<p>`` (one row a log partition).  Paths
    that are there already are replaced, others stay."""
    rows = current.select("topic", "group_id", "partition", F.col("offset").cast("string").alias("value"))
    rows.repartition("topic", "group_id", "partition").write.mode("overwrite") \
        .option("partitionOverwriteMode", "dynamic").partitionBy("topic", "group_id", "partition").text(folder)


def read_path_tree(spark: SparkSession, folder: str) -> DataFrame:
    """Current offsets from the files of a path tree: the path gives topic, group
    and partition, the content the offset."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt") \
        .load(folder).select("content", F.col("_metadata.file_path").alias("file"))

    def part(name: str) -> Column:
        found = F.regexp_extract("file", f"/{name}=([^/]*)/", 1)
        for _ in range(2):          # escaped as a folder name, then as a URI
            found = F.url_decode(F.replace(found, F.lit("+"), F.lit("%2B")))
        return found.alias(name)
    return files.select(part("group_id"), part("topic"), part("partition").cast("int").alias("partition"),
                        F.trim(F.regexp_replace(F.decode("content", "UTF-8"), r"\s", "")).cast("bigint").alias("offset"))


def to_wide(current: DataFrame, partitions: Iterable[int]) -> DataFrame:
    """Wide row: rowkey ``topic-group``, one column per partition.

    The partition list is topic metadata, passed in so ``pivot`` needs no
    extra job to discover its values.
    """
    parts = sorted(int(p) for p in partitions)
    keyed = current.select(
        F.concat_ws("-", "topic", "group_id").alias("rowkey"),
        F.col("partition").cast("string").alias("partition"), "offset")
    return keyed.groupBy("rowkey").pivot("partition", [str(p) for p in parts]).agg(
        F.max("offset"))


def from_wide(wide: DataFrame, group_id: str) -> DataFrame:
    """Unpivot wide rows of one group back to one row per partition.

    Both topic names and group ids may contain ``-``, so the key
    ``topic-group`` can only be split knowing the group: rows whose key ends
    with ``-<group_id>`` are that group's, and the rest of the key is the
    topic (the reader always asks for one group, as O2 does).
    """
    suffix = f"-{group_id}"
    cols = [c for c in wide.columns if c != "rowkey"]
    mine = wide.where(F.col("rowkey").endswith(suffix))
    long = mine.unpivot("rowkey", cols, "partition", "offset").where(
        F.col("offset").isNotNull())
    return long.select(
        F.lit(group_id).alias("group_id"),
        F.col("rowkey").substr(F.lit(1), F.length("rowkey") - F.lit(len(suffix)))
        .alias("topic"),
        F.col("partition").cast("int").alias("partition"),
        F.col("offset").cast("bigint").alias("offset"))
