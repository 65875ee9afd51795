"""A partitioned, offset-addressed message log as a DataFrame.

The same functions serve a Kafka stream (``sources.kafka``) and a parquet log:
both carry the ``MESSAGE`` columns.  Everything is a filter, projection,
aggregate or equi-join, so topic predicates reach the parquet scan.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamledger.operators.prefix import SPAN, running_total_non_null, running_total_null_safe
from streamledger.schemas import MESSAGE_COLUMNS, OFFSET_RANGE, PARTITION_KEY

# Width of the order blocks used to number offsets (see operators.prefix).
OFFSET_BLOCK = 1 << 20


def message_log(events: DataFrame, partitions: int = 3,
                block: int = OFFSET_BLOCK, span: int = SPAN) -> DataFrame:
    """The test log derived from ``events`` (FIXTURES.md section 2).

    topic = event_type; partition = user_id mod ``partitions``; offset =
    0-based position by ``event_id`` within (topic, partition); key = user_id;
    value = ``event_type,user_id``; timestamp = ts.

    Offsets are numbered by ``running_total`` so that no task ever holds a
    whole log partition, however skewed the topics are.
    """
    def keyed(ev: DataFrame) -> DataFrame:
        return ev.select(
            F.col("event_id"),
            F.col("event_type").alias("topic"),
            (F.col("user_id") % partitions).cast("int").alias("partition"),
            F.col("user_id").cast("string").alias("key"),
            F.concat(F.col("event_type"), F.lit(","), F.col("user_id").cast("string"))
            .alias("value"),
            F.col("ts").alias("timestamp"),
        )

    # Split on the *source* columns so both predicates reach the parquet scan;
    # row groups without nulls skip the second branch from their statistics.
    has_key = F.col("event_type").isNotNull() & F.col("user_id").isNotNull()
    main = running_total_non_null(
        keyed(events.where(has_key)), PARTITION_KEY, "event_id", None, "__n", block, span)
    rest = running_total_null_safe(
        keyed(events.where(~has_key)), PARTITION_KEY, "event_id", None, "__n", block, span)
    return main.unionByName(rest).select(
        "topic", "partition", (F.col("__n") - 1).alias("offset"), "key", "value",
        "timestamp")


def topic_set(topics: str | Iterable[str]) -> list[str]:
    """A comma list (or iterable) of topic names as a sorted set."""
    if isinstance(topics, str):
        topics = topics.split(",")
    return sorted({t for t in topics if t != ""})


def subscribe(log: DataFrame, topics: str | Iterable[str]) -> DataFrame:
    """Messages of the named topics (``IN`` list, pushed to the scan)."""
    return log.where(F.col("topic").isin(topic_set(topics)))


def full_match(c, pattern: str):
    """Whole-string regex match, as Kafka's ``subscribePattern`` uses."""
    return F.col(c).rlike(f"^(?:{pattern})\\z")


def subscribe_pattern(log: DataFrame, pattern: str) -> DataFrame:
    """S3: messages of every topic whose whole name matches ``pattern``."""
    return log.where(full_match("topic", pattern))


# S5 message handlers: which fields of a message reach the batch.
HANDLERS = {
    "kv": ["key", "value"],
    "tv": ["topic", "value"],
    "value": ["value"],
    "all": MESSAGE_COLUMNS,
}


def project(log: DataFrame, handler: str = "kv") -> DataFrame:
    """The message handler as a projection."""
    return log.select(*HANDLERS[handler])


def ranges_frame(spark: SparkSession,
                 ranges: Mapping[tuple[str, int], tuple[int, int]]) -> DataFrame:
    """An ``OFFSET_RANGE`` frame from an assignment map (driver metadata)."""
    rows = [(t, int(p), int(a), int(b)) for (t, p), (a, b) in sorted(ranges.items())]
    return spark.createDataFrame(rows, OFFSET_RANGE)


def read_ranges(log: DataFrame, ranges: DataFrame) -> DataFrame:
    """Only the assigned partitions, only ``from <= offset < until``.

    ``ranges`` has one row per log partition, so it is bounded by the topic
    metadata, not by the data; AQE broadcasts it when its measured size is
    small.  The topic list of an assignment is usually short: callers with a
    driver-side map may also pass it to ``subscribe`` first so the topic
    predicate reaches the scan.
    """
    r = ranges.select(
        F.col("topic").alias("__t"), F.col("partition").alias("__p"),
        "from_offset", "until_offset")
    joined = log.join(
        r, (log["topic"] == r["__t"]) & (log["partition"] == r["__p"]), "inner")
    return joined.where(
        (F.col("offset") >= F.col("from_offset")) & (F.col("offset") < F.col("until_offset"))
    ).select(*log.columns)


def read_assigned(log: DataFrame, ranges: Mapping[tuple[str, int], tuple[int, int | None]]) -> DataFrame:
    """S2 for an assignment held on the driver: the ranges become literals, one
    group of conditions per log partition, which reach the scan of a stored log
    as pushed filters.  An end of None is open."""
    wanted = F.lit(False)
    for (topic, partition), (lo, hi) in sorted(ranges.items(), key=lambda x: x[0]):
        one = (F.col("topic") == topic) & (F.col("partition") == partition) & (F.col("offset") >= lo)
        wanted = wanted | (one if hi is None else one & (F.col("offset") < hi))
    return log.where(F.col("topic").isin(sorted({t for t, _ in ranges}))).where(wanted)


def partition_extents(log: DataFrame) -> DataFrame:
    """Earliest and latest (next-to-write) offset of every log partition.

    What a broker reports as beginning / end offsets; on the parquet log a
    partial-combine aggregate.
    """
    return log.groupBy(*PARTITION_KEY).agg(
        F.min("offset").alias("earliest"), (F.max("offset") + 1).alias("latest"))


START_POLICIES = ("earliest", "latest", "none")
# The reference's reset names map onto two policies.
POLICY_ALIASES = {"smallest": "earliest", "largest": "latest"}


def resolve_starts(extents: DataFrame, stored: DataFrame, policy: str) -> DataFrame:
    """Where to start each *current* partition.

    A stored offset wins; otherwise the policy decides.  Partitions that
    appeared after the last commit are included (the reference reads only the
    stored map, D8).  ``none`` raises when any partition lacks a stored offset.
    ``stored`` has columns (topic, partition, offset).
    """
    policy = POLICY_ALIASES.get(policy, policy)
    if policy not in START_POLICIES:
        raise ValueError(f"unknown start policy {policy!r}")
    s = stored.select(*PARTITION_KEY, F.col("offset").alias("stored"))
    j = extents.join(s, PARTITION_KEY, "left")
    if policy == "none":
        missing = F.col("stored").isNull()
        start = F.when(~missing, F.col("stored")).otherwise(F.raise_error(F.concat(
            F.lit("no stored offset for "), F.col("topic"), F.lit("-"),
            F.col("partition").cast("string"))))
    else:
        start = F.coalesce(F.col("stored"), F.col(policy))
    return j.select(*PARTITION_KEY, start.alias("offset"))


def plan_ranges(starts: DataFrame, extents: DataFrame, max_per_partition: int) -> DataFrame:
    """Next batch's range per partition, capped at ``max_per_partition``.

    ``max_per_partition`` = batch interval (s) x ``maxRatePerPartition``; the
    cap applies to every partition separately, exactly as in the reference.
    """
    j = starts.join(extents.select(*PARTITION_KEY, "latest"), PARTITION_KEY, "inner")
    start = F.col("offset")
    return j.select(
        *PARTITION_KEY,
        start.alias("from_offset"),
        F.greatest(start, F.least(F.col("latest"), start + F.lit(max_per_partition)))
        .alias("until_offset"))


def next_batch(log: DataFrame, stored: DataFrame, policy: str,
               max_per_partition: int) -> DataFrame:
    """The messages of the next micro-batch of a consumer: start where the
    offset table says (S4, else ``policy``), cap every partition (S7) and read
    only those ranges (S2).  ``stored`` has (topic, partition, offset)."""
    extents = partition_extents(log)
    ranges = plan_ranges(resolve_starts(extents, stored, policy), extents,
                         max_per_partition)
    return read_ranges(log, ranges)


def with_batch_ids(log: DataFrame, max_per_partition: int) -> DataFrame:
    """Tag each message with the batch that reads it when the whole log is
    consumed from the earliest offsets under a per-partition cap (S4 + S7).

    The log fixture numbers every partition from 0, so the batch is
    ``offset div cap``; no extents join is needed.
    """
    return log.withColumn(
        "batch_id", F.expr(f"`offset` div {int(max_per_partition)}").cast("bigint"))
