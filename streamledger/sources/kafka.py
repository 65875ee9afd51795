"""Kafka through Spark's own connector (S1-S5, S7 on a broker).

The connector jar is not in the development image, so only the option maps
are tested here; ``read_stream`` is what a deployment calls.  Spark's Kafka
source rejects consumer settings it manages itself (``auto.offset.reset``,
``enable.auto.commit``, deserialisers, ``group.id`` unless asked for), so the
reference's parameters are translated, not forwarded.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamledger import fsio
from streamledger.sources.log import POLICY_ALIASES, topic_set

# Consumer settings the Spark source manages itself.
MANAGED = (
    "auto.offset.reset", "enable.auto.commit", "key.deserializer",
    "value.deserializer", "group.id", "metadata.broker.list",
)
# Kafka's special offsets in a startingOffsets JSON.
EARLIEST, LATEST = -2, -1


def starting_offsets_json(stored: Mapping[tuple[str, int], int],
                          default: int | None = None,
                          partitions: Iterable[tuple[str, int]] = ()) -> str:
    """``startingOffsets`` JSON from stored offsets.

    Partitions in ``partitions`` without a stored offset get ``default``
    (``EARLIEST`` / ``LATEST``), so partitions added after the last commit are
    read too (D8).
    """
    out: dict[str, dict[str, int]] = {}
    for (t, p), off in stored.items():
        out.setdefault(t, {})[str(int(p))] = int(off)
    if default is not None:
        for t, p in partitions:
            out.setdefault(t, {}).setdefault(str(int(p)), default)
    return json.dumps(out, sort_keys=True)


def source_options(bootstrap: str, topics: str | Iterable[str] | None = None,
                   pattern: str | None = None,
                   stored: Mapping[tuple[str, int], int] | None = None,
                   reset: str = "earliest",
                   max_per_partition: int | None = None,
                   partitions: Iterable[tuple[str, int]] = (),
                   total_partitions: int | None = None,
                   extra: Mapping[str, str] | None = None) -> dict[str, str]:
    """Options for ``readStream.format("kafka")`` from the reference's
    parameters: broker list, topic list or pattern, stored offsets, reset
    policy and per-partition rate.

    With ``partitions``, the current ones of the wanted topics, the stream is
    assigned to exactly these (``assign``, S2), each from its stored offset or
    by the policy; stored offsets of other topics are not used.  Otherwise it
    subscribes (S1) or matches a pattern (S3) and starts by the policy.
    The per-partition cap (S7) becomes ``maxOffsetsPerTrigger`` = cap x
    partitions, which Spark shares out by backlog: exact only without skew
    (the parquet path ``plan_ranges`` is exact).  ``total_partitions`` is their
    number where they are not assigned.
    """
    partitions = list(partitions)
    reset = POLICY_ALIASES.get(reset, reset)
    if reset not in ("earliest", "latest", "none"):
        raise ValueError(f"unknown reset policy {reset!r}")
    opts = {"kafka.bootstrap.servers": bootstrap}
    stored = stored or {}
    if partitions:
        parts = sorted(partitions)
        assign: dict[str, list[int]] = {}
        for t, p in parts:
            assign.setdefault(t, []).append(int(p))
        opts["assign"] = json.dumps(assign, sort_keys=True)
        missing = [tp for tp in parts if tp not in stored]
        if reset == "none" and missing:
            raise ValueError(f"no stored offset for {missing}")
        default = {"earliest": EARLIEST, "latest": LATEST}.get(reset)
        opts["startingOffsets"] = starting_offsets_json(
            {tp: stored[tp] for tp in parts if tp in stored}, default, parts)
    elif reset == "none":
        raise ValueError("reset 'none' needs a stored offset for every partition")
    else:
        if pattern is not None:
            opts["subscribePattern"] = pattern
        elif topics is not None:
            opts["subscribe"] = ",".join(topic_set(topics))
        else:
            raise ValueError("need topics, a pattern or partitions")
        opts["startingOffsets"] = reset
    if max_per_partition is not None:
        n = len(partitions) or total_partitions
        if not n:
            raise ValueError("the cap per partition needs the number of partitions")
        opts["maxOffsetsPerTrigger"] = str(int(max_per_partition) * n)
    for k, v in (extra or {}).items():
        if k.replace("kafka.", "", 1) in MANAGED:
            continue
        opts[k] = str(v)
    return opts


def read_stream(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """A ``MESSAGE`` stream from Kafka (needs the spark-sql-kafka package)."""
    raw = spark.readStream.format("kafka").options(**options).load()
    return raw.select(
        "topic", "partition", "offset",
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "timestamp")


def progress_ranges(start: str | None, end: str) -> list[tuple[str, int, int, int]]:
    """O1 from what the source reports: the ranges between two offset JSONs of
    a query's progress, ``{"topic": {"0": 12}}``.  Offsets without a message
    count as consumed; a partition that is new in ``end`` starts at 0."""
    before = json.loads(start) if start else {}
    return sorted((t, int(p), int(before.get(t, {}).get(p, 0)), int(o))
                  for t, parts in json.loads(end).items() for p, o in parts.items())


def checkpoint_ranges(spark: SparkSession, checkpoint: str):
    """The consumed ranges of a batch, for ``sinks.guarded``: the engine writes a
    batch's end offsets to its checkpoint before it runs the batch.  The first
    batch starts where the source was told to, kept beside its offsets."""
    def offsets_of(path: str) -> str | None:
        text = fsio.read_text(spark, path)
        return text.strip().splitlines()[-1] if text else None

    def ranges(batch_id: int) -> list[tuple[str, int, int, int]]:
        end = offsets_of(f"{checkpoint}/offsets/{batch_id}")
        if end is None:
            raise RuntimeError(f"no offsets of batch {batch_id} in {checkpoint}")
        start = offsets_of(f"{checkpoint}/offsets/{batch_id - 1}") if batch_id else \
            offsets_of(f"{checkpoint}/sources/0/0")
        return progress_ranges(start, end)
    return ranges
