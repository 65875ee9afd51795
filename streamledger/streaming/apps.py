"""The reference's streaming programs as runnable apps.

Each app opens a ``MESSAGE`` stream -- Kafka through Spark's connector, a stored
log read by offset (``--log``), or a folder of parquet files (``--feed``) -- and runs
one of the jobs in ``streaming.jobs``.  Offsets live in an ``OffsetStore`` under
the output folder (K4: in its rows); a new checkpoint starts from them (section
3.3), other partitions by ``--reset``.

    python -m streamledger <app> --bootstrap h:9092 --group g --topics a,b \
        --partitions a:3,b:1 --out <shared folder> [--feed <folder>] [--once]

``--partitions`` states how many partitions the topics have now (topic
metadata, which Spark's source does not hand out): stored offsets are used for
those, the policy for the rest, and the per-partition cap is multiplied by
their number.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from streamledger import fsio
from streamledger.operators import counts
from streamledger.schemas import MESSAGE, MESSAGE_COLUMNS
from streamledger.sources import kafka
from streamledger.sources import log as logsrc
from streamledger.sources import stored as storedlog
from streamledger.streaming import jobs, sinks, tables


def known_partitions(text: str | None, topics: str | None) -> list[tuple[str, int]]:
    """``a:3,b:1`` as (topic, partition) pairs, of the wanted topics only."""
    out = []
    for item in (text or "").split(","):
        topic, _, n = item.rpartition(":")
        if topic and (topics is None or topic in logsrc.topic_set(topics)):
            out += [(topic, p) for p in range(int(n))]
    return out


def open_stream(spark: SparkSession, args: argparse.Namespace,
                stored: Mapping[tuple[str, int], int] | None = None) -> DataFrame:
    """The input stream.  ``stored``: offsets to go on from (None: the app keeps
    none); partitions without one start by the policy."""
    if args.log:
        if stored is None:
            raise SystemExit("--log is for the apps that keep offsets in a table")
        schema = spark.read.parquet(args.log).select(*MESSAGE_COLUMNS).schema if fsio.folders(spark, args.log) else MESSAGE
        return storedlog.read_stream(spark, args.log, schema, topics=args.topics, pattern=args.pattern, policy=args.reset,
                                     cap=args.max_per_partition, offsets=f"{args.out}/offsets", group=args.group)
    if args.feed:
        if args.max_per_partition is not None:
            raise SystemExit("--max-per-partition needs Kafka: a folder has no offsets to cap by")
        stream, rows = jobs.read_feed(spark, args.feed), None
        if stored is not None or args.reset not in ("earliest", "smallest"):
            rows = spark.read.schema(stream.schema).parquet(args.feed)
        for pick, wanted in ((logsrc.subscribe, args.topics), (logsrc.subscribe_pattern, args.pattern)):
            if wanted:
                stream, rows = pick(stream, wanted), rows and pick(rows, wanted)
                break
        if rows is None:
            return stream
        return jobs.start_at(stream, jobs.resolve(logsrc.partition_extents(rows), stored or {}, args.reset))
    partitions = known_partitions(args.partitions, args.topics)
    wanted = {k: v for k, v in (stored or {}).items() if k in partitions}
    if stored and not partitions:
        raise SystemExit("--partitions is needed to go on from stored offsets")
    if args.max_per_partition is not None and not partitions:
        raise SystemExit("--partitions is needed to turn the cap per partition into one per trigger")
    opts = kafka.source_options(
        args.bootstrap, topics=args.topics, pattern=args.pattern, stored=wanted, reset=args.reset,
        max_per_partition=args.max_per_partition, partitions=partitions if stored is not None else (),
        total_partitions=len(partitions))
    return kafka.read_stream(spark, opts)


def _store(spark, args):
    return sinks.OffsetStore(spark, f"{args.out}/offsets")


def _guarded(spark, args, work):
    """A guarded job on the stream from the group's stored offsets; with Kafka
    the consumed ranges come from the checkpoint, as the source reported them."""
    store = _store(spark, args)
    chk = f"{args.out}/{args.checkpoint}"
    ranges = None if args.feed or args.log else kafka.checkpoint_ranges(spark, chk)
    fn = sinks.guarded(store, args.group, work, ranges, claim=True)
    stream = open_stream(spark, args, store.current_map(args.group))
    if args.log and args.once:
        return jobs.run_batches(stream, fn, chk)
    return jobs.run_foreach(stream, fn, chk, args.once)


def direct_word_count(spark, args):
    """Per-batch word count, printed (A1 F1 K1 K2)."""
    show = sinks.console_sink(args.rows, summarise=lambda df: counts.word_count(df, "value"))
    return jobs.run_foreach(open_stream(spark, args), show, f"{args.out}/{args.checkpoint}", args.once)


def checkpoint_count(spark, args):
    """Records per non-empty batch, resumable from its checkpoint."""
    show = sinks.console_sink(args.rows, summarise=counts.record_count)
    return jobs.run_foreach(open_stream(spark, args), show, f"{args.out}/{args.checkpoint}", args.once)


def running_word_count(spark, args):
    """Cumulative word count with state (A2)."""
    return jobs.run_running_word_count(
        open_stream(spark, args), f"{args.out}/counts", f"{args.out}/{args.checkpoint}",
        args.mode, args.once)


def offsets_count(spark, args):
    """Count per batch, then a guarded offset commit."""
    return _guarded(spark, args, sinks.record_count_work(f"{args.out}/counts"))


def idempotent_upsert(spark, args):
    """Keyed upsert of ``name,order_id``, then offsets (K3 K5)."""
    return _guarded(spark, args, tables.upsert_work(f"{args.out}/table", args.bad))


def _tables(spark, args):
    store = _store(spark, args)
    return [kind(spark, f"{args.out}/{name}", store, args.group)      # a group keeps one of them
            for kind, name in ((tables.UpsertTable, "table"), (tables.CountTable, "words"))
            if fsio.folders(spark, f"{args.out}/{name}")]


def compact_tables(spark, args):
    """Rows of the group's tables into their bases; run it beside the stream."""
    for table in _tables(spark, args):
        table.compact()


def vacuum_tables(spark, args):
    """Remove folders that nothing names, older than ``--grace`` hours."""
    for table in _tables(spark, args):
        table.vacuum(args.grace * 3600)


def stored_word_count(spark, args):
    """Running counts that live with the offsets and go on under a new
    checkpoint (A2 O4)."""
    return _guarded(spark, args, tables.running_count_work(f"{args.out}/words"))


def seed_offsets(spark, args):
    """Offset 0 for partitions of ``--partitions`` without one."""
    _store(spark, args).seed(known_partitions(args.partitions, args.topics), args.group)


def transactional_append(spark, args):
    """``name,id`` rows with their offsets through the file sink (K4), from the
    offsets of the rows that are committed."""
    rows = jobs.appended_offsets(spark, f"{args.out}/rows").collect()        # a row per log partition
    stored = {(r.topic, r.partition): r.offset for r in rows}
    return jobs.run_append_with_offsets(
        open_stream(spark, args, stored), f"{args.out}/rows", f"{args.out}/{args.checkpoint}", args.once)


APPS: dict[str, Callable] = {
    "direct-word-count": direct_word_count,
    "checkpoint-count": checkpoint_count,
    "running-word-count": running_word_count,
    "offsets-count": offsets_count,
    "idempotent-upsert": idempotent_upsert,
    "transactional-append": transactional_append,
    "stored-word-count": stored_word_count,
    "compact-upsert": compact_tables,
    "vacuum": vacuum_tables,
    "seed-offsets": seed_offsets,
}


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="streamledger")
    ap.add_argument("app", choices=sorted(APPS))
    ap.add_argument("--bootstrap", default=None, help="Kafka bootstrap servers")
    ap.add_argument("--group", default="streamledger")
    ap.add_argument("--topics", default=None, help="comma list (S1)")
    ap.add_argument("--pattern", default=None, help="topic regex (S3)")
    ap.add_argument("--reset", default="earliest",
                    help="earliest|latest|none (also smallest|largest)")
    ap.add_argument("--max-per-partition", type=int, default=None,
                    help="messages per partition per batch (S7)")
    ap.add_argument("--out", required=True, help="shared folder for state and output")
    ap.add_argument("--feed", default=None, help="folder of parquet files instead of Kafka")
    ap.add_argument("--log", default=None, help="stored log, topic=<t>/partition=<p> folders, read by offset")
    ap.add_argument("--partitions", default=None, help="current partitions of the topics, a:3,b:1")
    ap.add_argument("--checkpoint", default="checkpoint", help="checkpoint folder under --out")
    ap.add_argument("--mode", default="update", choices=["complete", "update"])
    ap.add_argument("--bad", default="fail", choices=["fail", "quarantine"], help="messages that are no pair (P6)")
    ap.add_argument("--grace", type=float, default=168.0, help="hours that vacuum leaves folders alone")
    ap.add_argument("--rows", type=int, default=None, help="rows shown per batch (K2); all if not given")
    ap.add_argument("--once", action="store_true", help="drain the input and stop")
    return ap


def main(argv: list[str] | None = None, spark: SparkSession | None = None):
    args = parser().parse_args(argv)
    if not args.feed and not args.log and not args.bootstrap:
        raise SystemExit("--bootstrap (Kafka), --log or --feed is required")
    if spark is None:
        spark = SparkSession.builder.appName(f"streamledger {args.app}").getOrCreate()
    q = APPS[args.app](spark, args)
    if q is not None and not args.once:
        q.awaitTermination()
    return q
