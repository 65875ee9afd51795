"""

Each job takes a streaming ``MESSAGE`` DataFrame (Kafka via
``sources.kafka.read_stream`` or a folder of parquet files via ``read_feed``),
a checkpoint folder and output folders in the shared checkpoint root, and
runs until the input is drained (``availableNow``) or forever.

The ``STREAM_QUERIES`` registered with the driver write the log derived from
``events`` into a plain folder in four parts (even shares of every partition),
one after the other, with an empty part behind them; each part becomes a
micro-batch.  The ``resume`` queries have two parts: they stop after the first
and go on with a new checkpoint, from stored offsets only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping
from functools import reduce

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from streamledger import fsio
from streamledger.operators import counts, offsets, upsert
from streamledger.plans import queries as Q
from streamledger.plans.oracles import ORACLES, SPLIT, even_parts_sql, parts_sql
from streamledger.schemas import APPEND_ROW, MESSAGE, OFFSET_RANGE, PARTITION_KEY
from streamledger.session import scratch_dir
from streamledger.sources import log as logsrc
from streamledger.sources import stored
from streamledger.streaming import sinks, tables


def _start(writer, available_now: bool):
    return (writer.trigger(availableNow=True) if available_now
            else writer.trigger(processingTime="2 seconds")).start()


def _run(writer, checkpoint: str, available_now: bool):
    q = _start(writer.option("checkpointLocation", checkpoint), available_now)
    if available_now:
        q.awaitTermination()
    return q


def run_name(checkpoint: str) -> str:
    """A short name for the run that a checkpoint identifies."""
    return hashlib.sha256(checkpoint.encode()).hexdigest()[:12]


def read_feed(spark: SparkSession, folder: str, schema=None) -> DataFrame:
    """A folder of parquet files as a stream, all new files in one batch.

    The schema is that of the files there (the log keeps its source's timestamp
    type), or ``schema`` / ``MESSAGE`` where there are none yet.
    """
    if schema is None:
        schema = spark.read.parquet(folder).schema if fsio.folders(spark, folder) else MESSAGE
    return spark.readStream.schema(schema).parquet(folder)


def run_foreach(stream: DataFrame, fn, checkpoint: str, available_now: bool = True):
    """K1: ``foreachRDD`` -> ``foreachBatch``, resumable from ``checkpoint``."""
    return _run(stream.writeStream.foreachBatch(fn), checkpoint, available_now)


def run_console(stream: DataFrame, checkpoint: str, num_rows: int = 10,
                output_mode: str = "append", available_now: bool = True):
    """K2 by Spark's console sink: ``print()`` shows the first 10 rows of a
    batch; ``sinks.console_sink`` prints every row."""
    return _run(stream.writeStream.format("console").outputMode(output_mode)
                .option("numRows", num_rows).option("truncate", False), checkpoint, available_now)


def run_running_word_count(stream: DataFrame, out: str, checkpoint: str,
                           mode: str = "update", available_now: bool = True):
    """A2: ``updateStateByKey`` -> streaming aggregation with a state store.

    ``update`` emits the words a batch changed (O(batch) per batch), each batch
    in its own folder.  ``complete`` keeps one table of all words, written anew
    by every batch: two folders in turn, and a file that names the one that is
    whole.  State lives in the checkpoint, so counts survive a restart.
    """
    agg = counts.word_count(stream, "value")
    if mode == "complete":
        def sink(df: DataFrame, batch_id: int) -> None:
            side = f"side-{batch_id % 2}"
            df.write.mode("overwrite").parquet(f"{out}/{side}")
            fsio.write_text(df.sparkSession, f"{out}/_current", side, overwrite=True)
    else:
        def sink(df: DataFrame, batch_id: int) -> None:
            sinks.write_batch(df, out, batch_id, run_name(checkpoint))
    return _run(agg.writeStream.outputMode(mode).foreachBatch(sink), checkpoint, available_now)


def current_word_counts(spark: SparkSession, out: str) -> DataFrame:
    """The table that complete mode keeps."""
    return spark.read.parquet(f"{out}/{fsio.read_text(spark, f'{out}/_current')}")


def run_append_with_offsets(stream: DataFrame, out: str, checkpoint: str,
                            available_now: bool = True, mode: str = "fail"):
    """K4: rows carry topic/partition/offset and go through the file sink,
    whose commit log makes each batch's rows appear exactly once; offsets are
    derived from the committed rows, so rows and offsets commit together.

    That log numbers batches by checkpoint, so every checkpoint writes to a
    folder of its own; ``appended_rows`` reads them all.  Rows lie in a folder
    for each log partition, so offsets come from the files' footers
    (``appended_offsets``).
    """
    rows = upsert.append_rows(stream, mode)
    return _run(rows.writeStream.format("parquet").partitionBy(*PARTITION_KEY)
                .option("path", f"{out}/run={run_name(checkpoint)}"), checkpoint, available_now)


def _appended(spark: SparkSession, path: str) -> DataFrame:
    """Committed rows of one run; its sink's own log says which files count."""
    try:
        held = spark.read.parquet(path).schema
    except AnalysisException as exc:
        if "infer schema" not in str(exc):
            raise
        return spark.createDataFrame([], APPEND_ROW)          # a run without rows
    types = {f.name: f for f in StructType.fromDDL(APPEND_ROW)}        # not what folder names look like
    return spark.read.schema(StructType([types.get(f.name, f) for f in held])).parquet(path)


def appended_rows(spark: SparkSession, out: str) -> DataFrame:
    """Committed rows of all runs."""
    runs = [_appended(spark, f"{out}/{f}") for f in fsio.folders(spark, out)]
    if not runs:
        return spark.createDataFrame([], APPEND_ROW)
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), runs)
    first = [f.name for f in StructType.fromDDL(APPEND_ROW)]
    return rows.select(*first, *[c for c in rows.columns if c not in first])


def appended_offsets(spark: SparkSession, out: str) -> DataFrame:
    """(topic, partition, offset): the next offset after the committed rows, from
    the maxima in the Parquet footers; no row is read.  Spark answers aggregates
    so in its newer file reader, which a session of its own turns on."""
    footers = spark.newSession()
    footers.conf.set("spark.sql.sources.useV1SourceList", "")
    footers.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    runs = [footers.read.schema(APPEND_ROW).parquet(f"{out}/{f}").groupBy(*PARTITION_KEY).agg(
        F.max("offset").alias("last")) for f in fsio.folders(spark, out)]
    if not runs:
        return spark.createDataFrame([], "topic string, partition int, offset bigint")
    return reduce(DataFrame.unionByName, runs).groupBy(*PARTITION_KEY).agg((F.max("last") + 1).alias("offset"))


MANAGER = "spark.sql.streaming.checkpointFileManagerClass"
BY_FILE_SYSTEM = "org.apache.spark.sql.execution.streaming.checkpointing.FileSystemBasedCheckpointFileManager"


def _start_batches(writer, spark: SparkSession, checkpoint: str):
    """Start a stream of many small batches.  Each writes two files to its
    checkpoint; on a local file system the way that Spark takes unless told
    otherwise starts processes for each of them, to rename it.  The other one
    makes the same checks there (any other file system keeps Spark's own)."""
    ours = spark.conf.get(MANAGER, None) is None and fsio.is_local(spark, checkpoint)
    if ours:
        spark.conf.set(MANAGER, BY_FILE_SYSTEM)
    try:
        return writer.start()
    finally:
        if ours:
            spark.conf.unset(MANAGER)


def run_batches(stream: DataFrame, fn, checkpoint: str):
    """K1 until the input is drained, batch after batch: for sources that cap
    their batches themselves (``availableNow`` would ask them for one batch)."""
    writer = stream.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint).trigger(processingTime="0 seconds")
    q = _start_batches(writer, stream.sparkSession, checkpoint)
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return q


# ------------------------------------------------------------- starting offsets

def start_at(stream: DataFrame, starts: Mapping[tuple[str, int], int]) -> DataFrame:
    """Read every partition from its start (literals: one per log
    partition); partitions that are not listed are read from the beginning."""
    if not starts:
        return stream
    pairs = [x for (t, p), o in sorted(starts.items()) for x in (F.lit(f"{t}/{p}"), F.lit(int(o)))]
    name = F.concat_ws("/", "topic", F.col("partition").cast("string"))
    start = F.coalesce(F.try_element_at(F.create_map(*pairs), name), F.lit(0))
    return stream.where(F.col("offset") >= start)


def resolve(extents: DataFrame, stored: Mapping[tuple[str, int], int], policy: str) -> dict[tuple[str, int], int]:
    """S4 once, on the driver: the start of every current partition."""
    spark = extents.sparkSession
    known = spark.createDataFrame([(t, p, o) for (t, p), o in stored.items()], "topic string, partition int, offset bigint")
    return {(r.topic, r.partition): r.offset for r in logsrc.resolve_starts(extents, known, policy).collect()}


def resume_from_store(stream: DataFrame, extents: DataFrame, store: sinks.OffsetStore,
                      group_id: str, policy: str = "earliest") -> DataFrame:
    """Section 3.3 on a new checkpoint: start every partition where the offset
    table says (O2 -> S4), else by policy.  Starts are looked up once, here;
    with Kafka they go into ``startingOffsets`` instead."""
    return start_at(stream, resolve(extents, store.current_map(group_id), policy))


def resume_from_rows(stream: DataFrame, out: str) -> DataFrame:
    """K4 on a new checkpoint: go on after the rows that are committed."""
    rows = appended_offsets(stream.sparkSession, out)
    return start_at(stream, {(r.topic, r.partition): r.offset for r in rows.collect()})


# --- registered stream queries ------------------------------------------

def write_parts(log: DataFrame, feed: str, parts) -> None:
    """The log's two parts as folders of a feed; part 2 is empty."""
    for k in parts:
        log.where(Q.part_of(F.col("offset")) == k).write.parquet(f"{feed}/part-{k}")


def _drain(spark, sf_dir, run):
    """Run a job over even parts of the log, one after the other, with an empty
    one behind them (O8: one checkpoint)."""
    log, parts, work = Q.staged_log(spark, sf_dir), Q.staged_parts(spark, sf_dir), scratch_dir(spark, "stream")
    for k in range(Q.PARTS + 1):
        parts.where(F.col("part") == k).select(*log.columns).write.parquet(f"{work}/feed/part-{k}")
        run(read_feed(spark, f"{work}/feed/*", log.schema), work)
    return work


def q_batch_word_count_stream(spark, sf_dir):
    """A1 F1 K1 on a real stream: per-batch counts written per batch."""
    work = _drain(spark, sf_dir, lambda s, w: run_foreach(s, sinks.word_count_sink(f"{w}/out"), f"{w}/chk"))
    return sinks.read_batches(spark, f"{work}/out").select("batch_id", "word", "n")


def q_running_word_count_stream(spark, sf_dir):
    """A2 O8 on a real stream, complete mode: the current table."""
    work = _drain(spark, sf_dir, lambda s, w: run_running_word_count(s, f"{w}/out", f"{w}/chk", "complete"))
    return current_word_counts(spark, f"{work}/out")


def q_running_word_count_update_stream(spark, sf_dir):
    """A2 O8 on a real stream, update mode."""
    work = _drain(spark, sf_dir, lambda s, w: run_running_word_count(s, f"{w}/out", f"{w}/chk"))
    return sinks.read_batches(spark, f"{work}/out").select("batch_id", "word", "n")


def _guarded(spark, sf_dir, work_of):
    def run(stream, work):
        store = sinks.OffsetStore(spark, f"{work}/offsets")
        run_foreach(stream, sinks.guarded(store, Q.GROUP_A, work_of(f"{work}/out")), f"{work}/chk")
    work = _drain(spark, sf_dir, run)
    return f"{work}/out", sinks.OffsetStore(spark, f"{work}/offsets")


def q_batch_record_count_stream(spark, sf_dir):
    """Count per batch, then a guarded offset commit."""
    out, store = _guarded(spark, sf_dir, sinks.record_count_work)
    return sinks.record_counts(spark, out, store, Q.GROUP_A)


def q_upsert_latest_stream(spark, sf_dir):
    """K3 K5: upsert each batch, then commit its offsets (effectively once)."""
    out, store = _guarded(spark, sf_dir, tables.upsert_work)
    return tables.UpsertTable(spark, out, store, Q.GROUP_A).view()


def q_stream_offsets(spark, sf_dir):
    """O1 O3 on a real stream: offsets committed by the guarded sink, read
    back as the history (group, topic, partition, offset, batch_id)."""
    _, store = _guarded(spark, sf_dir, lambda out: lambda df, slot: None)
    return store.history()


def q_append_with_offsets(spark, sf_dir):
    """K4: rows with their offsets through the exactly-once file sink; then a
    new checkpoint that starts from the offsets of the committed rows."""
    log, work = Q.staged_log(spark, sf_dir), scratch_dir(spark, "append")
    write_parts(log, f"{work}/feed", [0])
    run_append_with_offsets(read_feed(spark, f"{work}/feed/*", log.schema), f"{work}/out", f"{work}/chk-1")
    write_parts(log, f"{work}/feed", [1])
    whole = read_feed(spark, f"{work}/feed/*", log.schema)
    run_append_with_offsets(resume_from_rows(whole, f"{work}/out"), f"{work}/out", f"{work}/chk-2")
    return appended_rows(spark, f"{work}/out")


def _resumed(spark, sf_dir, work_of, change=lambda s: s, between=lambda out, store: None):
    """Section 3.3: the first part on one checkpoint; the whole log on a *new*
    one, which gets only what lies past the stored offsets."""
    log, work = Q.staged_log(spark, sf_dir), scratch_dir(spark, "resume")
    write_parts(log, f"{work}/feed", [0])
    store = sinks.OffsetStore(spark, f"{work}/offsets")
    first = change(read_feed(spark, f"{work}/feed/*", log.schema))
    run_foreach(first, sinks.guarded(store, Q.GROUP_A, work_of(f"{work}/out")), f"{work}/chk-1")
    between(f"{work}/out", store)
    write_parts(log, f"{work}/feed", [1])
    fresh = sinks.OffsetStore(spark, f"{work}/offsets")
    whole = change(read_feed(spark, f"{work}/feed/*", log.schema))
    resumed = resume_from_store(whole, logsrc.partition_extents(log), fresh, Q.GROUP_A)
    run_foreach(resumed, sinks.guarded(fresh, Q.GROUP_A, work_of(f"{work}/out")), f"{work}/chk-2")
    return f"{work}/out", fresh


def q_resume_from_offsets_stream(spark, sf_dir):
    """O2 S4 S2 O4 A3 O3 K6 over two checkpoints: every commit's offsets with
    the number of records that went with them."""
    out, store = _resumed(spark, sf_dir, sinks.record_count_work)
    return store.history(Q.GROUP_A).join(sinks.record_counts(spark, out, store, Q.GROUP_A), "batch_id")


def distinct_keys(stream: DataFrame) -> DataFrame:
    """Messages with a key of their own: ``topic,topic-partition-offset``."""
    key = F.concat_ws("-", "topic", F.col("partition").cast("string"), F.col("offset").cast("string"))
    return stream.withColumn("value", F.concat_ws(",", F.col("topic"), key))


def q_resume_upsert_stream(spark, sf_dir):
    """K3 K5 over two checkpoints, every message a key: none may be missing."""
    out, store = _resumed(spark, sf_dir, tables.upsert_work, distinct_keys)
    return tables.UpsertTable(spark, out, store, Q.GROUP_A).view()


def q_resume_running_word_count_stream(spark, sf_dir):
    """A2 over two checkpoints: counts kept with the commits go on under the
    new one, from a base that was compacted in between."""
    out, store = _resumed(spark, sf_dir, tables.running_count_work,
                          between=lambda out, store: tables.CountTable(spark, out, store, Q.GROUP_A).compact())
    return tables.CountTable(spark, out, store, Q.GROUP_A).view()


BAD_EVERY = 7           # offsets divisible by it carry no pair in the quarantine queries


def damaged(stream: DataFrame) -> DataFrame:
    """Messages of which some are no ``name,order_id``: the comma is lost."""
    return stream.withColumn("value", F.when(F.col("offset") % BAD_EVERY == 0, F.replace("value", F.lit(","), F.lit(";")))
                             .otherwise(F.col("value")))


def _with_quarantine(spark, sf_dir):
    out, store = _resumed(spark, sf_dir, lambda out: tables.upsert_work(out, "quarantine"), damaged,
                          lambda out, store: tables.UpsertTable(spark, out, store, Q.GROUP_A).compact())
    return tables.UpsertTable(spark, out, store, Q.GROUP_A)


def q_upsert_good_stream(spark, sf_dir):
    """Bad messages are set aside and the upsert goes on: the table."""
    return _with_quarantine(spark, sf_dir).view()


def q_upsert_quarantine_stream(spark, sf_dir):
    """The messages set aside, by the commit that covers them."""
    return _with_quarantine(spark, sf_dir).quarantine()


LATE_TOPIC = "click"     # added while the stream runs


def range_table(ranges: sinks.Ranges) -> pa.Table:
    """A batch's ranges, a row per partition."""
    types = [pa.string(), pa.int32(), pa.int64(), pa.int64()]
    return pa.table([pa.array(x, t) for x, t in zip(zip(*ranges), types)],
                    ["topic", "partition", "from_offset", "until_offset"])


def range_work(folder: str) -> sinks.BatchFn:
    """O1 as output: the ranges that the batch's rows span (a row per partition,
    which the guard has counted already where the source doesn't report them)."""
    def work(df: DataFrame, slot: sinks.Slot) -> None:
        if slot.ranges:
            sinks.put_tagged(df.sparkSession, range_table(slot.ranges), folder, slot)
        else:
            sinks.write_tagged(offsets.batch_ranges(df), folder, slot)
    return work


def _stored_stream(spark, schema, work: str, **options) -> DataFrame:
    return stored.read_stream(spark, f"{work}/log", schema, offsets=f"{work}/offsets", group=Q.GROUP_A, **options)


def _ranges(spark, work: str, store: sinks.OffsetStore) -> DataFrame:
    return sinks.read_committed(spark, f"{work}/out", store, Q.GROUP_A, OFFSET_RANGE).withColumnRenamed("seq", "batch_id")


def q_capped_log_stream(spark, sf_dir):
    """S7 S2 O1 O3 on an offset-addressed stream: each batch takes at most
    ``CAP`` offsets of every partition, whatever the others hold."""
    log, work = Q.staged_log(spark, sf_dir), scratch_dir(spark, "capped")
    stored.write_log(log, f"{work}/log")
    store = sinks.OffsetStore(spark, f"{work}/offsets")
    run_batches(_stored_stream(spark, log.schema, work, cap=Q.CAP),
                sinks.guarded(store, Q.GROUP_A, range_work(f"{work}/out")), f"{work}/chk")
    return _ranges(spark, work, store)


def q_added_topic_stream(spark, sf_dir):
    """S3 S4 O2 O8 on an offset-addressed stream: a topic that matches the
    pattern is added while the first batch runs, more messages come, and a new
    checkpoint goes on from the offset table.  How much of each partition was
    read, and how far."""
    log, work = Q.staged_log(spark, sf_dir), scratch_dir(spark, "added")
    late, early = F.col("topic") == LATE_TOPIC, F.col("offset") < SPLIT
    added: list[int] = []

    def run(checkpoint: str) -> sinks.OffsetStore:
        store = sinks.OffsetStore(spark, f"{work}/offsets")
        write_ranges = range_work(f"{work}/out")

        def work_of(df: DataFrame, slot: sinks.Slot) -> None:
            if not added:
                added.append(slot.seq)
                stored.write_log(log.where(late), f"{work}/log")
            write_ranges(df, slot)
        run_batches(_stored_stream(spark, log.schema, work, pattern=Q.PATTERN, cap=Q.CAP),
                    sinks.guarded(store, Q.GROUP_A, work_of, claim=True), f"{work}/{checkpoint}")
        return store

    stored.write_log(log.where(~late & early), f"{work}/log")
    run("chk-1")
    stored.write_log(log.where(~late & ~early), f"{work}/log")
    store = run("chk-2")
    return _ranges(spark, work, store).groupBy("topic", "partition").agg(
        F.sum(F.col("until_offset") - F.col("from_offset")).alias("n_read"), F.max("until_offset").alias("until_offset"))


STREAM_QUERIES = {
    "batch_word_count_stream": q_batch_word_count_stream,
    "running_word_count_stream": q_running_word_count_stream,
    "running_word_count_update_stream": q_running_word_count_update_stream,
    "batch_record_count_stream": q_batch_record_count_stream,
    "upsert_latest_stream": q_upsert_latest_stream,
    "append_with_offsets": q_append_with_offsets,
    "resume_from_offsets_stream": q_resume_from_offsets_stream,
    "resume_upsert_stream": q_resume_upsert_stream,
    "resume_running_word_count_stream": q_resume_running_word_count_stream,
    "upsert_good_stream": q_upsert_good_stream,
    "upsert_quarantine_stream": q_upsert_quarantine_stream,
    "capped_log_stream": q_capped_log_stream,
    "added_topic_stream": q_added_topic_stream,
    "offsets_log_stream": q_stream_offsets,
}

_HISTORY = ("SELECT 'stream-a' AS group_id, topic, \"partition\", until_offset AS \"offset\", batch_id FROM R")

# A stream over the parts must equal the batch query over the whole log, with
# the part as the batch.
STREAM_ORACLES = {
    "batch_word_count_stream": even_parts_sql(ORACLES["batch_word_count"]),
    "running_word_count_stream": ORACLES["running_word_count"],
    "running_word_count_update_stream": even_parts_sql(ORACLES["running_word_count_update"]),
    "batch_record_count_stream": even_parts_sql(ORACLES["batch_record_count"]),
    "upsert_latest_stream": even_parts_sql(ORACLES["upsert_latest"]),
    "append_with_offsets": ORACLES["append_rows"],
    "resume_from_offsets_stream": parts_sql(ORACLES["batch_ranges"]).replace(
        "SELECT * FROM R", f"SELECT h.*, c.n FROM ({_HISTORY}) h JOIN "
        "(SELECT batch_id, count(*) AS n FROM LB GROUP BY batch_id) c ON h.batch_id = c.batch_id"),
    "resume_upsert_stream": ORACLES["topic_subscribe"].split("SELECT * FROM L WHERE")[0]
    + "SELECT topic || '-' || CAST(\"partition\" AS VARCHAR) || '-' || CAST(\"offset\" AS VARCHAR) AS order_id, "
      "topic AS name FROM L",
    "resume_running_word_count_stream": ORACLES["running_word_count"],
    "capped_log_stream": ORACLES["batch_ranges"],
    "added_topic_stream": ORACLES["batch_ranges"].replace(
        "SELECT * FROM R", 'SELECT topic, "partition", count(*) AS n_read, max("offset") + 1 AS until_offset FROM L '
        f"WHERE regexp_full_match(topic, '{Q.PATTERN}') GROUP BY topic, \"partition\""),
    "upsert_good_stream": parts_sql(ORACLES["upsert_latest"]).replace("WHERE len(fs) = 2", f'WHERE len(fs) = 2 AND "offset" % {BAD_EVERY} <> 0'),
    "upsert_quarantine_stream": parts_sql(ORACLES["batch_ranges"]).replace(
        "SELECT * FROM R", f'SELECT batch_id, topic, "partition", "offset", replace(value, \',\', \';\') AS raw FROM LB '
        f'WHERE "offset" % {BAD_EVERY} = 0'),
    "offsets_log_stream": even_parts_sql(ORACLES["batch_ranges"]).replace("SELECT * FROM R", _HISTORY),
}
