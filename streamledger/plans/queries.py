"""

Each takes (spark, sf_dir) and returns a DataFrame over the driver tables (or
data Spark derives from them).  The message log ``L`` is derived from
``events`` (FIXTURES.md section 2); ``batch_id`` is the micro-batch that reads a
message when the log is consumed from the start with a per-partition cap of
``CAP`` messages (``offset div CAP``, S4 + S7).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamledger.functions.text import parse_pair, text_lines, typed_pair
from streamledger.operators import counts, offsets, upsert
from streamledger.schemas import MESSAGE_COLUMNS
from streamledger.session import load_table, scratch_dir
from streamledger.sources import log as logsrc
from streamledger.sources.text import read_lines, write_lines

# Fixed parameters of the registered queries (shared with the oracles).
CAP = 200                                  # messages per partition per batch
PARTITIONS = 3                             # log partitions per topic
SUBSCRIBED = "click,view"                  # S1 topic list
PATTERN = "c.*|p.*"                        # S3 topic pattern
ASSIGNED = {                               # S2 assignment map [from, until)
    ("click", 0): (100, 350),
    ("click", 2): (0, 50),
    ("view", 1): (600, None),             # to the end of the partition
    ("signup", 1): (5, 5),
}
GROUP_A = "stream-a"    # commits every batch of every partition
GROUP_B = "stream-b"    # stopped after batch 1, never read partition 2 (D8)
GROUP_B_PARTITIONS = (0, 1)
GROUP_B_LAST_BATCH = 1
CURRENT_TOPICS = "click,purchase,view"     # O6 topic filter
SPLIT = 400                                # resumed streams: offsets below are part 0
PARTS = 4                                  # streams: even shares of every partition, one after the other

Query = Callable[[SparkSession, str], DataFrame]


# --- shared derivations ---------------------------------------------------

_STAGED: dict[tuple[str, str, str], str] = {}


def _staged(spark: SparkSession, sf_dir: str, name: str, write) -> DataFrame:
    """A table derived once per session and table folder, in the shared folder."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STAGED:
        path = scratch_dir(spark, name)
        write(path)
        _STAGED[key] = path
    return spark.read.parquet(_STAGED[key])


def staged_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The message log, numbered and stored once, as a broker would hold it: a
    folder per topic, rows in offset order, so that topic lists prune folders
    and offset bounds prune row groups."""
    def write(path: str) -> None:
        log = logsrc.message_log(load_table(spark, sf_dir, "events"), PARTITIONS)
        log.sortWithinPartitions("topic", "partition", "offset") \
            .write.partitionBy("topic").parquet(path)

    log = _staged(spark, sf_dir, "log", write)
    return log.select(*MESSAGE_COLUMNS)


def batched_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logsrc.with_batch_ids(staged_log(spark, sf_dir), CAP)


def part_of(offset):
    """The part of the log that an offset lies in (resumed stream queries)."""
    return F.when(offset < SPLIT, 0).otherwise(1)


def staged_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``OFFSETS_LOG`` as two consumer groups would have written it (O3)."""
    def write(path: str) -> None:
        ranges = offsets.batch_ranges(batched_log(spark, sf_dir), ["batch_id"])
        a = offsets.commit_rows(ranges, GROUP_A, F.col("batch_id"))
        b = offsets.commit_rows(
            ranges.where(F.col("partition").isin(list(GROUP_B_PARTITIONS))
                         & (F.col("batch_id") <= GROUP_B_LAST_BATCH)),
            GROUP_B, F.col("batch_id"))
        a.unionByName(b).write.parquet(path)

    return _staged(spark, sf_dir, "offsets", write)


def staged_extents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Earliest and latest offset of every log partition, as a broker knows."""
    return _staged(spark, sf_dir, "extents", lambda path: logsrc.partition_extents(
        staged_log(spark, sf_dir)).write.parquet(path))


def staged_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log with the ``part`` of its partition that a message lies in, a
    folder per part (stream queries)."""
    def write(path: str) -> None:
        log, sizes = staged_log(spark, sf_dir).alias("m"), staged_extents(spark, sf_dir).alias("e")
        same = F.expr("m.topic <=> e.topic and m.partition <=> e.partition")
        log.join(sizes, same).select("m.*", F.expr(f"{PARTS} * m.offset div e.latest").alias("part")) \
            .write.partitionBy("part").parquet(path)

    return _staged(spark, sf_dir, "parts", write)


def _current(spark, sf_dir, group, topics=None):
    return offsets.current_offsets(staged_offsets(spark, sf_dir), group, topics)


# --- queries ----------------------------------------------------------------

def q_word_count(spark, sf_dir):
    """P1 P3 A1 (flagship): whitespace tokens of every document, counted."""
    docs = load_table(spark, sf_dir, "documents").select("text")
    return counts.word_count(docs, "text")


def q_space_tokens(spark, sf_dir):
    """Lines -> space tokens -> (length, 1) -> count, avg."""
    docs = load_table(spark, sf_dir, "documents").select("text")
    return counts.length_summary(counts.token_lengths(docs, "text"))


def q_text_lines(spark, sf_dir):
    """The lines a text file of the documents would yield."""
    docs = load_table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.select("doc_id", F.posexplode(text_lines("text")).alias("line_no", "line"))


def q_text_file_lines(spark, sf_dir):
    """Documents written as text files and read line by line, with how
    often each line occurs."""
    path = scratch_dir(spark, "lines")
    write_lines(load_table(spark, sf_dir, "documents").where("text is not null"), "text", path)
    return read_lines(spark, path).groupBy(F.col("value").alias("line")).agg(F.count("*").alias("n"))


def q_batch_word_count(spark, sf_dir):
    """A1 F1: per-batch word count, no memory between batches."""
    return counts.word_count(batched_log(spark, sf_dir), "value", ["batch_id"])


def _batch_counts(spark, sf_dir):
    return q_batch_word_count(spark, sf_dir)


def q_running_word_count(spark, sf_dir):
    """A2 complete mode: the table of every word seen, after the last batch."""
    return counts.running_word_count_complete(_batch_counts(spark, sf_dir))


def q_running_word_count_update(spark, sf_dir):
    """A2 update mode: words touched by a batch with their running count."""
    return counts.running_word_count_update(_batch_counts(spark, sf_dir))


def q_batch_record_count(spark, sf_dir):
    """A3 K1: records per non-empty batch."""
    return counts.record_count(batched_log(spark, sf_dir), ["batch_id"])


def q_topic_subscribe(spark, sf_dir):
    """Messages of a comma list of topics."""
    return logsrc.subscribe(staged_log(spark, sf_dir), SUBSCRIBED)


def q_topic_pattern(spark, sf_dir):
    """S3: messages of the topics whose whole name matches a pattern."""
    return logsrc.subscribe_pattern(staged_log(spark, sf_dir), PATTERN)


def q_message_kv(spark, sf_dir):
    """(key, message) handler."""
    return logsrc.project(staged_log(spark, sf_dir), "kv")


def q_message_tv(spark, sf_dir):
    """(topic, message) handler."""
    return logsrc.project(staged_log(spark, sf_dir), "tv")


def q_assigned_ranges(spark, sf_dir):
    """Only assigned partitions, only offsets inside their ranges."""
    return logsrc.read_assigned(staged_log(spark, sf_dir), ASSIGNED)


def _starts(spark, sf_dir, policy):
    extents = staged_extents(spark, sf_dir)
    return extents, logsrc.resolve_starts(extents, _current(spark, sf_dir, GROUP_B), policy)


def q_start_earliest(spark, sf_dir):
    """Stored offset, else earliest; partitions without one included."""
    return _starts(spark, sf_dir, "earliest")[1]


def q_start_latest(spark, sf_dir):
    """Stored offset, else latest."""
    return _starts(spark, sf_dir, "latest")[1]


def q_rate_limited_ranges(spark, sf_dir):
    """Next batch's range per partition under the per-partition cap."""
    extents, starts = _starts(spark, sf_dir, "smallest")
    return logsrc.plan_ranges(starts, extents, CAP)


def q_next_batch(spark, sf_dir):
    """S4 S7 S2 composed: the next capped batch of a group from its offsets."""
    ranges = q_rate_limited_ranges(spark, sf_dir).collect()     # a row per log partition
    return logsrc.read_assigned(staged_log(spark, sf_dir), {
        (r.topic, r.partition): (r.from_offset, r.until_offset) for r in ranges})


def q_batch_ranges(spark, sf_dir):
    """O1: consumed range of every partition in every batch."""
    return offsets.batch_ranges(batched_log(spark, sf_dir), ["batch_id"])


def q_offsets_current(spark, sf_dir):
    """Current offsets of a group for some topics."""
    return _current(spark, sf_dir, GROUP_A, CURRENT_TOPICS)


def q_offsets_guard(spark, sf_dir):
    """Verdict of every batch's ranges against a stale group's offsets."""
    ranges = offsets.batch_ranges(batched_log(spark, sf_dir), ["batch_id"])
    return offsets.guard(ranges, _current(spark, sf_dir, GROUP_B))


def q_offsets_seed(spark, sf_dir):
    """Seed rows for partitions the group has never committed."""
    extents = staged_extents(spark, sf_dir)
    return offsets.seed_missing(extents, _current(spark, sf_dir, GROUP_B), GROUP_B)


def q_offsets_tall(spark, sf_dir):
    """Tall layout; topic and partition parsed back from the row key."""
    tall = offsets.to_tall(_current(spark, sf_dir, GROUP_A))
    return tall.select("rowkey", "offset", *offsets.tall_key_parts("rowkey"))


def q_offsets_path(spark, sf_dir):
    """Path-tree layout ``topic/group/partition`` -> offset text."""
    return offsets.to_path(_current(spark, sf_dir, GROUP_A))


def q_offsets_wide(spark, sf_dir):
    """Wide layout, one column per partition."""
    return offsets.to_wide(_current(spark, sf_dir, GROUP_A), range(PARTITIONS))


def q_offsets_unpivot(spark, sf_dir):
    """O7 back: the wide row unpivoted to one row per partition again."""
    wide = offsets.to_wide(_current(spark, sf_dir, GROUP_A), range(PARTITIONS))
    return offsets.from_wide(wide, GROUP_A)


def q_offsets_path_parse(spark, sf_dir):
    """O7 back: path-tree entries parsed to (group, topic, partition, offset)."""
    return offsets.from_path(offsets.to_path(_current(spark, sf_dir, GROUP_A)))


def q_offsets_path_files(spark, sf_dir):
    """The path tree written as files, one a partition, and read back."""
    folder = scratch_dir(spark, "tree")
    offsets.write_path_tree(_current(spark, sf_dir, GROUP_A), folder)
    return offsets.read_path_tree(spark, folder)


def _pairs(spark, sf_dir, strict):
    conv = load_table(spark, sf_dir, "conversations")
    return conv.select("conv_id", "turn", parse_pair("text", strict).alias("p"))


def q_parse_pairs_strict(spark, sf_dir):
    """Exactly two comma fields; bad rows kept with ok = false."""
    return _pairs(spark, sf_dir, True).select("conv_id", "turn", "p.ok", "p.name", "p.id")


def q_parse_pairs_lenient(spark, sf_dir):
    """Two or more comma fields and a whole number for an id."""
    conv = load_table(spark, sf_dir, "conversations")
    return conv.select("conv_id", "turn", typed_pair("text").alias("p")).select(
        "conv_id", "turn", "p.ok", "p.name", "p.id")


def q_upsert_latest(spark, sf_dir):
    """K3 K5: keyed upsert of every batch; last (batch, offset, topic,
    partition) wins per order_id."""
    rows = upsert.upsert_rows(batched_log(spark, sf_dir))
    return upsert.upsert(None, rows).select("order_id", "name")


def q_append_rows(spark, sf_dir):
    """K4 rows: every message parsed leniently, with its log coordinates."""
    return upsert.append_rows(staged_log(spark, sf_dir))


def q_committed_offsets(spark, sf_dir):
    """K4 O3: offsets derived from the committed rows (max + 1)."""
    return upsert.offsets_from_rows(q_append_rows(spark, sf_dir), GROUP_A)


QUERIES: dict[str, Query] = {
    "word_count": q_word_count,
    "space_tokens": q_space_tokens,
    "text_lines": q_text_lines,
    "text_file_lines": q_text_file_lines,
    "batch_word_count": q_batch_word_count,
    "running_word_count": q_running_word_count,
    "running_word_count_update": q_running_word_count_update,
    "batch_record_count": q_batch_record_count,
    "topic_subscribe": q_topic_subscribe,
    "topic_pattern": q_topic_pattern,
    "message_kv": q_message_kv,
    "message_tv": q_message_tv,
    "assigned_ranges": q_assigned_ranges,
    "start_earliest": q_start_earliest,
    "start_latest": q_start_latest,
    "rate_limited_ranges": q_rate_limited_ranges,
    "next_batch": q_next_batch,
    "batch_ranges": q_batch_ranges,
    "offsets_current": q_offsets_current,
    "offsets_guard": q_offsets_guard,
    "offsets_seed": q_offsets_seed,
    "offsets_tall": q_offsets_tall,
    "offsets_path": q_offsets_path,
    "offsets_wide": q_offsets_wide,
    "offsets_unpivot": q_offsets_unpivot,
    "offsets_path_parse": q_offsets_path_parse,
    "offsets_path_files": q_offsets_path_files,
    "parse_pairs_strict": q_parse_pairs_strict,
    "parse_pairs_lenient": q_parse_pairs_lenient,
    "upsert_latest": q_upsert_latest,
    "append_rows": q_append_rows,
    "committed_offsets": q_committed_offsets,
}
