"""Per-batch sinks for ``foreachBatch`` (K1-K3, K5, K6) and the offset table
they commit to (O2-O5).

``foreachBatch`` is at least once, and its batch ids start at 0 again on every
new checkpoint.  Nothing here depends on them.  A group's commits carry a
sequence of their own; a commit names the folder that its output went to, so
output counts as written exactly when a commit names it, whichever run, batch
or attempt wrote it.  Output is written before offsets are committed (the
reference stores offsets first, D2).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from typing import NamedTuple
from urllib.parse import quote

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamledger import fsio
from streamledger.operators import counts, offsets
from streamledger.schemas import OFFSETS, OFFSETS_LOG

Ranges = Iterable[tuple[str, int, int, int]]


class Slot(NamedTuple):
    """Where a batch's output goes: the commit it will belong to, and the name
    of its folder; also the ranges that its rows span, where they are counted
    already."""

    seq: int
    tag: str
    ranges: tuple = ()


# What a work returns, if anything, is noted in its commit.
BatchFn = Callable[[DataFrame, Slot], dict | None]
Hook = Callable[[int], None] | None


def write_batch(df: DataFrame, folder: str, batch_id: int, run: str = "0") -> None:
    """Idempotent write of a sink without offsets: a replay of (run, batch)
    overwrites its own folder; ``run`` names the checkpoint."""
    df.write.mode("overwrite").parquet(f"{folder}/run={run}/batch_id={batch_id}")


def read_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Everything written by ``write_batch``, with ``run`` and ``batch_id``."""
    df = spark.read.parquet(folder)
    # partition discovery would infer int from the folder names
    return df.withColumn("batch_id", F.col("batch_id").cast("bigint")).withColumn("run", F.col("run").cast("string"))


# ------------------------------------------------------------- the offset table

class CommitConflict(RuntimeError):
    """Another writer of the group committed first."""


class Fenced(CommitConflict):
    """A later writer has taken the group over."""


_LINE = OFFSETS_LOG + ", tag string, changed boolean, complete bigint"


class OffsetStore:
    """``OFFSETS_LOG`` in the shared folder, one small file per commit.

    Commit ``n`` of a group is ``<folder>/<group>/c-<n>.json``.  It is put in place
    whole and only if there is none (``fsio.write_text``), so of two writers one
    fails, whenever they overlap, and no commit is ever seen in part.  It holds
    the offsets of all the group's partitions after the commit (one line each:
    topic metadata), marks those it changed, and ends with a line of its own.

    A writer may ``claim`` the group: it gets the next epoch, one small file like
    a commit's, and commits of writers with an earlier one fail from then on
    (``Fenced``).  A commit that came in before the claim counts; the new writer
    finds it, since its own next number is taken.

    The current offsets are the newest file: found from the last one known, or
    from the hint that every commit leaves, by looking for the next.  The number
    of file-system calls per batch does not depend on the number of commits.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._known: dict[str, tuple[int, dict[tuple[str, int], int]]] = {}
        self._epoch: dict[str, int] = {}

    def _path(self, group_id: str, name: str) -> str:
        return f"{self.folder}/{quote(group_id, safe='')}/{name}"

    def _load(self, group_id: str, seq: int) -> list[dict] | None:
        """Lines of a commit, None if there is none."""
        text = fsio.read_text(self.spark, self._path(group_id, f"c-{seq:012d}.json"))
        if text is None:
            return None
        lines = text.splitlines()
        if not lines or not lines[-1].startswith('{"complete"'):
            raise RuntimeError(f"group {group_id}: commit {seq} is damaged")
        return [json.loads(x) for x in lines[:-1]]

    def epoch(self, group_id: str) -> int:
        """The newest epoch claimed (-1: none)."""
        n = self._epoch.get(group_id, -1)
        while fsio.read_text(self.spark, self._path(group_id, f"e-{n + 1:06d}")) is not None:
            n += 1
        return n

    def claim(self, group_id: str) -> int:
        """Take the group over from every earlier writer."""
        n = self.epoch(group_id) + 1
        while not fsio.write_text(self.spark, self._path(group_id, f"e-{n:06d}"), str(n), overwrite=False):
            n += 1
        self._epoch[group_id] = n
        return n

    @staticmethod
    def _state(lines: list[dict]) -> dict[tuple[str, int], int]:
        return {(x["topic"], x["partition"]): x["offset"] for x in lines}

    def tip(self, group_id: str) -> tuple[int, dict[tuple[str, int], int]]:
        """Number of the last commit (-1: none) and the offsets after it."""
        if group_id not in self._known:
            hint = fsio.read_text(self.spark, self._path(group_id, "_latest"))
            seq = int(hint) if hint else -1
            lines = self._load(group_id, seq) if seq >= 0 else None
            self._known[group_id] = (-1, {}) if lines is None else (seq, self._state(lines))
        seq, state = self._known[group_id]
        while (lines := self._load(group_id, seq + 1)) is not None:
            seq, state = seq + 1, self._state(lines)
        self._known[group_id] = (seq, state)
        return seq, dict(state)

    def current_map(self, group_id: str) -> dict[tuple[str, int], int]:
        """Current offsets on the driver: one entry per log partition."""
        return self.tip(group_id)[1]

    def current(self, group_id: str) -> DataFrame:
        """O2: current offsets as a table."""
        rows = [(group_id, t, p, o) for (t, p), o in sorted(self.current_map(group_id).items())]
        return self.spark.createDataFrame(rows, OFFSETS)

    def commits(self, group_id: str | None = None, after: int = -1) -> DataFrame:
        """Lines of all commits (of one group: after number ``after``): what they
        changed, with seq and tag."""
        if group_id is not None:        # their names are known: nothing is listed
            paths = [self._path(group_id, f"c-{n:012d}.json") for n in range(after + 1, self.tip(group_id)[0] + 1)]
        else:
            paths = [f"{self.folder}/{g}" for g in fsio.folders(self.spark, self.folder)]
        if not paths:
            return self.spark.createDataFrame([], _LINE + ", file string, seq bigint")
        read = self.spark.read.schema(_LINE).option("pathGlobFilter", "c-*.json").json(paths)
        return read.where("changed").withColumn("file", F.col("_metadata.file_path")).withColumn(
            "seq", F.regexp_extract("file", r"c-(\d+)\.json$", 1).cast("bigint"))

    def notes(self, group_id: str, seq: int) -> dict:
        """What the work of a commit noted."""
        text = fsio.read_text(self.spark, self._path(group_id, f"c-{seq:012d}.json")) or '{"complete": 0}'
        last = json.loads(text.splitlines()[-1])
        return {k: v for k, v in last.items() if k != "complete"}

    def tags(self, group_id: str, after: int = -1) -> list[tuple[int, str]]:
        """(number, output folder) of the commits after number ``after``: one
        small file each, read on the driver."""
        out = []
        for seq in range(after + 1, self.tip(group_id)[0] + 1):
            found = {x["tag"] for x in self._load(group_id, seq)} - {""}
            out += [(seq, t) for t in found]
        return out

    def history(self, group_id: str | None = None) -> DataFrame:
        """Every commit (all groups unless ``group_id`` is given), as
        ``OFFSETS_LOG``; ``batch_id`` is the commit's number."""
        return self.commits(group_id).where("changed").select(
            "group_id", "topic", "partition", "offset", F.col("seq").alias("batch_id"))

    def verdict(self, ranges: Ranges, group_id: str) -> str:
        """O4 for a batch's ranges (topic, partition, from, until)."""
        now = self.current_map(group_id)
        return offsets.combine_verdicts([offsets.range_verdict(a, b, now.get((t, p))) for t, p, a, b in ranges if b > a])

    def commit(self, ranges: Ranges, group_id: str, slot: Slot | None = None, notes: dict | None = None) -> int:
        """O3: the batch's ranges as the group's next commit, or the one that
        ``slot`` was reserved for.  Fails if that commit exists already.  ``notes``
        go into its last line."""
        seq, state = self.tip(group_id)
        slot = slot or Slot(seq + 1, "")
        if slot.seq != seq + 1:
            raise CommitConflict(f"group {group_id}: commit {slot.seq} was made by another writer")
        ends = {(t, p): b for t, p, a, b in ranges}
        return self._create(group_id, slot, {**state, **ends}, set(ends), notes)

    def _create(self, group_id: str, slot: Slot, state: dict, changed: set, notes: dict | None = None) -> int:
        lines = [json.dumps({"group_id": group_id, "topic": t, "partition": p, "offset": o, "batch_id": slot.seq,
                             "tag": slot.tag, "changed": (t, p) in changed}) for (t, p), o in sorted(state.items())]
        text = "\n".join([*lines, json.dumps({"complete": len(lines), **(notes or {})})]) + "\n"
        if group_id in self._epoch and self.epoch(group_id) > self._epoch[group_id]:
            raise Fenced(f"group {group_id}: a later writer has claimed it")
        if not fsio.write_text(self.spark, self._path(group_id, f"c-{slot.seq:012d}.json"), text, overwrite=False):
            raise CommitConflict(f"group {group_id}: commit {slot.seq} was made by another writer")
        fsio.write_text(self.spark, self._path(group_id, "_latest"), str(slot.seq), overwrite=True)
        self._known[group_id] = (slot.seq, state)
        return slot.seq

    def seed(self, partitions: Iterable[tuple[str, int]], group_id: str, start: int = 0) -> int:
        """Store ``start`` for the partitions (topic, partition) that have
        no offset yet; returns how many there were."""
        seq, state = self.tip(group_id)
        missing = sorted(set(partitions) - state.keys())
        if missing:
            self._create(group_id, Slot(seq + 1, ""), {**state, **dict.fromkeys(missing, start)}, set(missing))
        return len(missing)


def _one_task(df: DataFrame) -> DataFrame:
    """The batch as it is; one that a single task reads says so to the planner,
    which then needs no shuffle to group its rows."""
    query = df._jdf.queryExecution()
    plan = query.logical()
    rows = plan.rdd() if plan.nodeName() == "LogicalRDD" else query.toRdd()     # a stream's batch is planned already
    return df.coalesce(1) if rows.getNumPartitions() <= 1 else df


def guarded(store: OffsetStore, group_id: str, work: BatchFn,
            ranges: Callable[[int], Ranges] | None = None, claim: bool = False,
            before_commit: Hook = None, after_commit: Hook = None):
    """K5 / K6 shape: check the guard, do the work, then commit the offsets.

    ``ranges`` gives a batch's consumed ranges as the source reports them
    (``sources.kafka.checkpoint_ranges``); it sees offsets that hold no message
    and idle partitions.  Without it they come from the batch's rows, which is
    right only for logs without missing offsets.

    ``skip``: the batch's offsets are already committed, so its output is
    complete too; nothing is done.  ``raise``: the ranges do not continue the
    stored offsets.  The commit must be the one right after the offsets that
    the verdict was given on.  With ``claim`` the first batch takes the group
    over, so a writer of an earlier run can't commit any more.  ``before_commit`` / ``after_commit`` are test
    hooks that may raise, to simulate a crash on either side of the commit.
    """
    claimed: list[int] = []

    def run(df: DataFrame, batch_id: int) -> None:
        if claim and not claimed:
            claimed.append(store.claim(group_id))
        if ranges is not None:
            consumed = [tuple(r) for r in ranges(batch_id)]
        else:       # one row per partition
            consumed = [tuple(r) for r in offsets.batch_ranges(_one_task(df)).collect()]
        seq = store.tip(group_id)[0]
        verdict = store.verdict(consumed, group_id)
        if verdict in ("empty", "skip"):     # F1, or a replayed batch
            return
        if verdict == "raise":
            raise RuntimeError(f"batch {batch_id}: ranges do not continue the stored offsets")
        slot = Slot(seq + 1, f"{seq + 1:012d}-{uuid.uuid4().hex[:12]}", () if ranges is not None else tuple(consumed))
        notes = work(df, slot)
        if before_commit is not None:
            before_commit(batch_id)
        store.commit(consumed, group_id, slot, notes)
        if after_commit is not None:
            after_commit(batch_id)
    return run


def write_tagged(df: DataFrame, folder: str, slot: Slot) -> None:
    """Output of a guarded batch: a folder that only its commit will name."""
    df.write.parquet(f"{folder}/tag={slot.tag}")


def put_tagged(spark: SparkSession, table: pa.Table, folder: str, slot: Slot) -> None:
    """``write_tagged`` of a few rows that the driver holds (one per log
    partition, say): a file, without a job."""
    out = pa.BufferOutputStream()
    pq.write_table(table, out)
    fsio.write_bytes(spark, f"{folder}/tag={slot.tag}/part-00000.parquet", out.getvalue().to_pybytes(), overwrite=True)


def read_committed(spark: SparkSession, folder: str, store: OffsetStore, group_id: str,
                   schema: str, after: int = -1, part: str = "") -> DataFrame:
    """Output that commits after number ``after`` name, with their ``seq``.  Only
    the folders they name are looked at (in each, the sub-folder ``part``)."""
    tags = store.tags(group_id, after)
    if not tags:
        return spark.createDataFrame([], schema + ", seq bigint")
    read = spark.read.schema(schema).parquet(*[f"{folder}/tag={t}{part}" for _, t in tags])
    return read.withColumn("seq", F.regexp_extract(F.col("_metadata.file_path"), r"/tag=(\d+)-", 1).cast("bigint"))


# --------------------------------------------------------------------- the sinks

def word_count_sink(folder: str, run: str = "0"):
    """K1 + A1 + F1: per-batch word count, written per batch."""
    def sink(df: DataFrame, batch_id: int) -> None:
        if not df.isEmpty():
            write_batch(counts.word_count(df, "value"), folder, batch_id, run)
    return sink


RECORD_COUNT = "n bigint"


def record_count_work(folder: str) -> BatchFn:
    """A3: the batch's record count."""
    def work(df: DataFrame, slot: Slot) -> None:
        write_tagged(counts.record_count(df), folder, slot)
    return work


def record_counts(spark: SparkSession, folder: str, store: OffsetStore, group_id: str) -> DataFrame:
    """(batch_id, n) of every committed batch; ``batch_id`` is its commit."""
    return read_committed(spark, folder, store, group_id, RECORD_COUNT).select(F.col("seq").alias("batch_id"), "n")


def console_sink(num_rows: int | None = None, truncate: bool = False, summarise=None):
    """K2: print every non-empty batch, whole unless ``num_rows`` is given;
    ``summarise`` is applied to a batch that holds rows (F1)."""
    def sink(df: DataFrame, batch_id: int) -> None:
        if df.isEmpty():
            return
        shown = summarise(df) if summarise else df
        print(f"---- batch {batch_id} ----")
        if num_rows is not None:
            shown.show(num_rows, truncate)
            return
        print(" | ".join(shown.columns))
        for row in shown.toLocalIterator():      # one partition at a time
            print(" | ".join(map(str, row)))
    return sink
