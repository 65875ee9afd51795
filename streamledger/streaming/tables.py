"""Keyed tables on plain files: K3's upsert table and A2's running counts.

A batch appends its rows (O(batch)) in a folder that its commit names.  The table
is a base in buckets of the key's hash, and the rows of later commits on top,
reduced to one row a key.  ``compact`` merges those rows into the base and writes
only the buckets that they touch; run it beside the stream, on a schedule of its
own.  A manifest, one small numbered file like a commit, names the folder that
holds each bucket and the last commit the base covers.  Readers look at the
newest manifest and at what it and later commits name, and list nothing else, so
a read costs as much as there are commits since the last compaction.

``vacuum`` removes folders that no manifest or commit names any more: bases that
were replaced, rows that went into a base, and what crashed batches left.  A
manifest that was current within the grace period still counts, and so does any
folder changed within it, so readers and running batches keep what they use.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamledger import fsio
from streamledger.operators import counts, upsert
from streamledger.streaming.sinks import BatchFn, CommitConflict, OffsetStore, Slot, read_committed, write_tagged

BUCKETS = 64


class KeyedTable:
    """A table of one row per ``key``; ``merge`` reduces rows of equal keys and
    may be applied to its own result."""

    def __init__(self, spark: SparkSession, folder: str, store: OffsetStore, group_id: str, schema: str,
                 key: str, merge: Callable[[DataFrame], DataFrame], buckets: int = BUCKETS):
        self.spark, self.folder, self.store, self.group_id = spark, folder, store, group_id
        self.schema, self.key, self.merge, self.buckets = schema, key, merge, buckets

    # -- manifest

    def _path(self, n: int) -> str:
        return f"{self.folder}/m-{n:08d}.json"

    def manifest(self) -> tuple[int, dict]:
        """Number and content of the newest manifest (-1: none yet)."""
        hint = fsio.read_text(self.spark, f"{self.folder}/_manifest")
        n = int(hint) if hint else -1
        text = fsio.read_text(self.spark, self._path(n)) if hint else None
        while (newer := fsio.read_text(self.spark, self._path(n + 1))) is not None:
            n, text = n + 1, newer
        empty = {"reach": -1, "buckets": self.buckets, "files": {}, "aside": []}
        return n, json.loads(text) if text else empty

    def _publish(self, n: int, content: dict) -> None:
        if not fsio.write_text(self.spark, self._path(n), json.dumps(content), overwrite=False):
            raise CommitConflict(f"{self.folder}: manifest {n} was made by another compaction")
        fsio.write_text(self.spark, f"{self.folder}/_manifest", str(n), overwrite=True)

    # -- reading

    def _rows(self, after: int) -> DataFrame:
        """Rows of the commits after number ``after``."""
        return read_committed(self.spark, f"{self.folder}/rows", self.store, self.group_id, self.schema, after)

    def _kept(self, rows: DataFrame) -> DataFrame:
        """The rows that belong to the table."""
        return rows

    def _bucket(self, n: int):
        return F.pmod(F.xxhash64(self.key), F.lit(n)).cast("int")

    def _base(self, files: dict[str, str], wanted) -> DataFrame | None:
        """The base's rows in the buckets ``wanted``."""
        paths = [f"{self.folder}/{files[b]}/bucket={b}" for b in sorted(files) if wanted(int(b))]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else None

    def _merged(self, content: dict, rows: DataFrame) -> tuple[set[int], DataFrame]:
        """The buckets that rows touch, and these as they are with the rows."""
        touched = {r[0] for r in rows.select(self._bucket(content["buckets"])).distinct().collect()}    # a row a bucket
        old = self._base(content["files"], touched.__contains__)
        return touched, self.merge(rows if old is None else old.unionByName(rows))

    def state(self) -> DataFrame:
        """The table after the last commit.  Buckets that no later row touches
        are passed on as they are stored."""
        _, content = self.manifest()
        rows = self._kept(self._rows(content["reach"]))
        touched, merged = self._merged(content, rows)
        rest = self._base(content["files"], lambda b: b not in touched)
        return merged if rest is None else rest.unionByName(merged)

    # -- maintenance

    def compact(self, buckets: int | None = None) -> int:
        """Merge all committed rows into the base; returns how many buckets were
        written.  ``buckets``: a new number of them, which writes them all."""
        n, content = self.manifest()
        reach = self.store.tip(self.group_id)[0]
        found = self._rows(content["reach"]).where(F.col("seq") <= reach)
        rows = self._kept(found)
        name = f"base/{reach:012d}-{uuid.uuid4().hex[:12]}"
        if buckets and buckets != content["buckets"]:
            old = self._base(content["files"], lambda b: True)
            merged = self.merge(rows if old is None else old.unionByName(rows))
            content = {**content, "buckets": buckets, "files": {}}
            touched = None
        else:
            touched, merged = self._merged(content, rows)
        if touched or touched is None:
            merged.withColumn("bucket", self._bucket(content["buckets"])).repartition("bucket") \
                .write.partitionBy("bucket").parquet(f"{self.folder}/{name}")
            made = [f.partition("=")[2] for f in fsio.folders(self.spark, f"{self.folder}/{name}") if f.startswith("bucket=")]
            content = {**content, "files": {**content["files"], **dict.fromkeys(made, name)}}
            written = len(made)
        else:
            written = 0
        content = {**content, "aside": content["aside"] + self._put_aside(found, name), "reach": reach}
        self._publish(n + 1, content)
        return written

    def _put_aside(self, found: DataFrame, name: str) -> list[str]:
        """Folders made for rows that are kept beside the table."""
        return []

    def _live(self, content: dict) -> set[str]:
        rows = {f"rows/tag={tag}" for _, tag in self.store.tags(self.group_id, content["reach"])}
        return set(content["files"].values()) | set(content["aside"]) | rows

    def vacuum(self, grace: float = 7 * 86400.0) -> list[str]:
        """Remove folders that nothing names; ``grace`` in seconds.  Returns them."""
        n, content = self.manifest()
        live = self._live(content)
        while n >= 0 and fsio.age_seconds(self.spark, self._path(n)) < grace:       # current within the period
            n -= 1
            text = fsio.read_text(self.spark, self._path(n)) if n >= 0 else None
            live |= self._live(json.loads(text) if text else {"reach": -1, "files": {}, "aside": []})
        gone = []
        for kind in ("rows", "base", "aside"):
            for name in fsio.folders(self.spark, f"{self.folder}/{kind}"):
                path = f"{kind}/{name}"
                if path not in live and fsio.age_seconds(self.spark, f"{self.folder}/{path}") >= grace:
                    fsio.delete_folder(self.spark, f"{self.folder}/{path}")
                    gone.append(path)
        return gone


# ---------------------------------------------------------------- K3: the upsert

UPSERT_ROWS = ("order_id string, name string, "
               "ord struct<batch_id bigint, offset bigint, topic string, partition int>, raw string")


class UpsertTable(KeyedTable):
    """K3: the last name of every order.  Messages that are no ``name,order_id``
    (``raw`` tells) lie in the same folders as the batch's rows, so one commit
    covers both; ``quarantine`` lists them."""

    def __init__(self, spark: SparkSession, folder: str, store: OffsetStore, group_id: str, buckets: int = BUCKETS):
        super().__init__(spark, folder, store, group_id, UPSERT_ROWS, "order_id", self._last, buckets)

    @staticmethod
    def _last(rows: DataFrame) -> DataFrame:
        return upsert.upsert(None, rows).withColumn("raw", F.lit(None).cast("string"))

    def _kept(self, rows: DataFrame) -> DataFrame:
        return rows.where("raw is null").select("order_id", "name", "ord", "raw")

    def _put_aside(self, found: DataFrame, name: str) -> list[str]:
        bad = found.where("raw is not null").select("ord", "raw", "seq")
        if bad.isEmpty():
            return []
        path = f"aside/{name.rpartition('/')[2]}"
        bad.write.parquet(f"{self.folder}/{path}")
        return [path]

    def view(self) -> DataFrame:
        return self.state().select("order_id", "name")

    def quarantine(self) -> DataFrame:
        """(batch_id, topic, partition, offset, raw) of every message set aside."""
        _, content = self.manifest()
        bad = self._rows(content["reach"]).where("raw is not null").select("ord", "raw", "seq")
        if content["aside"]:
            bad = bad.unionByName(self.spark.read.schema(bad.schema).parquet(
                *[f"{self.folder}/{p}" for p in content["aside"]]))
        return bad.select(F.col("seq").alias("batch_id"), "ord.topic", "ord.partition", "ord.offset", "raw")


def upsert_work(folder: str, mode: str = "fail") -> BatchFn:
    """K3 work for ``guarded``: append the batch's strictly parsed rows.

    P6: ``fail`` stops at a message that is no pair; ``quarantine`` writes it
    aside in the same pass, and its commit notes how many there were.
    """
    def work(df: DataFrame, slot: Slot) -> dict | None:
        rows = upsert.upsert_rows(df.withColumn("batch_id", F.lit(slot.seq).cast("bigint")), mode=mode)
        if mode == "fail":
            write_tagged(rows, f"{folder}/rows", slot)
            return None
        from pyspark.sql import Observation
        seen = Observation()
        write_tagged(rows.observe(seen, F.count_if(F.col("raw").isNotNull()).alias("bad")), f"{folder}/rows", slot)
        return {"bad": seen.get["bad"]}
    return work


# --------------------------------------------------------- A2: counts that stay

WORD_ROWS = "word string, n bigint"


class CountTable(KeyedTable):
    """A2: the running count of every word.  The counts live with the group's
    commits, not in a query's checkpoint, so they go on under a new one."""

    def __init__(self, spark: SparkSession, folder: str, store: OffsetStore, group_id: str, buckets: int = BUCKETS):
        super().__init__(spark, folder, store, group_id, WORD_ROWS, "word", self._total, buckets)

    @staticmethod
    def _total(rows: DataFrame) -> DataFrame:
        return rows.groupBy("word").agg(F.sum("n").alias("n"))

    def _kept(self, rows: DataFrame) -> DataFrame:
        return rows.select("word", "n")

    def view(self) -> DataFrame:
        return self.state().select("word", "n")


def running_count_work(folder: str) -> BatchFn:
    """A2 work for ``guarded``: the batch's word counts, added by ``CountTable``."""
    def work(df: DataFrame, slot: Slot) -> None:
        write_tagged(counts.word_count(df, "value"), f"{folder}/rows", slot)
    return work
