"""Bucketed tables: what a compaction writes, what a read touches, what vacuum
removes; bad messages set aside; counts that outlive a checkpoint."""

import os

import pytest

from streamledger import fsio
from streamledger.streaming import sinks, tables

MESSAGES = "topic string, partition int, offset bigint, value string"


class Feed:
    """Commits batches of messages of one partition through ``guarded``."""

    def __init__(self, spark, workdir, work, group="g"):
        self.spark, self.at, self.batch = spark, 0, 0
        self.store = sinks.OffsetStore(spark, f"{workdir}/offsets")
        self.run = sinks.guarded(self.store, group, work)

    def __call__(self, values):
        rows = [("t", 0, self.at + i, v) for i, v in enumerate(values)]
        self.run(self.spark.createDataFrame(rows, MESSAGES), self.batch)
        self.at, self.batch = self.at + len(values), self.batch + 1


def _upsert(spark, workdir, mode="fail", buckets=64):
    feed = Feed(spark, workdir, tables.upsert_work(f"{workdir}/t", mode))
    return feed, tables.UpsertTable(spark, f"{workdir}/t", feed.store, "g", buckets)


def test_compaction_writes_only_touched_buckets(spark, workdir):
    feed, table = _upsert(spark, workdir)
    feed([f"a,{k}" for k in range(300)])
    assert table.compact() == 64
    before = table.manifest()[1]["files"]
    feed([f"b,{k}" for k in range(3)])                        # 1% of the keys
    want = {str(k): "b" if k < 3 else "a" for k in range(300)}
    assert dict(table.view().collect()) == want               # before and after
    written = table.compact()
    after = table.manifest()[1]["files"]
    assert written <= 3 and sum(before[b] != after[b] for b in after) == written
    assert dict(table.view().collect()) == want
    assert table.compact() == 0 and dict(table.view().collect()) == want
    assert table.compact(buckets=8) == 8                      # written anew, by another number
    feed(["c,0", "c,new"])
    assert dict(table.view().collect()) == {**want, "0": "c", "new": "c"}


def test_untouched_buckets_are_not_shuffled(spark, workdir):
    feed, table = _upsert(spark, workdir)
    feed([f"a,{k}" for k in range(300)])
    table.compact()
    feed(["b,7"])
    plan = table.view()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 3 and plan.count("Exchange hashpartitioning") == 1


def test_calls_of_a_read_do_not_grow_with_commits(spark, workdir, monkeypatch):
    feed, table = _upsert(spark, workdir, buckets=4)
    feed(["a,1", "a,2"])
    for n in range(1, 500):                                   # commits without output of their own
        feed.store.commit([("t", 0, n + 1, n + 2)], "g", sinks.Slot(n, ""))
    table.compact()
    calls = []
    for name in ("read_text", "write_text", "folders", "age_seconds"):
        real = getattr(fsio, name)
        monkeypatch.setattr(fsio, name, lambda *a, real=real, **k: calls.append(a[1]) or real(*a, **k))
    fresh = tables.UpsertTable(spark, f"{workdir}/t", sinks.OffsetStore(spark, f"{workdir}/offsets"), "g")
    assert dict(fresh.view().collect()) == {"1": "a", "2": "a"}
    assert len(calls) <= 8


def test_vacuum_sweeps_orphans_and_never_what_is_live(spark, workdir):
    feed, table = _upsert(spark, workdir)
    feed([f"a,{k}" for k in range(20)])
    feed(["b,1", "b,2"])
    sinks.write_tagged(spark.createDataFrame([("x", "y")], "order_id string, name string"), f"{workdir}/t/rows",
                       sinks.Slot(2, "000000000002-crashed"))   # written, never committed
    state = lambda: dict(table.view().collect())
    want = state()
    assert table.vacuum(grace=3600) == [] and state() == want   # too young
    assert table.vacuum(grace=0) == ["rows/tag=000000000002-crashed"] and state() == want
    table.compact()
    feed(["c,3"])
    want = state()
    assert table.vacuum(grace=3600) == []                       # the state before is within the grace period
    gone = table.vacuum(grace=0)
    assert len(gone) == 2 and all(g.startswith("rows/tag=") for g in gone) and state() == want
    table.compact()
    gone = table.vacuum(grace=0)
    assert [g.split("/")[0] for g in gone] == ["rows"] and state() == want     # the old base holds other buckets
    table.compact(buckets=2)
    gone = table.vacuum(grace=0)
    assert [g.split("/")[0] for g in gone] == ["base", "base"] and state() == want
    assert os.listdir(f"{workdir}/t/rows") == []


def test_two_compactions_at_once_do_not_both_count(spark, workdir, monkeypatch):
    feed, table = _upsert(spark, workdir, buckets=4)
    feed(["a,1", "a,2"])
    other = tables.UpsertTable(spark, f"{workdir}/t", feed.store, "g", 4)
    real = table._publish
    monkeypatch.setattr(table, "_publish", lambda n, c: (other.compact(), real(n, c)))
    with pytest.raises(sinks.CommitConflict):
        table.compact()
    assert dict(other.view().collect()) == {"1": "a", "2": "a"} and other.manifest()[0] == 0
    assert other.vacuum(grace=0)                                # the loser's base is an orphan


def test_bad_messages_are_set_aside_under_the_same_commit(spark, workdir):
    feed, table = _upsert(spark, workdir, "quarantine")
    feed(["a,1", "no pair", "a,2", None, "x,y,z"])
    feed(["b,2"])
    bad = {(0, "t", 0, 1, "no pair"), (0, "t", 0, 3, ""), (0, "t", 0, 4, "x,y,z")}
    for _ in range(2):                                          # before and after a compaction
        assert dict(table.view().collect()) == {"1": "a", "2": "b"}
        assert {tuple(r) for r in table.quarantine().collect()} == bad
        table.compact()
    table.vacuum(grace=0)
    assert {tuple(r) for r in table.quarantine().collect()} == bad
    assert feed.store.notes("g", 0) == {"bad": 3} and feed.store.notes("g", 1) == {"bad": 0}
    assert feed.store.current_map("g") == {("t", 0): 6}
    strict, _ = _upsert(spark, f"{workdir}/strict")
    with pytest.raises(Exception, match="malformed"):
        strict(["a,1", "no pair"])
    assert strict.store.tip("g") == (-1, {})


def test_counts_go_on_from_the_table(spark, workdir):
    feed = Feed(spark, workdir, tables.running_count_work(f"{workdir}/w"))
    table = tables.CountTable(spark, f"{workdir}/w", feed.store, "g", 8)
    feed(["a b a", "c"])
    table.compact()
    feed(["a  d"])
    assert dict(table.view().collect()) == {"a": 3, "b": 1, "c": 1, "d": 1}
    assert dict(tables.CountTable(spark, f"{workdir}/w", sinks.OffsetStore(spark, f"{workdir}/offsets"), "g").view().collect()) \
        == {"a": 3, "b": 1, "c": 1, "d": 1}


def test_a_table_without_commits_is_empty(spark, workdir):
    _, table = _upsert(spark, workdir)
    assert table.view().count() == 0 and table.quarantine().count() == 0
    assert table.compact() == 0 and table.vacuum(grace=0) == []
