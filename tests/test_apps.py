"""The apps end to end on a folder of files (no broker here)."""

import json

import pytest

from streamledger.operators import counts, upsert
from streamledger.session import load_table, scratch_dir
from streamledger.sources import kafka
from streamledger.sources import log as logsrc
from streamledger.streaming import apps, jobs, sinks, tables
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def feed(spark):
    log = logsrc.message_log(load_table(spark, SF_SMALL, "events"))
    path = scratch_dir(spark, "appfeed")
    log.repartition(3).write.parquet(path)
    return log, path


def _run(spark, app, feed_dir, out, *extra):
    return apps.main([app, "--feed", feed_dir, "--out", out, "--once", *extra], spark)


def test_offsets_count_app_restart_and_new_checkpoint(spark, feed, workdir):
    log, feed_dir = feed

    def total():
        store = sinks.OffsetStore(spark, f"{workdir}/offsets")
        return sinks.record_counts(spark, f"{workdir}/counts", store, "g").groupBy().sum("n").first()[0]
    _run(spark, "offsets-count", feed_dir, workdir, "--group", "g")
    ext = {(r[0], r[1]): r[2] for r in logsrc.partition_extents(log).select("topic", "partition", "latest").collect()}
    assert sinks.OffsetStore(spark, f"{workdir}/offsets").current_map("g") == ext
    assert total() == log.count()
    _run(spark, "offsets-count", feed_dir, workdir, "--group", "g")           # nothing new
    _run(spark, "offsets-count", feed_dir, workdir, "--group", "g", "--checkpoint", "second")
    assert total() == log.count()                                             # resumed from the table


def test_reset_policy_on_a_folder(spark, feed, workdir):
    _, feed_dir = feed
    _run(spark, "offsets-count", feed_dir, workdir, "--group", "g", "--reset", "latest")
    assert sinks.OffsetStore(spark, f"{workdir}/offsets").current_map("g") == {}
    with pytest.raises(Exception, match="no stored offset"):
        _run(spark, "offsets-count", feed_dir, f"{workdir}/n", "--group", "g", "--reset", "none")
    with pytest.raises(SystemExit):
        _run(spark, "offsets-count", feed_dir, workdir, "--group", "g", "--max-per-partition", "5")


def test_upsert_compact_and_append_apps(spark, feed, workdir):
    log, feed_dir = feed
    _run(spark, "idempotent-upsert", feed_dir, f"{workdir}/u", "--group", "g")
    want = dict(upsert.upsert(None, upsert.upsert_rows(log, None)).select("order_id", "name").collect())
    view = lambda: dict(tables.UpsertTable(spark, f"{workdir}/u/table", sinks.OffsetStore(
        spark, f"{workdir}/u/offsets"), "g").view().collect())
    assert view() == want
    _run(spark, "compact-upsert", feed_dir, f"{workdir}/u", "--group", "g")
    assert view() == want
    for chk in ("one", "two"):
        _run(spark, "transactional-append", feed_dir, f"{workdir}/a", "--checkpoint", chk)
        assert jobs.appended_rows(spark, f"{workdir}/a/rows").count() == log.count()


def test_running_word_count_app_topic_filter(spark, feed, workdir):
    log, feed_dir = feed
    _run(spark, "running-word-count", feed_dir, workdir, "--topics", "click,view")
    got = sinks.read_batches(spark, f"{workdir}/counts")
    last = {r[0]: r[1] for r in got.groupBy("word").agg({"n": "max"}).collect()}
    assert last == dict(counts.word_count(logsrc.subscribe(log, "click,view"), "value").collect())


def test_console_apps_run(spark, feed, workdir, capsys):
    log, feed_dir = feed
    q = _run(spark, "direct-word-count", feed_dir, f"{workdir}/d")
    assert sum(p["numInputRows"] for p in q.recentProgress) > 0
    words = dict(counts.word_count(log, "value").collect())
    printed = capsys.readouterr().out.splitlines()
    assert {f"{w} | {n}" for w, n in words.items()} <= set(printed)          # every row
    q = _run(spark, "checkpoint-count", feed_dir, f"{workdir}/c", "--rows", "3")
    assert sum(p["numInputRows"] for p in q.recentProgress) > 0


def test_checkpoint_count_says_nothing_for_an_empty_batch(spark, feed, workdir, capsys):
    log, _ = feed
    log.limit(0).write.parquet(f"{workdir}/feed")
    _run(spark, "checkpoint-count", f"{workdir}/feed", f"{workdir}/c")
    assert "batch" not in capsys.readouterr().out


def test_kafka_needs_bootstrap():
    with pytest.raises(SystemExit):
        apps.main(["direct-word-count", "--out", "/nonexistent", "--once"])


def test_kafka_options_from_stored_offsets(spark, workdir, monkeypatch):
    """A new topic, a new partition, and a stored topic that nobody asked for."""
    seen = {}
    monkeypatch.setattr(kafka, "read_stream", lambda s, opts: seen.clear() or seen.update(opts))
    args = lambda *more: apps.parser().parse_args(
        ["offsets-count", "--bootstrap", "h:9092", "--group", "g", "--topics", "a,c", "--max-per-partition", "100",
         "--out", workdir, *more])
    stored = {("a", 0): 7, ("b", 0): 9}
    apps.open_stream(spark, args("--partitions", "a:2,b:1,c:1"), stored)
    assert json.loads(seen["assign"]) == {"a": [0, 1], "c": [0]}
    assert json.loads(seen["startingOffsets"]) == {"a": {"0": 7, "1": -2}, "c": {"0": -2}}
    assert seen["maxOffsetsPerTrigger"] == "300"
    apps.open_stream(spark, args("--partitions", "a:2,b:1,c:1"), {})         # the first start: the same cap
    assert seen["maxOffsetsPerTrigger"] == "300" and json.loads(seen["assign"]) == {"a": [0, 1], "c": [0]}
    with pytest.raises(SystemExit, match="partitions"):
        apps.open_stream(spark, args(), stored)
