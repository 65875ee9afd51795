"""The reference's defects D1-D11: each test shows the intended behaviour."""

import pytest

from streamledger.operators import offsets
from streamledger.schemas import OFFSETS, OFFSETS_LOG
from streamledger.sources import kafka
from streamledger.sources import log as logsrc
from streamledger.streaming import sinks


def test_d1_d5_offsets_read_back_typed_by_column(spark):
    cur = spark.createDataFrame([("g", "t", 2, 123456789012)], OFFSETS)
    back = offsets.from_tall(offsets.to_tall(cur), "g").first()
    assert (back["topic"], back["partition"], back["offset"]) == ("t", 2, 123456789012)
    assert dict(offsets.from_tall(offsets.to_tall(cur), "g").dtypes)["offset"] == "bigint"


def test_d2_output_before_offsets(spark, workdir):
    order = []
    store = sinks.OffsetStore(spark, f"{workdir}/offsets")
    real_commit = store.commit

    def commit(*a, **k):
        order.append("commit")
        real_commit(*a, **k)
    store.commit = commit
    fn = sinks.guarded(store, "g", lambda df, slot: order.append("work"))
    batch = spark.createDataFrame([("t", 0, 0, "a,1")],
                                  "topic string, partition int, offset bigint, value string")
    fn(batch, 0)
    assert order == ["work", "commit"]


def test_d3_d9_topic_and_group_by_equality(spark):
    hist = spark.createDataFrame(
        [("g", "a", 0, 1, 0), ("g", "a_", 0, 2, 0), ("g", "b", 0, 3, 0),
         ("h", "a", 0, 4, 0)], OFFSETS_LOG)
    got = [tuple(r) for r in offsets.current_offsets(hist, "g", "a").collect()]
    assert got == [("g", "a", 0, 1)]


def test_d4_empty_batch_commits_nothing(spark, workdir):
    store = sinks.OffsetStore(spark, f"{workdir}/offsets")
    fn = sinks.guarded(store, "g", lambda df, slot: None)
    empty = spark.createDataFrame([], "topic string, partition int, offset bigint, value string")
    fn(empty, 0)
    assert store.history().count() == 0


def test_d8_new_partitions_are_read(spark):
    extents = spark.createDataFrame([("t", 0, 0, 9), ("t", 1, 0, 9)],
                                    "topic string, partition int, earliest bigint, latest bigint")
    stored = spark.createDataFrame([("t", 0, 4)], "topic string, partition int, offset bigint")
    got = dict((r[1], r[2]) for r in logsrc.resolve_starts(extents, stored, "earliest").collect())
    assert got == {0: 4, 1: 0}
    opts = kafka.source_options("h:1", stored={("t", 0): 4}, partitions=[("t", 0), ("t", 1)])
    assert '"1": -2' in opts["startingOffsets"]


def test_d10_read_errors_surface(spark, workdir, monkeypatch):
    """A store that can't be read must not look like one without offsets."""
    from streamledger import fsio
    store = sinks.OffsetStore(spark, f"{workdir}/offsets")
    store.commit([("t", 0, 0, 5)], "g")

    def broken(*args):
        raise OSError("store unreachable")
    monkeypatch.setattr(fsio, "read_text", broken)
    ran = []
    fn = sinks.guarded(sinks.OffsetStore(spark, f"{workdir}/offsets"), "g", lambda df, slot: ran.append(slot))
    batch = spark.createDataFrame([("t", 0, 0, "a,1")], "topic string, partition int, offset bigint, value string")
    with pytest.raises(OSError, match="unreachable"):
        fn(batch, 0)
    assert not ran


def test_d7_d11_values_are_bound_not_spliced(spark):
    # a topic holding quote characters is just a value in a typed column
    odd = "x' OR '1'='1"
    hist = spark.createDataFrame([("g", odd, 0, 1, 0), ("g", "x", 0, 2, 0)], OFFSETS_LOG)
    got = offsets.current_offsets(hist, "g", [odd]).select("offset").collect()
    assert [r[0] for r in got] == [1]
