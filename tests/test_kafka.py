"""Kafka option maps (no connector in this image: only the options are tested)."""

import json

import pytest

from streamledger.sources import kafka


def test_subscribe_translates_reset_and_drops_managed_settings():
    opts = kafka.source_options(
        "h1:9092,h2:9092", topics="b,a,a", reset="smallest",
        extra={"group.id": "g", "enable.auto.commit": "false",
               "kafka.auto.offset.reset": "smallest", "minPartitions": "6"})
    assert opts == {"kafka.bootstrap.servers": "h1:9092,h2:9092", "subscribe": "a,b",
                    "startingOffsets": "earliest", "minPartitions": "6"}


def test_pattern_and_latest():
    opts = kafka.source_options("h:1", pattern="spark.*", reset="largest")
    assert opts["subscribePattern"] == "spark.*" and opts["startingOffsets"] == "latest"


def test_assign_from_stored_offsets_includes_new_partitions():
    stored = {("t", 0): 100, ("t", 1): 70}
    opts = kafka.source_options("h:1", stored=stored, reset="earliest",
                                partitions=[("t", 0), ("t", 1), ("t", 2)],
                                max_per_partition=200)
    assert json.loads(opts["assign"]) == {"t": [0, 1, 2]}
    assert json.loads(opts["startingOffsets"]) == {"t": {"0": 100, "1": 70, "2": -2}}
    assert opts["maxOffsetsPerTrigger"] == "600"


def test_none_policy_needs_every_partition():
    with pytest.raises(ValueError, match="no stored offset"):
        kafka.source_options("h:1", stored={("t", 0): 1}, reset="none",
                             partitions=[("t", 0), ("t", 1)])
    with pytest.raises(ValueError):
        kafka.source_options("h:1", topics="t", reset="none")
    opts = kafka.source_options("h:1", stored={("t", 0): 1}, reset="none",
                                partitions=[("t", 0)])
    assert json.loads(opts["startingOffsets"]) == {"t": {"0": 1}}


def test_cap_uses_the_real_number_of_partitions():
    first = kafka.source_options("h:1", topics="t", max_per_partition=200, total_partitions=3)
    again = kafka.source_options("h:1", stored={("t", 0): 5}, max_per_partition=200,
                                 partitions=[("t", 0), ("t", 1), ("t", 2)])
    assert first["maxOffsetsPerTrigger"] == again["maxOffsetsPerTrigger"] == "600"
    with pytest.raises(ValueError, match="number of partitions"):
        kafka.source_options("h:1", topics="t", max_per_partition=200)


def test_foreign_topics_are_not_assigned():
    opts = kafka.source_options("h:1", stored={("a", 0): 1, ("b", 0): 2}, partitions=[("a", 0), ("c", 0)])
    assert json.loads(opts["assign"]) == {"a": [0], "c": [0]}
    assert json.loads(opts["startingOffsets"]) == {"a": {"0": 1}, "c": {"0": -2}}


def test_ranges_from_the_checkpoint(spark, workdir):
    from streamledger import fsio
    for name, text in (("sources/0/0", '{"t":{"0":5,"1":7}}'), ("offsets/0", '{"t":{"0":9,"1":7}}'),
                       ("offsets/1", '{"t":{"0":20,"1":8,"2":3}}')):
        fsio.write_text(spark, f"{workdir}/chk/{name}", "v1\n{}\n" + text, overwrite=True)
    ranges = kafka.checkpoint_ranges(spark, f"{workdir}/chk")
    assert ranges(0) == [("t", 0, 5, 9), ("t", 1, 7, 7)]
    assert ranges(1) == [("t", 0, 9, 20), ("t", 1, 7, 8), ("t", 2, 0, 3)]
    with pytest.raises(RuntimeError):
        ranges(2)


def test_unknown_policy_rejected():
    with pytest.raises(ValueError):
        kafka.source_options("h:1", topics="t", reset="sometimes")
