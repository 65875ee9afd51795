"""S1-S5, S7 on the log derived from events, checked against brute force."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from streamledger.session import load_table
from streamledger.sources import log as logsrc
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def events(spark):
    return load_table(spark, SF_SMALL, "events")


def _brute_log(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("event_id").copy()
    pdf["topic"] = pdf["event_type"]
    pdf["partition"] = pdf["user_id"] % 3
    pdf["offset"] = pdf.groupby(["topic", "partition"]).cumcount()
    return pdf


def test_offsets_are_dense_positions_by_event_id(spark, events):
    # a tiny block forces many blocks per partition
    got = logsrc.message_log(events, 3, block=17, span=17 ** 3).select(
        "topic", "partition", "offset", "key").toPandas()
    want = _brute_log(events.select("event_id", "event_type", "user_id").toPandas())
    want["key"] = want["user_id"].astype(str)
    cols = ["topic", "partition", "offset", "key"]
    a = got[cols].sort_values(cols).reset_index(drop=True)
    b = want[cols].sort_values(cols).reset_index(drop=True)
    b["partition"] = b["partition"].astype(a["partition"].dtype)
    pd.testing.assert_frame_equal(a, b, check_dtype=False)


def test_null_keys_are_numbered_not_dropped(spark):
    ev = spark.createDataFrame(
        [(1, None, 5, "x"), (2, None, 5, "x"), (3, "a", None, "x"), (4, "a", 1, "x"),
         (5, None, 5, "x")],
        "event_id bigint, event_type string, user_id bigint, props string",
    ).withColumn("ts", F.current_timestamp())
    rows = logsrc.message_log(ev, 3, block=2, span=16).select(
        "topic", "partition", "offset").collect()
    assert len(rows) == 5
    nulls = sorted(r["offset"] for r in rows if r["topic"] is None)
    assert nulls == [0, 1, 2]


def test_subscribe_splits_comma_list_and_pushes_down(spark, events):
    log = logsrc.message_log(events)
    df = logsrc.subscribe(log, "click,view,,click")
    assert {r[0] for r in df.select("topic").distinct().collect()} == {"click", "view"}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "In(event_type, [click,view])" in plan


def test_pattern_is_a_whole_name_match(spark):
    log = spark.createDataFrame(
        [("ab", 0, 0), ("abc", 0, 0), ("xab", 0, 0), ("a\nb", 0, 0)],
        "topic string, partition int, offset bigint")
    got = [r[0] for r in logsrc.subscribe_pattern(log, "ab|a.c").collect()]
    assert sorted(got) == ["ab", "abc"]


def test_read_ranges_only_assigned_partitions(spark, events):
    log = logsrc.message_log(events)
    ranges = logsrc.ranges_frame(spark, {("click", 0): (2, 5), ("view", 2): (0, 1)})
    got = sorted((r[0], r[1], r[2]) for r in
                 logsrc.read_ranges(log, ranges).select("topic", "partition", "offset").collect())
    assert got == [("click", 0, 2), ("click", 0, 3), ("click", 0, 4), ("view", 2, 0)]


def test_start_policies_and_rate_cap(spark):
    extents = spark.createDataFrame(
        [("t", 0, 0, 500), ("t", 1, 10, 80), ("t", 2, 0, 300)],
        "topic string, partition int, earliest bigint, latest bigint")
    stored = spark.createDataFrame([("t", 0, 100), ("t", 1, 70)],
                                   "topic string, partition int, offset bigint")
    early = {r[1]: r[2] for r in logsrc.resolve_starts(extents, stored, "smallest").collect()}
    late = {r[1]: r[2] for r in logsrc.resolve_starts(extents, stored, "latest").collect()}
    assert early == {0: 100, 1: 70, 2: 0}      # partition 2 is new (D8)
    assert late == {0: 100, 1: 70, 2: 300}
    with pytest.raises(Exception, match="no stored offset"):
        logsrc.resolve_starts(extents, stored, "none").collect()
    starts = logsrc.resolve_starts(extents, stored, "earliest")
    plan = {r[1]: (r[2], r[3]) for r in logsrc.plan_ranges(starts, extents, 200).collect()}
    assert plan == {0: (100, 300), 1: (70, 80), 2: (0, 200)}
    # the reference's illustration: 2 s x 3 partitions x 100/s = 600 per batch
    total = sum(u - f for f, u in logsrc.plan_ranges(
        logsrc.resolve_starts(extents.withColumn("latest", F.lit(10_000)), stored,
                              "earliest"), extents.withColumn("latest", F.lit(10_000)),
        2 * 100).select("from_offset", "until_offset").collect())
    assert total == 600


def test_projections(spark, events):
    log = logsrc.message_log(events)
    assert logsrc.project(log, "kv").columns == ["key", "value"]
    assert logsrc.project(log, "tv").columns == ["topic", "value"]
    row = log.where(F.col("offset") == 0).first()
    assert row["value"] == f"{row['topic']},{row['key']}"


def test_next_batch_iterated_reads_the_log_exactly_once(spark, events, workdir):
    from streamledger.operators import offsets
    from streamledger.streaming import sinks
    log = logsrc.message_log(events).persist()
    store = sinks.OffsetStore(spark, f"{workdir}/offsets")
    seen, b = 0, 0
    while True:
        stored = store.current("g").select("topic", "partition", "offset")
        batch = logsrc.next_batch(log, stored, "earliest", 25).persist()
        ranges = offsets.batch_ranges(batch).collect()
        if not ranges or all(r["from_offset"] == r["until_offset"] for r in ranges):
            break
        assert max(r["until_offset"] - r["from_offset"] for r in ranges) <= 25
        assert store.verdict(ranges, "g") == "commit"
        seen += batch.count()
        assert store.commit(ranges, "g") == b
        batch.unpersist()
        b += 1
    assert seen == log.count() and b == -(-max(
        r[0] for r in logsrc.partition_extents(log).select("latest").collect()) // 25)
    log.unpersist()


def _plan(df):
    conf, key = df.sparkSession.conf, "spark.sql.maxMetadataStringLength"
    before = conf.get(key)
    conf.set(key, "100000")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        conf.set(key, before)


def test_stored_log_is_pruned_and_filtered(spark):
    """S2, S4+S7 and O6: bounds reach the scan of the stored log and offset
    table, and no offset query goes back to the events."""
    import re

    from streamledger.plans.queries import QUERIES
    for name in ("assigned_ranges", "next_batch"):
        plan = _plan(QUERIES[name](spark, SF_SMALL))
        pushed = re.search(r"PushedFilters: \[(.*?)ReadSchema", plan, re.S).group(1)
        assert "GreaterThanOrEqual(offset" in pushed and "events.parquet" not in plan
        assert re.search(r"PartitionFilters: \[[^\]]*topic", plan)
    plan = _plan(QUERIES["offsets_current"](spark, SF_SMALL))
    assert "EqualTo(group_id,stream-a)" in plan and "In(topic" in plan
    for name in QUERIES:
        if name.startswith(("offsets_", "start_", "rate_", "batch_ranges", "message_", "topic_")):
            assert "events.parquet" not in _plan(QUERIES[name](spark, SF_SMALL)), name
