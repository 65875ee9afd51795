"""O1-O7 on literal offset rows (FIXTURES.md section 3)."""

import pytest

from streamledger.operators import offsets
from streamledger.schemas import OFFSETS, OFFSETS_LOG

RANGE = "topic string, partition int, from_offset bigint, until_offset bigint"


def test_batch_ranges_half_open(spark):
    batch = spark.createDataFrame([("a", 0, 5), ("a", 0, 6), ("a", 1, 9)],
                                  "topic string, partition int, offset bigint")
    got = sorted(tuple(r) for r in offsets.batch_ranges(batch).collect())
    assert got == [("a", 0, 5, 7), ("a", 1, 9, 10)]


def test_current_is_latest_commit_and_filters_exactly(spark):
    hist = spark.createDataFrame([
        ("g", "a", 0, 10, 0), ("g", "a", 0, 30, 2), ("g", "a", 0, 20, 1),
        ("g", "a_b", 0, 7, 0), ("g", "b", 0, 9, 0), ("h", "a", 0, 99, 5),
    ], OFFSETS_LOG)
    got = sorted(tuple(r) for r in offsets.current_offsets(hist, "g", "a").collect())
    # equality on the topic: "a_b" and "b" are not picked up (D3)
    assert got == [("g", "a", 0, 30)]


def test_guard_verdicts(spark):
    ranges = spark.createDataFrame([
        ("t", 0, 100, 200),   # continues stored 100 -> commit
        ("t", 1, 0, 50),      # nothing stored -> commit
        ("t", 2, 100, 200),   # stored 200 = until -> replay, skip
        ("t", 3, 100, 200),   # stored 150: stale -> raise
        ("t", 4, 100, 200),   # stored 50: gap -> raise
    ], RANGE)
    cur = spark.createDataFrame([("g", "t", 0, 100), ("g", "t", 2, 200), ("g", "t", 3, 150),
                                 ("g", "t", 4, 50)], OFFSETS)
    got = {r["partition"]: r["verdict"] for r in offsets.guard(ranges, cur).collect()}
    assert got == {0: "commit", 1: "commit", 2: "skip", 3: "raise", 4: "raise"}


@pytest.mark.parametrize("parts,expected", [
    ([0, 1], "commit"), ([2], "skip"), ([0, 2], "raise"), ([3], "raise"), ([], "empty"),
])
def test_batch_verdict(spark, parts, expected):
    ranges = spark.createDataFrame(
        [("t", p, 100, 200) if p != 1 else ("t", 1, 0, 50) for p in parts], RANGE)
    cur = spark.createDataFrame([("g", "t", 0, 100), ("g", "t", 2, 200), ("g", "t", 3, 150)],
                                OFFSETS)
    assert offsets.batch_verdict(offsets.guard(ranges, cur)) == expected


def test_seed_only_missing_partitions(spark):
    parts = spark.createDataFrame([("t", 0), ("t", 1), ("t", 1), ("u", 0)],
                                  "topic string, partition int")
    cur = spark.createDataFrame([("g", "t", 0, 100)], OFFSETS)
    got = sorted(tuple(r) for r in offsets.seed_missing(parts, cur, "g").collect())
    assert got == [("g", "t", 1, 0), ("g", "u", 0, 0)]


TRICKY = [("g-1", "a", 0, 5), ("g-1", "a_b", 1, 6), ("g-1", "b-c_d", 2, 7),
          ("g-1", "x_1", 10, 8)]


def test_tall_round_trip(spark):
    cur = spark.createDataFrame(TRICKY, OFFSETS)
    back = offsets.from_tall(offsets.to_tall(cur), "g-1")
    assert sorted(tuple(r) for r in back.collect()) == sorted(TRICKY)
    keys = sorted(r[0] for r in offsets.to_tall(cur).collect())
    assert keys == ["a_0", "a_b_1", "b-c_d_2", "x_1_10"]


def test_path_round_trip(spark):
    cur = spark.createDataFrame(TRICKY, OFFSETS)
    paths = offsets.to_path(cur)
    assert sorted(r[0] for r in paths.collect())[0] == "a/g-1/0"
    back = offsets.from_path(paths)
    assert sorted(tuple(r) for r in back.collect()) == sorted(TRICKY)


def test_wide_round_trip(spark):
    # topics and the group contain "-": the group decides where the key splits
    rows = [("g-1", "a-b", 0, 5), ("g-1", "a-b", 2, 6), ("g-1", "c", 1, 7)]
    other = [("x", "a-b-g", 0, 9)]           # key "a-b-g-x": another group's row
    cur = spark.createDataFrame(rows + other, OFFSETS)
    wide = offsets.to_wide(cur, [0, 1, 2])
    assert wide.columns == ["rowkey", "0", "1", "2"]
    back = offsets.from_wide(wide, "g-1")
    assert sorted(tuple(r) for r in back.collect()) == sorted(rows)


def test_driver_side_verdict_agrees_with_guard(spark):
    cases = [(100, 200, 100), (0, 50, None), (100, 200, 200), (100, 200, 150),
             (100, 200, 50), (5, 5, 5), (0, 0, None)]
    ranges = spark.createDataFrame(
        [("t", i, a, b) for i, (a, b, _) in enumerate(cases)], RANGE)
    cur = spark.createDataFrame(
        [("g", "t", i, c) for i, (_, _, c) in enumerate(cases) if c is not None], OFFSETS)
    by_df = {r["partition"]: r["verdict"] for r in offsets.guard(ranges, cur).collect()}
    by_py = {i: offsets.range_verdict(a, b, c) for i, (a, b, c) in enumerate(cases)}
    assert by_df == by_py
