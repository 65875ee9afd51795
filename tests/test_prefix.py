"""Two-level running totals equal a plain window, even with hot and null keys."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from streamledger.operators.prefix import running_total, running_total_non_null


def test_running_total_matches_row_number(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        k = "hot" if rnd.random() < 0.4 else rnd.choice(["a", "b", None])
        p = rnd.choice([0, 1, None])
        rows.append((k, p, i * 3 + rnd.randint(0, 2), rnd.randint(-5, 9)))
    df = spark.createDataFrame(rows, "k string, p int, pos bigint, v bigint")
    got = running_total(df, ["k", "p"], "pos", None, "rn", block=16, span=1 << 12)
    got = running_total(got, ["k", "p"], "pos", "v", "cum", block=7, span=2000)
    w = Window.partitionBy("k", "p").orderBy("pos")
    want = df.select("*", F.row_number().over(w).cast("bigint").alias("rn"),
                     F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cum"))
    cols = ["k", "p", "pos", "v", "rn", "cum"]
    key = lambda r: tuple((x is None, x if x is not None else 0) for x in r)
    assert (sorted(got.select(cols).collect(), key=key)
            == sorted(want.select(cols).collect(), key=key))
    assert got.count() == 3000


def test_running_total_does_not_reshuffle_big_side(spark):
    df = spark.range(0, 1000).select(
        (F.col("id") % 3).cast("string").alias("k"), F.col("id").alias("pos"))
    keep = {k: spark.conf.get(k) for k in
            ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = running_total_non_null(df, ["k"], "pos", None, "rn", block=64, span=4096)
        text = plan._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
    assert "SortMergeJoin" in text
    # rows: one exchange (the in-block window); block totals: partial
    # aggregate, block window, join side.  A re-shuffled big side would be 5.
    assert text.count("Exchange hashpartitioning") == 4


def test_hot_key_is_split_into_bounded_window_groups(spark):
    """One key holds a third of 300k rows; every window group stays <= block."""
    n, block = 300_000, 4096
    df = spark.range(0, n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
         .otherwise((F.col("id") % 997).cast("string")).alias("k"),
        F.col("id").alias("pos"))
    got = running_total_non_null(df, ["k"], "pos", None, "rn", block=block, span=1 << 24)
    w = Window.partitionBy("k").orderBy("pos")
    want = df.select("k", "pos", F.row_number().over(w).cast("bigint").alias("rn"))
    assert got.select("k", "pos", "rn").exceptAll(want).count() == 0
    assert got.count() == n
    groups = df.groupBy("k", F.expr(f"pos div {block}").alias("b")).count()
    assert groups.agg(F.max("count")).first()[0] <= block
    assert df.where("k = 'hot'").count() == n // 3


def _window_groups(df, block, levels):
    """Largest group that a window sees at each level."""
    out = [df.groupBy("k", F.expr(f"pos div {block}")).count().agg(F.max("count")).first()[0]]
    for level in range(1, levels):
        low, high = block ** level, block ** (level + 1)
        blocks = df.select("k", F.expr(f"pos div {low}").alias("b"), F.expr(f"pos div {high}").alias("up")).distinct()
        out.append(blocks.groupBy("k", "up").count().agg(F.max("count")).first()[0])
    return out


def test_sparse_positions_are_split_at_every_level(spark):
    """Ids multiplied by 2**22: every block of 2**20 holds one row, so blocks
    are numbered in groups too."""
    block, n = 1 << 10, 20_000
    df = spark.range(0, n).select(F.lit("hot").alias("k"), (F.col("id") * (1 << 22)).alias("pos"))
    got = running_total_non_null(df, ["k"], "pos", None, "rn", block=block, span=1 << 40)
    assert got.where(F.col("rn") != F.col("pos") / (1 << 22) + 1).count() == 0 and got.count() == n
    assert max(_window_groups(df, block, 4)) <= block


def test_null_positions_come_first_in_many_blocks(spark):
    from streamledger.operators import prefix
    df = spark.range(0, 3000).select(F.lit("k").alias("k"), F.when(F.col("id") >= 2000, F.col("id")).alias("pos"),
                                     F.col("id").alias("x"))
    got = running_total_non_null(df, ["k"], "pos", None, "rn")
    assert sorted(r.rn for r in got.where("pos is null").collect()) == list(range(1, 2001))
    assert got.where("pos is not null and rn != pos + 1").count() == 0
    spread = df.where("pos is null").groupBy(F.pmod(F.xxhash64(*df.columns), F.lit(prefix.NULL_BLOCKS))).count()
    assert spread.agg(F.max("count")).first()[0] < 20
