"""Running totals per key without putting a whole key in one task.

A plain ``sum(...) OVER (PARTITION BY key ORDER BY pos)`` sends every row of a
key to one task; if one key holds a third of the data, that task holds a third
of the data.  Here the order axis is cut into blocks of ``block`` positions:

1. per (key, block) totals -- an aggregate with map-side partial combine;
2. exclusive prefix over the block totals per key -- the same step again
   over groups of ``block`` block numbers, and over groups of those, since
   sparse positions make as many blocks as rows;
3. running total inside each (key, block) -- a window over at most ``block``
   rows when ``pos`` is unique within the key;
4. add 2 to 3 with an equi-join on (key, block).  The big side is already
   hash-partitioned on (key, block) by step 3's exchange, so only the small
   block table is shuffled for the join; AQE may broadcast it when its
   measured size is under the threshold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BLOCK = 1 << 20
NULL_BLOCKS = 1 << 12
# Block totals that one window sums, where blocks are smaller than that.
FAN = 1 << 12
# Positions lie within this; blocks of 2**20 are grouped to 2**40 and 2**60.
SPAN = 1 << 63


def running_total(df: DataFrame, keys: Sequence[str], pos: str, value: str | None,
                  out: str, block: int = DEFAULT_BLOCK, span: int = SPAN) -> DataFrame:
    """Add ``out`` = inclusive running sum of ``value`` per ``keys`` by ``pos``.

    ``pos`` must be integral and unique within each key (ties would make the
    result depend on row order, as in any ``ROWS`` frame); null positions come
    first, as in Spark's ascending order.  ``value=None`` counts rows, i.e.
    ``out`` is the 1-based ``row_number``.

    Rows whose keys are all non-null go through windows partitioned by the
    key columns themselves, so Catalyst still pushes key predicates (e.g. a
    topic list) below the windows into the scan.  Rows with a null key take a
    second, null-safe branch; on parquet its ``IS NULL`` filter is answered
    from column statistics, so it costs almost nothing when there are none.
    """
    keys = list(keys)
    if not keys:
        raise ValueError("running_total needs at least one key")
    all_set = F.col(keys[0]).isNotNull()
    for k in keys[1:]:
        all_set = all_set & F.col(k).isNotNull()
    main = running_total_non_null(df.where(all_set), keys, pos, value, out, block, span)
    rest = running_total_null_safe(df.where(~all_set), keys, pos, value, out, block, span)
    return main.unionByName(rest)


def running_total_non_null(df: DataFrame, keys: Sequence[str], pos: str,
                           value: str | None, out: str,
                           block: int = DEFAULT_BLOCK, span: int = SPAN) -> DataFrame:
    """``running_total`` for input whose keys are known to be non-null."""
    return _blocked_total(df, list(keys), pos, value, out, block, df.columns, span)


def running_total_null_safe(df: DataFrame, keys: Sequence[str], pos: str,
                            value: str | None, out: str,
                            block: int = DEFAULT_BLOCK, span: int = SPAN) -> DataFrame:
    """``running_total`` where keys may be null: (value-or-default, is-null)
    stand-ins make null keys group and join like any other value."""
    return _null_safe_total(df, list(keys), pos, value, out, block, span)


def _null_safe_total(df, keys, pos, value, out, block, span):
    types = dict(df.dtypes)
    hidden, exprs = [], []
    for i, k in enumerate(keys):
        default = F.lit("") if types[k] == "string" else F.lit(0).cast(types[k])
        hidden += [f"__kv{i}", f"__kn{i}"]
        exprs += [F.coalesce(F.col(k), default).alias(f"__kv{i}"),
                  F.col(k).isNull().alias(f"__kn{i}")]
    return _blocked_total(df.select("*", *exprs), hidden, pos, value, out, block,
                          df.columns, span)


def _blocked_total(df, part_keys, pos, value, out, block, cols, span):
    blk = "__blk"
    # a null value adds nothing (SQL would give null while the prefix is all
    # null; every caller here sums non-null counts)
    val = (F.lit(1).cast("bigint") if value is None
           else F.coalesce(F.col(value).cast("bigint"), F.lit(0).cast("bigint")))
    # null positions come first, in any order: many blocks of their own
    spread = F.lit(-(1 << 62)) + F.pmod(F.xxhash64(*df.columns), F.lit(NULL_BLOCKS))
    blk_expr = F.coalesce(F.expr(f"`{pos}` div {int(block)}"), spread)
    staged = df.select("*", blk_expr.alias(blk), val.alias("__val"))

    totals = staged.groupBy(*part_keys, blk).agg(F.sum("__val").alias("__tot"))
    base = _exclusive_prefix(totals, part_keys, blk, int(block), max(int(block), FAN), span)

    upto = Window.partitionBy(*part_keys, blk).orderBy(pos).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    local = staged.withColumn("__local", F.sum("__val").over(upto))

    joined = local.join(base, [*part_keys, blk], "inner")
    return joined.select(*cols, (F.col("__base") + F.col("__local")).alias(out))


def _exclusive_prefix(totals, part_keys, blk, width, fan, span):
    """Sum of the totals of all earlier blocks of a key, as ``__base``.

    Block numbers may be as sparse as positions, so the step is applied again
    to the blocks: groups of ``fan`` block numbers, each summed up by itself,
    until one group spans all numbers there can be, at as many levels as that
    takes.  No window holds more than ``fan`` rows, however the positions lie.
    """
    before = lambda *by: Window.partitionBy(*part_keys, *by).orderBy(blk).rowsBetween(
        Window.unboundedPreceding, -1)
    if width * fan >= span:
        return totals.select(*part_keys, blk, F.coalesce(F.sum("__tot").over(before()), F.lit(0)).alias("__base"))
    up = f"{blk}_up"
    grouped = totals.withColumn(up, F.expr(f"`{blk}` div {fan}"))
    above = grouped.groupBy(*part_keys, up).agg(F.sum("__tot").alias("__tot"))
    base = _exclusive_prefix(above, part_keys, up, width * fan, fan, span).withColumnRenamed("__base", "__far")
    near = grouped.withColumn("__near", F.coalesce(F.sum("__tot").over(before(up)), F.lit(0)))
    return near.join(base, [*part_keys, up], "inner").select(
        *part_keys, blk, (F.col("__far") + F.col("__near")).alias("__base"))
