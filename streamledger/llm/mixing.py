"""Mixing sources to target weights by entropy balancing, in DataFrame operations.

Every source gets a number of words (its target).  Among all ways to repeat or
thin out a source's documents so that their words add up to the target, with
rates between 0 and ``most`` copies, the one of greatest entropy gives document
d the rate min(most, exp(l * size_d / mean size)).  The multiplier l of each
source is the dual's solution; ``balance`` finds it by Newton steps, kept
inside a bracket, one distributed aggregate a step over the counts of equal
(source, size).

Rates become whole copies by systematic rounding along the sizes, longest
documents first, so that what one document rounds away the next ones make up
for; the words still missing or left over in a source (about its longest
document's at most) change the last copy of up to three documents, which is then
a part of one.

Definitions: null text has no words; a null source is a source, ordered last;
sources order by code point.  Rows that share an id are separate documents.
A source without words has the target 0.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

WEIGHTS = (5, 2, 1)
_SPACE = " \t\n\x0b\x0c\r"
_UNIT = 1_000_000           # rates are rounded to this part of a copy
_BLOCK_ROWS = 100_000
_STEPS = 60
_FIXES = 3
_SALTS = 64


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text; 0 for null."""
    trimmed = F.btrim(text.cast("string"), F.lit(_SPACE))
    return F.when(trimmed.isNull() | (trimmed == ""), F.lit(0)) \
        .otherwise(F.size(F.split(trimmed, "[\\x20\\x09-\\x0D]+"))).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5,
                   most: int = 2) -> DataFrame:
    """sid, source, source_size, scale (mean size), target of every source.

    Weights repeat along the sources in order; together they share ``share``
    of all words by weight, and what a source's limit of ``most`` times its
    words cuts off goes to the others by weight.  One row per source from the
    first aggregate on.
    """
    per = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"),
        F.coalesce(F.avg(F.when(F.col("size") > 0, F.col("size"))), F.lit(1.0)).alias("scale"))
    every = Window.orderBy(F.col("source").asc_nulls_last())
    per = per.withColumn("sid", F.row_number().over(every)).withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.col("sid") - 1, F.lit(len(weights))) + 1))
    # Fill by rising limit per weight: once a source stays under its limit,
    # all after it do, and the level there is everyone's.
    limit = F.lit(float(most)) * F.col("source_size")
    by = Window.orderBy(limit / F.col("weight"), "sid")
    before, all_rows = by.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    left = F.lit(share) * F.sum("source_size").over(all_rows) - F.coalesce(F.sum(limit).over(before), F.lit(0.0))
    shared = F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    per = per.withColumn("level", left / shared).withColumn("place", F.row_number().over(by))
    fits = F.when(F.col("level") <= limit / F.col("weight"), F.struct("place", "level"))
    per = per.withColumn("level", F.min(fits).over(all_rows)["level"])
    return per.select("sid", "source", "source_size", "scale",
                      F.coalesce(F.least(limit, F.col("weight") * F.col("level")), limit).alias("target"))


def balance(counts: DataFrame, sources: DataFrame, most: int = 2) -> DataFrame:
    """sid and ``multiplier``: the dual solution of every source.

    ``counts`` has sid, size, n.  The dual's gradient is the words at the
    current multiplier less the target.  Its logarithm is used for the Newton
    step, which sums of exponentials follow closely; a step that leaves the
    bracket halves it instead.
    """
    if sources.isEmpty():
        return sources.select("sid", F.lit(0.0).alias("multiplier"))
    wide = F.greatest(F.col("source_size"), F.lit(1))
    tight = F.greatest(F.col("target"), F.lit(1e-9)) / wide
    # With every size at least 1: at lo no word too many, at hi all at ``most``.
    high = F.log(F.lit(float(most))) * F.col("scale")
    full = F.col("target") >= F.lit(most * (1 - 1e-12)) * F.col("source_size")
    state = sources.where("target > 0 and source_size > 0").select(
        "sid", "target", "scale", F.least(F.log(tight) * F.col("scale"), F.lit(0.0)).alias("lo"),
        high.alias("hi"), F.when(full, high).otherwise(0.0).alias("multiplier"), full.alias("done"))
    state = materialize(state, "mixing-state")
    used = counts.where("size > 0")
    for _ in range(_STEPS):
        x = F.col("size") / F.col("scale")
        rate = F.least(F.lit(float(most)), F.exp(F.col("multiplier") * x))
        mass = F.col("n") * F.col("size") * rate
        seen = used.join(state, "sid").groupBy("sid").agg(
            F.sum(mass).alias("words"), F.sum(F.when(rate < most, mass * x).otherwise(0.0)).alias("slope"))
        at = state.join(seen, "sid")
        miss = F.log(F.col("words") / F.col("target"))
        lo = F.when(miss < 0, F.col("multiplier")).otherwise(F.col("lo"))
        hi = F.when(miss > 0, F.col("multiplier")).otherwise(F.col("hi"))
        newton = F.col("multiplier") - miss * F.col("words") / F.when(F.col("slope") > 0, F.col("slope"))
        done = F.col("done") | (F.abs(miss) < 1e-9) | (F.col("hi") - F.col("lo") < 1e-12)
        at = at.select("sid", "target", "scale", "multiplier", lo.alias("lo"), hi.alias("hi"),
                       newton.alias("newton"), done.alias("done"))
        inside = (F.col("newton") > F.col("lo")) & (F.col("newton") < F.col("hi"))
        step = F.when(inside, F.col("newton")).otherwise((F.col("lo") + F.col("hi")) / 2)
        state = materialize(at.select(
            "sid", "target", "scale", "lo", "hi",
            F.when(F.col("done"), F.col("multiplier")).otherwise(step).alias("multiplier"), "done"), "mixing-state")
        if state.where("not done").isEmpty():
            return state.select("sid", "multiplier")
    raise ArithmeticError(f"multipliers not found in {_STEPS} steps")


def _block(blocks: int) -> Column:
    """The block that a document is numbered in.  Rows without an id are alike
    but for their size: they come last, spread over as many blocks again."""
    without = F.lit(blocks) + F.pmod(F.xxhash64("row"), F.lit(blocks))
    return F.when(F.col("doc_id").isNull(), without).otherwise(F.pmod(F.xxhash64("doc_id"), F.lit(blocks)))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: int = 2) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, and the
    rate and whole or begun copies that ``taken`` comes from."""
    sizes = materialize(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        word_count(F.col("text")).alias("size"), F.monotonically_increasing_id().alias("row")), "mixing-sizes")
    sources = materialize(source_targets(sizes, weights, share, most), "mixing-sources")
    named = sources.select(F.col("source").alias("name"), "sid")
    keyed = sizes.join(named, F.col("source").eqNullSafe(F.col("name"))).select("doc_id", "size", "row", "sid")
    counts = materialize(keyed.groupBy("sid", "size").agg(F.count("*").alias("n")), "mixing-counts")
    solved = balance(counts, sources, most)

    # Rate of every (source, size), and where its run of documents begins on
    # the source's line of words, in copies of this size.
    rate = F.round(F.least(F.lit(float(most)), F.exp(F.coalesce("multiplier", F.lit(0.0)) * F.col("size") / F.col("scale")))
                   * _UNIT).cast("long")
    line = Window.partitionBy("sid").orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, -1)
    whole = "decimal(38,0)"
    classes = counts.where("size > 0").join(sources, "sid").join(solved, "sid", "left") \
        .select("sid", "size", "n", rate.alias("unit_rate")) \
        .withColumn("words", (F.col("n").cast("decimal(19,0)") * (F.col("size") * F.col("unit_rate")).cast("decimal(19,0)")).cast(whole)) \
        .withColumn("begin", F.coalesce(F.sum("words").over(line), F.lit(0)).cast(whole)) \
        .withColumn("phase", (F.col("begin") % (F.col("size") * _UNIT).cast(whole)).cast("long")) \
        .select("sid", "size", "unit_rate", F.expr("phase div size").alias("phase"))

    # A document's number within its (source, size), which may hold any share
    # of the rows: blocks by id, each numbered by itself.
    blocks = max(1, -(-sizes.count() // _BLOCK_ROWS))
    placed = keyed.withColumn("block", _block(blocks))
    ahead = Window.partitionBy("sid", "size").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("sid", "size", "block").agg(F.count("*").alias("n")) \
        .withColumn("ahead", F.coalesce(F.sum("n").over(ahead), F.lit(0))).drop("n")
    within = Window.partitionBy("sid", "size", "block").orderBy(F.xxhash64("doc_id"), "doc_id", "row")
    numbered = placed.withColumn("at", F.row_number().over(within)) \
        .join(offsets, ["sid", "size", "block"]).withColumn("at", F.col("at") + F.col("ahead"))
    copies = F.expr(f"(phase + at * unit_rate + {_UNIT // 2}) div {_UNIT}"
                    f" - (phase + (at - 1) * unit_rate + {_UNIT // 2}) div {_UNIT}")
    rounded = materialize(
        numbered.join(classes, ["sid", "size"], "left")
        .select("doc_id", "size", "row", "sid", (F.coalesce("unit_rate", F.lit(0)) / _UNIT).alias("rate"),
                F.least(F.coalesce(copies, F.lit(0)), F.lit(most)).cast("int").alias("copies")), "mixing-rounded")

    # What rounding missed in a source goes to, or comes off, the documents
    # with most room for it.
    goal = sources.select("sid", "source_size", "target")
    out = rounded.withColumn("taken", F.col("copies") * F.col("size"))
    for _ in range(_FIXES):
        out = materialize(_fix(out, goal, most), "mixing-taken")
    begun = F.when(F.col("size") > 0, F.ceil(F.col("taken") / F.col("size"))).otherwise(0).cast("int")
    return _by_source(out, goal, "inner").select("doc_id", "size", "source_size", "target", "taken", "rate",
                                        begun.alias("copies"))


def _by_source(rows: DataFrame, per_source: DataFrame, how: str) -> DataFrame:
    """Join rows with a table of one row a source.  A source may hold any share
    of the rows, so its row is repeated and the rows are dealt over the copies."""
    copies = per_source.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    dealt = rows.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(_SALTS)).cast("int"))
    return dealt.join(copies, ["sid", "salt"], how).drop("salt")


def _fix(out: DataFrame, goal: DataFrame, most: int) -> DataFrame:
    """``out`` with one document of each source taking the words it misses, or
    giving up those it has too many, as far as that document can."""
    spare = F.lit(most) * F.col("size") - F.col("taken")
    pick = lambda what: F.max(F.struct(what.alias("room"), F.col("doc_id"), F.col("row")))
    miss = F.col("miss")
    change = out.groupBy("sid").agg(
        F.sum("taken").alias("got"), pick(spare).alias("more"), pick(F.col("taken")).alias("less")) \
        .join(goal, "sid").withColumn("miss", F.round("target").cast("long") - F.col("got")) \
        .where("miss != 0").select(
            "sid", F.when(miss > 0, F.col("more.row")).otherwise(F.col("less.row")).alias("chosen"),
            F.when(miss > 0, F.least(miss, F.col("more.room")))
            .otherwise(F.greatest(miss, -F.col("less.room"))).alias("change"))
    return _by_source(out, change, "left").withColumn(
        "taken", F.col("taken") + F.when(F.col("row") == F.col("chosen"), F.col("change")).otherwise(0)) \
        .drop("chosen", "change")
