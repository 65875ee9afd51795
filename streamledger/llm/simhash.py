"""SimHash near-duplicates: fingerprints, linking within a few bits, components.

A text's shingles are hashed by XXH64; a fingerprint bit is 1 if it is set in
over half of the hashes.  Fingerprints that differ in ``max_bits`` bits or
fewer are linked, and a document's component is all that its links reach.

Linking embeds a fingerprint as the vector of the bit counts of its 16
four-bit segments.  Flipping one bit moves that vector by one step, so the
Manhattan distance of two vectors never exceeds the bit distance of their
fingerprints.  The join runs on the grid of these vectors: each side names the
grid points within half the distance, pairs within ``max_bits`` steps share
such a point, and pairs that meet are verified by their differing bits.
Documents with equal fingerprints are one node, however many there are.

Definitions: null text has no words; a text without words has fingerprint 0,
linked like any other; a null ``doc_id`` is never a component's id, and a
component of rows without ids has the id null.  Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, numbered, small_batches, utf8
from .components import components

SEED = 42
_CHUNK = 1 << 17       # shingles counted at a time
_SEGMENTS = 16


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """The 64-bit fingerprint of one UTF-8 text."""
    words = text.lower().split()        # bytes: lowers A-Z, splits at ASCII white space
    if not words:
        return 0
    joined = b" ".join(words)
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = np.concatenate(([0], gaps + 1))
    ends = np.append(gaps, len(joined))
    size = min(shingle, len(words))
    starts, ends = starts[:len(words) - size + 1].tolist(), ends[size - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for lo in range(0, len(starts), _CHUNK):
        h = np.array([digest(joined[a:b], SEED) for a, b in
                      zip(starts[lo:lo + _CHUNK], ends[lo:lo + _CHUNK])], "<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """doc_id and fingerprint (as a signed long) of every row."""
    def task(batches):
        for batch in batches:
            prints = np.array([fingerprint(t.as_py() or b"", shingle)
                               for t in batch.column("text")], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(prints.view(np.int64))], ["doc_id", "fp"])

    return small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), utf8("text").alias("text")) \
        .mapInArrow(task, "doc_id long, fp long")


def _segment_counts(fp: Column) -> Column:
    """Bit counts of the 16 four-bit segments, packed four bits each."""
    def half(x: Column) -> Column:
        pairs = x.bitwiseAND(F.lit(0x55555555)) + F.shiftrightunsigned(x, 1).bitwiseAND(F.lit(0x55555555))
        return pairs.bitwiseAND(F.lit(0x33333333)) + F.shiftrightunsigned(pairs, 2).bitwiseAND(F.lit(0x33333333))
    low = half(fp.bitwiseAND(F.lit(0xFFFFFFFF)))
    high = half(F.shiftrightunsigned(fp, 32))
    return F.shiftleft(high, 32).bitwiseOR(low)


def _manhattan(a: Column, b: Column) -> Column:
    total = F.lit(0).cast("long")
    for k in range(0, 4 * _SEGMENTS, 4):
        total = total + F.abs(F.shiftrightunsigned(a, k).bitwiseAND(F.lit(15).cast("long"))
                              - F.shiftrightunsigned(b, k).bitwiseAND(F.lit(15).cast("long")))
    return total


def _grid_points(nodes: DataFrame, radius: int) -> DataFrame:
    """fp, vector, and every grid point within ``radius`` steps with its steps."""
    out = nodes.select("fp", "vector", F.col("vector").alias("point"), F.lit(0).alias("steps"))
    moves = F.expr(
        "array_compact(transform(sequence(0, 15), k -> "
        "if((shiftrightunsigned(point, 4 * k) & 15L) < 4L, point + shiftleft(1L, 4 * k), null)) || "
        "transform(sequence(0, 15), k -> "
        "if((shiftrightunsigned(point, 4 * k) & 15L) > 0L, point - shiftleft(1L, 4 * k), null)))")
    for r in range(1, radius + 1):
        last = out.where(F.col("steps") == r - 1) if r > 1 else out
        nearer = last.select("fp", "vector", F.explode(moves).alias("point"), F.lit(r).alias("steps"))
        out = out.union(nearer)
        if r > 1:       # a point may be reached on several ways
            out = out.groupBy("fp", "vector", "point").agg(F.min("steps").alias("steps"))
    return out


def links(prints: DataFrame, max_bits: int = 2) -> DataFrame:
    """Pairs (a, b) of different fingerprints within ``max_bits`` bits, a < b.

    ``prints`` has one row per distinct ``fp``.
    """
    nodes = prints.select("fp", _segment_counts(F.col("fp")).alias("vector"))
    near, far = _grid_points(nodes, max_bits // 2), _grid_points(nodes, max_bits - max_bits // 2)
    a = near.select(F.col("fp").alias("a"), F.col("vector").alias("va"), "point", F.col("steps").alias("sa"))
    b = far.select(F.col("fp").alias("b"), F.col("vector").alias("vb"), "point", F.col("steps").alias("sb"))
    order = F.col("a") < F.col("b") if max_bits % 2 == 0 else F.col("a") != F.col("b")
    # They meet on a shortest way, at the Manhattan distance of their vectors.
    met = a.join(b, "point").where(
        order & (F.col("sa") + F.col("sb") == _manhattan(F.col("va"), F.col("vb"))))
    near_pairs = met.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
    return near_pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id."""
    prints = materialize(fingerprints(docs, shingle), "simhash-prints")
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    label = components(links(nodes.select("fp"), max_bits))
    rooted = nodes.join(label.withColumnRenamed("node", "fp"), "fp", "left") \
        .select("fp", "first", F.coalesce("root", "fp").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    by_print = rooted.join(ids, "root").select("fp", "component_id")
    return prints.join(by_print, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """``docs``, all columns, with one row of each component: the smallest id
    (rows without one come last), among equal ids the smallest text.  Every row
    is a document of its own, also without an id or with another row's."""
    rows, row = numbered(docs, "simhash-rows")
    groups = near_duplicates(rows.select(F.col(row).alias("doc_id"), "text"), shingle, max_bits) \
        .select(F.col("doc_id").alias("row"), F.col("component_id").alias("group"))
    place = F.struct(F.col("doc_id").isNull().alias("late"), F.col("doc_id").cast("long").alias("id")).alias("place")
    placed = materialize(groups.join(rows.select(F.col(row).alias("row"), place), "row"), "simhash-places")
    # The smallest id of each group, and how many rows share that.
    first = placed.groupBy("group", "place").agg(F.count("*").alias("rows"), F.min("row").alias("least")) \
        .groupBy("group").agg(F.min(F.struct("place", "rows", "least")).alias("first")).select("group", "first.*")
    tied = placed.join(first.where("rows > 1"), ["group", "place"]).select("row", "group")
    texts = rows.select(F.col(row).alias("row"), F.coalesce("text", F.lit("")).alias("text"))
    by_text = texts.join(tied, "row").groupBy("group").agg(F.min(F.struct("text", "row")).alias("first")).select("first.row")
    kept = first.where("rows = 1").select(F.col("least").alias("row")).union(by_text)
    return rows.join(kept.withColumnRenamed("row", row), row, "left_semi").select(*docs.columns)
