"""Keyed upsert and append with offsets, table form (K3, K4).

A parquet table has no ``MERGE``; the upsert is a union of the current table
with the new rows, reduced per key by ``max_by`` over a total order.  The
order is deterministic where the reference is arbitrary: a later batch beats
an earlier one; within a batch the greatest (offset, topic, partition) wins.
``max_by`` has a partial aggregate, so a hot key is combined map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamledger.functions.text import fail_unless, parse_pair, typed_pair

ORDER = ["batch_id", "offset", "topic", "partition"]


def parsed_pairs(messages: DataFrame, strict: bool, keep=("topic", "partition", "offset")) -> DataFrame:
    """P6/P7 over ``value``: keeps the coordinates, adds ok / name / id."""
    return messages.select(*keep, parse_pair("value", strict).alias("p")).select(
        *keep, "p.ok", "p.name", "p.id")


def upsert_rows(messages: DataFrame, batch_id_col: str | None = "batch_id", mode: str = "fail") -> DataFrame:
    """Strictly parsed ``name,order_id`` rows with their upsert order key.

    ``fail``: a message that is no pair fails the task, as the reference's
    pattern match does.  ``quarantine``: it is kept without a key or name, with
    its text in ``raw`` (null in all other rows; an absent text is empty).
    """
    keep = ["topic", "partition", "offset"] + ([batch_id_col] if batch_id_col else [])
    p = parsed_pairs(messages, True, [*keep, "value"])
    order = F.struct(*[F.col(c) if c in keep else F.lit(None) for c in ORDER]).alias("ord")
    if mode == "fail":
        p = p.where(fail_unless(F.col("ok"), "malformed name,order_id message"))
        return p.select(F.col("id").alias("order_id"), "name", order)
    if mode == "quarantine":
        raw = F.when(~F.col("ok"), F.coalesce("value", F.lit("")))
        return p.select(F.col("id").alias("order_id"), "name", order, raw.alias("raw"))
    raise ValueError(f"unknown mode {mode!r}")


def upsert(current: DataFrame | None, rows: DataFrame) -> DataFrame:
    """K3: new table = last ``name`` per ``order_id`` over current + rows.

    ``current`` has (order_id, name, ord); rows come from ``upsert_rows``.
    """
    both = rows if current is None else current.unionByName(rows)
    return both.groupBy("order_id").agg(
        F.max_by("name", "ord").alias("name"), F.max("ord").alias("ord"))


def append_rows(messages: DataFrame, mode: str = "fail") -> DataFrame:
    """K4 rows: leniently parsed ``name,id`` (P7) with the log coordinates,
    so committed offsets can be derived from committed rows.

    ``fail``: a message with fewer than two fields, or an id that is no whole
    number of 64 bits, fails the task, as a strict database refuses it in the
    reference.  ``quarantine``: it is kept with ``ok = false``, null fields and
    its text in ``raw``, so every consumed offset still has a row.
    """
    p = messages.select("topic", "partition", "offset", "value", typed_pair("value").alias("p")).select(
        "topic", "partition", "offset", F.col("value").alias("raw"), "p.ok", "p.name", "p.id")
    cols = ["name", "id", "topic", "partition", "offset"]
    if mode == "fail":
        return p.where(fail_unless(F.col("ok"), "malformed name,id message")).select(*cols)
    if mode == "quarantine":
        return p.select(*cols, "ok", F.when(~F.col("ok"), F.col("raw")).alias("raw"))
    raise ValueError(f"unknown mode {mode!r}")


def offsets_from_rows(rows: DataFrame, group_id: str) -> DataFrame:
    """Offsets implied by committed K4 rows: ``max(offset) + 1`` per partition."""
    return rows.groupBy("topic", "partition").agg(
        (F.max("offset") + 1).alias("offset")).select(
        F.lit(group_id).alias("group_id"), "topic", "partition", "offset")
