"""Token counts of documents from flat token files, by a separator scan.

A token file is a bare array of little-endian token ids, documents end to end,
each closed by an end-of-document id; no index tells where documents begin.
``scan`` cuts every file into blocks, finds the separators of a block with one
vectorised comparison, and stitches documents that run across blocks by a prefix
scan over the blocks: the separators before a block number its documents, the
last separator before it is where its first document began.

``write`` makes such files from texts with a byte-pair vocabulary (a file of
ranks whose path is a parameter), and reports which documents each file holds,
in order.

Definitions: a null or empty text is a document of no tokens; what follows a
file's last separator is a document without an end, listed if it has tokens;
rows that share an id are separate documents.  Extra columns are ignored.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_dir
from .common import materialize, small_batches
from .files import own_name, random_reader, writer

FILE_TOKENS = 16 << 20
FILE_DOCUMENTS = 1 << 18    # a file is also closed by these: its ids are one row
BLOCK_TOKENS = 1 << 20
_PIECE = 1 << 18            # characters encoded at a time

# Fixed value: the split pattern that belongs to the vocabulary file.
PATTERN = (r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def encoder(path: str):
    """A byte-pair encoding from a file of base64 tokens and ranks."""
    import tiktoken
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}
    return tiktoken.Encoding("pairs", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def _encode(pairs, text: str):
    """Token ids of a text, piece by piece.  A piece ends before a blank that
    follows a letter, where the pattern always splits."""
    at = 0
    while at < len(text):
        end = min(at + _PIECE, len(text))
        while end < len(text) and not (text[end] == " " and text[end - 1].isalpha()):
            end += 1
        yield pairs.encode_ordinary(text[at:end])
        at = end


def _check_ids(pairs, separator: int, dtype: str) -> None:
    ids = set(pairs._mergeable_ranks.values())
    if separator in ids:
        raise ValueError(f"the separator {separator} is a token of the vocabulary")
    if not 0 <= max(separator, *ids) <= np.iinfo(dtype).max:
        raise ValueError(f"{dtype} does not hold all ids")


def write(docs: DataFrame, folder: str, vocabulary: str, separator: int, dtype: str = "<u2",
          file_tokens: int = FILE_TOKENS, file_documents: int = FILE_DOCUMENTS) -> DataFrame:
    """Token files of ``docs`` (doc_id, text) under ``folder``; returns their
    (path, tokens, doc_ids).  A separator that is a token of the vocabulary, or
    ids that ``dtype`` does not hold, are errors."""
    def task(batches):
        pairs, count, state = None, 0, None

        def close():
            path, _, context, n, ids = state
            context.__exit__(None, None, None)
            return pa.RecordBatch.from_arrays(
                [pa.array([path]), pa.array([n], pa.int64()), pa.array([ids], pa.list_(pa.int64()))],
                ["path", "tokens", "doc_ids"])

        for batch in batches:
            if pairs is None:
                pairs = encoder(vocabulary)
                _check_ids(pairs, separator, dtype)
            for i, text in zip(batch.column("doc_id"), batch.column("text")):
                if state is None:
                    path = own_name(folder, count, ".tokens")
                    context = writer(path)
                    state = [path, context.__enter__(), context, 0, []]
                    count += 1
                for ids in [*_encode(pairs, text.as_py() or ""), [separator]]:
                    state[1].write(np.array(ids, dtype).tobytes())
                    state[3] += len(ids)
                state[4].append(i.as_py())
                if state[3] >= file_tokens or len(state[4]) >= file_documents:
                    yield close()
                    state = None
        if state is not None:
            yield close()

    return small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(task, "path string, tokens long, doc_ids array<long>")


def _separators(separator: int, dtype: str):
    """Places of separators in each block."""
    width = np.dtype(dtype).itemsize

    def task(batches):
        for batch in batches:
            places, current, source = [], None, None
            for path, start, n in zip(*(batch.column(c).to_pylist() for c in ("path", "start", "n"))):
                if path != current:
                    if source is not None:
                        source.close()
                    current, source = path, random_reader(path)
                tokens = np.frombuffer(source.read_at(n * width, start * width), dtype)
                places.append(np.flatnonzero(tokens == separator) + start)
            if source is not None:
                source.close()
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("path", "block", "start", "n")), pa.array(places, pa.list_(pa.int64()))],
                ["path", "block", "start", "n", "places"])
    return task


def scan(files: DataFrame, separator: int, dtype: str = "<u2", block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(path, ordinal, start, n_tokens) of every document in token files
    ``files`` (path, tokens)."""
    blocks = files.where("tokens > 0").select("path", "tokens", F.explode(F.sequence(
        F.lit(0).cast("long"), F.expr(f"(tokens - 1) div {block_tokens}"))).alias("block")) \
        .select("path", "block", (F.col("block") * block_tokens).alias("start"), "tokens") \
        .select("path", "block", "start", F.least(F.lit(block_tokens), F.col("tokens") - F.col("start")).alias("n"))
    found = blocks.mapInArrow(_separators(separator, dtype),
                              "path string, block long, start long, n long, places array<long>")
    # Prefix scan: one row a block.
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    final = Window.partitionBy("path").orderBy(F.desc("block"))
    stitched = found.withColumn("held", F.size("places")) \
        .withColumn("ahead", F.coalesce(F.sum("held").over(before), F.lit(0))) \
        .withColumn("last", F.coalesce(F.max(F.try_element_at("places", F.lit(-1))).over(before), F.lit(-1))) \
        .withColumn("final", F.row_number().over(final) == 1)
    end = F.col("start") + F.col("n")
    tail = F.coalesce(F.try_element_at("places", F.lit(-1)), F.col("last"))
    # After the last block the file's end closes a document that has tokens.
    closes = F.when(F.col("final") & (tail < end - 1), F.concat("places", F.array(end))).otherwise(F.col("places"))
    opens = F.concat(F.array("last"), F.col("places"))
    return stitched.select("path", "ahead", F.posexplode(F.zip_with(
        closes, F.slice(opens, F.lit(1), F.size(closes)), lambda c, o: F.struct(o.alias("open"), c.alias("close")))).alias("k", "doc")) \
        .select("path", (F.col("ahead") + F.col("k")).alias("ordinal"), (F.col("doc.open") + 1).alias("start"),
                (F.col("doc.close") - F.col("doc.open") - 1).alias("n_tokens"))


def count_tokens(docs: DataFrame, vocabulary: str, separator: int, dtype: str = "<u2",
                 folder: str | None = None) -> DataFrame:
    """doc_id and n_tokens of every document, by way of token files."""
    folder = folder or scratch_dir(docs.sparkSession, "tokens")
    files = materialize(write(docs, folder, vocabulary, separator, dtype), "tokens-files")
    held = files.select("path", F.posexplode("doc_ids").alias("ordinal", "doc_id"))
    return held.join(scan(files, separator, dtype), ["path", "ordinal"]).select("doc_id", "n_tokens", "path", "start")
