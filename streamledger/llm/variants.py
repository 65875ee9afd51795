"""Spelling variants: words one edit apart, found by PartEnum signatures.

Words are runs of letters, counted over the whole corpus.  Two words are near
if one inserted, deleted or replaced code point makes one the other; a word's
form is its most frequent near word, if that is at least ``factor`` times as
frequent, and its root is the last word that forms lead to.

How near words are found, without comparing all pairs:

1. A word's letters are a multiset, written as a set of dimensions (letter,
   how often it has come before), so a binary vector.  A replaced letter changes
   two dimensions, or none; an inserted or deleted one changes one.
2. The dimensions are partitioned by a hash.  Vectors of words of one length
   that differ in at most two dimensions agree on all of ``parts`` parts but two
   at most: a word has a signature for every way to leave two parts out.  Words
   whose lengths differ by one differ in a single dimension: they agree on all
   of ``next_parts`` parts but one at most.
3. Signatures are equi-joined.  A bucket of more than ``crowd`` words is split
   further, exactly: one edit leaves either the words' first halves or their
   last halves alike, so its words meet by half.
4. Pairs that meet are verified by their edit distance, inside the join.

Definitions: null text has no words; a null ``doc_id`` is written as nothing
where ids are mixed into the hash of a run; repeated rows count each time;
other columns are ignored; an empty table has no words.  Nothing is dropped or
capped.  Counting and signing run in Arrow tasks on a batch at a time, all else
in DataFrame operations.
"""

from __future__ import annotations

import zlib
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, small_batches, utf8

PARTS = 5                  # parts of the dimensions for words of one length
NEXT_PARTS = 3             # the same for words whose lengths differ by one
CROWD = 32                 # words of a bucket that meet without their halves
BLOCK_BYTES = 1 << 24      # text that a task counts at a time
_LONG = 48                 # bytes of a run whose checksum is not taken side by side

# A run's UTF-8 bytes once A-Z are lower-cased: a-z, the byte C3 and the byte
# behind it (U+00C0 to U+00FF are C3 80 to C3 BF).
_LEAD = 0xC3
_IN_RUN = np.zeros(256, bool)
_IN_RUN[ord("a"):ord("z") + 1] = True
_IN_RUN[_LEAD] = True


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, np.uint32(0xEDB88320) ^ (c >> np.uint32(1)), c >> np.uint32(1))
    return c


_CRC = _crc_table()


def crc32_runs(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """The CRC-32 of every run, going on from the checksum of what comes before."""
    state = seeds ^ np.uint32(0xFFFFFFFF)
    key = (_LONG + 1 - np.minimum(sizes, _LONG + 1)).astype(np.uint8)
    order = np.argsort(key, kind="stable")                   # the longest first
    order = order[np.searchsorted(key[order], 1):]           # without those over the limit
    short, at, left = state[order], starts[order], sizes[order]
    for k in range(int(left[0]) if len(left) else 0):
        n = int(np.searchsorted(-left, -k))           # runs of more than k bytes come first
        c = short[:n]
        short[:n] = _CRC[(c ^ data[at[:n] + k]) & np.uint32(255)] ^ (c >> np.uint32(8))
    state[order] = short
    out = state ^ np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(sizes > _LONG):
        out[i] = zlib.crc32(data[starts[i]:starts[i] + sizes[i]], int(seeds[i]))
    return out


def count_runs(idents: list[str], texts: list[bytes], every: int) -> pa.Table:
    """(word, n) of the runs of some texts."""
    data = np.frombuffer(b" ".join(texts).lower() + b" ", np.uint8)      # lowers A-Z alone
    inside = _IN_RUN[data]
    inside[1:] |= data[:-1] == _LEAD
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside[0]:
        edges = np.concatenate(([0], edges))
    starts, sizes = edges[::2], edges[1::2] - edges[::2]
    ends = np.cumsum([len(t) + 1 for t in texts])
    doc = np.searchsorted(ends, starts, "right")
    seeds = np.array([zlib.crc32(f"{i}:".encode()) for i in idents], np.uint32)
    cut = crc32_runs(data, starts, sizes, seeds[doc])
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
    runs = pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(offsets), pa.py_buffer(data[inside]))
    at = np.flatnonzero(cut % np.uint32(every) == 0)
    changed = []
    for run, h in zip(runs.take(pa.array(at)).to_pylist(), cut[at].tolist()):
        gone = h % len(run)
        changed.append(run[:gone] + run[gone + 1:])
    whole = np.ones(len(sizes), bool)
    whole[at] = False
    counted = pc.value_counts(pa.chunked_array(
        [runs.filter(pa.array(whole)), pa.array(changed, pa.large_string())], pa.large_string()))
    return pa.table({"word": counted.field("values").cast(pa.string()), "n": counted.field("counts")})


def words(docs: DataFrame, every: int = 97) -> DataFrame:
    """(word, n) of all runs.  Where ``every`` divides the CRC-32 h of
    ``<doc_id>:<run>``, the run's code point h mod length is left out."""
    def task(batches):
        idents, texts, size = [], [], 0
        for batch in batches:
            for ident, text in zip(batch.column("id").to_pylist(), batch.column("text")):
                idents.append(ident)
                texts.append(text.as_py() or b"")
                size += len(texts[-1])
                if size > BLOCK_BYTES:
                    yield from count_runs(idents, texts, every).to_batches()
                    idents, texts, size = [], [], 0
        if texts:
            yield from count_runs(idents, texts, every).to_batches()

    ident = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return small_batches(docs).select(ident.alias("id"), utf8("text").alias("text")) \
        .mapInArrow(task, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _parts(letters: np.ndarray, parts: int) -> list[np.ndarray]:
    """For words of one length (a row of code points each): a hash of the
    word's dimensions in each part, blind to their order."""
    letters = np.sort(letters, axis=1)
    at = np.broadcast_to(np.arange(letters.shape[1]), letters.shape)
    new = np.ones(letters.shape, bool)
    new[:, 1:] = letters[:, 1:] != letters[:, :-1]
    before = at - np.maximum.accumulate(np.where(new, at, 0), axis=1)
    dims = _mixed(letters.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + before.astype(np.uint64))
    part = dims % np.uint64(parts)
    spread = _mixed(dims + np.uint64(0xD6E8FEB86659FD93))
    return [np.where(part == np.uint64(p), spread, np.uint64(0)).sum(axis=1, dtype=np.uint64) for p in range(parts)]


def _signed(kept: list[np.ndarray], tag: str) -> np.ndarray:
    h = np.full(len(kept[0]), zlib.crc32(tag.encode()), np.uint64)
    for k in kept:
        h = _mixed(h * np.uint64(0x9E3779B97F4A7C15) + k)
    return h.view(np.int64)


def word_signatures(words_: list[str], size: int, parts: int, next_parts: int):
    """(signature of every word, side) in turn, for words of one length."""
    letters = np.array(words_, dtype=f"U{size}").view(np.uint32).reshape(-1, size)
    same = _parts(letters, parts)
    for out in combinations(range(parts), 2):
        yield _signed([k for p, k in enumerate(same) if p not in out], f"{size} {out}"), 0
    near = _parts(letters, next_parts)
    for out in range(next_parts):
        kept = [k for p, k in enumerate(near) if p != out]
        yield _signed(kept, f"{size}+1 {out}"), 1
        yield _signed(kept, f"{size - 1}+1 {out}"), 2


def signatures(words_: DataFrame, parts: int = PARTS, next_parts: int = NEXT_PARTS) -> DataFrame:
    """(sig, word, side): a row for each signature of a word.

    ``side`` 0: meets words of its length; 1: meets words one longer, as the
    shorter; 2: the same as the longer.
    """
    def task(batches):
        for batch in batches:
            col = batch.column("word")
            sizes = pc.utf8_length(col).to_numpy(zero_copy_only=False)
            for size in np.unique(sizes).tolist():
                group = col.filter(pa.array(sizes == size))
                for sig, side in word_signatures(group.to_pylist(), size, parts, next_parts):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(sig), group, pa.array(np.full(len(sig), side, np.int32))], ["sig", "word", "side"])

    return words_.select("word").mapInArrow(task, "sig long, word string, side int")


def _halves(rows: DataFrame) -> DataFrame:
    """Signatures of crowded buckets, mixed with one half of the word: one edit
    leaves the first halves alike, or the last."""
    longer = F.when(F.col("side") == 2, 1).otherwise(0)
    half = F.floor((F.char_length("word") - longer) / 2).cast("int")
    first = F.substring(F.col("word"), F.lit(1), half)
    last = F.substring(F.col("word"), half + longer + 1, F.char_length("word"))
    return rows.select(F.explode(F.array(F.xxhash64("sig", F.lit(1), first), F.xxhash64("sig", F.lit(2), last)))
                       .alias("sig"), "word", "side")


def near_pairs(words_: DataFrame, parts: int = PARTS, next_parts: int = NEXT_PARTS, crowd: int = CROWD) -> DataFrame:
    """(a, b): every pair of words one edit apart, once.

    ``words_`` has each ``word`` once, none of them empty.
    """
    rows = materialize(signatures(words_, parts, next_parts), "variants-signatures")
    crowded = rows.groupBy("sig").agg(F.count("*").alias("held")).where(F.col("held") > crowd)
    crowded = materialize(crowded.select("sig"), "variants-crowded")
    met = rows.join(crowded, "sig", "left_anti").unionByName(_halves(rows.join(crowded, "sig", "left_semi")))
    a = met.select("sig", F.col("word").alias("a"), F.col("side").alias("sa"))
    b = met.select("sig", F.col("word").alias("b"), F.col("side").alias("sb"))
    # Sides 0 and 0, or 1 and 2; of two words of one length the smaller is a.
    sides = (F.col("sa") + 10 * F.col("sb")).isin(0, 21) & ((F.col("sa") + F.col("sb") > 0) | (F.col("a") < F.col("b")))
    return a.join(b, "sig").where(sides & (F.levenshtein(F.col("a"), F.col("b"), 1) == 1)).select("a", "b").distinct()


def forms(words_: DataFrame, pairs: DataFrame, factor: int = 2) -> DataFrame:
    """(word, n, n_near, form, form_n) of every word."""
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("other"))).join(
        words_.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other")
    # The largest count first, then the smallest word in code-point order.
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(
        F.struct((-F.col("other_n")).alias("minus"), F.col("other").alias("other"))).alias("best"))
    joined = words_.join(best, "word", "left")
    top = -F.col("best.minus")
    taken = top >= F.lit(factor) * F.col("n")
    return joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                         F.when(taken, F.col("best.other")).alias("form"), F.when(taken, top).alias("form_n"))


def roots(formed: DataFrame) -> DataFrame:
    """(word, root) of every word with a form: forms followed to the last.

    Each round doubles the steps that a word has gone; counts double with every
    form, so the rounds grow with the logarithm of the logarithm of the counts.
    """
    steps = formed.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = materialize(steps.join(ahead, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")),
            "variants-roots")
        steps = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return steps


def variants(docs: DataFrame, least: int = 5, seen: int = 3, factor: int = 2, every: int = 97,
             parts: int = PARTS, next_parts: int = NEXT_PARTS, crowd: int = CROWD) -> DataFrame:
    """One row per word of ``least`` code points that occurs ``seen`` times:
    word, form, root, n, n_near, form_n."""
    kept = words(docs, every).where((F.char_length("word") >= least) & (F.col("n") >= seen))
    kept = materialize(kept, "variants-words")
    formed = materialize(forms(kept, near_pairs(kept, parts, next_parts, crowd), factor), "variants-forms")
    return formed.join(roots(formed), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
