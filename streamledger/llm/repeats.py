"""Removal of repeated passages: seeds on winnowed anchors, extended both ways.

A word goes if some window of ``length`` words that covers it also starts
earlier: in a document with a smaller id, or earlier in the same document.

1. ``_seeds``: the k-grams of ``K`` words are hashed and winnowed: every window
   is named by the leftmost minimum among its k-grams, its anchor.  Equal windows
   have equal anchors, so documents are joined on anchors that occur more than
   once (the seeds); a window whose anchor occurs once can't repeat.
2. ``_shard``: documents are dealt to shards of about ``shard_bytes`` by id and
   text.  The seeds of a shard are extended against each other (``extend``), which
   settles the repeats within the shard.  Windows that are the first of their
   kind in the shard go on, a seed's windows in one row with their words.
3. ``_merge``: rows meet by seed and are extended in the same way across shards.
   The windows of seeds that stand more than ``split`` times go on as rows of
   their own, dealt by their words, so that no group holds a whole hot seed.
4. ``_finish``: matches go back to their shard, where overlapping ones join to
   maximal repeats, and the words that remain are joined and hashed.

``extend`` takes all occurrences of a seed at once: it extends them by a word to
the left, and to the right, and occurrences stay together while their words
agree.  Those that agree on r words to the left and on length - K - r to the right
share a window.  Words are compared themselves, not by hashes.

Definitions: words are ``[^\\x20\\x09-\\x0D]+``, unchanged; null text has none.
A null ``doc_id`` orders after every id; rows of one id order by the XXH64 (seed
42) of their text, as a signed number.  Rows equal in id and text are one row with
a count until the end: one of them is the first, and the others lose all words of
all windows.  A text of fewer than ``length`` words loses nothing.  Other columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import blocks_for, materialize, small_batches, utf8

K = 6                       # words of an anchor
SHARD_BYTES = 2 << 20       # text in a shard
SPLIT = 1 << 14             # windows of seeds that stand more often are dealt one by one
_TILE = 1 << 16
_LETTERS = 1 << 20          # letters hashed at a time
_LONG = 64                  # bytes of a word that are hashed side by side
_COPIES = 1 << 16           # copies of a row made at a time

_SEED = "hash long, n int, shards array<int>"
_PIECE = ("kind int, bucket int, hash long, shard int, doc_no int, late int, doc_id long, tie long, "
          "pos int, head int, mask int, n int, words binary")


# ------------------------------------------------------------------ numpy parts

def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_PLACE = _mixed(np.arange(257, 257 + _LONG, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_STEP = _mixed(np.arange(1000, 1000 + K, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


class Words:
    """The words of some texts laid end to end: ``starts`` and ``sizes`` in
    ``data``, and ``first``, each text's first word (one entry more than texts)."""

    def __init__(self, texts: list[bytes]):
        self.data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        inside = ~_BLANK[self.data]
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        if inside[0]:
            edges = np.concatenate(([0], edges))
        self.starts, self.sizes = edges[::2], edges[1::2] - edges[::2]
        ends = np.cumsum([len(t) + 1 for t in texts])
        self.first = np.concatenate(([0], np.searchsorted(self.starts, ends)))

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self) -> np.ndarray:
        out = np.zeros(len(self), np.uint64)
        letters = np.concatenate(([0], np.cumsum(self.sizes)))
        cuts = np.searchsorted(letters, np.arange(0, letters[-1], _LETTERS))       # arrays of bounded size
        for lo, hi in zip(cuts.tolist(), [*cuts[1:].tolist(), len(self)]):
            if hi > lo:
                begin, sizes = letters[lo:hi] - letters[lo], self.sizes[lo:hi]
                at = np.arange(letters[hi] - letters[lo]) - np.repeat(begin, sizes)
                found = self.data[np.repeat(self.starts[lo:hi], sizes) + at]
                out[lo:hi] = np.add.reduceat(_BYTE[found] * _PLACE[at & (_LONG - 1)], begin)
        out = _mixed(out + self.sizes.astype(np.uint64))
        for i in np.flatnonzero(self.sizes > _LONG):
            out[i] = xxhash.xxh64_intdigest(self.data[self.starts[i]:self.starts[i] + self.sizes[i]])
        return out

    def ids(self) -> np.ndarray:
        """A number for every word: equal words, equal numbers."""
        begin = np.concatenate(([0], np.cumsum(self.sizes))).astype(np.int64)
        flat = self.data[~_BLANK[self.data]]
        column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(self), [None, pa.py_buffer(begin), pa.py_buffer(flat)])
        return column.dictionary_encode().indices.to_numpy(zero_copy_only=False)

    def text(self, lo: int, hi: int) -> bytes:
        """Words lo to hi (exclusive), one blank between them."""
        return b" ".join(self.data[self.starts[lo]:self.starts[hi - 1] + self.sizes[hi - 1]].tobytes().split())


def window_runs(words: Words, length: int):
    """Runs of windows with one anchor: (first window, one past the last, the
    anchor's place, its hash).  A window lies within one text."""
    h, n, width = words.hashes(), len(words), length - K + 1
    fit = np.zeros(n + 1, np.int64)
    lo, hi = words.first[:-1], words.first[1:] - length + 1
    ok = hi > lo
    np.add.at(fit, lo[ok], 1)
    np.add.at(fit, hi[ok], -1)
    fit = np.cumsum(fit)[:n].astype(bool)
    out = []
    for at in range(0, n, _TILE):
        top = min(at + _TILE, n)
        part = h[at:min(top + length - 1, n)]
        if len(part) < length:
            break
        grams = np.zeros(len(part) - K + 1, np.uint64)
        for j in range(K):
            grams += part[j:j + len(grams)] * _STEP[j]
        grams = _mixed(grams)
        v = (grams & np.uint64(0xFFFFFFFFFFF00000)) | np.arange(len(grams), dtype=np.uint64)
        span = 1
        while span < width:
            step = min(span, width - span)
            v = np.minimum(v[:-step], v[step:])
            span += step
        v = v[:top - at]
        place = (v & np.uint64(0xFFFFF)).astype(np.int64)
        good = fit[at:at + len(place)]
        new = np.ones(len(place), bool)
        # Windows of two texts never share an anchor that fits in both.
        new[1:] = (place[1:] != place[:-1]) | (good[1:] != good[:-1])
        edge = np.flatnonzero(new)
        stop = np.append(edge[1:], len(place))
        keep = good[edge]
        out.append((edge[keep] + at, stop[keep] + at, place[edge[keep]] + at, grams[place[edge[keep]]]))
    if not out:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    return tuple(np.concatenate(c) for c in zip(*out))


def _ranked(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A number for every pair: equal pairs, equal numbers."""
    return np.unique(a.astype(np.int64) * (int(b.max()) + 2) + b + 1, return_inverse=True)[1]


def extend(ids: np.ndarray, seed: np.ndarray, at: np.ndarray, mask: np.ndarray, length: int) -> np.ndarray:
    """The windows of each occurrence that an earlier occurrence has as well.

    Occurrences are in their order; ``ids[at]`` is the first word of the seed.
    Bit r of ``mask`` tells that the window with r words to the left of the seed
    is asked about, and so is the result.
    """
    reach = length - K
    found = np.zeros(len(at), np.int64)
    if len(at) < 2:
        return found
    asked = [np.flatnonzero(mask >> r & 1) for r in range(reach + 1)]

    def word(offset):
        place = at + offset
        inside = (place >= 0) & (place < len(ids))       # words beyond aren't asked about
        return np.where(inside, ids[np.clip(place, 0, len(ids) - 1)], -1)

    core = np.unique(seed, return_inverse=True)[1]
    for j in range(K):
        core = _ranked(core, word(j))
    right = [core]
    for s in range(reach):
        right.append(_ranked(right[-1], word(K + s)))
    left = core
    for r in range(reach + 1):
        if r:
            left = _ranked(left, word(-r))
        rows = asked[r]
        if len(rows) > 1:
            key = left[rows].astype(np.int64) * len(at) + right[reach - r][rows]
            first = np.unique(key, return_index=True)[1]
            later = np.ones(len(rows), bool)
            later[first] = False
            found[rows[later]] |= 1 << r
    return found


def _runs(flags: np.ndarray):
    """(starts, ends) of the runs of true entries."""
    edges = np.flatnonzero(np.diff(np.concatenate(([False], flags, [False])).astype(np.int8)))
    return edges[::2], edges[1::2]


def _bounds(mask: np.ndarray, reach: int):
    """Lowest and highest set bit of masks that aren't zero."""
    bits = (mask[:, None] >> np.arange(reach + 1)) & 1
    return bits.argmax(axis=1), reach - bits[:, ::-1].argmax(axis=1)


# ------------------------------------------------------------------------ tasks

def _seeds(length: int):
    def task(batches):
        for batch in batches:
            words = Words([t.as_py() for t in batch.column("text")])
            _, _, place, h = window_runs(words, length)
            if not len(h):
                continue
            shard = batch.column("shard").to_numpy()[np.searchsorted(words.first, place, "right") - 1]
            order = np.argsort(h, kind="stable")
            h, shard = h[order], shard[order]
            begin = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
            offsets = np.append(begin, len(h))
            yield pa.RecordBatch.from_arrays(
                [pa.array(h[begin].view(np.int64)), pa.array(np.diff(offsets).astype(np.int32)),
                 pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(shard))], ["hash", "n", "shards"])
    return task


def _ordered(docs: pa.Table) -> pa.Table:
    late = pc.is_null(docs.column("doc_id")).cast(pa.int32())
    key = pc.coalesce(docs.column("doc_id"), pa.scalar(0, pa.int64()))
    docs = docs.append_column("late", late).append_column("key", key)
    return docs.sort_by([("late", "ascending"), ("key", "ascending"), ("tie", "ascending"), ("text", "ascending")])


def _empty(schema: list[tuple[str, pa.DataType]]) -> pa.Table:
    return pa.schema(schema).empty_table()


_PIECES = [("kind", pa.int32()), ("bucket", pa.int32()), ("hash", pa.int64()), ("shard", pa.int32()),
           ("doc_no", pa.int32()), ("late", pa.int32()), ("doc_id", pa.int64()), ("tie", pa.int64()),
           ("pos", pa.int32()), ("head", pa.int32()), ("mask", pa.int32()), ("n", pa.int32()), ("words", pa.binary())]


def _piece(rows: int, **columns) -> pa.Table:
    return pa.table([pa.array(columns[c], t) if c in columns else pa.nulls(rows, t) for c, t in _PIECES],
                    [c for c, _ in _PIECES])


def _settled(found: np.ndarray, first: np.ndarray, shard: int, buckets: int) -> pa.Table:
    """Rows of kind 1: runs of windows that repeat, by text."""
    at = np.flatnonzero(found)
    doc = np.searchsorted(first, at, "right") - 1
    edge = np.flatnonzero(np.concatenate(([True], (np.diff(at) != 1) | (np.diff(doc) != 0)))) if len(at) else at
    sizes = np.diff(np.append(edge, len(at)))
    lo, doc, rows = at[edge], doc[edge], len(edge)
    return _piece(rows, kind=np.ones(rows, np.int32), bucket=np.full(rows, shard % buckets, np.int32),
                  shard=np.full(rows, shard, np.int32), doc_no=doc.astype(np.int32),
                  pos=(lo - first[doc]).astype(np.int32), n=sizes.astype(np.int32))


def _shard(length: int, buckets: int, split: int):
    reach = length - K

    def task(docs: pa.Table, repeated: pa.Table) -> pa.Table:
        if not docs.num_rows or not repeated.num_rows:
            return _empty(_PIECES)
        docs = _ordered(docs)
        shard = docs.column("shard")[0].as_py()
        words = Words([t.as_py() for t in docs.column("text")])
        lo, hi, place, h = window_runs(words, length)
        known = repeated.column("hash").to_numpy()
        order = np.argsort(known)
        known, total = known[order], repeated.column("total").to_numpy()[order]
        found = np.minimum(np.searchsorted(known, h.view(np.int64)), len(known) - 1)
        seed = known[found] == h.view(np.int64)
        lo, hi, place, total, h = lo[seed], hi[seed], place[seed], total[found[seed]], h[seed]
        mask = np.zeros(len(place), np.int64)
        for r in range(reach + 1):
            w = place - r
            mask |= np.where((w >= lo) & (w < hi), 1 << r, 0)
        if not len(place):
            return _empty(_PIECES)
        # Only seeds that the shard holds twice can match within it.
        _, which, often = np.unique(h, return_inverse=True, return_counts=True)
        twice = np.flatnonzero(often[which] > 1)
        gone = np.zeros(len(place), np.int64)
        if len(twice):
            gone[twice] = extend(words.ids(), h[twice], place[twice], mask[twice], length)
        settled = np.zeros(len(words), bool)
        for r in range(reach + 1):
            settled[place[(gone >> r & 1) > 0] - r] = True
        mask &= ~gone
        live = mask > 0
        place, total, h, mask = place[live], total[live], h[live], mask[live]
        # Windows of hot seeds go one by one.
        hot = total > split
        rows = [(place[~hot], h[~hot], mask[~hot])]
        for r in range(reach + 1):
            one = hot & (mask >> r & 1 > 0)
            rows.append((place[one], h[one], np.full(int(one.sum()), 1 << r, np.int64)))
        dealt = np.concatenate([np.full(len(p), i > 0) for i, (p, _, _) in enumerate(rows)])
        place, h, mask = (np.concatenate(c) for c in zip(*rows))
        n = len(place)
        if not n:
            return _settled(settled, words.first, shard, buckets)
        low, high = _bounds(mask, reach)
        texts = [words.text(a, b) for a, b in zip((place - high).tolist(), (place - low + length).tolist())]
        signed = h.view(np.int64)
        bucket = np.array([xxhash.xxh64_intdigest(t) % buckets if d else x % buckets
                           for t, d, x in zip(texts, dealt.tolist(), signed.tolist())], np.int32)
        doc = np.searchsorted(words.first, place, "right") - 1
        take = pa.array(doc)
        out = _piece(n, kind=np.zeros(n, np.int32), bucket=bucket, hash=signed, shard=np.full(n, shard, np.int32),
                     doc_no=doc.astype(np.int32), late=docs.column("late").take(take).combine_chunks(),
                     doc_id=docs.column("key").take(take).combine_chunks(),
                     tie=docs.column("tie").take(take).combine_chunks(),
                     pos=(place - words.first[doc]).astype(np.int32), head=high.astype(np.int32),
                     mask=mask.astype(np.int32), words=texts)
        return pa.concat_tables([out, _settled(settled, words.first, shard, buckets)])
    return task


def _merge(length: int):
    reach = length - K

    def task(pieces: pa.Table) -> pa.Table:
        settled = pieces.filter(pc.equal(pieces.column("kind"), 1)).select(["shard", "doc_no", "pos", "n"])
        rows = pieces.filter(pc.equal(pieces.column("kind"), 0)).sort_by(
            [(c, "ascending") for c in ("late", "doc_id", "tie", "pos")])
        if rows.num_rows < 2:
            return settled
        parts = pc.split_pattern(rows.column("words").combine_chunks().cast(pa.large_binary()), b" ")
        ids = parts.flatten().dictionary_encode().indices.to_numpy(zero_copy_only=False)
        begin = parts.offsets.to_numpy()[:-1] - parts.offsets[0].as_py()
        mask = rows.column("mask").to_numpy().astype(np.int64)
        gone = extend(ids, rows.column("hash").to_numpy(), begin + rows.column("head").to_numpy(), mask, length)
        out = [settled]
        for r in range(reach + 1):
            hit = np.flatnonzero(gone >> r & 1)
            if len(hit):
                took = rows.take(pa.array(hit))
                out.append(pa.table([took.column("shard"), took.column("doc_no"),
                                     pc.subtract(took.column("pos"), pa.scalar(r, pa.int32())),
                                     pa.array(np.ones(len(hit), np.int32))], ["shard", "doc_no", "pos", "n"]))
        return pa.concat_tables(out).combine_chunks()
    return task


def _finish(length: int, with_text: bool):
    def task(docs: pa.Table, removed: pa.Table) -> pa.Table:
        docs = _ordered(docs)
        number = removed.column("doc_no").to_numpy()
        order = np.argsort(number, kind="stable")
        pos, n = removed.column("pos").to_numpy()[order], removed.column("n").to_numpy()[order]
        begin = np.searchsorted(number[order], np.arange(docs.num_rows + 1))
        rows = []
        for i, (ident, text, copies) in enumerate(zip(*(docs.column(c) for c in ("doc_id", "text", "copies")))):
            words = text.as_py().split()              # bytes: splits at ASCII white space
            size, spans = len(words), []
            if begin[i + 1] > begin[i]:
                step = np.zeros(size + 1, np.int64)
                np.add.at(step, pos[begin[i]:begin[i + 1]], 1)
                np.add.at(step, pos[begin[i]:begin[i + 1]] + n[begin[i]:begin[i + 1]] + length - 1, -1)
                lo, hi = _runs(np.cumsum(step)[:-1] > 0)
                spans = list(zip(lo.tolist(), hi.tolist()))
                kept, at = [], 0
                for a, b in [*spans, (size, size)]:
                    kept += words[at:a]
                    at = b
                words = kept
            left = b" ".join(words)
            row = [ident.as_py(), copies.as_py(), size, sum(b - a for a, b in spans), hashlib.sha256(left).hexdigest()]
            rows.append([*row, left.decode(), [list(s) for s in spans]] if with_text else row)
        names = ["doc_id", "copies", "n_words", "n_removed", "kept_sha256"]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
        if with_text:
            names += ["kept_text", "spans"]
            types += [pa.string(), pa.list_(pa.list_(pa.int64()))]
        columns = list(zip(*rows)) or [[]] * len(names)
        return pa.table([pa.array(list(c), t) for c, t in zip(columns, types)], names)
    return task


# ---------------------------------------------------------------------- operator

def _counted(docs: DataFrame) -> tuple[DataFrame, int]:
    """(doc_id, text, tie, copies) with rows equal in id and text as one, and the
    bytes of all texts."""
    rows = small_batches(docs).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(utf8("text"), F.lit(b"")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    keys = rows.groupBy("doc_id", "tie").agg(F.count("*").alias("held"), F.max(F.octet_length("text")).alias("size"))
    size, held = keys.agg(F.sum("size"), F.max("held")).first()
    single = rows.withColumn("copies", F.lit(1).cast("long"))
    if (held or 0) < 2:
        return single, size or 0
    keys = materialize(keys.where("held > 1").select(F.col("doc_id").alias("k_id"), F.col("tie").alias("k_tie")), "repeats-keys")
    same = F.col("doc_id").eqNullSafe(F.col("k_id")) & (F.col("tie") == F.col("k_tie"))
    several = rows.join(keys, same, "left_semi").groupBy("doc_id", "text", "tie").agg(F.count("*").alias("copies"))
    several = materialize(several, "repeats-copies")
    return single.join(keys, same, "left_anti").unionByName(several), size


def remove_passages(docs: DataFrame, length: int = 20, shard_bytes: int = SHARD_BYTES, split: int = SPLIT,
                    with_text: bool = False) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256 (of the
    words that remain, one blank between them).

    ``docs`` needs ``doc_id`` and ``text``.  ``with_text`` adds the remaining text
    (``kept_text``) and the maximal repeats as word ``spans`` [start, end).
    """
    if not K <= length <= K + 30:
        raise ValueError(f"length must be {K} to {K + 30} words")
    rows, size = _counted(docs)
    shards = blocks_for(size, shard_bytes)
    buckets = 2 * shards
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", "tie"), F.lit(shards)).cast("int"))
    seeds = dealt.select("text", "shard").mapInArrow(_seeds(length), _SEED)
    # A row for each of the 1,000-row blocks that hold an anchor, at most.
    same = Window.partitionBy("hash")
    repeated = seeds.withColumn("total", F.sum("n").over(same)).where("total > 1") \
        .select(F.explode(F.array_distinct("shards")).alias("shard"), "hash", "total")
    by_shard = dealt.groupBy("shard")
    pieces = by_shard.cogroup(repeated.groupBy("shard")).applyInArrow(_shard(length, buckets, split), _PIECE)
    removed = pieces.groupBy("bucket").applyInArrow(_merge(length), "shard int, doc_no int, pos int, n int")
    out = "doc_id long, copies long, n_words long, n_removed long, kept_sha256 string"
    out += ", kept_text string, spans array<array<long>>" if with_text else ""
    result = by_shard.cogroup(removed.groupBy("shard")).applyInArrow(_finish(length, with_text), out)
    # The rows that were one come apart again, a bounded number at a time.
    block = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / _COPIES)))
    result = result.withColumn("block", block)
    copy = F.explode(F.sequence(F.col("block") * _COPIES, F.least(F.col("copies"), (F.col("block") + 1) * _COPIES) - 1))
    result = result.withColumn("copy", copy)
    gone = (F.col("copy") > 0) & (F.col("n_words") >= length)
    columns = ["doc_id", "n_words", F.when(gone, F.col("n_words")).otherwise(F.col("n_removed")).alias("n_removed"),
               F.when(gone, hashlib.sha256(b"").hexdigest()).otherwise(F.col("kept_sha256")).alias("kept_sha256")]
    if with_text:
        whole = F.array(F.array(F.lit(0).cast("long"), F.col("n_words")))
        columns += [F.when(gone, "").otherwise(F.col("kept_text")).alias("kept_text"),
                    F.when(gone, whole).otherwise(F.col("spans")).alias("spans")]
    return result.select(*columns)
