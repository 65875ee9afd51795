"""Exact removal of long repeated substrings by suffix arrays.

A byte goes if some string of ``length`` bytes that covers it also starts
earlier: in a document with a smaller id, or earlier in the same document.

How it runs, all as one Spark plan:

1. ``_anchors``: every window of ``length`` bytes is named by the leftmost
   minimum of a hash over its k-grams (its anchor).  Equal windows have equal
   anchors, so a window whose anchor k-gram occurs once in the corpus cannot
   repeat.  Counting anchors (an aggregate over about 1/40 of the positions)
   leaves the stretches of text that can hold a repeat.
2. ``_shard``: documents are dealt to shards of about 1 MB by id and text, so
   rows that share an id or have none spread as well.  Each shard builds
   the suffix array of its stretches by Larsson-Sadakane refinement, gets the
   common prefixes of neighbours by Kasai's recurrence, and settles the repeats
   that lie within the shard.  What is left goes out as fragments: an anchor's
   run of windows with the bytes they cover.
3. ``_merge``: fragments meet by anchor, so equal windows of different shards
   meet in one task.  The windows' fingerprints are merged into one sorted
   array, every window finds its class there by binary search, and equality is
   verified on the bytes.  The windows of hot anchors (of over ``split`` runs)
   are dealt one by one instead, by a 128-bit BLAKE2b digest of the whole window
   that stands for its bytes.  Equal windows still meet, at most one of each
   shard, and no group holds a whole anchor: all windows of a corpus come to
   about ``shard_bytes`` a group.
4. ``_finish``: removed runs go back to their shard, where the documents'
   remaining bytes are counted and hashed.

Definitions: null text is empty; a null ``doc_id`` orders after every id;
rows that share an id order by their text, identical rows by occurrence.  The
place of a text among its id's is stored (``_places``), so all shards agree on
it; identical rows are in one shard.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import blocks_for, materialize, small_batches, total_bytes, utf8

SHARD_BYTES = 1 << 20  # text in a shard; its arrays then fit in the cache
K = 24                 # anchor k-gram
SPLIT_RUNS = 1 << 15   # windows of an anchor of more runs than this are dealt by content
_TILE = 1 << 16
_SALTS = 64            # parts that the texts of one id are dealt to
_HEAD = 128            # bytes of text that bounds of ranges are made of
_DIGEST = 16           # bytes that stand for a window of a hot anchor
_CARRIED = "carried_"

_ANCHOR = "hash long, shard int, n int"
_PIECE = ("kind int, bucket int, sub int, shard int, doc_no int, late int, "
          "doc_id long, tie long, start long, n int, data binary")
_PLACE = ("doc_id", "long"), ("digest", "binary"), ("place", "long")
_KEYS = ("late", "doc_id", "tie", "start")


# --------------------------------------------------------------- numpy parts

def _words(buf: np.ndarray) -> np.ndarray:
    """Unaligned little-endian 8-byte words starting at every byte."""
    return np.ndarray(max(len(buf) - 7, 0), "<u8", buf.data, strides=(1,))


def padded(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Parts laid end to end with a tail of zeros; offsets of parts."""
    offsets = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    return np.frombuffer(b"".join([*parts, bytes(128)]), np.uint8), offsets


def kgram_hash(words: np.ndarray, lo: int, hi: int) -> np.ndarray:
    h = words[lo:hi] * np.uint64(0x9E3779B97F4A7C15)
    h += words[lo + 8:hi + 8] * np.uint64(0xC2B2AE3D27D4EB4F)
    h += words[lo + 16:hi + 16] * np.uint64(0x165667B19E3779F9)
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(29)
    return h


def anchor_runs(buf: np.ndarray, offsets: np.ndarray, length: int):
    """Runs of windows with one anchor: (first window, one past the last,
    anchor's k-gram hash).  Windows that cross a document's end have no run."""
    n = int(offsets[-1])
    los, his, hashes = [], [], []
    width = length - K + 1
    words = _words(buf)
    valid_end = np.zeros(n + 1, np.int8)
    starts, ends = offsets[:-1], offsets[1:] - length + 1
    ok = ends > starts
    np.add.at(valid_end, starts[ok], 1)
    np.add.at(valid_end, ends[ok], -1)
    valid = np.cumsum(valid_end[:n], dtype=np.int8).astype(bool)
    first = np.zeros(n + 1, bool)
    first[offsets[:-1]] = True
    for lo in range(0, n, _TILE):
        hi = min(lo + _TILE, n)
        top = min(hi + width - 1, len(words) - 16)
        h = kgram_hash(words, lo, top)
        v = h & np.uint64(0xFFFFFFFFFFF00000)
        v |= np.arange(len(v), dtype=np.uint64)
        step, span = 1, 1
        while span < width:
            step = min(span, width - span)
            v = np.minimum(v[:-step], v[step:])
            span += step
        v = v[:hi - lo]
        at = (v & np.uint64(0xFFFFF)).astype(np.int64)
        good = valid[lo:lo + len(at)]
        new = np.empty(len(at), bool)
        new[:1] = True
        new[1:] = (at[1:] != at[:-1]) | (good[1:] != good[:-1]) | first[lo + 1:lo + len(at)]
        edge = np.flatnonzero(new)
        stop = np.append(edge[1:], len(at))
        keep = good[edge]
        edge, stop = edge[keep], stop[keep]
        los.append(edge + lo)
        his.append(stop + lo)
        hashes.append(h[at[edge]])
    if not los:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    return np.concatenate(los), np.concatenate(his), np.concatenate(hashes)


def suffix_array(buf: np.ndarray, n: int, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions 0..n-1 ordered by their next ``depth`` bytes or more; the
    places in that order whose suffix shares at least half of ``depth`` bytes
    with the one before it; and which of these share all of ``depth``.

    Larsson-Sadakane: order by 8 bytes, then double the compared length; only
    groups that are not yet settled are sorted again, by the rank of what
    follows them.  ``buf`` needs 8 bytes beyond n.
    """
    order = np.argsort(_words(buf)[:n].byteswap(), kind="quicksort").astype(np.int32)
    key = _words(buf)[order]
    new = np.ones(n, bool)
    new[1:] = key[1:] != key[:-1]
    rank = np.zeros(n + 1, np.int32)            # rank[n]: beyond the end
    first = np.flatnonzero(new)
    rank[order] = np.repeat((first + 1).astype(np.int32), np.diff(np.append(first, n)))
    done = 8
    alone = new & np.append(new[1:], True)
    todo = np.flatnonzero(~alone).astype(np.int32)      # places in ``order`` to refine
    close = equal = None
    while done < depth and len(todo):
        pos = order[todo]
        key = rank[pos].astype(np.uint64) << np.uint64(32)
        key |= rank[np.minimum(pos + np.int32(done), np.int32(n))].view(np.uint32)
        by = np.argsort(key, kind="quicksort")
        pos, key = pos[by], key[by]
        order[todo] = pos
        new = np.ones(len(todo), bool)
        new[1:] = key[1:] != key[:-1]
        first = np.flatnonzero(new)
        rank[pos] = np.repeat(todo[first] + np.int32(1), np.diff(np.append(first, len(todo))))
        done *= 2
        if done >= depth:
            head = key >> np.uint64(32)
            joined = np.zeros(len(todo), bool)
            joined[1:] = head[1:] == head[:-1]
            close, equal = todo[joined], ~new[joined]
        alone = new & np.append(new[1:], True)
        todo = todo[~alone]
    if close is None:
        close, equal = np.empty(0, np.int32), np.empty(0, bool)
    return order, close, equal


def common_prefixes(buf: np.ndarray, order: np.ndarray, places: np.ndarray, cap: int) -> np.ndarray:
    """For every one of ``places`` in ``order``, the bytes that its suffix
    shares with the suffix before it, up to ``cap``.

    Kasai's recurrence, run from the text's end: where a position and the next
    have predecessors at the same distance, the shared length of the earlier is
    one more than that of the later, so only the last position of each such
    chain is compared, eight bytes at a time.
    """
    n = len(order)
    if len(places) == 0:
        return np.empty(0, np.int64)
    by = np.argsort(order[places], kind="quicksort")
    pos = order[places[by]]
    before = np.where(places[by] > 0, order[places[by] - 1], np.int32(-1))
    chained = np.zeros(len(pos), bool)
    chained[:-1] = (pos[1:] == pos[:-1] + 1) & (before[1:] == before[:-1] + 1) \
        & (before[:-1] >= 0) & (buf[pos[:-1]] == buf[before[:-1]])
    last = np.flatnonzero(~chained)
    value = np.zeros(len(last), np.int64)
    words = _words(buf)
    live = np.flatnonzero(before[last] >= 0)
    shift = 0
    while len(live) and shift < cap:
        a, b = pos[last[live]] + shift, before[last[live]] + shift
        inside = np.maximum(a, b) < n
        live, a, b = live[inside], a[inside], b[inside]
        diff = words[a] ^ words[b]
        ended = diff != 0
        tail = diff[ended]
        low = tail & (~tail + np.uint64(1))
        value[live[ended]] = shift + np.log2(low.astype(np.float64)).astype(np.int64) // 8
        live = live[~ended]
        shift += 8
        value[live] = shift
    at = np.repeat(np.arange(len(last)), np.diff(np.concatenate(([-1], last))))
    out = np.empty(len(pos), np.int64)
    out[by] = np.minimum(value[at] + pos[last[at]] - pos, cap)
    return out


def runs_of(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], mask.view(np.int8), [0]))))
    return edge[::2], edge[1::2]


def later_copies(buf: np.ndarray, windows: np.ndarray, n: int, length: int) -> np.ndarray:
    """Mask over positions 0..n-1: windows equal to one at a smaller position.
    ``windows`` masks the positions that are windows of ``length`` bytes."""
    order, places, equal = suffix_array(buf, n, length)
    out = np.zeros(n, bool)
    equal[~equal] = common_prefixes(buf, order, places[~equal], length) >= length
    places = places[equal]                  # same window as at the place before
    if len(places) == 0:
        return out
    breaks = np.flatnonzero(np.diff(places, prepend=np.int32(-2)) != 1)
    pos, lead = order[places], order[places[breaks] - 1]
    least = np.minimum.reduceat(np.where(windows[pos], pos, np.int32(n)), breaks)
    least = np.minimum(least, np.where(windows[lead], lead, np.int32(n)))
    out[pos] = pos > np.repeat(least, np.diff(np.append(breaks, len(pos))))
    out[lead] = lead > least
    return out & windows


def _order_rank(t: dict[str, np.ndarray]) -> np.ndarray:
    """Place of each piece in the order of late, doc_id, tie, start."""
    by = np.lexsort([t[c] for c in reversed(_KEYS)])
    rank = np.empty(len(by), np.int64)
    rank[by] = np.arange(len(by))
    return rank


def merge_windows(pieces: list[bytes], length: int) -> np.ndarray:
    """Mask over the windows of all pieces, piece by piece: those equal to a
    window of an earlier piece (pieces come in order; a window occurs once
    within a piece's shard, so pieces never repeat themselves)."""
    buf, offsets = padded(pieces)
    total = int(offsets[-1])
    counts = np.diff(offsets) - (length - 1)
    pos = np.repeat(offsets[:-1] - np.concatenate(([0], np.cumsum(counts)[:-1])), counts) \
        + np.arange(int(counts.sum()))
    # Polynomial fingerprints modulo 2**64 from one running sum.
    base, inverse = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
    up = _powers(base, total + 1)
    run = np.zeros(total + 1, np.uint64)
    np.cumsum((buf[:total].astype(np.uint64) + np.uint64(1)) * _powers(inverse, total), out=run[1:])
    prints = (run[pos + length] - run[pos]) * up[pos]
    prints ^= prints >> np.uint64(32)
    by = np.argsort(prints, kind="quicksort")
    merged = prints[by]
    distinct = merged[np.append(True, merged[1:] != merged[:-1])]
    place = np.empty(len(prints), np.int64)
    place[by] = np.searchsorted(distinct, merged)        # each window's class
    first = np.empty(len(distinct), np.int64)
    first[place[::-1]] = np.arange(len(prints) - 1, -1, -1)   # the last write wins: the earliest
    lead = first[place]
    later = lead < np.arange(len(prints))
    # Equal fingerprints are verified on the bytes: in full where a run of
    # neighbouring pairs begins, by the one new byte within it.
    words = _words(buf)
    a, b = pos[later], pos[lead[later]]
    head = np.ones(len(a), bool)
    head[1:] = (np.diff(a) != 1) | (np.diff(b) != 1)
    same = buf[a + length - 1] == buf[b + length - 1]
    for k in [*range(0, length - 7, 8), max(length - 8, 0)]:
        same[head] &= words[a[head] + k] == words[b[head] + k]
    run = np.flatnonzero(head)
    if len(run):
        same = np.repeat(np.logical_and.reduceat(same, run), np.diff(np.append(run, len(a))))
    if not same.all():
        which = np.flatnonzero(later)
        clash = np.isin(place, place[which[~same]])
        seen: set[bytes] = set()
        for i in np.flatnonzero(clash).tolist():
            window = buf[pos[i]:pos[i] + length].tobytes()
            later[i] = window in seen
            seen.add(window)
    return later


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, by doubling."""
    out = np.ones(max(n, 1), np.uint64)
    size = 1
    while size < n:
        take = min(size, n - size)
        out[size:size + take] = out[:take] * np.uint64(pow(base, size, 1 << 64))
        size += take
    return out[:n]


# ------------------------------------------------------------ tasks on Spark

def _signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def _blocks(column, size: int = SHARD_BYTES):
    """Slices of a binary column of about ``size`` bytes, as (first row, parts)."""
    parts, held, first = [], 0, 0
    for i, value in enumerate(column):
        text = value.as_py() or b""
        parts.append(text)
        held += len(text)
        if held >= size:
            yield first, parts
            parts, held, first = [], 0, i + 1
    if parts:
        yield first, parts


def _anchors(length: int):
    def task(batches):
        for batch in batches:
            shard_all = batch.column("shard").to_numpy(zero_copy_only=False)
            for first, parts in _blocks(batch.column("text")):
                buf, offsets = padded(parts)
                lo, _, h = anchor_runs(buf, offsets, length)
                doc = np.searchsorted(offsets, lo, side="right") - 1
                shard = shard_all[first + doc].astype(np.int64)
                # one row for each k-gram and shard of this block
                by = np.lexsort((h, shard))
                h, shard = h[by], shard[by]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (shard[1:] != shard[:-1])
                at = np.flatnonzero(new)
                n = np.diff(np.append(at, len(h)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_signed(h[at])), pa.array(shard[at].astype(np.int32)),
                     pa.array(n.astype(np.int32))], ["hash", "shard", "n"])
    return task


def _ordered_docs(docs: pa.Table) -> tuple[list, list[bytes], list[int]]:
    """A shard's documents in order: ids, texts, and the rows they come from."""
    ids, texts = docs.column("doc_id").to_pylist(), docs.column("text").to_pylist()
    rows = sorted((i is None, i or 0, t or b"", k) for k, (i, t) in enumerate(zip(ids, texts)))
    return [None if r[0] else r[1] for r in rows], [r[2] for r in rows], [r[3] for r in rows]


def _ties(ids: list, texts: list[bytes], shared: pa.Table) -> np.ndarray:
    """Places of a shard's texts among all texts of their ids; 0 for an id of one row."""
    place = {(i, d): n for i, d, n in zip(*(shared.column(c).to_pylist() for c in ("doc_id", "digest", "place")))}
    several = {i for i, _ in place}
    return np.array([place[i, hashlib.sha256(t).digest()] if i in several else 0
                     for i, t in zip(ids, texts)], np.int64)


def _places(dealt: DataFrame) -> DataFrame | None:
    """The order of texts that share an id (or have none) over all shards: rows
    (shard, doc_id, digest, place).  None if every id is of one row."""
    several = materialize(dealt.groupBy("doc_id").count().where("count > 1").select("doc_id"), "suffix-ids")
    if several.isEmpty():
        return None
    # An id may have any number of rows: the join is salted with the text.
    salted = several.select(F.col("doc_id").alias("__id"), F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("__salt"))
    texts = dealt.select("doc_id", "shard", F.coalesce("text", F.lit(b"")).alias("text")) \
        .withColumn("salt", F.pmod(F.xxhash64("text"), F.lit(_SALTS)).cast("int"))
    texts = texts.join(salted, texts.doc_id.eqNullSafe(salted["__id"]) & (texts.salt == salted["__salt"]), "left_semi")
    # Ranges go by the text's head, as their bounds are sampled by the driver.
    order = F.col("doc_id").isNull(), F.col("doc_id")
    ranged = texts.repartitionByRange(*order, F.substring("text", 1, _HEAD)).sortWithinPartitions(*order, "text")
    return materialize(ranged.select("shard", "doc_id", F.unhex(F.sha2("text", 256)).alias("digest"),
                                     F.monotonically_increasing_id().alias("place")), "suffix-places") \
        .groupBy("shard", "doc_id", "digest").agg(F.min("place").alias("place"))


def _piece_table(kind, bucket, sub, shard, doc_no, late, doc_id, tie, start, n, data) -> pa.Table:
    i4, i8 = pa.int32(), pa.int64()
    return pa.table({
        "kind": pa.array(kind, i4), "bucket": pa.array(bucket, i4), "sub": pa.array(sub, i4),
        "shard": pa.array(shard, i4), "doc_no": pa.array(doc_no, i4), "late": pa.array(late, i4),
        "doc_id": pa.array(doc_id, i8), "tie": pa.array(tie, i8), "start": pa.array(start, i8),
        "n": pa.array(n, i4), "data": pa.array(data, pa.binary())})


def _shard(length: int, shards: int, split: int):
    def task(key, docs, repeated):
        ids, texts, _ = _ordered_docs(docs)
        empty = _piece_table(*[[]] * 11)
        shared = pc.is_valid(repeated.column("place"))
        tie = _ties(ids, texts, repeated.filter(shared))
        repeated = repeated.filter(pc.invert(shared))
        if repeated.num_rows == 0 or not texts:
            return empty
        shard = key[0].as_py()
        buf, offsets = padded(texts)
        lo, hi, h = anchor_runs(buf, offsets, length)
        known = repeated.column("hash").to_numpy().view(np.uint64)
        hot = repeated.column("total").to_numpy() > split
        by = np.argsort(known)
        known, hot = known[by], hot[by]
        at = np.minimum(np.searchsorted(known, h), len(known) - 1)
        hit = known[at] == h
        lo, hi, h, hot = lo[hit], hi[hit], h[hit], hot[at[hit]]
        if len(lo) == 0:
            return empty
        # Stretches of text that hold a window with a repeated anchor.
        size = int(offsets[-1])
        mask = np.zeros(size + 1, np.int32)
        np.add.at(mask, lo, 1)
        np.add.at(mask, hi, -1)
        windows = np.cumsum(mask[:size]) > 0
        np.add.at(mask, hi, 1)
        np.add.at(mask, hi + length - 1, -1)
        covered = np.cumsum(mask[:size]) > 0
        # A stretch never runs on into the next document: cut there.
        s, e = runs_of(covered)
        cuts = offsets[1:-1]
        cuts = cuts[covered[np.minimum(cuts, size - 1)] & (cuts < size)]
        s, e = np.sort(np.concatenate((s, cuts))), np.sort(np.concatenate((e, cuts)))
        width = e - s
        ok = width > 0
        s, e, width = s[ok], e[ok], width[ok]
        # Laid end to end.  What a suffix holds beyond its stretch decides
        # nothing: every window lies inside one.
        total = int(width.sum())
        src = np.repeat(s - np.concatenate(([0], np.cumsum(width)[:-1])), width) + np.arange(total)
        text = np.concatenate((buf[src], np.zeros(128, np.uint8)))
        copy = later_copies(text, windows[src], total, length)
        later = np.zeros(size, bool)
        later[src] = copy
        # Repeats within the shard are settled: runs of removed windows.
        out = []
        rs, re = _cut(*runs_of(later), offsets)
        doc = np.searchsorted(offsets, rs, side="right") - 1
        zero = np.zeros(len(rs), np.int64)
        out.append(_piece_table(zero + 1, zero + shard, zero, zero + shard, doc, zero, zero, zero,
                                rs - offsets[doc], re - rs, [None] * len(rs)))
        # The others go to their anchor's merge, a run of windows a piece, or
        # to their own if the anchor is hot.
        owner = np.full(size, -1, np.int64)
        widths = hi - lo
        fill = np.repeat(lo - np.concatenate(([0], np.cumsum(widths)[:-1])), widths) + np.arange(int(widths.sum()))
        owner[fill] = np.repeat(np.arange(len(lo)), widths)
        owner[later] = -1
        new = np.ones(size, bool)
        new[1:] = owner[1:] != owner[:-1]
        at = np.flatnonzero(new)
        end = np.append(at[1:], size)
        own = owner[at]
        at, end, own = at[own >= 0], end[own >= 0], own[own >= 0]
        doc = np.searchsorted(offsets, at, side="right") - 1
        raw = buf.tobytes()
        one = hot[own]
        alone = np.flatnonzero(one)
        n = (end - at)[alone]
        window = np.repeat(at[alone] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        digests = [hashlib.blake2b(raw[a:a + length], digest_size=_DIGEST).digest() for a in window.tolist()]
        late = np.array([i is None for i in ids], np.int32)
        id8 = np.array([i or 0 for i in ids], np.int64)
        d = np.repeat(doc[alone], n)
        out.append(_piece_table(
            np.full(len(d), 2), (_digest_words(digests)[:, 0] % np.uint64(shards)).astype(np.int64),
            np.ones(len(d), np.int64), np.full(len(d), shard),
            d, late[d], id8[d], tie[d], window - offsets[d], np.ones(len(d), np.int64), digests))
        at, end, own, doc = at[~one], end[~one], own[~one], doc[~one]
        data = [raw[a:b] for a, b in zip(at.tolist(), (end + length - 1).tolist())]
        out.append(_piece_table(
            np.zeros(len(at), np.int64), (h[own] % np.uint64(shards)).astype(np.int64),
            np.zeros(len(at), np.int64), np.full(len(at), shard),
            doc, late[doc], id8[doc], tie[doc], at - offsets[doc], end - at, data))
        return pa.concat_tables(out)
    return task


def _cut(s: np.ndarray, e: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs cut where a document ends."""
    cuts = offsets[1:-1]
    at = np.searchsorted(s, cuts, side="right") - 1
    inside = (at >= 0) & (cuts > s[np.maximum(at, 0)]) & (cuts < e[np.maximum(at, 0)]) if len(s) else np.zeros(len(cuts), bool)
    cuts = np.unique(cuts[inside])
    return np.sort(np.concatenate((s, cuts))), np.sort(np.concatenate((e, cuts)))


def _digest_words(digests: list[bytes]) -> np.ndarray:
    """Digests as rows of two words."""
    return np.frombuffer(b"".join(digests), "<u8").reshape(-1, 2)


def later_digests(t: dict[str, np.ndarray], words: np.ndarray) -> np.ndarray:
    """Mask over single windows: those equal to an earlier one in the order of
    late, doc_id, tie, start."""
    by = np.lexsort([*(t[c] for c in reversed(_KEYS)), words[:, 1], words[:, 0]])
    later = np.zeros(len(by), bool)
    later[by[1:]] = (words[by[1:]] == words[by[:-1]]).all(axis=1)
    return later


def _merge(length: int):
    """Settle the pieces of one group: what is removed, as runs of windows."""
    def task(key, pieces):
        kind = pieces.column("kind").to_numpy()
        out = [pieces.filter(pa.array(kind == 1))]

        def cut(c: dict[str, np.ndarray], start, n):
            size = len(start)
            out.append(_piece_table(np.ones(size, np.int64), c["bucket"], c["sub"], c["shard"], c["doc_no"], c["late"],
                                    c["doc_id"], c["tie"], start, n, [None] * size))

        single = pieces.filter(pa.array(kind == 2))
        if single.num_rows:
            cols = {c: single.column(c).to_numpy() for c in single.column_names if c != "data"}
            later = later_digests(cols, _digest_words(single.column("data").to_pylist()))
            cols = {c: v[later] for c, v in cols.items()}
            cut(cols, cols["start"], cols["n"])
        live = pieces.filter(pa.array(kind == 0))
        if live.num_rows:
            rank = _order_rank({c: live.column(c).to_numpy() for c in _KEYS})
            live = live.take(pa.array(np.argsort(rank)))
            later = merge_windows(live.column("data").to_pylist(), length)
            cols = {c: live.column(c).to_numpy() for c in live.column_names if c != "data"}
            n = cols["n"].astype(np.int64)
            first = np.cumsum(n) - n
            owner = np.repeat(np.arange(len(n)), n)
            new = np.ones(len(later), bool)
            new[1:] = (owner[1:] != owner[:-1]) | (later[1:] != later[:-1])
            at = np.flatnonzero(new)
            end = np.append(at[1:], len(later))
            at, end = at[later[at]], end[later[at]]
            o = owner[at]
            cols = {c: v[o] for c, v in cols.items()}
            cut(cols, cols["start"] + at - first[o], end - at)
        return pa.concat_tables(out)
    return task


def _finish(length: int, spans_out: bool):
    def task(key, docs, removed):
        ids, texts, place = _ordered_docs(docs)
        runs: dict[int, list[tuple[int, int]]] = {}
        for d, s, n in zip(*(removed.column(c).to_pylist() for c in ("doc_no", "start", "n"))):
            runs.setdefault(d, []).append((s, s + n + length - 1))
        rows = []
        for i, text in enumerate(texts):
            spans: list[list[int]] = []
            for s, e in sorted(runs.get(i, ())):
                if spans and s <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], e)
                else:
                    spans.append([s, e])
            kept, at = hashlib.sha256(), 0
            pieces = []
            for s, e in [*spans, [len(text), len(text)]]:
                kept.update(text[at:s])
                if spans_out:
                    pieces.append(text[at:s])
                at = e
            row = [ids[i], len(text), sum(e - s for s, e in spans), len(spans), kept.hexdigest()]
            left = b"".join(pieces)
            rows.append([*row, left, left.decode(errors="ignore"), spans] if spans_out else row)
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
        if spans_out:
            names += ["kept", "kept_text", "spans"]
            types += [pa.binary(), pa.string(), pa.list_(pa.list_(pa.int64()))]
        cols = list(zip(*rows)) or [[]] * len(names)
        out = pa.table([pa.array(list(c), t) for c, t in zip(cols, types)], names)
        for name in docs.column_names:
            if name.startswith(_CARRIED):
                out = out.append_column(name, docs.column(name).take(pa.array(place, pa.int64())))
        return out
    return task


def remove_repeats(docs: DataFrame, length: int = 100, shard_bytes: int = SHARD_BYTES,
                   split: int = SPLIT_RUNS, with_text: bool = False,
                   carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: what remains once repeated strings are removed.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored.  Returns
    doc_id, n_bytes, n_removed, n_spans, kept_sha256; ``with_text`` adds the
    remaining bytes (``kept``), their text without the pieces of characters
    that were cut in two (``kept_text``) and the removed ``spans`` as [start, end);
    ``carry`` names columns of ``docs`` to return as well, as ``carried_<name>``.
    A document shorter than ``length`` loses nothing.  An empty table gives an
    empty result.
    """
    if length < K:
        raise ValueError(f"length must be at least {K}")
    shards = blocks_for(total_bytes(docs, "text"), shard_bytes)
    rest = [F.col(c).alias(_CARRIED + c) for c in carry]
    dealt = small_batches(docs).select(
        *rest, F.col("doc_id").cast("long").alias("doc_id"), utf8("text").alias("text"),
        F.pmod(F.xxhash64(F.col("doc_id").cast("long"), F.coalesce(utf8("text"), F.lit(b""))), F.lit(shards))
        .cast("int").alias("shard"))
    anchors = dealt.select("text", "shard").where(F.octet_length("text") >= length) \
        .mapInArrow(_anchors(length), _ANCHOR)
    # Dealt out once; an anchor has a row for each shard's block at most.
    same = Window.partitionBy("hash")
    repeated = anchors.select("hash", "shard", F.sum("n").over(same).alias("total")) \
        .where("total > 1").select("shard", "hash", "total", *(F.lit(None).cast(t).alias(c) for c, t in _PLACE))
    places = _places(dealt.select("doc_id", "text", "shard"))
    if places is not None:
        none = (F.lit(0).cast("long").alias(c) for c in ("hash", "total"))
        repeated = repeated.unionByName(places.select("shard", *none, *(c for c, _ in _PLACE)))
    by_shard = dealt.groupBy("shard")
    pieces = by_shard.cogroup(repeated.groupBy("shard")).applyInArrow(
        _shard(length, shards, split), _PIECE)
    removed = pieces.groupBy("bucket", "sub").applyInArrow(_merge(length), _PIECE) \
        .select("shard", "doc_no", "start", "n")
    out = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    if with_text:
        out += ", kept binary, kept_text string, spans array<array<long>>"
    for c in carry:
        out += f", `{_CARRIED}{c}` {docs.schema[c].dataType.simpleString()}"
    return by_shard.cogroup(removed.groupBy("shard")).applyInArrow(_finish(length, with_text), out)
