"""Benchmark decontamination over a positional inverted index.

``build_index`` cuts the corpus into segments of a few MB and stores, for each
segment, the postings of every token: its positions in order, term by term
(delta coded).  The index is a table: a row per segment, written as Parquet.

``search`` takes phrases and finds their exact occurrences in every segment:
a phrase starts at its rarest term in that segment, the posting list shifted
to the phrase's start, and the lists of its other terms, shifted likewise, are
intersected in order of rarity by binary search.  A phrase with a term that
the segment lacks costs nothing more.

``proximity`` finds windows whose words were moved or parted: stretches of at
most ``span`` words of one document that begin with a word of the window and
hold every distinct word of it, in any order.  Only places near the window's
rarest term in the segment are looked at; which term that is doesn't change
what is found.  ``decontaminate`` does both in one pass over the index, if it is
given a ``span``.

Benchmark items are phrases cut into windows of ``window`` words.  They are
sent to the tasks in blocks of at most ``block_bytes`` of text, one pass over
the index for each block, so what is broadcast does not grow with them.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z.
Null texts have no words.  An item with a null id counts as an occurrence but
is not listed.  Rows that share an id are handled one by one; a null ``doc_id``
is kept.  Equal benchmark rows are one.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks_for, materialize, numbered, small_batches, total_bytes, utf8

SEGMENT_BYTES = 2 << 20
BLOCK_BYTES = 8 << 20       # benchmark text sent to the tasks at once
_CANDIDATES = 1 << 18       # places of rarest terms looked at together

# Separators become blanks, A-Z become a-z, digits, a-z and bytes over 0x7F stay.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32
              for c in range(256))

INDEX = ("segment long, n_tokens long, doc_ids array<long>, doc_starts array<long>, "
         "terms binary, term_starts binary, deltas binary")
HITS = "segment long, doc_no int, item_id string, spans array<array<int>>, near boolean"
NEAR = "segment long, doc_no int, item_id string, position int"


def words(text: bytes | None) -> list[bytes]:
    return text.translate(_FOLD).split() if text else []


# ---------------------------------------------------------------- the index

def _segment(texts: list[list[bytes]]):
    """Arrays of one segment: document starts, terms, where their postings
    start, and the postings."""
    number: dict[bytes, int] = {}
    codes = np.array([number.setdefault(w, len(number)) for t in texts for w in t], np.int32)
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=starts[1:])
    postings = np.argsort(codes, kind="stable").astype(np.int32)
    term_starts = np.zeros(len(number) + 1, np.int32)
    np.cumsum(np.bincount(codes, minlength=len(number)), out=term_starts[1:])
    deltas = np.diff(postings, prepend=np.int32(0)).astype(np.int32)
    return starts, b" ".join(number), term_starts, deltas


def build_index(docs: DataFrame, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """The index's rows; ``docs`` needs doc_id and text.  Every row of ``docs``
    is in exactly one segment, with or without words."""
    def task(batches):
        from pyspark import TaskContext
        part, count = TaskContext.get().partitionId(), 0
        ids, texts, held = [], [], 0

        def segment():
            starts, terms, term_starts, deltas = _segment(texts)
            return pa.RecordBatch.from_arrays([
                pa.array([(part << 32) + count], pa.int64()), pa.array([int(starts[-1])], pa.int64()),
                pa.array([ids], pa.list_(pa.int64())), pa.array([starts.tolist()], pa.list_(pa.int64())),
                pa.array([terms], pa.binary()), pa.array([term_starts.tobytes()], pa.binary()),
                pa.array([deltas.tobytes()], pa.binary())],
                ["segment", "n_tokens", "doc_ids", "doc_starts", "terms", "term_starts", "deltas"])

        for batch in batches:
            for i, t in zip(batch.column("doc_id"), batch.column("text")):
                t = t.as_py() or b""
                ids.append(i.as_py())
                texts.append(words(t))
                held += len(t) + 16
                if held >= segment_bytes:
                    yield segment()
                    count += 1
                    ids, texts, held = [], [], 0
        if ids:
            yield segment()

    return small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), utf8("text").alias("text")) \
        .mapInArrow(task, INDEX)


class Postings:
    """One segment, ready to search."""

    def __init__(self, terms: bytes, term_starts: bytes, deltas: bytes, doc_starts):
        names = terms.split(b" ") if terms else []
        self.number = dict(zip(names, range(len(names))))
        self.starts = np.frombuffer(term_starts, np.int32).astype(np.int64)
        self.positions = np.cumsum(np.frombuffer(deltas, np.int32), dtype=np.int64)
        self.doc_starts = np.asarray(doc_starts, np.int64)
        self.n = len(self.positions)
        # (term, position) as one ascending array: a binary search in it is a
        # binary search in the term's list
        size = np.diff(self.starts)
        self.keys = np.repeat(np.arange(len(size)), size) * (self.n + 1) + self.positions

    def code(self, terms: list[bytes]) -> np.ndarray:
        return np.array([self.number.get(t, -1) for t in terms], np.int64)

    def has(self, term: np.ndarray, position: np.ndarray) -> np.ndarray:
        key = term * (self.n + 1) + position
        at = np.minimum(np.searchsorted(self.keys, key), max(len(self.keys) - 1, 0))
        return (position >= 0) & (position < self.n) & (self.keys[at] == key)

    def counts(self, term: np.ndarray) -> np.ndarray:
        size = np.append(np.diff(self.starts), 0)
        return np.where(term >= 0, size[term], 0)

    def expand(self, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All postings of the given terms: (index into ``term``, position)."""
        size = self.counts(term)
        which = np.repeat(np.arange(len(term)), size)
        first = self.starts[np.maximum(term, 0)]
        at = np.repeat(first - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(int(size.sum()))
        return which, self.positions[at]

    def around(self, position: np.ndarray, near: int) -> tuple[np.ndarray, np.ndarray]:
        """First and last position at most ``near`` words away in the same document."""
        doc = np.searchsorted(self.doc_starts, position, side="right")
        return (np.maximum(position - near, self.doc_starts[doc - 1]),
                np.minimum(position + near, self.doc_starts[doc] - 1))

    def same_document(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        doc = lambda p: np.searchsorted(self.doc_starts, p, side="right")
        return doc(lo) == doc(hi)


def phrase_matches(index: Postings, phrases: np.ndarray, lengths: np.ndarray):
    """Exact occurrences of phrases (rows of term codes, -1 beyond a phrase's
    length): (phrase, start position)."""
    width = phrases.shape[1]
    used = np.arange(width) < lengths[:, None]
    size = np.where(used, index.counts(phrases.ravel()).reshape(phrases.shape), np.iinfo(np.int64).max)
    rare = np.argsort(size, axis=1, kind="stable")
    possible = np.flatnonzero(np.take_along_axis(size, rare[:, :1], 1)[:, 0] > 0)
    if len(possible) == 0 or index.n == 0:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    phrases, lengths, rare = phrases[possible], lengths[possible], rare[possible]
    which, at = index.expand(phrases[np.arange(len(possible)), rare[:, 0]])
    start = at - rare[which, 0]
    inside = (start >= 0) & (start + lengths[which] <= index.n)
    which, start = which[inside], start[inside]
    for k in range(1, width):
        live = lengths[which] > k
        slot = rare[which, k]
        ok = ~live
        ok[live] = index.has(phrases[which[live], slot[live]], start[live] + slot[live])
        which, start = which[ok], start[ok]
    ok = index.same_document(start, start + lengths[which] - 1)
    return possible[which[ok]], start[ok]


def _near_rarest(index: Postings, terms: np.ndarray, lengths: np.ndarray, near: int):
    """For rows of term codes, the places of a row's rarest term with all its
    other terms at most ``near`` words away in the same document: (row, position)."""
    width = terms.shape[1]
    used = np.arange(width) < lengths[:, None]
    size = np.where(used, index.counts(terms.ravel()).reshape(terms.shape), np.iinfo(np.int64).max)
    possible = np.flatnonzero((lengths > 0) & (size.min(axis=1, initial=np.iinfo(np.int64).max) > 0))
    rare = np.take_along_axis(terms, np.argsort(size, axis=1, kind="stable"), 1)[possible]
    which, at = index.expand(rare[:, 0] if width else np.empty(0, np.int64))
    lo, hi = index.around(at, near)
    for k in range(1, width):
        ok = lengths[possible[which]] <= k
        base = rare[which, k] * (index.n + 1)
        ok |= np.searchsorted(index.keys, base + hi, side="right") > np.searchsorted(index.keys, base + lo)
        which, at, lo, hi = which[ok], at[ok], lo[ok], hi[ok]
    return possible[which], at


def proximity_matches(index: Postings, terms: np.ndarray, length: int, near: int):
    """Places where ``length`` terms all occur within ``near`` words after or
    before the rarest: positions of the rarest."""
    return _near_rarest(index, terms[None, :length], np.array([length]), near)[1]


def _in_turn(index: Postings, terms: np.ndarray, lengths: np.ndarray):
    """Rows whose terms the segment has, in groups whose rarest terms have about
    ``_CANDIDATES`` places together."""
    used = np.arange(terms.shape[1]) < lengths[:, None]
    size = np.where(used, index.counts(terms.ravel()).reshape(terms.shape), np.iinfo(np.int64).max)
    least = np.where(lengths > 0, size.min(axis=1, initial=np.iinfo(np.int64).max), 0)
    live = np.flatnonzero(least > 0)
    if len(live):
        yield from np.split(live, np.flatnonzero(np.diff(np.cumsum(least[live]) // _CANDIDATES)) + 1)


def stretches(index: Postings, terms: np.ndarray, lengths: np.ndarray, span: int):
    """Stretches of at most ``span`` words that begin with one of a row's terms
    and hold them all: (row, first position), ascending."""
    rows, firsts = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    width = terms.shape[1]
    for group in _in_turn(index, terms, lengths):
        r, p = _near_rarest(index, terms[group], lengths[group], span - 1)
        r = group[r]
        lo, _ = index.around(p, span - 1)
        found = []          # where a stretch that holds the rarest term may begin
        for j in range(width):
            live = np.flatnonzero(lengths[r] > j)
            base = terms[r[live], j] * (index.n + 1)
            a = np.searchsorted(index.keys, base + lo[live])
            n = np.searchsorted(index.keys, base + p[live], side="right") - a
            own = np.repeat(np.arange(len(live)), n)
            key = a[own] + np.arange(len(own)) - (np.cumsum(n) - n)[own]
            found.append(r[live[own]] * (index.n + 1) + index.positions[key])
        r, first = np.divmod(np.unique(np.concatenate(found)), index.n + 1)
        _, hi = index.around(first, span - 1)
        for j in range(width):
            ok = lengths[r] <= j
            base = terms[r, j] * (index.n + 1)
            ok |= np.searchsorted(index.keys, base + hi, side="right") > np.searchsorted(index.keys, base + first)
            r, first, hi = r[ok], first[ok], hi[ok]
        rows.append(r)
        firsts.append(first)
    both = np.unique(np.concatenate(rows) * (index.n + 1) + np.concatenate(firsts))
    return np.divmod(both, index.n + 1)


# ------------------------------------------------------------------ searching

def _windows(items: list[list[bytes]], window: int):
    """Distinct windows of all items: terms, codes, lengths, and the items that
    hold each window."""
    number: dict[bytes, int] = {}
    holders: dict[tuple, list[int]] = {}
    for no, ws in enumerate(items):
        codes = tuple(number.setdefault(w, len(number)) for w in ws)
        for k in range(max(1, len(codes) - window + 1) if codes else 0):
            holders.setdefault(codes[k:k + window], []).append(no)
    width = max(map(len, holders), default=1)
    table = np.full((len(holders), width), -1, np.int64)
    for row, key in enumerate(holders):
        table[row, :len(key)] = key
    lengths = np.array([len(k) for k in holders], np.int64)
    sizes = np.array([len(set(v)) for v in holders.values()], np.int64)
    flat = np.array([i for v in holders.values() for i in sorted(set(v))], np.int64)
    starts = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
    return list(number), table, lengths, starts, flat


def _segments(batches):
    """The index's segments, ready to search: (segment, postings)."""
    for batch in batches:
        for row in range(batch.num_rows):
            get = lambda c: batch.column(c)[row].as_py()  # noqa: B023, E731
            yield get("segment"), Postings(get("terms"), get("term_starts"), get("deltas"), get("doc_starts"))


def _held(which: np.ndarray, starts: np.ndarray, flat: np.ndarray):
    """The items that hold the windows ``which``: (index into ``which``, item)."""
    n = starts[which + 1] - starts[which]
    own = np.repeat(np.arange(len(which)), n)
    return own, flat[starts[which][own] + np.arange(len(own)) - (np.cumsum(n) - n)[own]]


def _distinct_terms(table: np.ndarray, lengths: np.ndarray):
    """Windows as sets: each term once."""
    sets, sizes = np.full_like(table, -1), np.zeros_like(lengths)
    for row, held in enumerate(table):
        held = list(dict.fromkeys(held[:lengths[row]].tolist()))
        sets[row, :len(held)], sizes[row] = held, len(held)
    return sets, sizes


def _search(sent, window: int, span: int | None = None):
    """One row for each document and item, with its merged spans; with ``span``
    another, ``near``, for each document and item with a stretch."""
    def task(batches):
        ids, item_words = sent.value
        terms, table, lengths, starts, flat = _windows(item_words, window)
        sets, sizes = _distinct_terms(table, lengths) if span else (None, None)
        for segment, index in _segments(batches):
            code = np.append(index.code(terms), -1)
            which, at = phrase_matches(index, code[table], lengths)
            doc = np.searchsorted(index.doc_starts, at, side="right") - 1
            own, item = _held(which, starts, flat)
            lo = (at - index.doc_starts[doc])[own]
            hi, doc = lo + lengths[which][own], doc[own]
            by = np.lexsort((lo, item, doc))
            out: list[tuple[int, int, list | None]] = []
            for d, i, a, b in zip(*(x[by].tolist() for x in (doc, item, lo, hi))):
                if out and out[-1][:2] == (d, i):
                    spans = out[-1][2]
                    if a <= spans[-1][1]:
                        spans[-1][1] = max(b, spans[-1][1])
                    else:
                        spans.append([a, b])
                else:
                    out.append((d, i, [[a, b]]))
            if span and index.n and len(table):
                which, at = stretches(index, code[sets], sizes, span)
                own, item = _held(which, starts, flat)
                doc = np.searchsorted(index.doc_starts, at, side="right") - 1
                both = np.unique(doc[own] * np.int64(len(ids)) + item)
                out += [(d, i, None) for d, i in zip(*(x.tolist() for x in np.divmod(both, len(ids))))]
            cols = list(zip(*out)) or [[], [], []]
            yield pa.RecordBatch.from_arrays([
                pa.array([segment] * len(out), pa.int64()), pa.array(cols[0], pa.int32()),
                pa.array([ids[i] for i in cols[1]], pa.string()), pa.array(cols[2], pa.list_(pa.list_(pa.int32()))),
                pa.array([s is None for s in cols[2]], pa.bool_())],
                ["segment", "doc_no", "item_id", "spans", "near"])
    return task


def _proximity(sent, window: int, span: int):
    def task(batches):
        ids, item_words = sent.value
        terms, table, lengths, starts, flat = _windows(item_words, window)
        sets, sizes = _distinct_terms(table, lengths)
        for segment, index in _segments(batches):
            if index.n == 0 or len(table) == 0:
                continue
            which, at = stretches(index, np.append(index.code(terms), -1)[sets], sizes, span)
            own, item = _held(which, starts, flat)
            item, at = np.unique(np.stack((item, at[own])), axis=1) if len(own) else (item, at)
            doc = np.searchsorted(index.doc_starts, at, side="right") - 1
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(at), segment, np.int64)), pa.array(doc.astype(np.int32)),
                pa.array([ids[i] for i in item.tolist()], pa.string()),
                pa.array((at - index.doc_starts[doc]).astype(np.int32))],
                ["segment", "doc_no", "item_id", "position"])
    return task


def _check_span(window: int, span: int) -> None:
    if span < window:
        raise ValueError("span must be at least window, or exact phrases would be missed")


def _by_block(index: DataFrame, items: DataFrame, block_bytes: int, task, schema: str) -> DataFrame:
    """``task`` of every block of items, over all segments."""
    texts = items.select(F.col("item_id").cast("string").alias("item_id"),
                         F.col("text").cast("string").alias("text")).where(F.octet_length("text") > 0).distinct()
    blocks = blocks_for(total_bytes(texts, "text"), block_bytes)
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    found = None
    for k in range(blocks):
        rows = texts.where(block == k).collect()
        sent = index.sparkSession.sparkContext.broadcast(
            ([r.item_id for r in rows], [words(r.text.encode()) for r in rows]))
        hits = index.mapInArrow(task(sent), schema)
        found = hits if found is None else found.union(hits)
    return found


def search(index: DataFrame, items: DataFrame, window: int = 10,
           block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Occurrences of the items' windows: rows (segment, doc_no, item_id,
    spans), spans as [first word, one past the last)."""
    return _by_block(index, items, block_bytes, lambda sent: _search(sent, window), HITS).drop("near")


def proximity(index: DataFrame, items: DataFrame, window: int = 10, span: int = 12,
              block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Stretches of at most ``span`` words that hold all words of one of the
    items' windows, in any order: rows (segment, doc_no, item_id, position),
    position being the stretch's first word.  A position is listed once for
    each different row of ``items``."""
    _check_span(window, span)
    return _by_block(index, items, block_bytes, lambda sent: _proximity(sent, window, span), NEAR)


def _ids_digest(items) -> tuple[int, str]:
    ids = sorted({x for x in items or () if x is not None})
    return len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest()


def _digest(batches):
    """Union of spans and the lists of items of each document."""
    names = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "n_near", "near_sha256"]
    for batch in batches:
        rows = []
        for i, n, lists, items, near in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n_words", "lists", "items", "near"))):
            hit, end = 0, 0
            for a, b in sorted(map(tuple, (s for spans in lists or () for s in spans))):
                hit += max(b - max(a, end), 0)
                end = max(end, b)
            rows.append((i, n, hit, *_ids_digest(items), hit > 0, *_ids_digest(near)))
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.int64(), pa.string()]
        cols = list(zip(*rows)) or [[]] * 8
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types)], names)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10, span: int | None = None,
                  segment_bytes: int = SEGMENT_BYTES, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256,
    contaminated.  With ``span`` also n_near and near_sha256, the same of the
    items with a window whose words all stand within ``span`` words of the
    document, in any order (so of those with an exact occurrence too)."""
    if span is not None:
        _check_span(window, span)
    index = materialize(build_index(docs, segment_bytes), "leaks-index")
    # A document's hits are bounded by its words and the items.
    per_doc = _by_block(index, benchmark, block_bytes, lambda sent: _search(sent, window, span), HITS) \
        .groupBy("segment", "doc_no").agg(
            F.collect_list("spans").alias("lists"), F.collect_set(F.when(~F.col("near"), F.col("item_id"))).alias("items"),
            F.collect_set(F.when(F.col("near"), F.col("item_id"))).alias("near"))
    # An id's place in its segment is the document's number there.
    every = index.select(
        "segment", F.posexplode(F.arrays_zip(
            "doc_ids", F.slice("doc_starts", F.lit(1), F.size("doc_ids")).alias("lo"),
            F.slice("doc_starts", F.lit(2), F.size("doc_ids")).alias("hi"))).alias("doc_no", "doc")) \
        .select("segment", "doc_no", F.col("doc.doc_ids").alias("doc_id"), (F.col("doc.hi") - F.col("doc.lo")).alias("n_words"))
    out = ("doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, "
           "n_near long, near_sha256 string")
    found = every.join(per_doc, ["segment", "doc_no"], "left") \
        .select("doc_id", "n_words", "lists", "items", "near").mapInArrow(_digest, out)
    return found if span else found.drop("n_near", "near_sha256")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """``docs``, all columns, without the rows that hold a window of an item;
    rows that share an id, or have none, are judged one by one."""
    rows, row = numbered(docs, "leaks-rows")
    found = decontaminate(rows.select(F.col(row).alias("doc_id"), "text"), benchmark, window)
    bad = found.where("contaminated").select(F.col("doc_id").alias(row))
    return rows.join(bad, row, "left_anti").select(*docs.columns)
