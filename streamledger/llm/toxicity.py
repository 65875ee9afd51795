"""Toxicity scores of texts whose words may be disguised.

1. ``letter_counts`` counts byte-class trigrams over every document; they make
   the character language model.
2. A disguised word (leetspeak, letters set apart, repeated letters) is a
   noisy-channel problem: ``Decoder`` lays out a lattice of what each character
   may stand for and finds the most likely letters by Viterbi search under the
   language model.  Every token with a mark, a digit or a letter twice in a row
   is decoded, and every run of letters set apart.
3. Restored words and their prefixes are the features; a prefix counts only if
   more than one word brought it into toxic rows.  Letters set apart may be
   several words: their stretches count as words wherever they start and end
   (of up to ``_SPELLED`` letters while features are counted, and of any length
   that a known word has after that).  How much a feature
   speaks for toxicity is counted on labelled rows; a logistic regression turns
   a document's two strongest words into a score.

Labels are read only for ids with crc32(id as text) mod 5 not 0.  The
regression is fitted on rows whose features were counted on the other half of
the labelled rows; the final counts are taken from both halves.  The number of
labelled rows is bounded by ``max_rows`` (lowest hash of the id first), a fixed
sample whatever the corpus; each is decoded once.

Definitions: null text is empty; an empty text has no features and gets the
regression's base score; without labelled rows of both kinds the regression is
its prior.  A null ``doc_id`` is not held out.  A ``toxic`` above 0 is toxic;
several labels of one id: toxic if any says so.  A token of any length is
decoded whole; a word set apart has up to ``_SPELLED`` letters unless it is known
from elsewhere.  Extra columns are ignored.
"""

from __future__ import annotations

import heapq
import math
import re
from operator import itemgetter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, small_batches

CLASSES = 64
MAX_ROWS = 20_000
_PREFIXES = (4, 5, 6)
_SHRINK = 4.0
_CACHE = 120_000        # tokens whose readings a task keeps
_SEEN = 400_000         # tokens whose evidence a task keeps
_LONG = 64              # letters of a token that is kept
_HELD = 1 << 19         # features, or words, that a task holds at once
_ROWS = 16              # rows whose words are Python objects at once
_OUT = 1 << 16          # rows of an Arrow batch of features
_SPELLED = 64           # letters of a word set apart, where words aren't known yet

# What a character may stand for.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b",
        "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l"}
# Costs in nats of a substitution, a dropped mark, a shortened run, a kept run.
_SUBSTITUTE, _DROP, _SHORTEN, _KEEP_RUN = 1.0, 0.7, 0.5, 3.0
_BY_COST = itemgetter(0)


# ------------------------------------------------------- the language model

def _class_table() -> np.ndarray:
    """Byte -> class: a-z 1-26, UTF-8 bytes 27-62, digits 63, all else 0."""
    out = np.zeros(256, np.uint8)
    for c in range(26):
        out[97 + c] = out[65 + c] = 1 + c
    for b in range(128, 192):
        out[b] = 27 + b % 24
    for b in range(192, 256):
        out[b] = 51 + b % 12
    out[48:58] = 63
    return out


_CLASS = _class_table()


def letter_counts(docs: DataFrame) -> DataFrame:
    """(trigram, n): byte-class trigrams of all texts; at most CLASSES**3 rows."""
    def task(batches):
        total = np.zeros(CLASSES ** 3, np.int64)
        for batch in batches:
            raw = b" " + b"  ".join((t.as_py() or "").encode() for t in batch.column("text")) + b" "
            for lo in range(0, len(raw), 1 << 20):
                c = _CLASS[np.frombuffer(raw[max(lo - 2, 0):lo + (1 << 20)], np.uint8)].astype(np.int32)
                total += np.bincount((c[:-2] << 12) | (c[1:-1] << 6) | c[2:], minlength=CLASSES ** 3)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["trigram", "n"])

    return small_batches(docs).select(F.col("text").cast("string").alias("text")) \
        .mapInArrow(task, "trigram int, n long").groupBy("trigram").agg(F.sum("n").alias("n"))


def language_model(counts: np.ndarray) -> np.ndarray:
    """-log P(class | two classes before), interpolated with shorter contexts."""
    n3 = counts.reshape(CLASSES, CLASSES, CLASSES).astype(np.float64)
    n2, n1 = n3.sum(0), n3.sum((0, 1))
    p1 = (n1 + 1) / (n1.sum() + CLASSES)
    p2 = (n2 + 8 * p1) / (n2.sum(1, keepdims=True) + 8)
    p3 = (n3 + 8 * p2) / (n3.sum(2, keepdims=True) + 8)
    return (-np.log(p3)).astype(np.float32)


class Decoder:
    """Restores words by Viterbi search through a lattice of readings."""

    def __init__(self, cost: np.ndarray):
        self._cost = cost.tolist()
        self._known: dict[str, tuple[int, ...]] = {}

    def _classes(self, letters: str) -> tuple[int, ...]:
        got = self._known.get(letters)
        if got is None:
            got = tuple(_CLASS[np.frombuffer(letters.encode(), np.uint8)].tolist())
            if len(letters) <= 4 and len(self._known) < _CACHE:
                self._known[letters] = got
        return got

    def arcs(self, token: str, at: int) -> tuple[list[tuple[str, float]], int]:
        """Readings of the token from ``at`` up to the next place: (letters,
        cost) each, and that place.  Letters that stand once read as they are."""
        c = token[at]
        end = at + 1
        while end < len(token) and token[end] == c:
            end += 1
        run = end - at
        if c.isalpha():
            if run == 1:
                while end < len(token) and token[end].isalpha() and token[end] != token[end + 1:end + 2]:
                    end += 1
                return [(token[at:end], 0.0)], end
            out = [(c, _SHORTEN), (c + c, 0.0 if run == 2 else _SHORTEN)]
            if run > 2:
                out.append((c * run, _KEEP_RUN))
            return out, end
        out = []
        for letter in LEET.get(c, ""):
            out.append((letter, _SUBSTITUTE))
            if run > 1:
                out.append((letter * 2, _SUBSTITUTE + _SHORTEN))
        out.append((c * run, 0.0) if c.isdigit() else ("", _DROP))
        return out, end

    def best(self, token: str, n: int = 3) -> list[str]:
        """The ``n`` likeliest readings of a lower-case token of any length."""
        table, at = self._cost, 0
        # (two classes before) -> its n best (cost, letters so far, as a chain)
        states = {(0, 0): [(0.0, None)]}
        while at < len(token):
            readings_, at = self.arcs(token, at)
            further: dict[tuple[int, int], list] = {}
            for letters, price in readings_:
                classes = self._classes(letters)
                for (a, b), held in states.items():
                    step = price
                    for c in classes:
                        step += table[a][b][c]
                        a, b = b, c
                    to = further.get((a, b))
                    if to is None:
                        to = further[a, b] = []
                    for cost, before in held:
                        to.append((cost + step, (before, letters)))
            for to in further.values():
                if len(to) > n:
                    to.sort(key=_BY_COST)
                    del to[n:]
            states = further
        ends = sorted(((cost + table[a][b][0], chain) for (a, b), held in states.items() for cost, chain in held), key=_BY_COST)
        out = []
        for _, chain in ends[:n]:
            parts = []
            while chain:
                chain, letters = chain
                parts.append(letters)
            out.append("".join(reversed(parts)))
        return out

    def likely(self, token: str, n: int = 3) -> list[str]:
        """What ``best`` finds, in any order: a lattice of no more than ``n``
        readings needs no search."""
        found: list[list[str]] = [[]]
        at = 0
        while at < len(token):
            readings_, at = self.arcs(token, at)
            if len(readings_) == 1:
                for parts in found:
                    parts.append(readings_[0][0])
            elif len(found) * len(readings_) <= n:
                found = [[*parts, letters] for parts in found for letters, _ in readings_]
            else:
                return self.best(token, n)
        return ["".join(parts) for parts in found]


# ------------------------------------------------------------ words, features

_CORE = re.compile(r"[^\W_](?:.*[^\W_])?", re.S)
_LETTERS = re.compile(r"[^\W\d_]+")
_RUN = re.compile(r"(.)\1")
# Three or more characters with marks or up to three blanks between them.
# Marks and characters differ and blanks are never given back, so the time
# grows with the text even where nothing matches.  A blank comes first, so that
# the search passes over all else at once.
_GAP = r"(?:[ \t]{1,3}+(?:[.\-_*][ \t]{0,3}+)*+|(?:[.\-_*][ \t]{0,3}+)++)"
_SET_APART = re.compile(r"\s[.\-_*]*+(?:[^\s.\-_*]" + _GAP + r"){2,}[^\s.\-_*][.\-_*]*+(?![^\s])")


def readings(token: str, decoder: Decoder) -> set[str]:
    """The words a lower-case token may stand for: its own letters, and what a
    disguise in it hides."""
    if token.isalpha():
        return {token, *decoder.likely(token)} if _RUN.search(token) else {token}
    found = _CORE.search(token)
    lead, core, trail = (token[:found.start()], found.group(), token[found.end():]) if found else (token, "", "")
    out = set(_LETTERS.findall(core))
    hidden = core
    if lead and lead[-1] in LEET and lead[-2:-1] != lead[-1]:
        hidden = lead[-1] + hidden
    if trail and trail[0] in "$@+" and trail[:3] != trail[0] * 3:
        hidden += trail[0] * (2 if trail[:2] == trail[0] * 2 else 1)
    if any(c.isalpha() for c in hidden) and (not hidden.isalpha() or _RUN.search(hidden)):
        out.update(decoder.likely(hidden))
    return out


def set_apart(text: str) -> list[str]:
    """Letters written one by one: ``s t u p i d`` -> ``stupid``."""
    return [re.sub(r"[\s.\-_*]+", "", m.group()) for m in _SET_APART.finditer(" " + text)]


def features(word: str) -> list[int]:
    """Hashes of a word and its prefixes."""
    raw = xxhash.xxh64_intdigest
    out = [raw(("=" + word).encode())]
    out += [raw(("<" + word[:k]).encode()) for k in _PREFIXES if len(word) >= k]
    return out


def feature_sizes(word: str) -> list[int]:
    """Letters of each of a word's features."""
    return [len(word), *(k for k in _PREFIXES if len(word) >= k)]


def spelled_arrays(letters: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes that letters set apart bring in, with the word that brought each
    and the feature's letters: stretches as words, and the prefixes of what is
    left from each letter on.  Of equal hashes the last one counts."""
    raw = xxhash.xxh64_intdigest
    most = max(len(letters) - 2, 0) * (_SPELLED - 2 + len(_PREFIXES))
    found, own, sizes, n = np.empty(most, np.uint64), np.empty(most, np.uint64), np.empty(most, np.int32), 0
    for k in range(len(letters) - 2):
        rest = letters[k:k + _SPELLED]
        words = [raw(("=" + rest[:size]).encode()) for size in range(3, len(rest) + 1)]
        prefixes = [raw(("<" + rest[:size]).encode()) for size in _PREFIXES if len(rest) >= size]
        end = n + len(words) + len(prefixes)
        found[n:end], own[n:end] = words + prefixes, words + [words[-1]] * len(prefixes)
        sizes[n:end] = [*range(3, len(rest) + 1), *_PREFIXES[:len(prefixes)]]
        n = end
    return found[:n], own[:n], sizes[:n]


def spelled_features(letters: str) -> dict[int, tuple[int, int]]:
    """``spelled_arrays`` as hash -> (word, letters)."""
    found, own, sizes = (x.tolist() for x in spelled_arrays(letters))
    return dict(zip(found, zip(own, sizes)))


def spelled_weight(letters: str, weights: dict, sizes: list[int]) -> float:
    """The strongest feature of letters set apart: a word or a prefix anywhere."""
    raw, top = xxhash.xxh64_intdigest, 0.0
    kinds = [("=", size) for size in sizes if size > 2] + [("<", size) for size in _PREFIXES]
    for kind, size in kinds:
        for k in range(len(letters) - size + 1):
            top = max(top, weights.get(raw((kind + letters[k:k + size]).encode()), 0.0))
    return top


def document_words(text: str, decoder: Decoder, cache: dict) -> tuple[list[tuple[str, ...]], list[str]]:
    """The words that each different token of a text may stand for, and the
    text's letters set apart."""
    low = text.lower()
    tokens = []
    for token in sorted(set(low.split())):
        got = cache.get(token)
        if got is None:
            got = tuple(sorted(readings(token, decoder)))
            if len(token) <= _LONG:
                if len(cache) > _CACHE:
                    cache.clear()
                cache[token] = got
        if got:
            tokens.append(got)
    return tokens, _apart(low, decoder)


def _apart(low: str, decoder: Decoder) -> list[str]:
    out: set[str] = set()
    for found in set(set_apart(low)):
        if found.isalpha():
            out.add(found)
        if not found.isalpha() or _RUN.search(found):
            out.update(decoder.likely(found))
    return sorted(out)


# ----------------------------------------------------------------- the model

def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def _by_rows(batches):
    """Batches of few rows, so that few rows' words are Python objects at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            yield batch.slice(at, _ROWS)


def _labelled_words(sent):
    """Labelled rows with their restored words in place of the text."""
    def task(batches):
        decoder, cache = Decoder(sent.value), {}
        for batch in batches:
            found, held, first = [], 0, 0
            for at, t in enumerate(batch.column("text"), 1):
                found.append(document_words(t.as_py() or "", decoder, cache))
                held += len(found[-1][0])
                if held < _HELD and at < batch.num_rows:
                    continue
                rows = batch.slice(first, at - first)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("toxic"), rows.column("half"),
                     pa.array([tokens for tokens, _ in found], pa.list_(pa.list_(pa.string()))),
                     pa.array([apart for _, apart in found], pa.list_(pa.string()))], ["toxic", "half", "tokens", "apart"])
                found, held, first = [], 0, at
    return task


def _counted(f: np.ndarray, counts: list[np.ndarray], least: np.ndarray, most: np.ndarray, size: np.ndarray) -> list[np.ndarray]:
    """One row per feature: sums of the counts, the least and greatest word."""
    by = np.argsort(f, kind="stable")
    f = f[by]
    at = np.flatnonzero(np.append(True, f[1:] != f[:-1]))
    return [f[at], *(np.add.reduceat(c[by], at, dtype=np.int64) for c in counts),
            np.minimum.reduceat(least[by], at), np.maximum.reduceat(most[by], at), size[by][at]]


def _feature_rows():
    """A task's features with the number of clean and toxic rows of either half
    that hold them, and the least and greatest hash of the words that brought
    them into toxic rows.  However many features its rows have, a task holds
    ``_HELD`` or so at once: it counts them together and passes on what has
    piled up, so a feature may have several rows."""
    def document(words: set[str], apart: list[str], hashes: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Features of a row, each once, with the word that brought it and its letters."""
        if len(hashes) > _CACHE:
            hashes.clear()
        held = []
        for w in words:
            h = hashes.get(w)
            if h is None:
                found = features(w)
                h = np.array([found, found[:1] * len(found), feature_sizes(w)], np.uint64)
                if len(w) <= _LONG:
                    hashes[w] = h
            held.append(h)
        whole = np.concatenate(held, axis=1) if held else np.empty((3, 0), np.uint64)
        f, own, size = whole[0], whole[1], whole[2].astype(np.int32)
        if apart:
            spelled = [spelled_arrays(letters) for letters in reversed(apart)]
            f, own, size = (np.concatenate([x, *(y[k][::-1] for y in spelled)]) for k, x in enumerate((f, own, size)))
        f, at = np.unique(f, return_index=True)
        return f, own[at], size[at]

    def table(raw: list, kept: list | None) -> list[np.ndarray]:
        """Rows of features, counted together with what is counted already."""
        f = np.concatenate([x[0] for x in raw])
        w = (np.concatenate([x[1] for x in raw]) >> np.uint64(1)).view(np.int64)
        m = np.repeat(np.array([x[3] for x in raw], np.int8), [len(x[0]) for x in raw])
        size, toxic = np.concatenate([x[2] for x in raw]), m % 2 == 1
        new = _counted(f, [m == k for k in range(4)], np.where(toxic, w, np.iinfo(np.int64).max), np.where(toxic, w, -1), size)
        if kept is None:
            return new
        f, *counts, least, most, size = (np.concatenate(x) for x in zip(kept, new))
        return _counted(f, counts, least, most, size)

    def batches_of(found: list[np.ndarray]):
        whole = pa.RecordBatch.from_arrays(
            [pa.array(found[0].view(np.int64)), *map(pa.array, found[1:])],
            ["feature", "c0", "t0", "c1", "t1", "least", "most", "size"])
        for at in range(0, whole.num_rows, _OUT):
            yield whole.slice(at, _OUT)

    def task(batches):
        hashes: dict[str, np.ndarray] = {}
        raw, n, kept = [], 0, None
        for batch in _by_rows(batches):
            for tokens, apart, toxic, half in zip(*(batch.column(c).to_pylist() for c in ("tokens", "apart", "toxic", "half"))):
                words = {w for t in tokens for w in t}
                if not words and not apart:
                    continue
                f, own, size = document(words, apart, hashes)
                if not len(f):
                    continue
                raw.append((f, own, size, half * 2 + toxic))
                n += len(f)
                if n >= _HELD:
                    kept, raw, n = table(raw, kept), [], 0
                    if len(kept[0]) >= _HELD:
                        yield from batches_of(kept)
                        kept = None
        if raw:
            kept = table(raw, kept)
        if kept is not None:
            yield from batches_of(kept)
    return task


def _evidence(toxic: np.ndarray, clean: np.ndarray, prior: float) -> np.ndarray:
    """Log odds of a feature's documents, shrunk to the prior, over the prior's."""
    p = (toxic + _SHRINK * prior) / (toxic + clean + _SHRINK)
    return np.log(p / (1 - p)) - math.log(prior / (1 - prior))


def _top_two(found: list[float], apart: list[str], weights: dict, sizes: list[int]) -> tuple[float, float]:
    """The two strongest of the words' evidence and that of letters set apart."""
    top = heapq.nlargest(2, found + [spelled_weight(letters, weights, sizes) for letters in apart]) + [0.0, 0.0]
    return top[0], top[1]


def _weigher(weights: dict):
    """A function that gives the strongest of a word's ``features``.  It keeps
    what a word's beginning gives, which many words share."""
    raw, get, starts = xxhash.xxh64_intdigest, weights.get, {}
    least, most = _PREFIXES[0], _PREFIXES[-1]

    def weigh(word: str) -> float:
        top = get(raw(("=" + word).encode()), 0.0)
        if len(word) < least:
            return top
        start = word[:most]
        e = starts.get(start)
        if e is None:
            e = max(get(raw(("<" + start[:k]).encode()), 0.0) for k in _PREFIXES if len(start) >= k)
            if len(starts) >= _CACHE:
                starts.clear()
            starts[start] = e
        return e if e > top else top
    return weigh


def _scorer(cost: np.ndarray, keys: np.ndarray, values: np.ndarray, sizes: list[int]):
    """A function that gives the evidence of a text's two strongest words.  It
    keeps the evidence of tokens, as a mere set of those that have none."""
    decoder, weights = Decoder(cost), dict(zip(keys.tolist(), values.tolist()))
    weigh, cache, without = _weigher(weights), {}, set()

    def strongest(text: str) -> tuple[float, float]:
        low = text.lower()
        found = []
        for token in set(low.split()) - without:
            e = cache.get(token)
            if e is None:
                e = max(map(weigh, readings(token, decoder)), default=0.0)
                if len(token) <= _LONG:
                    if len(cache) + len(without) > _SEEN:
                        cache.clear()
                        without.clear()
                    if e:
                        cache[token] = e
                    else:
                        without.add(token)
            if e:
                found.append(e)
        return _top_two(found, _apart(low, decoder), weights, sizes)
    return strongest


def _summaries(sent, columns: list[str]):
    """Rows with the two strongest evidences in place of the text."""
    def task(batches):
        strongest = _scorer(*sent.value)
        for batch in batches:
            tops = [strongest(t.as_py() or "") for t in batch.column("text")]
            x = np.array(tops, np.float64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), pa.array(x[:, 0]), pa.array(x[:, 1])],
                [*columns, "x1", "x2"])
    return task


def _labelled_summaries(sent):
    """The same for labelled rows, whose words are restored already."""
    def task(batches):
        keys, values, sizes = sent.value
        weights = dict(zip(keys.tolist(), values.tolist()))
        weigh, seen = _weigher(weights), {}

        def known(word: str) -> float:
            e = seen.get(word)
            if e is None:
                e = weigh(word)
                if len(word) <= _LONG:
                    if len(seen) > _CACHE:
                        seen.clear()
                    seen[word] = e
            return e

        for batch in _by_rows(batches):
            tops = []
            for tokens, apart in zip(batch.column("tokens").to_pylist(), batch.column("apart").to_pylist()):
                found = [known(t[0]) if len(t) == 1 else max(map(known, t)) for t in tokens]
                tops.append(_top_two([e for e in found if e], apart, weights, sizes))
            x = np.array(tops, np.float64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), pa.array(x[:, 0]), pa.array(x[:, 1])], ["toxic", "x1", "x2"])
    return task


def _fit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps, with a Gaussian prior around plain
    weights, so that a handful of rows can't mislead it."""
    prior = np.array([-4.0, 1.0, 1.0])
    w = prior.copy()
    x = np.column_stack([np.ones(len(x)), x])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + (w - prior)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.eye(3), grad)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w


class Model:
    """Language model, feature evidence, the features' lengths and regression weights."""

    def __init__(self, cost: np.ndarray, keys: np.ndarray, values: np.ndarray, sizes: list[int], weights: np.ndarray):
        self.cost, self.keys, self.values, self.sizes, self.weights = cost, keys, values, sizes, weights


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    """Language model from all of ``docs``; the rest from labelled rows."""
    spark = docs.sparkSession
    counts = np.zeros(CLASSES ** 3, np.int64)
    gathered = letter_counts(docs).toArrow()        # at most CLASSES**3 rows
    counts[gathered.column("trigram").to_numpy()] = gathered.column("n").to_numpy()
    cost = language_model(counts)

    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("toxic") > 0).cast("int").alias("toxic")) \
        .where("toxic is not null and doc_id is not null").where(~held_out(F.col("doc_id"))) \
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows) \
        .withColumn("half", F.pmod(F.xxhash64(F.lit("half"), F.col("doc_id")), F.lit(2)).cast("int"))
    texts = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    total = chosen.groupBy("half", "toxic").count().collect()
    n = {(r.half, r.toxic): r["count"] for r in total}
    # Every labelled text is decoded once.
    rows = texts.join(chosen, "doc_id").select("text", "toxic", "half").mapInArrow(
        _labelled_words(spark.sparkContext.broadcast(cost)),
        "toxic int, half int, tokens array<array<string>>, apart array<string>")
    rows = materialize(rows, "toxicity-labelled")
    schema = "feature long, c0 long, t0 long, c1 long, t1 long, least long, most long, size int"
    toxic, clean = (sum(n.get((h, k), 0) for h in (0, 1)) for k in (1, 0))
    prior = (toxic + 0.5) / (toxic + clean + 1)
    table = rows.mapInArrow(_feature_rows(), schema).groupBy("feature") \
        .agg(*(F.sum(c).alias(c) for c in ("c0", "t0", "c1", "t1")),
             F.min("least").alias("least"), F.max("most").alias("most"), F.max("size").alias("size")) \
        .where("t0 + t1 >= 2") \
        .where("least != most or least = shiftrightunsigned(feature, 1)") \
        .where((F.col("t0") + F.col("t1") + _SHRINK * prior) / F.expr(f"t0 + t1 + c0 + c1 + {_SHRINK}") > 2 * prior) \
        .toArrow()          # words and prefixes of toxic rows among max_rows, seen twice at least
    f, c0, t0, c1, t1, size = (table.column(c).to_numpy() for c in ("feature", "c0", "t0", "c1", "t1", "size"))
    sizes = np.unique(size).tolist()
    f = f.view(np.uint64)

    def kept(e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return f[e > 0.5], e[e > 0.5]

    # Each half's rows are summed up by the counts of the other half.
    parts = []
    for half, (t, c) in enumerate(((t1, c1), (t0, c0))):
        other = (n.get((1 - half, 1), 0) + 0.5) / (n.get((1 - half, 1), 0) + n.get((1 - half, 0), 0) + 1)
        sent = spark.sparkContext.broadcast((*kept(np.where(t >= 1, _evidence(t, c, other), 0.0)), sizes))
        parts.append(rows.where(F.col("half") == half).select("tokens", "apart", F.col("toxic").cast("long").alias("toxic"))
                     .mapInArrow(_labelled_summaries(sent), "toxic long, x1 double, x2 double"))
    fit = parts[0].union(parts[1]).toArrow()         # at most max_rows rows
    x = np.column_stack([fit.column(c).to_numpy() for c in ("x1", "x2")])
    y = fit.column("toxic").to_numpy().astype(float)
    by = np.lexsort((y, x[:, 1], x[:, 0]))           # sums in one order, so reruns agree
    weights = _fit(x[by], y[by])
    return Model(cost, *kept(_evidence(t0 + t1, c0 + c1, prior)), sizes, weights)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    sent = docs.sparkSession.sparkContext.broadcast((model.cost, model.keys, model.values, model.sizes))
    tops = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(_summaries(sent, ["doc_id"]), "doc_id long, x1 double, x2 double")
    b, w1, w2 = map(float, model.weights)
    value = 1 / (1 + F.exp(-(F.lit(b) + w1 * F.col("x1") + w2 * F.col("x2"))))
    return tops.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), value.alias("score")) \
        .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is below ``threshold``."""
    sent = docs.sparkSession.sparkContext.broadcast((model.cost, model.keys, model.values, model.sizes))
    b, w1, w2 = map(float, model.weights)

    def task(batches):
        strongest = _scorer(*sent.value)
        for batch in batches:
            tops = (strongest(t.as_py() or "") for t in batch.column("text"))
            clean = [1 / (1 + math.exp(-(b + w1 * x + w2 * y))) < threshold for x, y in tops]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return small_batches(docs).mapInArrow(task, docs.schema)
