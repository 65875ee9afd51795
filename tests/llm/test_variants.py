import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

from streamledger.llm import variants as V
from tests.conftest import SF_SMALL


def brute_words(docs, every=97):
    counts = Counter()
    for ident, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if ident is None else ident}:{run}".encode())
            counts[run[:h % len(run)] + run[h % len(run) + 1:] if h % every == 0 else run] += 1
    return counts


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(docs, least=5, seen=3, factor=2):
    counts = {w: n for w, n in brute_words(docs).items() if len(w) >= least and n >= seen}
    near = defaultdict(set)
    by_size = defaultdict(list)
    for w in counts:
        by_size[len(w)].append(w)
    for size, group in by_size.items():
        for a in group:
            for b in group + by_size.get(size + 1, []):
                if one_edit(a, b):
                    near[a].add(b)
                    near[b].add(a)

    def form(w):
        best = min(near[w], key=lambda o: (-counts[o], o), default=None)
        return best if best and counts[best] >= factor * counts[w] else None

    def root(w):
        while form(w):
            w = form(w)
        return w
    return {(w, form(w), root(w), n, len(near[w]), counts[form(w)] if form(w) else None) for w, n in counts.items()}


def made(spark, docs):
    return spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, word string")


def test_equals_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = V.variants(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert {tuple(r) for r in got.collect()} == brute(docs)


def test_crowded_buckets_lose_nothing(spark):
    rng = random.Random(5)
    docs = [(i, " ".join("".join(rng.choice("abé") for _ in range(rng.randint(4, 8))) for _ in range(400)))
            for i in range(12)]
    docs += [(None, "Straße ÀÉÎ×÷ abababab " * 5), (3, None), (3, ""), (None, None), (None, "a-b_c1d " * 3)] + docs[:3]
    expected = brute(docs)
    assert any(e[1] for e in expected)
    for crowd in (1, 8, 1 << 20):
        assert {tuple(r) for r in V.variants(made(spark, docs), crowd=crowd).collect()} == expected


def test_empty_table(spark):
    assert V.variants(made(spark, [])).count() == 0
    assert V.variants(made(spark, [(1, None), (2, "12 34 -")])).count() == 0


def test_counts_of_runs_are_exact():
    docs = [(7, "Zoë zoë ZOË x" * 3), (8, ""), (9, "b" * 5000 + " " + "é" * 300 + " tail"), (10, "Ѐabc一d")]
    for every in (1, 2, 97):
        table = V.count_runs([i for i, _ in docs], [t.encode() for _, t in docs], every)
        got = Counter()
        for word, n in zip(table.column("word").to_pylist(), table.column("n").to_pylist()):
            got[word] += n
        assert got == brute_words(docs, every)


def test_words_one_edit_apart_share_a_signature():
    rng = np.random.default_rng(2)
    letters = list("abcdeé")
    for _ in range(300):
        size = int(rng.integers(5, 12))
        word = "".join(rng.choice(letters, size))
        at = int(rng.integers(size))
        other = {0: word[:at] + rng.choice(letters) + word[at + 1:], 1: word[:at] + word[at + 1:],
                 2: word[:at] + rng.choice(letters) + word[at:]}[int(rng.integers(3))]
        if one_edit(word, other):
            a, b = ({(int(s[0]), side) for s, side in V.word_signatures([w], len(w), 5, 3)} for w in (word, other))
            meets = {(s, 0) for s, side in a & b if side == 0}
            meets |= {s for s, side in a if side == 1} & {s for s, side in b if side == 2}
            meets |= {s for s, side in a if side == 2} & {s for s, side in b if side == 1}
            assert meets, (word, other)


def test_roots_follow_long_chains(spark):
    rows = [(f"w{i}", f"w{i + 1}" if i < 40 else None) for i in range(41)]
    formed = spark.createDataFrame(rows, "word string, form string")
    assert {tuple(r) for r in V.roots(formed).collect()} == {(f"w{i}", "w40") for i in range(40)}
