import random
import zlib

import numpy as np
import pytest

from streamledger.llm import toxicity
from streamledger.llm.queries import op8_toxicity

WORDS = ["idiot", "stupid", "scum", "worthless"]


def brute_counts(texts):
    out = np.zeros(toxicity.CLASSES ** 3, np.int64)
    raw = b" " + b"  ".join(t.encode() for t in texts) + b" "
    c = [int(toxicity._CLASS[b]) for b in raw]
    for x, y, z in zip(c, c[1:], c[2:]):
        out[(x * 64 + y) * 64 + z] += 1
    return out


def disguise(rnd, w):
    kind = rnd.randrange(4)
    if kind == 0:
        return "".join({"i": "1", "o": "0", "s": "$", "e": "3", "t": "7"}.get(c, c) for c in w)
    if kind == 1:
        return " ".join(w)
    if kind == 2:
        return "".join(c * rnd.choice([1, 4]) for c in w)
    return ".".join(w)


@pytest.fixture(scope="module")
def corpus():
    rnd = random.Random(5)
    syllables = "ba ne ro ti lu ka mo se di fa pi st ou".split()
    vocab = ["".join(rnd.choices(syllables, k=rnd.randint(1, 4))) for _ in range(500)]
    docs, labels = [], []
    for i in range(900):
        ws = rnd.choices(vocab, k=rnd.randint(5, 40))
        toxic = rnd.random() < .25
        if toxic:
            bad = rnd.sample(WORDS, 2)
            hide = i >= 500
            for w in bad:
                ws.insert(rnd.randrange(len(ws)), disguise(rnd, w) if hide else w)
        docs.append((i, " ".join(ws)))
        if i < 500 or zlib.crc32(str(i).encode()) % 5 == 0:
            labels.append((i, 1, int(toxic)))
    return docs, labels


def frames(spark, docs, labels):
    return (spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_letter_counts_cover_everything(spark):
    texts = ["Été 12 abc", "", "x" * 50, "long " * 9000, None]
    df = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    got = np.zeros(toxicity.CLASSES ** 3, np.int64)
    for r in toxicity.letter_counts(df).collect():
        got[r.trigram] = r.n
    assert (got == brute_counts([t or "" for t in texts])).all()


def test_disguises_are_restored_and_scored(spark, corpus):
    d, l = frames(spark, *corpus)
    model = toxicity.train(d, l)
    decoder = toxicity.Decoder(model.cost)
    assert "stupid" in toxicity.readings("s7up1d", decoder)
    assert "idiot" in toxicity.readings("iiiidiooot", decoder)
    assert "scum" in toxicity.readings("$cum", decoder)
    assert "worthless" in toxicity.readings("w.o.r.t.h.l.e.s.s", decoder)
    assert toxicity.set_apart("so s t u p i d , yes") == ["stupid,"] or "stupid" in toxicity.set_apart(
        "so s t u p i d, yes")[0]
    truth = {i: t for i, _, t in corpus[1]}
    got = {r.doc_id: r for r in toxicity.score(d, model).collect()}
    held = [(got[i].predicted, t) for i, t in truth.items() if got[i].held_out]
    right = sum(p == t for p, t in held) / len(held)
    assert len(held) > 100 and right > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= .5) for r in got.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())


@pytest.fixture(scope="module")
def model(spark, corpus):
    return toxicity.train(*frames(spark, *corpus))


def test_no_gate_before_the_lattice(spark, model):
    decoder = toxicity.Decoder(model.cost)
    for token, word in [("iiddiioott", "idiot"), ("stuupid", "stupid"), ("sccum", "scum"), ("stupid", "stupid")]:
        assert word in toxicity.readings(token, decoder)
    for text, word in [("i. d. i. o. t", "idiot"), ("so a s s", "ass"), ("s  t  u  p  i  d..", "stupid"),
                       ("ii - s s t t u u p p i i d d", "stupid"), ("s.c.u.m", "scum"), ("--s c u m", "scum")]:
        found = toxicity.document_words(text, decoder, {})
        assert any(word in x for x in [*(w for t in found[0] for w in t), *found[1]]), text
    for text in ("dog a b", "a-b", "ab c d", "no such thing", ". . .  -", "a     b     c"):
        assert toxicity.document_words(text, decoder, {})[1] == []


def test_spaced_words_within_a_run(spark):
    raw = lambda w: toxicity.features(w)[0]
    weights = {raw("stupid"): 3.0, raw("man"): 1.0, toxicity.features("scummy")[1]: 2.0}
    weigh = lambda x: toxicity.spelled_weight(x, weights, [3, 4, 6])
    assert weigh("stupidman") == weigh("astupidman") == weigh("stupid") == 3.0
    assert weigh("aman") == 1.0 and weigh("ascumx") == 2.0 and weigh("st") == 0.0
    got = toxicity.spelled_features("stupidman")
    assert {raw(w) for w in ("stupid", "man", "stupidman", "upid")} <= set(got)
    assert all(got[raw(w)] == (raw(w), len(w)) for w in ("stupid", "man"))


def test_spaced_words_score(spark, model):
    filler = "banero tilu kamo sedi fapi "
    hidden = ["i d i o t s t u p i d m a n", "iiddiioott stuupid", "i. d. i. o. t s. t. u. p. i. d",
              "s t u p i d m a n and i d i o t s a l l"]
    df = spark.createDataFrame(list(enumerate([filler + h for h in hidden] + [filler])), "doc_id long, text string")
    got = {r.doc_id: r.score for r in toxicity.score(df, model).collect()}
    assert min(got[k] for k in range(4)) > got[4]


def test_long_runs_of_marks_take_no_time():
    import time
    began = time.time()
    for text in ("." * 5000 + "x1", "a " + "-" * 5000 + "bc", "a." * 5000 + "bc", "x " * 5000 + "yz", ". " * 5000 + "yz"):
        toxicity.set_apart(text)
    assert time.time() - began < 5


def test_held_out_labels_are_never_read(spark, corpus):
    docs, labels = corpus
    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]
    one, two = (sorted(map(tuple, toxicity.score(d, toxicity.train(d, l)).collect()))
                for d, l in (frames(spark, docs, labels), frames(spark, docs, flipped)))
    assert one == two


def test_viterbi_finds_the_cheapest_reading():
    rnd = np.random.default_rng(0)
    cost = rnd.uniform(0.1, 6, (64, 64, 64)).astype(np.float32)
    decoder = toxicity.Decoder(cost)

    def every(token, at, text, price):
        if at == len(token):
            yield price, text
        else:
            arcs, end = decoder.arcs(token, at)
            for letters, c in arcs:
                yield from every(token, end, text + letters, price + c)

    def total(price, text):
        c = [0, 0, *decoder._classes(text), 0]
        return price + sum(float(cost[x, y, z]) for x, y, z in zip(c, c[1:], c[2:]))

    for token in ("1d10t", "a$$", "s-t.u_p", "bb66aaa!", "x", "plain", "ünder5core", "ab00ba"):
        ranked = [t for _, t in sorted((total(p, t), t) for p, t in every(token, 0, "", 0.0))]
        assert decoder.best(token) == ranked[:3]


def test_long_tokens_are_decoded_whole(model):
    import time
    decoder, began = toxicity.Decoder(model.cost), time.time()
    for middle in (120, 5000):
        found = decoder.best("ba" * middle + "s7up1d" + "ba" * middle)
        assert len(found) == 3 and any("stupid" in t for t in found)
    assert len(decoder.best("a1" * 5000)) == 3 and time.time() - began < 20


def test_scores_equal_a_plain_scorer(spark, corpus, model):
    docs = corpus[0][600:790] + [(5000 + i, t) for i, t in enumerate(
        ["", "i d i o t s t u p i d", "s7up1d !!!", "iiii", "a" * 700 + "1d10t", "ünï $cum", "x", "4ss a.s.s", "\u3000", "sc\num"])]
    decoder, weights = toxicity.Decoder(model.cost), dict(zip(model.keys.tolist(), model.values.tolist()))

    def plain(text):
        low, found = text.lower(), [0.0, 0.0]
        for token in set(low.split()):
            found.append(max((weights.get(f, 0.0) for w in toxicity.readings(token, decoder) for f in toxicity.features(w)), default=0.0))
        found += [toxicity.spelled_weight(x, weights, model.sizes) for x in toxicity._apart(low, decoder)]
        x = sorted(found)[-2:]
        return 1 / (1 + np.exp(-(model.weights[0] + model.weights[1] * x[1] + model.weights[2] * x[0])))
    got = {r.doc_id: r.score for r in toxicity.score(spark.createDataFrame(docs, "doc_id long, text string"), model).collect()}
    assert len(got) == 200 and all(abs(got[i] - plain(t)) < 1e-12 for i, t in docs)


def test_labels_other_than_0_and_1(spark, corpus):
    docs, labels = corpus
    loud = [(i, q, 7 * t) for i, q, t in labels]
    one, two = (sorted(map(tuple, toxicity.score(d, toxicity.train(d, l)).collect()))
                for d, l in (frames(spark, docs, labels), frames(spark, docs, loud)))
    assert one == two


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (None, "scum scum"), (3, "!" * 5000), (4, "a1" * 3000), (5, "x " * 20000)]
    docs = spark.createDataFrame([(*r, 7, "z") for r in rows], "doc_id long, text string, score int, toxic string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    out = toxicity.score(docs, toxicity.train(docs, none)).collect()
    assert len(out) == 6 and all(r.predicted == 0 for r in out)
    assert not [r for r in out if r.doc_id is None][0].held_out
    assert toxicity.score(docs.limit(0), toxicity.train(docs.limit(0), none)).collect() == []


def test_query_on_table(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in op8_toxicity(spark, sf).collect()}
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    held = [(got[r.doc_id].predicted, r.toxic) for r in spark.read.parquet(f"{sf}/labels.parquet").collect()
            if got[r.doc_id].held_out]
    assert sum(p == t for p, t in held) / len(held) > 0.9


def feature_batch(rows):
    import pyarrow as pa
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()),
         pa.array([r[2] for r in rows], pa.list_(pa.list_(pa.string()))), pa.array([r[3] for r in rows], pa.list_(pa.string()))],
        ["toxic", "half", "tokens", "apart"])


def test_features_of_many_rows_are_counted_in_bounded_memory(monkeypatch):
    """Rows with many features: a task passes them on in parts, and their sums are
    those of every row at once."""
    import tracemalloc
    monkeypatch.setattr(toxicity, "_HELD", 1 << 14, raising=False)
    rnd = random.Random(3)
    rows = [(rnd.randrange(2), rnd.randrange(2), [["word", rnd.choice(["words", "wording"])]] * (k % 3), ["".join(rnd.choices("abcdefghij", k=200)), "st"][:k % 4])
            for k in range(75)]
    found = lambda: toxicity._feature_rows()(feature_batch(rows[at:at + 25]) for at in (0, 25, 50))
    tracemalloc.start()
    try:
        n = sum(1 for _ in found())
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 40 << 20 and n > 1
    got, size = {}, {}
    for part in found():
        for f, c0, t0, c1, t1, least, most, k in zip(*(c.to_pylist() for c in part.columns)):
            a = got.setdefault(f, [0, 0, 0, 0, least, most])
            got[f] = [*(x + y for x, y in zip(a, (c0, t0, c1, t1))), min(a[4], least), max(a[5], most)]
            assert size.setdefault(f, k) == k
    want = {}
    for toxic, half, tokens, apart in rows:
        held = {}
        for letters in apart:
            held |= {f: word for f, (word, _) in toxicity.spelled_features(letters).items()}
        words = {w for t in tokens for w in t}
        for w in reversed(list(words)):
            held |= dict.fromkeys(toxicity.features(w), toxicity.features(w)[0])
        for f, word in held.items():
            a = want.setdefault(f - (1 << 64) if f >> 63 else f, [0, 0, 0, 0, (1 << 63) - 1, -1])
            a[half * 2 + toxic] += 1
            if toxic:
                a[4:] = min(a[4], word >> 1), max(a[5], word >> 1)
    assert got == want


def test_few_readings_need_no_search(model, monkeypatch):
    decoder, rnd = toxicity.Decoder(model.cost), random.Random(8)
    tokens = ["".join(rnd.choices("aabst150$@!|.-_#éß", k=rnd.randint(1, 7))) for _ in range(3000)]
    assert all(set(decoder.likely(t)) == set(decoder.best(t)) for t in tokens)
    searched = []
    monkeypatch.setattr(decoder, "best", lambda token, n=3: searched.append(token) or [])
    for token, words in [("missed", {"missed", "mised"}), ("missed,", {"missed", "mised"}), ("ab-cd", {"ab", "cd", "abcd"}),
                         ("sooo!", {"so", "soo", "sooo"}), ("plain...", {"plain"}), ("...", set())]:
        assert toxicity.readings(token, decoder) == words and not searched
    toxicity.readings("coffee", decoder)
    assert searched == ["coffee"]


def test_words_share_what_their_beginning_gives(monkeypatch):
    rnd, hashed = random.Random(9), []
    words = ["".join(rnd.choices("abé", k=rnd.randint(1, 9))) for _ in range(2000)]
    weights = {f: rnd.random() for w in words[:300] for f in toxicity.features(w) if rnd.random() < .5}
    plain = [max(weights.get(f, 0.0) for f in toxicity.features(w)) for w in words]
    weigh = toxicity._weigher(weights)
    assert [weigh(w) for w in words] == plain
    monkeypatch.setattr(toxicity, "_CACHE", 7)
    weigh = toxicity._weigher(weights)
    assert [weigh(w) for w in words] == plain
    real = toxicity.xxhash.xxh64_intdigest
    monkeypatch.setattr(toxicity.xxhash, "xxh64_intdigest", lambda raw: hashed.append(raw) or real(raw))
    weigh = toxicity._weigher(weights)
    for w in ("abcdefg", "abcdefgh", "abcdefi"):
        weigh(w)
    assert len(hashed) == 3 + 3


def test_a_scorer_keeps_little_and_scores_alike(corpus, model, monkeypatch):
    texts = [t for _, t in corpus[0][450:800]] + ["", "i d i o t " + "ab" * 90, "s7up1d", "s7up1d s7up1d $cum..."]
    parts = (model.cost, model.keys, model.values, model.sizes)
    one = list(map(toxicity._scorer(*parts), texts))
    monkeypatch.setattr(toxicity, "_SEEN", 20)
    assert list(map(toxicity._scorer(*parts), texts)) == one and len(set(one)) > 5
