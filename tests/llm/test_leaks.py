import hashlib
import random

import numpy as np
import pytest

from streamledger.llm import leaks
from streamledger.llm.queries import op9_decontamination

from . import brute

COLS = "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"
NEAR = (*COLS, "n_near", "near_sha256")


def rows(df, cols=COLS):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


def corpus(seed):
    rnd = random.Random(seed)
    vocab = ["the", "of", "É", "x1", "日本"] + ["w%d" % k for k in range(60)]
    say = lambda k: rnd.choices(vocab, [40, 30, 5, 5, 5] + [1] * 60, k=k)
    items = [(i, say(rnd.choice([1, 3, 9, 10, 25]))) for i in range(25)]
    docs = []
    for i in range(60):
        ws = say(rnd.randint(0, 60))
        if rnd.random() < .6:
            src = rnd.choice(items)[1]
            lo = rnd.randint(0, max(0, len(src) - 10))
            ws[len(ws) // 2:len(ws) // 2] = src[lo:lo + rnd.randint(8, 14)]
        docs.append((i, rnd.choice([" ", "--", "\n"]).join(w.upper() if rnd.random() < .2 else w for w in ws)))
    items = [(i, ", ".join(w)) for i, w in items]
    return (docs + [(100, None), (101, ""), (None, items[4][1]), (3, docs[5][1]), (3, docs[5][1])],
            items + [(900, None), (901, "..."), (None, "w1"), (7, "w2 w3 w4"), (7, "w2 w3 w4")])


@pytest.mark.parametrize("seed,segment,block", [(1, 1 << 20, 1 << 20), (2, 300, 200), (3, 1, 1 << 20)])
def test_matches_brute_force(spark, seed, segment, block):
    docs, items = corpus(seed)
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    assert rows(leaks.decontaminate(d, b, 10, None, segment, block)) == sorted(
        brute.decontaminate(docs, items, 10), key=str)


@pytest.mark.parametrize("seed,window,span,segment,block", [(1, 10, 12, 1 << 20, 1 << 20), (2, 4, 7, 300, 200)])
def test_near_columns_against_brute_force(spark, monkeypatch, seed, window, span, segment, block):
    monkeypatch.setattr(leaks, "_CANDIDATES", 50)
    docs, items = corpus(seed)
    d = spark.createDataFrame([(k, t) for k, (_, t) in enumerate(docs)], "doc_id long, text string").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    got = leaks.decontaminate(d, b, window, span, segment, block)
    want = {}
    for k, i, _ in near_by_brute_force([(k, t) for k, (_, t) in enumerate(docs)], [x for x in items if x[0] is not None], window, span):
        want.setdefault(k, set()).add(str(i))
    for r in got.collect():
        ids = sorted(want.get(r.doc_id, ()))
        assert (r.n_near, r.near_sha256) == (len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest())
        assert r.n_near >= r.n_items
    assert rows(got) == rows(leaks.decontaminate(d, b, window, None, segment, block))
    with pytest.raises(ValueError):
        leaks.decontaminate(d, b, 10, 9)


def test_equal_benchmark_rows_are_sent_once(spark):
    b = spark.createDataFrame([(1, "a b c")] * 500 + [(2, "a b c")], "item_id long, text string")
    d = spark.createDataFrame([(1, "x a b c y"), (2, "c z a b"), (3, "c a")], "doc_id long, text string")
    sent = []
    index = leaks.materialize(leaks.build_index(d), "leaks-test")
    leaks._by_block(index, b, 1 << 20, lambda s: sent.append(len(s.value[0])) or leaks._search(s, 10, 12), leaks.HITS).collect()
    assert sent == [2]
    got = {r.doc_id: (r.n_hit, r.n_items, r.n_near) for r in leaks.decontaminate(d, b, 10, 12).collect()}
    assert got == {1: (3, 2, 2), 2: (0, 0, 2), 3: (0, 0, 0)}


def test_index_holds_every_token(spark):
    docs, _ = corpus(4)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    got = []
    for r in leaks.build_index(d, 500).collect():
        index = leaks.Postings(r.terms, r.term_starts, r.deltas, r.doc_starts)
        text = [None] * r.n_tokens
        for term, no in index.number.items():
            for p in index.positions[index.starts[no]:index.starts[no + 1]]:
                text[p] = term.decode()
        got += [(i, text[a:b]) for i, a, b in zip(r.doc_ids, r.doc_starts, r.doc_starts[1:])]
    assert sorted(got, key=str) == sorted(((i, brute.bench_words(t)) for i, t in docs), key=str)


def test_proximity(spark):
    texts = [leaks.words(t) for t in (b"a b c d e f g", b"c a", b"a z z z z z c", b"b")]
    starts, terms, term_starts, deltas = leaks._segment(texts)
    index = leaks.Postings(terms, term_starts.tobytes(), deltas.tobytes(), starts)
    near = lambda *t, d: sorted(leaks.proximity_matches(index, index.code(list(t)), len(t), d).tolist())
    # both terms occur three times; the first named is looked up
    assert near(b"a", b"c", d=2) == [0, 8]
    assert near(b"a", b"c", d=6) == [0, 8, 9]
    assert near(b"a", b"c", d=1) == [8]
    assert near(b"a", b"nope", d=9) == []
    assert near(b"b", b"c", b"d", d=2) == [3]       # d is the rarest


def near_by_brute_force(docs, items, window, span):
    out = []
    for d, t in docs:
        ws = brute.bench_words(t)
        for i, text in items:
            b = brute.bench_words(text)
            sets = [set(b[k:k + window]) for k in range(max(1, len(b) - window + 1) if b else 0)]
            out += [(d, i, p) for p in range(len(ws)) if any(ws[p] in s and s <= set(ws[p:p + span]) for s in sets)]
    return sorted(out)


@pytest.mark.parametrize("seed,window,span,segment,block", [(1, 10, 12, 1 << 20, 1 << 20), (2, 4, 7, 300, 200), (3, 3, 3, 1, 99)])
def test_proximity_search_against_brute_force(spark, monkeypatch, seed, window, span, segment, block):
    monkeypatch.setattr(leaks, "_CANDIDATES", 50)
    docs, items = corpus(seed)
    ws = brute.bench_words(items[7][1]) + ["v%d" % k for k in range(10)]
    items.append((500, " ".join(ws[-10:])))
    docs = [(k, t) for k, (_, t) in enumerate(docs)] + [
        (300, " ".join(["q", *ws[-10:-4], "inserted", *ws[-4:], "q"])),
        (301, " ".join([*ws[-10:-6], ws[-5], ws[-6], *ws[-4:]]))]
    items = [(k, t) for k, (_, t) in enumerate(items)]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    index = leaks.materialize(leaks.build_index(d, segment), "leaks-test")
    ids = {(r.segment, k): i for r in index.collect() for k, i in enumerate(r.doc_ids)}
    found = leaks.proximity(index, b, window, span, block).collect()
    got = sorted((ids[r.segment, r.doc_no], int(r.item_id), r.position) for r in found)
    assert got == near_by_brute_force(docs, items, window, span)
    if window == 10:
        moved = {(d, i) for d, i, _ in got if d >= 300}
        assert moved >= {(300, len(items) - 1), (301, len(items) - 1)}
        exact = {(ids[r.segment, r.doc_no], int(r.item_id)) for r in leaks.search(index, b, window).collect()}
        assert not exact & moved


def test_phrase_never_crosses_documents():
    texts = [[b"a", b"b"], [b"c"]]
    starts, terms, term_starts, deltas = leaks._segment(texts)
    index = leaks.Postings(terms, term_starts.tobytes(), deltas.tobytes(), starts)
    code = index.code([b"a", b"b", b"c"])
    which, at = leaks.phrase_matches(index, np.array([code, [code[0], code[1], -1]]), np.array([3, 2]))
    assert which.tolist() == [1] and at.tolist() == [0]


def test_empty_tables_and_clashing_columns(spark):
    docs, items = corpus(5)
    schema = "doc_id long, text string, segment string, lists int, item_id int"
    none = spark.createDataFrame([], schema)
    b = spark.createDataFrame(items, "item_id long, text string")
    assert leaks.decontaminate(none, b).collect() == []
    d = spark.createDataFrame([(1, "a b", "s", 1, 2)], schema)
    assert rows(leaks.decontaminate(d, b.limit(0), span=12))[0][:4] == (1, 2, 0, 0)


def test_query_against_sql(spark):
    import duckdb

    from streamledger.llm.queries import LLM_ORACLES
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    sql = f"select {', '.join(NEAR)} from ({LLM_ORACLES['op9_decontamination']})"
    assert sorted(con.execute(sql).fetchall(), key=str) == rows(op9_decontamination(spark, sf), NEAR)


def test_query_on_table(spark):
    read = lambda t, k: [tuple(r) for r in spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet")
                         .select(k, "text").collect()]
    got = rows(op9_decontamination(spark, "/root/testdata/sf0.001"))
    assert got == sorted(brute.decontaminate(read("documents", "doc_id"), read("benchmark", "item_id"), 10), key=str)
    assert any(r[5] for r in got)
