import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from streamledger.llm import mixing, toxicity
from streamledger.session import scratch_dir

from . import brute

BAD = ["idiot", "stupid"]


@pytest.fixture(scope="module")
def corpus(spark):
    """Documents with planted toxic texts, near copies, shared passages and
    benchmark passages, as tables in a folder."""
    rnd = random.Random(11)
    vocab = ["".join(rnd.choices("bdfgklmnprstvz", k=1) + rnd.choices("aeiou", k=1)) * rnd.randint(1, 2)
             + rnd.choice(["n", "r", "l", "st"]) for _ in range(600)]
    say = lambda k: rnd.choices(vocab, k=k)
    docs, labels, planted = [], [], {}
    passage, item = say(60), say(14)

    def add(kind, words, source="s0"):
        i = len(docs)
        docs.append((i, " ".join(words), "en", source))
        planted.setdefault(kind, []).append(i)
        return i

    for k in range(260):
        add("clean", say(rnd.randint(30, 120)), rnd.choice(["s0", "s0", "s1", None]))
    for k in range(90):
        add("toxic", [*say(30), *BAD, *say(20)])
    for i in range(350):
        labels.append((i, 1, int(i >= 260)))
    base = say(300)
    for k in range(6):
        copy = list(base)
        copy[50 * k] = copy[50 * k] + "x" if k else copy[0]
        add("copies", copy)
    for k in range(4):
        add("passage", [*say(40), *passage, *say(40)])
    for k in range(3):
        add("leak", [*say(20), *(w.upper() for w in item[k:k + 11]), *say(20)])
    add("empty", [])
    docs.append((None, "no id but words", "en", "s1"))
    docs.append((None, None, None, None))
    root = scratch_dir(spark, "pipeline-test")
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string") \
        .withColumn("n_chars", F.char_length("text").cast("long"))
    df.repartition(4).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame([(1, " ".join(item)), (2, None)], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return root, planted


def test_stages_against_brute_force(spark, corpus):
    root, planted = corpus
    docs = spark.read.parquet(f"{root}/documents.parquet")
    for name, stage in pipeline.STAGES:
        before = docs
        docs = stage(spark, before, root)
        if name != "mixing":
            assert docs.columns == before.columns and docs.dtypes == before.dtypes
        path = scratch_dir(spark, name)
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        old, new = [r.asDict() for r in before.collect()], [r.asDict() for r in docs.collect()]
        ids = {r["doc_id"] for r in new}
        if name == "toxicity":
            gone = {r["doc_id"] for r in old} - ids
            assert gone <= set(planted["toxic"]) and len(gone) >= 0.95 * len(planted["toxic"])
            assert ids >= set(planted["clean"]) and None in ids
        elif name == "simhash":
            groups = brute.simhash_components([(r["doc_id"], r["text"]) for r in old if r["doc_id"] is not None], 3, 2)
            assert ids - {None} == {i for i, _, root_id in groups if i == root_id}
            assert len(ids & set(planted["copies"])) < 6
        elif name == "suffix":
            want = {r[0]: r for r in brute.remove_repeats([(r["doc_id"], r["text"]) for r in old], 100)}
            for r in new:
                if r["doc_id"] is not None:
                    assert len((r["text"] or "").encode()) == want[r["doc_id"]][1] - want[r["doc_id"]][2]
                    assert r["n_chars"] == len(r["text"] or "")
            texts = {r["doc_id"]: r["text"] for r in old}
            assert sum(len(r["text"] or "") < len(texts[r["doc_id"]] or "") for r in new if r["doc_id"] in planted["passage"]) == 3
        elif name == "leaks":
            want = brute.decontaminate([(r["doc_id"], r["text"]) for r in old],
                                       [(1, spark.read.parquet(f"{root}/benchmark.parquet").first().text)], 10)
            assert ids - {None} == {r[0] for r in want if not r[5] and r[0] is not None}
            assert not ids & set(planted["leak"]) and len(new) == sum(not r[5] for r in want)
        else:
            assert len(new) == len(old)
            for r in new:
                assert 0 <= r["taken"] <= 2 * r["size"]


def test_cut_characters_go_whole(spark):
    rows = [(1, "é" * 60 + "a"), (2, "z" + "é" * 60 + "b")]
    df = spark.createDataFrame([(*r, "en", "s", len(r[1])) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r for r in pipeline.suffix(spark, df, "").collect()}
    assert got[1].text == rows[0][1] or got[1].n_chars == len(got[1].text)
    assert got[2].text == "zb" and got[2].n_chars == 2


def shared_ids(rnd):
    say = lambda k: " ".join(rnd.choices(["w%d" % k for k in range(900)], k=k))
    a, other, third, copies = say(80), say(80), say(80), say(80)
    return a, [(1, a), (5, a), (5, other), (5, third), (None, say(80)), (None, say(80)), (None, copies), (None, copies),
               (None, copies + " "), (7, say(80)), (7, say(80)), (9, None), (9, "")]


def test_rows_that_share_an_id_are_kept_one_by_one(spark):
    a, rows = shared_ids(random.Random(4))
    df = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows],
                               "doc_id long, text string, lang string, source string, n_chars long")
    got = [(r.doc_id, r.text) for r in pipeline.simhash(spark, df.repartition(5), "").collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    # one row of each group: the copy of 1, of the nulls' copies, and of the empty texts goes
    groups = brute.simhash_components([(k, t) for k, (_, t) in enumerate(rows)], 3, 2)
    best = {}
    for k, _, group in groups:
        best[group] = min(best.get(group, rows[k]), rows[k], key=key)
    assert sorted(map(key, got)) == sorted(map(key, best.values()))
    assert (1, a) in got and (5, a) not in got and sum(i == 5 for i, _ in got) == 2 and sum(i is None for i, _ in got) == 3


def test_ties_among_equal_ids_go_by_text(spark):
    text = " ".join("w%d" % k for k in range(60))
    rows = [(3, text.upper()), (3, text), (3, text + " "), (None, text)]
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows],
                               "doc_id long, text string, lang string, source string, n_chars long")
    for n in (1, 4):
        assert [(r.doc_id, r.text) for r in pipeline.simhash(spark, df.repartition(n), "").collect()] == [(3, text.upper())]


def test_leaks_go_row_by_row(spark, corpus):
    root, _ = corpus
    item = spark.read.parquet(f"{root}/benchmark.parquet").where("text is not null").first().text
    rows = [(4, "clean one"), (4, "x " + item), (4, "clean two"), (None, item), (None, "clean three"), (None, None)]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows],
                               "doc_id long, text string, lang string, source string, n_chars long")
    got = [(r.doc_id, r.text) for r in pipeline.leaks(spark, df.repartition(3), root).collect()]
    assert sorted(got, key=str) == sorted([rows[0], rows[2], rows[4], rows[5]], key=str)


def test_extra_columns_keep_their_values(spark, corpus):
    """Columns named like those the stages use on the way pass through as they are."""
    root, _ = corpus
    names = ["row", "row_", "__row", "null", "__null", "NULL_", "group", "place", "least", "late", "fp", "kept_text", "carried_text", "segment"]
    docs = spark.read.parquet(f"{root}/documents.parquet").where("doc_id < 30 or doc_id >= 350 or doc_id is null")
    docs = docs.select("*", *(F.lit(k).alias(c) for k, c in enumerate(names)))
    for stage in (pipeline.simhash, pipeline.suffix, pipeline.leaks):
        got = stage(spark, docs, root)
        assert got.columns == docs.columns
        assert got.select(*names).distinct().collect() == [tuple(range(len(names)))]


def test_empty_tables(spark, corpus):
    root, _ = corpus
    docs = spark.read.parquet(f"{root}/documents.parquet").limit(0)
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, root)
        assert docs.collect() == []


def test_run_is_the_query(spark):
    import __spark_entry__ as entry
    sf = "/root/testdata/sf0.001"
    a = entry.queries()["pipeline"](spark, sf).collect()
    total = spark.read.parquet(f"{sf}/documents.parquet").count()
    assert 0 < len(a) <= total and all(0 <= r.taken <= 2 * r.size for r in a)
    assert re.match("op|pipeline", "pipeline") and mixing and toxicity
