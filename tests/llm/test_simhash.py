import random

import pytest
from pyspark.sql import functions as F

from streamledger.llm import simhash
from streamledger.llm.components import components
from streamledger.llm.queries import op10_simhash

from . import brute


def rows(df):
    return sorted(map(tuple, df.select("doc_id", "fingerprint", "component_id").collect()), key=str)


def test_matches_brute_force(spark):
    rnd = random.Random(3)
    words = ["w%d" % k for k in range(300)] + ["Éa", "BIG", "　x"]
    docs = []
    for i in range(80):
        base = rnd.choices(words, k=rnd.choice([1, 2, 3, 20, 200]))
        for _ in range(rnd.choice([1, 1, 3])):
            t = list(base)
            if len(t) > 100:
                t[rnd.randrange(len(t))] = "edit"
            docs.append((len(docs), rnd.choice([" ", "\n", "\t \x0b"]).join(t)))
    docs += [(500, ""), (501, None), (502, " \t"), (503, "a b"), (3, docs[3][1]), (None, "a b"), (None, "lone z")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for bits in (1, 2, 3):
        assert rows(simhash.near_duplicates(df, 3, bits)) == sorted(
            brute.simhash_components(docs, 3, bits), key=str)


@pytest.mark.parametrize("bits", [0, 1, 2, 3])
def test_links_find_every_pair(spark, bits):
    rnd = random.Random(bits)
    base = [rnd.getrandbits(64) for _ in range(10)]
    prints = {b ^ sum(1 << rnd.randrange(64) for _ in range(rnd.randint(0, 4))) & (2**64 - 1)
              for b in base for _ in range(8)} | {0, 1, 3, 2**64 - 1, 2**63}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    got = {tuple(r) for r in simhash.links(df, bits).collect()}
    want = {(a, b) for a in signed for b in signed
            if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= bits}
    assert got == want


def test_hash_is_sparks(spark):
    df = spark.createDataFrame([("été the x",)], "t string").select(F.xxhash64("t"))
    assert df.first()[0] & (2**64 - 1) == __import__("xxhash").xxh64_intdigest("été the x".encode(), 42)


def test_long_text_in_chunks(monkeypatch):
    text = " ".join("w%d" % (k * k % 97) for k in range(1000)).encode()
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "_CHUNK", 7)
    assert simhash.fingerprint(text) == whole == brute.simhash(text.decode(), 3)


def test_empty_table_and_clashing_columns(spark):
    schema = "doc_id long, text string, fp string, component_id string, vector int"
    assert simhash.near_duplicates(spark.createDataFrame([], schema)).collect() == []
    df = spark.createDataFrame([(2, "a", "x", "y", 1), (1, "a", "x", "y", 1)], schema)
    assert {r.component_id for r in simhash.near_duplicates(df).collect()} == {1}


def test_components_of_chains_and_stars(spark):
    pairs = [(k, k + 1) for k in range(60)] + [(1000, k) for k in range(1001, 1040)] + [(7, 7), (2000, 2000), (-5, 2)]
    got = dict(map(tuple, components(spark.createDataFrame(pairs, "a long, b long")).collect()))
    assert got == {**{k: -5 for k in range(61)}, **{k: 1000 for k in range(1001, 1040)}}


def test_query_on_table(spark):
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
            .select("doc_id", "text").collect()]
    assert rows(op10_simhash(spark, "/root/testdata/sf0.001")) == sorted(
        brute.simhash_components(docs, 3, 2), key=str)
