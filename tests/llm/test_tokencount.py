import numpy as np
import pytest

from streamledger.llm import tokencount
from streamledger.llm.files import writer
from streamledger.llm.queries import VOCABULARY, op2_token_counts
from streamledger.session import scratch_dir


def test_counts_match_the_encoder(spark):
    rows = [(i, t) for i, t in enumerate(["", None, "a", "Hello, wörld! 日本\n\n  x", "<|endoftext|>", "word " * 5000, " " * 700, "z" * 3000])]
    rows += [(None, "no id"), (3, "same id"), (3, "same id")]
    df = spark.createDataFrame([(*r, "p", 1) for r in rows], "doc_id long, text string, path string, n_tokens int")
    got = tokencount.count_tokens(df.repartition(3), VOCABULARY, 50256).select("doc_id", "n_tokens")
    pairs = tokencount.encoder(VOCABULARY)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        ((i, len(pairs.encode_ordinary(t or ""))) for i, t in rows), key=str)
    assert tokencount.count_tokens(df.limit(0), VOCABULARY, 50256).collect() == []


def test_text_in_pieces_has_the_same_tokens(monkeypatch):
    pairs = tokencount.encoder(VOCABULARY)
    text = "It's  many words, 12 345 – and  spaces \n here don't  stop " * 60
    whole = pairs.encode_ordinary(text)
    for size in (1, 7, 64):
        monkeypatch.setattr(tokencount, "_PIECE", size)
        assert [t for ids in tokencount._encode(pairs, text) for t in ids] == whole


@pytest.mark.parametrize("block", [1, 2, 3, 7, 1000])
@pytest.mark.parametrize("dtype", ["<u2", "<u4"])
def test_documents_across_blocks(spark, block, dtype):
    rng = np.random.default_rng(block)
    folder, files, want = scratch_dir(spark, "tokens-test"), [], []
    for k in range(6):
        tokens = rng.integers(0, 4, [0, 1, 5, 40, 40, 40][k]).astype(dtype)
        if k == 3:
            tokens[:] = 0
        if k == 4:
            tokens[:] = 1
        path = f"{folder}/{k}.tokens"
        with writer(path) as out:
            out.write(tokens.tobytes())
        files.append((path, len(tokens)))
        docs, start = [], 0
        for at in np.flatnonzero(tokens == 0).tolist():
            docs.append((start, at - start))
            start = at + 1
        if start < len(tokens):
            docs.append((start, len(tokens) - start))
        want += [(path, o, *d) for o, d in enumerate(docs)]
    got = tokencount.scan(spark.createDataFrame(files, "path string, tokens long"), 0, dtype, block)
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_query_on_table(spark):
    sf = "/root/testdata/sf0.001"
    pairs = tokencount.encoder(VOCABULARY)
    want = sorted((r.doc_id, len(pairs.encode_ordinary(r.text)))
                  for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    assert sorted(map(tuple, op2_token_counts(spark, sf).collect())) == want


def test_files_close_by_documents_too(spark):
    """Empty documents are a token each; no file holds more than ``file_documents``."""
    rows = [(i, "" if i % 7 else "some words") for i in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    folder = scratch_dir(spark, "tokens-many")
    files = tokencount.materialize(tokencount.write(df, folder, VOCABULARY, 50256, file_documents=64), "tokens-test")
    sizes = [len(r.doc_ids) for r in files.collect()]
    assert max(sizes) == 64 and sum(sizes) == 500
    assert tokencount.scan(files, 50256).groupBy().sum("n_tokens").first()[0] == sum(not i % 7 for i, _ in rows) * 2


def test_separator_and_ids_are_checked():
    pairs = tokencount.encoder(VOCABULARY)
    tokencount._check_ids(pairs, 50256, "<u2")
    for separator, dtype in ((0, "<u2"), (70000, "<u2"), (50256, "<i2")):
        with pytest.raises(ValueError):
            tokencount._check_ids(pairs, separator, dtype)
