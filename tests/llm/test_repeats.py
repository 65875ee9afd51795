import hashlib
import random

import numpy as np
import pytest
import xxhash

from streamledger.llm import repeats as R
from tests.conftest import SF_SMALL


def order(row):
    h = xxhash.xxh64_intdigest((row[1] or "").encode(), 42)
    return (row[0] is None, row[0] or 0, h - (1 << 64) if h >> 63 else h)


def brute(rows, length):
    """(doc_id, n_words, n_removed, sha, spans) by a set of all windows."""
    seen, out = set(), []
    for ident, text in sorted(rows, key=order):
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for p in range(len(words) - length + 1):
            window = tuple(words[p:p + length])
            if window in seen:
                gone[p:p + length] = [True] * length
            seen.add(window)
        edges = [i for i in range(len(words) + 1)
                 if (i < len(words) and gone[i]) != (i > 0 and gone[i - 1])]
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        out.append((ident, len(words), sum(gone), hashlib.sha256(kept).hexdigest(), kept.decode(),
                    list(map(list, zip(edges[::2], edges[1::2])))))
    return sorted(out, key=str)


def run(df, length, **how):
    return sorted((tuple(r) for r in R.remove_passages(df, length, with_text=True, **how).collect()), key=str)


def made(spark, rows):
    return spark.createDataFrame([(i, t, "x", 3) for i, t in rows], "doc_id long, text string, tie string, shard int")


def test_equals_brute_force(spark):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
    expected = brute(rows, 20)
    assert sum(e[2] for e in expected) > 1000
    assert run(df, 20) == expected
    assert run(df, 20, shard_bytes=30_000, split=2) == expected          # many shards, every seed hot


def hard_rows():
    rng = random.Random(1)
    rows = [(rng.choice([None, *range(60)]), " ".join(rng.choice("ab") for _ in range(rng.randint(0, 150))))
            for _ in range(150)]
    passage = " ".join(f"p{i}" for i in range(60))
    rows += [(200 + i, f"left{i} " * rng.randint(0, 9) + passage + f" right{i}" * rng.randint(0, 9)) for i in range(40)]
    rows += rows[:20] + [(None, None), (None, "")] * 20 + [(7, "x " * 900)] * 3 + [(8, "x\t\x0bx\n" * 60), (None, "x " * 50)]
    rows += [(300, "é" * 200 + " 　   z " * 30), (301, "é" * 200 + " 　   z " * 30)]
    return rows


@pytest.mark.parametrize("length", [6, 9, 20])
def test_hard_texts(spark, length):
    rows = hard_rows()
    df = made(spark, rows)
    expected = brute(rows, length)
    assert run(df, length, shard_bytes=2_000, split=1 << 20) == expected
    assert run(df, length, shard_bytes=2_000, split=10) == expected


def test_empty_table_and_bad_length(spark):
    assert R.remove_passages(made(spark, [])).count() == 0
    with pytest.raises(ValueError):
        R.remove_passages(made(spark, []), length=5)


def test_identical_rows_are_one_until_the_end(spark):
    rows = [(None, "a b c d e f g")] * 500 + [(1, "a b c d e f g")]
    counted, _ = R._counted(made(spark, rows))
    assert sorted(r.copies for r in counted.collect()) == [1, 500]
    got = run(made(spark, rows), 6)
    assert got == brute(rows, 6) and len(got) == 501


def test_rows_of_one_id_spread_over_shards(spark):
    rows = [(None, f"w{i} " * 30) for i in range(400)]
    dealt, _ = R._counted(made(spark, rows))
    from pyspark.sql import functions as F
    shards = dealt.select(F.pmod(F.xxhash64("doc_id", "tie"), F.lit(8)).alias("s")).groupBy("s").count().collect()
    assert len(shards) == 8 and max(r["count"] for r in shards) < 100


def test_windows_of_a_hot_seed_do_not_meet_in_one_group(spark):
    """A passage shorter than a window, in many texts with unlike surroundings."""
    rng = random.Random(4)
    line = " ".join(f"l{i}" for i in range(12))
    texts = [" ".join(str(rng.random()) for _ in range(20)) + f" {line} " + " ".join(str(rng.random()) for _ in range(20))
             for _ in range(400)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(1000 + i, t) for i, t in enumerate(texts[:50])]
    assert run(made(spark, rows), 20, shard_bytes=20_000, split=16) == brute(rows, 20)
    words = R.Words([t.encode() for t in texts])
    import pyarrow as pa
    ids = range(len(texts))
    docs = pa.table({"doc_id": pa.array(ids, pa.int64()), "text": pa.array([t.encode() for t in texts]),
                     "tie": pa.array(ids, pa.int64()), "shard": pa.array([0] * len(texts), pa.int32())})
    _, _, _, h = R.window_runs(words, 20)
    known, often = np.unique(h.view(np.int64), return_counts=True)
    repeated = pa.table({"hash": known[often > 1], "total": often[often > 1]})
    buckets = 64
    pieces = R._shard(20, buckets, 16)(docs, repeated).to_pandas()
    assert len(pieces) > 1000 and pieces.bucket.value_counts().max() < 3 * len(pieces) / buckets


def test_runs_name_every_window_once_and_equal_windows_alike():
    rng = random.Random(9)
    texts = [" ".join(rng.choice("abc") for _ in range(n)).encode() for n in (0, 5, 19, 20, 21, 300, 0, 70_000)]
    words = R.Words(texts)
    lo, hi, place, h = R.window_runs(words, 20)
    windows = np.concatenate([np.arange(a, b) for a, b in zip(lo, hi)])
    valid = [f + p for f, t in zip(words.first, texts) for p in range(max(0, len(t.split()) - 19))]
    assert sorted(windows.tolist()) == valid
    ids = words.ids()
    seen = {}
    for a, b, p, x in zip(lo, hi, place, h):
        for w in range(a, b):
            assert seen.setdefault(tuple(ids[w:w + 20]), (p - w, x)) == (p - w, x)
