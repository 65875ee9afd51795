import base64
import gzip
import hashlib
import json
import random
import time
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from streamledger.llm import warc
from streamledger.llm.files import random_reader, resolve
from streamledger.llm.queries import LLM_ORACLES, op7_warc
from streamledger.session import scratch_dir

COLS = "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"


def brute(rows, least):
    first = {}
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0))
    out = []
    for k in order:
        i, _, h = rows[k]
        p = (h or "").encode()
        d = base64.b32encode(hashlib.sha1(p).digest()).decode()
        again = len(p) >= least and d in first
        out.append((i, len(p), d, "revisit" if again else "response", first[d] if again else None))
        if len(p) >= least:
            first.setdefault(d, i)
    return sorted(out, key=str)


ROWS = [(i, f"http://x/{i}?q=a b\n", random.Random(i).choice(["", "é" * 20, "<p>%d</p>" % i, "same", "big " * 9000]))
        for i in range(80)] + [(None, None, "same"), (None, "u", None), (7, "u", "x\r\n\r\nWARC/1.1\r\n"), (7, "u", "same")]


@pytest.mark.parametrize("least", [0, 5])
def test_round_trip(spark, least):
    df = spark.createDataFrame([(*r, "x", 3) for r in ROWS], "page_id long, url string, html string, path string, at int")
    got = warc.round_trip(df.repartition(3), least).select(*COLS)
    assert sorted(map(tuple, got.collect()), key=str) == brute(ROWS, least)


def test_files_are_what_they_should_be(spark, monkeypatch):
    folder = scratch_dir(spark, "warc-test")
    df = spark.createDataFrame(ROWS, "page_id long, url string, html string").coalesce(1)
    whole = warc.write(df, folder + "/whole", 0, 20_000).cache()
    paths = whole.collect()
    assert len(paths) > 2 and sum(r.records for r in paths) == len(ROWS)
    for r in paths:
        raw = random_reader(r.path).read()
        one = zlib.decompressobj(31)
        text = one.decompress(raw)
        assert one.eof and not one.unused_data              # a single stream
        assert text.count(b"WARC/1.1\r\nWARC-Type") == r.records
    index = warc.normalise(whole, folder + "/members").cache()
    rows = index.collect()
    for path in {r.path for r in rows}:
        own = sorted((r.at, r.length) for r in rows if r.path == path)
        raw = random_reader(path).read()
        assert own[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(own, own[1:] + [(len(raw), 0)]))
        side = [json.loads(x) for x in random_reader(path + ".idx").read().decode().splitlines()]
        assert [(x["offset"], x["length"]) for x in side] == own
        assert all(gzip.decompress(raw[a:a + n]).startswith(b"WARC/1.1") for a, n in own)
    one = index.orderBy(F.rand(1)).limit(5)
    assert warc.read(one).count() == 5
    assert resolve(folder)[1]


def test_streams_in_small_pieces():
    import io
    raw = [warc.record(i, None, b"p" * (i * 37), None, False) for i in range(30)]
    data = gzip.compress(b"".join(raw[:20])) + gzip.compress(b"".join(raw[20:]))
    for piece in (1, 7, 1000, 1 << 20):
        assert list(warc.records(io.BytesIO(data), piece)) == raw
    with pytest.raises(ValueError):
        list(warc.records(io.BytesIO(gzip.compress(raw[3][:-5]))))


def test_damage_is_noticed():
    good = warc.record(1, "u", b"payload", None, False)
    assert warc.parse(good)[0] == 1
    with pytest.raises(ValueError):
        warc.parse(good.replace(b"payload\r\n\r\n", b"pAyload\r\n\r\n"))


def test_cut_and_padded_archives():
    """A stream cut anywhere is an error; zero bytes behind or between members are not."""
    import io
    raws = [warc.record(i, f"u{i}", f"payload {i} ".encode() * 50, None, False) for i in range(30)]
    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
    flushed = deflate.compress(b"".join(raws[:15])) + deflate.flush(zlib.Z_FULL_FLUSH)
    whole = flushed + deflate.compress(b"".join(raws[15:])) + deflate.flush()
    members = b"".join(map(warc._member, raws))
    read = lambda data, piece=1 << 20: list(warc.records(io.BytesIO(data), piece))
    for piece in (1, 7, 64, 1 << 20):
        assert read(whole, piece) == raws and read(members, piece) == raws
    for padded in (whole + bytes(512), members + bytes(9), bytes(3).join(map(warc._member, raws))):
        assert read(padded) == read(padded, 5) == raws
    for cut in (whole[:-1], whole[:-4], whole[:-8], whole[:-9], flushed, whole[:len(whole) // 2], whole[:10],
                members[:-1], members[:-8], members[:-200]):
        with pytest.raises(ValueError, match="ends within"):
            read(cut)
    with pytest.raises(ValueError, match="within a record"):
        read(warc._member(raws[0][:-1]))
    assert read(b"") == read(bytes(100)) == []


def test_empty_table(spark):
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_query_against_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"create view pages as select * from read_parquet('{sf}/pages.parquet')")
    rows = con.execute("select page_id, url, html from pages").fetchall()
    want = brute(rows, 0)
    assert sorted(map(tuple, op7_warc(spark, sf).select(*COLS).collect()), key=str) == want
    assert "op7_warc" not in LLM_ORACLES or sorted(con.execute(LLM_ORACLES["op7_warc"]).fetchall(), key=str) == want


def test_record_ids_are_unique_and_references_lead_to_responses(spark):
    rows = [(1, "u", "<p>a"), (1, "u", "<p>a"), (1, "v", "<p>a"), (1, "u", "<p>b"), (None, None, "<p>a"), (None, "w", "<p>b"),
            (None, "w", "<p>b"), (2, None, None), (2, None, "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    archives = warc.write(df, warc.scratch_dir(spark, "warc-ids")).collect()
    heads = []
    for r in archives:
        with warc.reader(r.path) as source:
            heads += [warc._head(raw[:raw.index(b"\r\n\r\n")]) for raw in warc.records(source)]
    kinds = {h["warc-record-id"]: h["warc-type"] for h in heads}
    digests = {h["warc-record-id"]: h["warc-payload-digest"] for h in heads}
    assert len(kinds) == len(rows) == len(heads)
    revisits = [h for h in heads if h["warc-type"] == "revisit"]
    assert len(revisits) == len(rows) - 3
    for h in revisits:
        assert kinds[h["warc-refers-to"]] == "response" and digests[h["warc-refers-to"]] == h["warc-payload-digest"]
    assert {warc._id(h["warc-record-id"]) for h in heads} == {1, 2, None}


@pytest.mark.parametrize("held", [None, "false"])
def test_shuffled_payloads_are_gone_before_members_are_written(spark, monkeypatch, held):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    store = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        files = store.getAllFiles()
        return {n for n in (files.apply(i).getName() for i in range(files.size())) if n.startswith("shuffle_")}

    def normalise(archives, folder, real=warc.normalise):
        until = time.time() + 5                             # files are removed in the background
        while (left := shuffled() - before) and time.time() < until:
            time.sleep(0.1)
        seen.append((archives.count(), left))
        return real(archives, folder)

    monkeypatch.setattr(warc, "normalise", normalise)
    if held:
        spark.conf.set(key, held)
    try:
        df = spark.createDataFrame(ROWS, "page_id long, url string, html string").repartition(3)
        before, seen = shuffled(), []
        got = warc.round_trip(df).select(*COLS).collect()
        assert spark.conf.get(key, None) == held            # and the session is left as it was
    finally:
        spark.conf.unset(key)
    assert seen[0][0] > 0 and seen[0][1] == set()
    assert sorted(map(tuple, got), key=str) == brute(ROWS, 0)
