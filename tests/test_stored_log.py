"""The offset-addressed stream over a stored log."""

import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from streamledger import fsio
from streamledger.operators import offsets
from streamledger.sources import stored
from streamledger.streaming import apps, jobs, progress, sinks

SCHEMA = "topic string, partition int, offset bigint, key string, value string, timestamp timestamp_ntz"


def messages(spark, sizes, first=0):
    """``sizes``: messages of each (topic, partition), from offset ``first``."""
    parts = [spark.range(first, first + n).select(
        F.lit(t).alias("topic"), F.lit(p).alias("partition"), F.col("id").alias("offset"),
        F.lit(None).cast("string").alias("key"), F.concat(F.lit("a,"), F.col("id").cast("string")).alias("value"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("timestamp")) for (t, p), n in sizes.items()]
    out = parts[0]
    for df in parts[1:]:
        out = out.unionByName(df)
    return out


class Consumer:
    def __init__(self, spark, workdir, **options):
        self.spark, self.dir, self.options = spark, workdir, options
        self.store = sinks.OffsetStore(spark, f"{workdir}/offsets")
        self.seen = []

    def run(self, checkpoint="chk", **hooks):
        stream = stored.read_stream(self.spark, f"{self.dir}/log", SCHEMA, offsets=f"{self.dir}/offsets", group="g", **self.options)

        def work(df, slot):
            rows = offsets.batch_ranges(df).collect()
            self.seen.append({(r.topic, r.partition): (r.from_offset, r.until_offset) for r in rows})
            assert df.count() == sum(r.until_offset - r.from_offset for r in rows)
        return jobs.run_batches(stream, sinks.guarded(self.store, "g", work, **hooks), f"{self.dir}/{checkpoint}")


def test_cap_is_exact_under_skew(spark, workdir):
    stored.write_log(messages(spark, {("hot", 0): 95, ("cold", 0): 7, ("cold", 3): 25}), f"{workdir}/log")
    c = Consumer(spark, workdir, cap=20)
    c.run()
    assert c.seen == [
        {("hot", 0): (0, 20), ("cold", 0): (0, 7), ("cold", 3): (0, 20)},
        {("hot", 0): (20, 40), ("cold", 3): (20, 25)},
        {("hot", 0): (40, 60)}, {("hot", 0): (60, 80)}, {("hot", 0): (80, 95)}]
    assert c.store.current_map("g") == {("hot", 0): 95, ("cold", 0): 7, ("cold", 3): 25}


def test_restarts_neither_lose_nor_repeat(spark, workdir):
    """The same checkpoint, a crash on either side of a commit, a new checkpoint,
    and files that were appended meanwhile."""
    stored.write_log(messages(spark, {("t", 0): 50, ("t", 1): 30}), f"{workdir}/log")
    c = Consumer(spark, workdir, cap=20)
    state = {"n": 0}

    def crash(batch_id):
        state["n"] += 1
        if state["n"] == 2:
            raise RuntimeError("simulated")
    for hook in ("before_commit", "after_commit"):
        state["n"] = 0
        with pytest.raises(StreamingQueryException, match="simulated"):
            c.run("chk", **{hook: crash})
            c.run("chk")
        stored.write_log(messages(spark, {("t", 1): 40}, first=30) if hook == "before_commit"
                         else messages(spark, {("t", 0): 10}, first=50), f"{workdir}/log")
    c.run("chk")
    c.run("new")
    assert c.store.current_map("g") == {("t", 0): 60, ("t", 1): 70}
    history = c.store.history("g").orderBy("batch_id").collect()
    for p, end in ((0, 60), (1, 70)):
        ends = [r.offset for r in history if r.partition == p]
        assert ends == sorted(set(ends)) and ends[-1] == end


def test_topics_that_appear_while_it_runs(spark, workdir):
    stored.write_log(messages(spark, {("pa", 0): 30, ("x", 0): 5}), f"{workdir}/log")
    c = Consumer(spark, workdir, pattern="p.*", cap=10, policy="latest")
    c.store.commit([("pa", 0, 0, 10)], "g")
    work_seen = []

    def added(batch_id):
        if not work_seen:
            work_seen.append(1)
            stored.write_log(messages(spark, {("pb", 2): 12, ("y", 0): 3}), f"{workdir}/log")
    c.run(after_commit=added)
    assert c.store.current_map("g") == {("pa", 0): 30, ("pb", 2): 12}
    assert c.seen[0] == {("pa", 0): (10, 20)}
    assert [s[("pb", 2)] for s in c.seen if ("pb", 2) in s] == [(0, 10), (10, 12)]


def test_start_policies(spark, workdir):
    stored.write_log(messages(spark, {("t", 0): 9, ("u", 0): 4}), f"{workdir}/log")
    latest = Consumer(spark, workdir, policy="largest", topics="t,u")
    latest.run("latest")
    assert latest.seen == []
    with pytest.raises(StreamingQueryException, match="no stored offset for t-0"):
        Consumer(spark, workdir, policy="none", topics="t").run("none")
    latest.store.commit([("t", 0, 0, 6)], "g")
    c = Consumer(spark, workdir, policy="none", topics="t")
    c.run("stored")
    assert c.seen == [{("t", 0): (6, 9)}]
    with pytest.raises(Exception, match="offsets and group"):
        stored.read_stream(spark, f"{workdir}/log", SCHEMA).writeStream.format("noop").option(
            "checkpointLocation", f"{workdir}/bad").start().processAllAvailable()


def test_only_overlapping_row_groups_are_read(spark, workdir, monkeypatch):
    import pyarrow.parquet as pq
    stored.write_log(messages(spark, {("t", 0): 1000}), f"{workdir}/src")
    (path,) = [f for v in stored.Files(f"{workdir}/src").list().values() for _, _, f in v]
    table = pq.ParquetFile(path).read()
    import os
    os.makedirs(f"{workdir}/log/topic=t/partition=0")
    pq.write_table(table, f"{workdir}/log/topic=t/partition=0/a.parquet", row_group_size=100)
    reader = stored.Reader(messages(spark, {("t", 0): 1}).schema, {
        "path": f"{workdir}/log", "offsets": f"{workdir}/o", "group": "g"})
    (part,) = reader.partitions({"t": {"0": 250}}, {"t": {"0": 320}})
    asked = []
    real = pq.ParquetFile.iter_batches
    monkeypatch.setattr(pq.ParquetFile, "iter_batches", lambda self, *a, **k: asked.append(k["row_groups"]) or real(self, *a, **k))
    got = [o for b in reader.read(part) for o in b.column("offset").to_pylist()]
    assert got == list(range(250, 320)) and asked == [[2, 3]]


def test_progress_gives_the_ranges_of_the_commits(spark, workdir):
    """O1 from query progress, over two checkpoints."""
    log = progress.ProgressLog()
    spark.streams.addListener(log)
    try:
        c = Consumer(spark, workdir, cap=20)
        for k in (0, 1):
            for part, n in ((0, 45), (1, 10)):
                stored.write_log(messages(spark, {("t", part): n}, first=n * k), f"{workdir}/log")
            log.wait_for(c.run(f"chk-{k}"))
    finally:
        spark.streams.removeListener(log)
    rows = log.ranges(spark).collect()
    assert sorted((r.topic, r.partition, r.until_offset) for r in rows) == sorted(
        (r.topic, r.partition, r.offset) for r in c.store.history("g").collect())
    assert sorted((r.partition, r.from_offset, r.until_offset) for r in rows if r.batch_id) == sorted(
        (k[1], *v) for s in (*c.seen[1:3], *c.seen[4:]) for k, v in s.items())
    assert len({r.run_id for r in rows}) == 2


def test_app_over_a_stored_log(spark, workdir):
    stored.write_log(messages(spark, {("t", 0): 50, ("u", 1): 8}), f"{workdir}/log")
    argv = ["offsets-count", "--log", f"{workdir}/log", "--out", f"{workdir}/out", "--group", "g", "--once",
            "--max-per-partition", "20"]
    for chk in ("one", "one", "two"):
        apps.main([*argv, "--checkpoint", chk], spark)
    store = sinks.OffsetStore(spark, f"{workdir}/out/offsets")
    assert store.current_map("g") == {("t", 0): 50, ("u", 1): 8}
    assert [r.n for r in sinks.record_counts(spark, f"{workdir}/out/counts", store, "g").orderBy("batch_id").collect()] == [28, 20, 10]


def test_append_offsets_come_from_footers(spark, workdir):
    """K4: a start reads no row."""
    df = messages(spark, {("t", 0): 50, ("007", 1): 8})
    df.write.parquet(f"{workdir}/feed/a")
    jobs.run_append_with_offsets(jobs.read_feed(spark, f"{workdir}/feed/*", df.schema), f"{workdir}/rows", f"{workdir}/chk")
    found = jobs.appended_offsets(spark, f"{workdir}/rows")
    assert {tuple(r) for r in found.collect()} == {("t", 0, 50), ("007", 1, 8)}
    plan = found._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PushedAggregation: [MAX(offset)]" in plan and "PushedGroupBy: [topic, partition]" in plan
    rows = jobs.appended_rows(spark, f"{workdir}/rows")
    assert rows.columns == ["name", "id", "topic", "partition", "offset"] and rows.where("topic = '007'").count() == 8


def test_path_tree_files_round_trip(spark, workdir):
    current = spark.createDataFrame([("g", "t", 0, 5), ("g/odd name+%", "t.a_b-c", 12, 7), ("g", "t", 1, 0)],
                                    "group_id string, topic string, partition int, offset bigint")
    offsets.write_path_tree(current, f"{workdir}/tree")
    assert {tuple(r) for r in offsets.read_path_tree(spark, f"{workdir}/tree").collect()} == {tuple(r) for r in current.collect()}
    offsets.write_path_tree(current.limit(1).withColumn("offset", F.lit(9).cast("bigint")), f"{workdir}/tree")
    assert sorted(r.offset for r in offsets.read_path_tree(spark, f"{workdir}/tree").collect()) == [0, 7, 9]


def test_a_batch_reads_about_what_it_takes(spark, workdir, monkeypatch):
    """However long the log: short row groups, files of bounded length, and small
    ranges of several partitions in one task."""
    import pyarrow.parquet as pq
    monkeypatch.setattr(stored, "FILE_ROWS", 20_000, raising=False)
    stored.write_log(messages(spark, {("t", 0): 50_000, ("u", 1): 30_000}).coalesce(1), f"{workdir}/log")
    held = stored.Files(f"{workdir}/log").list()
    assert [(a, b) for a, b, _ in held["t", 0]] == [(0, 20_000), (20_000, 40_000), (40_000, 50_000)]
    reader = stored.Reader(messages(spark, {("t", 0): 1}).schema, {"path": f"{workdir}/log", "offsets": f"{workdir}/o", "group": "g"})
    (part,) = reader.partitions({"t": {"0": 19_900}, "u": {"1": 100}}, {"t": {"0": 20_100}, "u": {"1": 300}})
    read = []
    real = pq.ParquetFile.iter_batches

    def asked(self, *a, **k):
        read.append(sum(self.metadata.row_group(g).num_rows for g in k["row_groups"]))
        return real(self, *a, **k)
    monkeypatch.setattr(pq.ParquetFile, "iter_batches", asked)
    got = [x for b in reader.read(part) for x in zip(b.column("topic").to_pylist(), b.column("offset").to_pylist())]
    assert got == [("t", o) for o in range(19_900, 20_100)] + [("u", o) for o in range(100, 300)]
    assert len(read) == 3 and max(read) <= 4096
    assert len(reader.partitions({"t": {"0": 0}}, {"t": {"0": 50_000}})) == 1
    assert [len(x.ranges) for x in stored.tasks([stored.Range("t", 0, "p", 0, n) for n in (3, 4, 9, 1, 1, 20, 2)], 8)] == [2, 1, 2, 1, 1]


def test_ranges_are_not_counted_twice(spark, workdir):
    """The guard has counted what a batch's rows span; its rows aren't read again."""
    broken = messages(spark, {("t", 0): 5}).withColumn("offset", F.raise_error(F.lit("read again")).cast("bigint"))
    spans = (("t", 0, 0, 5), (None, 2, 7, 9))
    jobs.range_work(f"{workdir}/out")(broken, sinks.Slot(3, "000000000003-x", spans))
    got = spark.read.parquet(f"{workdir}/out/tag=000000000003-x")
    assert {tuple(r) for r in got.collect()} == set(spans)
    assert [t.simpleString() for t in (f.dataType for f in got.schema)] == ["string", "int", "bigint", "bigint"]
    seen = []
    sinks.guarded(sinks.OffsetStore(spark, f"{workdir}/offsets"), "g", lambda df, slot: seen.append(slot.ranges))(messages(spark, {("t", 0): 5}), 0)
    assert seen == [(("t", 0, 0, 5),)]


def test_a_small_batch_takes_one_stage(spark, workdir):
    """A batch that one task reads is counted without a shuffle, and its ranges
    are written without a job; one of several tasks is counted as before."""
    sc, store = spark.sparkContext, sinks.OffsetStore(spark, f"{workdir}/offsets")
    fn = sinks.guarded(store, "g", jobs.range_work(f"{workdir}/out"))
    sizes = {("t", 0): 40, ("u", 1): 25}
    small = messages(spark, sizes).coalesce(1)
    sc.setJobGroup("small batch", "")
    try:
        fn(small, 0)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    tracker = sc.statusTracker()
    done = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup("small batch")]
    assert [len(j.stageIds) for j in done] == [1]
    fn(messages(spark, sizes, first=0).where("topic = 't'").withColumn("offset", F.col("offset") + 40).repartition(3), 1)
    rows = sinks.read_committed(spark, f"{workdir}/out", store, "g", jobs.OFFSET_RANGE)
    assert {tuple(r) for r in rows.collect()} == {("t", 0, 0, 40, 0), ("u", 1, 0, 25, 0), ("t", 0, 40, 80, 1)}
    fn(messages(spark, sizes).where("false"), 2)                 # no rows: no commit
    assert store.tip("g")[0] == 1


@pytest.mark.parametrize("local", [True, False])
def test_small_files(spark, workdir, monkeypatch, local):
    """The same of both ways: whole or not at all, never replaced unasked, nothing
    left behind, read by Spark."""
    if not local:
        monkeypatch.setattr(fsio, "_local", lambda fs, p: None)
    path = f"{workdir}/a b%2F/x.json"
    assert fsio.read_text(spark, path) is None
    assert fsio.write_text(spark, path, '{"a": "\u00e4"}\r\n', overwrite=False)
    assert not fsio.write_text(spark, path, "2", overwrite=False)
    assert fsio.read_text(spark, path) == '{"a": "\u00e4"}\r\n'
    assert [r.a for r in spark.read.schema("a string").json(path).collect()] == ["\u00e4"]
    assert fsio.write_bytes(spark, path, b"3", overwrite=True) and fsio.read_text(spark, path) == "3"
    assert [f for f in __import__("os").listdir(f"{workdir}/a b%2F") if not f.endswith(".crc")] == ["x.json"]


def test_a_local_checkpoint_is_written_without_processes(spark, workdir):
    """Restarts go on from it, and the session is left as it was."""
    stored.write_log(messages(spark, {("t", 0): 30}), f"{workdir}/log")
    seen = []

    class Writer:
        def start(self):
            seen.append(spark.conf.get(jobs.MANAGER, None))
    jobs._start_batches(Writer(), spark, f"{workdir}/chk")
    spark.conf.set(jobs.MANAGER, "own.Choice")
    try:
        jobs._start_batches(Writer(), spark, f"{workdir}/chk")
    finally:
        spark.conf.unset(jobs.MANAGER)
    assert seen == [jobs.BY_FILE_SYSTEM, "own.Choice"] and spark.conf.get(jobs.MANAGER, None) is None
    c = Consumer(spark, workdir, cap=20)
    c.run()
    stored.write_log(messages(spark, {("t", 0): 15}, first=30), f"{workdir}/log")
    c.run()
    assert c.seen == [{("t", 0): (0, 20)}, {("t", 0): (20, 30)}, {("t", 0): (30, 45)}]


def test_a_worker_keeps_what_the_next_batches_read(spark, workdir, monkeypatch):
    """Footers and short row groups are decoded once for the batches that lie in
    them, within bounds; each batch still gets its own rows, in one Arrow batch."""
    import pyarrow.parquet as pq
    monkeypatch.setattr(stored, "_GROUPS", stored.Kept(stored.KEPT_BYTES))
    monkeypatch.setattr(stored, "_FOOTERS", stored.Kept(stored.KEPT_FOOTERS))
    sizes = {("t", 0): 6000, ("u", 1): 2000}
    stored.write_log(messages(spark, sizes).coalesce(1), f"{workdir}/log")
    asked = []
    real = pq.ParquetFile.iter_batches
    monkeypatch.setattr(pq.ParquetFile, "iter_batches", lambda self, *a, **k: asked.append(k["row_groups"]) or real(self, *a, **k))
    options = {"path": f"{workdir}/log", "offsets": f"{workdir}/o", "group": "g", "cap": 200}
    reader = stored.Reader(messages(spark, {("t", 0): 1}).schema, options)

    def drained():
        at, sent, got = reader.initialOffset(), [], []
        for _ in range(30):
            end = reader.latestOffset()
            for part in reader.partitions(at, end):
                sent.append(list(reader.read(part)))
                got += [x for b in sent[-1] for x in zip(*(b.column(c).to_pylist() for c in ("topic", "partition", "offset", "value")))]
            at = end
        return sent, got
    sent, got = drained()
    assert sorted(got) == sorted((t, p, o, f"a,{o}") for (t, p), n in sizes.items() for o in range(n))
    assert len(sent) == 30 and {len(b) for b in sent} == {1}
    assert len(asked) == 4 and stored._FOOTERS.held == 2          # 40 ranges of three row groups; [0, 1] is one more
    assert 0 < stored._GROUPS.held <= stored.KEPT_BYTES

    for bound in ("KEPT_GROUP", "KEPT_BYTES"):              # too much to be kept: read again
        monkeypatch.setattr(stored, "_GROUPS", stored.Kept(0 if bound == "KEPT_BYTES" else stored.KEPT_BYTES))
        monkeypatch.setattr(stored, "KEPT_GROUP", 0 if bound == "KEPT_GROUP" else 1 << 20)
        asked.clear()
        reader = stored.Reader(messages(spark, {("t", 0): 1}).schema, options)
        assert drained()[1] == got and len(asked) == 40 and stored._GROUPS.held == 0


def test_what_is_kept_is_bounded():
    kept = stored.Kept(10)
    for k in range(5):
        kept.put(k, str(k), 4)
    assert kept.held == 8 and [kept.get(k) for k in range(5)] == [None, None, None, "3", "4"]
    kept.get(3)
    kept.put(5, "5", 4)                                         # the one that wasn't asked for goes
    assert kept.get(3) == "3" and kept.get(4) is None
    kept.put(3, "new", 2)
    assert kept.held == 6 and kept.get(3) == "new"
    kept.put(6, "more than all", 11)
    assert kept.held == 0 and kept.get(6) is None


def test_a_worker_acknowledges_its_task_at_once(spark, workdir, monkeypatch):
    """When it gets the reader, that is before it waits for the partition; its
    connections stay as they are."""
    import pickle
    import socket
    reader = stored.Reader(messages(spark, {("t", 0): 1}).schema, {"path": f"{workdir}/log", "offsets": f"{workdir}/o", "group": "g"})
    seen = []

    class Watched(socket.socket):
        def setsockopt(self, *a):
            seen.append((self.getsockname(), *a))
            super().setsockopt(*a)
    listener = socket.create_server(("127.0.0.1", 0))
    near = socket.create_connection(listener.getsockname())
    far, _ = listener.accept()
    one, other = socket.socketpair()
    try:
        monkeypatch.setattr(stored.socket, "socket", Watched)
        again = pickle.loads(pickle.dumps(reader))
        monkeypatch.undo()
        assert again.columns == reader.columns and again.path == reader.path
        quick = (socket.IPPROTO_TCP, socket.TCP_QUICKACK, 1)
        assert (near.getsockname(), *quick) in seen and (far.getsockname(), *quick) in seen
        assert all(x[1:] == quick for x in seen) and one.getsockname() not in [x[0] for x in seen]
        for a, b in ((near, far), (one, other)):
            a.sendall(b"x")
            assert b.recv(1) == b"x"
    finally:
        for s in (listener, near, far, one, other):
            s.close()


def test_a_batch_takes_few_calls_of_the_gateway(spark, workdir, monkeypatch):
    """Each is a message to the JVM and back; local files take none."""
    store = sinks.OffsetStore(spark, f"{workdir}/offsets")
    fn = sinks.guarded(store, "g", jobs.range_work(f"{workdir}/out"), claim=True)
    client = type(spark.sparkContext._gateway._gateway_client)
    calls, real = [], client.send_command
    batches = [messages(spark, {("t", 0): 20, ("u", 1): 20}, first=20 * k).coalesce(1) for k in range(4)]
    for k, df in enumerate(batches):
        if k == 2:
            monkeypatch.setattr(client, "send_command", lambda self, *a, **b: calls.append(a[0]) or real(self, *a, **b))
            monkeypatch.setattr(fsio, "_open", None)
        fn(df, k)
    monkeypatch.undo()
    assert store.current_map("g") == {("t", 0): 80, ("u", 1): 80}
    assert len(sinks.read_committed(spark, f"{workdir}/out", store, "g", jobs.OFFSET_RANGE).collect()) == 8
    assert len([c for c in calls if not c.startswith("m\n")]) < 2 * 60, len(calls)     # m: what Python lets go


def test_names_of_local_files(spark, workdir):
    """As Hadoop reads them, whether asked with a scheme or without."""
    for path in (f"{workdir}/a b%2F/x+y.json", f"file:{workdir}/n/x", f"file://{workdir}/n//y"):
        assert fsio.write_text(spark, path, path, overwrite=False) and fsio.read_text(spark, path) == path
        fs, p = fsio._open(spark, path)
        assert fs.exists(p) and os.path.samefile(fsio._local_name(spark, path), fsio._name(fs, p))
    assert fsio._local_name(spark, "relative/x") == f"{os.getcwd()}/relative/x"
    assert [fsio._ROOT.match(x) for x in ("hdfs://host/x", "s3a://b/x", "//x", "x/y", "host:80/x")][:4] == [None] * 4
