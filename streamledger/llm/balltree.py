"""Exact top-k by inner product: ball trees, branch and bound, a shared bound.

Vectors become integer codes, floor(scale * x).  ``build`` cuts them into
shards of a few thousand and stores each as one row: its codes in leaf order
and a ball tree over them.  ``search`` takes queries in blocks.  No code in a
ball of center c and radius r has a product with q above q.c + |q| r, so nodes
are opened in the order of that bound, and never when it is below the k-th
score a query already has.  That k-th score is shared: one shard is searched
first for the whole block, its k-th scores are sent to all tasks, and a task
carries its own from shard to shard.

Each task returns k candidates for a query; they meet by query.

Definitions: a vector that is null, holds a null or a component that is not
finite, or has no id, takes no part.  A finite component whose code is 2**62 or
more, and a product that doesn't fit into 64 bits, are errors, never dropped.  Products are taken between vectors of
equal length.  A query's own row is left out, other rows with its id are not.
Ties go to the smaller id.  Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

SHARD_ROWS = 8192
LEAF_ROWS = 64
QUERY_ROWS = 4096           # queries sent to the tasks at once

INDEX = "shard long, dim int, ids binary, codes binary, tree binary, spheres binary"
_LEAST = np.iinfo(np.int64).min
_EXACT = float(1 << 53)


# ------------------------------------------------------------------ the tree

def ball_tree(codes: np.ndarray, leaf: int = LEAF_ROWS):
    """(order of rows, nodes, spheres): a node is (first row, end row, left
    child or -1), its right child is the next after the left one; a sphere is
    the center and the radius."""
    points = codes.astype(np.float64)
    order = np.arange(len(points))
    nodes, spheres, todo = [(0, len(points), -1)], [], 0
    while todo < len(nodes):
        lo, hi, _ = nodes[todo]
        own = points[order[lo:hi]]
        center = own.mean(axis=0)
        away = ((own - center) ** 2).sum(axis=1)
        spheres.append(np.append(center, np.sqrt(away.max())))
        if hi - lo > leaf:
            one = own[away.argmax()]
            other = own[((own - one) ** 2).sum(axis=1).argmax()]
            side = np.argsort(own @ (other - one), kind="stable")
            order[lo:hi] = order[lo:hi][side]
            mid = (lo + hi) // 2
            nodes[todo] = (lo, hi, len(nodes))
            nodes += [(lo, mid, -1), (mid, hi, -1)]
        todo += 1
    return order, np.array(nodes, np.int64), np.array(spheres)


class TopK:
    """The k best (score, id) of every query of a block so far."""

    def __init__(self, queries: int, k: int, floor: np.ndarray | None = None):
        self.k = k
        self.scores = np.full((queries, k), _LEAST)
        self.ids = np.zeros((queries, k), np.int64)
        self.floor = np.full(queries, _LEAST) if floor is None else floor

    def bound(self) -> np.ndarray:
        """What a row must reach to matter."""
        return np.maximum(self.scores[:, -1], self.floor)

    def add(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """New candidates: scores[i] are those of query rows[i] with ``ids``."""
        score = np.concatenate((self.scores[rows], scores), axis=1)
        name = np.concatenate((self.ids[rows], np.broadcast_to(ids, scores.shape)), axis=1)
        by = np.lexsort((name, ~score), axis=1)          # ~ turns 64-bit integers around without overflow
        by = by[:, :self.k]
        self.scores[rows] = np.take_along_axis(score, by, 1)
        self.ids[rows] = np.take_along_axis(name, by, 1)


def _products(q: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Integer inner products; by floats where every sum is exact in them."""
    reach = float(np.abs(q).max(initial=0)) * float(np.abs(codes).max(initial=0)) * max(q.shape[1], 1)
    if reach < _EXACT:
        return (q.astype(np.float64) @ codes.astype(np.float64).T).astype(np.int64)
    if reach < 2.0 ** 62:
        return q @ codes.T
    exact = q.astype(object) @ codes.astype(object).T
    if exact.size and (exact.max() >= 2 ** 63 or exact.min() <= _LEAST):
        raise ArithmeticError("a score is past a 64-bit integer")
    return exact.astype(np.int64)


def search_shard(top: TopK, q: np.ndarray, own: np.ndarray, shard: int, ids: np.ndarray, codes: np.ndarray,
                 nodes: np.ndarray, spheres: np.ndarray) -> None:
    """Branch and bound over one shard for a block of queries.  ``own`` has
    each query's (shard, row)."""
    import heapq
    qf = q.astype(np.float64)
    length = np.sqrt((qf ** 2).sum(axis=1))
    centers, radius = spheres[:, :-1], spheres[:, -1]
    upper = qf @ centers.T + length[:, None] * radius
    upper += 1e-9 * (length[:, None] * (np.sqrt((centers ** 2).sum(axis=1)) + radius)) + 1e-6   # rounding
    heap = [(-upper[:, 0].max(initial=-np.inf), 0)]
    while heap:
        _, node = heapq.heappop(heap)
        live = np.flatnonzero(upper[:, node] >= top.bound())
        if len(live) == 0:
            continue
        lo, hi, left = nodes[node].tolist()
        if left >= 0:
            for child in (left, left + 1):
                heapq.heappush(heap, (-upper[live, child].max(), child))
            continue
        scores = _products(q[live], codes[lo:hi])
        here = own[live]
        mine = np.flatnonzero((here[:, 0] == shard) & (here[:, 1] >= lo) & (here[:, 1] < hi))
        scores[mine, here[mine, 1] - lo] = _LEAST
        top.add(live, scores, ids[lo:hi])


# --------------------------------------------------------------------- Spark

def build(vectors: DataFrame, scale: int = 1024, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The index's rows, a shard each; ``vectors`` needs vec_id and embedding."""
    def shard(part: int, count: int, dim: int, ids: list, codes: list):
        ids, codes = np.concatenate(ids), np.concatenate(codes)
        order, nodes, spheres = ball_tree(codes)
        return pa.RecordBatch.from_arrays([
            pa.array([(part << 32) + count], pa.int64()), pa.array([dim], pa.int32()),
            *(pa.array([x.tobytes()], pa.binary()) for x in (ids[order], codes[order], nodes, spheres))],
            ["shard", "dim", "ids", "codes", "tree", "spheres"])

    def task(batches):
        from pyspark import TaskContext
        part, count = TaskContext.get().partitionId(), 0
        held: dict[int, tuple[list, list, int]] = {}
        for batch in batches:
            for dim, ids, codes in _codes(batch, scale):
                for lo in range(0, len(ids), shard_rows):
                    a, b, n = held.get(dim, ([], [], 0))
                    a.append(ids[lo:lo + shard_rows])
                    b.append(codes[lo:lo + shard_rows])
                    held[dim] = (a, b, n + len(a[-1]))
                    if held[dim][2] >= shard_rows:
                        yield shard(part, count, dim, a, b)
                        count += 1
                        del held[dim]
        for dim, (a, b, _) in held.items():
            yield shard(part, count, dim, a, b)
            count += 1

    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                          F.col("embedding").cast("array<double>").alias("embedding")).mapInArrow(task, INDEX)


def _codes(batch: pa.RecordBatch, scale: int):
    """(length, ids, codes) of the vectors that take part, by their length."""
    ids, column = batch.column("vec_id"), batch.column("embedding")
    if len(column) == 0:
        return
    sizes = np.asarray(column.value_lengths().fill_null(-1))
    flat = column.flatten()
    good = np.asarray(flat.is_valid()) & np.isfinite(flat.fill_null(np.nan).to_numpy(zero_copy_only=False))
    values = np.floor(np.where(good, flat.fill_null(0.0).to_numpy(zero_copy_only=False), 0.0) * scale)
    large = np.abs(values) >= 2.0 ** 62
    starts = np.concatenate(([0], np.cumsum(np.maximum(sizes, 0))))
    wrong = np.concatenate(([0], np.cumsum(~good)))
    ok = (sizes >= 0) & (wrong[starts[1:]] == wrong[starts[:-1]]) & np.asarray(ids.is_valid())
    if large.any() and (wrong[starts[1:]] == wrong[starts[:-1]])[np.searchsorted(starts, np.flatnonzero(large), "right") - 1].any():
        raise ArithmeticError("a component is past the range of integer codes, 2**62")
    names = ids.fill_null(0).to_numpy(zero_copy_only=False)
    for dim in np.unique(sizes[ok]).tolist():
        rows = np.flatnonzero(ok & (sizes == dim))
        codes = values[starts[rows][:, None] + np.arange(dim)].astype(np.int64)
        yield dim, names[rows].astype(np.int64), codes


def _load(batch: pa.RecordBatch, row: int):
    get = lambda c: batch.column(c)[row].as_py()
    dim = get("dim")
    ids = np.frombuffer(get("ids"), np.int64)
    return (get("shard"), dim, ids, np.frombuffer(get("codes"), np.int64).reshape(len(ids), dim),
            np.frombuffer(get("tree"), np.int64).reshape(-1, 3),
            np.frombuffer(get("spheres"), np.float64).reshape(-1, dim + 1))


def _queries(every: int):
    def task(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                shard, dim, ids, codes, _, _ = _load(batch, row)
                at = np.flatnonzero(ids % every == 0)
                yield pa.RecordBatch.from_arrays([
                    pa.array([shard] * len(at), pa.int64()), pa.array(at), pa.array(ids[at]),
                    pa.array([dim] * len(at), pa.int32()), pa.array([codes[i].tobytes() for i in at], pa.binary())],
                    ["shard", "at", "query_id", "dim", "code"])
    return task


def _search(sent, k: int):
    """Candidates of one task for the block of queries it was sent: (dim,
    own places, codes, lower bounds)."""
    def task(batches):
        dim, own, q, floor = sent.value
        top = TopK(len(q), k, floor)
        for batch in batches:
            for row in range(batch.num_rows):
                shard, length, ids, codes, nodes, spheres = _load(batch, row)
                if length == dim:
                    search_shard(top, q, own, shard, ids, codes, nodes, spheres)
        at, rank = np.nonzero(top.scores > _LEAST)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at), pa.array(top.ids[at, rank]), pa.array(top.scores[at, rank])], ["q", "vec_id", "score"])
    return task


def top_k(vectors: DataFrame, k: int = 10, every: int = 100, scale: int = 1024,
          shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """The k best rows for every query row (id divisible by ``every``):
    query_id, rank, vec_id, score."""
    spark = vectors.sparkSession
    index = materialize(build(vectors, scale, shard_rows), "balltree-index")
    queries = materialize(index.mapInArrow(_queries(every), "shard long, at long, query_id long, dim int, code binary"),
                          "balltree-queries")
    found = spark.createDataFrame([], "shard long, at long, query_id long, vec_id long, score long")
    for dim, n in [(r.dim, r["count"]) for r in queries.groupBy("dim").count().collect()]:
        blocks = -(-n // query_rows)
        block = F.pmod(F.xxhash64("shard", "at"), F.lit(blocks))
        for b in range(blocks):
            # one block of queries: about query_rows rows of one length
            rows = queries.where((F.col("dim") == dim) & (block == b)).orderBy("shard", "at").collect()
            own = np.array([(r.shard, r.at) for r in rows], np.int64).reshape(-1, 2)
            q = np.frombuffer(b"".join(r.code for r in rows), np.int64).reshape(len(rows), dim)
            first = _search(spark.sparkContext.broadcast((dim, own, q, None)), k)
            sample = index.where(F.col("dim") == dim).limit(1).mapInArrow(first, "q long, vec_id long, score long")
            floor = np.full(len(rows), _LEAST)
            for r in sample.groupBy("q").agg(F.min("score").alias("kth"), F.count("*").alias("n")).where(F.col("n") >= k).collect():
                floor[r.q] = r.kth
            sent = spark.sparkContext.broadcast((dim, own, q, floor))
            names = spark.createDataFrame([(i, r.shard, r.at, r.query_id) for i, r in enumerate(rows)],
                                          "q long, shard long, at long, query_id long")
            hits = index.mapInArrow(_search(sent, k), "q long, vec_id long, score long")
            found = found.union(hits.join(names, "q").select("shard", "at", "query_id", "vec_id", "score"))
    best = Window.partitionBy("shard", "at").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
