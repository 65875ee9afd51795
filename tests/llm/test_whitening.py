import numpy as np
import pytest
from pyspark.sql import functions as F

from streamledger.llm import whitening as W
from tests.conftest import SF_SMALL


def brute(vectors, columns):
    """(vec_id -> deviation and whitened row, explained, n), by a full eigensystem."""
    rows = [(i, [int(np.floor(64 * float(c))) + 1_000_000 for c in v]) for i, v in vectors
            if v and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array([r for _, r in rows])
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = (n * fit - sums) / n
    v = centred.T @ centred / n
    values, q = np.linalg.eigh(v)
    values, q = values[::-1][:columns], q[:, ::-1][:, :columns]
    keep = values > 1e-9 * max(values[0], 1e-300)
    values, q = values[keep], q[:, keep]
    white = ((n * x - sums) / n) @ q / np.sqrt(values)
    return [i for i, _ in rows], ((n * x - sums) ** 2).sum(axis=1), white, values / np.trace(v), n


def compare(spark, df, columns=16, **how):
    got = W.whiten(df, columns=columns, **how).toPandas()
    ids, deviation, white, explained, n = brute([tuple(r) for r in df.select("vec_id", "embedding").collect()], columns)
    width = white.shape[1]
    assert len(got) == len(ids) * width and set(got.n) == {n}
    got["again"] = got.groupby(["vec_id", "component"]).cumcount()       # repeated rows
    got = got.sort_values(["vec_id", "again", "component"])
    order = np.argsort(ids, kind="stable")
    mine = got.whitened.to_numpy().reshape(-1, width)
    sign = np.sign((mine * white[order]).sum(axis=0))
    assert np.abs(mine * sign - white[order]).max() < 1e-8
    assert got.deviation.tolist() == np.repeat(deviation[order], width).tolist()
    assert [int(d) for d in got.deviation_exact] == got.deviation.tolist()
    assert np.allclose(got.explained.to_numpy()[:width], explained, rtol=1e-9)
    assert got.identity_error.max() < 1e-9


def test_equals_a_full_eigensystem(spark):
    df = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    compare(spark, df)
    compare(spark, df, columns=5, guard=3)


def test_edges_of_the_input(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(24).tolist(), "x") for i in range(60)]
    rows += rows[:30]                                         # repeated rows
    rows += [(100, rows[0][1], "y"), (None, rows[1][1], "z")]  # a copy under another id; no id
    bad = [(200, None, "n"), (201, [1.0, None] * 12, "n"), (202, [float("nan")] * 24, "n"),
           (203, [float("-inf")] + [0.0] * 23, "n"), (204, [], "n")]
    made = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>, component string")
    whole = made.where("vec_id is not null")
    compare(spark, whole, columns=4, guard=4)
    out = W.whiten(made, columns=4, guard=4)
    assert out.where("vec_id is null").count() == 4
    assert out.where("vec_id >= 200").count() == 0
    assert set(r.n for r in out.select("n").distinct().collect()) == {60}


def test_few_rows_and_low_rank(spark):
    schema = "vec_id long, embedding array<double>"
    assert W.whiten(spark.createDataFrame([], schema)).count() == 0
    same = spark.createDataFrame([(i, [1.0, 2.0, 3.0]) for i in range(5)], schema)
    assert W.whiten(same).count() == 0                        # no variance, no component
    two = spark.createDataFrame([(1, [1.0, 2.0, 3.0]), (2, [2.0, 4.0, -3.0])], schema)
    got = W.whiten(two).collect()
    assert sorted((r.vec_id, r.component, round(abs(r.whitened), 9), round(r.explained, 9)) for r in got) == \
        [(1, 1, 1.0, 1.0), (2, 1, 1.0, 1.0)]
    rng = np.random.default_rng(0)
    flat = rng.standard_normal((200, 3)) @ rng.standard_normal((3, 40))
    rows = [(i, np.round(v).tolist()) for i, v in enumerate(8 * flat)]
    compare(spark, spark.createDataFrame(rows, schema), columns=3, guard=2)


def test_large_components_and_unlike_lengths(spark):
    schema = "vec_id long, embedding array<double>"
    big = spark.createDataFrame([(i, [float(s) * 2.0 ** 50, float(i)]) for i, s in enumerate((1, -1, 3, 5))], schema)
    got = W.whiten(big, columns=1).collect()
    xs = [(int(s) * 2 ** 56 + 1_000_000, 64 * i + 1_000_000) for i, s in enumerate((1, -1, 3, 5))]
    sums = [sum(c) for c in zip(*xs)]
    for r in got:
        exact = sum((4 * c - s) ** 2 for c, s in zip(xs[r.vec_id], sums))
        assert int(r.deviation_exact) == exact and r.deviation is None
    with pytest.raises(Exception, match="past the integer grid"):
        W.whiten(spark.createDataFrame([(1, [1e300]), (2, [0.0])], schema)).count()
    with pytest.raises(ValueError, match="vectors of 1 and of 2"):
        W.whiten(spark.createDataFrame([(1, [1.0]), (2, [0.0, 1.0])], schema))


def operator(values, seed=1):
    dim = len(values)
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))[0]
    return q, lambda y: q @ (np.array(values)[:, None] * (q.T @ y))


@pytest.mark.parametrize("values", [
    np.linspace(1, 2, 120),                     # close together
    2.0 ** -np.arange(100.0),                   # falling fast
    np.concatenate(([1e6, 1e3], np.ones(98))),  # two above a flat floor
])
def test_leading_pairs(values):
    q, product = operator(np.sort(values)[::-1])
    found, vectors = W.leading(product, len(values), columns=2, guard=8)
    assert np.allclose(found, np.sort(values)[::-1][:len(found)], rtol=1e-10)
    assert np.allclose(np.abs(np.sum(vectors * q[:, :2], axis=0)), 1, atol=1e-9)


def test_filter_is_the_chebyshev_polynomial():
    values = np.array([5.0, 3.0, 1.0, 0.5, 0.0])
    product = lambda y: values[:, None] * y
    q = np.eye(5)
    for degree in (2, 3, 7):
        y = W._filtered(product, q, product(q), values, 2.0, degree)
        cheb = np.polynomial.chebyshev.Chebyshev.basis(degree)
        assert np.allclose(np.diag(y), cheb(values - 1) / cheb(values[0] - 1))


def test_uncertified_pairs_raise():
    _, product = operator(np.linspace(1, 2, 200))
    with pytest.raises(ArithmeticError, match="not certified"):
        W.leading(product, 200, columns=4, guard=2, max_steps=1)


def test_no_products_of_dimension_by_dimension(spark):
    df = W.grid(spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")).select("x").distinct()
    n, sums = W.totals(df)
    widths = []
    W.leading(lambda q: (widths.append(q.shape[1]), W._products(df, n, sums, q))[1], len(sums), 4, guard=4,
              tolerance=1e-3, max_steps=100)
    assert set(widths) == {8}
    assert df.select(F.size("x")).first()[0] == 64
