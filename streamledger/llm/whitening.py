"""Embedding whitening by Chebyshev-filtered subspace iteration.

Vectors are put on an integer grid (x = floor(scale c) + shift), the leading
eigenvectors of their covariance are found, and every vector is projected on
them with unit variance.

The covariance V is never formed.  A pass over the fit list (every distinct
grid vector once) gives V Q for a narrow block Q as the distributed sum of
Xc' (Xc Q), with each row centred before it is multiplied.  A block of
``columns`` + ``guard`` vectors is

1. filtered: the three-term recurrence of a Chebyshev polynomial of V, scaled
   to stay within range, damps the spectrum below the block's smallest Ritz
   value and lets the wanted one grow; one pass a degree;
2. made orthonormal by QR;
3. turned to the Ritz vectors of V in the block (Rayleigh-Ritz; the products
   with V are kept, so the next filter's first step needs no pass).

The degree is as high as the block stands: the polynomial's ratio between the
largest and the last wanted value stays below ``_RATIO``.  The steps end when
every wanted pair is certified: its residual |V q - e q| over its gap to the
other Ritz values is below ``tolerance``, or at the floor of rounding.  If that
is not reached in ``max_steps``, an error says so.  A block that spans the whole
space is exact after one Rayleigh-Ritz step.

Definitions.  Rows whose vector is null, or holds a null or a non-finite entry,
take no part; nor do vectors without entries.  Rows of equal vectors are one in
the fit list and all come back.  Vectors of unlike lengths, and entries whose
grid value is past a 64-bit integer, raise an error.  A component whose
variance is zero but for rounding can't be scaled to one and is not returned,
so equal vectors alone give no rows, like an empty table.  A ``deviation`` past
a 64-bit integer is null; ``deviation_exact`` always holds it.  Other columns
are ignored; a null ``vec_id`` comes back as null.

One block of the driver's is dimension x (``columns`` + ``guard``) numbers; sums
come to it one row a dimension.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

GUARD = 16             # vectors of the block beyond the wanted ones
TOLERANCE = 1e-10      # of a certified eigenvector
MAX_DEGREE = 16
MAX_STEPS = 100
_RATIO = 1e9           # how far a filter may pull wanted values apart
_EPS = float(np.finfo(np.float64).eps)
_SAFE = 1 << 62


class Fit(NamedTuple):
    """What a fit list gives: its size, sums, and leading eigenpairs."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray         # falling
    vectors: np.ndarray        # a column each
    trace: float


def grid(vectors: DataFrame, column: str = "embedding", scale: int = 64, shift: int = 1_000_000) -> DataFrame:
    """(vec_id, x): the rows that take part, on the integer grid."""
    entry = F.col("v")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias("v"))
    bad = F.exists(entry, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    high, low = float(2 ** 63 - 2 ** 11 - shift), float(-2 ** 63)
    at = F.transform(entry, lambda c: F.when(
        (c * scale < high) & (c * scale >= low), F.floor(c * scale) + F.lit(shift).cast("long"))
        .otherwise(F.raise_error(F.lit("a component is past the integer grid")).cast("long")))
    return rows.where((F.size("v") > 0) & ~bad).select("vec_id", at.alias("x"))


def _matrix(column) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _scaled_deviations(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n x - S, exactly: 64-bit integers where they hold it, Python's otherwise."""
    top = max(int(np.abs(x.min())), int(np.abs(x.max()))) if x.size else 0
    if n * top + max(map(abs, sums.tolist())) < _SAFE:
        return n * x - sums.astype(np.int64)
    return n * x.astype(object) - sums


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - S/n, rounded once."""
    d = _scaled_deviations(x, n, sums)
    return d / n if d.dtype != object else np.array([[float(e) / n if abs(e) < 2 ** 53 else e / n for e in r] for r in d], float)


def _summed(fit: DataFrame, each, width: int) -> np.ndarray:
    """Sum over the fit list of ``each(x)``, a (dimension x width) array for a
    block of rows: added up within tasks, then by Spark, one row a dimension."""
    def task(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                part = each(_matrix(batch.column("x")))
                total = part if total is None else total + part
        if total is not None:
            cols = [pa.array(np.arange(len(total)))] + [pa.array(total[:, i]) for i in range(width)]
            yield pa.RecordBatch.from_arrays(cols, ["dim"] + [f"c{i}" for i in range(width)])

    schema = "dim long" + "".join(f", c{i} double" for i in range(width))
    rows = fit.select("x").mapInArrow(task, schema).groupBy("dim").agg(
        *(F.sum(f"c{i}").alias(f"c{i}") for i in range(width))).collect()
    out = np.zeros((len(rows), width))
    for r in rows:
        out[r["dim"]] = r[1:]
    return out


def _products(fit: DataFrame, n: int, sums: np.ndarray, q: np.ndarray) -> np.ndarray:
    """V Q: one pass."""
    def each(x):
        c = _centred(x, n, sums)
        return c.T @ (c @ q)
    return _summed(fit, each, q.shape[1]) / n


def totals(fit: DataFrame) -> tuple[int, np.ndarray]:
    """Rows of the fit list and its sums per dimension, exactly."""
    ends = fit.agg(F.count("*"), F.min(F.size("x")), F.max(F.size("x"))).first()
    if not ends[0]:
        return 0, np.zeros(0, object)
    if ends[1] != ends[2]:
        raise ValueError(f"vectors of {ends[1]} and of {ends[2]} entries")
    rows = fit.select(F.posexplode("x").alias("dim", "x")).groupBy("dim").agg(
        F.sum(F.col("x").cast("decimal(38,0)")).alias("s")).collect()       # a row a dimension
    sums = np.zeros(ends[1], object)
    for r in rows:
        sums[r["dim"]] = int(r["s"])
    return ends[0], sums


def _ritz(q: np.ndarray, vq: np.ndarray):
    """Ritz values (falling), vectors, and their products with V."""
    h = q.T @ vq
    values, turn = np.linalg.eigh((h + h.T) / 2)
    turn = turn[:, ::-1]
    return values[::-1], q @ turn, vq @ turn


def _degree(values: np.ndarray, columns: int, edge: float) -> int:
    """The highest degree whose filter keeps the wanted values within _RATIO."""
    reach = lambda e: math.acosh(max(2 * e / edge - 1, 1.0))
    spread = reach(values[0]) - reach(values[columns - 1])
    return max(2, min(MAX_DEGREE, int(math.log(_RATIO) / spread) if spread > 0 else MAX_DEGREE))


def _filtered(product, q, vq, values, edge: float, degree: int) -> np.ndarray:
    """The Chebyshev polynomial of V on [0, edge], of V Q known, applied to Q:
    y' = 2 s (V y - c y) / h - s t y'', scaled so that it is 1 at the top."""
    half, centre = edge / 2, edge / 2
    first = half / (values[0] - centre)
    sigma, last, now = first, q, (vq - centre * q) * (first / half)
    for _ in range(degree - 1):
        further = 1 / (2 / first - sigma)
        last, now = now, 2 * further / half * (product(now) - centre * now) - sigma * further * last
        sigma = further
    return now


def leading(product, dim: int, columns: int, guard: int = GUARD, tolerance: float = TOLERANCE,
            max_steps: int = MAX_STEPS, seed: int = 0):
    """The ``columns`` largest eigenpairs of a positive semidefinite operator,
    given by its products with a block of vectors: (values, vectors)."""
    width = min(dim, columns + guard)
    columns = min(columns, width)
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, width)))[0]
    values, q, vq = _ritz(q, product(q))
    for _ in range(max_steps):
        top = values[0]
        if top <= 0:
            return values[:0], q[:, :0]
        wanted = int((values[:columns] > dim * _EPS * top).sum())
        residual = np.linalg.norm(vq - q * values, axis=0)[:wanted]
        floor = 16 * dim * _EPS * top
        # Runs of values that are equal but for rounding are one space.
        gap = np.array([min((abs(values[j] - values[i]) for j in range(width)
                             if abs(values[j] - values[i]) > floor), default=top) for i in range(wanted)])
        if width == dim or np.all((residual <= tolerance * gap) | (residual <= floor)):
            return values[:wanted], q[:, :wanted]
        edge = max(values[-1], 64 * _EPS * top)
        if values[0] <= edge * (1 + 1e-12):       # a flat spectrum: any basis will do
            return values[:wanted], q[:, :wanted]
        y = _filtered(product, q, vq, values, edge, _degree(values, columns, edge))
        q = np.linalg.qr(np.linalg.qr(y / np.linalg.norm(y, axis=0))[0])[0]
        values, q, vq = _ritz(q, product(q))
    raise ArithmeticError(f"eigenvectors not certified after {max_steps} steps: "
                          f"residuals over gaps up to {float((residual / gap).max()):.1e}")


def fit_components(fit: DataFrame, columns: int = 16, guard: int = GUARD, tolerance: float = TOLERANCE) -> Fit:
    """Leading eigenpairs of the covariance of a fit list (column ``x``)."""
    n, sums = totals(fit)
    if not n:
        return Fit(0, (), np.zeros(0), np.zeros((0, 0)), 0.0)
    variances = _summed(fit, lambda x: (_centred(x, n, sums) ** 2).sum(axis=0)[:, None], 1)[:, 0] / n
    values, vectors = leading(lambda q: _products(fit, n, sums, q), len(sums), columns, guard, tolerance)
    return Fit(n, tuple(int(s) for s in sums), values, vectors, float(math.fsum(variances)))


def _projected(x: np.ndarray, model: Fit) -> np.ndarray:
    return _centred(x, model.n, np.array(model.sums, object)) @ model.vectors / np.sqrt(model.values)


def identity_error(fit: DataFrame, model: Fit) -> float:
    """Largest entry of the whitened fit list's covariance minus the identity."""
    width = len(model.values)
    if not width:
        return 0.0
    means = _summed(fit, lambda x: _projected(x, model).sum(axis=0)[:, None], 1)[:, 0] / model.n

    def each(x):
        w = _projected(x, model) - means
        return w.T @ w
    return float(np.abs(_summed(fit, each, width) / model.n - np.eye(width)).max())


def transform(rows: DataFrame, model: Fit, error: float) -> DataFrame:
    """A row per vector of ``rows`` (vec_id, x) and component."""
    width = len(model.values)

    def task(batches):
        number = pa.array(np.arange(1, width + 1, dtype=np.int32))
        for batch in batches:
            if not batch.num_rows or not width:
                continue
            x = _matrix(batch.column("x"))
            d = _scaled_deviations(x, model.n, np.array(model.sums, object))
            exact = [str(sum(int(e) * int(e) for e in r)) for r in d] if d.dtype == object or \
                len(model.sums) * int(np.abs(d).max()) ** 2 >= _SAFE else (d * d).sum(axis=1).astype(str).tolist()
            each = np.repeat(np.arange(len(x)), width)
            explained = np.tile(model.values / model.trace, len(x))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(pa.array(each)), pa.concat_arrays([number] * len(x)),
                 pa.array(exact).take(pa.array(each)), pa.array(_projected(x, model).ravel()), pa.array(explained)],
                ["vec_id", "component", "deviation_text", "whitened", "explained"])

    out = rows.select("vec_id", "x").mapInArrow(
        task, "vec_id long, component int, deviation_text string, whitened double, explained double")
    exact = F.col("deviation_text").cast("decimal(38,0)")
    return out.select("vec_id", "component", F.lit(model.n).cast("long").alias("n"),
                      F.col("deviation_text").try_cast("long").alias("deviation"), "whitened", "explained",
                      F.lit(error).alias("identity_error"), exact.alias("deviation_exact"))


def whiten(vectors: DataFrame, columns: int = 16, scale: int = 64, shift: int = 1_000_000, guard: int = GUARD,
           tolerance: float = TOLERANCE) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error and
    deviation_exact, for every row that takes part and component up to ``columns``."""
    rows = grid(vectors, scale=scale, shift=shift)
    fit = materialize(rows.select("x").distinct(), "whitening-fit")
    model = fit_components(fit, columns, guard, tolerance)
    return transform(rows, model, identity_error(fit, model))
