"""Whitening of embeddings by a refined eigenvector basis.

Every vector is brought to whole numbers (``floor(scale * c)``), so the sums and
the products of centred entries are exact: each task multiplies its vectors less
the rounded mean and Spark adds the products up as decimals. The covariance of
the distinct vectors is thus known to the last bit, however many rows there are.

Eigenvectors of its float32 copy are corrected by the iteration of Ogita and
Aishima, which needs matrix products only, in extended precision. Where
eigenvalues lie too close for that, the basis of their common space is turned by
a small eigenproblem of its own (the matrix less the cluster's mean, inside that
space) before the next step.

Bounds: the driver holds one matrix of the vectors' length squared, nothing that
grows with the rows. Distinct vectors are found by one shuffle with a combine
before it, so a vector that very many rows share costs one row a task.

Defined cases: rows with a null vector, or with a null or non-finite entry, are
left out; so are rows whose vector has another length than most distinct vectors
(of equal numbers the longer). Entries beyond 64 bits after scaling are set to the
limit. Repeated rows each get their rows. A component without variance has
whitened and explained 0 and is left out of ``identity_error``; with no vector the
result is empty. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitfeat.checkpoints import cut_lineage

#: entries are multiplied by this and rounded down
SCALE = 256
#: components that are returned
COMPONENTS = 4
#: entries of vectors that a task multiplies at a time
BLOCK = 1 << 21
#: a correction this small leaves doubles as they are
DONE = 2.0**-56
_EXACT = pa.decimal128(38, 0)


@dataclass
class Whitening:
    """Number and sums of the fitted vectors, and their leading components."""

    n: int
    sums: list[int]
    values: np.ndarray
    #: a column for each component
    axes: np.ndarray
    trace: float
    identity_error: float = 0.0

    @property
    def scaled(self) -> np.ndarray:
        """Axes over the root of the eigenvalue; zero for components without variance."""
        return self.axes * np.where(self.values > 0, 1 / np.sqrt(np.where(self.values > 0, self.values, 1)), 0)


# ---- vectors

def whole_numbers(vector: Column, scale: int = SCALE) -> Column:
    """The vector as array<long>; null where an entry is missing or not finite."""
    entries = vector.cast("array<double>")
    fine = F.forall(entries, lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False)) & ~F.isnan(c))
    return F.when(fine, F.transform(entries, lambda c: F.floor(c * scale)))


def _matrices(batch: pa.RecordBatch, column: str, length: int | None = None):
    """(rows, x) for slices of a batch: row numbers and an int64 matrix, one length at a time."""
    lists = batch.column(column)
    if not len(lists):
        return
    offsets = np.asarray(lists.offsets)
    sizes = np.diff(offsets)
    flat = lists.values.to_numpy(zero_copy_only=False)
    for d in np.unique(sizes) if length is None else [length]:
        rows = np.flatnonzero(sizes == d)
        step = max(1, BLOCK // max(1, int(d)))
        for at in range(0, len(rows), step):
            own = rows[at:at + step]
            yield own, flat[offsets[own][:, None] + np.arange(int(d))].astype(np.int64, copy=False)


def _decimals(numbers) -> pa.Array:
    return pa.array([Decimal(int(v)) for v in numbers], _EXACT)


def exact_products(y: np.ndarray) -> np.ndarray:
    """y.T @ y in whole numbers. Floats are exact below 2**53, and far faster."""
    most = int(np.abs(y).max(initial=0))
    if most * most * len(y) < 1 << 53:
        f = y.astype(np.float64)
        return (f.T @ f).astype(np.int64)
    wide = y.astype(object)
    return wide.T @ wide


def distinct_vectors(rows: DataFrame, vector: str, scale: int = SCALE) -> DataFrame:
    """x: each distinct vector of whole numbers once."""
    return rows.select(whole_numbers(F.col(vector), scale).alias("x")).where("x is not null").distinct()


def _totals(fit: DataFrame) -> tuple[int, list[int]]:
    """Number and sums of the vectors of the prevailing length."""
    def run(batches):
        found: dict[int, list] = {}
        for b in batches:
            for _, x in _matrices(b, "x"):
                most = int(np.abs(x).max(initial=0))
                own = x.sum(0) if most * len(x) < 1 << 62 else x.astype(object).sum(0)
                n, s = found.get(x.shape[1], (0, 0))
                found[x.shape[1]] = (n + len(x), s + own.astype(object))
        for d, (n, s) in found.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([d] * (d + 1), pa.int32()), pa.array(range(-1, d), pa.int32()), _decimals([n, *s])],
                ["d", "i", "s"])

    sums = cut_lineage(fit.mapInArrow(run, "d int, i int, s decimal(38,0)").groupBy("d", "i").agg(
        F.sum("s").cast("decimal(38,0)").alias("s")))
    most = sums.where("i = -1").orderBy(F.desc("s"), F.desc("d")).first()
    if most is None or most.d == 0:
        return 0, []
    found = sums.where((F.col("d") == most.d) & (F.col("i") >= 0)).select("i", "s").collect()
    return int(most.s), [int(r.s) for r in sorted(found)]


def covariance(fit: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """Exact covariance over the vectors, rounded once to extended precision.

    The vectors are centred at the rounded mean; what the rounding left, at most
    a half in each dimension, is subtracted from the exact products.
    """
    d = len(sums)
    centre = [(2 * s + n) // (2 * n) for s in sums]
    upper = np.triu_indices(d)

    def run(batches):
        total = None
        for b in batches:
            for _, x in _matrices(b, "x", d):
                part = exact_products(x - np.array(centre, np.int64))[upper]
                total = part.astype(object) if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(total)), pa.int32()), _decimals(total)], ["i", "m"])

    products = fit.mapInArrow(run, "i int, m decimal(38,0)").groupBy("i").agg(F.sum("m").alias("m")).collect()
    out, rest = np.zeros((d, d), np.longdouble), [s - n * c for s, c in zip(sums, centre)]
    for r in products:
        i, j = int(upper[0][r.i]), int(upper[1][r.i])
        out[i, j] = out[j, i] = _divided(n * int(r.m) - rest[i] * rest[j], n * n)
    return out


def _divided(a: int, b: int) -> np.longdouble:
    whole, rest = divmod(a, b)
    high = np.longdouble(whole >> 40) * np.longdouble(1 << 40) + np.longdouble(whole & ((1 << 40) - 1))
    return high + np.longdouble((rest << 62) // b) / np.longdouble(1 << 62)


# ---- eigenvectors

def wide_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b to about 60 bits. Both are cut into slices short enough that every product of
    two slices is exact in doubles, which the fast matrix product then serves."""
    bits = (53 - int(np.ceil(np.log2(max(2, a.shape[1]))))) // 2
    left, right = _slices(a, bits, 1), _slices(b, bits, 0)
    out = np.zeros((len(a), b.shape[1]), np.longdouble)
    for i, (p, u) in enumerate(left):
        for q, v in right[:len(left) - i]:
            out += (p @ q) * u * v
    return out


def _slices(a: np.ndarray, bits: int, axis: int, parts: int = 3) -> list[tuple[np.ndarray, np.ndarray]]:
    """Whole numbers of so many bits and their unit, for each row (axis 1) or column, leading part first."""
    out, rest = [], np.asarray(a, np.longdouble)
    for _ in range(parts):
        unit = np.ldexp(np.longdouble(1), np.frexp(np.abs(rest).max(axis, keepdims=True))[1] - bits)
        part = np.rint(rest / unit)
        out.append((part.astype(np.float64), unit))
        rest = rest - part * unit
    return out


def refined_eigenvectors(a: np.ndarray, steps: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix, to double precision.

    One step, for a basis X: R = I - X'X, S = X'AX, eigenvalues l_i = S_ii / (1 - R_ii), and
    X + XE with E_ij = (S_ij + l_j R_ij) / (l_j - l_i), or R_ij / 2 inside a cluster.
    """
    a = np.asarray(a, np.longdouble)
    size = np.abs(a).max(initial=0)
    if size == 0:
        return np.zeros(len(a)), np.eye(len(a))
    a = a / size
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(np.longdouble)
    one = np.eye(len(a), dtype=np.longdouble)
    before = np.inf
    for step in range(steps):
        r, s = one - wide_product(x.T, x), wide_product(x.T, wide_product(a, x))
        # both are symmetric but for rounding, which small gaps would magnify
        r, s = (r + r.T) / 2, (s + s.T) / 2
        values = np.diag(s) / (1 - np.diag(r))
        order = np.argsort(-values, kind="stable")
        x, r, s, values = x[:, order], r[np.ix_(order, order)], s[np.ix_(order, order)], values[order]
        off = s - np.diag(np.diag(s))
        delta = 2 * (np.sqrt((off * off).sum()) + np.sqrt((r * r).sum()))
        gaps = values[None, :] - values[:, None]
        apart = np.abs(gaps) > delta
        e = np.where(apart, (s + values[None, :] * r) / np.where(apart, gaps, 1), r / 2)
        x = x + wide_product(x, e)
        # the error is squared by a step; past its best it only moves with the rounding
        now = np.abs(e).max()
        if now < DONE or (step > 3 and now > before / 2):
            break
        before = now
        for own in _clusters(values, delta):
            x[:, own] = _turned(a, x[:, own])
    values = (x * wide_product(a, x)).sum(0) / (x * x).sum(0)
    order = np.argsort(-values, kind="stable")
    x = x[:, order] / np.sqrt((x * x).sum(0))[order]
    return (values[order] * size).astype(np.float64), x.astype(np.float64)


def _clusters(values: np.ndarray, delta) -> list[slice]:
    """Runs of falling values that lie within delta of their neighbour."""
    cut = np.flatnonzero(np.abs(np.diff(values)) > delta) + 1
    bounds = [0, *cut.tolist(), len(values)]
    return [slice(i, j) for i, j in zip(bounds, bounds[1:]) if j - i > 1]


def _turned(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The basis x of a cluster's space, turned to eigenvectors of A inside that space.

    The cluster's mean is taken off first, so the double-precision solve sees the
    differences inside the cluster and not its size.
    """
    scale = np.sqrt((x * x).sum(0))
    x = x / scale
    inside = wide_product(x.T, wide_product(a, x))
    mean = np.trace(inside) / len(inside)
    inside = inside - mean * wide_product(x.T, x)
    width = np.abs(inside).max()
    if width == 0:
        return x
    turn = np.linalg.eigh(((inside + inside.T) / (2 * width)).astype(np.float64))[1][:, ::-1]
    return wide_product(x, turn)


# ---- the operator

def fit(rows: DataFrame, vector: str = "embedding", components: int = COMPONENTS, scale: int = SCALE) -> Whitening:
    """The leading components of the distinct vectors, checked against the data."""
    vectors = cut_lineage(distinct_vectors(rows, vector, scale))
    n, sums = _totals(vectors)
    if not n:
        return Whitening(0, [], np.empty(0), np.empty((0, 0)), 0.0)
    v = covariance(vectors, n, sums)
    trace = float(np.trace(v))
    values, axes = refined_eigenvectors(v)
    values = np.where(values > max(trace, 0.0) * len(v) * np.finfo(np.float64).eps, values, 0.0)
    model = Whitening(n, sums, values[:components], np.ascontiguousarray(axes[:, :components]), trace)
    model.identity_error = _identity_error(vectors, model)
    return model


def _deviations(x: np.ndarray, model: Whitening) -> np.ndarray:
    """n * x - sums in whole numbers."""
    most = int(np.abs(x).max(initial=0)) * model.n + max(map(abs, model.sums), default=0)
    if most < 1 << 62:
        return x * model.n - np.array(model.sums, np.int64)
    return x.astype(object) * model.n - np.array(model.sums, object)


def _whitened(deviations: np.ndarray, model: Whitening) -> np.ndarray:
    return (deviations / model.n).astype(np.float64) @ model.scaled


def _identity_error(vectors: DataFrame, model: Whitening) -> float:
    """Largest entry of the whitened vectors' covariance less the identity, measured on the data.

    Whitened vectors are centred by construction, as the exact mean was taken off.
    """
    real = np.flatnonzero(model.values > 0)
    if not len(real):
        return 0.0
    d = len(model.sums)

    def run(batches):
        total = np.zeros((len(real), len(real)))
        for b in batches:
            for _, x in _matrices(b, "x", d):
                w = _whitened(_deviations(x, model), model)[:, real]
                total += w.T @ w
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(total.size), pa.int32()), pa.array(total.ravel())], ["i", "c"])

    sums = vectors.mapInArrow(run, "i int, c double").groupBy("i").agg(F.sum("c").alias("c")).collect()
    found = np.zeros(len(real) ** 2)
    for r in sums:
        found[r.i] = r.c / model.n
    return float(np.abs(found.reshape(len(real), -1) - np.eye(len(real))).max())


def apply(rows: DataFrame, model: Whitening, vec_id: str = "vec_id", vector: str = "embedding",
          scale: int = SCALE) -> DataFrame:
    """vec_id, component, n, deviation (decimal), whitened, explained, identity_error: a row for each
    vector and component; no shuffle."""
    kind = rows.schema[vec_id].dataType.simpleString()
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        d, k = len(m.sums), len(m.values)
        explained = m.values / m.trace if m.trace > 0 else m.values
        for b in batches:
            for own, x in _matrices(b, "x", d) if m.n else ():
                y = _deviations(x, m)
                # floats bound the squares' sum: below 2**62 whole numbers of 64 bits are exact
                if float((y.astype(np.float64) ** 2).sum(1).max(initial=0)) < 2.0**62:
                    squares = (y * y).sum(1)
                else:
                    squares = (y.astype(object) ** 2).sum(1)
                w = _whitened(y, m)
                size = len(own) * k
                yield pa.RecordBatch.from_arrays(
                    [b.column("id").take(pa.array(np.repeat(own, k))),
                     pa.array(np.tile(np.arange(1, k + 1), len(own)), pa.int32()),
                     pa.array(np.full(size, m.n), pa.int64()),
                     _decimals(squares).take(pa.array(np.repeat(np.arange(len(own)), k))),
                     pa.array(w.ravel()), pa.array(np.tile(explained, len(own))),
                     pa.array(np.full(size, m.identity_error))],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    read = rows.select(F.col(vec_id).alias("id"), whole_numbers(F.col(vector), scale).alias("x"))
    return read.where("x is not null").mapInArrow(
        run, f"vec_id {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, "
             "identity_error double")
