"""Embedding whitening by QDWH spectral divide-and-conquer.

Vectors are whole numbers here: entry c becomes x = floor(1024 c) + 100000. Two passes over the
table, each a sum of whole numbers that any partitioning gives alike: the sums S, then, centred by
the whole numbers next to S / n, the products. The covariance follows from them without rounding
but its last step. It is dims x dims, whatever the number of rows, and is taken apart on the driver:

* ``polar`` finds the orthogonal polar factor of a symmetric matrix by QDWH, the dynamically
  weighted Halley iteration (QR steps first, Cholesky steps when the weights are small);
* the factor of ``block - shift I`` has the signs of the eigenvalues' distances to the shift, so
  (I + factor) / 2 is the projector onto the invariant subspace above the shift, and a basis of it
  and of its complement splits the block in two;
* ``leading`` does so with the upper half first, down to single components, until it has enough.

The components are broadcast (``components`` x dims doubles) and each vector is projected on them,
over the square root of the eigenvalue. The whitened rows are written once; a last pass has their
covariance, each entry centred, and its greatest distance from the identity.

Defined cases: null vectors, vectors with null or non-finite entries, or with entries of 2**31 or
more in size, are left out; so are vectors of another length than the commonest (of equally common
ones the longer). Empty vectors and an empty table give no row. Components of no variance (within
rounding) are left out: one row, or equal rows, give none. Equal eigenvalues: some orthonormal basis
of their space, the same for all rows of a run. Repeated rows and null ids count as rows. A
deviation beyond a long is null. Only the id and the vector are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.llm.common import pinned, table

COMPONENTS = 8
SCALE, SHIFT = 1024, 100000
TOO_LARGE = float(1 << 31)
_EXACT = 1 << 53            # whole numbers up to here are exact in a double, sums in any order too
_EPS = float(np.finfo(np.float64).eps)


@dataclass(frozen=True)
class Whitening:
    """n, the sums S and the trace of the covariance, exact; eigenvalues, falling, and their unit vectors as rows."""
    n: int
    sums: list[int]
    trace: Fraction
    values: np.ndarray
    vectors: np.ndarray


# ----------------------------------------------------------------------------- spectral part

def polar(a: np.ndarray) -> np.ndarray:
    """Orthogonal polar factor of a symmetric matrix: its eigenvectors with the signs of its eigenvalues.

    QDWH with the least lower bound that doubles can tell from zero, so six steps do for any matrix.
    """
    eye = np.eye(len(a))
    x, low = a / max(np.linalg.norm(a), np.finfo(np.float64).tiny), _EPS / 2
    for _ in range(9):
        square = low * low
        d = np.cbrt(4 * (1 - square) / (square * square))
        wa = np.sqrt(1 + d) + np.sqrt(8 - 4 * d + 8 * (2 - square) / (square * np.sqrt(1 + d))) / 2
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        if wc > 100:
            q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, eye]))
            step = q[:len(a)] @ q[len(a):].T / np.sqrt(wc)
        else:
            root = np.linalg.cholesky(eye + wc * (x @ x))
            step = np.linalg.solve(root.T, np.linalg.solve(root, x)).T
        new = wb / wc * x + (wa - wb / wc) * step
        new = (new + new.T) / 2
        moved, x = np.linalg.norm(new - x), new
        low = min(low * (wa + wb * square) / (1 + wc * square), 1.0)
        if 1 - low < 10 * _EPS and moved < np.cbrt(_EPS):
            break
    return x


def split(block: np.ndarray, shift: float, draw: np.random.Generator) -> tuple[np.ndarray, np.ndarray, float] | None:
    """Orthonormal bases of the invariant subspaces above and below ``shift`` and what couples them; None if one is empty."""
    m = len(block)
    projector = (np.eye(m) + polar(block - shift * np.eye(m))) / 2
    k = int(round(np.trace(projector)))
    if not 0 < k < m:
        return None
    basis = draw.standard_normal((m, k))
    for _ in range(3):      # an orthonormal basis of the projector's range, refined
        basis, _ = np.linalg.qr(projector @ basis)
    whole, _ = np.linalg.qr(basis, mode="complete")
    upper, lower = whole[:, :k], whole[:, k:]
    return upper, lower, float(np.linalg.norm(lower.T @ block @ upper))


def leading(v: np.ndarray, want: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``want`` largest eigenvalues (fewer if there are fewer), falling, and unit eigenvectors as rows."""
    draw, size = np.random.default_rng(len(v)), float(np.linalg.norm(v))
    todo, values, vectors = [(np.eye(len(v)), v)] if size else [], [], []
    while todo and len(values) < want:
        basis, block = todo.pop()
        spread = np.linalg.norm(block - np.diag(np.diag(block)))
        if spread <= _EPS * size:               # single, or diagonal already
            order = np.argsort(-np.diag(block), kind="stable")
            values += np.diag(block)[order].tolist()
            vectors += list(basis[:, order].T)
            continue
        middle = float(np.trace(block)) / len(block)    # between the least and the greatest eigenvalue, always
        best = None
        for shift in (float(np.median(np.diag(block))), middle, *(middle + spread * t / 64 for t in (1, -1, 3, -3))):
            parts = split(block, shift, draw)
            if parts and (best is None or parts[2] < best[2]):
                best = parts
            if best and best[2] <= 8 * len(block) * _EPS * size:
                break
        if best is None:                        # no shift tells its eigenvalues apart: equal to rounding
            values += np.diag(block).tolist()
            vectors += list(basis.T)
            continue
        for part in (best[1], best[0]):         # the upper half is taken up first
            inner = part.T @ block @ part
            todo.append((basis @ part, (inner + inner.T) / 2))
    order = np.argsort([-x for x in values], kind="stable")[:want]
    vectors = np.array(vectors).reshape(-1, len(v))[order]
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    values = np.einsum("id,de,ie->i", vectors, v, vectors)
    sign = np.sign(vectors[np.arange(len(vectors)), np.abs(vectors).argmax(1)]) if len(vectors) else np.ones(0)
    return values, vectors * sign[:, None]


# ----------------------------------------------------------------------------- passes over the rows

def usable(vectors: DataFrame, vector: str = "embedding", vec_id: str = "vec_id") -> tuple[DataFrame, int]:
    """(vec_id, v array<double>) of the vectors that count, and their length."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    rows = rows.filter("v is not null and size(v) > 0").filter(     # NaN is above every number
        F.forall("v", lambda c: F.coalesce(F.abs(c) < F.lit(TOO_LARGE), F.lit(False))))
    common = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    dims = common["d"] if common else 0
    return rows.filter(F.size("v") == F.lit(dims)), dims


def _whole(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    """x - 100000 of every entry of the batch."""
    return np.floor(np.asarray(batch.column("v").flatten(), np.float64).reshape(-1, dims) * SCALE).astype(np.int64)


def _decimals(rows) -> pa.Array:
    return pa.array([[Decimal(int(x)) for x in row] for row in rows], pa.list_(pa.decimal128(38, 0)))


def _sums(dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * dims
        for batch in batches:
            if batch.num_rows:
                n += batch.num_rows
                total = [a + int(b) for a, b in zip(total, _whole(batch, dims).sum(0))]
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), _decimals([[n, *total]])], ["i", "sums"])
    return run


def _products(dims: int, centre: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros((dims, dims), object), False
        for batch in batches:
            if not batch.num_rows:
                continue
            z, seen = _whole(batch, dims) - centre, True
            top = int(np.abs(z).max())
            if top * top * len(z) < _EXACT:     # the products and their sums are exact as doubles
                real = z.astype(np.float64)
                part = (real.T @ real).astype(np.int64).astype(object)
            else:
                z = z.astype(object)
                part = z.T @ z
            total = total + part
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims), pa.int32()), _decimals(total)], ["i", "sums"])
    return run


def _added(partial: DataFrame, dims: int, rows: int) -> list[list[int]]:
    """Sums over the tasks' rows (i, sums); at most (dims + 1) squared numbers reach the driver."""
    out = [[0] * (dims + 1) for _ in range(rows)]
    for i, at, total in (partial.select("i", F.posexplode("sums").alias("at", "value"))
                         .groupBy("i", "at").agg(F.sum("value")).toLocalIterator()):
        out[i][at] = int(total)
    return out


_PARTIAL = "i int, sums array<decimal(38,0)>"


def fit(rows: DataFrame, dims: int, components: int = COMPONENTS) -> Whitening:
    """Covariance over all of ``rows`` (see ``usable``) and its leading components."""
    n, *sums = _added(rows.mapInArrow(_sums(dims), _PARTIAL), dims, 1)[0]
    if not n:
        return Whitening(0, [], Fraction(0), np.zeros(0), np.zeros((0, 0)))
    centre = [round(Fraction(s, n)) for s in sums]
    rest = [s - n * c for s, c in zip(sums, centre)]            # sums of what is centred, under n / 2 each
    products = _added(rows.mapInArrow(_products(dims, np.array(centre, np.int64)), _PARTIAL), dims, dims)
    exact = [[Fraction(n * products[i][j] - rest[i] * rest[j], n * n) for j in range(dims)] for i in range(dims)]
    values, vectors = leading(np.array([[float(x) for x in row] for row in exact]), components)
    trace = sum(exact[i][i] for i in range(dims))
    there = values > dims * _EPS * float(trace)
    return Whitening(n, [s + n * SHIFT for s in sums], trace, values[there], vectors[there])


def _project(dims: int, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, values, vectors = shared.value
        centre = np.array([round(Fraction(s, n)) - SHIFT for s in sums], np.int64)
        rest = [s - n * (int(c) + SHIFT) for s, c in zip(sums, centre)]
        offset = np.array([float(Fraction(r, n)) for r in rest])
        weights = (vectors / np.sqrt(values)[:, None]).T
        far = max(map(abs, rest))
        for batch in batches:
            if not batch.num_rows:
                continue
            z = _whole(batch, dims) - centre
            if dims * (n * int(np.abs(z).max()) + far) ** 2 < 1 << 63:
                deviation = ((n * z - np.array(rest, np.int64)) ** 2).sum(1).tolist()
            else:
                deviation = [x if x < 1 << 63 else None
                             for x in ((n * z.astype(object) - np.array(rest, object)) ** 2).sum(1)]
            white = (z - offset) @ weights
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(deviation, pa.int64()), pa.array(list(white), pa.list_(pa.float64()))],
                ["vec_id", "deviation", "whitened"])
    return run


def whiten(rows: DataFrame, dims: int, model: Whitening) -> DataFrame:
    """(vec_id, deviation, whitened array<double>), one row per vector; the model is broadcast."""
    shared = rows.sparkSession.sparkContext.broadcast((model.n, model.sums, model.values, model.vectors))
    return rows.mapInArrow(_project(dims, shared), "vec_id long, deviation long, whitened array<double>")


def identity_error(whitened: DataFrame, components: int) -> float:
    """Largest absolute entry of the covariance (divisor n, centred) of ``whitened`` minus the identity."""
    w = [F.col("whitened")[i] for i in range(components)]
    entries = [F.abs(F.covar_pop(w[i], w[j]) - F.lit(float(i == j))) for i in range(components) for j in range(i + 1)]
    return whitened.agg(F.greatest(*entries, F.lit(0.0)).alias("e")).first()["e"]


def op11_whiten(spark, sf_dir: str) -> DataFrame:
    """Every usable row of ``embeddings`` on up to eight components: vec_id, component, n, deviation, whitened,
    explained, identity_error."""
    rows, dims = usable(table(spark, sf_dir, "embeddings"))
    columns = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    model = fit(rows, dims) if dims > 0 else None
    if model is None or not len(model.values):
        return spark.createDataFrame([], columns)
    white = pinned(whiten(rows, dims, model))
    error = identity_error(white, len(model.values))
    explained = [float(Fraction(float(e)) / model.trace) for e in model.values]
    return white.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.array(*map(F.lit, explained))[F.col("at")].alias("explained"), F.lit(error).alias("identity_error"))
