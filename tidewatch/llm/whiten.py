"""Whitening of vectors by a contour-integral eigensolver (FEAST).

Spark does what grows with the rows: integer components, the distinct vectors, exact sums, the
centred covariance, and the projection of every row. The driver gets d numbers and a d x d matrix.

The eigensolver works on one interval of the spectrum at a time. Symmetric indefinite
factorisations of V - tI count the eigenvalues above t (Sylvester's law of inertia), and bisection
on the counts cuts the top of the spectrum into intervals with few eigenvalues each. For an
interval, Gauss-Legendre nodes on the upper half of a circle over it give complex shifted systems
(zI - V) X = Y, whose weighted solutions project Y onto the interval's eigenvectors. Rayleigh-Ritz
on the projected block gives eigenpairs; the projection repeats until their residuals are at
rounding level and as many of them lie in the interval as the inertia counts say.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import ready, stored

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000
# Eigenvalues an interval should hold at most, quadrature nodes of a half circle, rounds of projection.
PER_INTERVAL = 8
NODES = 8
ROUNDS = 30
# Eigenvalues below this share of the largest are rounding noise of a singular covariance.
FLOOR = 1e-12


# --- eigensolver


def inertia(matrix: np.ndarray, shift: float) -> int:
    """Eigenvalues of ``matrix`` above ``shift``: positive pivots of an LDL' factorisation with 1x1 and 2x2 pivots."""
    a = matrix - shift * np.eye(len(matrix))
    above = 0
    while len(a):
        off = np.abs(a - np.diag(np.diag(a)))
        diag = np.abs(np.diag(a))
        p = int(diag.argmax())
        if len(a) == 1 or diag[p] >= 0.6404 * off.max():
            keep = np.delete(np.arange(len(a)), p)
            pivot, col = a[p, p], a[keep, p]
            above += bool(pivot > 0)
            if pivot == 0:  # all of what is left is zero
                break
            a = a[np.ix_(keep, keep)] - np.outer(col, col) / pivot
        else:
            i, j = np.unravel_index(off.argmax(), off.shape)
            keep = np.delete(np.arange(len(a)), [i, j])
            block, cols = a[np.ix_([i, j], [i, j])], a[np.ix_(keep, [i, j])]
            above += 1  # such a block has one eigenvalue of each sign
            a = a[np.ix_(keep, keep)] - cols @ np.linalg.solve(block, cols.T)
    return above


def intervals(matrix: np.ndarray, wanted: int, per_interval: int = PER_INTERVAL) -> list[tuple[float, float, int]]:
    """(low, high, count) that together hold at least the ``wanted`` largest eigenvalues above the floor."""
    top = float(np.abs(matrix).sum(axis=1).max()) * (1 + 1e-9)
    floor = top * FLOOR
    wanted = min(wanted, inertia(matrix, floor))
    out = []

    def cut(low: float, high: float, above_low: int, above_high: int) -> None:
        count = above_low - above_high
        if count == 0 or above_high >= wanted:
            return
        # A narrow interval holds equal eigenvalues, which no cut separates.
        if (count <= per_interval and above_low <= 2 * wanted) or high - low < 1e-9 * top:
            out.append((low, high, count))
            return
        middle = (low + high) / 2
        above = inertia(matrix, middle)
        cut(middle, high, above, above_high)
        cut(low, middle, above_low, above)

    if wanted:
        cut(floor, top, inertia(matrix, floor), 0)
    return out


def contour(matrix: np.ndarray, block: np.ndarray, low: float, high: float, nodes: int = NODES) -> np.ndarray:
    """``block`` projected onto the eigenvectors of the interval, by quadrature of shifted solves on a circle."""
    x, w = np.polynomial.legendre.leggauss(nodes)
    centre, radius = (low + high) / 2, (high - low) / 2
    total = np.zeros_like(block)
    for angle, weight in zip(np.pi / 2 * (1 - x), w):
        arm = radius * np.exp(1j * angle)
        solved = np.linalg.solve((centre + arm) * np.eye(len(matrix)) - matrix, block.astype(complex))
        # The lower half circle has the conjugate terms.
        total += weight / 2 * (arm * solved).real
    return total


def in_interval(matrix: np.ndarray, low: float, high: float, count: int) -> tuple[np.ndarray, np.ndarray] | None:
    """The ``count`` eigenpairs between the bounds, or None where the rounds did not find them all."""
    d, scale = len(matrix), float(np.abs(matrix).sum(axis=1).max())
    size = min(d, count + max(4, count // 2))
    block = np.random.default_rng(0).standard_normal((d, size))
    # A circle a little wider than the interval keeps eigenvalues at its ends inside.
    margin = 0.05 * (high - low) + 1e-14 * scale
    for _ in range(ROUNDS):
        basis, triangle = np.linalg.qr(contour(matrix, block, low - margin, high + margin))
        held = np.abs(np.diag(triangle))
        basis = basis[:, held > 1e-13 * held.max()] if held.max() > 0 else basis
        values, turn = np.linalg.eigh(basis.T @ matrix @ basis)
        vectors = basis @ turn
        inside = (values > low) & (values <= high)
        residual = np.linalg.norm(matrix @ vectors[:, inside] - vectors[:, inside] * values[inside], axis=0)
        if inside.sum() == count and (residual <= 4e-15 * d * scale).all():
            return values[inside], vectors[:, inside]
        block = vectors
        if block.shape[1] < size:
            fill = np.random.default_rng(block.shape[1]).standard_normal((d, size - block.shape[1]))
            block = np.hstack((block, fill))
    return None


def leading(matrix: np.ndarray, wanted: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, and their unit vectors; fewer where the rank is less.

    Where an interval does not come out whole (an eigenvalue on its end), it is widened to its
    neighbours, at last to the whole spectrum with a full block, which is exact.
    """
    found, parts = [], intervals(matrix, wanted)
    while parts:
        low, high, count = parts.pop(0)
        pair = in_interval(matrix, low, high, count)
        if pair is None and parts:
            below = parts.pop(0)
            parts.insert(0, (below[0], high, inertia(matrix, below[0]) - inertia(matrix, high)))
        elif pair is None:
            top = float(np.abs(matrix).sum(axis=1).max()) * (1 + 1e-9)
            found = [in_interval(matrix, top * FLOOR, top, inertia(matrix, top * FLOOR)) or np.linalg.eigh(matrix)]
        else:
            found.append(pair)
    if not found:
        return np.zeros(0), np.zeros((len(matrix), 0))
    # One last Rayleigh-Ritz over all intervals makes vectors of neighbouring ones orthogonal to rounding.
    basis, _ = np.linalg.qr(np.hstack([v for _, v in found]))
    values, turn = np.linalg.eigh(basis.T @ matrix @ basis)
    order = np.argsort(-values)[:wanted]
    order = order[values[order] > FLOOR * values.max()]
    return values[order], (basis @ turn)[:, order]


# --- rows


def integer_rows(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, x): floor(64 c) + 1000000 of each component; rows with null or non-finite components go."""

    def made(batches):
        for batch in batches:
            held = batch.column(1)
            ids, out = [], []
            for i, v in zip(batch.column(0).to_pylist(), held):
                if not v.is_valid or v.values.null_count:
                    continue
                c = v.values.to_numpy(zero_copy_only=False).astype(np.float64)
                x = np.floor(SCALE * c) + SHIFT
                if len(c) and np.isfinite(c).all() and (np.abs(x) < 2.0**53).all():
                    ids.append(i)
                    out.append(x.astype(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.list_(pa.int64()))], names=["vec_id", "x"])

    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), vector)
    return rows.mapInArrow(made, "vec_id long, x array<long>")


def _matrix(batch: pa.RecordBatch, column: str) -> np.ndarray:
    held = batch.column(batch.schema.get_field_index(column))
    return held.flatten().to_numpy(zero_copy_only=False).reshape(len(held), -1)


def summed(rows: DataFrame, of, shape: tuple[int, ...], kind: str = "double") -> np.ndarray:
    """Sum over all rows of the arrays ``of(matrix of a batch)``; each task sends one number per place."""
    places = int(np.prod(shape))

    def partial(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                part = of(_matrix(batch, "x"))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(places)), pa.array(total.ravel())], names=["place", "value"])

    sums = rows.select("x").mapInArrow(partial, f"place long, value {kind}").groupBy("place").agg(F.sum("value").alias("value"))
    out = np.zeros(places, np.int64 if kind == "long" else np.float64)
    for r in sums.collect():  # as many rows as places, whatever the input
        out[r["place"]] = r["value"]
    return out.reshape(shape)


@dataclass(frozen=True)
class Whitening:
    """What the rows need: count and sums of the fit list, components with their values, and the measured error."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray
    identity_error: float

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exact; in big integers where 64 bits do not hold it."""
        if self.n and len(x) and float(np.abs(x).max()) * self.n >= 2.0**62:
            return x.astype(object) * self.n - self.sums.astype(object)
        return x * self.n - self.sums

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return (self.deviations(x).astype(np.float64) / self.n) @ self.vectors / np.sqrt(self.values)


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening:
    """Whitening of the distinct ``x`` of ``rows``, which all have one length."""
    fit_list = stored(rows.select("x").distinct(), "whiten-fit")
    head = fit_list.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("d")).first()
    n, d = head["n"], head["d"] or 0
    empty = Whitening(n, np.zeros(d, np.int64), np.zeros(0), np.zeros((d, 0)), np.zeros(0), 0.0)
    if not n:
        return empty
    sums = summed(fit_list, lambda x: x.sum(axis=0), (d,), "long")
    centred = Whitening(n, sums, np.ones(d), np.eye(d), np.zeros(0), 0.0).whitened

    def spread(x):
        y = centred(x)
        return y.T @ y

    covariance = summed(fit_list, spread, (d, d)) / n
    covariance = (covariance + covariance.T) / 2
    if not covariance.any():
        return Whitening(n, sums, empty.values, empty.vectors, empty.explained, 0.0)
    values, vectors = leading(covariance, components)
    made = Whitening(n, sums, values, vectors, values / np.trace(covariance), 0.0)
    k = len(values)

    def moments(x):
        w = made.whitened(x)
        return np.vstack((w.sum(axis=0), w.T @ w))

    measured = summed(fit_list, moments, (k + 1, k)) / n
    error = float(np.abs(measured[1:] - np.outer(measured[0], measured[0]) - np.eye(k)).max())
    return Whitening(n, sums, values, vectors, made.explained, error)


OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per vector and component, components by falling eigenvalue.

    Rows whose vector is null, empty, or holds null or non-finite components (or such that 64 bits
    do not hold) are left out, and so are vectors of another length than the most frequent one
    (the longest of equally frequent). Repeated rows are whitened each and count once in the fit;
    a null vec_id stays null; other columns are not read. Components without variance are not
    returned: one distinct vector, or an empty table, gives no rows. A ``deviation`` beyond 64 bits
    is null.
    """
    spark = ready(vectors.sparkSession)
    rows = stored(integer_rows(vectors, vector), "whiten-rows")
    sizes = rows.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    best = sizes.orderBy(F.desc("n"), F.desc("d")).first()
    if best is not None:
        rows = rows.where(F.size("x") == best["d"])
    side = spark.sparkContext.broadcast(fit(rows, components))

    def projected(batches):
        model = side.value
        k = len(model.values)
        for batch in batches:
            m = batch.num_rows
            if not m or not k:
                continue
            x = _matrix(batch, "x")
            gaps = model.deviations(x)
            if gaps.dtype != object and float(np.abs(gaps).max()) ** 2 * x.shape[1] >= 2.0**62:
                gaps = gaps.astype(object)
            squares = [s if s < 2**63 else None for s in (gaps * gaps).sum(axis=1).tolist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(np.repeat(np.arange(m), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, model.n)),
                    pa.array(squares, pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                    pa.array(model.whitened(x).ravel()),
                    pa.array(np.tile(model.explained, m)),
                    pa.array(np.full(m * k, model.identity_error)),
                ],
                names=[f.split()[0] for f in OUT.split(", ")],
            )

    return rows.select("vec_id", "x").mapInArrow(projected, OUT)
