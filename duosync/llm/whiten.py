"""Embedding whitening: pivoted Cholesky of the centred scatter, then one-sided Jacobi on its factor.

Statistics. Entries become whole numbers x, so sums are exact. A first pass adds up each dimension. A
second one adds up products of d = x - m, where m is the whole part of the mean: centred before
multiplying, and still whole. Tasks send one triangle of sums per so many rows; nothing else of the
vectors leaves them. From these sums the scatter about the true mean follows exactly,
n * sum (x_i - mean_i)(x_j - mean_j) = n * sum d_i d_j - r_i r_j, with r = S - n m.

Components. With symmetric pivoting, scatter = L L' with a lower trapezoid L whose columns fall in size.
Jacobi rotations from the right make L's columns orthogonal. Then L J = U sqrt(E): the columns'
squared norms are the eigenvalues, and the columns over their norms are the components. The
scatter itself is never rotated, so small eigenvalues keep their relative accuracy. This takes the
driver dimensions squared numbers, whatever the number of vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duosync.llm.common import Scratch

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
# Rows whose products are added up as one matrix product.
BLOCK_ROWS = 1 << 14
# Whole numbers beyond this are not exact as doubles.
EXACT = 1 << 53
SWEEPS = 60


class Whitening(NamedTuple):
    """A fitted whitening; ``components`` has a row per component, by falling eigenvalue."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float

    @property
    def middle(self) -> np.ndarray:
        return np.array([s // self.n for s in self.sums], np.int64)

    @property
    def rest(self) -> np.ndarray:
        """n times what the means have beyond ``middle``: at least 0, below n."""
        return np.array([s % self.n for s in self.sums], np.int64)


def numbers(column: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows are vectors of ``dims`` finite entries, and these as whole numbers."""
    column = column.cast(pa.list_(pa.float64()))
    lengths = np.diff(column.offsets.to_numpy())
    ok = np.array(column.is_valid()) & (lengths == dims)
    flat = column.filter(pa.array(ok)).flatten()
    values = flat.to_numpy(zero_copy_only=False).reshape(-1, dims)  # a null entry becomes NaN
    with np.errstate(over="ignore", invalid="ignore"):
        x = np.floor(SCALE * values) + SHIFT
        fits = (np.abs(x) < EXACT).all(axis=1)
    ok[ok] = fits
    return ok, x[fits].astype(np.int64)


def _sum_rows(dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, sums = 0, [0] * dims
        for batch in batches:
            _, x = numbers(batch.column(0), dims)
            rows += len(x)
            # Below 2 ** 53 each, at most a batch of them: split in two for an exact sum.
            high, low = (x >> 20).sum(axis=0).tolist(), (x & 0xFFFFF).sum(axis=0).tolist()
            sums = [s + (h << 20) + w for s, h, w in zip(sums, high, low, strict=True)]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(-1, dims), pa.int32()),
                    pa.array([Decimal(s) for s in [rows, *sums]], pa.decimal128(38, 0)),
                ],
                ["at", "s"],
            )

    return run


def products(d: np.ndarray) -> np.ndarray:
    """d' d as exact whole numbers (Python ones if they could pass 2 ** 53)."""
    most = int(np.abs(d).max(initial=0))
    if most * most * len(d) < EXACT:
        x = d.astype(float)
        return (x.T @ x).astype(np.int64)
    x = d.astype(object)
    return x.T @ x


def _product_rows(middle: np.ndarray):
    dims = len(middle)
    i, j = np.tril_indices(dims)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros((dims, dims), object), 0
        for batch in batches:
            _, x = numbers(batch.column(0), dims)
            for start in range(0, len(x), BLOCK_ROWS):
                total = total + products(x[start : start + BLOCK_ROWS] - middle)
            rows += len(x)
        if rows:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(i, pa.int32()),
                    pa.array(j, pa.int32()),
                    pa.array([Decimal(int(v)) for v in total[i, j]], pa.decimal128(38, 0)),
                ],
                ["i", "j", "s"],
            )

    return run


def pivoted_cholesky(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(L, order) with v[order][:, order] = L L', L lower trapezoidal, its pivots falling.

    It stops where what is left is rounding: L has as many columns as ``v`` has rank.
    """
    left, size = v.astype(float).copy(), len(v)
    order, factor = np.arange(size), np.zeros((size, size))
    least = size * np.finfo(float).eps * max(left.diagonal().max(initial=0.0), 0.0)
    for k in range(size):
        p = k + int(np.argmax(left.diagonal()[k:]))
        if left[p, p] <= least:
            return factor[:, :k], order
        left[[k, p]] = left[[p, k]]
        left[:, [k, p]] = left[:, [p, k]]
        factor[[k, p]], order[[k, p]] = factor[[p, k]], order[[p, k]]
        factor[k, k] = np.sqrt(left[k, k])
        factor[k + 1 :, k] = left[k + 1 :, k] / factor[k, k]
        left[k + 1 :, k + 1 :] -= np.outer(factor[k + 1 :, k], factor[k + 1 :, k])
    return factor, order


def _rounds(size: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Every two of ``size`` columns meet once; in a round each column is in one pair at most."""
    players = list(range(size + size % 2))
    out = []
    for _ in range(len(players) - 1):
        half = len(players) // 2
        pairs = [p for p in zip(players[:half], reversed(players[half:]), strict=True) if max(p) < size]
        out.append(tuple(np.array(side, int) for side in zip(*pairs, strict=True)))
        players = [players[0], players[-1], *players[1:-1]]
    return out


def orthogonal_columns(factor: np.ndarray) -> np.ndarray:
    """``factor`` times the rotations that make its columns orthogonal (one-sided Jacobi)."""
    a = factor.copy()
    tolerance = np.finfo(float).eps * len(a)
    for _ in range(SWEEPS):
        worst = 0.0
        for p, q in _rounds(a.shape[1]) if a.shape[1] > 1 else []:
            left, right = a[:, p], a[:, q]
            alpha, beta = (left * left).sum(0), (right * right).sum(0)
            gamma = (left * right).sum(0)
            size = np.sqrt(alpha * beta)
            off = np.divide(np.abs(gamma), size, out=np.zeros_like(size), where=size > 0)
            worst = max(worst, off.max(initial=0.0))
            turn = off > tolerance
            zeta = np.divide(beta - alpha, 2 * gamma, out=np.zeros_like(gamma), where=turn)
            t = np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            c = np.where(turn, 1 / np.hypot(1.0, t), 1.0)
            s = np.where(turn, c * t, 0.0)
            a[:, p], a[:, q] = c * left - s * right, s * left + c * right
        if worst <= tolerance:
            return a
    raise ArithmeticError("the rotations don't converge")


def eigen(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positive eigenvalues of a covariance, falling, and their unit vectors as rows."""
    factor, order = pivoted_cholesky(v)
    columns = orthogonal_columns(factor)
    norms = np.sqrt((columns * columns).sum(0))
    by_size = np.argsort(-norms, kind="stable")
    vectors = np.zeros((len(norms), len(v)))
    vectors[:, order] = (columns[:, by_size] / norms[by_size]).T
    return norms[by_size] ** 2, vectors


def dimension(vectors: DataFrame, column: str) -> int:
    """The most common length of the vectors that are not null; the larger one of two."""
    sizes = vectors.filter(F.col(column).isNotNull()).groupBy(F.size(column).alias("dims")).count()
    first = sizes.orderBy(F.desc("count"), F.desc("dims")).first()
    return first.dims if first else 0


def fit(vectors: DataFrame, column: str = "embedding") -> Whitening | None:
    """Learn the whitening from all vectors; None where there is no vector with an entry."""
    dims = dimension(vectors, column)
    source = vectors.select(F.col(column).cast("array<double>").alias("v"))
    summed = source.mapInArrow(_sum_rows(dims), "at int, s decimal(38,0)") if dims else None
    rows = summed.groupBy("at").agg(F.sum("s").alias("s")).collect() if dims else []
    if not rows:
        return None
    sums = {r.at: int(r.s) for r in rows}
    n = sums.pop(-1)
    start = Whitening(n, [sums[d] for d in range(dims)], np.zeros((0, dims)), np.zeros(0), 0.0)
    given = source.mapInArrow(_product_rows(start.middle), "i int, j int, s decimal(38,0)")
    scatter = np.zeros((dims, dims))
    trace, rest = Fraction(0), start.rest.tolist()
    for r in given.groupBy("i", "j").agg(F.sum("s").alias("s")).collect():
        exact = Fraction(n * int(r.s) - rest[r.i] * rest[r.j], n * n)
        scatter[r.i, r.j] = scatter[r.j, r.i] = float(exact)
        trace += exact if r.i == r.j else 0
    values, units = eigen(scatter)
    return start._replace(components=units, eigenvalues=values, trace=float(trace))


WHITENED = "_id long, deviation decimal(38,0), whitened array<double>"


def _whiten(model: Whitening, top: int):
    middle, rest, n = model.middle, model.rest, model.n
    units = (model.components[:top] / np.sqrt(model.eigenvalues[:top])[:, None]).T
    own = sum(r * r for r in rest.tolist())

    def deviations(d: np.ndarray) -> list[int]:
        # Sums of (n d - r) ** 2 = n * n * sum d d - 2 n sum d r + sum r r; the first two sums
        # are taken in 64 bits where they fit.
        most = int(np.abs(d).max(initial=0))
        exact = np.int64 if most * max(most, n) * d.shape[1] < 1 << 62 else object
        d, r = d.astype(exact), rest.astype(exact)
        squares, crossed = (d * d).sum(axis=1).tolist(), (d * r).sum(axis=1).tolist()
        return [n * n * s - 2 * n * c + own for s, c in zip(squares, crossed, strict=True)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok, x = numbers(batch.column(1), len(middle))
            if not len(x):
                continue
            d = x - middle
            out = (d - rest / n) @ units
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).filter(pa.array(ok)),
                    pa.array([Decimal(v) for v in deviations(d)], pa.decimal128(38, 0)),
                    pa.ListArray.from_arrays(
                        np.arange(len(out) + 1, dtype=np.int32) * out.shape[1], out.reshape(-1)
                    ),
                ],
                ["_id", "deviation", "whitened"],
            )

    return run


def whiten(
    vectors: DataFrame,
    model: Whitening,
    top: int = COMPONENTS,
    id_column: str = "vec_id",
    column: str = "embedding",
) -> DataFrame:
    """(vec_id, deviation, whitened): each usable vector on the first ``top`` components."""
    source = vectors.select(
        F.col(id_column).cast("long"), F.col(column).cast("array<double>").alias("v")
    )
    found = source.mapInArrow(_whiten(model, top), WHITENED)
    return found.withColumnRenamed("_id", id_column)


def identity_error(whitened: DataFrame, top: int) -> float:
    """Largest entry of the covariance of ``whitened`` less the identity. ``covar_pop`` centres first."""
    entry = [F.col("whitened")[k] for k in range(top)]
    covariances = [F.covar_pop(entry[i], entry[j]) for i in range(top) for j in range(i + 1)]
    row = whitened.agg(*[c.alias(str(k)) for k, c in enumerate(covariances)]).first()
    wanted = [float(i == j) for i in range(top) for j in range(i + 1)]
    return max((abs(v - w) for v, w in zip(row, wanted, strict=True)), default=0.0)


def whiten_vectors(vectors: DataFrame, scratch: Scratch, top: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    A vector is usable if it has as many entries as most have and none is null, not finite, or too
    large for an exact whole number (1024 times it must stay below 2**53); the others are left out of
    the fit and of the result. There are as many components as the covariance has rank, ``top`` at most: vectors
    that are all equal give no rows, and neither do an empty table or vectors without entries. Components
    of equal eigenvalues are one choice of many. ``deviation`` is decimal(38,0). Rows that repeat or
    share an id count each and have rows each; a null id stays null. Only ``vec_id`` and
    ``embedding`` are read, whatever other columns there are.
    """
    model = fit(vectors)
    found = min(top, len(model.eigenvalues)) if model else 0
    kinds = "vec_id long, component int, n long, deviation decimal(38,0), whitened double"
    if not found:
        return vectors.sparkSession.createDataFrame(
            [], kinds + ", explained double, identity_error double"
        )
    written = scratch(whiten(vectors, model, found))
    error = identity_error(written, found)
    explained = F.array(*[F.lit(float(e / model.trace)) for e in model.eigenvalues[:found]])
    return written.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        explained[F.col("at")].alias("explained"),
        F.lit(error).alias("identity_error"),
    )
