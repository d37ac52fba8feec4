"""Embedding whitening by spectrum slicing.

Vectors become integers, so their sums are exact and centring loses nothing.
Partial products of centred rows are added up per cell of the covariance; the
finished matrix has one number per pair of dimensions, however many rows there
are, and is solved where the plan is made:

1. An LDL' factorisation of the covariance minus a shift tells by the signs of
   its pivots how many eigenvalues lie above the shift (inertia). Halving
   intervals by these counts isolates each leading eigenvalue.
2. Rayleigh quotient iteration inside its interval converges cubically.
3. Two more counts, just below and just above the value found, certify that it
   is the eigenvalue with that number. Where they do not, or the quotient left
   the interval, the interval is halved again. Values that no shift can tell
   apart share one interval, and a basis of their space is found at once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhawk.llm.common import saved

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
#: different vector lengths at most, as a matrix of each is held
MOST_LENGTHS = 64
#: rows multiplied at once, and result rows per batch
BLOCK_ROWS, OUT_ROWS = 4096, 64_000
EPS = np.finfo(np.float64).eps
_PIVOT = (1 + 17 ** 0.5) / 8


def above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues of a symmetric matrix are greater than ``shift``:
    the positive pivots of LDL' = matrix - shift, with pivots of one or two
    rows (Bunch-Kaufman)."""
    a = matrix - shift * np.eye(len(matrix))
    n, i, positive = len(a), 0, 0
    while i < n:
        column = np.abs(a[i + 1:, i])
        most = column.max(initial=0.0)
        two = False
        if abs(a[i, i]) < _PIVOT * most:
            r = i + 1 + int(column.argmax())
            row = np.abs(a[r, i:])
            row[r - i] = 0
            if abs(a[i, i]) * row.max() < _PIVOT * most * most:
                two = abs(a[r, r]) < _PIVOT * row.max()
                to = i + 1 if two else i
                if to != r:
                    a[[to, r]] = a[[r, to]]
                    a[:, [to, r]] = a[:, [r, to]]
        if two:
            (p, q), (_, s) = a[i:i + 2, i:i + 2]
            det = p * s - q * q
            positive += 1 if det < 0 else 2 * (p + s > 0)
            c = a[i + 2:, i:i + 2]
            a[i + 2:, i + 2:] -= c @ (np.array([[s, -q], [-q, p]]) / det) @ c.T
            i += 2
        else:
            positive += a[i, i] > 0
            if a[i, i] != 0:
                c = a[i + 1:, i]
                a[i + 1:, i + 1:] -= np.outer(c, c / a[i, i])
            i += 1
    return int(positive)


def _solve(matrix: np.ndarray, shift: float, x: np.ndarray, tiny: float) -> np.ndarray:
    for push in (0.0, tiny, -3 * tiny):
        try:
            y = np.linalg.solve(matrix - (shift + push) * np.eye(len(matrix)), x)
        except np.linalg.LinAlgError:
            continue
        if np.isfinite(y).all():
            return y
    raise np.linalg.LinAlgError(f"no solution near the shift {shift}")


def _orthogonal(x: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        for b in basis:
            x = x - b * (b @ x)
    return x / np.linalg.norm(x)


def rayleigh(matrix: np.ndarray, low: float, high: float, near: list[np.ndarray], tiny: float) -> tuple[float, np.ndarray]:
    """An eigenvalue and unit vector by Rayleigh quotient iteration from the
    middle of an interval, orthogonal to the vectors ``near`` it."""
    x = _orthogonal(np.random.default_rng(len(matrix)).standard_normal(len(matrix)), near)
    shift = (low + high) / 2
    for _ in range(2):  # towards the vector nearest the middle
        x = _orthogonal(_solve(matrix, shift, x, tiny), near)
    best = np.inf
    for _ in range(40):
        value = float(x @ matrix @ x)
        off = float(np.linalg.norm(matrix @ x - value * x))
        if off <= tiny or off >= best and best <= 64 * tiny:
            break
        best = off
        x = _orthogonal(_solve(matrix, value, x, tiny), near)
    return float(x @ matrix @ x), x


def leading(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues, falling, and their unit vectors as columns
    (the largest entry positive), fewer where values are zero to rounding."""
    n = len(matrix)
    size = float(np.abs(matrix).sum(axis=1).max(initial=0.0))
    if not size:
        return np.empty(0), np.empty((n, 0))
    tiny = EPS * size
    least = 4 * n * tiny  # values below are zero to rounding
    k = min(k, above(matrix, least))
    values: list[float] = []
    vectors: list[np.ndarray] = []
    todo = [(least, size * (1 + 8 * EPS) + tiny, above(matrix, least), 0)]  # (low, high, above low, above high)
    while todo and len(values) < k:
        low, high, many, few = todo.pop()
        if many == few:
            continue
        near = [v for e, v in zip(values, vectors, strict=True) if e - high <= 1e-3 * size]
        middle = (low + high) / 2
        if high - low <= 8 * tiny:  # one value to rounding, of several vectors
            x = np.random.default_rng(n).standard_normal((n, many - few))
            for _ in range(4):
                x = _solve(matrix, middle, x, tiny)
                x = np.stack(_basis(x.T, near), axis=1)
            values += [middle] * (many - few)
            vectors += list(x.T)
            continue
        if many - few == 1:
            value, x = rayleigh(matrix, low, high, near, tiny)
            edge = 4 * n * tiny
            if low < value <= high and above(matrix, max(value - edge, low)) == many and above(matrix, min(value + edge, high)) == few:
                values.append(value)
                vectors.append(x)
                continue
        half = above(matrix, middle)
        todo += [(low, middle, many, half), (middle, high, half, few)]  # the upper one first
    order = np.argsort(-np.array(values), kind="stable")[:k]
    out = np.stack([vectors[i] for i in order], axis=1) if len(order) else np.empty((n, 0))
    out = out * np.where(out[np.abs(out).argmax(axis=0), np.arange(out.shape[1])] < 0, -1.0, 1.0)
    return np.array(values)[order], out


def _basis(rows: np.ndarray, near: list[np.ndarray]) -> list[np.ndarray]:
    found: list[np.ndarray] = []
    for x in rows:
        found.append(_orthogonal(x / np.linalg.norm(x), [*near, *found]))
    return found


def whole_numbers(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, dim, raw): floor(SCALE * c) + SHIFT of every component as 64-bit
    numbers; only vectors that can take part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, dims, raws = [], [], []
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                x = np.asarray(v, np.float64) if v and None not in v else None
                if x is None or not np.isfinite(x).all():
                    continue
                with np.errstate(over="ignore"):
                    x = np.floor(SCALE * x)
                if np.abs(x).max() >= 2.0 ** 62:
                    raise OverflowError(f"a component of vector {i} does not fit a long")
                ids.append(i)
                dims.append(len(x))
                raws.append((x.astype(np.int64) + SHIFT).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(dims, pa.int32()),
                                              pa.array(raws, pa.binary())], ["id", "dim", "raw"])
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    return rows.mapInArrow(run, "id long, dim int, raw binary")


@dataclass
class Fit:
    """What is known of all vectors of one length."""
    n: int
    sums: np.ndarray  # exact, as Python numbers where they may pass 64 bits
    largest: int  # of |x|
    weights: np.ndarray | None = None
    explained: np.ndarray | None = None
    identity_error: float = 0.0

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact."""
        if 2 * self.n * self.largest >= 1 << 62:
            return x.astype(object) * self.n - self.sums
        return x * self.n - self.sums.astype(np.int64)

    def squares(self, deviations: np.ndarray) -> list[int]:
        """Sum of squares of each row, exact."""
        if len(self.sums) * (2 * self.n * self.largest) ** 2 < 1 << 62:
            return (deviations * deviations).sum(axis=1).tolist()
        most = int(np.abs(deviations).max(initial=0))
        if len(self.sums) * most * most < 1 << 62:
            return (deviations * deviations).sum(axis=1).tolist()
        wide = deviations.astype(object)
        return (wide * wide).sum(axis=1).tolist()

    def centred(self, deviations: np.ndarray) -> np.ndarray:
        return deviations.astype(np.float64) / self.n


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch, np.ndarray]]:
    """(dim, rows, their numbers) of rows (id, dim, raw), of one length each."""
    for batch in batches:
        dims = batch.column(1).to_numpy()
        for dim in np.unique(dims).tolist():
            part = batch.filter(pa.array(dims == dim))
            for at in range(0, part.num_rows, BLOCK_ROWS):
                some = part.slice(at, BLOCK_ROWS)
                yield dim, some, np.frombuffer(b"".join(some.column(2).to_pylist()), np.int64).reshape(-1, dim)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(dim, place, n, total, largest) of a partition."""
    found: dict[int, list] = {}
    for dim, _, x in _blocks(batches):
        largest = int(np.abs(x).max())
        part = x.sum(axis=0) if largest * len(x) < 1 << 62 else x.astype(object).sum(axis=0)
        old = found.setdefault(dim, [0, np.zeros(dim, object), 0])
        found[dim] = [old[0] + len(x), old[1] + part.astype(object), max(old[2], largest)]
    for dim, (n, total, largest) in found.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([dim] * dim, pa.int32()), pa.array(range(dim), pa.int32()), pa.array([n] * dim, pa.int64()),
             pa.array([int(t) for t in total], pa.decimal128(38, 0)), pa.array([largest] * dim, pa.int64())],
            ["dim", "place", "n", "total", "largest"])


def _products(fits, project: bool) -> Callable:
    """(dim, cell, total): partial products of the centred rows of a partition
    (projected first, or as they are), cells on and above the diagonal."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for dim, _, x in _blocks(batches):
            fit = fits.value[dim]
            y = fit.centred(fit.deviations(x))
            if project:
                y = y @ fit.weights
            found[dim] = found.get(dim, 0.0) + y.T @ y
        for dim, total in found.items():
            upper = np.triu_indices(len(total))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(upper[0]), dim), pa.int32()), pa.array(upper[0] * len(total) + upper[1], pa.int64()),
                 pa.array(total[upper])], ["dim", "cell", "total"])
    return run


def _covariances(rows: DataFrame, fits: dict[int, Fit], project: bool = False) -> dict[int, np.ndarray]:
    shared = rows.sparkSession.sparkContext.broadcast(fits)
    cells = (rows.mapInArrow(_products(shared, project), "dim int, cell long, total double")
             .groupBy("dim", "cell").agg(F.sum("total").alias("total")).collect())
    width = {dim: fit.weights.shape[1] if project else dim for dim, fit in fits.items()}
    out = {dim: np.zeros((w, w)) for dim, w in width.items()}
    for r in cells:
        i, j = divmod(r["cell"], width[r["dim"]])
        out[r["dim"]][i, j] = out[r["dim"]][j, i] = r["total"] / fits[r["dim"]].n
    return out


def _fit(rows: DataFrame, components: int) -> dict[int, Fit]:
    lengths = [r["dim"] for r in rows.select("dim").distinct().limit(MOST_LENGTHS + 1).collect()]
    if len(lengths) > MOST_LENGTHS:
        raise ValueError(f"vectors of more than {MOST_LENGTHS} lengths")
    sums = (rows.mapInArrow(_sums, "dim int, place int, n long, total decimal(38,0), largest long")
            .groupBy("dim", "place").agg(F.sum("n").alias("n"), F.sum("total").cast("decimal(38,0)").alias("total"),
                                         F.max("largest").alias("largest")).collect())
    fits = {}
    for r in sums:
        fit = fits.setdefault(r["dim"], Fit(r["n"], np.zeros(r["dim"], object), r["largest"]))
        fit.sums[r["place"]] = int(r["total"])
    for dim, matrix in _covariances(rows, fits).items():
        values, vectors = leading(matrix, components)
        fits[dim].weights = vectors / np.sqrt(values)
        fits[dim].explained = values / np.trace(matrix) if len(values) else values
    for dim, matrix in _covariances(rows, fits, project=True).items():
        fits[dim].identity_error = float(np.abs(matrix - np.eye(len(matrix))).max(initial=0.0))
    return fits


def whiten(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """id, component (from 1), n, deviation (decimal), whitened, explained and
    identity_error for each vector and component.

    Vectors that are null, empty or hold null or non-finite entries take no
    part. Vectors of each length are a list of their own (at most 64 lengths).
    Null and repeated ids are rows like any other. Components without variance
    (to rounding) are left out, as are those beyond the length of the vectors;
    a single vector or equal vectors thus give no rows, nor do no rows. A
    component that does not fit a long raises.
    """
    rows = saved(whole_numbers(vectors, id_col, vec_col), "whole-numbers")
    shared = rows.sparkSession.sparkContext.broadcast(_fit(rows, components))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, part, x in _blocks(batches):
            fit = shared.value[dim]
            k = fit.weights.shape[1]
            if not k:
                continue
            for at in range(0, len(x), max(OUT_ROWS // k, 1)):
                some = x[at:at + max(OUT_ROWS // k, 1)]
                off = fit.deviations(some)
                ids = np.repeat(np.arange(len(some)), k)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).slice(at, len(some)).take(pa.array(ids)),
                     pa.array(np.tile(np.arange(1, k + 1), len(some)), pa.int32()),
                     pa.array(np.full(len(ids), fit.n), pa.int64()),
                     pa.array([int(s) for s in fit.squares(off)], pa.decimal128(38, 0)).take(pa.array(ids)),
                     pa.array((fit.centred(off) @ fit.weights).ravel()),
                     pa.array(np.tile(fit.explained, len(some))),
                     pa.array(np.full(len(ids), fit.identity_error))],
                    ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return rows.mapInArrow(run, "id long, component int, n long, deviation decimal(38,0), whitened double, "
                                "explained double, identity_error double")
