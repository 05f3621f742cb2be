"""Whitening of embeddings: centred covariance on Spark, its leading eigenvectors, projection by a broadcast matrix.

Entries are put on a grid of whole numbers, ``floor(scale * c) + shift``, so that sums are exact in any order.  Vectors
that are null, or have a null or non-finite entry or one that no long holds on the grid, are left out; so are those of
another length than the most common one (of equally common ones the longer).  Repeated rows count each time.

The covariance has the divisor n and is summed from centred rows, a matrix per task; the matrices are added up row by row
in a shuffle, so the driver sees one of them.  There it is brought to tridiagonal form by Householder reflections, its
leading eigenvalues are found by bisection with Sturm counts, and their vectors by inverse iteration, made orthogonal
again inside of clusters of close eigenvalues.  Its size is that of the vectors squared and never grows with the rows.
Components with no variance beyond rounding are left out, as there is nothing to divide by; an empty table, or one of
equal vectors, has no components.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructType

COMPONENTS, SCALE, SHIFT = 32, 64.0, 1_000_000
#: Lengths whose sums a task holds at once; further ones are sent on.
LENGTHS = 64
#: Eigenvalues closer than this part of the norm are one cluster.
CLUSTER = 1e-3
LONG = 1 << 63


# --- the symmetric eigenproblem ------------------------------------------------------------------------------------

def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and the unit vectors of the Householder reflections, first one first."""
    a = np.array(matrix, float)
    n = len(a)
    reflections = []
    for k in range(n - 2):
        x = a[k + 1:, k].copy()
        x[0] += np.copysign(np.linalg.norm(x), x[0])
        size = np.linalg.norm(x)
        v = x / size if size > 0 else x
        reflections.append(v)
        p = 2 * (a[k + 1:, k + 1:] @ v)
        w = p - v * (v @ p)
        a[k + 1:, k + 1:] -= np.outer(v, w) + np.outer(w, v)
        a[k + 1:, k] -= 2 * v * (v @ a[k + 1:, k])
        a[k, k + 1:] = a[k + 1:, k]
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflections


def counts_below(diag: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues are smaller, for each entry of ``at``: the negative pivots of T - x."""
    tiny = np.finfo(float).tiny / np.finfo(float).eps
    found = np.zeros(len(at), int)
    pivot = np.ones(len(at))
    for i, d in enumerate(diag):
        pivot = d - at - (off[i - 1] ** 2 / pivot if i else 0.0)
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        found += pivot < 0
    return found


def leading_eigenvalues(diag: np.ndarray, off: np.ndarray, count: int) -> np.ndarray:
    """The ``count`` largest, falling, each by bisection until its interval has no double inside."""
    n = len(diag)
    reach = np.abs(np.concatenate([[0.0], off])) + np.abs(np.concatenate([off, [0.0]]))
    edge = max(np.abs(diag + reach).max(), np.abs(diag - reach).max()) * (1 + 1e-12) + np.finfo(float).tiny
    low, high = np.full(count, (diag - reach).min() - edge * 1e-12), np.full(count, (diag + reach).max() + edge * 1e-12)
    rank = n - np.arange(count)  # so many eigenvalues are not larger
    least = np.finfo(float).eps * edge * 2.0 ** -8
    for _ in range(2100):
        middle = low + (high - low) / 2
        if np.all((middle <= low) | (middle >= high) | (high - low <= np.maximum(least, np.spacing(np.abs(middle))))):
            break
        up = counts_below(diag, off, middle) >= rank
        high, low = np.where(up, middle, high), np.where(up, low, middle)
    return low + (high - low) / 2


def _factor(diag: np.ndarray, off: np.ndarray, shift: float, least: float) -> Callable[[np.ndarray], np.ndarray]:
    """Solver of (T - shift) x = b by elimination with row exchanges; pivots are at least ``least``."""
    n = len(diag)
    main, upper, second = (diag - shift).tolist(), [*off.tolist(), 0.0], [0.0] * n
    factors, swapped = [0.0] * n, [False] * n
    for i in range(n - 1):
        below = float(off[i])
        if abs(below) > abs(main[i]):
            swapped[i] = True
            factors[i] = main[i] / below
            main[i], upper[i], after = below, main[i + 1], upper[i]
            main[i + 1] = after - factors[i] * upper[i]
            second[i], upper[i + 1] = upper[i + 1], -factors[i] * upper[i + 1]
        else:
            if abs(main[i]) < least:
                main[i] = math.copysign(least, main[i])
            factors[i] = below / main[i]
            main[i + 1] -= factors[i] * upper[i]
    if abs(main[-1]) < least:
        main[-1] = math.copysign(least, main[-1])

    def solve(b: np.ndarray) -> np.ndarray:
        x = [*b.tolist(), 0.0, 0.0]
        for i in range(n - 1):
            if swapped[i]:
                x[i], x[i + 1] = x[i + 1], x[i]
            x[i + 1] -= factors[i] * x[i]
        for i in range(n - 1, -1, -1):
            x[i] = (x[i] - upper[i] * x[i + 1] - second[i] * x[i + 2]) / main[i]
        return np.array(x[:n])

    return solve


def tridiagonal_vectors(diag: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors for falling ``values``, one a row, orthogonal to those of the same cluster."""
    n = len(diag)
    norm = max(np.abs(diag).max(), np.abs(off).max() if len(off) else 0.0)
    least = max(np.finfo(float).eps * norm, np.finfo(float).tiny)
    draw = np.random.default_rng(11)
    out = np.zeros((len(values), n))
    first = 0
    for k, value in enumerate(values):
        if k and values[k - 1] - value > CLUSTER * norm:
            first = k
        # equal shifts would give the same start of the same vector
        shift = min(value, values[k - 1] - (k - first) * least) if k > first else value
        solve = _factor(diag, off, shift, least)
        x = draw.standard_normal(n)
        for _ in range(6):
            x /= np.abs(x).max()
            x = solve(x)
            x /= np.abs(x).max()
            for _ in range(2):
                x -= out[first:k].T @ (out[first:k] @ x)
            x /= np.linalg.norm(x)
        out[k] = x
    return out


def leading_components(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues of a symmetric matrix, falling, and their unit vectors, one a row.

    Eigenvalues that are zero up to rounding are left out.
    """
    n = len(matrix)
    size = np.abs(matrix).max() if n else 0.0
    if size == 0.0:
        return np.zeros(0), np.zeros((0, n))
    diag, off, reflections = tridiagonal(matrix / size)
    values = leading_eigenvalues(diag, off, min(count, n))
    values = values[values > n * np.finfo(float).eps * max(values[0], 0.0)]
    vectors = tridiagonal_vectors(diag, off, values)
    for k in range(len(reflections) - 1, -1, -1):
        v = reflections[k]
        vectors[:, k + 1:] -= 2 * np.outer(vectors[:, k + 1:] @ v, v)
    return values * size, vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


# --- on Spark ------------------------------------------------------------------------------------------------------

def _on_grid(column: pa.Array, dims: int, scale: float, shift: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the vectors of ``dims`` entries that count, and their entries on the grid."""
    lengths = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    places = np.flatnonzero(lengths == dims)
    held = column if len(places) == len(column) else column.take(pa.array(places))
    entries = held.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(places), dims)
    with np.errstate(invalid="ignore", over="ignore"):
        entries = np.floor(entries * scale)
        fits = (np.isfinite(entries) & (np.abs(entries) < 2.0 ** 62)).all(axis=1)
    return places[fits], entries[fits].astype(np.int64) + shift


def _sums(x: np.ndarray) -> list[int]:
    """Exact column sums."""
    top = int(np.abs(x).max()) if x.size else 0
    return [int(v) for v in (x.sum(axis=0) if top * len(x) < LONG else x.astype(object).sum(axis=0))]


@dataclass(frozen=True)
class Whitening:
    """Count and exact sums of the vectors that were fitted, and the components, falling."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    scale: float
    shift: int

    @property
    def dims(self) -> int:
        return len(self.sums)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - mean; whole parts are taken off first, so that nothing is lost to the shift."""
        whole = [s // self.n for s in self.sums]
        part = np.array([(s - w * self.n) / self.n for s, w in zip(self.sums, whole)])
        return (x - np.array(whole, np.int64)).astype(float) - part

    def projected(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.vectors / np.sqrt(self.values)[:, None]).T

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """The exact sum over dimensions of (n * x - sum)**2; null where no long holds it."""
        whole = [s // self.n for s in self.sums]
        part = [s - w * self.n for s, w in zip(self.sums, whole)]
        d = x - np.array(whole, np.int64)
        top = int(np.abs(d).max()) + 1 if d.size else 1
        if (self.n * top) ** 2 * max(self.dims, 1) < LONG:
            return ((self.n * d - np.array(part, np.int64)) ** 2).sum(axis=1).tolist()
        rows = d.astype(object) * self.n - np.array(part, object)
        return [v if v < LONG else None for v in ((row * row).sum() for row in rows)]


def _lengths_and_sums(vectors: DataFrame, scale: float, shift: int) -> tuple[int, list[int]]:
    """Vectors of the most common length, and their exact sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[int]] = {}

        def send() -> pa.RecordBatch:
            rows = [(d, k - 1, str(v)) for d, entries in held.items() for k, v in enumerate(entries)]
            held.clear()
            return pa.RecordBatch.from_pydict({"dims": pa.array([r[0] for r in rows], pa.int32()), "place": pa.array([r[1] for r in rows], pa.int32()),
                                               "value": pa.array([r[2] for r in rows], pa.string())})

        for batch in batches:
            column = batch.column(0)
            for dims in {n for n in column.value_lengths().unique().to_pylist() if n}:
                places, x = _on_grid(column, dims, scale, shift)
                if len(places):
                    old = held.get(dims, [0] * (dims + 1))
                    held[dims] = [a + b for a, b in zip(old, [len(places), *_sums(x)])]
                if len(held) > LENGTHS:
                    yield send()
        yield send()

    parts = vectors.mapInArrow(run, "dims int, place int, value string")
    totals = parts.groupBy("dims", "place").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    best = totals.where("place = -1").orderBy(F.desc("value"), F.desc("dims")).first()
    if best is None:
        return 0, []
    rows = totals.where(F.col("dims") == best["dims"]).collect()
    found = {r["place"]: int(r["value"]) for r in rows}
    return found[-1], [found[k] for k in range(best["dims"])]


def _cross_products(vectors: DataFrame, dims: int, scale: float, shift: int, size: int,
                    change: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum of y y' over all vectors, y being ``change(x)`` of ``size`` entries."""

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            y = change(_on_grid(batch.column(0), dims, scale, shift)[1])
            total += y.T @ y
        if total.any():
            yield pa.RecordBatch.from_pydict({"place": pa.array(range(size), pa.int32()), "entries": pa.array(list(total), pa.list_(pa.float64()))})

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for place, entries in zip(batch.column(0).to_pylist(), batch.column(1)):
                held[place] = held.get(place, 0.0) + entries.values.to_numpy()
        yield pa.RecordBatch.from_pydict({"place": pa.array(list(held), pa.int32()), "entries": pa.array(list(held.values()), pa.list_(pa.float64()))})

    schema = "place int, entries array<double>"
    rows = vectors.mapInArrow(matrices, schema).repartition("place").mapInArrow(added, schema).collect()
    out = np.zeros((size, size))
    for r in rows:
        out[r["place"]] = r["entries"]
    return out


def _only(df: DataFrame, vector_col: str) -> DataFrame:
    return df.select(F.col(vector_col).cast("array<double>").alias("vector")).where("vector IS NOT NULL")


def fit(df: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS, scale: float = SCALE, shift: int = SHIFT) -> Whitening:
    """Components of all vectors of the table; two passes over it."""
    vectors = _only(df, vector_col)
    n, sums = _lengths_and_sums(vectors, scale, shift)
    if not n:
        return Whitening(0, (), np.zeros(0), np.zeros((0, 0)), 0.0, scale, shift)
    dims = len(sums)
    plain = Whitening(n, tuple(sums), np.zeros(0), np.zeros((0, dims)), 0.0, scale, shift)
    covariance = _cross_products(vectors, dims, scale, shift, dims, plain.centred) / n
    values, found = leading_components((covariance + covariance.T) / 2, components)
    return Whitening(n, tuple(sums), values, found, float(np.trace(covariance)), scale, shift)


def identity_error(df: DataFrame, model: Whitening, vector_col: str = "embedding") -> float:
    """Largest absolute entry of the whitened vectors' covariance minus the identity, over all vectors."""
    if not len(model.values):
        return 0.0
    shared = df.sparkSession.sparkContext.broadcast(model)
    size = len(model.values) + 1

    def change(x: np.ndarray) -> np.ndarray:
        return np.hstack([shared.value.projected(x), np.ones((len(x), 1))])

    total = _cross_products(_only(df, vector_col), model.dims, model.scale, model.shift, size, change) / model.n
    mean = total[-1, :-1]
    return float(np.abs(total[:-1, :-1] - np.outer(mean, mean) - np.eye(size - 1)).max())


def whiten(df: DataFrame, model: Whitening, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, row, deviation, whitened``: the vectors that count, on the components, over the root of their variance.

    ``row`` has the other columns.  ``deviation`` is the exact sum over dimensions of (n * x - S)**2, null beyond a long.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    rest = [df[c] for c in df.columns if c not in (id_col, vector_col)] or [F.lit(None).cast("int").alias("none")]
    held = df.select(F.col(id_col).alias("vec_id"), F.struct(*rest).alias("row"), F.col(vector_col).cast("array<double>").alias("vector"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            if not model.n:
                continue
            places, x = _on_grid(batch.column(2), model.dims, model.scale, model.shift)
            if not len(places):
                continue
            kept = pa.array(places)
            y = model.projected(x)
            offsets = pa.array(np.arange(len(places) + 1, dtype=np.int32) * y.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(kept), batch.column(1).take(kept), pa.array(model.deviations(x), pa.int64()),
                 pa.ListArray.from_arrays(offsets, pa.array(y.ravel(), pa.float64()))], ["vec_id", "row", "deviation", "whitened"])

    schema = StructType([held.schema["vec_id"], held.schema["row"]]).add("deviation", "long").add("whitened", ArrayType(DoubleType()))
    return held.mapInArrow(run, schema)
