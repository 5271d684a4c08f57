"""Embedding whitening by Chebyshev-filtered subspace iteration over distributed passes.

Vectors become whole numbers x = floor(scale * c) + offset. Their sums S and number n are exact, so a centred entry (n x - S) / n is rounded once.
The leading eigenvectors of the covariance V come from a block of more vectors than wanted:

1. A pass multiplies V with a block Q: every task adds up its own X'(XQ) over Arrow batches, and the entries are summed by
   their place. V itself is never formed; the driver holds blocks of (dimensions x block) numbers only.
2. Rayleigh-Ritz: the block's Ritz values and vectors, and the residuals |Vq - eq|. Done (certified) when every wanted residual is below
   ``tolerance`` times the largest Ritz value: each value is then that close to an eigenvalue.
3. Else the block goes through a Chebyshev polynomial of V, by its three-term recurrence, one pass a degree. All eigenvalues are at
   least 0; from there up to the smallest Ritz value of the block lies the unwanted spectrum, where the polynomial stays within 1 while it grows
   fast above. The degree is what the residuals still need, bounded so that the largest eigenvalue does not drown the smallest wanted one.
4. QR and on with 2. A block that does not settle is widened, at the most to all dimensions, where step 2 is exact.

Defined cases: rows whose vector is null, empty, holds nulls or non-finite entries, or has another length than most vectors are
left out; scaled entries beyond 2^52 count as 2^52; ``deviation`` is null where it passes 64 bits; repeated rows and null keys are rows of their
own; components without variance are left out, so one row, equal rows, or an empty table give no rows; columns with the name of a new one are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import by_place, map_in_arrow, named, stored, without

LARGEST = 1 << 52
ADDED = ("component", "n", "deviation", "whitened", "explained", "identity_error")
ROUNDS = 12          # rounds before the block is widened
DROWN = 1e8          # most that the largest eigenvalue may outgrow the smallest wanted one in a filter
ROWS = 2_000         # vectors handled at once


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, ROWS):
            yield batch.slice(lo, ROWS)


def _cells(rows: DataFrame, of, shape: tuple[int, int], kind=T.DoubleType()) -> np.ndarray:
    """The sum over all rows of the matrices that ``of`` gives for each batch of vectors (an array of whole numbers)."""
    plain = np.float64 if isinstance(kind, T.DoubleType) else np.int64
    schema = pa.schema([("c0", pa.int32()), ("c1", pa.from_numpy_dtype(plain))])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in _batches(batches):
            if batch.num_rows:
                part = of(batch.column(0))
                total = part if total is None else total + part
        if total is not None:
            yield by_place([pa.array(np.arange(total.size)), pa.array(total.ravel().astype(plain))], schema)

    out = T.StructType([T.StructField("cell", T.IntegerType()), T.StructField("value", kind)])
    found = map_in_arrow(rows, add, out).groupBy("cell").agg(F.sum("value").alias("value")).toArrow()
    cells = np.zeros(shape[0] * shape[1], plain)  # as many rows as the block has entries
    cells[found["cell"].to_numpy()] = found["value"].to_numpy()
    return cells.reshape(shape)


@dataclass(frozen=True)
class Spectrum:
    """What the vectors were fitted to: ``vectors`` has a column for each of ``values``, falling; ``residual`` certifies them."""

    n: int
    sums: np.ndarray
    trace: float
    values: np.ndarray
    vectors: np.ndarray
    residual: float
    passes: int

    def centred(self, column: pa.Array) -> np.ndarray:
        return (self.n * _matrix(column, len(self.sums)) - self.sums) / self.n


def whole_vectors(df: DataFrame, vector: str = "embedding", scale: float = 64.0, offset: int = 1_000_000) -> DataFrame:
    """The other columns of ``df`` and ``__x``, the vectors as whole numbers, stored; rows without a usable vector are left out."""
    given = named(vector).cast("array<double>")
    sound = F.forall("__v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    usable = df.select(*without(df, vector, *ADDED), given.alias("__v")).filter(F.coalesce((F.size("__v") > 0) & sound, F.lit(False)))
    x = F.transform("__v", lambda c: F.greatest(F.least(F.floor(c * scale), F.lit(LARGEST)), F.lit(-LARGEST)) + offset)
    rows = stored(usable.withColumn("__x", x).drop("__v"), "whiten")
    common = rows.groupBy(F.size("__x").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.filter(F.size("__x") == (common["d"] if common else 0))


def fit(rows: DataFrame, components: int, guard: int | None = None, tolerance: float = 1e-12, seed: int = 13) -> Spectrum | None:
    """The leading eigenpairs of the covariance of ``__x`` (divisor n), or None without rows."""
    x = rows.select("__x")
    head = x.select(F.size("__x")).first()
    if head is None:
        return None
    d = head[0]
    count = _cells(x, lambda c: np.append(_matrix(c, d).sum(axis=0), len(c)).reshape(1, -1), (1, d + 1), T.LongType())[0]
    n, sums = int(count[d]), count[:d]
    centred = Spectrum(n, sums, 0.0, np.empty(0), np.empty((d, 0)), 0.0, 0).centred
    passes = 1

    def times(block: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1

        def product(column: pa.Array) -> np.ndarray:
            m = centred(column)
            return m.T @ (m @ block)
        return _cells(x, product, block.shape) / n

    trace = float(_cells(x, lambda c: np.square(centred(c)).sum().reshape(1, 1), (1, 1))[0, 0]) / n
    wanted = min(components, d)
    none = Spectrum(n, sums, trace, np.empty(0), np.empty((d, 0)), 0.0, passes)
    if trace == 0:
        return none
    width = min(d, wanted + (max(8, wanted // 2) if guard is None else guard))
    rng = np.random.default_rng(seed)
    block = np.linalg.qr(rng.standard_normal((d, width)))[0]
    for round_ in range(1, 100 * ROUNDS):
        image = times(block)
        ritz = block.T @ image
        values, turn = np.linalg.eigh((ritz + ritz.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        block, image = block @ turn, image @ turn
        residual = float(np.linalg.norm(image - block * values, axis=0)[:wanted].max())
        if residual <= tolerance * values[0] or width == d:
            break
        if round_ % ROUNDS == 0:
            width = min(d, 2 * width)
            block = np.linalg.qr(np.hstack([block, rng.standard_normal((d, width - block.shape[1]))]))[0]
            continue
        half = max(values[-1], 1e-10 * values[0]) / 2  # the unwanted spectrum lies in [0, 2 half]

        def growth(value: float, half: float = half) -> float:
            t = max(value / half - 1, 1.0)
            return t + np.sqrt(t * t - 1)
        first, last = growth(values[0]), growth(values[wanted - 1])
        needed = np.log(residual / (tolerance * values[0])) / max(np.log(last), 1e-3) + 1
        allowed = np.log(DROWN) / max(np.log(first / last), 1e-3)
        degree = int(np.clip(min(needed, allowed), 2, 40))
        before, now = block, (image - half * block) / half  # the image of the block is known already
        for _ in range(degree - 1):
            before, now = now, 2 * (times(now) - half * now) / half - before
        block = np.linalg.qr(now / np.linalg.norm(now, axis=0))[0]
    else:
        raise RuntimeError(f"residual {residual / values[0]:.1e} of the largest eigenvalue after {passes} passes")
    keep = values[:wanted] > 1e-12 * values[0]
    return Spectrum(n, sums, trace, values[:wanted][keep], block[:, :wanted][:, keep], residual, passes)


def identity_error(rows: DataFrame, spectrum: Spectrum) -> float:
    """The largest absolute entry of the covariance of the whitened vectors less the identity, from one pass over them."""
    turn = spectrum.vectors / np.sqrt(spectrum.values)
    k = turn.shape[1]

    def square(column: pa.Array) -> np.ndarray:
        w = spectrum.centred(column) @ turn
        return w.T @ w
    mean = _cells(rows.select("__x"), lambda c: (spectrum.centred(c) @ turn).sum(axis=0).reshape(1, k), (1, k)) / spectrum.n
    both = _cells(rows.select("__x"), square, (k, k)) / spectrum.n
    return float(np.abs(both - mean.T @ mean - np.eye(k)).max())


def whiten(df: DataFrame, components: int, vector: str = "embedding", scale: float = 64.0, offset: int = 1_000_000) -> DataFrame:
    """One row for each usable vector and component: the other columns of ``df``, then

    ``component`` (from 1), ``n`` vectors fitted, ``deviation`` (exact sum of (n x - S)^2), ``whitened``, ``explained`` (share of the
    variance) and ``identity_error`` (one value, measured).
    """
    rows = whole_vectors(df, vector, scale, offset)
    spectrum = fit(rows, components)
    kinds = (T.IntegerType(), T.LongType(), T.LongType(), T.DoubleType(), T.DoubleType(), T.DoubleType())
    out = T.StructType([*rows.schema.fields[:-1], *(T.StructField(n, t) for n, t in zip(ADDED, kinds))])
    if spectrum is None or not len(spectrum.values):
        return df.sparkSession.createDataFrame([], out)
    error = identity_error(rows, spectrum)
    turn = spectrum.vectors / np.sqrt(spectrum.values)
    explained = spectrum.values / spectrum.trace
    schema, d, k = to_arrow_schema(out), len(spectrum.sums), turn.shape[1]

    def deviations(column: pa.Array) -> pa.Array:
        off = spectrum.n * _matrix(column, d) - spectrum.sums
        if int(np.abs(off).max()) ** 2 * d < 1 << 63:
            return pa.array((off * off).sum(axis=1))
        exact = [sum(int(v) ** 2 for v in row) for row in off]
        return pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batches(batches):
            m, x = batch.num_rows, batch.column(batch.num_columns - 1)
            if not m:
                continue
            again = pa.array(np.repeat(np.arange(m), k))
            white = spectrum.centred(x) @ turn
            yield by_place([*(c.take(again) for c in batch.columns[:-1]), pa.array(np.tile(np.arange(1, k + 1), m)),
                            pa.array(np.full(m * k, spectrum.n)), deviations(x).take(again), pa.array(white.ravel()),
                            pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))], schema)

    return map_in_arrow(rows, project, out)
