"""Embedding whitening from exact cross-products by bit-sliced scatter.

*Scatter.* An entry c becomes the integer x = floor(64 * c) + 1000000. Inside a task the integers of a block of rows
are shifted by each dimension's minimum in the block, so that few bits remain, and every dimension's bits are packed
across the rows into 64-bit words, one bit plane per word row. The product sum of two dimensions is the sum over their
planes of 2^(a + b) times the number of ones in the AND of plane a and plane b; the shifts are put back in whole
numbers. Tasks add up whole numbers of any size and hand on d * (d + 3) / 2 + 1 sums, which Spark adds as decimals.

*Fit.* The covariance n * sum(xy) - sum(x) * sum(y) is centred in whole numbers and divided by n^2 with one rounding;
only then follow the eigenvectors. What reaches the driver, and is broadcast, is bounded by the square of the width.

*Whitening.* Each row is centred with the exact mean, projected and divided by the root of the eigenvalue. The
covariance of the whitened values is measured over all rows in a pass of its own.

Rows whose vector is null or holds a null or non-finite entry are dropped; a null id stays as it is and rows that
repeat are rows of their own. Vectors of another length than the longest are padded with zeros, an empty vector is all
zeros. An integer beyond 2^62 counts as 2^62 with its sign. Equal eigenvalues keep the order the decomposition gives;
of each component the largest entry is positive. A component without variance has no whitened value (null, ``explained``
0, or null if no component has any) and no part in ``identity_error``. A deviation that no long holds is null. An empty
table gives an empty result. Only the named columns are read.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import PIECES, add_arrays, array_rows, task_number

SCALE = 64
BASE = 1_000_000
COMPONENTS = 32
BLOCK_ROWS = 8192        # rows whose planes are packed together
OUT_ROWS = 2048          # input rows per batch of the result (each becomes up to ``components`` rows)
MOST = 1 << 62
LIMB = 1 << 60           # sums travel as two decimals: the part below this number, and the rest
SUMS = "i int, j int, low decimal(38,0), high decimal(38,0)"


@dataclass
class Fit:
    n: int
    mean: np.ndarray         # whole part of each dimension's mean of floor(64 * c)
    rest: np.ndarray         # what the sum has beyond n * mean
    covariance: np.ndarray
    values: np.ndarray       # eigenvalues, falling; zero where there is no variance
    vectors: np.ndarray      # one column per component

    @property
    def dims(self) -> int:
        return len(self.mean)

    def explained(self) -> np.ndarray:
        return self.values / np.trace(self.covariance)


def usable(vector: Column) -> Column:
    return vector.isNotNull() & ~F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))


def integers(column: pa.Array, dims: int | None = None, scale: int = SCALE, most: int = MOST) -> np.ndarray:
    """floor(scale * c) of a list column, one row per vector, padded with zeros to ``dims`` (or to the longest)."""
    length = np.diff(column.offsets.to_numpy())
    dims = int(length.max(initial=0)) if dims is None else dims
    y = np.zeros((len(column), dims), dtype=np.int64)
    with np.errstate(over="ignore"):
        flat = np.floor(column.flatten().to_numpy(zero_copy_only=False) * float(scale))
    y[np.arange(dims) < length[:, None]] = np.clip(flat, -float(most), float(most)).astype(np.int64)
    return y


def planes(u: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bit planes of unsigned integers (rows x dims): packed words (plane x word), dimension and bit of each plane.
    Planes without a one are left out."""
    words, dim, bit = [], [], []
    for b in range(int(u.max(initial=0)).bit_length()):
        packed = np.packbits(((u >> np.uint64(b)) & np.uint64(1)).astype(np.uint8).T, axis=1)
        packed = np.ascontiguousarray(np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8)))).view(np.uint64)
        some = np.flatnonzero(packed.any(axis=1))
        words.append(packed[some])
        dim.append(some)
        bit.append(np.full(len(some), b))
    if not words:
        return np.zeros((0, 0), np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(words), np.concatenate(dim), np.concatenate(bit)


def scatter(y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sum per dimension, sum of products per pair of dimensions) of whole numbers, exact, as Python integers."""
    n, dims = y.shape
    low = y.min(axis=0) if n else np.zeros(dims, np.int64)
    u = y.view(np.uint64) - low.view(np.uint64)      # wraps to the right unsigned difference
    word, dim, bit = planes(u)
    ones = np.zeros((len(word), len(word)), dtype=np.int64)
    for a in range(len(word)):
        ones[a, a:] = ones[a:, a] = np.bitwise_count(word[a] & word[a:]).sum(axis=1, dtype=np.int64)
    top = int(bit.max(initial=0)) + 1
    kind = np.int64 if 2 * top + n.bit_length() + 2 < 63 else object
    weight = np.zeros((len(word), dims), dtype=kind)
    weight[np.arange(len(word)), dim] = np.array([1 << int(b) for b in bit], dtype=kind)
    cross = (weight.T @ (ones.astype(kind) @ weight)).astype(object)
    total = (np.diagonal(ones).astype(kind) @ weight).astype(object)
    low = low.astype(object)
    cross = cross + np.outer(low, total) + np.outer(total, low) + n * np.outer(low, low)
    return total + n * low, cross


def _wider(whole: np.ndarray, more: int) -> np.ndarray:
    out = np.zeros([n + more for n in whole.shape], dtype=object)
    out[tuple(slice(n) for n in whole.shape)] = whole
    return out


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, total, cross = 0, np.zeros(0, object), np.zeros((0, 0), object)
    for batch in batches:
        y = integers(batch.column(0))
        more = y.shape[1] - len(total)
        if more > 0:
            total, cross = _wider(total, more), _wider(cross, more)
        for at in range(0, len(y), BLOCK_ROWS):
            part, both = scatter(np.ascontiguousarray(y[at:at + BLOCK_ROWS]))
            d = len(part)
            total[:d] += part
            cross[:d, :d] += both
        n += len(y)
    if not n:
        return
    i, j = np.triu_indices(len(total))
    rows = [(-1, -1, n)] + [(k, -1, v) for k, v in enumerate(total)] + list(zip(i, j, cross[i, j]))
    kind = pa.decimal128(38, 0)
    for at in range(0, len(rows), 65_536):
        part = rows[at:at + 65_536]
        yield pa.RecordBatch.from_arrays(
            [pa.array([int(r[0]) for r in part], pa.int32()), pa.array([int(r[1]) for r in part], pa.int32()),
             pa.array([Decimal(int(r[2]) % LIMB) for r in part], kind),
             pa.array([Decimal(int(r[2]) // LIMB) for r in part], kind)], names=["i", "j", "low", "high"])


def fit(vectors: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS) -> Fit | None:
    """The fit over all usable rows; None if there are none."""
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(v.alias("v")).where(usable(F.col("v"))).mapInArrow(_sums, SUMS)
    added = rows.groupBy("i", "j").agg(F.sum("low").alias("low"), F.sum("high").alias("high"))
    found = {(r["i"], r["j"]): int(r["low"]) + LIMB * int(r["high"]) for r in added.toLocalIterator()}
    if not found:
        return None
    n = found[-1, -1]
    dims = sum(j == -1 for _, j in found) - 1
    total = [found[k, -1] for k in range(dims)]
    covariance = np.zeros((dims, dims))
    for i in range(dims):
        for j in range(i, dims):
            covariance[i, j] = covariance[j, i] = (n * found.get((i, j), 0) - total[i] * total[j]) / (n * n)
    values, axes = np.linalg.eigh(covariance) if dims else (np.zeros(0), np.zeros((0, 0)))
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    axes = axes * np.where(axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])] < 0, -1.0, 1.0) if dims else axes
    values = np.where(values > np.finfo(float).eps * dims * values.max(initial=0.0), values, 0.0)
    mean = [t // n for t in total]
    return Fit(n, np.array(mean, np.int64), np.array([t - n * m for t, m in zip(total, mean)], np.int64), covariance,
               values, axes)


def _whitened(model: Fit, y: np.ndarray) -> np.ndarray:
    """Rows x components; NaN where a component has no variance."""
    centred = (y - model.mean).astype(float) - model.rest / model.n
    with np.errstate(divide="ignore"):
        scale = np.where(model.values > 0, 1 / np.sqrt(model.values), np.nan)
    return (centred @ model.vectors) * scale


def _deviation(model: Fit, y: np.ndarray) -> pa.Array:
    """Sum over the dimensions of (n * x - S)^2: the shift of x by a constant takes no part."""
    step = y - model.mean
    most = (int(np.abs(step).max(initial=0)) + 1) * model.n
    if model.dims * most * most < 1 << 63:
        return pa.array(((model.n * step - model.rest) ** 2).sum(axis=1, dtype=np.int64), pa.int64())
    square = ((model.n * step.astype(object) - model.rest.astype(object)) ** 2).sum(axis=1)
    return pa.array([int(s) if s < 1 << 63 else None for s in square], pa.int64())


def identity_error(vectors: DataFrame, model: Fit, vector_col: str = "embedding") -> float:
    """Largest absolute entry of the whitened values' covariance minus the identity, measured over all rows."""
    shared = vectors.sparkSession.sparkContext.broadcast(model)
    held = np.flatnonzero(model.values > 0)
    k = len(held)
    if not k:
        return 0.0
    size = k * (k + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc = np.zeros(size)
        for batch in batches:
            w = _whitened(shared.value, integers(batch.column(0), shared.value.dims))[:, held]
            acc += np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])
        yield array_rows(acc, task_number())

    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(v.alias("v")).where(usable(F.col("v")))
    parts = rows.mapInArrow(run, "piece int, part int, data binary")
    total = add_arrays(parts, np.float64, size, max(PIECES, vectors.sparkSession.sparkContext.defaultParallelism))
    mean = total[:k] / model.n
    return float(np.abs(total[k:].reshape(k, k) / model.n - np.outer(mean, mean) - np.eye(k)).max())


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS
           ) -> DataFrame:
    """One row per usable row and component: id, component (from 1), n, deviation, whitened, explained,
    identity_error."""
    spark = vectors.sparkSession
    schema = (f"id {vectors.schema[id_col].dataType.simpleString()}, component int, n long, deviation long, "
              "whitened double, explained double, identity_error double")
    names = [c if c != "id" else id_col for c in ("id", "component", "n", "deviation", "whitened", "explained",
                                                  "identity_error")]
    model = fit(vectors, vector_col, components)
    if model is None or not model.dims:
        return spark.createDataFrame([], schema).toDF(*names)
    error = identity_error(vectors, model, vector_col)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        k = len(model.values)
        share = model.explained() if model.values.any() else np.full(k, np.nan)
        for batch in batches:
            for at in range(0, batch.num_rows, OUT_ROWS):
                part = batch.slice(at, OUT_ROWS)
                y = integers(part.column(1), model.dims)
                row = pa.array(np.repeat(np.arange(len(y)), k))
                size = len(row)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(row), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(y))),
                     pa.array(np.full(size, model.n)), _deviation(model, y).take(row),
                     pa.array(_whitened(model, y).ravel(), from_pandas=True),
                     pa.array(np.tile(share, len(y)), from_pandas=True), pa.array(np.full(size, error))],
                    names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    return rows.where(usable(F.col("v"))).mapInArrow(run, schema).toDF(*names)
