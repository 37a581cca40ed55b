"""Whitening of embeddings with an exact, bit-sliced covariance.

Entries are whole numbers. Of every dimension the smallest value is taken off, and
the bits of what is left are packed across rows: 64 rows to a word, one row of words
per dimension and bit plane. The sum of the products of two dimensions is then a
sum over pairs of planes: the number of rows with both bits, a popcount of two words'
AND, times two to the power of the planes' places. Counts are added up by Spark in
limbs of 16 bits that never overflow, so cross-products are exact at any size; they
are centred as whole numbers, and only the finished covariance becomes floating point.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm.tables import free
from newsloom.staging import stage

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
LIMB = 16
#: Entries from here on have no 64-bit whole number and count as not finite.
LARGEST = 2.0**62
LONG = (1 << 63) - 1
MADE = "component int, n long, deviation long, whitened double, explained double, identity_error double"


@dataclass(frozen=True)
class Whitening:
    """What was fitted: `rows` vectors with the exact sums of every dimension.

    `eigenvalues` fall; `axes` holds a unit eigenvector in each column, its
    largest entry (the first among equals) positive. `explained` are the shares of the trace. Directions
    without variance are left out, so there may be fewer than were asked for, or none.
    """

    rows: int
    sums: list[int]
    covariance: np.ndarray
    eigenvalues: np.ndarray
    axes: np.ndarray
    explained: np.ndarray


def whole(vector: Column) -> Column:
    """The entries as whole numbers: `floor(64 * entry) + 1000000`, for usable vectors."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * F.lit(float(SCALE))) + F.lit(OFFSET))


def usable(vector: Column) -> Column:
    """True for a vector that is there and has only finite entries."""
    small = lambda c: F.coalesce(F.abs(c.cast("double") * F.lit(float(SCALE))) < LARGEST, F.lit(False))
    return F.coalesce(F.forall(vector, lambda c: small(c) & ~F.isnan(c.cast("double"))), F.lit(False)) & (F.size(vector) > 0)


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)


def _bounds(dimensions: int):
    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = high = None
        for batch in source:
            if batch.num_rows:
                x = _matrix(batch.column(0), dimensions)
                low = x.min(axis=0) if low is None else np.minimum(low, x.min(axis=0))
                high = x.max(axis=0) if high is None else np.maximum(high, x.max(axis=0))
        if low is not None:
            columns = [pa.array(range(dimensions), pa.int32()), pa.array(low, pa.int64()), pa.array(high, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["i", "low", "high"])

    return run


def bit_planes(values: np.ndarray, planes: int) -> np.ndarray:
    """`(planes, columns, words)`: the bits of unsigned values, packed across rows, 64 rows to a word."""
    rows, columns = values.shape
    padded = np.zeros((columns, -(-rows // 64) * 64), dtype=np.uint64)
    padded[:, :rows] = values.T
    bits = [((padded >> np.uint64(p)) & np.uint64(1)).astype(np.uint8) for p in range(planes)]
    return np.stack([np.packbits(b, axis=1).view(np.uint64) for b in bits])


def scatter(planes: np.ndarray, totals: np.ndarray, sums: np.ndarray) -> None:
    """Add the products of all pairs of columns to `totals[limb, i, j]` (j from i up), the sums to `sums[limb, i]`."""
    places, columns, _ = planes.shape
    for a in range(places):
        sums[a // LIMB] += np.bitwise_count(planes[a]).sum(axis=1, dtype=np.int64) << (a % LIMB)
        for i in range(columns):
            both = np.bitwise_count(planes[:, i:] & planes[a, i]).sum(axis=2, dtype=np.int64)
            for b in range(places):
                totals[(a + b) // LIMB, i, i:] += both[b] << ((a + b) % LIMB)


def _scatter(low: np.ndarray, places: int):
    """Partial sums of a task: `(limb, i, j, value)`, with j = -1 for the sum of column i itself."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns, limbs = len(low), (2 * places - 2) // LIMB + 1
        totals = np.zeros((limbs, columns, columns), dtype=np.int64)
        sums = np.zeros((limbs, columns), dtype=np.int64)
        for batch in source:
            if batch.num_rows:
                shifted = (_matrix(batch.column(0), columns) - low).astype(np.uint64)
                scatter(bit_planes(shifted, places), totals, sums)
        limb, i, j = np.nonzero(totals)
        alone_limb, alone_i = np.nonzero(sums)
        arrays = [
            pa.array(np.concatenate([limb, alone_limb]), pa.int32()),
            pa.array(np.concatenate([i, alone_i]), pa.int32()),
            pa.array(np.concatenate([j, np.full(len(alone_i), -1)]), pa.int32()),
            pa.array(np.concatenate([totals[limb, i, j], sums[alone_limb, alone_i]]), pa.int64()),
        ]
        yield pa.RecordBatch.from_arrays(arrays, names=["limb", "i", "j", "value"])

    return run


def _eigen(covariance: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    least = len(values) * np.finfo(float).eps * max(values[0], 0.0)
    count = min(most, int((values > least).sum()))
    vectors = vectors[:, :count]
    largest = np.abs(vectors).argmax(axis=0)
    return values[:count], vectors * np.where(vectors[largest, np.arange(count)] < 0, -1.0, 1.0)


def fit(vectors: DataFrame, dimensions: int, most: int = COMPONENTS) -> Whitening:
    """Fit on a written table of distinct vectors `x` of whole numbers, all of one length, at least one row.

    What comes to the driver is of the size of the covariance, whatever the number of rows.
    """
    ends = vectors.mapInArrow(_bounds(dimensions), "i int, low long, high long").groupBy("i")
    ends = sorted(ends.agg(F.min("low").alias("low"), F.max("high").alias("high")).collect(), key=lambda r: r.i)
    low = [r.low for r in ends]
    places = max(1, max(r.high - r.low for r in ends).bit_length())
    rows = vectors.count()
    parts = vectors.mapInArrow(_scatter(np.array(low, dtype=np.int64), places), "limb int, i int, j int, value long")
    cross, sums = [[0] * dimensions for _ in range(dimensions)], [0] * dimensions
    for r in parts.groupBy("limb", "i", "j").agg(F.sum("value").alias("value")).collect():
        value = r.value << (LIMB * r.limb)
        if r.j < 0:
            sums[r.i] += value
        else:
            cross[r.i][r.j] += value
    covariance = np.empty((dimensions, dimensions))
    for i in range(dimensions):
        for j in range(i, dimensions):
            # Whole numbers up to the division, which rounds once.
            covariance[i, j] = covariance[j, i] = (rows * cross[i][j] - sums[i] * sums[j]) / (rows * rows)
    values, axes = _eigen(covariance, most)
    trace = np.trace(covariance)
    explained = values / trace if len(values) else values
    return Whitening(rows, [s + rows * lo for s, lo in zip(sums, low, strict=True)], covariance, values, axes, explained)


def _deviations(x: np.ndarray, model: Whitening) -> tuple[np.ndarray, np.ndarray]:
    """`n * x - S` and, per row, the sum of its squares (None where it has no 64-bit number)."""
    mean = [s // model.rows for s in model.sums]
    rest = np.array([s - model.rows * m for s, m in zip(model.sums, mean, strict=True)], dtype=object)
    near = x.astype(object) - np.array(mean, dtype=object)
    widest = max(int(np.abs(near).max()) if near.size else 0, 1) + 1
    if (widest * model.rows) ** 2 * x.shape[1] <= LONG:
        exact = near.astype(np.int64) * model.rows - rest.astype(np.int64)
        return exact, (exact * exact).sum(axis=1)
    exact = near * model.rows - rest
    squares = (exact * exact).sum(axis=1)
    return exact, np.array([s if s <= LONG else None for s in squares], dtype=object)


def projected(x: np.ndarray, model: Whitening) -> np.ndarray:
    exact, _ = _deviations(x, model)
    return exact.astype(np.float64) @ (model.axes / np.sqrt(model.eigenvalues)) / model.rows


def _moments(model: Whitening):
    """Partial `(a, b, value)` of a task: sums of products of whitened entries; b = -1 for their sums."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = len(model.eigenvalues)
        products, sums = np.zeros((count, count)), np.zeros((count, 1))
        for batch in source:
            if batch.num_rows:
                z = projected(_matrix(batch.column(0), len(model.sums)), model)
                products += z.T @ z
                sums += z.sum(axis=0)[:, None]
        a = np.repeat(np.arange(count), count + 1)
        b = np.tile(np.arange(-1, count), count)
        values = np.hstack([sums, products]).ravel()
        arrays = [pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(values)]
        yield pa.RecordBatch.from_arrays(arrays, names=["a", "b", "value"])

    return run


def identity_error(vectors: DataFrame, model: Whitening) -> float:
    """The largest absolute entry of the covariance of the whitened vectors, as computed, minus the identity."""
    count = len(model.eigenvalues)
    found = np.zeros((count, count + 1))
    parts = vectors.mapInArrow(_moments(model), "a int, b int, value double")
    for r in parts.groupBy("a", "b").agg(F.sum("value").alias("value")).collect():
        found[r.a, r.b + 1] = r.value
    mean, products = found[:, 0] / model.rows, found[:, 1:] / model.rows
    return float(np.abs(products - np.outer(mean, mean) - np.eye(count)).max()) if count else 0.0


def _whitened_rows(model: Whitening, error: float):
    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = len(model.eigenvalues)
        for batch in source:
            rows = batch.num_rows
            if not rows:
                continue
            x = _matrix(batch.column(1), len(model.sums))
            places = np.repeat(np.arange(rows), count)
            columns = [
                batch.column(0).take(pa.array(places)),
                pa.array(np.tile(np.arange(1, count + 1), rows), pa.int32()),
                pa.array(np.full(rows * count, model.rows), pa.int64()),
                pa.array(_deviations(x, model)[1][places], pa.int64()),
                pa.array(projected(x, model).ravel()),
                pa.array(np.tile(model.explained, rows)),
                pa.array(np.full(rows * count, error)),
            ]
            names = ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def whitened(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", most: int = COMPONENTS) -> DataFrame:
    """`(id, component, n, deviation, whitened, explained, identity_error)`, a row per usable row and component.

    Rows whose vector is NULL, empty, or holds an entry that is NULL, not finite or too
    large for a 64-bit whole number are left out, and so are vectors of another length than most have (of
    lengths equally frequent, the shortest counts). The fit is over distinct vectors; every row is
    whitened, repeated ones alike, and the id, which may be NULL or repeated, is returned as it
    is. Only directions with variance are components, so a table of one distinct vector,
    like an empty one, gives no rows. A `deviation` beyond 64 bits is NULL. No other column is read.
    """
    name = free(["x"], [id_col])[0]
    kept = vectors.filter(usable(F.col(vector_col))).select(id_col, whole(F.col(vector_col)).alias(name))
    lengths = kept.groupBy(F.size(name).alias("length")).agg(F.count("*").alias("n"))
    commonest = lengths.orderBy(F.col("n").desc(), "length").first()
    kind = f"id {vectors.schema[id_col].dataType.simpleString()}, {MADE}"
    if commonest is None:
        return vectors.sparkSession.createDataFrame([], kind)
    kept = kept.filter(F.size(name) == commonest.length)
    distinct = stage(kept.select(F.col(name).alias("x")).distinct(), "whitening-vectors")
    model = fit(distinct, commonest.length, most)
    return kept.mapInArrow(_whitened_rows(model, identity_error(distinct, model)), kind)
