"""Whitening of embeddings by a bidiagonal qd solver.

Vectors become whole numbers, each distinct one counts once. Their number and sums are
exact, so centring is. Tasks reduce their centred rows block by block to a triangle R
by QR; triangles are stacked and reduced again, a few at a time, until one is
left. ``bidiagonal`` finds the singular values and right directions of that one, which is
as wide as a vector; directions over the roots of the values whiten all rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslake import scratch
from newslake.llm.bidiagonal import right_directions

SCALE, OFFSET, COMPONENTS = 64, 1_000_000, 16
FAN_IN = 16
_BLOCK_BYTES = 8 << 20
# Beyond this, sums of a table's whole numbers might not fit 64 bits.
_LARGEST = float(1 << 40)

Fold = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


@dataclass(frozen=True)
class Whitening:
    """``n`` distinct vectors with exact ``sums`` per dimension; ``directions`` are columns of falling ``values``."""

    n: int
    sums: np.ndarray
    directions: np.ndarray
    values: np.ndarray
    trace: float

    @property
    def explained(self) -> np.ndarray:
        return self.values / self.trace


def _whole_numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("vec_id", pa.int64()), ("x", pa.list_(pa.int64()))])
    for batch in batches:
        lists = batch.column(1)
        given = np.flatnonzero(lists.is_valid().to_numpy(zero_copy_only=False))
        lists = lists.take(pa.array(given))
        offsets, flat = lists.offsets.to_numpy().astype(np.int64), lists.values
        flat, offsets = flat.slice(offsets[0], offsets[-1] - offsets[0]), offsets - offsets[0]
        entries = flat.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
        with np.errstate(invalid="ignore", over="ignore"):
            bad = np.concatenate([[0], np.cumsum(~(np.abs(entries * SCALE) < _LARGEST))])
        good = np.flatnonzero(bad[offsets[1:]] == bad[offsets[:-1]])
        keep = np.zeros(len(entries) + 1, np.int64)
        np.add.at(keep, offsets[good], 1)
        np.add.at(keep, offsets[good + 1], -1)
        entries = entries[np.cumsum(keep[:-1]) > 0]
        x = np.floor(entries * SCALE).astype(np.int64) + OFFSET
        ends = np.concatenate([[0], np.cumsum(np.diff(offsets)[good])]).astype(np.int32)
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(given[good])), pa.ListArray.from_arrays(ends, x)], schema=schema)


def whole_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, x): entries c as floor(64 * c) + 1,000,000.

    Rows whose vector is null or holds a null or non-finite entry go, as do those with an entry of
    2 ** 34 or more, which the sums of whole numbers could not hold. Rows without an id stay.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    return rows.mapInArrow(_whole_numbers, "vec_id long, x array<long>")


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _rows(matrix: np.ndarray) -> pa.Array:
    flat = np.ascontiguousarray(matrix)
    return pa.ListArray.from_arrays(np.arange(len(flat) + 1, dtype=np.int32) * flat.shape[1], flat.ravel())


def _summed(width: int) -> Fold:
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, np.zeros(width, np.int64)
        for batch in batches:
            n += int(np.sum(batch.column(0).to_numpy()))
            sums += _matrix(batch.column(1), width).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array([n]), _rows(sums[None])], names=["n", "row"])

    return fold


def _triangles(width: int, centre: tuple[int, np.ndarray] | None = None) -> Fold:
    """Rows to the triangle of their QR, a block at a time; ``centre`` first makes whole numbers centred rows."""
    block_rows = max(width, _BLOCK_BYTES // (8 * width))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, width))
        for batch in batches:
            rows = _matrix(batch.column(0), width)
            for i in range(0, len(rows), block_rows):
                block = rows[i : i + block_rows]
                if centre:
                    block = _centred(block, *centre)
                r = np.linalg.qr(np.concatenate([r, block]), mode="r")
        if len(r):
            yield pa.RecordBatch.from_arrays([_rows(r)], names=["row"])

    return fold


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - S / n, the difference taken between whole numbers."""
    return (x * n - sums) / n


def _moments(model: Whitening) -> Fold:
    """Whole numbers to (rows, mean, centred products) of their whitened form."""
    width, count = len(model.sums), len(model.values)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = _no_moments(count)
        for batch in batches:
            w = _projected(_matrix(batch.column(0), width), model)
            mean = w.mean(0) if len(w) else np.zeros(count)
            total = _joined(total, (len(w), mean, (w - mean).T @ (w - mean)))
        yield _moment_row(total)

    return fold


def _join_moments(count: int) -> Fold:
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = _no_moments(count)
        for batch in batches:
            for n, mean, products in zip(*(c.to_pylist() for c in batch.columns)):
                total = _joined(total, (n, np.array(mean), np.array(products).reshape(count, count)))
        yield _moment_row(total)

    return fold


def _no_moments(count: int):
    return 0, np.zeros(count), np.zeros((count, count))


def _joined(a, b):
    """Moments of two sets of rows together, centred on their common mean."""
    n = a[0] + b[0]
    if not n:
        return a
    apart = b[1] - a[1]
    return n, a[1] + apart * (b[0] / n), a[2] + b[2] + np.outer(apart, apart) * (a[0] * b[0] / n)


def _moment_row(moments) -> pa.RecordBatch:
    n, mean, products = moments
    return pa.RecordBatch.from_arrays([pa.array([n]), _rows(mean[None]), _rows(products.reshape(1, -1))], names=["n", "mean", "products"])


def _projected(x: np.ndarray, model: Whitening) -> np.ndarray:
    return _centred(x, model.n, model.sums) @ (model.directions / np.sqrt(model.values))


def _reduced(rows: DataFrame, first: Fold, more: Fold, schema: str) -> DataFrame:
    """One partition's worth of ``rows``: each task folds its own, then ever fewer tasks fold what is left.

    A task sends a bounded number of rows, so the last one reads few whatever the table's size.
    """
    left = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.mapInArrow(first, schema)
    while True:
        left = -(-left // FAN_IN)
        rows = rows.repartition(left).mapInArrow(more, schema)
        if left == 1:
            return rows


def fit_list(vectors: DataFrame, path: str) -> DataFrame:
    """(x, copies): each distinct vector of whole numbers once, stored at ``path``.

    Equal vectors are first counted inside each task, so a vector that fills the table is no hot key.
    """
    return scratch.stored(vectors.groupBy("x").agg(F.count("*").alias("copies")), path)


def fit(distinct: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Whitening over the distinct vectors of ``fit_list``; None where there is no vector or none varies.

    Vectors count if they have as many entries as most rows do, the longer ones at a tie. A component
    whose deviation is below 1e-11 of the first one's has no whitened form and is left out.
    """
    widths = distinct.groupBy(F.size("x").alias("width")).agg(F.sum("copies").alias("n")).orderBy(F.desc("n"), F.desc("width")).limit(1).collect()
    if not widths or not widths[0].width:
        return None
    width = widths[0].width
    rows = distinct.filter(F.size("x") == width).select(F.lit(1).cast("long").alias("n"), F.col("x").alias("row"))
    n, sums = _reduced(rows, _summed(width), _summed(width), "n long, row array<long>").first()
    sums = np.array(sums, np.int64)
    triangle = _reduced(rows.select("row"), _triangles(width, (n, sums)), _triangles(width), "row array<double>").collect()
    values, directions = right_directions(np.array([r.row for r in triangle]), components)
    if not directions.shape[1]:
        return None
    return Whitening(n, sums, directions, values[: directions.shape[1]] / n, float(values.sum()) / n)


def identity_error(distinct: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened vectors' covariance less the identity, over the fit list."""
    rows = distinct.filter(F.size("x") == len(model.sums)).select("x")
    count = len(model.values)
    last = _reduced(rows, _moments(model), _join_moments(count), "n long, mean array<double>, products array<double>").first()
    return float(np.abs(np.array(last.products).reshape(count, count) / last.n - np.eye(count)).max())


def _whitened(model: Whitening) -> Fold:
    schema = pa.schema([("vec_id", pa.int64()), ("deviation", pa.decimal128(38, 0)), ("whitened", pa.list_(pa.float64()))])
    width = len(model.sums)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), width)
            apart = x * model.n - model.sums
            largest = int(np.abs(apart).max(initial=0))
            if largest * largest * width < 1 << 63:
                deviation = pa.array((apart * apart).sum(1)).cast(pa.decimal128(38, 0))
            else:
                whole = apart.astype(object)
                deviation = pa.array((whole * whole).sum(1).tolist(), pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([batch.column(0), deviation, _rows(_projected(x, model))], schema=schema)

    return rows


def whitened(vectors: DataFrame, model: Whitening) -> DataFrame:
    """(vec_id, deviation, whitened) of every row of ``whole_vectors`` with as many entries as the model.

    ``deviation`` is the exact sum of (n * x - S) ** 2; ``whitened`` has one number per component.
    Repeated rows stay. Nothing is shuffled.
    """
    rows = vectors.filter(F.size("x") == len(model.sums))
    return rows.mapInArrow(_whitened(model), "vec_id long, deviation decimal(38,0), whitened array<double>")
