"""Vectors in array columns: as bytes that group and join quickly, and as matrices inside Arrow functions."""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql.functions import arrow_udf

STEPS = 256  # steps of one when entries become whole numbers
LARGEST = float(1 << 53)  # whole entries beyond this are taken as not finite
STEP_KINDS = ("<i1", "<i2", "<i4", "<i8")
_CHUNK = 1 << 22  # entries handled at once


def _whole_rows(vectors: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows whose vectors have entries, all finite: their places and the matrix in double precision, by length and in chunks."""
    size = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False)
    for length in np.unique(size[size > 0]).tolist():
        places = np.flatnonzero(size == length)
        for part in np.array_split(places, 1 + places.size * length // _CHUNK):
            values = pc.list_flatten(vectors.take(pa.array(part)))
            rows = pc.cast(values, pa.float64()).to_numpy(zero_copy_only=False).reshape(part.size, length)  # null entries become NaN
            good = np.isfinite(rows).all(1)
            yield part[good], rows[good]


def _as_bytes(places_rows: Iterator[tuple[np.ndarray, np.ndarray]], count: int) -> pa.Array:
    out: list[bytes | None] = [None] * count
    for places, rows in places_rows:
        width = rows.shape[1] * rows.dtype.itemsize
        data = rows.tobytes()
        for n, place in enumerate(places.tolist()):
            out[place] = data[n * width:(n + 1) * width]
    return pa.array(out, pa.binary())


def _bytes_of(change: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]):
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for vectors in batches:
            yield _as_bytes((change(*part) for part in _whole_rows(vectors)), len(vectors))

    return arrow_udf(run, returnType="binary")


def double_bytes(vector: Column, zeros: bool = False) -> Column:
    """A vector as little-endian doubles; null if it is null, empty, all zero (unless `zeros`) or has a null or non-finite entry. Minus zero becomes zero."""

    def change(places, rows):
        rows = rows + 0.0
        some = rows.any(1) | zeros
        return places[some], rows[some].astype("<f8", copy=False)

    return _bytes_of(change)(vector)


def float_bytes(vector: Column) -> Column:
    """As `double_bytes`, for columns of single precision: little-endian floats without loss."""

    def change(places, rows):
        rows = rows + 0.0
        some = rows.any(1)
        return places[some], rows[some].astype("<f4")

    return _bytes_of(change)(vector)


def narrowest(numbers: np.ndarray) -> np.dtype:
    """The smallest kind of whole number that holds all of these."""
    low, high = (int(numbers.min()), int(numbers.max())) if numbers.size else (0, 0)
    return next(np.dtype(k) for k in STEP_KINDS if np.iinfo(k).min <= low and high <= np.iinfo(k).max)


def _step_rows(vectors: pa.Array) -> pa.Array:
    count = len(vectors)
    sizes: list[int | None] = [None] * count
    out: list[bytes | None] = [None] * count
    for places, rows in _whole_rows(vectors):
        with np.errstate(over="ignore"):
            steps = np.floor(rows * STEPS)
        fits = (np.abs(steps) <= LARGEST).all(1)
        places, steps = places[fits], steps[fits].astype(np.int64)
        largest = np.maximum(steps.max(1), -1 - steps.min(1)) if places.size else np.zeros(0, np.int64)
        kinds = np.searchsorted([np.iinfo(k).max for k in STEP_KINDS], largest)
        for kind in np.unique(kinds).tolist():
            which = np.flatnonzero(kinds == kind)
            data, width = steps[which].astype(STEP_KINDS[kind]).tobytes(), steps.shape[1] * np.dtype(STEP_KINDS[kind]).itemsize
            for n, place in enumerate(places[which].tolist()):
                sizes[place], out[place] = steps.shape[1], data[n * width:(n + 1) * width]
    return pa.StructArray.from_arrays([pa.array(sizes, pa.int32()), pa.array(out, pa.binary())], ["size", "x"])


def steps(vector: Column) -> Column:
    """A vector's whole numbers floor(256 * c): a struct of their number `size` and `x`, their bytes in the smallest kind that holds them all.

    Both are null if the vector is null, empty or has a null or non-finite entry; an entry whose whole number lies beyond 2^53 counts as such.
    Equal whole numbers have equal bytes.
    """

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for vectors in batches:
            yield _step_rows(vectors)

    return arrow_udf(run, returnType="size int, x binary")(vector)


def step_matrix(column: pa.Array | pa.ChunkedArray, size: int) -> np.ndarray:
    """Bytes of `steps`, all of `size` numbers, as rows of 64-bit numbers."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    out = np.zeros((len(column), size), np.int64)
    width = pc.binary_length(column).to_numpy(zero_copy_only=False)
    for kind in STEP_KINDS:
        which = np.flatnonzero(width == size * np.dtype(kind).itemsize)
        if which.size:
            out[which] = matrix(column.take(pa.array(which)), kind)
    return out


def matrix(column: pa.Array | pa.ChunkedArray, dtype: str) -> np.ndarray:
    """Vectors of one length, given as bytes, as rows of a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros((0, 0), dtype)
    begin, end = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4)[[0, -1]].tolist()
    return np.frombuffer(column.buffers()[2], np.uint8)[begin:end].view(dtype).reshape(len(column), -1)


def spread_out(points: np.ndarray, count: int, least: float = 1e-6) -> np.ndarray:
    """Places of up to `count` points, each the farthest from those before it, as long as it is `least` away from them.

    Any first part of the result is such a choice itself.
    """
    if not len(points):
        return np.zeros(0, np.int64)
    chosen = [0]
    gap = ((points - points[0]) ** 2).sum(1)
    while len(chosen) < min(count, len(points)) and gap.max() > least * least:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, ((points - points[chosen[-1]]) ** 2).sum(1))
    return np.array(chosen)
