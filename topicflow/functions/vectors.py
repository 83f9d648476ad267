"""Vector columns as Arrow batches of fixed-width float lists."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A list column as a 2-D float64 block; vectors of different widths are an error."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    widths = np.unique(np.asarray(pc.list_value_length(column)))
    if len(widths) > 1:
        raise ValueError(f"vectors of different widths: {widths.tolist()[:5]}")
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.asarray(flat, dtype=np.float64).reshape(len(column), -1)


def as_bytes(matrix: np.ndarray) -> pa.Array:
    """The rows of a float64 matrix as binary values."""
    width = matrix.shape[1] * 8
    offsets = np.arange(len(matrix) + 1, dtype=np.int32) * np.int32(width)
    data = np.ascontiguousarray(matrix, dtype=np.float64)
    return pa.Array.from_buffers(pa.binary(), len(matrix), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def from_bytes(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """The matrix that ``as_bytes`` made the values of."""
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    parts, widths = [], set()
    for chunk in chunks:
        if len(chunk):
            ends = np.frombuffer(chunk.buffers()[1], np.int32)[chunk.offset : chunk.offset + len(chunk) + 1]
            widths |= set(np.unique(np.diff(ends)).tolist())
            parts.append(np.frombuffer(chunk.buffers()[2], np.uint8)[ends[0] : ends[-1]])
    if len(widths) > 1:
        raise ValueError(f"vectors of different widths: {sorted(w // 8 for w in widths)[:5]}")
    flat = np.concatenate(parts) if len(parts) != 1 else parts[0]
    return flat.view(np.float64).reshape(len(column), -1)


def chunks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """The batches as tables of ``rows`` rows, the last one smaller."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            table = pa.Table.from_batches(held)
            for start in range(0, n - rows + 1, rows):
                yield table.slice(start, rows)
            held, n = table.slice(n - n % rows).to_batches(), n % rows
    if n:
        yield pa.Table.from_batches(held)


def unit(matrix: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; zero rows stay zero."""
    norm = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, norm, out=np.zeros_like(matrix), where=norm > 0)


@F.arrow_udf(T.DoubleType())
def _cosine(a: pa.Array, b: pa.Array) -> pa.Array:
    if len(a) == 0:
        return pa.array([], pa.float64())
    known = np.asarray(a.is_valid()) & np.asarray(b.is_valid())
    out = np.full(len(a), np.nan)
    if known.any():
        mask = pa.array(known)
        left, right = unit(as_matrix(a.filter(mask))), unit(as_matrix(b.filter(mask)))
        if left.shape != right.shape:
            raise ValueError(f"vectors of different widths: {left.shape[1]} and {right.shape[1]}")
        out[known] = np.einsum("ij,ij->i", left, right)
    return pa.array(out, pa.float64(), mask=~known)


def cosine_similarity(a: Column, b: Column) -> Column:
    """Cosine of two vectors; 0 if either is zero, null if either is null."""
    return _cosine(a, b)


def cosine_distance(a: Column, b: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(2.0), 1 - _cosine(a, b)))


def cosine_plain(a: Column, b: Column) -> Column:
    """The same value without a Python worker, for the few rows of a topic table."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)
    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norms == 0, F.lit(0.0)).otherwise(dot(a, b) / norms)
