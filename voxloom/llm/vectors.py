"""Vectors made integers, for the operators that search them: rows of bytes, and what several of them need."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Components may be as large as this in size; larger ones are an error, since lengths could not be told.
LARGEST = 1e150


def binary(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Neighbouring stretches of values, sizes[i] bytes each, as binary values."""
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    if offsets[-1] >= 1 << 31:
        raise ValueError("an Arrow batch of vectors has 2 GB or more")
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def integers(df: DataFrame, id_col: str, vector_col: str, scale: int, label_col: str | None = None) -> DataFrame:
    """id, dim, norm, data (floor(scale * x), held exactly as 64-bit floats), label as a string if asked for, of the rows that take part: those without nulls or non-finite components."""

    def kernel(batch):
        v = batch.column(1)
        sizes = pc.list_value_length(v).fill_null(0).to_numpy().astype(np.int64)
        flat = v.flatten().fill_null(np.nan).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        odd = np.concatenate(([0], np.cumsum(~np.isfinite(flat))))
        keep = (sizes > 0) & (odd[ends] == odd[ends - sizes])
        for i in (0, *range(2, batch.num_columns)):
            keep &= batch.column(i).is_valid().to_numpy(zero_copy_only=False)
        with np.errstate(over="ignore"):
            x = np.floor(flat[np.repeat(keep, sizes)] * scale)
        sizes, names = sizes[keep], batch.column(0).filter(pa.array(keep))
        starts = np.cumsum(sizes) - sizes
        if len(x):
            wide = np.maximum.reduceat(np.abs(x), starts)
            if not wide.max() <= LARGEST:
                raise ValueError(f"vector {names[int(wide.argmax())]} has a component beyond {LARGEST} in size")
        norms = np.sqrt(np.add.reduceat(x * x, starts)) if len(x) else np.empty(0)
        out = [names, pa.array(sizes.astype(np.int32)), pa.array(norms), binary(x, 8 * sizes)]
        return pa.RecordBatch.from_arrays(out + [batch.column(i).filter(pa.array(keep)) for i in range(2, batch.num_columns)], ["id", "dim", "norm", "data", *["label"] * (label_col is not None)])

    own = [F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")]
    src = df.select(*own, *[F.col(c).cast("string").alias("label") for c in [label_col] if c])
    return common.map_batches(src, kernel, "id long, dim int, norm double, data binary" + ", label string" * (label_col is not None))


def matrix(data: pa.Array, dim: int) -> np.ndarray:
    """Binary values of dim 64-bit floats each as rows."""
    data = data.combine_chunks() if isinstance(data, pa.ChunkedArray) else data
    offsets = np.frombuffer(data.buffers()[1], np.int32)[data.offset : data.offset + len(data) + 1]
    return np.frombuffer(data.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].view(np.float64).reshape(len(data), dim) if len(data) else np.empty((0, dim))


def runs_of_dims(batch: pa.RecordBatch):
    """The batch cut where the dimension (column dim) changes."""
    dims = batch.column("dim").to_numpy()
    cuts = np.concatenate(([0], np.flatnonzero(dims[1:] != dims[:-1]) + 1, [len(dims)])).tolist() if len(dims) else [0]
    for a, b in zip(cuts, cuts[1:]):
        yield int(dims[a]), batch.slice(a, b - a)


def best(q: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of (query, id, score) the k best of each query by score, then smaller id, the best of each id; last, which rows are the k-th of a query."""
    order = np.lexsort((-scores, ids, q))  # the best of each id first, and the others away, so that they take no places
    q, ids, scores = q[order], ids[order], scores[order]
    if len(q):
        first = np.concatenate(([True], (q[1:] != q[:-1]) | (ids[1:] != ids[:-1])))
        q, ids, scores = q[first], ids[first], scores[first]
    order = np.lexsort((ids, -scores, q))
    q, ids, scores = q[order], ids[order], scores[order]
    first = np.concatenate(([0], np.flatnonzero(q[1:] != q[:-1]) + 1)) if len(q) else np.empty(0, np.int64)
    nth = np.arange(len(q)) - np.repeat(first, np.diff(np.append(first, len(q))))
    keep = nth < k
    return q[keep], ids[keep], scores[keep], nth[keep] == k - 1
