"""Vector columns as numpy matrices, and what the vector operators share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def usable(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per row the number of entries, or -1; where its entries begin; all entries one after the other.

    -1 stands for a null vector and for one with a null, infinite or undefined entry.
    """
    lengths = np.asarray(pc.fill_null(column.value_lengths(), 0)).astype(np.int64)
    flat = pc.fill_null(column.flatten().cast(pa.float64()), float("nan"))
    values = np.asarray(flat)
    begin = np.cumsum(lengths) - lengths
    bad = np.append(0, np.cumsum(~np.isfinite(values)))
    broken = (bad[begin + lengths] > bad[begin]) | np.asarray(column.is_null())
    return np.where(broken, -1, lengths), begin, values


def matrix(begin: np.ndarray, values: np.ndarray, rows: np.ndarray, width: int) -> np.ndarray:
    """The vectors of some rows, all of one width, as a matrix."""
    return values[begin[rows][:, None] + np.arange(width)]


def lists(rows: np.ndarray) -> pa.Array:
    """A matrix as a column of lists."""
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.ravel()))


def square(column: pa.Array, width: int) -> np.ndarray:
    """A column of lists without nulls, all of one width, as a matrix."""
    return np.asarray(column.flatten()).reshape(len(column), width)
