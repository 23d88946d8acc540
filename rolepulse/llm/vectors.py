"""Vectors of an Arrow list column as matrices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, vectors as float64) for each length among the lists of a column.

    Null lists are left out; null components are NaN.
    """
    lists = column.cast(pa.list_(pa.float64()))
    values = lists.values.to_numpy(zero_copy_only=False)
    at = lists.offsets.to_numpy(zero_copy_only=False)
    length, valid = np.diff(at), lists.is_valid().to_numpy(zero_copy_only=False)
    for n in np.unique(length[valid]):
        rows = np.flatnonzero(valid & (length == n))
        yield rows, values[at[rows][:, None] + np.arange(n)]


def packed(rows: np.ndarray) -> list[bytes]:
    """The bytes of each row of a matrix."""
    return [r.tobytes() for r in np.ascontiguousarray(rows)]


def binaries(column: pa.Array, dtype: str, width: int) -> np.ndarray:
    """A matrix of ``width`` columns from a column of non-null binaries, one row each."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(-1, width)
