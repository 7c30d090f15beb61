"""Columns of vectors as NumPy matrices, and back as binary columns."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T


def element_type(df: DataFrame, column: str) -> str:
    """NumPy's name of the numbers in a column of arrays: single precision where they are, else double."""
    kind = df.schema[column].dataType
    if not isinstance(kind, T.ArrayType):
        raise ValueError(f"{column} is no column of arrays")
    return "f4" if isinstance(kind.elementType, T.FloatType) else "f8"


def matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, matrix of doubles) of the usable vectors of each length.

    Null or empty vectors, and those with null or non-finite components, are left out.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    broken = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    usable = (lengths > 0) & (broken[ends] == broken[ends - lengths])
    for length in np.unique(lengths[usable]).tolist():
        places = np.flatnonzero(usable & (lengths == length))
        yield places, values[(ends[places] - length)[:, None] + np.arange(length)]


def binaries(rows: dict[int, bytes], n: int) -> pa.Array:
    """A binary column of n rows; rows that are not given are null."""
    return pa.array([rows.get(i) for i in range(n)], pa.binary())


def stacked(column: pa.Array, kind: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, matrix) of the binary vectors of each length."""
    sizes = pc.binary_length(column).to_numpy(zero_copy_only=False)
    for size in np.unique(sizes).tolist():
        places = np.flatnonzero(sizes == size)
        data = b"".join(column.take(pa.array(places)).to_pylist())
        yield places, np.frombuffer(data, kind).reshape(len(places), -1)
