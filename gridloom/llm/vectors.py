"""Columns of vectors as whole numbers in binary rows of one size.

A vector's entries become x = floor(scale * entry) + shift, with entries taken as doubles, and
x is kept as little-endian 32-bit integers, so that equal vectors are equal bytes, and rows
are compared, hashed and written without looking at entries.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Whole numbers of entries lie below this.
MOST = 1 << 31


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of a column of binary rows."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<i4").reshape(len(column), dims).astype(np.int64)


def rows_of(x: np.ndarray) -> pa.Array:
    """A binary column of the rows of a matrix."""
    n, dims = x.shape
    places = np.arange(n + 1, dtype=np.int32) * (4 * dims)
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(places), pa.py_buffer(np.ascontiguousarray(x, dtype="<i4"))])


def usable(column: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows are vectors of dims entries, all of them finite; and the matrix of their entries."""
    fits = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False) == dims
    flat = column.filter(pa.array(fits)).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, dims)
    fine = np.isfinite(flat).all(axis=1)  # an entry that is null has become NaN
    return np.flatnonzero(fits)[fine], flat[fine]


def usual_size(df: DataFrame, vector: str) -> int:
    """The number of entries that most vectors have, of equally frequent ones the largest; 0 without vectors."""
    sizes = df.select(F.size(vector).alias("dims")).filter("dims > 0").groupBy("dims").count()
    top = sizes.orderBy(F.col("count").desc(), F.col("dims").desc()).first()
    return top["dims"] if top else 0


def whole(df: DataFrame, vector: str, keep: Sequence[str], dims: int, scale: int, shift: int = 0, out: str = "x") -> DataFrame:
    """(keep, out) of the rows of df whose column vector has dims entries, none of them null or not finite.

    A number that needs more than 32 bits is an error.
    """
    fields = [df.schema[c] for c in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, entries = usable(batch.column(vector), dims)
            numbers = np.floor(scale * entries) + shift
            if np.abs(numbers).max(initial=0) >= MOST:
                raise ValueError(f"{vector}: whole numbers of entries must lie below {MOST}")
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(pa.array(rows)) for c in keep), rows_of(numbers.astype(np.int64))], [*keep, out])

    return df.select(*keep, vector).mapInArrow(run, T.StructType([*fields, T.StructField(out, T.BinaryType())]))
