"""Small helpers that several text operators share."""

from __future__ import annotations

import os
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.sources.scratch import discard, stored

__all__ = ["WORD", "column_slices", "discard", "n_words", "numbered", "slices", "stored", "table"]

#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def numbered(df: DataFrame, id: str, out: str) -> DataFrame:
    """df with the long column out: numbers that sort like the column id, null where it is null."""
    names = df.select(F.col(id).alias("_name")).filter(F.col("_name").isNotNull()).distinct().orderBy("_name")
    names = stored(names.select("_name", F.monotonically_increasing_id().alias(out)), "names")
    return df.join(names, F.col(id) == F.col("_name"), "left").drop("_name")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def n_words(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def slices(texts: Sequence[str | None], limit: int = 1 << 18) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about limit characters together, at least one row each."""
    start = held = 0
    for i, t in enumerate(texts):
        if held and held + len(t or "") > limit:
            yield start, i
            start, held = i, 0
        held += len(t or "") + 64
    if start < len(texts):
        yield start, len(texts)


def column_slices(column: pa.Array, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about limit bytes of strings together, at least one row each."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 64)
    start = 0
    while start < len(column):
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + limit, "right")))
        yield start, stop
        start = stop
