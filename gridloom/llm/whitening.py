"""Whitening of vectors of whole numbers by an exact scatter matrix.

The fit list has every different vector once. Their number n and sums S are exact, and each
vector becomes y = n * x - S, which is n times its distance from the mean, without any rounding. The scatter sum of
y y' is found in a residue number system: each task takes its y modulo several primes, small enough
for matrix products in doubles to be exact, and multiplies modulo each prime. The residues of all tasks
are added up, and Chinese remaindering gives the whole numbers back; there are as many primes as the largest
possible entry needs. So the covariance, scatter / n^3, is rounded once, however large the mean
is beside the spread, and a double eigendecomposition gives the components. Their whitened covariance is measured
on the fit list in a pass of its own.

Edge cases: vectors that are null, of another size than most or with null or non-finite entries are left
out; an empty table gives no rows; directions without spread (eigenvalues within rounding of 0, as with
one vector only) have no component; repeated rows and ids are rows of their own, but one vector of the fit list;
other columns are left out; a deviation beyond 64 bits is null. The driver holds entries x entries numbers for each prime, whatever the table's size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, stored
from .vectors import matrix, usual_size, whole

#: Primes lie below this; residues are at most half as large, so a product of BLOCK rows is below 2^53.
TOP, BLOCK = 1 << 21, 1 << 12


def primes(bound: int) -> list[int]:
    """The largest primes below TOP, as many as make a product above 2 * bound."""
    found: list[int] = []
    product, p = 1, TOP - 1
    while product <= 2 * bound:
        if all(p % q for q in range(3, math.isqrt(p) + 1, 2)):
            found.append(p)
            product *= p
        p -= 2
    return found


def residue_scatter(y: np.ndarray, p: int) -> np.ndarray:
    """Sum of the products of all entries of the rows of y, modulo p."""
    r = y % p
    r = np.where(r > p // 2, r - p, r).astype(np.float64)
    total = np.zeros((y.shape[1], y.shape[1]), dtype=np.int64)
    for i in range(0, len(r), BLOCK):
        total = (total + (r[i : i + BLOCK].T @ r[i : i + BLOCK]).astype(np.int64)) % p
    return total


def remaindered(residues: list[int], moduli: list[int]) -> int:
    """The whole number nearest 0 with these residues."""
    value, product = 0, 1
    for r, p in zip(residues, moduli, strict=True):
        value += product * ((r - value) * pow(product, -1, p) % p)
        product *= p
    return value - product if value > product // 2 else value


@dataclass(frozen=True)
class Fit:
    """n different vectors, their sums, eigenvalues falling with unit vectors as columns, and the trace of the covariance."""

    n: int
    sums: list[int]
    values: np.ndarray
    components: np.ndarray
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - sums, exact."""
        return x * self.n - np.array(self.sums, dtype=np.int64)

    def whitened(self, y: np.ndarray) -> np.ndarray:
        return (y / self.n) @ self.components / np.sqrt(self.values)


def _wide(column: str) -> F.Column:
    return F.sum(F.col(column).cast("decimal(38,0)")).alias(column)


def _entries(vectors: DataFrame, dims: int) -> tuple[int, list[int], int]:
    """How many vectors there are, their sums, and the largest distance of an entry from its dimension's ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("x"), dims)
            if len(x):
                columns = [np.full(dims, len(x)), np.arange(dims), x.sum(axis=0), x.min(axis=0), x.max(axis=0)]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["n", "entry", "total", "low", "high"])

    parts = vectors.mapInArrow(run, "n long, entry long, total long, low long, high long")
    found = sorted(parts.groupBy("entry").agg(F.sum("n").alias("n"), _wide("total"), F.min("low").alias("low"), F.max("high").alias("high")).collect())  # a row for each entry
    n, sums = found[0]["n"] if found else 0, [int(r["total"]) for r in found]
    widest = max((max(n * r["high"] - s, s - n * r["low"]) for r, s in zip(found, sums, strict=True)), default=0)
    return n, sums, widest


def scatter(vectors: DataFrame, dims: int, n: int, sums: list[int], widest: int) -> list[list[int]]:
    """Sum of y y' over the column x of vectors, y = n * x - sums, exact. widest: no entry of y is larger."""
    if widest >= 1 << 62:
        raise ValueError("n * x - sums needs more than 63 bits")
    moduli, shift = primes(n * widest * widest), np.array(sums, dtype=np.int64)
    upper = np.triu_indices(dims)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [np.zeros((dims, dims), dtype=np.int64) for _ in moduli]
        for batch in batches:
            y = matrix(batch.column("x"), dims) * n - shift
            for i, p in enumerate(moduli):
                total[i] = (total[i] + residue_scatter(y, p)) % p
        for i, part in enumerate(total):
            values = part[upper]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(values), i), pa.int32()), pa.array(np.arange(len(values)), pa.int32()), pa.array(values)], ["prime", "place", "residue"])

    parts = vectors.select("x").mapInArrow(run, "prime int, place int, residue long")
    held = np.zeros((len(upper[0]), len(moduli)), dtype=object)
    for r in parts.groupBy("prime", "place").agg(F.sum("residue").alias("residue")).collect():  # entries squared / 2 for each prime
        held[r["place"], r["prime"]] = r["residue"] % moduli[r["prime"]]
    out = [[0] * dims for _ in range(dims)]
    for place, (i, j) in enumerate(zip(*upper, strict=True)):
        out[i][j] = out[j][i] = remaindered(list(held[place]), moduli)
    return out


def fitted(vectors: DataFrame, dims: int, most: int) -> Fit:
    """The first components, at most most, of the different rows of the column x."""
    n, sums, widest = _entries(vectors, dims)
    if not n:
        return Fit(0, [], np.empty(0), np.empty((dims, 0)), 0.0)
    covariance = np.array([[v / n**3 for v in row] for row in scatter(vectors, dims, n, sums, widest)])
    values, components = np.linalg.eigh(covariance)
    values, components = values[::-1][:most], components[:, ::-1][:, :most]
    trace = float(np.trace(covariance))
    real = values > dims * np.finfo(float).eps * max(trace, 0.0)
    values, components = values[real], components[:, real]
    turn = np.sign(components[np.abs(components).argmax(axis=0), np.arange(components.shape[1])])  # the largest entry is above 0
    return Fit(n, sums, values, components * turn, trace)


def identity_error(vectors: DataFrame, dims: int, fit: Fit) -> float:
    """The largest absolute entry of the covariance of the whitened vectors less the identity."""
    k = len(fit.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for batch in batches:
            w = fit.whitened(fit.centred(matrix(batch.column("x"), dims)))
            total += np.vstack([w.T @ w, w.sum(axis=0)])
        flat = total.ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat)), pa.int32()), pa.array(flat)], ["place", "value"])

    parts = vectors.select("x").mapInArrow(run, "place int, value double")
    total = np.zeros((k + 1) * k)
    for r in parts.groupBy("place").agg(F.sum("value").alias("value")).collect():  # components squared
        total[r["place"]] = r["value"]
    total = total.reshape(k + 1, k) / fit.n
    return float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max(initial=0.0))


def whitened(df: DataFrame, components: int = 16, scale: int = 64, shift: int = 1_000_000, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) of every usable row and each of the first components.

    Entries become x = floor(scale * entry) + shift. n: different vectors; deviation: the sum over
    entries of (n * x - S)^2, exact; whitened: x less the mean on the component, over the root of its
    eigenvalue; explained: that eigenvalue's share of the trace.
    """
    spark = df.sparkSession
    named = df.select(F.col(id).alias("_id"), F.col(vector).alias("_vector"))
    kind = T.StructType([T.StructField(id, df.schema[id].dataType), *T.StructType.fromDDL("component int, n long, deviation long, whitened double, explained double, identity_error double").fields])
    dims = usual_size(named, "_vector")
    if not dims:
        return spark.createDataFrame([], kind)
    rows = stored(whole(named, "_vector", ["_id"], dims, scale, shift), "vectors")
    vectors = stored(rows.select("x").distinct(), "fit-list")
    fit = fitted(vectors, dims, components)
    k = len(fit.values)
    if not k:
        return spark.createDataFrame([], kind)
    error = identity_error(vectors, dims, fit)
    discard(vectors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = fit.centred(matrix(batch.column("x"), dims))
            w, again = fit.whitened(y), np.repeat(np.arange(len(y)), k)
            exact = float(np.abs(y).max(initial=0)) ** 2 * dims < 2.0**62
            squares = pa.array((y * y).sum(axis=1)) if exact else pa.array([s if s < 2**63 else None for s in (sum(v * v for v in row) for row in y.tolist())], pa.int64())
            columns = [
                batch.column("_id").take(pa.array(again)), pa.array(np.tile(np.arange(1, k + 1), len(y)), pa.int32()), pa.array(np.full(len(again), fit.n), pa.int64()), squares.take(pa.array(again)),
                pa.array(w.ravel()), pa.array(np.tile(fit.values / fit.trace, len(y))), pa.array(np.full(len(again), error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, kind.names)

    return rows.mapInArrow(run, kind)
