"""Clusters around centroids of whole numbers, searched in balls around the centroid that a vector had.

Vectors and centroids are whole numbers, and so are squared distances, so that equal
distances are seen as equal. A snapshot holds for every vector its centroid, an
upper bound of the distance to it and a lower bound of that to any other, at the centroids of that time. Later rounds
loosen the bounds by how far centroids have moved since then, as the crow flies, so a round reads
the snapshot and writes nothing but sums; every REFRESH rounds it is made anew. A vector whose upper
bound lies below the lower one, or below half the way to the centroid's nearest neighbour, stays. Any
other gets its exact distance, and if that doesn't settle it, only the centroids in the ball around its centroid with
twice that distance and the way to the nearest neighbour as its radius are looked at. They are the
head of the centroid's list of all others, sorted by distance. The radius is inclusive and bounds
have a margin for rounding, so nearest, second nearest and all ties lie within; of equally near centroids
the one with the smaller number is taken, by whole numbers.

Edge cases: vectors that are null, of another size or with null or non-finite entries are left out; with fewer vectors
than clusters each starts one; an empty table gives no rows; equal vectors share a cluster; a null id
hashes like an empty one; repeated ids are rows of their own; other columns are left out. The
driver holds the centroids and their sums: clusters x entries numbers, whatever the table's size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, stored
from .vectors import matrix, whole

#: Rounds from one snapshot to the next, vectors looked at together.
REFRESH, STEP = 4, 1 << 14
#: Relative margin of bounds, far above the rounding of their few operations.
MARGIN = 1e-9
#: Entries must be less than this for squared distances below 2^63.
MOST = 1 << 26


class Centroids:
    """Centroids with, for each, the others sorted by their distance."""

    def __init__(self, at: np.ndarray) -> None:
        self.at = np.asarray(at, dtype=np.int64)
        self.k = len(self.at)
        away = np.sqrt(self.squared(self.at, np.arange(self.k)).astype(np.float64))
        np.fill_diagonal(away, -1.0)  # itself comes first in its list
        self.order = np.argsort(away, axis=1, kind="stable")
        self.away = np.take_along_axis(away, self.order, axis=1)
        self.away[:, 0] = 0.0
        self.gap = self.away[:, 1] if self.k > 1 else np.full(self.k, np.inf)

    def squared(self, x: np.ndarray, chosen: np.ndarray) -> np.ndarray:
        """Squared distances of all x to the chosen centroids, exact."""
        c = self.at[chosen]
        top = max(int(np.abs(x).max(initial=0)), int(np.abs(c).max(initial=0)))
        if x.shape[1] * (2 * top) ** 2 < 1 << 52:  # whole numbers that doubles hold: one matrix product
            a, b = x.astype(np.float64), c.astype(np.float64)
            return ((a * a).sum(axis=1)[:, None] - 2.0 * (a @ b.T) + (b * b).sum(axis=1)).astype(np.int64)
        return np.stack([((x - one) ** 2).sum(axis=1) for one in c], axis=1) if len(c) else np.empty((len(x), 0), dtype=np.int64)

    def own(self, x: np.ndarray, cluster: np.ndarray) -> np.ndarray:
        """Squared distances to each vector's own centroid, exact."""
        return ((x - self.at[cluster]) ** 2).sum(axis=1)


def _two(squares: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first column with the least square, its root and that of the least one beside it."""
    best = squares.argmin(axis=1)
    least = squares[np.arange(len(squares)), best]
    rest = squares.astype(np.float64)
    rest[np.arange(len(squares)), best] = np.inf
    return best, np.sqrt(least.astype(np.float64)), np.sqrt(rest.min(axis=1, initial=np.inf))


def scan(x: np.ndarray, now: Centroids) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cluster, upper, lower) of all x by all centroids."""
    parts = [_two(now.squared(x[i : i + STEP], np.arange(now.k))) for i in range(0, len(x), STEP)]
    return tuple(np.concatenate(p) for p in zip(*parts, strict=True)) if parts else (np.empty(0, dtype=np.int64), np.empty(0), np.empty(0))


def search(x: np.ndarray, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray, then: Centroids, now: Centroids) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(cluster, upper, lower) of all x, given what they were at the centroids then; and how many distances were computed."""
    moved = np.sqrt(((now.at - then.at) ** 2).sum(axis=1).astype(np.float64))
    far = np.sort(moved)[::-1]
    # the furthest that any other centroid has moved
    others = np.where(moved == far[0], far[1] if now.k > 1 and (moved == far[0]).sum() == 1 else far[0], far[0])
    cluster = cluster.astype(np.int64)
    upper = (upper + moved[cluster]) * (1 + MARGIN)
    lower = (lower - others[cluster]) * (1 - MARGIN)
    enough = np.maximum(lower, now.gap[cluster] / 2 * (1 - MARGIN))
    left = np.flatnonzero(upper >= enough)
    upper[left] = np.sqrt(now.own(x[left], cluster[left]).astype(np.float64))
    done = len(left)
    left = left[upper[left] * (1 + MARGIN) >= enough[left]]
    for c in np.unique(cluster[left]):
        mine = left[cluster[left] == c]
        radius = (2 * upper[mine] + now.gap[c]) * (1 + MARGIN)
        within = np.searchsorted(now.away[c], radius, "right") if now.k > 1 else np.ones(len(mine), dtype=np.int64)
        # rings: vectors whose balls hold about as many centroids are searched together
        ring = np.minimum(1 << np.ceil(np.log2(np.maximum(within, 1))).astype(np.int64), now.k)
        for width in np.unique(ring):
            rows, near = mine[ring == width], np.sort(now.order[c][:width])
            for i in range(0, len(rows), STEP):
                part = rows[i : i + STEP]
                best, upper[part], lower[part] = _two(now.squared(x[part], near))
                cluster[part] = near[best]
                done += len(part) * int(width)
    return cluster, upper, lower, done


def _seen(batch: pa.RecordBatch, dims: int, then: np.ndarray | None, now: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """x, cluster, upper and lower of a batch at the centroids now."""
    x = matrix(batch.column("x"), dims)
    if np.abs(x).max(initial=0) >= MOST:
        raise ValueError(f"whole numbers of entries must lie below {MOST}")
    if then is None:
        return x, *scan(x, Centroids(now))
    held = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("cluster", "upper", "lower")]
    return x, *search(x, *held, Centroids(then), Centroids(now))[:3]


def _snapshot(rows: DataFrame, dims: int, then: np.ndarray | None, now: np.ndarray) -> DataFrame:
    """rows with cluster, upper and lower at the centroids now."""
    kind = T.StructType([f for f in rows.schema.fields if f.name not in ("cluster", "upper", "lower")])
    names = kind.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, cluster, upper, lower = _seen(batch, dims, then, now)
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(cluster, pa.int32()), pa.array(upper), pa.array(lower)], [*names, "cluster", "upper", "lower"])

    return rows.mapInArrow(run, T.StructType([*kind.fields, *T.StructType.fromDDL("cluster int, upper double, lower double").fields]))


def _updated(rows: DataFrame, dims: int, then: np.ndarray, now: np.ndarray) -> np.ndarray:
    """The centroids after a round: the floor of the mean of their vectors, exact; those without vectors stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros(now.shape, dtype=np.int64), np.zeros(len(now), dtype=np.int64)
        for batch in batches:
            x, cluster, _, _ = _seen(batch, dims, then, now)
            for c in np.unique(cluster):
                mine = cluster == c
                sums[c] += x[mine].sum(axis=0)
                counts[c] += mine.sum()
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(counts[used]), pa.array(list(sums[used]), pa.list_(pa.int64()))], ["cluster", "n", "sums"])

    parts = rows.select("x", "cluster", "upper", "lower").mapInArrow(run, "cluster int, n long, sums array<long>")
    entry = parts.select("cluster", "n", F.posexplode("sums").alias("entry", "value"))
    wide = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    out = now.copy()
    for r in entry.groupBy("cluster", "entry").agg(wide("n"), wide("value")).collect():  # clusters x entries rows
        out[r["cluster"], r["entry"]] = int(r["value"]) // int(r["n"])
    return out


def first_centroids(rows: DataFrame, k: int, seed: str, id: str) -> np.ndarray:
    """The k vectors with the smallest SHA-256 of seed:id, in their order; of rows with one id the least vector first."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id).cast("string"), F.lit(""))).cast("binary"), 256)
    found = rows.select(digest.alias("digest"), "x").orderBy("digest", "x").limit(k).collect()
    return np.array([np.frombuffer(r["x"], dtype="<i4") for r in found], dtype=np.int64)


def clustered(df: DataFrame, k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, seed: str = "3", id: str = "vec_id", vector: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """((id, cluster, distance, cluster_inertia, inertia), centroids) after so many rounds and one more assignment.

    Entries become floor(scale * entry); distance is squared; inertia is the sum of distances over a cluster, and over all.
    """
    named = df.select(F.col(id).alias("_id"), F.col(vector).alias("_vector"))
    rows = stored(whole(named, "_vector", ["_id"], dims, scale), "vectors")
    now = first_centroids(rows, k, seed, "_id")
    kind = "cluster int, distance long, cluster_inertia long, inertia long"
    if not len(now):
        return df.sparkSession.createDataFrame([], T.StructType([df.schema[id], *T.StructType.fromDDL(kind).fields])), now
    then, held = None, rows
    for r in range(rounds):
        if r % REFRESH == 0:
            held, old = stored(_snapshot(held, dims, then, now), "snapshot"), held
            discard(old)
            then = now
        now = _updated(held, dims, then, now)
    field = named.schema["_id"]

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, cluster, _, _ = _seen(batch, dims, then, now)
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(cluster, pa.int32()), pa.array(Centroids(now).own(x, cluster))], ["_id", "cluster", "distance"])

    found = stored(held.mapInArrow(last, T.StructType([field, *T.StructType.fromDDL("cluster int, distance long").fields])), "clusters")
    discard(held)
    sums = {r["cluster"]: int(r["s"]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}  # k rows
    of = F.create_map(*[F.lit(v) for c, s in sums.items() for v in (c, s)])
    return found.select(F.col("_id").alias(id), "cluster", "distance", of[F.col("cluster")].cast("long").alias("cluster_inertia"), F.lit(sum(sums.values())).cast("long").alias("inertia")), now


def centroid_digest(centroid: np.ndarray) -> str:
    """SHA-256 of a centroid's entries as decimal numbers joined by commas."""
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()
