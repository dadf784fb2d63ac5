"""Document fingerprints of closed syncmers.

A k-mer of code points is a closed syncmer if its least s-mer hash is its first or its
last s-mer. Whether a k-mer is chosen depends on nothing around it, so an edit
changes only the syncmers that overlap it. The fingerprint keeps SKETCH syncmers of the
least hashes with their positions; two fingerprints are compared on the least hashes
of both together (bottom-k), counting those present in both whose shift in position
agrees with the shift of other matches, so that chance matches of scattered common
k-mers do not count as copied text.

Edge cases: texts of less than four k-mers' length take k-mers of a quarter of it; the
fingerprint of a null or empty text is the empty string, like only another empty text.
Ids may be of any type that can be sorted. Rows with one id, and those without any, are in one range.
An empty table gives no rows; equal texts have equal fingerprints; very long texts keep SKETCH syncmers like others; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import numbered, slices

K, S, SKETCH = 16, 6, 64
#: Rows in a range that is sorted on its own, about.
PART = 2000
#: Code points by which the shifts of matches may differ to count as one passage.
DRIFT = 64

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)


def _bits(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def _hashes(code: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n code points from each place on, by doubling."""
    h, have, out, at = _bits(code + _BASE), 1, None, 0
    while n:
        if n & have:
            m = len(code) - at - have + 1
            out = h[at : at + m].copy() if out is None else out[:m] * _BASE + h[at : at + m]
            n, at = n - have, at + have
        if n:
            h = _bits(h[:-have] * _U(3) + h[have:] * _BASE)
            have *= 2
    return _bits(out)


def syncmers(text: str, k: int = K, s: int = S) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and positions of the closed syncmers of a text."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(_U)
    if not len(code):
        return np.empty(0, dtype=_U), np.empty(0, dtype=np.int64)
    if len(code) < 4 * k:
        k, s = max(1, len(code) // 4), max(1, len(code) * s // (4 * k))
    inner = _hashes(code, s)
    low, have, wide = inner, 1, k - s + 1
    while have * 2 <= wide:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    low = np.minimum(low[: len(code) - k + 1], low[wide - have : wide - have + len(code) - k + 1])
    at = np.flatnonzero((inner[: len(low)] == low) | (inner[k - s : k - s + len(low)] == low))
    if not len(at):
        at = np.array([int(np.argmin(inner[: len(low)]))])
    return _hashes(code, k)[at], at


def fingerprint(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The SKETCH least hashes, sorted, and the position of each; a k-mer's second and later
    occurrences have hashes of their own, so repeated passages count as often as they occur."""
    h, at = syncmers(text)
    order = np.argsort(h, kind="stable")
    h, at = h[order], at[order]
    new = np.concatenate([[True], h[1:] != h[:-1]]) if len(h) else np.empty(0, dtype=bool)
    again = np.arange(len(h)) - np.flatnonzero(new)[np.cumsum(new) - 1]
    h = np.where(again > 0, _bits(h + again.astype(_U) * _BASE), h)
    h, first = np.unique(h, return_index=True)
    return h[:SKETCH], at[first][:SKETCH]


def written(print_: tuple[np.ndarray, np.ndarray]) -> str:
    return ",".join(f"{h:016x}@{p}" for h, p in zip(print_[0].tolist(), print_[1].tolist(), strict=True))


def read(text: str) -> tuple[np.ndarray, np.ndarray]:
    parts = [x.split("@") for x in text.split(",")] if text else []
    return np.array([int(h, 16) for h, _ in parts], dtype=_U), np.array([int(p) for _, p in parts], dtype=np.int64)


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """0 to 1: the share of the least hashes of both texts that match in line with others."""
    (ha, pa_), (hb, pb) = a, b
    if not len(ha) or not len(hb):
        return float(len(ha) == len(hb))
    if len(ha) == len(hb) and np.array_equal(ha, hb) and np.array_equal(pa_, pb):
        return 1.0
    # below the last hash of a full sketch both sides are known
    cut = min([x[-1] for x in (ha, hb) if len(x) == SKETCH], default=_U(2**64 - 1))
    every = np.union1d(ha, hb)
    every = every[every <= cut]
    both, i, j = np.intersect1d(ha, hb, assume_unique=True, return_indices=True)
    ok = both <= cut
    shift = np.sort(pa_[i[ok]] - pb[j[ok]])
    if not len(shift):
        return 0.0
    near = np.searchsorted(shift, shift + DRIFT, "right") - np.searchsorted(shift, shift - DRIFT, "left")
    agree = len(shift) if len(shift) < 3 else int((near > 1).sum())
    return agree / len(every)


def successive(df: DataFrame, compare: Callable[[list[str], list[str]], list[tuple]], schema: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, *schema): compare's results for lists of texts and of the texts that follow them.

    The row that follows is the next in ascending order of (id, text), null first, and after
    the last the first. Ranges of id, of about PART rows, are sorted each on its own;
    each also gets the first row of the next range as a guest.
    """
    rows = df.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    if not isinstance(df.schema[id].dataType, T.IntegralType):
        rows = numbered(rows, "id", "place")
    rows = rows.withColumn("place", F.coalesce(F.col("place" if "place" in rows.columns else "id").cast("double"), F.lit(-np.inf)))
    whole = rows.agg(F.count("*").alias("n"), F.max("place").alias("top")).first()
    # some ranges for each task, so what comes to the driver or is broadcast is bounded by a setting
    parts = min(whole.n // PART + 1, 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    cuts = rows.stat.approxQuantile("place", [i / parts for i in range(1, parts)], 0.2 / parts) if parts > 1 else []
    splits = [-np.inf, *sorted({c for c in cuts if -np.inf < c < whole.top}), np.inf]
    placed = Bucketizer(splits=splits, inputCol="place", outputCol="part").transform(rows) if len(splits) > 2 else rows.withColumn("part", F.lit(0.0))
    # the first place of each range, and the range before it, to which that row goes as a guest
    first = sorted((r.part, r.low) for r in placed.groupBy("part").agg(F.min("place").alias("low")).collect())
    hosts = df.sparkSession.createDataFrame([(low, first[i - 1][0]) for i, (_, low) in enumerate(first)], "place double, host double")
    stays = F.struct(F.col("part").alias("part"), F.lit(0).alias("guest"))
    goes = F.struct(F.coalesce("host", "part").alias("part"), F.lit(1).alias("guest"))
    sent = placed.join(F.broadcast(hosts), "place", "left").withColumn("to", F.explode(F.when(F.col("host").isNull(), F.array(stays)).otherwise(F.array(stays, goes))))
    dealt = sent.select("id", "text", F.col("to.part").cast("int").alias("part"), F.col("to.guest").alias("guest")).repartitionById(max(1, len(splits) - 1), "part").sortWithinPartitions("part", "guest", "id", "text")
    out = T.StructType([T.StructField(id, df.schema[id].dataType), *T.StructType.fromDDL(schema).fields])
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None
        for batch in batches:
            texts, ids, part, guest = (batch.column(c).to_pylist() for c in ("text", "id", "part", "guest"))
            for a, b in slices(texts):
                done, own, after = [], [], []
                for i in range(a, b):
                    if held is not None and held[2] == part[i]:
                        done.append(held[0]), own.append(held[1]), after.append(texts[i])
                        held = None
                    if not guest[i]:
                        held = (ids[i], texts[i], part[i])
                if done:
                    columns = zip(*compare(own, after), strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip([done, *columns], arrow, strict=True)], schema=arrow)

    return dealt.mapInArrow(run, out)
