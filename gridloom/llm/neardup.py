"""Near-duplicate documents by HyperMinHash registers, bands and exact verification.

A document's set holds its distinct word shingles as 64-bit hashes (a text with
fewer words than a shingle has one: its whole word sequence). The hashes are
split over REGISTERS buckets; a register keeps, of the least hash of its bucket,
the count of leading zeros and MANTISSA bits after them. Empty buckets borrow from
others in a fixed order, so small sets fill all registers too. Documents with
equal sets form one class, a node; sets are equal if two digests of 64 bits are (nodes
that the first one alone would throw together are told apart by the second), and a single
shingle is told from others by a second hash of its words. Classes that share a band of
ROWS registers are candidates:

1. in every band each class meets the band's most central class (a star, so a band
   makes as many pairs as it has members); the collision-corrected register estimate
   drops hopeless pairs, and the full sets confirm the rest;
2. where the members of a band are still in different components, those members are
   compared exactly by a prefix filter: shingles are ordered rarest first, and a pair
   that passes the threshold shares one among the first (1 - threshold) * n + 1. A
   class of which more than that share of shingles is its own drops out at once.

So no link among members of a band is lost, and no band's pairs are all made.

Edge cases: null, empty and blank texts have an empty set and link with nothing,
not even with each other; repeated rows are in one class; a null id counts as
larger than any id. Ids need not be unique: a row is known by its id and its text's hash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, slices, stored

SHINGLE, REGISTERS, MANTISSA, BANDS, ROWS = 5, 256, 10, 36, 7
#: Standard errors that the register estimate may lie below the threshold.
ERRORS = 6
#: Bits of the first digest of a set; a test takes few of them.
DIGEST = 64
_PROBES = 12

_U = np.uint64
_random = np.random.default_rng(20240607)
_BYTE = _random.integers(1, 2**63, 256, dtype=_U) * _U(2) + _U(1)
_BASE = _U(0x9E3779B97F4A7C15)
_PLACE = _random.integers(1, 2**63, 64, dtype=_U) * _U(2) + _U(1)
_BORROW = np.stack([_random.permutation(REGISTERS) for _ in range(_PROBES)])
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mixed(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def shingle_sets(texts: list[str | None], k: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text, A-Z lower-cased."""
    return [s for s, _ in checked_sets(texts, k)]


def checked_sets(texts: list[str | None], k: int = SHINGLE) -> list[tuple[np.ndarray, int]]:
    """The set of each text and a second digest of it; that of a single shingle is made from its words."""
    raw = [(t or "").encode("utf-8", "surrogatepass").lower() for t in texts]
    data = np.frombuffer(b"\n".join([b"", *raw, b""]), dtype=np.uint8)
    space = _SPACE[data]
    starts = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    none = np.empty(0, dtype=_U)
    if not len(starts):
        return [(none, 0)] * len(texts)
    ends = np.flatnonzero(~space[:-1] & space[1:]) + 1
    lengths = ends - starts
    bound = np.empty(2 * len(starts), dtype=np.int64)
    bound[0::2], bound[1::2] = starts, ends
    power = np.cumprod(np.concatenate([[_U(1)], np.full(int(lengths.max()), _BASE)]))
    place = np.arange(len(data)) - np.repeat(np.concatenate([[0], starts]), np.diff(np.concatenate([[0], starts, [len(data)]])))
    place[space] = 0
    words = mixed(np.add.reduceat(_BYTE[data] * power[place], bound)[0::2] + lengths.astype(_U) * _PLACE[0])
    edges = np.cumsum([1, *(len(r) + 1 for r in raw)])
    first = np.searchsorted(starts, edges)
    grams = reduce(np.add, (words[i : len(words) - k + 1 + i] * _PLACE[i + 1] for i in range(k))) if len(words) >= k else none
    grams = mixed(grams)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= k:
            found = np.unique(grams[a : b - k + 1])
        elif b > a:
            found = mixed(np.array([sum(int(w) * int(_PLACE[i + 1]) for i, w in enumerate(words[a:b])) + (b - a) * int(_PLACE[9]) & 2**64 - 1], dtype=_U))
        else:
            found = none
        if len(found) == 1:
            first_words = words[a : min(b, a + k)]
            out.append((found, digest(mixed(first_words * _PLACE[32 : 32 + len(first_words)]), 1)))
        else:
            out.append((found, digest(found, 1) if len(found) else 0))
    return out


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """A row of REGISTERS packed registers for each set; sets must not be empty."""
    bits = 64 - (REGISTERS - 1).bit_length()
    least = np.zeros((len(sets), REGISTERS), dtype=_U)
    full = np.zeros((len(sets), REGISTERS), dtype=bool)
    for i, s in enumerate(sets):
        bucket = (s >> _U(bits)).astype(np.int64)
        lead = np.concatenate([[True], bucket[1:] != bucket[:-1]])
        least[i, bucket[lead]] = s[lead] & _U(2**bits - 1)
        full[i, bucket[lead]] = True
    top = np.frexp((least >> _U(MANTISSA)).astype(np.float64))[1].astype(np.int64)
    mantissa = (least >> np.maximum(top - 1, 0).astype(_U)).astype(np.int64) & (2**MANTISSA - 1)
    packed = np.minimum(bits - MANTISSA - top, 63) << MANTISSA | mantissa
    out = np.where(full, packed, 0)
    lack = ~full
    for order in _BORROW:
        if not lack.any():
            return out
        can = lack & full[:, order]
        out[can] = packed[:, order][can]
        lack &= ~can
    for i in np.flatnonzero(lack.any(axis=1)):  # few are full: take the next one in a fixed order
        have = np.flatnonzero(full[i])
        gaps = np.flatnonzero(lack[i])
        score = mixed(gaps[:, None].astype(_U) * _PLACE[10] + have[None, :].astype(_U) * _PLACE[11])
        out[i, gaps] = packed[i, have[np.argmin(score, axis=1)]]
    return out


def band_keys(regs: np.ndarray) -> np.ndarray:
    parts = regs[:, : BANDS * ROWS].reshape(len(regs), BANDS, ROWS).astype(_U) + _U(1)
    key = (parts * _PLACE[16 : 16 + ROWS]).sum(axis=2, dtype=_U) + np.arange(1, BANDS + 1, dtype=_U) * _PLACE[12]
    return mixed(key).view(np.int64)


def digest(s: np.ndarray, which: int = 0) -> int:
    """A number that identifies a set: the first or the second of two."""
    a, b = (_PLACE[13], _PLACE[14]) if which == 0 else (_PLACE[24], _PLACE[25])
    return int(mixed((mixed(s ^ a) * b).sum(dtype=_U, keepdims=True) + _U(len(s)))[0].view(np.int64))


def sketched(df: DataFrame) -> DataFrame:
    """(id, mark, n, node, twin, regs, bands) of each row (id, mark, text).

    node is the first digest of the set, twin the second; null if it is empty.
    """
    shift = 64 - DIGEST

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in slices(texts):
                sets = checked_sets(texts[a:b])
                some = [s for s, _ in sets if len(s)]
                regs = registers(some) if some else np.empty((0, REGISTERS), dtype=np.int64)
                keys, at, node, twin, packed, bands = band_keys(regs), iter(range(len(some))), [], [], [], []
                for s, second in sets:
                    if not len(s):
                        node.append(None), twin.append(None), packed.append(None), bands.append(None)
                        continue
                    i = next(at)
                    node.append(digest(s) >> shift)
                    twin.append(second)
                    packed.append(regs[i].astype("<u2").tobytes())
                    bands.append(keys[i])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(a, b - a), batch.column("mark").slice(a, b - a), pa.array([len(s) for s, _ in sets], pa.int64()), pa.array(node, pa.int64()), pa.array(twin, pa.int64()), pa.array(packed, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                    ["id", "mark", "n", "node", "twin", "regs", "bands"],
                )

    schema = T.StructType([T.StructField("id", df.schema["id"].dataType), *T.StructType.fromDDL("mark long, n long, node long, twin long, regs binary, bands array<long>").fields])
    return df.select("id", "mark", "text").mapInArrow(run, schema)


def _own_node() -> Column:
    """The node of a set whose first digest other sets have, too."""
    return F.xxhash64(F.lit("twin"), "node", "twin")


def _told_apart(sketch: DataFrame) -> DataFrame:
    """The stored sketch, with a node of its own for each set of those that share one."""
    shared = sketch.filter("node is not null").groupBy("node").agg(F.min("twin").alias("lo"), F.max("twin").alias("hi")).filter("lo != hi")
    shared = stored(shared.select("node", F.lit(True).alias("shared")), "shared")
    if not shared.isEmpty():
        apart = sketch.join(shared, "node", "left").withColumn("node", F.when(F.col("shared"), _own_node()).otherwise(F.col("node")))
        old, sketch = sketch, stored(apart.select(*sketch.columns), "sketches")
        discard(old)
    discard(shared)
    return sketch


def full_sets(df: DataFrame) -> DataFrame:
    """(node, n, grams) of each row (node, text) whose text is of that node: the shingle hashes; both digests are made again."""
    shift = 64 - DIGEST

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in slices(texts):
                sets = checked_sets(texts[a:b])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("node").slice(a, b - a),
                        pa.array([digest(s) >> shift for s, _ in sets], pa.int64()),
                        pa.array([t for _, t in sets], pa.int64()),
                        pa.array([len(s) for s, _ in sets], pa.int64()),
                        pa.array([s.view(np.int64) for s, _ in sets], pa.list_(pa.int64())),
                    ],
                    ["of", "node", "twin", "n", "grams"],
                )

    made = df.select("node", "text").mapInArrow(run, "of long, node long, twin long, n long, grams array<long>")
    return made.filter((F.col("of") == F.col("node")) | (F.col("of") == _own_node())).select(F.col("of").alias("node"), "n", "grams")


def _estimate(a: Column, b: Column, na: Column, nb: Column) -> Column:
    """Share of equal registers, less those expected to be equal by chance."""
    equal = F.size(F.filter(F.sequence(F.lit(0), F.lit(REGISTERS - 1)), lambda i: F.substring(a, i * 2 + 1, F.lit(2)) == F.substring(b, i * 2 + 1, F.lit(2))))
    share = na / nb
    by_chance = 0.16992 * 2.0**-MANTISSA * 4 * share / ((1 + share) * (1 + share))
    return equal / F.lit(float(REGISTERS)) - by_chance


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): the least node that each node of the edge list reaches.

    Every round takes the least label among the neighbours, then the label's own
    label, so labels travel twice as far each time.
    """
    both = stored(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).union(edges.select(F.col(b), F.col(a))).distinct(), "edges")
    label = old = stored(both.groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.first("u")).alias("root")), "labels")
    while True:
        near = both.join(label.withColumnRenamed("node", "v"), "v").groupBy(F.col("u").alias("node")).agg(F.min("root").alias("near"))
        step = label.join(near, "node").select("node", F.col("root").alias("was"), F.least("root", "near").alias("to"))
        on = label.select(F.col("node").alias("to"), F.col("root").alias("next"))
        done = stored(step.join(on, "to").select("node", "was", F.least("to", "next").alias("root")), "labels")
        discard(old)
        label, old = done.select("node", "root"), done
        if done.filter(F.col("was") != F.col("root")).isEmpty():
            discard(both)
            return label


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those (a, b) whose full sets reach the similarity; sets of one shingle in two classes have different ones."""
    left = sets.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("grams").alias("ga"))
    right = sets.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("grams").alias("gb"))
    met = pairs.select("a", "b").join(left, "a").join(right, "b").withColumn("both", F.size(F.array_intersect("ga", "gb")))
    return met.filter(F.greatest("na", "nb") > 1).filter(F.col("both") * 100 >= (F.col("na") + F.col("nb") - F.col("both")) * percent).select("a", "b")


def near_duplicates(df: DataFrame, id: str = "doc_id", text: str = "text", percent: int = 85) -> DataFrame:
    """(id, n_shingles, node, component, mark, root): one row for each row of df.

    component is the least id among all rows reachable over links of at least
    percent similarity, the row's own included; root is the least node of those, null
    for an empty set; mark is the hash of the text.
    """
    docs = df.select(F.col(id).alias("id"), F.col(text).alias("text")).withColumn("mark", F.xxhash64("text"))
    sketch = _told_apart(stored(sketched(docs), "sketches"))
    # a class is known by one row of it, whose id may be null or that of other texts too
    key = F.xxhash64("id", "mark")
    classes = sketch.filter("node is not null").groupBy("node").agg(F.min(key).alias("key"), F.first("n").alias("n"), F.first("regs").alias("regs"), F.first("bands").alias("bands"))
    bands = stored(classes.select("node", F.explode("bands").alias("band")), "bands")
    sizes = bands.groupBy("band").agg(F.count("*").alias("size")).filter("size > 1")
    crowd = stored(bands.join(sizes, "band"), "crowd")
    discard(bands)
    central = crowd.groupBy("node").agg(F.sum("size").alias("weight"))
    ranked = stored(crowd.join(central, "node").select("band", "node", "weight"), "ranked")
    hubs = ranked.groupBy("band").agg(F.max(F.struct("weight", "node")).alias("hub")).select("band", F.col("hub.node").alias("b"))
    discard(crowd)
    starred = stored(ranked.join(hubs, "band").select("band", F.col("node").alias("a"), "b"), "starred")
    pairs = starred.filter("a != b").select("a", "b").distinct()

    # an inner join, as a semi join would be made before the classes and deal out all rows of large ones
    seen = stored(classes.drop("bands").join(ranked.select("node").distinct(), "node"), "seen")
    left = seen.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("regs").alias("ra"))
    right = seen.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("regs").alias("rb"))
    goal = percent / 100
    spread = F.sqrt(goal * (1 - goal) / F.least(F.lit(REGISTERS), "na", "nb"))
    hopeful = pairs.join(left, "a").join(right, "b").filter((F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent) & (_estimate(F.col("ra"), F.col("rb"), F.col("na"), F.col("nb")) >= goal - ERRORS * spread))

    words = docs.withColumn("key", key).join(seen.select("key", "node"), "key").select("node", "text")
    sets = stored(full_sets(words).dropDuplicates(["node"]), "sets")
    links = stored(_confirmed(hopeful, sets, percent), "links")
    discard(ranked, seen)

    # bands whose members are in different components yet
    root = components(links)
    placed = starred.join(root.withColumnRenamed("node", "a"), "a", "left").select("band", "a", F.coalesce("root", "a").alias("root"))
    torn = placed.groupBy("band").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi").select("band")
    rest = placed.join(torn, "band", "left_semi").select(F.col("a").alias("node"), "root").distinct()
    rest = stored(sets.join(rest, "node"), "rest")
    discard(starred)
    first, more = links, stored(_by_prefix(rest, percent), "more")
    discard(rest)
    links = stored(first.union(_confirmed(more, sets, percent)), "links")
    discard(first, more, sets)

    root = components(links)
    discard(links)
    classes = sketch.filter("node is not null").groupBy("node").agg(F.min("id").alias("first"))
    least = classes.join(root, "node", "left").select("node", "first", F.coalesce("root", "node").alias("root"))
    lows = least.groupBy("root").agg(F.min("first").alias("component"))
    named = least.join(lows, "root").select("node", "component", "root")
    # rows without words are not dealt out by a node that they lack; a large class is split by Spark
    linked = sketch.filter("node is not null").select("id", "mark", "n", "node").join(named, "node")
    alone = sketch.filter("node is null").select("id", "mark", "n", "node", F.col("id").alias("component"), F.col("node").alias("root"))
    return linked.unionByName(alone).select(F.col("id").alias(id), F.col("n").alias("n_shingles"), "node", "component", "mark", "root")


def _by_prefix(rest: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of rows (node, n, grams, root) that may reach the similarity and differ in root."""
    grams = rest.select("node", "n", "root", F.explode("grams").alias("gram"))
    shared = grams.groupBy("gram").agg(F.count("*").alias("df")).filter("df > 1")
    own = grams.join(shared, "gram").groupBy("node").agg(F.first("n").alias("n"), F.first("root").alias("root"), F.array_sort(F.collect_list(F.struct("df", "gram"))).alias("seen"))
    # of the first need shingles, rarest first, n - size(seen) are the class's own
    need = F.col("n") - F.ceil(F.col("n") * percent / F.lit(100)) + 1
    take = (need - (F.col("n") - F.size("seen"))).cast("int")
    at = F.col("n") - F.col("own") + F.col("i")
    front = own.withColumn("own", F.size("seen")).filter(take > 0).select("node", "n", "root", "own", F.posexplode(F.slice("seen", F.lit(1), take)).alias("i", "x"))
    front = front.select("node", "n", "root", at.alias("at"), F.col("x.gram").alias("gram"))
    whole = stored(front, "front")
    # under each shingle those outside its commonest root meet all the others, so a
    # large component makes no pairs within itself; sets of too different sizes don't meet, as
    # the ratio of sizes is at least percent for sets of neighbouring cells only
    roots = whole.groupBy("gram", "root").agg(F.count("*").alias("size")).groupBy("gram").agg(F.max(F.struct("size", "root")).alias("main"), F.count("*").alias("roots"))
    roots = stored(roots.filter("roots > 1").select("gram", F.col("main.root").alias("main")), "roots")
    cell = F.floor(F.log(F.col("n")) / math.log(100 / percent)) if percent < 100 else F.col("n")
    front = stored(whole.join(roots, "gram").withColumn("cell", cell), "front")
    discard(whole, roots)
    near = F.explode(F.array(*[F.col("cell") + i for i in (-1, 0, 1)]))
    other = front.select("gram", near.alias("cell"), F.col("node").alias("b"), F.col("n").alias("nb"), F.col("root").alias("rb"), F.col("at").alias("bt"))
    # the first shingle that a pair shares leaves at least the needed number in both
    enough = F.least(F.col("n") - F.col("at"), F.col("nb") - F.col("bt")) * (100 + percent) >= (F.col("n") + F.col("nb")) * percent
    met = front.filter("root != main").withColumnRenamed("node", "a").join(other, ["gram", "cell"])
    met = met.filter((F.col("root") != F.col("rb")) & ((F.col("rb") == F.col("main")) | (F.col("a") < F.col("b"))) & enough)
    return met.select("a", "b").distinct()
