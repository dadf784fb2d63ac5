"""Mixing sources to target weights by a low-discrepancy schedule.

Targets. Sources in code point order, null last, weigh 5, 2, 1 and again; they share
all words of the table. A target stops at REPEATS times its source's words, and the
excess is shared again by weight: sorted by limit per weight, the sources up to some
place are at their limit and the others share the rest, so one running sum gives it.

Schedule. There are n = 2^m slots. Slot i takes the van der Corput point of i, its m bits
mirrored at the binary point, and belongs to the source whose interval of cumulative
target shares holds the point. As the n points are the multiples of 1 / n, a source's
slots are the mirrored numbers of the grid places in its interval, and it wins its share
of all slots to within one. Slots are ranked per source, and the slot of rank r takes the r-th
block of the source's line: its documents in hashed order, passed up to REPEATS times.
All blocks are as long as one slot's share of all words, so what a source gives is what
its slots take, less what lies beyond the last pass.

Nothing is ordered in one task: ranks and offsets are prefix sums over chunks of about the
square root of all rows, then running sums within them; sources are sorted by ranges.

Edge cases: null and empty texts have no words and take none; a table without words
takes none; equal rows are taken like rows with different ids, in the order of their ids' hash,
then of their texts'; a null id is placed by its text; a very long text is a long piece of its source's line and may fill many slots;
columns that are not asked for are left out.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import n_words, stored

WEIGHTS = (5, 2, 1)
REPEATS = 3
#: Words in a slot, at most; small tables get shorter ones, BLOCKS at least for the mean source.
BLOCK, BLOCKS = 4096, 1024
#: Rows in a chunk, at least.
CHUNK = 1000
#: Grid places that a source's row makes at a time.
PART = 1 << 16


def _sorted_sums(df: DataFrame, order: list[Column], sums: dict[str, Column], name: str) -> DataFrame:
    """df with the sums over the rows before each in order, by ranges of it."""
    held = stored(df.orderBy(*order).withColumn("_i", F.monotonically_increasing_id()), name)
    held = held.withColumn("_part", F.shiftright("_i", 33))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)  # over one row for each range
    parts = held.groupBy("_part").agg(*[F.sum(v).alias(f"_{k}") for k, v in sums.items()])
    parts = parts.select("_part", *[F.coalesce(F.sum(f"_{k}").over(before), F.lit(0)).alias(f"_{k}") for k in sums])
    within = W.partitionBy("_part").orderBy("_i").rowsBetween(W.unboundedPreceding, -1)
    found = held.withColumns({k: F.coalesce(F.sum(v).over(within), F.lit(0)) for k, v in sums.items()}).join(parts, "_part")
    return found.withColumns({k: F.col(k) + F.col(f"_{k}") for k in sums}).drop("_i", "_part", *[f"_{k}" for k in sums])


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, weight, k, target) from (source, size); k counts the sources from 0."""
    summed = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = _sorted_sums(summed, [F.col("source").asc_nulls_last()], {"k": F.lit(1)}, "sources")
    ranked = ranked.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("k") % len(WEIGHTS) + 1).cast("int")).cast("double"))
    ranked = ranked.withColumn("limit", REPEATS * F.col("source_size"))
    whole = ranked.agg(F.sum("source_size").alias("total"), F.sum("weight").alias("weights"))
    per = F.col("source_size") / F.col("weight")
    spread = _sorted_sums(ranked, [per, F.col("k")], {"full": F.col("limit"), "used": F.col("weight")}, "limits").crossJoin(F.broadcast(whole))  # one row
    spread = spread.withColumn("level", (F.col("total") - F.col("full")) / (F.col("weights") - F.col("used")))
    spread = stored(spread.withColumn("free", F.col("level") * F.col("weight") <= F.col("limit")), "levels")
    # from the first free source on, all are free and share at its level
    level = spread.agg(F.min(F.when(F.col("free"), F.struct(per, "k", "level"))).getField("level").alias("at"))
    target = F.when(F.col("free"), F.col("at") * F.col("weight")).otherwise(F.col("limit").cast("double"))
    return spread.crossJoin(F.broadcast(level)).select("source", "source_size", "weight", "k", F.coalesce(target, F.col("limit").cast("double")).alias("target"))


def _running(df: DataFrame, keys: list[str], order: list[str], value: str, out: str) -> DataFrame:
    """df with out: the sum of value over the rows before it in order among those with its keys.

    order starts with the chunk, a number that grows with the order.
    """
    chunk, *inner = order
    sums = df.groupBy(*keys, chunk).agg(F.sum(value).alias("_sum"))
    before = W.partitionBy(*keys).orderBy(chunk).rowsBetween(W.unboundedPreceding, -1)
    starts = sums.select(*keys, chunk, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    within = W.partitionBy(*keys, chunk).orderBy(*inner).rowsBetween(W.unboundedPreceding, -1)
    part = df.withColumn(out, F.coalesce(F.sum(value).over(within), F.lit(0)))
    return part.join(starts, [*keys, chunk]).withColumn(out, F.col(out) + F.col("_start")).drop("_start")


def mirrored(place: Column, bits: int) -> Column:
    """The number whose bits are those of place in reverse."""
    return F.conv(F.reverse(F.lpad(F.bin(place), bits, "0")), 2, 10).cast("long") if bits else F.lit(0).cast("long")


def schedule(aims: DataFrame, bits: int) -> DataFrame:
    """(k, rank, slot): the slots that the sources of aims (k, target) win among 2 ** bits."""
    n = 2**bits
    whole = aims.agg(F.sum("target").alias("total"), F.max(F.when(F.col("target") > 0, F.col("k"))).alias("last"))
    shares = _sorted_sums(aims.filter("target > 0"), [F.col("k")], {"below": F.col("target")}, "shares").crossJoin(F.broadcast(whole))  # one row
    edge = lambda words: F.least(F.ceil(words / F.col("total") * n), F.lit(n)).cast("long")
    shares = shares.select("k", edge(F.col("below")).alias("lo"), F.when(F.col("k") == F.col("last"), n).otherwise(edge(F.col("below") + F.col("target"))).alias("hi"))
    # a large source's places are made in parts, dealt out evenly
    parts = shares.filter("lo < hi").select("k", "lo", "hi", F.explode(F.sequence(F.floor(F.col("lo") / PART), F.floor((F.col("hi") - 1) / PART))).alias("part")).repartition("part")
    places = parts.select("k", F.explode(F.sequence(F.greatest("lo", F.col("part") * PART), F.least("hi", (F.col("part") + 1) * PART) - 1)).alias("place"))
    slots = places.select("k", mirrored(F.col("place"), bits).alias("slot"), F.lit(1).alias("one")).withColumn("chunk", F.floor(F.col("slot") / max(CHUNK, math.isqrt(n))))
    return stored(_running(slots, ["k"], ["chunk", "slot"], "one", "rank").select("k", "rank", "slot"), "schedule")


def mixed(df: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", seed: int = 0, also: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """The documents and what the mix takes of them.

    The first frame has row (a number of the row), id, source, size, source_size, target
    and the columns named in also; the second has row, pass (0 to REPEATS - 1), slot and
    words: the words that a slot takes from a row in a pass.
    """
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(id).cast("string"), F.concat(F.lit("null:"), F.xxhash64(text).cast("string")))))
    h = F.conv(F.substring(digest, 1, 12), 16, 10).cast("long")
    rows = df.select(F.col(id).alias("id"), F.col(source).alias("source"), n_words(F.col(text)).alias("size"), h.alias("h"), F.xxhash64(text).alias("tie"), *(also or []))
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "sizes")
    whole = rows.agg(F.count("*").alias("rows"), F.coalesce(F.sum("size"), F.lit(0)).alias("words")).first()
    aims = stored(targets(rows.select("source", "size")), "targets")
    block = max(1, min(BLOCK, whole.words // (max(1, aims.count()) * BLOCKS)))
    bits = max(0, math.ceil(math.log2(max(1, whole.words) / block)))
    share = max(1, whole.words) / 2**bits  # words in a slot
    slots = schedule(aims.select("k", "target"), bits)
    won = slots.groupBy("k").agg(F.count("*").alias("won"))
    gives = F.least(F.floor(F.coalesce("won", F.lit(0)) * share), REPEATS * F.col("source_size"))
    aims = stored(aims.join(won, "k", "left").withColumn("gives", gives), "shares")  # one row for each source
    known = rows.alias("r").join(aims.alias("a"), F.col("r.source").eqNullSafe(F.col("a.source"))).select("r.*", "a.k", "a.source_size", "a.target", "a.gives")

    chunks = whole.rows // max(CHUNK, math.isqrt(whole.rows)) + 1
    line = known.filter("size > 0").select("row", "k", "size", "source_size", "gives", "h", "tie", F.floor(F.col("h") * chunks / 2**48).alias("chunk"))
    line = _running(line, ["k"], ["chunk", "h", "tie", "row"], "size", "at")
    lo = F.col("pass") * F.col("source_size") + F.col("at")
    passes = line.withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(REPEATS - 1)))).withColumn("lo", lo).withColumn("hi", F.least(F.col("lo") + F.col("size"), "gives")).filter("hi > lo")
    # the block of a word is the quotient by share, or a neighbour where that is rounded
    near = F.sequence(F.greatest(F.floor(F.col("lo") / share) - 1, F.lit(0)), F.floor(F.col("hi") / share) + 1)
    words = F.least("hi", F.floor((F.col("rank") + 1) * share)) - F.greatest("lo", F.floor(F.col("rank") * share))
    pieces = passes.select("row", "k", "pass", "lo", "hi", F.explode(near).alias("rank")).select("row", "k", "pass", "rank", words.cast("long").alias("words")).filter("words > 0")
    taken = pieces.join(slots, ["k", "rank"]).select("row", "pass", "slot", "words")
    return known.drop("k", "h", "tie", "gives"), taken
