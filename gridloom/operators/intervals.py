"""Intervals between points and their overlaps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridloom.functions.localtime import hours_between, micros

#: Seconds of a bin in which intervals meet.
BIN = 3600


def to_intervals(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, start, stop, value, next_value) of consecutive points; the last point opens none."""
    order = W.partitionBy(*keys).orderBy("time", "value")
    pairs = df.withColumns({"stop": F.lead("time").over(order), "next_value": F.lead("value").over(order)})
    return pairs.filter("stop is not null").select(*keys, F.col("time").alias("start"), "stop", "value", "next_value")


def _bin(instant: Column, width: int) -> Column:
    return F.floor(micros(instant) / (width * 1_000_000)).cast("long")


def overlaps(left: DataFrame, right: DataFrame, keys: Sequence[str], width: int = BIN) -> DataFrame:
    """Pairs of intervals with equal keys and l.start < r.stop and l.stop > r.start.

    Both sides are dealt to the bins they touch, so that a join group is what one bin
    holds; a pair is made only in the bin of the later of the two starts. The right
    side's columns other than keys get the prefix r_.
    """
    touched = lambda df: F.explode(F.sequence(_bin(df["start"], width), _bin(df["stop"] - F.expr("INTERVAL 1 MICROSECOND"), width)))
    a = left.withColumn("bin", touched(left))
    b = right.withColumn("bin", touched(right)).select(*keys, "bin", *[F.col(c).alias(f"r_{c}") for c in right.columns if c not in keys])
    met = a.join(b, [*keys, "bin"])
    here = F.col("bin") == _bin(F.greatest("start", "r_start"), width)
    return met.filter((F.col("start") < F.col("r_stop")) & (F.col("stop") > F.col("r_start")) & here).drop("bin")


#: Sums kept for each side of an interval: energy in watts times microseconds, microseconds, and how many powers are no numbers.
_SUMS = ("energy", "span", "odd")


def _moments(intervals: DataFrame, grid: DataFrame, shared: Sequence[str], own: Sequence[str], width: int) -> DataFrame:
    """A row for each start and stop of both sides, in the order in which they count at one instant (rank): grid
    intervals that end, questions of intervals (side), grid intervals that begin. o_ and c_: sums of those that begin and end there."""
    power = F.col("power")
    number = F.coalesce(power, F.lit(0.0)).try_cast("decimal(19,6)")  # tells what is too large to sum
    span = micros(F.col("stop")) - micros(F.col("start"))
    sums = {
        # the power as it is: cut to some places, it would be a wrong energy; of whole intervals any rounding cancels
        "energy": F.when(number.isNotNull() & (power > 0), power * span).otherwise(0.0).cast("decimal(38,6)"),
        "span": span,
        "odd": (F.isnan(power) | number.isNull()).cast("long"),
    }
    known = [F.coalesce(sums[s], F.lit(0)).alias(s) for s in _SUMS]
    kinds = {"energy": "decimal(38,6)", "span": "bigint", "odd": "bigint"}
    zero = {s: F.lit(0).cast(kinds[s]) for s in _SUMS}
    here = [F.lit(None).cast(intervals.schema[c].dataType).alias(f"of_{c}") for c in own]

    def moment(at: str, rank: int, opens: bool) -> DataFrame:
        o = [(F.col(s).cast(kinds[s]) if opens else zero[s]).alias(f"o_{s}") for s in _SUMS]
        c = [(zero[s] if opens else F.col(s).cast(kinds[s])).alias(f"c_{s}") for s in _SUMS]
        return F.struct(F.col(at).alias("at"), F.lit(rank).alias("rank"), F.lit(None).cast("string").alias("side"), *o, *c)

    given = grid.filter("start < stop").withColumnRenamed("value", "power").select(*shared, "start", "stop", *known)
    given = given.select(*shared, F.explode(F.array(moment("start", 2, True), moment("stop", 0, False))).alias("m"), *here)
    none = [zero[s].alias(f"{x}_{s}") for x in "oc" for s in _SUMS]
    asked = [F.struct(F.col(at).alias("at"), F.lit(1).alias("rank"), F.lit(side).alias("side"), *none) for at, side in (("start", "lo"), ("stop", "hi"))]
    asking = intervals.select(*shared, F.explode(F.array(*asked)).alias("m"), *[F.col(c).alias(f"of_{c}") for c in own])
    rows = given.unionByName(asking).select(*shared, "m.*", *[f"of_{c}" for c in own])
    return rows.withColumn("bin", _bin(F.col("at"), width))


def import_energy(intervals: DataFrame, grid: DataFrame, keys: Sequence[str], width: int = BIN) -> DataFrame:
    """intervals with import_kwh: the grid import of the time that each takes.

    Of all grid intervals that an interval touches, whole, the energy of those that import is scaled by the interval's
    share of their hours; 0 without any, NaN if a power is no number.

    No pairs are made: what an interval touches is what begins before its stop less what ends by its start, so two
    running sums at its ends tell it, in decimals and whole microseconds, as a rest of rounding would be an import. The sums run within bins
    of width seconds, on top of the sums of the bins before, so that a busy grid meter's day is many groups.
    """
    shared = [k for k in keys if k in grid.columns]
    own = [*keys, "start", "stop"]
    names = [f"{x}_{s}" for x in "oc" for s in _SUMS]
    rows = _moments(intervals, grid, shared, own, width)
    bins = rows.groupBy(*shared, "bin").agg(*[F.sum(n).alias(n) for n in names])
    earlier = W.partitionBy(*shared).orderBy("bin").rowsBetween(W.unboundedPreceding, -1)
    base = bins.select(*shared, "bin", *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).cast(rows.schema[n].dataType).alias(n) for n in names])
    upto = W.partitionBy(*shared, "bin").orderBy(F.col("at").asc_nulls_first(), "rank").rowsBetween(W.unboundedPreceding, W.currentRow)
    running = rows.unionByName(base, allowMissingColumns=True).withColumns({n: F.sum(n).over(upto) for n in names}).filter("side is not null")
    end = lambda n, side: F.max(F.when(F.col("side") == side, F.col(n)))
    sums = running.groupBy(*[F.col(f"of_{c}").alias(c) for c in own]).agg(*[(end(f"o_{s}", "hi") - end(f"c_{s}", "lo")).alias(s) for s in _SUMS])
    joined = intervals.join(sums, own, "left")
    kwh = F.col("energy").cast("double") / 3.6e12
    scaled = F.when(F.col("odd") > 0, F.lit(float("nan"))).when(F.col("span") > 0, kwh * (micros(F.col("stop")) - micros(F.col("start"))) / F.col("span")).otherwise(0.0)
    return joined.withColumn("import_kwh", scaled).drop(*_SUMS)
