"""Repair of daily counters whose reset at midnight comes early, late or not at all.

Everything is a window over (entity_id, day), so one exchange serves all steps. Positions
count from 0 in the day's read window; an inserted first row has position -1.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from gridloom.functions.localtime import ZONE, day_close, day_start, micros, to_local

#: Local hours before and after a day that are read with it, and the largest fall that is smoothed.
BEFORE, AFTER, TOLERANCE = 4, 4, 0.25


def _order() -> WindowSpec:
    return W.partitionBy("entity_id", "day").orderBy("idx")


def _group() -> WindowSpec:
    """All rows of a day; in order, so that Spark takes it in one step with other windows."""
    return _order().rowsBetween(W.unboundedPreceding, W.unboundedFollowing)


def _before() -> WindowSpec:
    return _order().rowsBetween(W.unboundedPreceding, -1)


def _upto() -> WindowSpec:
    return _order().rowsBetween(W.unboundedPreceding, W.currentRow)


def assign_days(points: DataFrame, zone: str = ZONE, before: int = BEFORE, after: int = AFTER) -> DataFrame:
    """points with day: a row for each local day whose read window holds the point."""
    rows = points.withColumn("_local", to_local(F.col("time"), zone)).withColumns({"day": F.to_date("_local"), "_hour": F.hour("_local")})
    day, following, previous = F.col("day"), F.date_add("day", 1), F.date_sub("day", 1)
    late, early = F.col("_hour") >= 24 - before, F.col("_hour") < after
    days = F.when(late & early, F.array(day, following, previous)).when(late, F.array(day, following)).when(early, F.array(day, previous)).otherwise(F.array(day))
    return rows.withColumn("day", F.explode(days)).drop("_local", "_hour")


def windows(points: DataFrame, spine: DataFrame, zone: str = ZONE, sparse: bool = False) -> DataFrame:
    """(entity_id, day, ds, de, idx, n, mark, time, value): the read window of every row of the spine
    (entity_id, day); one row with a null time where it is empty. mark: see fingerprints.

    sparse: the spine may hold few of the days that have points, so points of others are left out before they are sorted.
    """
    tie = [F.col(c) for c in ("measurement", "value") if c in points.columns]
    held = assign_days(points, zone).select("entity_id", "day", "time", "value", *[c for c in ("measurement",) if c in points.columns])
    if sparse:
        held = held.join(spine.select("entity_id", "day"), ["entity_id", "day"], "left_semi")
    rows = spine.select("entity_id", "day").join(held, ["entity_id", "day"], "left")
    order = W.partitionBy("entity_id", "day").orderBy("time", *tie)
    every = order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    n, mark = F.count("time").over(every), F.xxhash64(*[x.over(every) for x in _sums()])
    rows = rows.select("entity_id", "day", (F.row_number().over(order) - 1).alias("idx"), n.alias("n"), mark.alias("mark"), "time", "value")
    return rows.select("entity_id", "day", day_start(F.col("day"), zone).alias("ds"), day_close(F.col("day"), zone).alias("de"), "idx", "n", F.when(F.col("n") > 0, F.col("mark")).alias("mark"), "time", "value")


def _at(position: Column, value: Column) -> Column:
    """The group's value at a position."""
    return F.max(F.when(F.col("idx") == position, value)).over(_group())


def detect_resets(rows: DataFrame) -> DataFrame:
    """rows with first and second: the positions of the reset that opens the day and of the last value before the one that closes it; null if there is none.

    Values are compared rounded to 3 places. A fall nearer to the day's start opens it if none
    did; the first later fall nearer to its end closes it; other falls are passed over.
    """
    v = F.bround("value", 3)
    early = F.abs(micros(F.col("time")) - micros(F.col("ds"))) <= F.abs(micros(F.col("de")) - micros(F.col("time")))
    rows = rows.withColumns({"_v": v, "_early": early, "_top": F.greatest(F.lit(0.0), F.max(v).over(_before()))})
    fall = F.min(F.when(F.col("_v") < F.col("_top"), F.struct("idx", "_early"))).over(_group())
    rows = rows.withColumn("_fall", fall).withColumns({"_fall": F.col("_fall.idx"), "first": F.when(F.col("_fall._early"), F.col("_fall.idx"))})
    rows = rows.withColumn("_top", F.max(F.when(F.col("idx") >= F.col("first"), F.col("_v"))).over(_before()))
    later = (F.col("idx") > F.col("first")) & ~F.col("_early") & (F.col("_v") < F.col("_top"))
    rows = rows.withColumn("_next", F.min(F.when(later, F.col("idx"))).over(_group()))
    second = F.when(F.col("first").isNull(), F.col("_fall")).otherwise(F.col("_next")) - 1
    return rows.withColumn("second", second).drop("_v", "_early", "_top", "_fall", "_next")


def place_resets(rows: DataFrame) -> DataFrame:
    """rows with first and second filled where none was found, mode, and status where none can be placed.

    Without a closing reset the last row closes the day. Without an opening one the first row
    does if it is 0 in the day; a row at midnight is inserted before it if it is above 0; it is
    moved to midnight if it is 0 and before the day.
    """
    rows = rows.withColumn("second", F.coalesce("second", F.col("n").cast("int") - 1))
    nulls = F.sum(F.when(F.col("time").isNotNull() & F.col("value").isNull(), 1).otherwise(0)).over(_group())
    rows = rows.withColumns({"_t0": _at(F.lit(0), F.col("time")), "_v0": _at(F.lit(0), F.col("value")), "_nulls": nulls})
    inside = F.col("_t0").between(F.col("ds"), F.col("de"))
    how = (
        F.when(F.col("first").isNotNull(), "found")
        .when((F.col("_v0") == 0) & inside, "stay")
        .when((F.col("_t0") >= F.col("ds")) & (F.col("_v0") > 0), "insert")
        .when((F.col("_t0") < F.col("ds")) & (F.col("_v0") == 0), "move")
        .otherwise("none")
    )
    rows = rows.withColumn("_how", how)
    own = F.struct("idx", F.when((F.col("_how") == "move") & (F.col("idx") == 0), F.col("ds")).otherwise(F.col("time")).alias("time"), "value")
    added = F.struct(F.lit(-1).alias("idx"), F.col("ds").alias("time"), F.lit(0.0).alias("value"))
    both = F.when((F.col("_how") == "insert") & (F.col("idx") == 0), F.array(added, own)).otherwise(F.array(own))
    rows = rows.withColumn("_x", F.explode(both)).drop("idx", "time", "value").select("*", "_x.*").drop("_x")
    rows = rows.withColumn("first", F.when(F.col("_how") == "insert", -1).when(F.col("_how").isin("stay", "move"), 0).otherwise(F.col("first")))
    rows = rows.withColumns({"_ft": _at(F.col("first"), F.col("time")), "_st": _at(F.col("second"), F.col("time"))})
    lone = (F.col("n") == 1) & (F.col("_how") != "insert") & (F.col("_ft") == F.col("_st")) & F.col("_ft").between(F.col("ds"), F.col("de")) & (F.col("_v0") == 0)
    mode = (
        F.when((F.col("n") == 0) | lone, "zero")
        .when((F.col("_ft") >= F.col("ds")) & (F.col("_st") <= F.col("de")), "keep")
        .when((F.col("_ft") < F.col("ds")) & (F.col("_st") <= F.col("de")), "early")
        .when(F.col("_ft") >= F.col("ds"), "late")
        .otherwise("both")
    )
    status = F.when(F.col("_nulls") > 0, "null_value").when((F.col("n") > 0) & (F.col("_how") == "none"), "no_first_reset")
    return rows.withColumns({"mode": mode, "status": status}).drop("_t0", "_v0", "_how", "_nulls", "_ft", "_st")


def retime(rows: DataFrame) -> DataFrame:
    """The rows from first to second with times moved into the day.

    early: the opening row goes to midnight; m misplaced rows after it go to equal steps up to the next
    row, the last of them onto it. late: the closing row goes to the day's end, the misplaced
    rows before it to equal steps from the last row in place.
    """
    us = lambda c: micros(F.col(c))
    at = lambda value: F.timestamp_micros(F.bround(value).cast("long"))
    rows = rows.withColumn("_after", F.lead("time").over(_order())).filter((F.col("mode") == "zero") | F.col("idx").between(F.col("first"), F.col("second")) | F.col("status").isNotNull())
    moved = F.col("mode").isin("early", "both") & (F.col("time") < F.col("ds")) & (F.col("idx") > F.col("first"))
    rows = rows.withColumn("_m", F.count(F.when(moved, 1)).over(_group()))
    rows = rows.withColumn("_anchor", _at(F.col("first") + F.col("_m"), us("_after")))
    lost = F.col("mode").isin("early", "both") & (F.col("_m") > 0) & F.col("_anchor").isNull()
    step = (F.col("_anchor") - us("ds")) / (F.col("_m") + 1)
    shifted = F.when(moved, at(us("ds") + (F.col("idx") - F.col("first") + 1) * step)).when(F.col("mode").isin("early", "both") & (F.col("idx") == F.col("first")), F.col("ds")).otherwise(F.col("time"))
    rows = rows.withColumns({"status": F.coalesce("status", F.when(lost, "no_anchor")), "time": shifted})
    late = F.col("mode").isin("late", "both") & (F.col("time") > F.col("de"))
    rows = rows.withColumns({"_late": late, "_from": F.min(F.when(late, F.col("idx"))).over(_group())})
    rows = rows.withColumn("_base", _at(F.col("_from") - 1, us("time")))
    step = (us("de") - F.col("_base")) / F.nullif(F.col("second") - F.col("_from") + 1, F.lit(0))
    shifted = F.when(F.col("_late") & (F.col("idx") == F.col("second")), F.col("de")).when(F.col("_late"), at(F.col("_base") + (F.col("idx") - F.col("_from") + 1) * step)).otherwise(F.col("time"))
    return rows.withColumn("time", shifted).drop("_after", "_m", "_anchor", "_late", "_from", "_base")


def clamp(rows: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """rows whose values never fall, in the order of positions; a fall of more than tolerance sets status."""
    before = F.greatest(F.lit(0.0), F.max("value").over(_before()))
    rows = rows.withColumns({"_fell": before - F.col("value") > tolerance, "value": F.greatest(F.lit(0.0), F.max("value").over(_upto()))})
    fell = F.max(F.col("_fell").cast("int")).over(_group()) == 1
    return rows.withColumn("status", F.coalesce("status", F.when(fell & (F.col("mode") != "zero"), "monotonicity"))).drop("_fell")


def anchor(rows: DataFrame) -> DataFrame:
    """(entity_id, day, seq, time, value): rows with a first point at the day's start and a last one at its end.

    Days of mode zero get a 0 for each hour instead. seq is the order in which points are written.
    """
    point = lambda seq, time, value: F.struct(seq.cast("int").alias("seq"), time.alias("time"), value.cast("double").alias("value"))
    none = F.array().cast("array<struct<seq:int,time:timestamp,value:double>>")
    head = F.when((F.col("idx") == F.min("idx").over(_group())) & (F.col("time") != F.col("ds")), F.array(point(F.col("idx") - 1, F.col("ds"), F.lit(0.0)))).otherwise(none)
    tail = F.when((F.col("idx") == F.max("idx").over(_group())) & (F.col("time") != F.col("de")), F.array(point(F.col("idx") + 1, F.col("de"), F.col("value")))).otherwise(none)
    hours = F.sequence(F.col("ds"), F.col("de"), F.expr("INTERVAL 1 HOUR"))
    zeros = F.concat(F.transform(hours, lambda t, i: point(i, t, F.lit(0.0))), F.array(point(F.size(hours), F.col("de"), F.lit(0.0))))
    own = F.array(point(F.col("idx"), F.col("time"), F.col("value")))
    written = F.when(F.col("mode") == "zero", F.when(F.col("idx") == 0, zeros).otherwise(none)).otherwise(F.concat(head, own, tail))
    return rows.withColumn("_written", written).select("entity_id", "day", F.explode("_written").alias("x")).select("entity_id", "day", "x.*")


def repair(points: DataFrame, spine: DataFrame, zone: str = ZONE, tolerance: float = TOLERANCE, hold: Callable[[DataFrame], DataFrame] = lambda rows: rows, sparse: bool = False) -> tuple[DataFrame, DataFrame]:
    """(written, rejects) for each row of the spine (entity_id, day).

    written: (entity_id, day, seq, time, value), where a later (day, seq) with the same time
    replaces an earlier one. rejects: (entity_id, day, status), of which nothing is written.
    hold: may store the rows that both are made of, so that they are computed once. sparse: see windows.
    """
    rows = clamp(retime(place_resets(detect_resets(windows(points, spine, zone, sparse)))), tolerance)
    rows = hold(rows.withColumn("_opens", F.col("idx") == F.min("idx").over(_group()))).drop("_opens")
    bad = rows.filter("status is not null").groupBy("entity_id", "day").agg(F.first("status").alias("status"))
    return anchor(rows.filter("status is null")), bad


def opens_group() -> Column:
    """The first of the rows of each day."""
    return F.col("_opens")


def _sums() -> list[Column]:
    """What a fingerprint is made of: halves of hashes, so that sums of 2^31 of them stay in range."""
    return [F.count("*"), F.sum(F.shiftright(F.xxhash64(micros(F.col("time")), "value"), 32)), F.sum(F.shiftright(F.xxhash64("value", micros(F.col("time"))), 32))]


def fingerprints(points: DataFrame, zone: str = ZONE) -> DataFrame:
    """(entity_id, day, fingerprint) of what each day's read window holds, in any order; days without points are left out."""
    return assign_days(points, zone).groupBy("entity_id", "day").agg(F.xxhash64(*_sums()).alias("fingerprint"))


def stored_points(written: DataFrame) -> DataFrame:
    """Of the written points with equal entity and time the last one."""
    last = W.partitionBy("entity_id", "time").orderBy(F.col("day").desc(), F.col("seq").desc())
    return written.withColumn("_nth", F.row_number().over(last)).filter("_nth = 1").drop("_nth")
