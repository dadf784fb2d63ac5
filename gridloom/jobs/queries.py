"""Registered queries of the meter jobs over the given tables, and the same in SQL.

Times leave as TIMESTAMP_NTZ in UTC. January has no change of clocks, so the SQL takes local
time as one hour ahead.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions.localtime import hours_between, local_day, to_local
from gridloom.functions.versions import version_rank
from gridloom.jobs.pipeline import run_pipeline
from gridloom.operators import daily, intervals, lookup, repair, split
from gridloom.sources.events import LOST, PER_GRID, counters, event_points, grid_power
from gridloom.sources.exports import read_export
from gridloom.sources.ledger import read_ledger
from gridloom.sources.points import compact, delete_points, delete_range, last_write_wins, matching, points, read_points, select_points, whole_day, write_points
from gridloom.sources.scratch import new_path, stored

#: Look-up days: the last one counted as done, and the day of the run.
DONE, TODAY = date(2024, 1, 20), date(2024, 1, 28)
DAY = date(2024, 1, 15)


def _plain(instant: str | Column) -> Column:
    return F.col(instant).cast("timestamp_ntz") if isinstance(instant, str) else instant.cast("timestamp_ntz")


def _instant(text: str) -> Column:
    return F.lit(text).cast("timestamp")


def _spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(entity_id, day) of every meter and every local day from the first to the last of the table."""
    points = event_points(spark, sf_dir)
    ends = points.agg(local_day(F.min("time")).alias("lo"), local_day(F.max("time")).alias("hi"))
    days = ends.filter("lo is not null").select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("day"))
    return points.select("entity_id").distinct().crossJoin(F.broadcast(days))  # one row for each day


def daily_sum_with_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    sums = daily.daily_sums(event_points(spark, sf_dir), "total")
    return sums.select("day", "entity_id", F.round("daily_sum", 6).alias("daily_sum"))


def range_filter_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = select_points(event_points(spark, sf_dir), _instant("2024-01-10 06:00:00"), _instant("2024-01-20 18:30:00"), entities=["m0", "m4"], measurement="click")
    return found.select("entity_id", _plain("time").alias("time"), "value")


def whole_day_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whole_day(event_points(spark, sf_dir), F.lit(DAY))
    return found.select("entity_id", _plain("time").alias("time"), "value")


def max_point_per_entity_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = event_points(spark, sf_dir).withColumn("day", local_day(F.col("time")))
    return lookup.max_point(points, ["entity_id", "day"]).select("entity_id", "day", "value", _plain("time").alias("time"))


def first_last_data_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = event_points(spark, sf_dir)
    last = lookup.last_day(points.filter("time >= '1970-01-01'"), ["entity_id"])
    return last.crossJoin(F.broadcast(lookup.first_day(points))).select("entity_id", "first_day", "last_day")


def latest_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.latest_version(event_points(spark, sf_dir), ["entity_id"])


def available_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lookup.available_versions(event_points(spark, sf_dir), ["measurement"])
    return found.select("measurement", "version", version_rank(F.col("version")).getField("number").cast("long").alias("number"))


def unprocessed_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Meters are done up to different days: those with an odd number to DONE, the others not at all; they start with their own first day."""
    points = event_points(spark, sf_dir)
    done = points.filter((F.substring("entity_id", 2, 9).cast("int") % 2 == 1) & (F.to_date("time") <= F.lit(DONE)))
    ends = points.groupBy("entity_id").agg(F.to_date(F.min("time")).alias("first"))
    return lookup.unprocessed_days(ends, done, F.col("first"), TODAY)


def missing_entity_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days on which a meter has no purchase over 120."""
    buys = event_points(spark, sf_dir).filter("measurement = 'purchase' and value > 120").withColumn("day", local_day(F.col("time")))
    return lookup.missing_days(_spine(spark, sf_dir), buys)


def last_write_wins_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points written to whole minutes: later events replace earlier ones."""
    rounded = event_points(spark, sf_dir).withColumn("time", F.date_trunc("minute", "time"))
    kept = last_write_wins(rounded, [F.col("event_id")], ("measurement", "entity_id", "time"))
    return kept.select("measurement", "entity_id", _plain("time").alias("time"), "value")


def delete_by_predicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    hit = matching(_instant("2024-01-05 00:00:00"), _instant("2024-01-25 00:00:00"), measurement="error", version="v3")
    return event_points(spark, sf_dir).filter(~hit).select("event_id", "measurement", "version", _plain("time").alias("time"))


def to_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = event_points(spark, sf_dir).withColumn("day", local_day(F.col("time")))
    found = intervals.to_intervals(points, ["entity_id", "day"])
    return found.select("entity_id", "day", _plain("start").alias("start"), _plain("stop").alias("stop"), "value", F.round(hours_between(F.col("start"), F.col("stop")), 9).alias("hours"))


def _roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    meters = event_points(spark, sf_dir).select("entity_id").distinct()
    grid = F.concat(F.lit("g"), F.floor(F.substring("entity_id", 2, 9).cast("int") / PER_GRID).cast("long"))
    return meters.select(F.col("entity_id").alias("pump_entity"), grid.alias("grid_entity"), F.lit("total").alias("output_entity"))


def _split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.split_intervals(counters(spark, sf_dir), grid_power(spark, sf_dir), _roles(spark, sf_dir))


def interval_overlap_import(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _split(spark, sf_dir)
    return found.select("entity_id", _plain("start").alias("start"), _plain("stop").alias("stop"), F.round("import_kwh", 6).alias("import_kwh"))


def overlapping_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many grid intervals each meter's interval meets on a day, and their hours."""
    power = grid_power(spark, sf_dir).withColumn("day", local_day(F.col("time"))).withColumnRenamed("entity_id", "grid_entity")
    grid = intervals.to_intervals(power, ["grid_entity", "day"]).select("grid_entity", "day", "start", "stop")
    own = counters(spark, sf_dir).withColumn("day", local_day(F.col("time"))).join(_roles(spark, sf_dir).withColumnRenamed("pump_entity", "entity_id"), "entity_id")
    used = intervals.to_intervals(own, ["entity_id", "grid_entity", "day"]).select("entity_id", "grid_entity", "day", "start", "stop")
    met = intervals.overlaps(used, grid, ["grid_entity", "day"])
    sums = met.groupBy("entity_id", "start", "stop").agg(F.count("*").alias("n"), F.sum(hours_between(F.col("r_start"), F.col("r_stop"))).alias("hours"))
    return sums.select("entity_id", _plain("start").alias("start"), _plain("stop").alias("stop"), "n", F.round("hours", 6).alias("hours"))


def split_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intervals whose shares are below 0, as where a counter starts anew, or have no value."""
    return _split(spark, sf_dir).filter("status is not null").select("entity_id", _plain("start").alias("start"), _plain("stop").alias("stop"), "status")


def pv_grid_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _split(spark, sf_dir).filter("status is null").withColumnRenamed("stop", "time")
    long = split.long_form(found, ["entity_id", "time"], split.INTERVAL_FIELDS)
    return long.select("entity_id", _plain("time").alias("time"), "field", F.round("value", 6).alias("value"))


def pv_grid_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    spine = _spine(spark, sf_dir).withColumn("output_entity", F.lit("total"))
    days = split.split_days(_split(spark, sf_dir).filter("status is null"), spine)
    return days.select("day", "entity_id", F.round("daily_pv", 6).alias("daily_pv"), F.round("daily_grid_import", 6).alias("daily_grid_import"))


def assign_processing_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.assign_days(event_points(spark, sf_dir)).select("event_id", "day")


def detect_resets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = repair.detect_resets(repair.windows(counters(spark, sf_dir), _spine(spark, sf_dir)))
    return rows.groupBy("entity_id", "day").agg(F.max("n").alias("n"), F.max("first").alias("first_reset"), F.max("second").alias("second_reset"))


def zero_fill_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zeros for the days that have no points in their read window."""
    spine, rows = _spine(spark, sf_dir), counters(spark, sf_dir)
    empty = spine.join(repair.assign_days(rows).select("entity_id", "day").distinct(), ["entity_id", "day"], "left_anti")
    written, _ = repair.repair(rows, empty)
    return written.select("entity_id", "day", _plain("time").alias("time"), "value")


def repair_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How each day's resets are placed: the number of its rows, the mode, and why it is rejected."""
    rows = repair.clamp(repair.retime(repair.place_resets(repair.detect_resets(repair.windows(counters(spark, sf_dir), _spine(spark, sf_dir))))))
    return rows.groupBy("entity_id", "day").agg(F.max("n").alias("n"), F.first("mode").alias("mode"), F.first("status").alias("status"))


def monotone_clamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running maxima of each meter and local day, and whether any fall is too large."""
    points = event_points(spark, sf_dir)
    rows = repair.windows(points, _spine(spark, sf_dir)).filter(local_day(F.col("time")) == F.col("day"))
    rows = rows.withColumns({"status": F.lit(None).cast("string"), "mode": F.lit("keep"), "value": F.col("value") / 100})
    out = repair.clamp(rows, 2.5)
    return out.select("entity_id", _plain("time").alias("time"), F.round("value", 6).alias("value"), F.col("status").isNotNull().alias("rejected"))


def _repaired(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return repair.repair(counters(spark, sf_dir), _spine(spark, sf_dir))


def repair_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = repair.stored_points(_repaired(spark, sf_dir)[0])
    return kept.select("entity_id", _plain("time").alias("time"), F.round("value", 6).alias("value"))


def repair_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _repaired(spark, sf_dir)[1]


def pipeline_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repair, then daily sums and daily shares; the repaired points are computed once."""
    kept = stored(repair.stored_points(_repaired(spark, sf_dir)[0]).select("entity_id", "time", "value"), "repaired")
    sums = daily.daily_sums(kept, "total")
    shares = split.split_intervals(kept, grid_power(spark, sf_dir), _roles(spark, sf_dir)).filter("status is null")
    days = split.split_days(shares, _spine(spark, sf_dir).withColumn("output_entity", F.lit("total")))
    met = sums.join(days, ["day", "entity_id"])
    return met.select("day", "entity_id", *[F.round(c, 6).alias(c) for c in ("daily_sum", "daily_pv", "daily_grid_import")])


def _batch(spark: SparkSession, sf_dir: str, part: int) -> DataFrame:
    """The events with even numbers, or the others, as points of whole minutes."""
    minutes = event_points(spark, sf_dir).withColumns({"time": F.date_trunc("minute", "time"), "measurement": F.concat(F.lit("e:"), "measurement", F.lit("/x")), "version": F.when(F.col("measurement") == "click", "").otherwise("v1")})
    return minutes.filter(F.col("event_id") % 2 == part).withColumns({"scenario": F.lit(""), "unit": F.lit("")})


def _written(spark: SparkSession, sf_dir: str, name: str) -> str:
    """A table of the events of even numbers, then of the others, each batch over what is there."""
    path = new_path(spark, name)
    for part in (0, 1):
        write_points(_batch(spark, sf_dir, part), path, [F.col("event_id")])
    return path


def upsert_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches written one over the other, read back."""
    kept = read_points(spark, _written(spark, sf_dir, "upsert"))
    return kept.select("measurement", "entity_id", "version", _plain("time").alias("time"), "value", "day")


def delete_points_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, less the clicks without a version, and all errors of some days."""
    path = _written(spark, sf_dir, "delete")
    delete_points(spark, path, (F.col("measurement") == "e:click/x") & (F.col("version") == ""))
    delete_points(spark, path, matching(_instant("2024-01-05 00:00:00"), _instant("2024-01-25 00:00:00"), measurement="e:error/x"))
    return read_points(spark, path).select("measurement", "entity_id", "version", _plain("time").alias("time"), "value", "day")


def incremental_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All jobs up to DAY and again up to TODAY, for all meters and the mean power of each hour: what is in their table then."""
    given, made = new_path(spark, "raw"), new_path(spark, "made")
    views = spark.read.parquet(f"{sf_dir}/events.parquet").filter(F.col("event_type") == "view")
    power = views.groupBy(F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("time")).agg(((F.avg("value") - 50) * 100).alias("value"))
    raw = counters(spark, sf_dir, faults=False).select("entity_id", "time", "value").union(power.select(F.lit("grid"), "time", "value"))
    write_points(points(raw, measurement="raw"), given)
    meters = new_path(spark, "meters")
    event_points(spark, sf_dir).select("entity_id", F.lit("grid").alias("grid_entity")).distinct().write.parquet(meters)
    jobs = {
        "repair": {"version": "v1", "entities": {"table": meters}, "output_measurement": "clean"},
        "daily": {"version": "v1", "entities": {"table": meters}, "output_entity_id": "total", "output_measurement": "stat"},
        "split": {"version": "v1", "entities": {"table": meters}, "output_entity_id": "total", "output_measurement": "stat"},
    }
    for day in (DAY, TODAY):
        run_pipeline(spark, {"input": given, "output": made, "jobs": jobs}, day, "quarantine")
    return read_points(spark, made).select("measurement", "entity_id", "field", _plain("time").alias("time"), F.round("value", 6).alias("value"))


def days_after_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the ledger says of every day after a first repair, and after a second one for which the lost values have been
    written over the points without one; again: whether the second one did the day."""
    given, made, meters = new_path(spark, "raw"), new_path(spark, "made"), new_path(spark, "meters")
    write_points(points(counters(spark, sf_dir).select("entity_id", "time", "value"), measurement="raw"), given)
    event_points(spark, sf_dir).select("entity_id").distinct().write.parquet(meters)
    config = {"input": given, "output": made, "jobs": {"repair": {"version": "v1", "entities": {"table": meters}, "output_measurement": "clean"}}}
    run_pipeline(spark, config, TODAY, "quarantine")
    first = stored(read_ledger(spark, made), "first")
    found = counters(spark, sf_dir, lost=False).filter(F.col("event_id") % LOST == 0)
    write_points(points(found.select("entity_id", "time", "value"), measurement="raw"), given)
    run_pipeline(spark, config, TODAY, "quarantine")
    met = first.alias("a").join(read_ledger(spark, made).alias("b"), ["entity_id", "day"])
    return met.select("entity_id", "day", F.col("a.status").alias("before"), F.col("b.status").alias("after"), (F.col("b.run") > F.col("a.run")).alias("again"))


def delete_ranges_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches of points; ranges deleted between them and after them, some days of a meter written once more. Read before and after the ranges are worked into the points."""
    path = new_path(spark, "ranges")
    first, second = (_batch(spark, sf_dir, part) for part in (0, 1))
    write_points(first, path, [F.col("event_id")])
    delete_range(spark, path, datetime(2024, 1, 3), datetime(2024, 1, 9, 12), measurement="e:view/x")
    write_points(second, path, [F.col("event_id")])
    delete_range(spark, path, datetime(2024, 1, 12), datetime(2024, 1, 20, 7, 30), version="v1")
    delete_range(spark, path, datetime(2024, 1, 18), datetime(2024, 1, 26), entity_id="m0")
    again = first.filter((F.col("entity_id") == "m0") & (F.col("time") >= "2024-01-24"))
    write_points(again, path, [F.col("event_id")])
    read = lambda: read_points(spark, path).select("measurement", "entity_id", "version", _plain("time").alias("time"), "value", "day")
    before = stored(read().withColumn("state", F.lit("ranges")), "before")
    compact(spark, path)
    return before.unionByName(read().withColumn("state", F.lit("compacted")))


#: Days by which even and other events are moved, to the changes of clocks in March and October.
MOVED = (75, 285)


def _export(spark: SparkSession, sf_dir: str) -> dict[str, tuple[DataFrame, DataFrame]]:
    """Events around the changes of clocks, exported with local times as CSV (even events) and JSON (others), some lines of them bad; read back."""
    moved = F.when(F.col("event_id") % 2 == 0, F.lit(MOVED[0])).otherwise(F.lit(MOVED[1]))
    rows = event_points(spark, sf_dir).withColumn("time", F.col("time") + F.make_dt_interval(moved))
    at = F.when(F.col("event_id") % 89 == 0, "2024-13-45 00:00:00").otherwise(F.date_format(to_local(F.col("time")), "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    name = F.when(F.col("event_id") % 83 == 0, " ").otherwise(F.col("entity_id"))
    value = F.when(F.col("event_id") % 97 == 0, "n/a").otherwise(F.col("value").cast("string"))
    rows = rows.select("event_id", F.col("measurement").alias("measurement"), name.alias("entity_id"), at.alias("time"), value.alias("value"))
    shared = ("measurement", "entity_id", "time", "value")
    broken = F.col("event_id") % 79 == 0
    csv, json = new_path(spark, "csv"), new_path(spark, "json")
    line = F.when(broken, F.concat_ws(",", *shared, "event_id")).otherwise(F.concat_ws(",", *shared))
    rows.filter("event_id % 2 = 0").select(line.alias("value")).write.text(csv)
    line = F.to_json(F.struct(*shared))
    rows.filter("event_id % 2 = 1").select(F.when(broken, F.substring(line, 1, 20)).otherwise(line).alias("value")).write.text(json)
    return {"csv": read_export(spark, csv, "csv", shared, header=False), "json": read_export(spark, json, "json")}


def export_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The points of the exports, with the local day of each."""
    found = [good.withColumn("form", F.lit(form)) for form, (good, _) in _export(spark, sf_dir).items()]
    return found[0].unionByName(found[1]).select("form", "measurement", "entity_id", _plain("time").alias("time"), local_day(F.col("time")).alias("day"), "value")


def export_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many lines of each export are no points, by reason."""
    found = [bad.withColumn("form", F.lit(form)) for form, (_, bad) in _export(spark, sf_dir).items()]
    return found[0].unionByName(found[1]).groupBy("form", "reason").agg(F.count("*").alias("n"))


def zero_fill_clock_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zeros for all meters on days without points around the changes of clocks: of 23, 24 and 25 hours."""
    days = spark.createDataFrame([(date(2024, m, d) + timedelta(days=i),) for m, d in ((3, 30), (10, 26)) for i in range(3)], "day date")
    spine = event_points(spark, sf_dir).select("entity_id").distinct().crossJoin(F.broadcast(days))  # six rows
    written, _ = repair.repair(counters(spark, sf_dir), spine)
    return written.select("entity_id", "day", _plain("time").alias("time"), "value")


def latest_named_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest version of each meter where most points have none, a blank one is empty, and some meters have none at all."""
    points = event_points(spark, sf_dir)
    none = (F.col("event_id") % 7 != 3) | (F.substring("entity_id", 2, 9).cast("int") % 3 == 1)
    return lookup.latest_version(points.withColumn("version", F.when(none & (F.col("event_id") % 2 == 0), F.lit(None)).when(none, "").otherwise(F.col("version"))), ["entity_id"])


_QUERIES = [
    daily_sum_with_total,
    range_filter_points,
    whole_day_points,
    max_point_per_entity_day,
    first_last_data_day,
    latest_version,
    available_versions,
    unprocessed_days,
    missing_entity_days,
    last_write_wins_points,
    delete_by_predicate,
    to_intervals,
    interval_overlap_import,
    overlapping_intervals,
    split_rejects,
    pv_grid_interval,
    pv_grid_daily,
    assign_processing_days,
    detect_resets,
    zero_fill_days,
    monotone_clamp,
    repair_counters,
    repair_modes,
    repair_rejects,
    pipeline_totals,
    upsert_points,
    delete_points_roundtrip,
    incremental_run,
    days_after_rejects,
    delete_ranges_compacted,
    export_points,
    export_rejects,
    zero_fill_clock_changes,
    latest_named_version,
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q.__name__: q for q in _QUERIES}


_POINTS = """points AS (
    SELECT event_type AS measurement, 'm' || (user_id // 15) AS entity_id, 'v' || (event_id % 12 + 1) AS version, ts AS time, value, event_id,
           CAST(ts + INTERVAL 1 HOUR AS DATE) AS day
    FROM events)"""
_SPINE = """spine AS (
    SELECT entity_id, CAST(d AS DATE) AS day
    FROM (SELECT DISTINCT 'm' || (user_id // 15) AS entity_id FROM events),
         generate_series((SELECT date_trunc('day', min(ts) + INTERVAL 1 HOUR) FROM events), (SELECT date_trunc('day', max(ts) + INTERVAL 1 HOUR) FROM events), INTERVAL 1 DAY) AS g(d))"""
# plan(d) and begin(d): what goes wrong with a meter's day, and when its counter starts
_COUNTERS = """moments AS (
    SELECT event_id, ts AS time, ts + INTERVAL 1 HOUR AS local, user_id // 15 AS meter, CAST(round(value * 100) AS BIGINT) AS cents,
           unnest([-1, 0, 1]) AS off FROM events),
around AS (
    SELECT *, CAST(local AS DATE) + off AS d, (meter + dayofyear(CAST(local AS DATE) + off)) % 17 AS plan,
           CAST(CAST(local AS DATE) + off AS TIMESTAMP) - to_minutes(CAST([-40, 20, 0, 40, -20][(meter + dayofyear(CAST(local AS DATE) + off)) % 5 + 1] AS BIGINT)) AS begin
    FROM moments),
days_of AS (
    SELECT event_id, time, local, hour(local) AS h, meter, cents, max(d) FILTER (WHERE begin <= local OR off = -1) AS day, max(plan) FILTER (WHERE off = -1) AS before,
           max(plan) FILTER (WHERE off = 0) AS today, max(plan) FILTER (WHERE off = 1) AS after, max(begin) FILTER (WHERE off = 1) AS next_begin
    FROM around GROUP BY ALL),
started AS (SELECT *, CASE WHEN (meter + dayofyear(day)) % 17 = 0 THEN day - 1 ELSE day END AS counted FROM days_of),
counters AS (
    SELECT 'm' || meter AS entity_id, time, event_id, value FROM (
        SELECT *, CASE WHEN event_id % 997 <> 0 THEN
                floor(CAST(sum(cents) OVER (PARTITION BY meter, counted ORDER BY time, event_id) - cents AS DOUBLE) / 10) / 1000 - CASE WHEN event_id % 211 = 0 THEN 0.4 ELSE 0 END END AS value
        FROM started)
    WHERE NOT (today IN (1, 5) OR h >= 20 AND after IN (1, 2, 3) OR h < 4 AND before IN (1, 5) OR h < 2 AND today = 3 OR h >= 20 AND after = 4 AND local < next_begin))"""
# the read windows of all days, and the resets found in them
_RESETS = """assigned AS (
    SELECT * FROM (
        SELECT entity_id, time, value, unnest([l, CASE WHEN h >= 20 THEN l + 1 END, CASE WHEN h < 4 THEN l - 1 END]) AS day
        FROM (SELECT *, CAST(time + INTERVAL 1 HOUR AS DATE) AS l, hour(time + INTERVAL 1 HOUR) AS h FROM counters)) WHERE day IS NOT NULL),
r0 AS (
    SELECT s.entity_id, s.day, s.day - INTERVAL 1 HOUR AS ds, s.day + INTERVAL '22:59:59' AS de, a.time, a.value,
           CAST(row_number() OVER (PARTITION BY s.entity_id, s.day ORDER BY a.time, a.value NULLS FIRST) - 1 AS BIGINT) AS idx, count(a.time) OVER (PARTITION BY s.entity_id, s.day) AS n
    FROM spine s LEFT JOIN assigned a ON s.entity_id = a.entity_id AND s.day = a.day),
r1 AS (
    SELECT *, round(value, 3) AS v, abs(epoch_us(time) - epoch_us(ds)) <= abs(epoch_us(de) - epoch_us(time)) AS early,
           greatest(0, max(round(value, 3)) OVER (PARTITION BY entity_id, day ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) AS top
    FROM r0),
r2 AS (SELECT *, min(CASE WHEN v < top THEN idx END) OVER (PARTITION BY entity_id, day) AS fall FROM r1),
r3 AS (SELECT *, CASE WHEN max(CASE WHEN idx = fall AND early THEN 1 ELSE 0 END) OVER (PARTITION BY entity_id, day) = 1 THEN fall END AS one FROM r2),
r4 AS (SELECT *, max(CASE WHEN idx >= one THEN v END) OVER (PARTITION BY entity_id, day ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top2 FROM r3),
r5 AS (SELECT *, min(CASE WHEN idx > one AND NOT early AND v < top2 THEN idx END) OVER (PARTITION BY entity_id, day) AS fall2 FROM r4),
resets AS (SELECT entity_id, day, ds, de, idx, n, time, value, one AS first_reset, CASE WHEN one IS NULL THEN fall ELSE fall2 END - 1 AS second_reset FROM r5)"""
_REPAIR = """p0 AS (
    SELECT entity_id, day, ds, de, idx, n, time, value, first_reset, coalesce(second_reset, n - 1) AS two,
           max(CASE WHEN idx = 0 THEN time END) OVER g AS t0, max(CASE WHEN idx = 0 THEN value END) OVER g AS v0,
           count(*) FILTER (WHERE time IS NOT NULL AND value IS NULL) OVER g AS lost
    FROM resets WINDOW g AS (PARTITION BY entity_id, day)),
p1 AS (
    SELECT *, CASE WHEN first_reset IS NOT NULL THEN 'found' WHEN v0 = 0 AND t0 BETWEEN ds AND de THEN 'stay'
                   WHEN t0 >= ds AND v0 > 0 THEN 'insert' WHEN t0 < ds AND v0 = 0 THEN 'move' ELSE 'none' END AS how
    FROM p0),
p2 AS (
    SELECT entity_id, day, ds, de, idx, n, CASE WHEN how = 'move' AND idx = 0 THEN ds ELSE time END AS time, value, two, how, v0, lost,
           CASE WHEN how = 'insert' THEN -1 WHEN how IN ('stay', 'move') THEN 0 ELSE first_reset END AS one
    FROM p1
    UNION ALL
    SELECT entity_id, day, ds, de, -1, n, ds, 0.0, two, how, v0, lost, -1 FROM p1 WHERE how = 'insert' AND idx = 0),
p3 AS (
    SELECT *, max(CASE WHEN idx = one THEN time END) OVER g AS ft, max(CASE WHEN idx = two THEN time END) OVER g AS st,
           lead(time) OVER (PARTITION BY entity_id, day ORDER BY idx) AS after
    FROM p2 WINDOW g AS (PARTITION BY entity_id, day)),
p4 AS (
    SELECT *, CASE WHEN n = 0 OR (n = 1 AND how <> 'insert' AND ft = st AND ft BETWEEN ds AND de AND v0 = 0) THEN 'zero'
                   WHEN ft >= ds AND st <= de THEN 'keep' WHEN ft < ds AND st <= de THEN 'early' WHEN ft >= ds THEN 'late' ELSE 'both' END AS mode,
           CASE WHEN lost > 0 THEN 'null_value' WHEN n > 0 AND how = 'none' THEN 'no_first_reset' END AS bad
    FROM p3),
p5 AS (SELECT *, mode IN ('early', 'both') AND time < ds AND idx > one AS moved FROM p4 WHERE mode = 'zero' OR bad IS NOT NULL OR idx BETWEEN one AND two),
p6 AS (SELECT *, count(*) FILTER (WHERE moved) OVER (PARTITION BY entity_id, day) AS m FROM p5),
p7 AS (SELECT *, max(CASE WHEN idx = one + m THEN epoch_us(after) END) OVER (PARTITION BY entity_id, day) AS anchor FROM p6),
p8 AS (
    SELECT * EXCLUDE (time, bad), coalesce(bad, CASE WHEN mode IN ('early', 'both') AND m > 0 AND anchor IS NULL THEN 'no_anchor' END) AS bad,
           CASE WHEN moved THEN make_timestamp(CAST(round_even(epoch_us(ds) + (idx - one + 1) * ((anchor - epoch_us(ds)) / CAST(m + 1 AS DOUBLE)), 0) AS BIGINT))
                WHEN mode IN ('early', 'both') AND idx = one THEN ds ELSE time END AS time
    FROM p7),
p9 AS (SELECT *, mode IN ('late', 'both') AND time > de AS late FROM p8),
pa AS (SELECT *, min(CASE WHEN late THEN idx END) OVER (PARTITION BY entity_id, day) AS lo FROM p9),
pb AS (SELECT *, max(CASE WHEN idx = lo - 1 THEN epoch_us(time) END) OVER (PARTITION BY entity_id, day) AS base FROM pa),
pc AS (
    SELECT * EXCLUDE (time), CASE WHEN late AND idx = two THEN de
                WHEN late THEN make_timestamp(CAST(round_even(base + (idx - lo + 1) * ((epoch_us(de) - base) / CAST(nullif(two - lo + 1, 0) AS DOUBLE)), 0) AS BIGINT)) ELSE time END AS time
    FROM pb),
pd AS (SELECT *, greatest(0.0, max(value) OVER (PARTITION BY entity_id, day ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) AS before FROM pc),
pe AS (
    SELECT * EXCLUDE (value, bad), greatest(0.0, before, value) AS value,
           coalesce(bad, CASE WHEN mode <> 'zero' AND max(CASE WHEN before - value > 0.25 THEN 1 ELSE 0 END) OVER (PARTITION BY entity_id, day) = 1 THEN 'monotonicity' END) AS bad
    FROM pd),
rejects AS (SELECT entity_id, day, min(bad) AS status FROM pe WHERE bad IS NOT NULL GROUP BY entity_id, day),
pf AS (SELECT *, min(idx) OVER (PARTITION BY entity_id, day) AS i0, max(idx) OVER (PARTITION BY entity_id, day) AS i1 FROM pe WHERE bad IS NULL),
written AS (
    SELECT entity_id, day, idx AS seq, time, value FROM pf WHERE mode <> 'zero'
    UNION ALL SELECT entity_id, day, idx - 1, ds, 0.0 FROM pf WHERE mode <> 'zero' AND idx = i0 AND time <> ds
    UNION ALL SELECT entity_id, day, idx + 1, de, value FROM pf WHERE mode <> 'zero' AND idx = i1 AND time <> de
    UNION ALL SELECT entity_id, day, CAST(k AS BIGINT), CASE WHEN k = 24 THEN de ELSE ds + to_hours(k) END, 0.0 FROM pf, generate_series(0, 24) AS g(k) WHERE mode = 'zero' AND idx = 0),
repaired AS (
    SELECT entity_id, time, value
    FROM (SELECT *, row_number() OVER (PARTITION BY entity_id, time ORDER BY day DESC, seq DESC) AS nth FROM written) WHERE nth = 1)"""


_VIEWS = """SELECT grid, CAST(ts + INTERVAL 1 HOUR AS DATE) AS day, ts AS start, (value - 50) * 100 AS w,
               lead(ts) OVER (PARTITION BY grid, CAST(ts + INTERVAL 1 HOUR AS DATE) ORDER BY ts, value) AS stop
        FROM (SELECT user_id // 150 AS grid, ts, max(value) AS value FROM events WHERE event_type = 'view' GROUP BY ALL)"""


def _split_sql(pumps: str, power: str = _VIEWS, grid: str = "CAST(substr(u.entity_id, 2) AS INT) // 10") -> str:
    return f"""used AS (
    SELECT * FROM (
        SELECT entity_id, CAST(time + INTERVAL 1 HOUR AS DATE) AS day, time AS start, value,
               lead(time) OVER w AS stop, lead(value) OVER w AS next_value
        FROM {pumps} WINDOW w AS (PARTITION BY entity_id, CAST(time + INTERVAL 1 HOUR AS DATE) ORDER BY time, value NULLS FIRST)) WHERE stop IS NOT NULL),
power AS (
    SELECT * FROM (
        {power}) WHERE stop > start),
sums AS (
    SELECT u.entity_id, u.start, u.stop, sum(CASE WHEN w >= 0 THEN w * (epoch_us(p.stop) - epoch_us(p.start)) / 3.6e12 ELSE 0 END) AS energy,
           sum((epoch_us(p.stop) - epoch_us(p.start)) / 3.6e9) AS hours
    FROM used u JOIN power p ON {grid} = p.grid AND u.day = p.day AND p.start < u.stop AND p.stop > u.start GROUP BY ALL),
imported AS (
    SELECT u.*, u.next_value - u.value AS diff, CASE WHEN s.hours > 0 THEN energy * ((epoch_us(u.stop) - epoch_us(u.start)) / 3.6e9) / s.hours ELSE 0 END AS import_kwh
    FROM used u LEFT JOIN sums s USING (entity_id, start, stop)),
shares AS (
    SELECT * FROM (
        SELECT *, CASE WHEN import_kwh > 0 THEN greatest(0, diff - import_kwh) ELSE diff END AS pv_contribution,
               diff - CASE WHEN import_kwh > 0 THEN greatest(0, diff - import_kwh) ELSE diff END AS grid_import
        FROM imported) WHERE diff >= 0 AND import_kwh >= 0 AND grid_import >= 0),
split_days AS (
    SELECT s.day, CASE WHEN grouping(s.entity_id) = 1 THEN 'total' ELSE s.entity_id END AS entity_id,
           coalesce(sum(pv), 0) AS daily_pv, coalesce(sum(bought), 0) AS daily_grid_import
    FROM spine s LEFT JOIN (SELECT entity_id, day, sum(pv_contribution) AS pv, sum(grid_import) AS bought FROM shares GROUP BY ALL) x USING (entity_id, day)
    GROUP BY GROUPING SETS ((s.day, s.entity_id), (s.day)))"""


_BATCHES = """batches AS (
    SELECT 'e:' || event_type || '/x' AS measurement, 'm' || (user_id // 15) AS entity_id, CASE WHEN event_type = 'click' THEN '' ELSE 'v1' END AS version,
           date_trunc('minute', ts) AS time, value, CAST(date_trunc('minute', ts) + INTERVAL 1 HOUR AS DATE) AS day, event_id
    FROM events),
kept AS (SELECT * FROM batches QUALIFY row_number() OVER (PARTITION BY measurement, entity_id, version, time ORDER BY event_id % 2 DESC, event_id DESC) = 1)"""
_EVEN = (
    _COUNTERS.replace("CASE WHEN (meter + dayofyear(day)) % 17 = 0 THEN day - 1 ELSE day END", "day")
    .replace("CASE WHEN event_id % 997 <> 0 THEN", "").replace(" - CASE WHEN event_id % 211 = 0 THEN 0.4 ELSE 0 END END", "")
)
_EVEN = _EVEN[: _EVEN.index("    WHERE NOT (today")].rstrip() + ")"
# days from the first (in UTC) of the points to the one before the last run; a day with a reject has no sums and no shares
_RUN_SQL = f"""WITH {_EVEN},
spine AS (
    SELECT entity_id, CAST(d AS DATE) AS day FROM (SELECT DISTINCT 'm' || (user_id // 15) AS entity_id FROM events),
           generate_series((SELECT date_trunc('day', least(min(ts), min(date_trunc('hour', ts)) FILTER (WHERE event_type = 'view'))) FROM events), TIMESTAMP '2024-01-27', INTERVAL 1 DAY) AS g(d)),
{_RESETS}, {_REPAIR},
hours AS (SELECT date_trunc('hour', ts) AS start, (avg(value) - 50) * 100 AS w FROM events WHERE event_type = 'view' GROUP BY ALL),
{_split_sql("repaired", "SELECT 0 AS grid, CAST(start + INTERVAL 1 HOUR AS DATE) AS day, start, w, lead(start) OVER (PARTITION BY CAST(start + INTERVAL 1 HOUR AS DATE) ORDER BY start) AS stop FROM hours", "0")},
tops AS (SELECT CAST(time + INTERVAL 1 HOUR AS DATE) AS day, entity_id, max(value) AS top FROM repaired GROUP BY ALL),
whole AS (SELECT day FROM spine LEFT JOIN tops USING (entity_id, day) GROUP BY day HAVING count(top) = count(*)),
sums_of AS (SELECT day, CASE WHEN grouping(entity_id) = 1 THEN 'total' ELSE entity_id END AS entity_id, sum(top) AS value FROM tops SEMI JOIN whole USING (day) GROUP BY GROUPING SETS ((day, entity_id), (day))),
failed AS (SELECT DISTINCT day FROM imported ANTI JOIN shares USING (entity_id, start, stop)),
fine AS (SELECT * FROM shares WHERE day IN (SELECT day FROM spine) AND day NOT IN (SELECT day FROM failed)),
totals AS (
    SELECT s.day, CASE WHEN grouping(s.entity_id) = 1 THEN 'total' ELSE s.entity_id END AS entity_id, coalesce(sum(pv), 0) AS pv, coalesce(sum(bought), 0) AS bought
    FROM spine s LEFT JOIN (SELECT entity_id, day, sum(pv_contribution) AS pv, sum(grid_import) AS bought FROM fine GROUP BY ALL) x USING (entity_id, day)
    WHERE s.day NOT IN (SELECT day FROM failed) GROUP BY GROUPING SETS ((s.day, s.entity_id), (s.day))),
made AS (
    SELECT 'clean' AS measurement, entity_id, 'value' AS field, time, value FROM repaired
    UNION ALL SELECT 'stat', entity_id, 'daily_sum', day + INTERVAL '22:59:59.999999', value FROM sums_of
    UNION ALL SELECT 'stat', entity_id, 'pv_contribution', stop, pv_contribution FROM fine
    UNION ALL SELECT 'stat', entity_id, 'grid_import', stop, grid_import FROM fine
    UNION ALL SELECT 'stat', entity_id, 'daily_pv', day + INTERVAL '22:59:59.999999', pv FROM totals
    UNION ALL SELECT 'stat', entity_id, 'daily_grid_import', day + INTERVAL '22:59:59.999999', bought FROM totals)
SELECT measurement, entity_id, field, time, round(value, 6) AS value FROM made"""


_ALL_VALUES = _COUNTERS.replace("CASE WHEN event_id % 997 <> 0 THEN", "").replace("THEN 0.4 ELSE 0 END END AS value", "THEN 0.4 ELSE 0 END AS value")
# days from the first of the points to the one before the run
_RUN_SPINE = """spine AS (
    SELECT entity_id, CAST(d AS DATE) AS day FROM (SELECT DISTINCT 'm' || (user_id // 15) AS entity_id FROM events),
           generate_series((SELECT date_trunc('day', min(time)) FROM counters), TIMESTAMP '2024-01-27', INTERVAL 1 DAY) AS g(d))"""


def _statuses(counters: str) -> str:
    return f"(WITH {counters}, {_RUN_SPINE}, {_RESETS}, {_REPAIR} SELECT entity_id, day, coalesce(status, 'done') AS status FROM spine LEFT JOIN rejects USING (entity_id, day))"


_RANGES_SQL = f"""WITH {_BATCHES},
    one AS (SELECT * FROM batches WHERE event_id % 2 = 0 QUALIFY row_number() OVER (PARTITION BY measurement, entity_id, version, time ORDER BY event_id DESC) = 1),
    two AS (SELECT * FROM batches WHERE event_id % 2 = 1 QUALIFY row_number() OVER (PARTITION BY measurement, entity_id, version, time ORDER BY event_id DESC) = 1),
    met AS (
        SELECT *, 1 AS nth FROM one WHERE NOT (measurement = 'e:view/x' AND time >= '2024-01-03' AND time < '2024-01-09 12:00:00')
        UNION ALL SELECT *, 2 FROM two),
    both_ AS (SELECT * FROM met QUALIFY row_number() OVER (PARTITION BY measurement, entity_id, version, time ORDER BY nth DESC) = 1),
    left_ AS (
        SELECT *, 1 AS again FROM both_ WHERE NOT (version = 'v1' AND time >= '2024-01-12' AND time < '2024-01-20 07:30:00') AND NOT (entity_id = 'm0' AND time >= '2024-01-18' AND time < '2024-01-26')
        UNION ALL SELECT *, 1, 2 FROM one WHERE entity_id = 'm0' AND time >= '2024-01-24'),
    kept_ AS (SELECT measurement, entity_id, version, time, value, day FROM left_ QUALIFY row_number() OVER (PARTITION BY measurement, entity_id, version, time ORDER BY again DESC) = 1)
    SELECT *, unnest(['ranges', 'compacted']) AS state FROM kept_"""


# even events in March, others in October; in the hour that October repeats, the first pass is read as the second
_MOVED = """moved AS (
    SELECT *, CASE WHEN event_id % 79 = 0 THEN 'format' WHEN event_id % 83 = 0 THEN 'entity_id' WHEN event_id % 89 = 0 THEN 'time' WHEN event_id % 97 = 0 THEN 'value' END AS reason,
           CASE WHEN utc >= '2024-10-27 00:00:00' AND utc < '2024-10-27 01:00:00' THEN utc + INTERVAL 1 HOUR ELSE utc END AS time, CASE WHEN event_id % 2 = 0 THEN 'csv' ELSE 'json' END AS form
    FROM (SELECT *, ts + to_days(CASE WHEN event_id % 2 = 0 THEN 75 ELSE 285 END) AS utc FROM events))"""


def oracle_sql() -> dict[str, str]:
    bought = f"WITH {_POINTS}, {_SPINE} SELECT entity_id, day FROM spine ANTI JOIN (SELECT entity_id, day FROM points WHERE measurement = 'purchase' AND value > 120) USING (entity_id, day)"
    repaired = f"WITH {_SPINE}, {_COUNTERS}, {_RESETS}, {_REPAIR}"
    counted = f"WITH {_SPINE}, {_COUNTERS}, {_split_sql('counters')}"
    return {
        "daily_sum_with_total": f"""WITH {_POINTS}, tops AS (SELECT day, entity_id, max(value) AS top FROM points GROUP BY ALL)
            SELECT day, CASE WHEN grouping(entity_id) = 1 THEN 'total' ELSE entity_id END AS entity_id, round(sum(top), 6) AS daily_sum
            FROM tops GROUP BY GROUPING SETS ((day, entity_id), (day))""",
        "range_filter_points": f"""WITH {_POINTS} SELECT entity_id, time, value FROM points
            WHERE time >= '2024-01-10 06:00:00' AND time < '2024-01-20 18:30:00' AND entity_id IN ('m0', 'm4') AND measurement = 'click'""",
        "whole_day_points": f"WITH {_POINTS} SELECT entity_id, time, value FROM points WHERE time >= '2024-01-14 23:00:00' AND time < '2024-01-15 23:00:00'",
        "max_point_per_entity_day": f"""WITH {_POINTS} SELECT entity_id, day, value, time FROM points
            QUALIFY row_number() OVER (PARTITION BY entity_id, day ORDER BY value DESC, time) = 1""",
        "first_last_data_day": f"""WITH {_POINTS} SELECT entity_id, CAST((SELECT min(time) FROM points) AS DATE) AS first_day, CAST(max(time) AS DATE) AS last_day
            FROM points GROUP BY entity_id""",
        "latest_version": f"""WITH {_POINTS} SELECT entity_id, version FROM (SELECT DISTINCT entity_id, version FROM points)
            QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY CAST(regexp_extract(version, '([0-9]+)$', 1) AS BIGINT) DESC) = 1""",
        "available_versions": f"WITH {_POINTS} SELECT DISTINCT measurement, version, CAST(regexp_extract(version, '([0-9]+)$', 1) AS BIGINT) AS number FROM points WHERE version <> ''",
        "unprocessed_days": """WITH ends AS (
                SELECT 'm' || (user_id // 15) AS entity_id, coalesce(max(CAST(ts AS DATE)) FILTER (WHERE user_id // 15 % 2 = 1 AND CAST(ts AS DATE) <= DATE '2024-01-20'), min(CAST(ts AS DATE)) - 1) AS last
                FROM events GROUP BY 1)
            SELECT entity_id, CAST(d AS DATE) AS day FROM ends, generate_series(TIMESTAMP '2023-12-01', TIMESTAMP '2024-01-27', INTERVAL 1 DAY) AS g(d) WHERE d > last""",
        "missing_entity_days": bought,
        "last_write_wins_points": f"""WITH {_POINTS} SELECT measurement, entity_id, date_trunc('minute', time) AS time, value FROM points
            QUALIFY row_number() OVER (PARTITION BY measurement, entity_id, date_trunc('minute', time) ORDER BY event_id DESC) = 1""",
        "delete_by_predicate": f"""WITH {_POINTS} SELECT event_id, measurement, version, time FROM points
            WHERE NOT (measurement = 'error' AND version = 'v3' AND time >= '2024-01-05' AND time < '2024-01-25')""",
        "to_intervals": f"""WITH {_POINTS} SELECT entity_id, day, start, stop, value, round((epoch_us(stop) - epoch_us(start)) / 3.6e9, 9) AS hours
            FROM (SELECT entity_id, day, time AS start, value, lead(time) OVER (PARTITION BY entity_id, day ORDER BY time, value) AS stop FROM points) WHERE stop IS NOT NULL""",
        "interval_overlap_import": f"{counted} SELECT entity_id, start, stop, round(import_kwh, 6) AS import_kwh FROM imported",
        "overlapping_intervals": f"""{counted} SELECT u.entity_id, u.start, u.stop, count(*) AS n, round(sum((epoch_us(p.stop) - epoch_us(p.start)) / 3.6e9), 6) AS hours
            FROM used u JOIN power p ON CAST(substr(u.entity_id, 2) AS INT) // 10 = p.grid AND u.day = p.day AND p.start < u.stop AND p.stop > u.start GROUP BY ALL""",
        "split_rejects": f"{counted} SELECT entity_id, start, stop, 'negative_share' AS status FROM imported ANTI JOIN shares USING (entity_id, start, stop)",
        "pv_grid_interval": f"""{counted} SELECT entity_id, stop AS time, 'pv_contribution' AS field, round(pv_contribution, 6) AS value FROM shares
            UNION ALL SELECT entity_id, stop, 'grid_import', round(grid_import, 6) FROM shares""",
        "pv_grid_daily": f"{counted} SELECT day, entity_id, round(daily_pv, 6) AS daily_pv, round(daily_grid_import, 6) AS daily_grid_import FROM split_days",
        "assign_processing_days": """SELECT event_id, CAST(d AS DATE) AS day
            FROM events, generate_series(TIMESTAMP '2023-12-30', TIMESTAMP '2024-02-02', INTERVAL 1 DAY) AS g(d)
            WHERE ts >= d - INTERVAL 5 HOUR AND ts < d + INTERVAL 27 HOUR""",
        "detect_resets": f"WITH {_SPINE}, {_COUNTERS}, {_RESETS} SELECT entity_id, day, max(n) AS n, max(first_reset) AS first_reset, max(second_reset) AS second_reset FROM resets GROUP BY ALL",
        "zero_fill_days": f"""WITH {_SPINE}, {_COUNTERS}, {_RESETS}
            SELECT entity_id, day, CASE WHEN k = 24 THEN day + INTERVAL '22:59:59' ELSE day - INTERVAL 1 HOUR + to_hours(k) END AS time, CAST(0 AS DOUBLE) AS value
            FROM (SELECT entity_id, day FROM resets WHERE n = 0), generate_series(0, 24) AS g(k)""",
        "monotone_clamp": f"""WITH {_POINTS}, {_SPINE}, x AS (
                SELECT entity_id, day, time, value / 100 AS value, greatest(0, max(value / 100) OVER (PARTITION BY entity_id, day ORDER BY time, value ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) AS before
                FROM points SEMI JOIN spine USING (entity_id, day))
            SELECT entity_id, time, round(greatest(before, value), 6) AS value, max(before - value > 2.5) OVER (PARTITION BY entity_id, day) AS rejected FROM x""",
        "repair_counters": f"{repaired} SELECT entity_id, time, round(value, 6) AS value FROM repaired",
        "repair_modes": f"{repaired} SELECT entity_id, day, max(n) AS n, any_value(mode) AS mode, min(bad) AS status FROM pe GROUP BY ALL",
        "repair_rejects": f"{repaired} SELECT entity_id, day, status FROM rejects",
        "pipeline_totals": f"""{repaired}, {_split_sql("repaired")},
            tops AS (SELECT CAST(time + INTERVAL 1 HOUR AS DATE) AS day, entity_id, max(value) AS top FROM repaired GROUP BY ALL),
            day_sums AS (SELECT day, CASE WHEN grouping(entity_id) = 1 THEN 'total' ELSE entity_id END AS entity_id, sum(top) AS daily_sum
                FROM tops GROUP BY GROUPING SETS ((day, entity_id), (day)))
            SELECT day, entity_id, round(daily_sum, 6) AS daily_sum, round(daily_pv, 6) AS daily_pv, round(daily_grid_import, 6) AS daily_grid_import
            FROM day_sums JOIN split_days USING (day, entity_id)""",
        "upsert_points": f"WITH {_BATCHES} SELECT measurement, entity_id, version, time, value, day FROM kept",
        "delete_points_roundtrip": f"""WITH {_BATCHES} SELECT measurement, entity_id, version, time, value, day FROM kept
            WHERE NOT (measurement = 'e:click/x' AND version = '') AND NOT (measurement = 'e:error/x' AND time >= '2024-01-05' AND time < '2024-01-25')""",
        "incremental_run": f"{_RUN_SQL}",
        "days_after_rejects": f"""SELECT a.entity_id, a.day, a.status AS before, CASE WHEN a.status = 'done' THEN 'done' ELSE b.status END AS after, a.status <> 'done' AS again
            FROM {_statuses(_COUNTERS)} a JOIN {_statuses(_ALL_VALUES)} b USING (entity_id, day)""",
        "delete_ranges_compacted": _RANGES_SQL,
        "export_points": f"""WITH {_MOVED} SELECT form, event_type AS measurement, 'm' || (user_id // 15) AS entity_id, time, value,
                CAST(time + CASE WHEN time >= '2024-03-31 01:00:00' AND time < '2024-10-27 01:00:00' THEN INTERVAL 2 HOUR ELSE INTERVAL 1 HOUR END AS DATE) AS day
            FROM moved WHERE reason IS NULL""",
        "export_rejects": f"WITH {_MOVED} SELECT form, reason, count(*) AS n FROM moved WHERE reason IS NOT NULL GROUP BY ALL",
        "zero_fill_clock_changes": """WITH days AS (SELECT * FROM (VALUES
                (DATE '2024-03-30', 1, 1), (DATE '2024-03-31', 1, 2), (DATE '2024-04-01', 2, 2), (DATE '2024-10-26', 2, 2), (DATE '2024-10-27', 2, 1), (DATE '2024-10-28', 1, 1)) AS v(day, from_, to_)),
            ends AS (SELECT day, day - to_hours(from_) AS ds, day + INTERVAL '23:59:59' - to_hours(to_) AS de FROM days)
            SELECT entity_id, day, unnest(list_append(generate_series(ds, de, INTERVAL 1 HOUR), de)) AS time, CAST(0 AS DOUBLE) AS value
            FROM ends CROSS JOIN (SELECT DISTINCT 'm' || (user_id // 15) AS entity_id FROM events)""",
        "latest_named_version": f"""WITH {_POINTS} SELECT entity_id, version FROM (SELECT DISTINCT entity_id, version FROM points WHERE event_id % 7 = 3 AND CAST(substr(entity_id, 2) AS INT) % 3 <> 1)
            QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY CAST(regexp_extract(version, '([0-9]+)$', 1) AS BIGINT) DESC) = 1""",
    }
