"""The table events read as points, counters and grid power."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridloom.functions.localtime import ZONE, to_local

#: Users that share a meter, and meters that share a grid meter, so their number grows with the table.
PER_METER, PER_GRID, VERSIONS = 15, 10, 12
#: Minutes by which a meter's day is shifted, one day after another.
SHIFTS = (-40, 20, 0, 40, -20)
#: One in so many events has a counter that is too low by so much, or no value.
FAULTS, TOO_LOW, LOST = 211, 0.4, 997
#: What goes wrong with a meter's day, by (meter + day of the year) % PLANS; other numbers: nothing.
PLANS = 17
NO_RESET, SILENT, NO_EVENING, NO_NIGHT, FROM_RESET, NO_DAY = range(6)


def _meter() -> Column:
    return F.floor(F.col("user_id") / PER_METER).cast("long")


def event_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a point; event_id is kept as the order of writing."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.select(
        F.col("event_type").alias("measurement"),
        F.concat(F.lit("m"), _meter()).alias("entity_id"),
        F.lit("value").alias("field"),
        F.concat(F.lit("v"), F.col("event_id") % VERSIONS + 1).alias("version"),
        F.col("ts").cast("timestamp").alias("time"),
        "value",
        "event_id",
    )


def _plan(day: Column) -> Column:
    return (F.col("meter") + F.dayofyear(day)) % PLANS


def _shift(day: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, SHIFTS)), ((F.col("meter") + F.dayofyear(day)) % len(SHIFTS) + 1).cast("int"))


def counters(spark: SparkSession, sf_dir: str, zone: str = ZONE, faults: bool = True, lost: bool = True) -> DataFrame:
    """(entity_id, time, value, event_id): for each meter a counter of its events that starts anew each day, early, late or not at all.

    A day's counter starts at local midnight less the day's shift. Days with NO_RESET go on counting. Points
    are missing around SILENT days with their evenings before and nights after, in evenings (from 20:00) before
    NO_EVENING days, to 2:00 of NO_NIGHT days too, from 20:00 to the reset before FROM_RESET days, and from midnight
    to 4:00 of the day after NO_DAY days. Without faults, days only start early or late; without lost, every point has its value. Hundredths are added as whole numbers, so the order of summing does not show.
    """
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", F.col("ts").cast("timestamp").alias("time"), _meter().alias("meter"), F.round(F.col("value") * 100).cast("long").alias("cents"))
    rows = events.withColumn("local", to_local(F.col("time"), zone)).withColumns({"date": F.to_date("local"), "hour": F.hour("local")})
    rows = rows.withColumns({"next": F.date_add("date", 1), "prev": F.date_sub("date", 1)})
    starts = lambda day: day.cast("timestamp") - F.make_dt_interval(mins=_shift(day))
    own = F.when(F.col("local") < starts(F.col("date")), F.col("prev")).when(F.col("local") >= starts(F.col("next")), F.col("next")).otherwise(F.col("date"))
    rows = rows.withColumn("day", own)
    if faults:
        rows = rows.withColumn("day", F.when(_plan(F.col("day")) == NO_RESET, F.date_sub("day", 1)).otherwise(F.col("day")))
    order = W.partitionBy("meter", "day").orderBy("time", "event_id").rowsBetween(W.unboundedPreceding, W.currentRow)
    value = F.floor((F.sum("cents").over(order) - F.col("cents")) / 10) / 1000
    if not faults:
        return rows.select(F.concat(F.lit("m"), F.col("meter")).alias("entity_id"), "time", value.alias("value"), "event_id")
    value = value - F.when(F.col("event_id") % FAULTS == 0, TOO_LOW).otherwise(0.0)
    rows = rows.withColumn("value", F.when(F.col("event_id") % LOST != 0, value) if lost else value)
    today, tomorrow, yesterday, evening = _plan(F.col("date")), _plan(F.col("next")), _plan(F.col("prev")), F.col("hour") >= 20
    away = (
        (today == SILENT)
        | (evening & tomorrow.isin(SILENT, NO_EVENING, NO_NIGHT))
        | ((F.col("hour") < 4) & yesterday.isin(SILENT, NO_DAY))
        | ((F.col("hour") < 2) & (today == NO_NIGHT))
        | (evening & (tomorrow == FROM_RESET) & (F.col("local") < starts(F.col("next"))))
        | (today == NO_DAY)
    )
    return rows.filter(~away).select(F.concat(F.lit("m"), F.col("meter")).alias("entity_id"), "time", "value", "event_id")


def grid_power(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(entity_id, time, value): the power of each grid meter, import positive."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").filter(F.col("event_type") == "view")
    grid = F.concat(F.lit("g"), F.floor(F.col("user_id") / (PER_METER * PER_GRID)).cast("long"))
    return events.groupBy(grid.alias("entity_id"), F.col("ts").cast("timestamp").alias("time")).agg(((F.max("value") - 50) * 100).alias("value"))
