"""Daily sums of repaired counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.localtime import ZONE, day_stamp, local_day
from gridloom.operators.lookup import missing_days


def daily_sums(cleaned: DataFrame, total: str, zone: str = ZONE) -> DataFrame:
    """(day, entity_id, daily_sum): the highest value of each counter and day, and their sum as the entity total."""
    tops = cleaned.withColumn("day", local_day(F.col("time"), zone)).groupBy("day", "entity_id").agg(F.max("value").alias("top"))
    summed = tops.groupingSets([["day", "entity_id"], ["day"]], "day", "entity_id").agg(F.sum("top").alias("daily_sum"), F.grouping("entity_id").alias("whole"))
    return summed.select("day", F.when(F.col("whole") == 1, F.lit(total)).otherwise(F.col("entity_id")).alias("entity_id"), "daily_sum")


def daily_points(sums: DataFrame, measurement: str, version: str, zone: str = ZONE) -> DataFrame:
    """The sums as points, stamped at the end of their day."""
    return sums.select(
        F.lit(measurement).alias("measurement"), "entity_id", F.lit("daily_sum").alias("field"), F.lit(version).alias("version"), F.lit("").alias("scenario"), F.lit("kWh").alias("unit"), day_stamp(F.col("day"), zone).alias("time"), F.col("daily_sum").alias("value")
    )


def rejects(spine: DataFrame, cleaned: DataFrame, zone: str = ZONE) -> DataFrame:
    """(entity_id, day, status) of wanted days without data."""
    have = cleaned.select("entity_id", local_day(F.col("time"), zone).alias("day"))
    return missing_days(spine, have).select("entity_id", "day", F.lit("no_data").alias("status"))


def within_day(time: Column, zone: str = ZONE) -> Column:
    """Before the stamp of the daily results, which themselves are outside."""
    return time < day_stamp(local_day(time, zone), zone)
