"""Look-ups over points: highest point, first and last day, versions, days still to do."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.localtime import days_after
from gridloom.functions.versions import version_rank


def max_point(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, value, time) of the highest value; among equal values the earliest.

    On a counter that never falls this is also the last value of the range.
    """
    best = F.max(F.struct("value", (-F.unix_micros("time")).alias("age"))).alias("best")
    return df.filter("value is not null").groupBy(*keys).agg(best).select(*keys, "best.value", F.timestamp_micros(-F.col("best.age")).alias("time"))


def first_day(df: DataFrame) -> DataFrame:
    """One row: the UTC date of the earliest point, null without points."""
    return df.agg(F.to_date(F.min("time")).alias("first_day"))


def last_day(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The UTC date of the latest point, for each of keys."""
    return df.groupBy(*keys).agg(F.to_date(F.max("time")).alias("last_day"))


def available_versions(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return df.filter(F.coalesce("version", F.lit("")) != "").select(*keys, "version").distinct()


def latest_version(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The highest version, for each of keys; one row of null if there is none and no keys are given."""
    named = df.filter(F.coalesce("version", F.lit("")) != "")
    return named.groupBy(*keys).agg(F.max(version_rank(F.col("version"))).alias("top")).select(*keys, F.col("top.version").alias("version"))


def unprocessed_days(entities: DataFrame, done: DataFrame, first: Column, as_of: date, key: str = "entity_id") -> DataFrame:
    """(key, day): for each entity the days after its last one in done, or from first on, up to the day before as_of."""
    last = F.coalesce("last_day", F.date_sub(first, 1))
    days = days_after(last, F.date_sub(F.lit(as_of), 1))
    return entities.join(last_day(done, [key]), key, "left").select(key, F.explode(days).alias("day"))


def missing_days(spine: DataFrame, data: DataFrame, keys: Sequence[str] = ("entity_id", "day")) -> DataFrame:
    """Rows of the spine without data."""
    return spine.join(data.select(*keys).distinct(), list(keys), "left_anti")
