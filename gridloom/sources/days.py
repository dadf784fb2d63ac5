"""Sets of days as filters that file listings understand."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Ranges of days that a filter spells out, at most.
RANGES = 64


def day_ranges(days: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, lo, hi): the runs of consecutive days in the column day, for each of by."""
    place = F.row_number().over(W.partitionBy(*by).orderBy("day"))
    runs = days.select(*by, "day").distinct().withColumn("_run", F.date_sub(F.col("day"), place))
    return runs.groupBy(*by, "_run").agg(F.min("day").alias("lo"), F.max("day").alias("hi")).drop("_run")


def day_list(days: DataFrame) -> list[tuple[date, date]]:
    """The runs of the days as (first, last); one from the first to the last day if there are more than RANGES."""
    runs = day_ranges(days)
    found = runs.limit(RANGES + 1).collect()
    if len(found) > RANGES:
        found = runs.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).collect()
    return sorted((r["lo"], r["hi"]) for r in found)


def within(runs: Sequence[tuple[date, date]], column: Column, before: int = 0, after: int = 0) -> Column:
    """A filter with literals, so that files of other days are left alone: the column lies in one of the runs or so many days around."""
    days = lambda n: timedelta(days=n)
    return reduce(lambda a, b: a | b, [column.between(F.lit(lo - days(before)), F.lit(hi + days(after))) for lo, hi in runs], F.lit(False))
