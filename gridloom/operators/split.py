"""Split of consumption into the shares from the roof and from the grid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.localtime import ZONE, day_stamp, local_day
from gridloom.operators.intervals import BIN, import_energy, to_intervals

INTERVAL_FIELDS = ("pv_contribution", "grid_import")
DAILY_FIELDS = ("daily_pv", "daily_grid_import")


def shares(used: Column, imported: Column) -> tuple[Column, Column]:
    """(pv, grid) of a consumption, given the import in its time."""
    pv = F.when(imported > 0, F.greatest(F.lit(0.0), used - imported)).otherwise(used)
    return pv, used - pv


def split_intervals(pumps: DataFrame, grid: DataFrame, roles: DataFrame, zone: str = ZONE, width: int = BIN) -> DataFrame:
    """(entity_id, output_entity, day, start, stop, used, import_kwh, pv_contribution, grid_import, status).

    pumps: points of repaired counters; grid: points of power, import positive; roles: (pump_entity,
    grid_entity, output_entity). Intervals lie within one local day.
    """
    day = local_day(F.col("time"), zone)
    inside = F.col("time") < day_stamp(day, zone)
    kept = lambda df: df.filter(inside).select("entity_id", day.alias("day"), "time", "value")
    own = roles.select(F.col("pump_entity").alias("entity_id"), "grid_entity", "output_entity")
    used = to_intervals(kept(pumps).join(own, "entity_id"), ["entity_id", "grid_entity", "output_entity", "day"])
    power = to_intervals(kept(grid).withColumnRenamed("entity_id", "grid_entity"), ["grid_entity", "day"])
    met = import_energy(used, power, ["entity_id", "grid_entity", "output_entity", "day"], width)
    met = met.withColumn("used", F.col("next_value") - F.col("value"))
    pv, bought = shares(F.col("used"), F.col("import_kwh"))
    bad = (F.col("used") < 0) | (F.col("import_kwh") < 0) | F.isnan("import_kwh") | F.isnan("used") | F.col("used").isNull() | (pv < 0) | (bought < 0)
    return met.select("entity_id", "output_entity", "day", "start", "stop", "used", "import_kwh", pv.alias("pv_contribution"), bought.alias("grid_import"), F.when(bad, F.lit("negative_share")).alias("status"))


def split_days(intervals: DataFrame, spine: DataFrame) -> DataFrame:
    """(day, entity_id, daily_pv, daily_grid_import) for each pump and day of the spine (entity_id,
    output_entity, day) and, as output_entity, for all pumps together; 0 without intervals."""
    sums = intervals.groupBy("entity_id", "day").agg(F.sum("pv_contribution").alias("pv"), F.sum("grid_import").alias("bought"))
    every = spine.join(sums, ["entity_id", "day"], "left")
    sets = every.groupingSets([["day", "output_entity", "entity_id"], ["day", "output_entity"]], "day", "output_entity", "entity_id")
    return sets.agg(F.coalesce(F.sum("pv"), F.lit(0.0)).alias("daily_pv"), F.coalesce(F.sum("bought"), F.lit(0.0)).alias("daily_grid_import"), F.grouping("entity_id").alias("whole")).select(
        "day", F.when(F.col("whole") == 1, F.col("output_entity")).otherwise(F.col("entity_id")).alias("entity_id"), "daily_pv", "daily_grid_import"
    )


def long_form(df: DataFrame, keys: list[str], fields: tuple[str, ...]) -> DataFrame:
    """A row (keys, field, value) for each of the fields."""
    return df.unpivot(keys, list(fields), "field", "value")


def wide_form(df: DataFrame, keys: list[str], fields: tuple[str, ...]) -> DataFrame:
    """A row (keys, *fields), the inverse of long_form."""
    return df.groupBy(*keys).pivot("field", list(fields)).agg(F.first("value"))


def split_points(intervals: DataFrame, days: DataFrame, measurement: str, version: str, zone: str = ZONE) -> DataFrame:
    """Both results as points: shares stamped at the end of their interval, sums at the end of the day."""
    a = long_form(intervals.select("entity_id", F.col("stop").alias("time"), *INTERVAL_FIELDS), ["entity_id", "time"], INTERVAL_FIELDS)
    b = long_form(days.select("entity_id", day_stamp(F.col("day"), zone).alias("time"), *DAILY_FIELDS), ["entity_id", "time"], DAILY_FIELDS)
    return a.unionByName(b).select(F.lit(measurement).alias("measurement"), "entity_id", "field", F.lit(version).alias("version"), F.lit("").alias("scenario"), F.lit("kWh").alias("unit"), "time", "value")
