"""The ledger beside a table of results: what has become of each job's days.

A row tells that a job has done a day of an entity (status `done`), why it was rejected, or
that it is open again, as points of it were deleted. Rows are written together with the results,
by partitions of job and day, and days to do are found here, so no results are read for that.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.sources.days import day_list, within
from gridloom.sources.swap import exists

LEDGER = "entity_id string, status string, run long, measurement string, version string, fingerprint long, job string, day date"
PARTITIONS = ("job", "day")
DONE, OPEN = "done", "open"


def beside(output: str) -> str:
    return f"{output.rstrip('/')}_ledger"


def read_ledger(spark: SparkSession, output: str, job: str | None = None) -> DataFrame:
    """(entity_id, status, run, measurement, version, fingerprint, job, day) of the table of results output; empty if there is none."""
    path = beside(output)
    if not exists(spark, path):
        return spark.createDataFrame([], LEDGER)
    rows = spark.read.schema(LEDGER).parquet(path)
    return rows.filter(F.col("job") == job) if job else rows


def days_to_do(spine: DataFrame, ledger: DataFrame) -> DataFrame:
    """Rows (entity_id, day) of the spine that are not done, such as new and rejected ones; ledger: of one job."""
    done = ledger.filter(F.col("status") == DONE).select("entity_id", "day")
    return spine.join(done, ["entity_id", "day"], "left_anti")


def entered(spark: SparkSession, output: str, job: str, rows: DataFrame, runs: Sequence[tuple[date, date]]) -> tuple[DataFrame, str, tuple[str, ...]]:
    """The change of the ledger that rows of a job bring: they replace those of their entity and day. runs: their days, see day_list."""
    kept = read_ledger(spark, output, job).filter(within(runs, F.col("day")))
    kept = kept.join(rows.select("entity_id", "day"), ["entity_id", "day"], "left_anti")
    return kept.select(*rows.columns).unionByName(rows), beside(output), PARTITIONS


def reopened(spark: SparkSession, output: str, touched: DataFrame) -> list[tuple[DataFrame, str, tuple[str, ...]]]:
    """The change of the ledger of a table, if it has one, when points of (measurement, version, day) are deleted: those days
    and the ones beside them, as a day's points may lie in the next, are open. A null measurement or version is any."""
    if not exists(spark, beside(output)):
        return []
    around = touched.select("measurement", "version", F.explode(F.array(F.date_sub("day", 1), F.col("day"), F.date_add("day", 1))).alias("day")).distinct()
    rows = read_ledger(spark, output).filter(within(day_list(around), F.col("day"))).alias("l")
    hit = F.broadcast(around).alias("t")  # a row for each day and version
    same = lambda c: F.col(f"t.{c}").isNull() | (F.col(f"t.{c}") == F.col(f"l.{c}"))
    on = (F.col("l.day") == F.col("t.day")) & same("measurement") & same("version")
    again = rows.join(hit, on, "left_semi").withColumn("status", F.lit(OPEN))
    return [(rows.join(hit, on, "left_anti").unionByName(again), beside(output), PARTITIONS)]
