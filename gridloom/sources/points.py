"""Tables of points: schema, filters, reading, upserts and deletes."""

from __future__ import annotations

import time
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.functions.localtime import ZONE, day_start, local_day, next_day_start
from gridloom.sources.days import RANGES, day_ranges
from gridloom.sources.ledger import reopened
from gridloom.sources.scratch import stored
from gridloom.sources.swap import exists, replace_together

TAGS = ("version", "scenario", "unit")
#: Two points with one key are the same point; the later write stays.
KEY = ("measurement", "entity_id", "version", "scenario", "unit", "field", "time")
POINTS = T.StructType(
    [
        *[T.StructField(n, T.StringType(), False) for n in ("measurement", "entity_id", "field", *TAGS)],
        T.StructField("time", T.TimestampType(), False),
        T.StructField("value", T.DoubleType()),
    ]
)
PARTITIONS = ("measurement", "version", "day")
#: As stored: points, the sequence number of their write, and their local date.
STORED = T.StructType([*POINTS.fields, T.StructField("written", T.LongType()), T.StructField("day", T.DateType())])
#: Columns of the tables beside one of points: what versions it has, and what is deleted from it.
VERSIONS = "entity_id string, version string, measurement string"
DELETED = "measurement string, entity_id string, version string, start timestamp, stop timestamp, sequence long"
#: Deleted ranges that readers apply, at most.
MOST_DELETED = 256
#: Fixed value: the measurement of points that come without one.
MEASUREMENT = "home_assistant"


def points(df: DataFrame, now: datetime | None = None, measurement: str = MEASUREMENT) -> DataFrame:
    """df in the schema of points: absent tags are empty, values double, an absent time is now."""
    have = set(df.columns)
    columns = {t: F.coalesce(F.col(t), F.lit("")) if t in have else F.lit("") for t in TAGS}
    columns["measurement"] = F.col("measurement") if "measurement" in have else F.lit(measurement)
    columns["field"] = F.col("field") if "field" in have else F.lit("value")
    default = F.lit(now) if now else F.current_timestamp()
    columns["time"] = F.coalesce(F.col("time").cast("timestamp"), default) if "time" in have else default
    columns["entity_id"] = F.col("entity_id")
    columns["value"] = F.col("value").cast("double")
    return df.select([columns[f.name].alias(f.name) for f in POINTS.fields])


def select_points(
    df: DataFrame,
    start: Column | None = None,
    stop: Column | None = None,
    entities: Sequence[str] | DataFrame | None = None,
    field: str | None = "value",
    measurement: str | None = None,
    version: str | None = None,
    scenario: str | None = None,
) -> DataFrame:
    """Points of [start, stop) with the tags that are given; an empty or absent tag filters nothing.

    entities: a few names, or a table with the column entity_id. A table is joined, so the plan doesn't grow
    with it: Spark sends it to all tasks if its size allows that, else both sides are shuffled, the
    points through a Bloom filter of the names.
    """
    wanted = {"field": field, "measurement": measurement, "version": version, "scenario": scenario}
    for name, value in wanted.items():
        if value:
            df = df.filter(F.col(name) == value)
    if isinstance(entities, DataFrame):
        names = entities.select(F.col("entity_id").alias("_name")).distinct()
        df = df.join(names, F.col("entity_id") == F.col("_name"), "left_semi")
    elif entities:
        df = df.filter(F.col("entity_id").isin(list(entities)))
    if start is not None:
        df = df.filter(F.col("time") >= start)
    if stop is not None:
        df = df.filter(F.col("time") < stop)
    return df


def whole_day(df: DataFrame, day: Column, zone: str = ZONE) -> DataFrame:
    """Points of one local day."""
    return df.filter((F.col("time") >= day_start(day, zone)) & (F.col("time") < next_day_start(day, zone)))


def valid_entities(df: DataFrame) -> DataFrame:
    return df.filter(F.trim("entity_id") != "")


def last_write_wins(df: DataFrame, order: Sequence[Column], key: Sequence[str] = KEY) -> DataFrame:
    """Of the rows with one key the last in order."""
    parts = sorted(key, key=lambda c: c != "time")  # rows are sorted by them, and times tell most apart
    newest = W.partitionBy(*parts).orderBy(*[o.desc() for o in order])
    return df.withColumn("_nth", F.row_number().over(newest)).filter("_nth = 1").drop("_nth")


def _parts(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a table: points, and rows without an entity in partitions that have lost all."""
    table = spark.read.schema(STORED).parquet(path)
    # an empty partition value is read as null
    table = table.withColumns({c: F.coalesce(c, F.lit("")) for c in ("measurement", "version")})
    gone = f"{path}_deleted"
    if not exists(spark, gone):
        return table
    # MOST_DELETED rows at most, see delete_range
    gone = F.broadcast(spark.read.schema(DELETED).parquet(gone)).alias("g")
    same = lambda c: F.col(f"g.{c}").isNull() | (F.col(f"g.{c}") == F.col(f"p.{c}"))
    hit = same("measurement") & same("entity_id") & same("version") & (F.col("p.time") >= F.col("g.start")) & (F.col("p.time") < F.col("g.stop"))
    return table.alias("p").join(gone, hit & (F.coalesce("p.written", F.lit(0)) < F.col("g.sequence")), "left_anti")


def read_points(spark: SparkSession, path: str) -> DataFrame:
    """A table written by write_points; day is the local date, a partition column."""
    return _parts(spark, path).filter("entity_id is not null").drop("written")


def in_partitions(df: DataFrame, touched: DataFrame) -> DataFrame:
    """Rows of df in the partitions (measurement, version, day) of touched.

    The partitions become literals on the partition columns, so that only their files are opened; with more than RANGES
    runs of days, the literals hold a range around them, and a join does the rest.
    """
    by = ["measurement", "version"]
    runs = day_ranges(touched, by)
    found = runs.limit(RANGES + 1).collect()
    exact = len(found) <= RANGES
    if not exact:
        found = runs.groupBy(*by).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).limit(RANGES + 1).collect()
        if len(found) > RANGES:
            found = runs.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).collect()
    hit = F.lit(False)
    for r in found:
        part = F.col("day").between(F.lit(r["lo"]), F.lit(r["hi"]))
        for c in by if "version" in r else ():
            part = part & (F.col(c) == r[c])
        hit = hit | part
    df = df.filter(hit)
    return df if exact else df.join(touched, list(PARTITIONS), "left_semi")


def merged_points(df: DataFrame, path: str, order: Sequence[Column] = (), zone: str = ZONE) -> list[tuple[DataFrame, str, tuple[str, ...]]]:
    """The upsert of df into a table as changes for replace_together: the touched partitions with the new points over
    the kept ones, and the versions that the table has not had before. df is computed once, and stored."""
    spark = df.sparkSession
    new = last_write_wins(df, order or [F.col("value")])
    stamp = F.lit(time.time_ns() // 1000).alias("written")
    new = stored(new.select(*POINTS.names, stamp, local_day(F.col("time"), zone).alias("day"), F.lit(1).alias("_write")), "points")
    versions = [_new_versions(new, path)]
    if exists(spark, path):
        touched = new.select(*PARTITIONS).distinct()
        kept = in_partitions(_parts(spark, path), touched).filter("entity_id is not null").withColumn("_write", F.lit(0))
        new = last_write_wins(kept.select(*STORED.names, "_write").unionByName(new), [F.col("_write")])
    return [(new.drop("_write"), path, PARTITIONS), *[v for v in versions if v]]


def write_points(df: DataFrame, path: str, order: Sequence[Column] = (), zone: str = ZONE) -> None:
    """Upsert: new points replace kept ones with their key; only touched partitions are read and rewritten.

    order tells which of several new points with one key came last. df is computed once. A large
    partition is written by several tasks.
    """
    replace_together(df.sparkSession, merged_points(df, path, order, zone))


def _new_versions(new: DataFrame, path: str) -> tuple[DataFrame, str, tuple[str, ...]] | None:
    """The change of the table of versions that new points bring, if any: whole measurements, kept and new."""
    spark, beside = new.sparkSession, f"{path}_versions"
    found = new.select("entity_id", "version", "measurement").distinct()
    if not exists(spark, beside):
        return found, beside, ("measurement",)
    have = read_versions(spark, path)
    more = found.join(have, found.columns, "left_anti")
    if more.isEmpty():
        return None
    kept = have.join(F.broadcast(more.select("measurement").distinct()), "measurement", "left_semi")  # a row for each measurement
    return kept.select(*more.columns).unionByName(more), beside, ("measurement",)


def read_versions(spark: SparkSession, path: str) -> DataFrame:
    """(entity_id, version, measurement) that a table of points has, from the table beside it: no point is read.

    Deletes leave it as it is, so a version all of whose points are deleted stays until compact().
    """
    beside = f"{path}_versions"
    if not exists(spark, beside):
        return spark.createDataFrame([], VERSIONS)
    return spark.read.schema(VERSIONS).parquet(beside).filter("entity_id is not null").withColumn("measurement", F.coalesce("measurement", F.lit("")))


def matching(start: Column, stop: Column, measurement: str | None = None, entity_id: str | None = None, version: str | None = None) -> Column:
    """The predicate of a delete: the tags that are given, in [start, stop)."""
    hit = (F.col("time") >= start) & (F.col("time") < stop)
    for name, value in {"measurement": measurement, "entity_id": entity_id, "version": version}.items():
        if value:
            hit = hit & (F.col(name) == value)
    return hit


def _without(spark: SparkSession, path: str, touched: DataFrame, hit: Column) -> tuple[DataFrame, str, tuple[str, ...]]:
    """The touched partitions less what hit holds for, and a row without an entity for each, so that one that has lost all is replaced, too."""
    table = _parts(spark, path).filter("entity_id is not null")
    left = in_partitions(table, touched).filter(~F.coalesce(hit, F.lit(False))).select(*STORED.names)
    nothing = touched.select(*[F.col(c) if c in PARTITIONS else F.lit(None).cast(STORED[c].dataType).alias(c) for c in STORED.names])
    return left.unionByName(nothing), path, PARTITIONS


def delete_points(spark: SparkSession, path: str, hit: Column) -> None:
    """Delete points for which hit holds; other partitions than theirs stay untouched.

    The touched partitions are replaced by what stays of them. Each gets a row without an entity,
    too, which readers leave out. Days that a job wrote there are open again (see sources.ledger).
    """
    touched = stored(read_points(spark, path).filter(hit).select(*PARTITIONS).distinct(), "touched")
    replace_together(spark, [_without(spark, path, touched, hit), *reopened(spark, path, touched)])


def delete_range(spark: SparkSession, path: str, start: datetime, stop: datetime, measurement: str | None = None, entity_id: str | None = None, version: str | None = None, zone: str = ZONE) -> None:
    """Delete what was written so far in [start, stop) with the tags that are given, without touching any points.

    The range is kept in the table <path>_deleted, and readers leave out what it holds. Once there are
    MOST_DELETED ranges, they are worked into the points first.
    """
    beside = f"{path}_deleted"
    known = spark.read.schema(DELETED).parquet(beside) if exists(spark, beside) else None
    if known is not None and known.count() >= MOST_DELETED:
        compact(spark, path)
        known = None
    row = [(measurement or None, entity_id or None, version or None, start, stop, time.time_ns() // 1000)]
    new = spark.createDataFrame(row, DELETED)
    lo, hi = new.select(local_day(F.col("start"), zone), local_day(F.col("stop"), zone)).first()
    days = spark.range((hi - lo).days + 1).select(F.date_add(F.lit(lo), F.col("id").cast("int")).alias("day"), F.lit(measurement).cast("string").alias("measurement"), F.lit(version).cast("string").alias("version"))
    whole = (new if known is None else known.unionByName(new)).coalesce(1)
    replace_together(spark, [(whole, beside, ()), *reopened(spark, path, days)])


def compact(spark: SparkSession, path: str) -> None:
    """Work the deleted ranges into the points, and leave out versions that have no points."""
    beside = f"{path}_deleted"
    if exists(spark, beside):
        ranges = stored(spark.read.schema(DELETED).parquet(beside), "ranges")
        plain = spark.read.schema(STORED).parquet(path).withColumns({c: F.coalesce(c, F.lit("")) for c in ("measurement", "version")})
        zoned = F.broadcast(ranges.select("measurement", "version", local_day(F.col("start")).alias("lo"), local_day(F.col("stop")).alias("hi"))).alias("g")
        same = lambda c: F.col(f"g.{c}").isNull() | (F.col(f"g.{c}") == F.col(f"p.{c}"))
        near = F.col("p.day").between(F.date_sub("g.lo", 1), F.date_add("g.hi", 1))
        touched = stored(plain.select(*PARTITIONS).distinct().alias("p").join(zoned, same("measurement") & same("version") & near, "left_semi"), "touched")
        none = spark.createDataFrame([], DELETED).coalesce(1)
        replace_together(spark, [_without(spark, path, touched, F.lit(False)), (none, beside, ())])
    have = read_points(spark, path).select("entity_id", "version", "measurement").distinct()
    nothing = read_versions(spark, path).select(F.lit(None).cast("string").alias("entity_id"), F.lit(None).cast("string").alias("version"), "measurement").distinct()
    replace_together(spark, [(have.unionByName(nothing), f"{path}_versions", ("measurement",))])
