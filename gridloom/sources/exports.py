"""Points from exports in CSV or JSON lines, and exports of points.

Every column is read as text under a fixed schema and converted here, so that a bad row is seen and kept: rows
that can't be made points go to a table of rejects with their text and the reason. Times with an offset
are instants; times without one are local, by the rules of functions.localtime. Values may be numbers or
true and false; an empty one is a point without a value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.functions.localtime import ZONE, to_utc
from gridloom.sources.points import POINTS, points
from gridloom.sources.scratch import stored

#: Columns of an export, all optional but entity_id, time and value; a CSV file names those that it has in its first line.
COLUMNS = tuple(POINTS.names)
_BAD = "_record"
_OFFSET = r"[0-9]{2}:[0-9]{2}.*(?:Z|UTC|[+-][0-9]{2}(?::?[0-9]{2})?)$"


def instant(text: Column, zone: str = ZONE) -> Column:
    """The instant of a written time; null if it is none."""
    read = F.trim(text).try_cast("timestamp")
    return F.when(F.trim(text).rlike(_OFFSET), read).otherwise(to_utc(read, zone))


def number(text: Column) -> Column:
    """Numbers as doubles, true and false as 1 and 0; null if it is neither."""
    low = F.lower(F.trim(text))
    return F.when(low == "true", 1.0).when(low == "false", 0.0).otherwise(low.try_cast("double"))


def read_export(spark: SparkSession, path: str, form: str, columns: tuple[str, ...] = COLUMNS, zone: str = ZONE, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """(points, rejects) of the files under path; form is csv (with a line of names, if header) or json (an object a line).

    columns: those that a CSV file has, in its order. rejects: (record, reason), where reason is
    format, entity_id, time or value. The files are read once.
    """
    if form not in ("csv", "json"):
        raise ValueError("an export is csv or json")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*columns, _BAD)])
    reader = spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _BAD)
    rows = reader.option("header", header).option("enforceSchema", True).csv(path) if form == "csv" else reader.json(path)
    for c in set(COLUMNS) - set(columns):
        rows = rows.withColumn(c, F.lit(None).cast("string"))
    empty = lambda c: F.trim(F.coalesce(c, F.lit(""))) == ""
    reason = (
        F.when(F.col(_BAD).isNotNull(), "format")
        .when(empty("entity_id"), "entity_id")
        .when(F.col("_time").isNull(), "time")
        .when(~empty("value") & F.col("_value").isNull(), "value")
    )
    told = F.coalesce(F.col(_BAD), F.to_json(F.struct(*columns)))
    rows = rows.withColumns({"_time": instant(F.col("time"), zone), "_value": number(F.col("value"))})
    kept = rows.select(*[c for c in COLUMNS if c not in ("time", "value")], F.col("_time").alias("time"), F.col("_value").alias("value"), reason.alias("reason"), F.when(reason.isNotNull(), told).alias("record"))
    kept = stored(kept, "export")
    good = kept.filter("reason is null").drop("reason", "record")
    defaults = {"measurement": "home_assistant", "field": "value"}
    good = good.withColumns({c: F.when(empty(c), F.lit(v)).otherwise(F.col(c)) for c, v in defaults.items()})
    return points(good), kept.filter("reason is not null").select("record", "reason")


def write_export(df: DataFrame, path: str, form: str) -> None:
    """Points as CSV with a line of names or as JSON lines; times are instants with an offset."""
    if form not in ("csv", "json"):
        raise ValueError("an export is csv or json")
    # value as text keeps every digit
    text = points(df).withColumns({"time": F.date_format("time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"), "value": F.col("value").cast("string")})
    writer = text.write.option("compression", "gzip")
    writer.option("header", "true").csv(path) if form == "csv" else writer.json(path)
