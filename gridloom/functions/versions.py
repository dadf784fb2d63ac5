"""Order of version tags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def version_rank(version: Column) -> Column:
    """Sorts by the number at the end; versions without one sort above all others, by name."""
    digits = F.regexp_extract(version, "([0-9]+)$", 1)
    return F.struct(F.when(digits == "", 1).otherwise(0).alias("plain"), F.coalesce(digits.try_cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)")).alias("number"), version.alias("version"))
