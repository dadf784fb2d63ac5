"""Calendar days of a local time zone over UTC instants.

The session time zone must be UTC. A local day has 23, 24 or 25 hours, so bounds are
always made from local dates, never by adding seconds.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ZONE = "Europe/Berlin"


def to_utc(local: Column, zone: str = ZONE) -> Column:
    """Instant of a local wall time.

    In the hour that autumn repeats, the later instant (standard time) is taken; a time in
    the hour that spring skips is read with the offset before the change.
    """
    first = F.to_utc_timestamp(local, zone)
    later = first + F.expr("INTERVAL 1 HOUR")
    return F.when(F.from_utc_timestamp(later, zone) == local.cast("timestamp"), later).otherwise(first)


def to_local(instant: Column, zone: str = ZONE) -> Column:
    return F.from_utc_timestamp(instant, zone)


def local_day(instant: Column, zone: str = ZONE) -> Column:
    return F.to_date(to_local(instant, zone))


def day_start(day: Column, zone: str = ZONE) -> Column:
    """Local midnight of a date."""
    return to_utc(day.cast("timestamp"), zone)


def day_close(day: Column, zone: str = ZONE) -> Column:
    """Local 23:59:59, the last second of a counter's day."""
    return to_utc(day.cast("timestamp") + F.expr("INTERVAL '23:59:59' HOUR TO SECOND"), zone)


def day_stamp(day: Column, zone: str = ZONE) -> Column:
    """Local 23:59:59.999999, the stamp of daily results."""
    return to_utc(day.cast("timestamp") + F.expr("INTERVAL '23:59:59.999999' HOUR TO SECOND"), zone)


def next_day_start(day: Column, zone: str = ZONE) -> Column:
    return day_start(F.date_add(day, 1), zone)


def micros(instant: Column) -> Column:
    return F.unix_micros(instant)


def hours_between(start: Column, stop: Column) -> Column:
    return (micros(stop) - micros(start)) / 3.6e9


def days_after(last: Column, until: Column) -> Column:
    """Array of the days after last up to until; empty if there are none."""
    first = F.date_add(last, 1)
    return F.when(first <= until, F.sequence(first, until, F.expr("INTERVAL 1 DAY"))).otherwise(F.array().cast("array<date>"))
