"""Time expressions. All of them assume a UTC session."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pulsegrid.functions.values import LOCAL_ZONE


def local_timestamp(ts: Column) -> Column:
    return F.from_utc_timestamp(ts, LOCAL_ZONE)


def local_date(ts: Column) -> Column:
    return F.to_date(local_timestamp(ts))


def epoch_millis_whole_seconds(ts: Column) -> Column:
    """Epoch milliseconds with the sub-second part dropped first, as the app loader stores them."""
    return F.unix_seconds(ts) * F.lit(1000).cast("long")


def timestamp_of_millis(ms: Column, keep_millis: bool = False) -> Column:
    """Timestamp of epoch milliseconds; whole seconds unless ``keep_millis``."""
    if keep_millis:
        return F.timestamp_millis(ms)
    return F.timestamp_seconds(F.floor(ms / F.lit(1000)).cast("long"))


def months_between_calendar(start: Column, end: Column) -> Column:
    """Month boundaries crossed between two dates (28 Feb -> 1 Mar is 1)."""
    return (F.year(end) - F.year(start)) * 12 + (F.month(end) - F.month(start))
