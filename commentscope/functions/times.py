"""Time columns. The session time zone decides days and hours; the session factory pins UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Seconds that a Spark timestamp (64-bit microseconds) can hold.
MAX_SECONDS = (2**63 - 1) // 1_000_000


def event_time(seconds: Column) -> Column:
    """Unix seconds as timestamp; NULL where a timestamp cannot hold the value."""
    return F.when(
        seconds.between(-MAX_SECONDS, MAX_SECONDS), F.timestamp_seconds(seconds)
    )


def parse_time(value: Column) -> Column:
    """Timestamp from text or whole unix seconds given as text; NULL where neither fits."""
    text = value.cast("string")
    seconds = text.try_cast("bigint")
    return F.coalesce(event_time(seconds), F.try_to_timestamp(text))


def calendar_days(first: Column, last: Column) -> Column:
    return F.datediff(last, first)


def magnitude(value: Column) -> Column:
    """|value|; the one integer without a positive counterpart stays as it is."""
    return F.greatest(value, F.try_subtract(F.lit(0).cast("bigint"), value))
