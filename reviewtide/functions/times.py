"""Features of a review's time. All follow the session time zone (UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The hours of the day that count as "day", both included.
DAY_FIRST_HOUR = 8
DAY_LAST_HOUR = 17
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"


def review_time(epoch_seconds: Column) -> Column:
    """Exact in every time zone, as it takes no detour through local time text."""
    return F.timestamp_seconds(epoch_seconds)


def weekday(time: Column) -> Column:
    return F.date_format(time, "E")


def day_night(time: Column) -> Column:
    hour = F.hour(time)
    return F.when(hour.between(DAY_FIRST_HOUR, DAY_LAST_HOUR), "day").when(hour.isNotNull(), "night")


def iso_text(time: Column) -> Column:
    return F.date_format(time, ISO_FORMAT)
