"""Date and time expressions on untrusted input."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_timestamp(text: Column | str) -> Column:
    """ISO-8601 text (with or without ``Z``) to timestamp; NULL when it does not parse."""
    return F.try_to_timestamp(F.col(text) if isinstance(text, str) else text)


def day_of(timestamp: Column | str) -> Column:
    return F.to_date(timestamp)


def calendar_days(end: Column | str, start: Column | str) -> Column:
    return F.datediff(end, start)


def event_bucket(event_time: Column, fallback: Column) -> dict[str, Column]:
    """Partition values ``dt`` and ``hour`` of a raw row: event time, else ingest time."""
    moment = F.coalesce(event_time, fallback)
    return {
        "dt": F.date_format(moment, "yyyy-MM-dd"),
        "hour": F.date_format(moment, "HH"),
    }


def processing_day(date: str) -> Column:
    return F.to_date(F.lit(date))
