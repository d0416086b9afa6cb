"""Time expressions. All assume a UTC session."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"


def start_of_minute(ts: Column) -> Column:
    return F.date_trunc("MINUTE", ts)


def start_of_hour(ts: Column) -> Column:
    return F.date_trunc("HOUR", ts)


def start_of_five_minutes(ts: Column) -> Column:
    """Epoch-aligned; a plain expression, so no time-window row expansion is planned."""
    seconds = F.unix_seconds(ts)
    return F.timestamp_seconds(seconds - F.pmod(seconds, F.lit(300)))


def whole_second(ts: Column) -> Column:
    return F.date_trunc("SECOND", ts)


def weekday_from_monday(ts: Column) -> Column:
    """Monday 0 .. Sunday 6."""
    return F.weekday(ts)


def micros_between(later: Column, earlier: Column) -> Column:
    return F.unix_micros(later) - F.unix_micros(earlier)


def seconds_between(later: Column, earlier: Column) -> Column:
    return micros_between(later, earlier) / F.lit(1e6)


def iso_text(ts: Column) -> Column:
    """ISO-8601 text; microseconds are shown only where there are any."""
    has_micros = F.pmod(F.unix_micros(ts), F.lit(1_000_000)) != 0
    return F.when(has_micros, F.date_format(ts, ISO_MICROS)).otherwise(
        F.date_format(ts, ISO_SECONDS)
    )


def moment(as_of: datetime | str | Column | None) -> Column:
    """A point in time given as a value or column; None means the query's start."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(str(as_of)).cast("timestamp")
