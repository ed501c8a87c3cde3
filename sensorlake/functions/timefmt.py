"""Time parsing and formatting (F-1..F-18) as ANSI-safe column expressions.

ANSI mode is on in Spark 4, so every parse of input data uses ``try_*`` forms:
a bad value becomes NULL (and is quarantined) instead of failing the batch.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Wire and file formats.
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
CSV_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
DAY_FORMAT = "yyyy-MM-dd"
CLOCK_WITH_SECONDS = "h:mm:ss a"
CLOCK_WITHOUT_SECONDS = "h:mm a"


def utc(at: _dt.datetime) -> _dt.datetime:
    """The instant with its zone; a datetime without one is UTC, whatever the driver's zone."""
    return at.replace(tzinfo=_dt.timezone.utc) if at.tzinfo is None else at.astimezone(_dt.timezone.utc)


def utc_literal(at: _dt.datetime) -> Column:
    """A TIMESTAMP literal that doesn't depend on the zone of driver or session."""
    return F.lit(utc(at).isoformat()).cast("timestamp")


def parse_iso(text: Column) -> Column:
    """ISO-8601 text (``T`` or space separator, optional fraction) -> TIMESTAMP, bad -> NULL."""
    return F.try_to_timestamp(text)


def parse_strict(text: Column, fmt: str = CSV_TIME_FORMAT) -> Column:
    """Fixed-format parse; values that do not match give NULL (F-13, lenient for quarantine)."""
    return F.try_to_timestamp(text, F.lit(fmt))


def parse_day_clock(day: Column, clock: Column) -> Column:
    """Lenient date + 12-hour clock text, with or without seconds (F-11, F-12); neither -> NULL."""
    text = F.concat_ws(" ", format_day(lenient_day(day)), F.trim(clock))
    return F.when(lenient_day(day).isNotNull(), F.coalesce(
        F.try_to_timestamp(text, F.lit(f"{DAY_FORMAT} {CLOCK_WITH_SECONDS}")),
        F.try_to_timestamp(text, F.lit(f"{DAY_FORMAT} {CLOCK_WITHOUT_SECONDS}")),
    ))


def lenient_day(text: Column) -> Column:
    """Lenient date parse (F-12): ISO, with or without a time after it, or month/day/year; bad -> NULL."""
    t = F.trim(text)
    return F.coalesce(F.try_to_timestamp(t).cast("date"), F.try_to_date(t, "M/d/yyyy"),
                      F.try_to_timestamp(t, F.lit("M/d/yyyy H:mm:ss")).cast("date"))


def format_day(ts: Column) -> Column:
    return F.date_format(ts, DAY_FORMAT)


def format_clock(ts: Column, with_seconds: Column | bool = True) -> Column:
    if isinstance(with_seconds, bool):
        return F.date_format(ts, CLOCK_WITH_SECONDS if with_seconds else CLOCK_WITHOUT_SECONDS)
    return F.when(with_seconds, F.date_format(ts, CLOCK_WITH_SECONDS)).otherwise(
        F.date_format(ts, CLOCK_WITHOUT_SECONDS))


def to_iso(ts: Column) -> Column:
    """TIMESTAMP -> ISO text with microseconds (F-14, F-15 under a UTC session)."""
    return F.date_format(ts, ISO_FORMAT)


def epoch_seconds(ts: Column) -> Column:
    """Whole epoch seconds (F-4)."""
    return F.unix_timestamp(ts)


def whole_second_duration(start: Column, end: Column) -> Column:
    """F-5: difference of truncated epochs (not a truncated difference)."""
    return F.unix_timestamp(end) - F.unix_timestamp(start)
