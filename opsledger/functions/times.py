"""Date and time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# JSON writing cuts times to milliseconds unless told otherwise.
EXACT_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}

# The ISO 8601 shapes the contract accepts, and the point above which a bare number
# counts milliseconds instead of seconds.
ISO_TIME = r"^\d{4}-\d{2}-\d{2}([Tt ]\d{2}:\d{2}(:\d{2}([.,]\d{1,9})?)?([Zz]|[+-]\d{2}:?\d{2})?)?$"
EPOCH_NUMBER = r"^[+-]?\d+(\.\d+)?$"
EPOCH_MILLIS_ABOVE = 20_000_000_000


def epoch_timestamp(number: Column) -> Column:
    """A bare number as a timestamp: seconds, or milliseconds when it is too large for seconds."""
    seconds = F.when(F.abs(number) > EPOCH_MILLIS_ABOVE, number / 1000).otherwise(number)
    return F.timestamp_micros((seconds * 1_000_000).cast("bigint"))


def _parsed(text: Column, kind: str) -> Column:
    iso = F.when(text.rlike(ISO_TIME), F.replace(F.upper(text), F.lit(","), F.lit(".")).try_cast(kind))
    number = F.when(text.rlike(EPOCH_NUMBER), text.try_cast("decimal(30,6)"))
    return F.coalesce(iso, epoch_timestamp(number).cast(kind))


def iso_timestamp(text: Column) -> Column:
    """ISO text (with `Z`, an offset, or neither) or a bare number; NULL for anything else."""
    return _parsed(text, "timestamp")


def wall_clock(text: Column) -> Column:
    """Like `iso_timestamp`, but the local clock reading, with any offset ignored."""
    return _parsed(text, "timestamp_ntz")


def whole_day(clock: Column) -> Column:
    """The date of a clock reading at midnight; NULL at any other time of day."""
    day = clock.cast("date")
    return F.when(clock == day, day)


def iso_date(text: Column) -> Column:
    """An ISO date; a date-time counts only at midnight of its own clock."""
    return whole_day(wall_clock(text))


def day_drift(ts: Column, day: Column) -> Column:
    """Whole days between an instant and a date, ignoring direction."""
    return F.abs(F.datediff(F.to_date(ts), day))


def micros(ts: Column) -> Column:
    """Microseconds since the epoch for either timestamp type."""
    return F.unix_micros(ts.cast("timestamp"))


def interval(text: str) -> Column:
    """`'3 seconds'` as an interval literal."""
    return F.expr(f"INTERVAL {text}")


def interval_micros(text: str) -> Column:
    """`'3 seconds'` as a number of microseconds (a foldable expression)."""
    return F.expr(f"unix_micros(TIMESTAMP '1970-01-01 00:00:00Z' + INTERVAL {text})")
