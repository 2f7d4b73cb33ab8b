"""Event time, days and window labels.

Instants are Spark ``timestamp`` values; the session time zone decides which
day an instant falls on.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY = "yyyy-MM-dd"
SECOND = "yyyy-MM-dd HH:mm:ss"


def from_epoch_s(seconds: Column | str) -> Column:
    """Event time of a change record (epoch seconds, often text)."""
    return F.timestamp_seconds(_col(seconds).try_cast("bigint"))


def from_epoch_ms(millis: Column | str) -> Column:
    """Event time of a log record (epoch milliseconds)."""
    return F.timestamp_millis(_col(millis).try_cast("bigint"))


def from_epoch_ms_whole_s(millis: Column | str) -> Column:
    """Event time of a log record cut to whole seconds."""
    return F.timestamp_seconds(F.floor(_col(millis).try_cast("bigint") / 1000))


def to_epoch_ms(text: Column | str, full: bool = False) -> Column:
    """Epoch milliseconds of a date text, or of a date-time text if ``full``."""
    return F.unix_millis(F.try_to_timestamp(_col(text), F.lit(SECOND if full else DAY)))


def day_text(t: Column | str) -> Column:
    return F.date_format(_col(t), DAY)


def second_text(t: Column | str) -> Column:
    return F.date_format(_col(t), SECOND)


def day_text_ms(millis: Column | str) -> Column:
    return day_text(from_epoch_ms(millis))


def second_text_ms(millis: Column | str) -> Column:
    return second_text(from_epoch_ms(millis))


def day_of_text(text: Column | str) -> Column:
    """Day part of a date-time text; null when the text is no date-time."""
    return F.date_format(F.try_to_timestamp(_col(text)), DAY)


def day(t: Column | str) -> Column:
    return F.to_date(_col(t))


def yesterday(t: Column | str) -> Column:
    return F.date_sub(F.to_date(_col(t)), 1)


def days_between(later: Column | str, earlier: Column | str) -> Column:
    return F.datediff(_col(later), _col(earlier))


def emit_time_ms() -> Column:
    """Processing time in milliseconds; one value per batch or micro-batch."""
    return F.unix_millis(F.current_timestamp())


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
