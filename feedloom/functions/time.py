"""Time expressions. All times are naive UTC wall-clock times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom.schemas import EVENT_DAY_FORMAT, EVENT_STAMP_FORMAT, WEATHER_TIME_FORMAT


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_stamp(c) -> Column:
    """``YYYYMMDDHHMMSS`` text (or number) to a timestamp; NULL when malformed."""
    return F.try_to_timestamp(F.trim(_c(c).cast("string")), F.lit(EVENT_STAMP_FORMAT))


def parse_compact_day(c) -> Column:
    """``YYYYMMDD`` integer or text to a date; NULL when malformed."""
    return F.try_to_timestamp(F.trim(_c(c).cast("string")), F.lit(EVENT_DAY_FORMAT)).cast("date")


def parse_weather_time(c) -> Column:
    """``YYYY-MM-DDTHH:MM`` to a timestamp (strict: a bad reading time is an error)."""
    col = _c(c)
    t = F.try_to_timestamp(col, F.lit(WEATHER_TIME_FORMAT))
    bad = col.isNotNull() & t.isNull()
    return F.when(bad, F.raise_error(F.concat(F.lit("bad reading time: "), col))).otherwise(t)


def fmt_minute(c) -> Column:
    """Timestamp to ``YYYY-MM-DDTHH:MM`` text."""
    return F.date_format(_c(c), WEATHER_TIME_FORMAT)


def hour_of(c) -> Column:
    """Start of the hour, typed like the input (NTZ stays NTZ)."""
    return F.date_trunc("hour", _c(c))


def minute_of(c) -> Column:
    return F.date_trunc("minute", _c(c))


def day_of(c) -> Column:
    return F.to_date(_c(c))


def slot_of(c, minutes: int = 15) -> Column:
    """Start of the ``minutes``-long slot that holds the time (tumbling, aligned to midnight)."""
    return F.window(_c(c), f"{minutes} minutes").start
