"""Look-back windows (F4, F5, F6) and their bounds.

A look-back is anchored at ``as_of``:

* ``"now"``    - the session's current time (what a live chart wants);
* ``"latest"`` - the newest time present in the data, as a scalar subquery, so no value
  travels through the driver and the bound still reaches the scan as a runtime filter;
* ``"newest_partition"`` - the same, read from the newest day partition only (needs
  ``partition_col``). Valid when no row's time is later than its partition day and the newest
  partition holds the newest time, as in both feed tables (events: DATEADDED is the export's
  own stamp, which names the partition; weather: partitioned by the reading's own day). It
  reads one day of ``ts`` instead of the whole column;
* a ``datetime``/``date``/string literal or a ``Column``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ts_type(df: DataFrame, ts: str) -> T.DataType:
    return df.schema[ts].dataType


def as_time(df: DataFrame, ts: str, c: Column) -> Column:
    """Cast ``c`` to the type of ``df[ts]`` (keeps NTZ tables NTZ)."""
    return c.cast(ts_type(df, ts))


def floor_time(df: DataFrame, ts: str, unit: str) -> Column:
    """Start of the ``unit`` (``'hour'``, ``'minute'``) holding ``ts``, typed like ``ts``.

    A wall-clock (NTZ) time is floored on the wall clock itself (a tumbling window, no zone),
    so a session zone with daylight saving cannot move it; a zoned time uses ``date_trunc``.
    """
    if ts_type(df, ts).simpleString() == "timestamp_ntz":
        return F.window(ts, f"1 {unit}").start
    return as_time(df, ts, F.date_trunc(unit, ts))


def resolve_as_of(df: DataFrame, ts: str, as_of="now", partition_col: str | None = None) -> Column:
    if isinstance(as_of, Column):
        return as_of
    if as_of is None or as_of == "now":
        return as_time(df, ts, F.current_timestamp())
    if as_of == "latest":
        return df.select(F.max(ts)).scalar()
    if as_of == "newest_partition":
        if not partition_col:
            raise ValueError("as_of='newest_partition' needs partition_col")
        newest = df.select(F.max(partition_col)).scalar()
        return df.filter(F.col(partition_col) == newest).select(F.max(ts)).scalar()
    if isinstance(as_of, (_dt.datetime, _dt.date, str)):
        # A naive literal is a wall-clock time (like SQL's TIMESTAMP '...'), cast to the column's
        # type from text: a Python datetime literal would be an instant and shift with the zone.
        text = as_of.isoformat(sep=" ") if isinstance(as_of, _dt.datetime) else str(as_of)
        return F.lit(text).cast(ts_type(df, ts))
    raise ValueError(f"as_of must be 'now', 'latest', a literal or a Column, not {as_of!r}")


def since(df: DataFrame, ts: str, as_of="now", days: int = 7, partition_col: str | None = None) -> DataFrame:
    """Rows with ``ts >= as_of - days`` (a look-back from ``as_of``)."""
    anchor = resolve_as_of(df, ts, as_of, partition_col)
    return df.filter(F.col(ts) >= anchor - F.make_dt_interval(days=F.lit(days)))


def day_window(df: DataFrame, day: str, days: int = 7) -> DataFrame:
    """Rows of the newest ``days`` days present (F5): ``day BETWEEN max(day) - (days-1) AND max(day)``.

    ``day`` should be the partition column of a day-partitioned table: Spark then turns the
    subquery bounds into partition filters and reads only the days in the window.
    """
    last = df.select(F.max(day)).scalar()
    return df.filter(F.col(day).between(F.date_sub(last, days - 1), last))


def window_bounds(df: DataFrame, day: str, days: int = 7) -> DataFrame:
    """One row: ``last_day``, ``first_day`` of the newest-days window."""
    return df.agg(F.max(day).alias("last_day")).select(
        "last_day", F.date_sub("last_day", days - 1).alias("first_day"))


def window_totals(df: DataFrame, day: str, days: int = 7) -> DataFrame:
    """One row: rows in the window and distinct days covered."""
    w = day_window(df, day, days)
    return w.agg(F.count(F.lit(1)).alias("rows_scanned"), F.count_distinct(day).alias("days"))


def literal_day_window(df: DataFrame, day: str, days: int = 7):
    """``(window, first_day, last_day)`` with the bounds resolved to literals (F5, two-step).

    One tiny aggregate finds the newest day; the filter then carries literal dates, so every
    plan built on the window prunes partitions statically. Empty input -> empty window, None bounds.
    """
    b = window_bounds(df, day, days).first()
    if b is None or b.last_day is None:
        return df.filter(F.lit(False)), None, None
    return df.filter(F.col(day).between(F.lit(b.first_day), F.lit(b.last_day))), b.first_day, b.last_day
