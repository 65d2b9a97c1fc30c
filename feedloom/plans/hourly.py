"""Hourly activity (C7 / G2 / G3): events and mean tone per hour over a look-back.

The layout (raw CSV landing, one Parquet snapshot, day-partitioned Parquet) is only the input
DataFrame; the plan never sees it. On Parquet only ``ts``, the group column and the value
column are read, and on a day-partitioned table the ``ingest_day`` bound prunes whole days.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.functions.casts import lenient_in
from feedloom.functions.text import country_code
from feedloom.functions.time import hour_of
from feedloom.plans.lookback import as_time, floor_time, resolve_as_of


def _hour_start(df: DataFrame, ts: str, e):
    """Start of the hour holding the time ``e``; a wall-clock (NTZ) time is floored zone-free."""
    if df.schema[ts].dataType.simpleString() == "timestamp_ntz":
        e = e.cast("timestamp_ntz")
        return F.make_timestamp_ntz(F.year(e), F.month(e), F.dayofmonth(e), F.hour(e), F.lit(0), F.lit(0))
    return as_time(df, ts, hour_of(e))


def hourly(df: DataFrame, as_of="now", days: int = 7, group: str | None = None,
           group_col: str = "ActionGeo_CountryCode", ts: str = "ts", value: str = "AvgTone",
           normalise_group: bool = True, partition_col: str | None = None,
           digits: int | None = None, fill: bool = False) -> DataFrame:
    """``h, n, tone`` per hour for rows with ``ts >= as_of - days``, optionally one group.

    ``partition_col`` names a day partition column (e.g. ``ingest_day``); when given, the same
    bound is also applied to it so Spark prunes partitions before reading any file. A row
    lands in the partition of its own day or a later one, so this never drops a row.

    Hours without rows are absent, as in a GROUP BY; ``fill=True`` adds them with ``n = 0``
    (and a NULL tone), joining onto the window's hour axis (24 rows a day).
    """
    anchor = resolve_as_of(df, ts, as_of, partition_col)
    lower = anchor - F.make_dt_interval(days=F.lit(days))
    out = df.filter(F.col(ts) >= lower)
    if partition_col:
        out = out.filter(F.col(partition_col) >= F.to_date(lower))
    if group is not None:
        key = country_code(group) if normalise_group else F.lit(group)
        out = out.filter(F.col(group_col) == key)
    tone = F.avg(lenient_in(df, value, "double"))
    if digits is not None:
        tone = F.round(tone, digits)
    counts = (out.groupBy(floor_time(df, ts, "hour").alias("h"))
                 .agg(F.count(F.lit(1)).alias("n"), tone.alias("tone")))
    if not fill:
        return counts
    first_hour, last_hour = _hour_start(df, ts, lower), _hour_start(df, ts, anchor)
    axis = (df.sparkSession.range(1)
              .select(F.explode(F.sequence(first_hour, last_hour, F.make_dt_interval(hours=F.lit(1)))).alias("h")))
    # Every counted hour stays (also any after ``as_of``); axis hours without a count are added
    # with n = 0. Both sides hold at most one row per hour of the window.
    empty = (axis.join(F.broadcast(counts.select("h")), "h", "left_anti")
                 .select("h", F.lit(0).cast("bigint").alias("n"), F.lit(None).cast("double").alias("tone")))
    return counts.unionByName(empty)
