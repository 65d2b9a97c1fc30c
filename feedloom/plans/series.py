"""Series and summaries (C5, C6, C8, C12 with F1, F3, F4, F11, G1, G14-G18, W1, W2, W7).

Series stay long-form DataFrames (``city, time, value``); nothing is collected into a dict.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.functions.time import fmt_minute
from feedloom.operators.dedup import keep_one
from feedloom.operators.joins import dense_index
from feedloom.plans.lookback import resolve_as_of, since


def exact_sum(c, digits: int) -> F.Column:
    """Sum of measurements, exact in decimal, rounded: the same total whatever the partial-sum order."""
    col = F.col(c) if isinstance(c, str) else c
    return F.round(F.sum(col.cast("decimal(38,6)")), digits).cast("double")


def _minute_text(df: DataFrame, c: str) -> F.Column:
    """``YYYY-MM-DDTHH:MM``; a wall-clock (NTZ) time is formatted without any zone."""
    if c in df.columns and df.schema[c].dataType.simpleString() == "timestamp_ntz":
        return F.regexp_replace(F.substring(F.col(c).cast("string"), 1, 16), " ", "T")
    return fmt_minute(c)


def _window(df: DataFrame, ts: str, as_of, days: int, partition_col: str | None) -> DataFrame:
    rows = since(df, ts, as_of, days, partition_col)
    if partition_col:  # same bound on the day partitions: whole days are skipped before any read
        anchor = resolve_as_of(df, ts, as_of, partition_col)
        rows = rows.filter(F.col(partition_col) >= F.to_date(anchor - F.make_dt_interval(days=F.lit(days))))
    return rows


def readings(df: DataFrame, keys: Sequence[str], ts: str, tie: Sequence[str] = ()) -> DataFrame:
    """One row per ``keys`` and time (W1, W2); among copies the one with the largest ``tie`` columns."""
    return keep_one(df, [*keys, ts], [F.desc(c) for c in tie])


def series_one(df: DataFrame, city: str, as_of="now", days: int = 7, city_col: str = "city",
               ts: str = "time", value: str = "temperature_c", extra: Sequence[str] = ("precipitation_mm",),
               tie: Sequence[str] = (), partition_col: str | None = None) -> DataFrame:
    """One city's readings over the look-back, one row per reading time, in time order.

    Times are shown to the minute; readings within one minute stay rows of their own."""
    rows = _window(df, ts, as_of, days, partition_col).filter(F.col(city_col) == F.lit(city))
    # Only the needed columns go on: the de-dup tie-break would otherwise reference (and read) all.
    one = readings(rows.select(*dict.fromkeys([ts, value, *extra, *tie])), [], ts, tie)
    return one.orderBy(ts).select(_minute_text(one, ts).alias("time"), value, *extra)


def series_all(df: DataFrame, as_of="now", days: int = 7, city_col: str = "city", ts: str = "time",
               value: str = "temperature_c", tie: Sequence[str] = (), partition_col: str | None = None) -> DataFrame:
    """Every city's readings over the look-back, one row per city and reading time."""
    rows = _window(df, ts, as_of, days, partition_col).select(*dict.fromkeys([city_col, ts, value, *tie]))
    one = readings(rows, [city_col], ts, tie)
    return one.orderBy(city_col, ts).select(F.col(city_col).alias("city"), _minute_text(one, ts).alias("time"), value)


def nested_series(df: DataFrame, city_col: str = "city", ts: str = "time", value: str = "temperature_c",
                  minutes: int = 1440) -> DataFrame:
    """Series as sorted arrays (G18): ``city, chunk, points`` with points ``struct<time, value>``, one row per city and
    ``minutes``. A chunk holds the readings of its time span and never more, however long the series is."""
    chunk = F.window(ts, f"{minutes} minutes").start
    return df.groupBy(F.col(city_col).alias("city"), chunk.cast(df.schema[ts].dataType).alias("chunk")).agg(
        F.array_sort(F.collect_list(F.struct(F.col(ts).alias("time"), F.col(value).alias("value")))).alias("points"))


def unnested(series: DataFrame) -> DataFrame:
    """The points of nested series as rows ``city, time, value``, chunk after chunk."""
    return series.select("city", F.explode("points").alias("p")).select("city", "p.time", "p.value")


def daily_summary(df: DataFrame, city: str | None = None, city_col: str = "city", ts: str = "time",
                  temp: str = "temperature_c", rain: str = "precipitation_mm", digits: int = 1) -> DataFrame:
    """Per city and day: mean, min, max, rain total (rounded) and readings."""
    d = df if city is None else df.filter(F.col(city_col) == F.lit(city))
    return (d.groupBy(F.col(city_col).alias("city"), F.to_date(ts).alias("day"))
             .agg(F.round(F.avg(temp), digits).alias("mean_c"),
                  F.round(F.min(temp), digits).alias("min_c"),
                  F.round(F.max(temp), digits).alias("max_c"),
                  exact_sum(rain, digits).alias("rain_mm"),
                  F.count(F.lit(1)).alias("readings"))
             .orderBy("city", "day"))


# --------------------------------------------------------------------------- chart numbers

def series_domain(series: DataFrame, value: str, rain: str | None = None) -> DataFrame:
    """One row: ``lo = min-1``, ``hi = max+1`` and ``rmax = max(max rain, 1.0)``."""
    aggs = [(F.min(value) - 1).alias("lo"), (F.max(value) + 1).alias("hi")]
    if rain:
        aggs.append(F.greatest(F.max(rain), F.lit(1.0)).alias("rmax"))
    return series.agg(*aggs)


def daily_domain(daily: DataFrame) -> DataFrame:
    """One row for a daily chart: ``lo`` below the lowest minimum, ``hi`` above the highest maximum."""
    return daily.agg((F.min("min_c") - 1).alias("lo"), (F.max("max_c") + 1).alias("hi"))


def series_totals(series: DataFrame, group: str, ts: str, value: str, rain: str | None = None,
                  digits: int = 1) -> DataFrame:
    """Per series: readings, latest time, last value (of tied times the largest), wet readings and rain total
    (G15, G16, F11)."""
    aggs = [F.count(F.lit(1)).alias("readings"), F.max(ts).alias("latest"),
            F.max_by(value, F.struct(ts, value)).alias("last_value")]
    if rain:
        aggs += [F.count_if(F.col(rain) > 0).alias("wet_readings"), exact_sum(rain, digits).alias("rain_total")]
    return series.groupBy(group).agg(*aggs)


def day_ticks(series: DataFrame, ts: str, group: str | None = None) -> DataFrame:
    """First reading of each calendar day (G17): where a day's tick goes on the axis."""
    keys = ([group] if group else []) + [F.to_date(ts).alias("day")]
    return series.groupBy(*keys).agg(F.min(ts).alias("first_time"))


def axis_positions(series: DataFrame, ts: str) -> DataFrame:
    """Each distinct time's position on the common axis (W7), without a single-task window."""
    return dense_index(series, ts, "pos")


def hourly_domain(hourly: DataFrame, n: str = "n") -> DataFrame:
    """One row for an hourly chart: ``top = max(n) * 1.05`` and the event total."""
    return hourly.agg((F.max(n) * 1.05).alias("top"), F.sum(n).alias("total"))
