"""File names as data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STAMP_RE = r"(\d{14})[^/]*$"  # of the file name, never of a folder


def stamp_of(path_col: Column | str = "_metadata.file_path") -> Column:
    """The 14-digit ``YYYYMMDDHHMMSS`` stamp in a file's name (S15); NULL when absent."""
    c = F.col(path_col) if isinstance(path_col, str) else path_col
    s = F.regexp_extract(c, STAMP_RE, 1)
    return F.when(s == "", F.lit(None).cast("string")).otherwise(s)


def day_of_stamp(stamp: Column) -> Column:
    return F.try_to_timestamp(stamp, F.lit("yyyyMMddHHmmss")).cast("date")


def newest_stamp(files: DataFrame, path_col: str = "path") -> DataFrame:
    """One row: the newest stamp among the listed files."""
    return files.agg(F.max(stamp_of(path_col)).alias("stamp"))


def slots(days: DataFrame, day_col: str = "day", minutes: int = 15, as_ntz: bool = True) -> DataFrame:
    """Every ``minutes`` slot of each day in ``days`` (S16): 96 rows a day at 15 minutes.

    Generated per day row, so the work spreads over the days rather than one task.
    """
    start = F.col(day_col).cast("timestamp_ntz" if as_ntz else "timestamp")
    end = start + F.make_dt_interval(mins=F.lit(24 * 60 - minutes))
    step = F.make_dt_interval(mins=F.lit(minutes))
    return days.select(F.col(day_col).alias("day"), F.explode(F.sequence(start, end, step)).alias("slot"))
