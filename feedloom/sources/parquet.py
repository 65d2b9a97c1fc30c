"""Parquet tables."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A Parquet file or folder; missing and a schema given -> typed empty frame."""
    from feedloom.operators.merge import table_exists
    if schema is not None and not table_exists(spark, path):
        return empty(spark, schema)
    return spark.read.parquet(path)


def read_days(spark: SparkSession, root: str, first: _dt.date | str | None = None,
              last: _dt.date | str | None = None, day_col: str = "ingest_day") -> DataFrame:
    """A day-partitioned folder; bounds on the partition column prune whole days.

    A missing day is simply an empty partition (S18).
    """
    df = spark.read.option("basePath", root).parquet(root)
    if first is not None:
        df = df.filter(F.col(day_col) >= F.lit(first).cast("date"))
    if last is not None:
        df = df.filter(F.col(day_col) <= F.lit(last).cast("date"))
    return df


def last_days(spark: SparkSession, root: str, as_of: _dt.date, days: int, day_col: str = "ingest_day") -> DataFrame:
    """The last ``days`` day partitions up to ``as_of`` that exist."""
    start = as_of - _dt.timedelta(days=days - 1)
    return read_days(spark, root, start, as_of, day_col)


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """Typed empty relation, the fallback when a source is missing."""
    return spark.createDataFrame([], schema)


def read_parquet_nanos(spark: SparkSession, path: str, ts_cols) -> DataFrame:
    """Parquet written with nanosecond timestamps (pandas' default), which Spark rejects (H7).

    Read with ``spark.sql.legacy.parquet.nanosAsLong`` (a session setting, left on) so the
    columns arrive as BIGINT nanoseconds, then turned into microsecond timestamps.
    """
    spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
    df = spark.read.parquet(path)
    return df.withColumns({c: F.timestamp_micros(F.floor(F.col(c) / 1000)) for c in ts_cols})
