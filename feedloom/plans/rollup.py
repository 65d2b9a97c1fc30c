"""Maintained roll-ups of a day table (K7, C7, C8, G8, T9): hourly partials that add up.

Per source day, hour and group the roll-up keeps what can be combined later: rows, values, their exact sum
(a decimal), smallest and largest value, and a sketch of a column's distinct values. ``refresh`` computes the
partials of the days that a compaction report names and replaces those days alone; an answer reads partials only, never the table.

Distinct counts: the sketch (HyperLogLog, 2^``LG_K`` registers, standard error about 1.04 / sqrt(2^LG_K), 0.8 % at the default
14) merges over any hours and groups. Exact counts come from a second roll-up, one row per day and distinct value
(``refresh_distinct``), whose union over days is counted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions.casts import lenient_in
from feedloom.functions.time import hour_of
from feedloom.operators.merge import publish_days, read_days_only, swap_in
from feedloom.plans.lookback import as_time, floor_time
from feedloom.session import child_folders, delete_path

LG_K = 14
TOTAL = "decimal(38,10)"


def partials(df: DataFrame, day_col: str, ts: str, value: str, group: str | None = None, distinct: str | None = None) -> DataFrame:
    """Rows (day, h, group): ``n``, ``n_values``, ``total`` (exact), ``rest`` (of values no decimal holds), ``low``, ``high`` and, if asked, ``sketch``."""
    v = lenient_in(df, value, "double")
    exact = v.try_cast(TOTAL)  # null for NaN, infinities and what has no room: those are summed apart
    aggs = [F.count(F.lit(1)).alias("n"), F.count(v).alias("n_values"), F.sum(exact).cast(TOTAL).alias("total"),
            F.sum(F.when(exact.isNull(), v)).alias("rest"), F.min(v).alias("low"), F.max(v).alias("high")]
    if distinct:
        aggs.append(F.hll_sketch_agg(F.col(distinct).cast("string"), F.lit(LG_K)).alias("sketch"))
    by = [F.col(day_col), floor_time(df, ts, "hour").alias("h")]
    if group:
        by.append(F.col(group).alias("group"))
    return df.groupBy(*by).agg(*aggs)


def _replace(spark: SparkSession, path: str, rows: DataFrame, day_col: str, days: Sequence) -> None:
    """Put some days of a roll-up in place, whole; a day that has no rows any more goes."""
    publish_days(spark, path, day_col)
    placed = set(swap_in(spark, path, rows.hint("rebalance", day_col), day_col))
    have = child_folders(spark, path)
    for d in days:
        if str(d) not in placed and f"{day_col}={d}" in have:
            delete_path(spark, f"{path.rstrip('/')}/{day_col}={d}")


def _source(spark: SparkSession, table: str, day_col: str, days: Sequence) -> DataFrame:
    rows = read_days_only(spark, table, day_col, days)
    return spark.read.parquet(table).limit(0) if rows is None else rows


def refresh(spark: SparkSession, table: str, rollup: str, days: Sequence, ts: str = "ts", value: str = "AvgTone",
            group: str | None = None, distinct: str | None = None, day_col: str = "ingest_day") -> None:
    """Compute the partials of ``days`` again (``report["days"]`` of a compaction); no other day is opened."""
    if len(days):
        _replace(spark, rollup, partials(_source(spark, table, day_col, days), day_col, ts, value, group, distinct), day_col, days)


def combined(rollup: DataFrame, by: Sequence[Column | str], digits: int | None = None) -> DataFrame:
    """Partials added up: ``n``, ``mean``, ``total``, ``low``, ``high`` and, if kept, ``distinct`` (estimated)."""
    mean = (F.coalesce(F.sum("total").cast("double"), F.lit(0.0)) + F.coalesce(F.sum("rest"), F.lit(0.0))) / F.sum("n_values")
    mean = F.when(F.sum("n_values") > 0, F.round(mean, digits) if digits is not None else mean)
    aggs = [F.sum("n").alias("n"), mean.alias("mean"), F.sum("total").cast(TOTAL).alias("total"), F.min("low").alias("low"), F.max("high").alias("high")]
    if "sketch" in rollup.columns:
        aggs.append(F.hll_sketch_estimate(F.hll_union_agg("sketch", F.lit(False))).alias("distinct"))
    return rollup.groupBy(*by).agg(*aggs)


def hourly_rollup(rollup: DataFrame, as_of="latest", days: int = 7, group: str | None = None, digits: int | None = None) -> DataFrame:
    """``h, n, tone`` from partials: the hours from ``as_of - days`` on, whole hours at both ends.

    ``as_of`` is a time, or ``"latest"`` for the newest hour kept."""
    rows = rollup if group is None else rollup.filter(F.col("group") == group)
    newest = rollup.select(F.max("h")).scalar() if as_of == "latest" else as_time(rollup, "h", hour_of(F.lit(as_of)))
    return combined(rows.filter(F.col("h") >= newest - F.make_dt_interval(days=F.lit(days))), ["h"], digits).select("h", "n", F.col("mean").alias("tone"))


def refresh_distinct(spark: SparkSession, table: str, path: str, days: Sequence, value: str, day_col: str = "ingest_day") -> None:
    """One row per day and distinct value, for the days given."""
    if len(days):
        rows = _source(spark, table, day_col, days).filter(F.col(value).isNotNull()).select(day_col, F.col(value).alias("value")).distinct()
        _replace(spark, path, rows, day_col, days)


def distinct_exact(rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Exact distinct counts over any days of a distinct roll-up (per ``by``): two aggregations, no list of values."""
    return rows.select(*by, "value").distinct().groupBy(*by).agg(F.count(F.lit(1)).alias("distinct"))
