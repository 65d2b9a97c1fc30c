"""Dashboard pack (C9): bounds, totals, per hour, top groups, tone of the leaders, class mix.

All answers share one look-back over the newest days (F5). The window is read once and reduced to one row
per (hour, group, class); that small table is stored, and every answer is rolled up from it.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from feedloom.functions.casts import lenient_in
from feedloom.functions.labels import quad_label
from feedloom.functions.text import non_blank
from feedloom.plans.lookback import floor_time, literal_day_window


def top_groups(df: DataFrame, group: str, k: int = 15, alias: str = "country", count_name: str = "events") -> DataFrame:
    """The ``k`` largest groups by row count, ties broken by the key (G6, L2, F7, A-14)."""
    return (df.filter(non_blank(group) if dict(df.dtypes)[group] == "string" else F.col(group).isNotNull())
              .groupBy(F.col(group).alias(alias)).agg(F.count(F.lit(1)).alias(count_name))
              .orderBy(F.desc(count_name), F.asc(alias)).limit(k))


def leaders_tone(window: DataFrame, leaders: DataFrame, day: str, group: str, tone: str,
                 alias: str = "country", digits: int | None = None) -> DataFrame:
    """Mean tone by day for the leading groups (G4, J2). ``leaders`` has at most k rows."""
    sel = window.join(F.broadcast(leaders.select(F.col(alias).alias(group))), group, "left_semi")
    t = F.avg(lenient_in(window, tone, "double"))
    if digits is not None:
        t = F.round(t, digits)
    return sel.groupBy(F.col(day).alias("day"), F.col(group).alias(alias)).agg(t.alias("tone"))


def class_mix(window: DataFrame, day: str, cls: str, label: bool = True, digits: int | None = None) -> DataFrame:
    """Rows by day and class with each class's share of its day.

    The share window runs over the aggregated rows (a few per day), never the raw table.
    """
    agg = window.groupBy(F.col(day).alias("day"), F.col(cls).alias(cls)).agg(F.count(F.lit(1)).alias("events"))
    share = F.col("events") / F.sum("events").over(Window.partitionBy("day"))
    if digits is not None:
        share = F.round(share, digits)
    out = agg.withColumn("share", share)
    return out.withColumn("class", quad_label(cls)) if label else out


def dashboard(df: DataFrame, days: int = 7, top: int = 15, tone: int = 6, day: str = "ingest_day",
              group: str = "ActionGeo_CountryCode", tone_col: str = "AvgTone", ts: str = "ts",
              cls: str = "QuadClass", label: bool = True) -> dict[str, DataFrame]:
    """The six dashboard answers from ONE scan of the window.

    The window bounds are resolved first (one tiny aggregate; on a day-partitioned table it
    reads only the partition column) and applied as literals, so every later read is pruned
    statically. One aggregate per (day, hour, group, class) combines rows before the shuffle; it is checkpointed
    and each answer is a roll-up of it. ``cost`` has the rows read and the seconds taken, as measured.
    """
    from feedloom.session import cut_lineage
    began = time.perf_counter()
    window, first, last = literal_day_window(df, day, days)
    spark = df.sparkSession
    bounds = spark.createDataFrame([(last, first)], "last_day date, first_day date")
    t = lenient_in(df, tone_col, "double")
    read = Observation("dashboard_scan")
    slim = window.select(F.col(day).alias("day"), floor_time(df, ts, "hour").alias("hour"),
                         F.col(group).alias("country"), F.col(cls).alias(cls), t.alias("_tone"))
    slim = slim.observe(read, F.count(F.lit(1)).alias("rows"))
    cells = cut_lineage(slim.groupBy("day", "hour", "country", cls).agg(
        F.count(F.lit(1)).alias("events"), F.sum("_tone").alias("tone_sum"), F.count("_tone").alias("tone_n")))
    totals = cells.agg(F.coalesce(F.sum("events"), F.lit(0)).alias("rows_scanned"), F.count_distinct("day").alias("days"))
    named = cells.filter(non_blank("country") if dict(slim.dtypes)["country"] == "string" else F.col("country").isNotNull())
    top_countries = (named.groupBy("country").agg(F.sum("events").alias("events"))
                     .orderBy(F.desc("events"), F.asc("country")).limit(top))
    leaders = top_countries.limit(tone).select("country")
    tone_df = (cells.join(F.broadcast(leaders), "country", "left_semi").groupBy("day", "country")
               .agg((F.sum("tone_sum") / F.nullif(F.sum("tone_n"), F.lit(0))).alias("tone")))
    quad = cells.groupBy("day", cls).agg(F.sum("events").alias("events"))
    quad = quad.withColumn("share", F.col("events") / F.sum("events").over(Window.partitionBy("day")))
    if label:
        quad = quad.withColumn("class", quad_label(cls))
    cost = spark.createDataFrame([(read.get.get("rows", 0), time.perf_counter() - began)], "rows_read long, seconds double")
    return {
        "bounds": bounds,
        "totals": totals,
        "per_hour": cells.groupBy("hour").agg(F.sum("events").alias("events")),
        "top_countries": top_countries,
        "top_countries_display": top_countries.orderBy("events", F.desc("country")),  # bars bottom-up (L5)
        "tone": tone_df,
        "quad": quad,
        "cost": cost,
    }
