"""Weather feed payloads.

A landed payload file holds one JSON array with one object per city, in the order the
cities were asked for. Entries are matched to the city dimension by position with an
equi-join on the broadcast 10-row dimension; an unreadable payload, an entry without a city and
a city without an entry are reported as rejects rather than silently cut.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.operators.dedup import with_position
from feedloom.schemas import CITIES, CITY_DIM, WEATHER_FIELDS, WEATHER_PAYLOAD


def city_dim(spark: SparkSession) -> DataFrame:
    """The fixed 10-row city dimension with each city's payload position."""
    return spark.createDataFrame([(i, n, la, lo) for i, (n, la, lo) in enumerate(CITIES)], CITY_DIM)


def payload_entries(payloads: DataFrame, places: int, text_col: str = "value", keep: tuple = (), start: str | None = None) -> DataFrame:
    """One row per place of each payload: ``pos``, the entry ``p`` (NULL if absent), and whether the payload
    could be read; an unreadable payload gives one row with its text in ``raw``. A long payload can come in parts of
    at least ``places`` entries (the last may have fewer); ``start`` is the column with the place of a part's first."""
    kept = [c for c in ("_pos", *keep) if c in payloads.columns]
    arr = F.from_json(F.col(text_col), WEATHER_PAYLOAD)
    first = F.lit(0) if start is None else F.col(start).cast("int")
    read = payloads.select(*kept, F.col(text_col).alias("raw"), arr.alias("a"), first.alias("_first"))
    last = F.when(F.col("a").isNull(), 0).otherwise(F.greatest(F.size("a"), F.lit(places) - F.col("_first")) - 1)
    return (read.withColumn("_at", F.explode(F.sequence(F.lit(0), last))).withColumn("pos", F.col("_first") + F.col("_at"))
                .select(*kept, "pos", F.get("a", F.col("_at")).alias("p"), F.col("a").isNotNull().alias("readable"),
                        F.when(F.col("a").isNull(), F.col("raw")).alias("raw")))


def rows_from_payload(payloads: DataFrame, cities: DataFrame, text_col: str = "value",
                      keep: tuple = (), start: str | None = None) -> tuple[DataFrame, DataFrame]:
    """``(rows, rejects)``: weather rows in the day-file field order; and, with a ``reason``, payloads that cannot
    be read, entries without a city and cities without an entry. ``start``: see :func:`payload_entries`."""
    e = payload_entries(payloads, len(CITIES), text_col, keep, start)
    joined = e.join(F.broadcast(cities), "pos", "left")  # 10 fixed rows: a proven bound
    reason = (F.when(~F.col("readable"), "unreadable").when(F.col("name").isNull(), "no city")
               .when(F.col("p").isNull(), "no entry"))
    joined = joined.withColumn("reason", reason)
    cur = F.col("p.current")
    rows = joined.filter(F.col("reason").isNull()).select(
        *[c for c in ("_pos", *keep) if c in joined.columns],
        F.col("pos"),
        F.col("name").alias("city"),
        cur["time"].alias("time"),
        cur["temperature_2m"].alias("temperature_c"),
        cur["relative_humidity_2m"].alias("humidity_pct"),
        cur["precipitation"].alias("precipitation_mm"),
        cur["wind_speed_10m"].alias("wind_kmh"),
        cur["weather_code"].alias("weather_code"),
    )
    rejects = joined.filter(F.col("reason").isNotNull()).select(
        *[c for c in keep if c in joined.columns], "pos", "reason",
        F.coalesce(F.col("raw"), F.to_json("p")).alias("entry"))
    return rows, rejects


def read_payloads(spark: SparkSession, paths, position: bool = True) -> DataFrame:
    """Landed payload files, one row per file (``value`` = whole JSON text); Spark passes over files of no bytes."""
    df = spark.read.text(paths, wholetext=True)
    return with_position(df) if position else df


def weather_rows(spark: SparkSession, paths) -> tuple[DataFrame, DataFrame]:
    rows, rejects = rows_from_payload(read_payloads(spark, paths), city_dim(spark))
    return rows.select(*[c for c in ("_pos",) if c in rows.columns], *WEATHER_FIELDS), rejects
