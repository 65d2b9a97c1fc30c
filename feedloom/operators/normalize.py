"""Text rows -> typed rows (P1-P9, A-4, A-11).

One place decides every type: blank text becomes NULL, the weather feed is cast strictly
(a bad reading is an error, as in the feed's own compaction), the event feed is cast
leniently (bad -> NULL) with the loss counted by ``audit.cast_loss``. Rows without a key or
a readable time are returned as rejects, never merged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.functions.casts import lenient_number, strict
from feedloom.functions.text import blank_to_null
from feedloom.functions.time import parse_compact_day, parse_stamp, parse_weather_time
from feedloom.schemas import EVENT_CASTS, EVENT_FIELDS, WEATHER_FIELDS

WEATHER_TYPES = {"temperature_c": "double", "humidity_pct": "double", "precipitation_mm": "double",
                 "wind_kmh": "double", "weather_code": "bigint"}


def _extras(df: DataFrame, known) -> list[str]:
    return [c for c in df.columns if c not in known]


def blanks_to_null(df: DataFrame, columns=None) -> DataFrame:
    cols = columns or [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    return df.withColumns({c: blank_to_null(c) for c in cols})


BAD = "_bad"   # flag column of the ``*_flagged`` normalisers: the row cannot be merged


def weather_flagged(raw: DataFrame) -> DataFrame:
    """Strict casts of the 7 weather columns, in table order (P1, P3), with ``_bad`` set on rows
    without a city or a time. One frame, so a consumer reads the landing once."""
    d = blanks_to_null(raw, [c for c in WEATHER_FIELDS if c in raw.columns])
    typed = d.select(
        F.col("city"),
        parse_weather_time(F.col("time").cast("string")).alias("time")
        if dict(d.dtypes)["time"] == "string" else F.col("time").cast("timestamp"),
        *[strict(c, t).alias(c) for c, t in WEATHER_TYPES.items()],
        *_extras(d, WEATHER_FIELDS),
    )
    return typed.withColumn(BAD, ~(F.col("city").isNotNull() & F.col("time").isNotNull()))


def weather(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(typed, rejects)`` (see ``weather_flagged``). Extra columns are kept."""
    t = weather_flagged(raw)
    return t.filter(~F.col(BAD)).drop(BAD), t.filter(F.col(BAD)).drop(BAD)


def events_flagged(raw: DataFrame) -> DataFrame:
    """Lenient casts of the 15 typed event columns; ``ts`` from DATEADDED, ``event_day`` from Day;
    ``_bad`` set on rows with no event id or an unreadable DATEADDED (A-11). Raw columns missing
    from a file (an older header) come back as NULL."""
    d = raw
    for c in EVENT_FIELDS:
        if c not in d.columns:
            d = d.withColumn(c, F.lit(None).cast("string"))
    d = blanks_to_null(d, EVENT_FIELDS)
    typed = d.select(
        *[lenient_number(c, EVENT_CASTS[c]).alias(c) if c in EVENT_CASTS else F.col(c) for c in EVENT_FIELDS],
        parse_stamp("DATEADDED").alias("ts"),
        parse_compact_day("Day").alias("event_day"),
        *_extras(d, EVENT_FIELDS),
    )
    return typed.withColumn(BAD, ~(F.col("GlobalEventID").isNotNull() & F.col("ts").isNotNull()))


def events(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(typed, rejects)`` (see ``events_flagged``)."""
    t = events_flagged(raw)
    return t.filter(~F.col(BAD)).drop(BAD), t.filter(F.col(BAD)).drop(BAD)
