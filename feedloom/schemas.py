"""Explicit schemas for every table the library reads or writes.

No reader infers types: raw files are read with these schemas (event files all-string,
then cast leniently in one normalise step) and Parquet carries the types after that.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# These must equal the feeds' own definitions for results to match.
# ---------------------------------------------------------------------------

# Weather day-file columns, in file order.
WEATHER_FIELDS = ["city", "time", "temperature_c", "humidity_pct", "precipitation_mm", "wind_kmh", "weather_code"]

# The ten cities of the weather feed, in the order the payload lists them: name, latitude, longitude.
CITIES = [
    ("Vancouver", 49.2827, -123.1207), ("Victoria", 48.4284, -123.3656), ("Kelowna", 49.8880, -119.4960),
    ("Prince George", 53.9171, -122.7497), ("Whistler", 50.1163, -122.9574), ("Toronto", 43.6532, -79.3832),
    ("Montreal", 45.5019, -73.5674), ("Calgary", 51.0447, -114.0719), ("Bergen", 60.3913, 5.3221),
    ("Reykjavik", 64.1466, -21.9426),
]

# World-event export columns, in file order (61 names).
EVENT_FIELDS = [
    "GlobalEventID", "Day", "MonthYear", "Year", "FractionDate",
    "Actor1Code", "Actor1Name", "Actor1CountryCode", "Actor1KnownGroupCode", "Actor1EthnicCode",
    "Actor1Religion1Code", "Actor1Religion2Code", "Actor1Type1Code", "Actor1Type2Code", "Actor1Type3Code",
    "Actor2Code", "Actor2Name", "Actor2CountryCode", "Actor2KnownGroupCode", "Actor2EthnicCode",
    "Actor2Religion1Code", "Actor2Religion2Code", "Actor2Type1Code", "Actor2Type2Code", "Actor2Type3Code",
    "IsRootEvent", "EventCode", "EventBaseCode", "EventRootCode", "QuadClass", "GoldsteinScale",
    "NumMentions", "NumSources", "NumArticles", "AvgTone",
    "Actor1Geo_Type", "Actor1Geo_Fullname", "Actor1Geo_CountryCode", "Actor1Geo_ADM1Code", "Actor1Geo_ADM2Code",
    "Actor1Geo_Lat", "Actor1Geo_Long", "Actor1Geo_FeatureID",
    "Actor2Geo_Type", "Actor2Geo_Fullname", "Actor2Geo_CountryCode", "Actor2Geo_ADM1Code", "Actor2Geo_ADM2Code",
    "Actor2Geo_Lat", "Actor2Geo_Long", "Actor2Geo_FeatureID",
    "ActionGeo_Type", "ActionGeo_Fullname", "ActionGeo_CountryCode", "ActionGeo_ADM1Code", "ActionGeo_ADM2Code",
    "ActionGeo_Lat", "ActionGeo_Long", "ActionGeo_FeatureID", "DATEADDED", "SOURCEURL",
]

# The 15 event columns that are typed; every other event column stays a string.
EVENT_CASTS = {
    "GlobalEventID": "bigint", "Day": "bigint", "IsRootEvent": "bigint", "QuadClass": "bigint",
    "GoldsteinScale": "double", "NumMentions": "bigint", "NumSources": "bigint", "NumArticles": "bigint",
    "AvgTone": "double", "Actor1Geo_Lat": "double", "Actor1Geo_Long": "double",
    "Actor2Geo_Lat": "double", "Actor2Geo_Long": "double", "ActionGeo_Lat": "double", "ActionGeo_Long": "double",
}

# QuadClass code -> label.
QUAD_LABELS = {1: "verbal coop", 2: "material coop", 3: "verbal conflict", 4: "material conflict"}

# Time formats of the feeds (Spark datetime patterns).
WEATHER_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm"
EVENT_STAMP_FORMAT = "yyyyMMddHHmmss"
EVENT_DAY_FORMAT = "yyyyMMdd"

# ---------------------------------------------------------------------------

_SPARK_TYPES = {"bigint": T.LongType(), "double": T.DoubleType(), "string": T.StringType()}

# Raw weather day file: every column text so a bad value is seen, not guessed.
WEATHER_RAW = T.StructType([T.StructField(c, T.StringType(), True) for c in WEATHER_FIELDS])

# Typed weather table, in table order.
WEATHER = T.StructType([
    T.StructField("city", T.StringType(), True),
    T.StructField("time", T.TimestampType(), True),
    T.StructField("temperature_c", T.DoubleType(), True),
    T.StructField("humidity_pct", T.DoubleType(), True),
    T.StructField("precipitation_mm", T.DoubleType(), True),
    T.StructField("wind_kmh", T.DoubleType(), True),
    T.StructField("weather_code", T.LongType(), True),
])

# Raw event export / day file: all 61 columns as text.
EVENTS_RAW = T.StructType([T.StructField(c, T.StringType(), True) for c in EVENT_FIELDS])

# Typed event table: 15 typed columns, the rest text, plus derived time columns.
EVENTS = T.StructType(
    [T.StructField(c, _SPARK_TYPES[EVENT_CASTS.get(c, "string")], True) for c in EVENT_FIELDS]
    + [T.StructField("ts", T.TimestampType(), True), T.StructField("event_day", T.DateType(), True)]
)

# Weather feed payload: one object per location, readings under ``current``.
WEATHER_PAYLOAD = T.ArrayType(T.StructType([
    T.StructField("latitude", T.DoubleType(), True),
    T.StructField("longitude", T.DoubleType(), True),
    T.StructField("current", T.StructType([
        T.StructField("time", T.StringType(), True),
        T.StructField("interval", T.LongType(), True),
        T.StructField("temperature_2m", T.DoubleType(), True),
        T.StructField("relative_humidity_2m", T.DoubleType(), True),
        T.StructField("precipitation", T.DoubleType(), True),
        T.StructField("wind_speed_10m", T.DoubleType(), True),
        T.StructField("weather_code", T.LongType(), True),
    ]), True),
]))

CITY_DIM = T.StructType([
    T.StructField("pos", T.IntegerType(), False),
    T.StructField("name", T.StringType(), False),
    T.StructField("latitude", T.DoubleType(), False),
    T.StructField("longitude", T.DoubleType(), False),
])

# One row per job run: what was read and written (the feed jobs printed this as JSON).
RUN_LOG = T.StructType([
    T.StructField("run_at", T.TimestampType(), False),
    T.StructField("job", T.StringType(), False),
    T.StructField("target", T.StringType(), True),
    T.StructField("rows_before", T.LongType(), True),
    T.StructField("rows_in", T.LongType(), True),
    T.StructField("rows_after", T.LongType(), True),
    T.StructField("rejects", T.LongType(), True),
    T.StructField("partitions", T.LongType(), True),
    T.StructField("bytes", T.LongType(), True),
])
