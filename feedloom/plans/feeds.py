"""The two feeds end to end: landed raw files -> landing -> typed day table.

Weather: payload JSON files (one per pull) -> one CSV pull each in the landing -> strict
types -> day table partitioned by the reading's own day, one row per (city, time); a reading
stamped 23:45 that lands in the next day's pull still merges with its own day.

Events: zipped exports (one per quarter hour) -> CSV pulls in the landing under the export's
day -> lenient types -> day table partitioned by ``ingest_day``, one row per event id and day,
the newest DATEADDED winning, then the later pull.

Every step is a Spark job over files; nothing is read on the driver but file listings,
the touched-day list and counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from feedloom.operators import normalize
from feedloom.operators.dedup import with_position
from feedloom.operators.layout import land_partitioned
from feedloom.operators.merge import compact_days, merge_into_snapshot
from feedloom.schemas import EVENT_FIELDS, WEATHER_FIELDS
from feedloom.sources.csv import read_csv_by_header, read_event_csv, read_weather_csv
from feedloom.sources.files import day_of_stamp, stamp_of
from feedloom.sources.payload import city_dim, read_payloads, rows_from_payload
from feedloom.session import path_exists
from feedloom.sources.zipped import read_event_zips


def _landed(spark: SparkSession, landing: str, days: Sequence | None, read, columns, by_name: bool) -> DataFrame:
    """The landing's pulls, of some ingest days only by those days' folders (no other day is listed).

    Files of another header order are an error, or with ``by_name`` read by their own headers."""
    root = landing.rstrip("/")
    paths = root if days is None else [p for p in (f"{root}/ingest_day={d}" for d in days) if path_exists(spark, p) is not False]
    if by_name:
        paths = f"{root}/ingest_day=*" if days is None else paths
    if days is not None and not paths:
        none = ", ".join(f"{c} string" for c in [*columns, "stamp"])
        return with_position(spark.createDataFrame([], none + ", ingest_day date"))
    if by_name:
        return read_csv_by_header(spark, paths, [*columns, "stamp"], base_path=root)
    return read(spark, paths, basePath=root)


# --------------------------------------------------------------------------- weather

def land_weather_payloads(spark: SparkSession, payload_paths, landing: str) -> DataFrame:
    """Land each payload file as one CSV pull under ``ingest_day=<day of the pull>/stamp=<stamp>``.

    The pull's stamp is the 14-digit stamp in the payload file name. Returns what could
    not be landed: unreadable payloads, entries without a city, cities without an entry.
    """
    raw = read_payloads(spark, payload_paths, position=False).withColumn("stamp", stamp_of("_metadata.file_path"))
    return land_payloads(raw, landing)


def land_payloads(payloads: DataFrame, landing: str) -> DataFrame:
    """The same for payloads as rows (``value`` = the JSON text, ``stamp`` = the pull's)."""
    rows, rejects = rows_from_payload(payloads, city_dim(payloads.sparkSession), keep=("stamp",))
    land_partitioned(rows.select(*WEATHER_FIELDS, "stamp").withColumn("ingest_day", day_of_stamp(F.col("stamp"))),
                     landing)
    return rejects


def compact_weather(spark: SparkSession, landing: str, table: str, ingest_days: Sequence | None = None,
                    layout: str = "day", mode: str = "latest", by_name: bool = False) -> dict:
    """Landed weather pulls (optionally only some ingest days, e.g. today and yesterday) into
    the reading-day table (``layout="day"``) or the whole-history snapshot (``"snapshot"``):
    one row per (city, time), the later pull winning (``mode="latest"``) or the first kept."""
    raw = _landed(spark, landing, ingest_days, read_weather_csv, WEATHER_FIELDS, by_name)
    if layout == "snapshot":
        typed, bad = normalize.weather(raw)
        return merge_into_snapshot(spark, table, typed.select(*WEATHER_FIELDS, "_pos"), ["city", "time"],
                                   mode=mode, sort_by=["time", "city"], rejects=bad)
    typed = normalize.weather_flagged(raw)
    typed = typed.withColumn("day", F.to_date("time")).select(*WEATHER_FIELDS, "day", "_pos", normalize.BAD)
    return compact_days(spark, table, typed, ["city", "time"], day_col="day", cluster_by=["time", "city"],
                        reject_col=normalize.BAD, mode=mode)


# --------------------------------------------------------------------------- events

def land_event_exports(spark: SparkSession, pattern: str, landing: str) -> dict:
    """Unzip the exports matching ``pattern`` in tasks and land each as one CSV pull under its
    own day. Returns ``{"rows", "ragged"}``, counted while landing (the archives are read once);
    ragged rows (other than 61 fields) are cut or padded to 61, as the feed's own pull did, and their
    whole lines are kept under ``<landing>/_ragged``."""
    obs = Observation("landed")
    rows = read_event_zips(spark, pattern).observe(
        obs, F.count(F.lit(1)).alias("rows"), F.count_if(F.col("_nfields") != len(EVENT_FIELDS)).alias("ragged"))
    landed = rows.withColumn("ingest_day", day_of_stamp(F.col("stamp")))
    land_partitioned(landed.select(*EVENT_FIELDS, "ingest_day", "stamp"), landing)
    found = dict(obs.get)
    if found["ragged"]:
        bad = read_event_zips(spark, pattern).filter(F.col("_nfields") != len(EVENT_FIELDS))
        bad.select("stamp", "_file", "_line", "_nfields", "_raw").write.mode("append").json(f"{landing.rstrip('/')}/_ragged")
    return found


def compact_events(spark: SparkSession, landing: str, table: str, ingest_days: Sequence | None = None,
                   layout: str = "day", mode: str = "latest", by_name: bool = False) -> dict:
    """Landed event pulls of the given ingest days into the day table (C4, ``layout="day"``:
    one row per (ingest_day, GlobalEventID)) or the whole-history snapshot (``"snapshot"``: one
    row per GlobalEventID; ``mode="insert_only"`` keeps history rows and adds unseen ids). After a
    backfill ``mode="replace"`` makes the days those of the landing alone. Newest DATEADDED first, then the
    later pull; lines that do not fit the columns are kept with the rejects."""
    raw = _landed(spark, landing, ingest_days, read_event_csv, EVENT_FIELDS, by_name)
    if layout == "snapshot":
        typed, bad = normalize.events(raw)
        return merge_into_snapshot(spark, table, typed.drop("_corrupt_record", "stamp", "ingest_day"),
                                   "GlobalEventID", order=[F.desc("ts")], mode=mode, rejects=bad)
    typed = normalize.events_flagged(raw).drop("stamp")
    return compact_days(spark, table, typed, "GlobalEventID", order=[F.desc("ts")], day_col="ingest_day",
                        cluster_by=["GlobalEventID"], reject_col=normalize.BAD, mode=mode,
                        raw_col="_corrupt_record" if "_corrupt_record" in typed.columns else None)


def landed_events(spark: SparkSession, landing: str, ingest_days: Sequence | None = None) -> DataFrame:
    """The landing itself as typed event rows (every delivery, nothing de-duplicated), for queries over raw CSV."""
    typed, _ = normalize.events(_landed(spark, landing, ingest_days, read_event_csv, EVENT_FIELDS, False))
    return typed.drop("_corrupt_record", "stamp", "_pos")
