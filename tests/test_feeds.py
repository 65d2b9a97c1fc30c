"""Both feeds end to end on small landed files, plus backfill and JSON output."""

import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from feedloom.operators.layout import backfill_day, land, to_json_rows
from feedloom.plans.feeds import compact_events, compact_weather, land_event_exports, land_weather_payloads
from feedloom.plans.series import daily_summary
from feedloom.schemas import CITIES, EVENT_FIELDS, WEATHER_FIELDS
from feedloom.sources.csv import read_text_csv


def _payload(time, base):
    return [{"latitude": 0.25 * i, "longitude": 0.75 * i,
             "current": {"time": time, "interval": 300, "temperature_2m": base + i, "relative_humidity_2m": 52,
                         "precipitation": 0.2 * i, "wind_speed_10m": 1.5, "weather_code": 45}}
            for i in range(len(CITIES))]


def test_weather_feed_end_to_end(spark, tmp_path):
    pay = tmp_path / "payloads"
    pay.mkdir()
    (pay / "20260916234500.json").write_text(json.dumps(_payload("2026-09-16T23:45", 10.0)))
    # the 23:45 reading again, pulled after midnight with a corrected value, in the next day's pull
    (pay / "20260917000100.json").write_text(json.dumps(_payload("2026-09-16T23:45", 20.0)))
    (pay / "20260917001500.json").write_text(json.dumps(_payload("2026-09-17T00:15", 30.0)))
    landing, table = str(tmp_path / "landing"), str(tmp_path / "table")
    assert land_weather_payloads(spark, str(pay), landing).count() == 0
    rep = compact_weather(spark, landing, table)
    assert rep["rows_after"] == 20 and rep["partitions"] == 2
    t = spark.read.parquet(table)
    assert t.columns == ["city", "time", "temperature_c", "humidity_pct", "precipitation_mm", "wind_kmh",
                         "weather_code", "day"]
    v = {(r.city, str(r.time)): r.temperature_c for r in t.collect()}
    assert v[("Vancouver", "2026-09-16 23:45:00")] == 20.0  # the later pull wins, in its own day
    assert t.filter("day = '2026-09-16'").count() == 10
    ds = {(r.city, str(r.day)): r for r in daily_summary(t).collect()}
    assert ds[("Bergen", "2026-09-16")].readings == 1 and ds[("Bergen", "2026-09-16")].rain_mm == 1.6
    # replaying the same landing changes nothing
    compact_weather(spark, landing, table, ingest_days=["2026-09-17"])
    assert spark.read.parquet(table).count() == 20


def _export(rows):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("x.export.CSV", "\n".join("\t".join(r) for r in rows) + "\n")
    return buf.getvalue()


def _event(eid, added, tone, country="CA"):
    r = [""] * len(EVENT_FIELDS)
    r[EVENT_FIELDS.index("GlobalEventID")] = str(eid)
    r[EVENT_FIELDS.index("Day")] = added[:8]
    r[EVENT_FIELDS.index("DATEADDED")] = added
    r[EVENT_FIELDS.index("AvgTone")] = tone
    r[EVENT_FIELDS.index("ActionGeo_CountryCode")] = country
    r[EVENT_FIELDS.index("SOURCEURL")] = 'http://x/"a",b'
    return r


def test_event_feed_end_to_end(spark, tmp_path):
    z = tmp_path / "zips"
    z.mkdir()
    (z / "20260916000000.export.CSV.zip").write_bytes(_export(
        [_event(1, "20260916000000", "1.5"), _event(2, "20260916000000", "abc"), _event(3, "bad", "2")]))
    (z / "20260916001500.export.CSV.zip").write_bytes(_export(
        [_event(1, "20260916001500", "-3.0"), _event(4, "20260916001500", "4", "")]))
    (z / "20260917000000.export.CSV.zip").write_bytes(_export([_event(1, "20260917000000", "9")]))
    landing, table = str(tmp_path / "landing"), str(tmp_path / "table")
    landed = land_event_exports(spark, str(z), landing)
    assert landed == {"rows": 6, "ragged": 0}
    rep = compact_events(spark, landing, table)
    assert rep["rejects"] == 1 and rep["partitions"] == 2
    t = spark.read.parquet(table)
    assert t.columns == EVENT_FIELDS + ["ts", "event_day", "ingest_day"]
    got = {(str(r.ingest_day), r.GlobalEventID): r.AvgTone for r in t.collect()}
    assert got == {("2026-09-16", 1): -3.0, ("2026-09-16", 2): None, ("2026-09-16", 4): 4.0,
                   ("2026-09-17", 1): 9.0}
    assert t.filter("GlobalEventID = 1").select("SOURCEURL").first()[0] == 'http://x/"a",b'
    assert spark.read.parquet(f"{table}/_rejects").count() == 1


def test_backfill_replaces_one_landing_day_only(spark, tmp_path):
    root = str(tmp_path / "landing")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    land(df, root, "20260916000000")
    land(df, root, "20260917000000")
    new = spark.createDataFrame([(9, "z", "20260916120000", "2026-09-16")],
                                "id int, v string, stamp string, ingest_day string")
    backfill_day(new.withColumn("ingest_day", F.to_date("ingest_day")), root)
    back = read_text_csv(spark, root, ["id", "v", "stamp"], basePath=root)
    got = sorted((str(r.ingest_day), r.id) for r in back.collect())
    assert got == [("2026-09-16", "9"), ("2026-09-17", "1"), ("2026-09-17", "2")]


def test_a_row_that_the_backfill_lacks_leaves_the_table(spark, tmp_path):
    z = tmp_path / "zips"
    z.mkdir()
    (z / "20310203000000.export.CSV.zip").write_bytes(_export([_event(k, "20310203000000", "1") for k in (1, 2, 3)]))
    landing, table = str(tmp_path / "landing"), str(tmp_path / "table")
    land_event_exports(spark, str(z), landing)
    compact_events(spark, landing, table)
    fields = [F.lit(v).alias(c) for c, v in zip(EVENT_FIELDS, _event(2, "20310203000000", "5"))]
    backfill_day(spark.range(1).select(*fields, F.lit("20310203120000").alias("stamp"), F.lit("2031-02-03").cast("date").alias("ingest_day")), landing)
    compact_events(spark, landing, table, ingest_days=["2031-02-03"], mode="replace")
    assert [(r.GlobalEventID, r.AvgTone) for r in spark.read.parquet(table).collect()] == [(2, 5.0)]


def test_ragged_lines_are_kept_whole(spark, tmp_path):
    z = tmp_path / "zips"
    z.mkdir()
    wide = [*_event(1, "20310203000000", "1"), "one field", "too many"]
    (z / "20310203000000.export.CSV.zip").write_bytes(_export([wide, _event(2, "20310203000000", "1")]))
    landing = str(tmp_path / "landing")
    assert land_event_exports(spark, str(z), landing) == {"rows": 2, "ragged": 1}
    kept = spark.read.json(f"{landing}/_ragged").first()
    assert kept["_raw"] == "\t".join(wide) and kept["_nfields"] == 63


def test_landed_files_of_another_header_order(spark, tmp_path):
    """By position they are refused, by name read right."""
    day = tmp_path / "landing" / "ingest_day=2031-02-03"
    day.mkdir(parents=True)
    cols = ["stamp", *reversed(WEATHER_FIELDS)]
    row = {"city": "Bergen", "time": "2031-02-03T04:15", "temperature_c": "1.5", "humidity_pct": "50", "precipitation_mm": "0",
           "wind_kmh": "2", "weather_code": "3", "stamp": "20310203041500"}
    (day / "a.csv").write_text(",".join(cols) + "\n" + ",".join(row[c] for c in cols) + "\n")
    (day / "b.csv").write_text(",".join(row) + "\n" + ",".join({**row, "stamp": "20310203050000", "temperature_c": "9"}.values()) + "\n")
    landing, table = str(tmp_path / "landing"), str(tmp_path / "table")
    with pytest.raises(Exception, match="header"):
        compact_weather(spark, landing, table)
    compact_weather(spark, landing, table, by_name=True)
    assert [(r.city, r.temperature_c, r.wind_kmh) for r in spark.read.parquet(table).collect()] == [("Bergen", 9.0, 2.0)]


def test_rows_as_json(spark):
    df = spark.createDataFrame([("Bergen", 11.5)], "city string, t double")
    assert json.loads(to_json_rows(df).first().json) == {"city": "Bergen", "t": 11.5}
