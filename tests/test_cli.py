"""The spark-submit jobs, run in-process on small landed files."""

import io
import json

from feedloom.__main__ import main
from feedloom.schemas import CITIES


def _payload(time, base):
    return [{"latitude": 0.5 * i, "longitude": -0.5 * i,
             "current": {"time": time, "interval": 300, "temperature_2m": base + i, "relative_humidity_2m": 71,
                         "precipitation": 0.1, "wind_speed_10m": 3.25, "weather_code": 2}}
            for i in range(len(CITIES))]


def _run(spark, *argv):
    out = io.StringIO()
    assert main(list(argv), spark=spark, out=out) == 0
    return [json.loads(x) for x in out.getvalue().splitlines()]


def test_weather_jobs(spark, tmp_path):
    pay = tmp_path / "payloads"
    pay.mkdir()
    for stamp, t, base in (("20260916191500", "2026-09-16T19:15", 10.0), ("20260916193000", "2026-09-16T19:30", 11.0)):
        (pay / f"{stamp}.json").write_text(json.dumps(_payload(t, base)))
    landing, table, ck = str(tmp_path / "landing"), str(tmp_path / "table"), str(tmp_path / "ck")
    assert _run(spark, "land-weather", "--payloads", str(pay), "--landing", landing) == [{"unmatched": 0}]
    _run(spark, "stream-compact", "--landing", landing, "--table", table, "--checkpoint", ck, "--feed", "weather")
    daily = _run(spark, "daily", "--table", table, "--city", "Bergen")[0]["daily"]
    assert daily == [{"city": "Bergen", "day": "2026-09-16", "mean_c": 18.5, "min_c": 18.0, "max_c": 19.0,
                      "rain_mm": 0.2, "readings": 2}]
    rows = _run(spark, "sql", "--table", table, "--view", "weather")[0]["rows"]
    assert len(rows) == 10 and all(r["readings"] == 2 for r in rows)
    rep = _run(spark, "compact-weather", "--landing", landing, "--table", table, "--days", "all")[0]
    assert rep["rows_after"] == 20
    assert _run(spark, "compact-weather", "--landing", landing, "--table", table)[0]["rows_in"] == 0  # none of today or yesterday
    few = _run(spark, "sql", "--table", table, "--limit", "3")[0]
    assert len(few["rows"]) == 3 and few["truncated"]
    out = str(tmp_path / "series")
    assert _run(spark, "series", "--table", table, "--out", out, "--as-of", "latest") == [{"written": out, "rows": 20}]
    one = str(tmp_path / "bergen")
    assert _run(spark, "series", "--table", table, "--out", one, "--city", "Bergen", "--as-of", "newest_partition")[0]["rows"] == 2


def test_event_jobs(spark, tmp_path):
    import zipfile
    from feedloom.schemas import EVENT_FIELDS

    def row(eid, added, tone, country, quad):
        r = [""] * len(EVENT_FIELDS)
        for k, v in (("GlobalEventID", str(eid)), ("Day", added[:8]), ("DATEADDED", added), ("AvgTone", tone),
                     ("ActionGeo_CountryCode", country), ("QuadClass", quad)):
            r[EVENT_FIELDS.index(k)] = v
        return "\t".join(r)

    z = tmp_path / "zips"
    z.mkdir()
    for stamp, rows in (("20260916100000", [row(1, "20260916100000", "1.0", "CA", "1"),
                                            row(2, "20260916100000", "3.0", "US", "4")]),
                        ("20260917101500", [row(3, "20260917101500", "-1.0", "CA", "1"),
                                            row(1, "20260917101500", "5.0", "CA", "2")])):
        with zipfile.ZipFile(z / f"{stamp}.export.CSV.zip", "w") as f:
            f.writestr("e.CSV", "\n".join(rows) + "\n")
    landing, table, ck = str(tmp_path / "landing"), str(tmp_path / "table"), str(tmp_path / "ck")
    assert _run(spark, "land-events", "--exports", str(z), "--landing", landing) == [{"rows": 4, "ragged": 0}]
    _run(spark, "stream-compact", "--landing", landing, "--table", table, "--checkpoint", ck)
    hourly = _run(spark, "hourly", "--table", table, "--country", "ca", "--as-of", "newest_partition", "--days", "3")
    assert [(h["h"], h["n"], h["tone"]) for h in hourly[0]["hourly"]] == [
        ("2026-09-16T10:00:00", 1, 1.0), ("2026-09-17T10:00:00", 2, 2.0)]
    raw = _run(spark, "hourly", "--landing", landing, "--country", "CA", "--as-of", "latest")[0]["hourly"]
    assert [(h["h"], h["n"]) for h in raw] == [("2026-09-16T10:00:00", 1), ("2026-09-17T10:00:00", 2)]
    dash = {k: v for d in _run(spark, "dashboard", "--table", table, "--top", "1", "--tone", "1") for k, v in d.items()}
    assert dash["totals"] == [{"rows_scanned": 4, "days": 2}]
    assert dash["top_countries"] == [{"country": "CA", "events": 3}]


def test_whole_history_snapshot_modes(spark, tmp_path):
    pay = tmp_path / "payloads"
    pay.mkdir()
    (pay / "20260916191500.json").write_text(json.dumps(_payload("2026-09-16T19:15", 10.0)))
    landing = str(tmp_path / "landing")
    _run(spark, "land-weather", "--payloads", str(pay), "--landing", landing)
    snap = str(tmp_path / "snap")
    r1 = _run(spark, "compact-weather", "--landing", landing, "--table", snap, "--layout", "snapshot", "--days", "all")[0]
    assert r1["rows_after"] == 10 and r1["rows_before"] == 0
    (pay / "20260916200000.json").write_text(json.dumps(_payload("2026-09-16T19:15", 50.0)))  # a correction
    land2 = str(tmp_path / "landing2")
    _run(spark, "land-weather", "--payloads", str(pay / "20260916200000.json"), "--landing", land2)
    keep = _run(spark, "compact-weather", "--landing", land2, "--table", snap, "--layout", "snapshot",
                "--days", "all", "--mode", "insert_only")[0]
    assert keep["rows_before"] == 10 and keep["rows_after"] == 10
    rows = _run(spark, "sql", "--table", snap, "--q", "SELECT max(temperature_c) AS t FROM weather")[0]["rows"]
    assert rows == [{"t": 19.0}]  # history won
    _run(spark, "compact-weather", "--landing", land2, "--table", snap, "--layout", "snapshot", "--days", "all")
    rows = _run(spark, "sql", "--table", snap, "--q", "SELECT max(temperature_c) AS t FROM weather")[0]["rows"]
    assert rows == [{"t": 59.0}]  # the batch won
