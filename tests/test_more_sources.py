"""Archives streamed line by line, gaps of a landing as runs, nested series, files by header."""

import datetime as dt
import io
import zipfile

from pyspark.sql import functions as F

from feedloom.operators.audit import landing_gaps
from feedloom.operators.layout import list_files
from feedloom.plans.series import nested_series, unnested
from feedloom.sources import zipped
from feedloom.sources.csv import read_csv_by_header


def test_members_are_streamed_in_blocks(monkeypatch):
    import pandas as pd
    monkeypatch.setattr(zipped, "LINES", 10)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("a", b"".join(b"%d\x85\tx\r\n\n" % k for k in range(95)))
        z.writestr("b", b"last \xff line, no feed")
    got = list(zipped._unzip(iter([pd.DataFrame({"path": ["p"], "content": [out.getvalue()]})])))
    assert max(len(g) for g in got) == 10 and len(got) == 11
    rows = pd.concat(got)
    assert rows[rows._member == "a"]._line.tolist() == list(range(0, 190, 2))
    assert rows._raw.iloc[3] == "3�\tx" and rows._raw.iloc[-1] == "last � line, no feed"


def test_landing_gaps_join_over_midnight(spark, tmp_path):
    have = [dt.datetime(2026, 9, 1, 1), dt.datetime(2026, 9, 1, 2), dt.datetime(2026, 9, 1, 5), dt.datetime(2026, 9, 4, 23)]
    for t in have:
        (tmp_path / f"{t:%Y%m%d%H%M%S}.export.zip").write_bytes(b"x")
    for name in ("readme.txt", "20260831230000.zip", "20269931230000.zip"):
        (tmp_path / name).write_bytes(b"x")
    got = landing_gaps(list_files(spark, str(tmp_path)), dt.date(2026, 9, 1), dt.date(2026, 9, 5), 60)
    d = lambda day, h: dt.datetime(2026, 9, day, h)
    assert sorted(map(tuple, got.collect())) == [(d(1, 0), d(1, 0), 1), (d(1, 3), d(1, 4), 2), (d(1, 6), d(4, 22), 89), (d(5, 0), d(5, 23), 24)]
    none = landing_gaps(list_files(spark, str(tmp_path)).limit(0), dt.date(2026, 9, 1), dt.date(2026, 9, 2), 15)
    assert sorted(map(tuple, none.collect())) == [(d(1, 0), dt.datetime(2026, 9, 2, 23, 45), 192)]


def test_nested_series_are_sorted_and_bounded(spark):
    rows = [(f"c{k % 3}", dt.datetime(2026, 9, 1) + dt.timedelta(minutes=15 * ((k * 7) % 500)), float(k)) for k in range(500)]
    df = spark.createDataFrame(rows, "city string, time timestamp_ntz, v double")
    nested = nested_series(df, value="v", minutes=360)
    for r in nested.collect():
        times = [p.time for p in r.points]
        assert times == sorted(times) and len(times) <= 24 and all(r.chunk <= t < r.chunk + dt.timedelta(hours=6) for t in times)
    assert sorted(map(tuple, unnested(nested).collect())) == sorted(rows)


def test_files_by_header_are_scanned_not_joined(spark, tmp_path):
    (tmp_path / "a b.csv").write_text('id,"x,y",stamp\n1,2,s1\n')
    (tmp_path / "c.csv").write_text('﻿stamp,id\r\ns2,7\r\n\r\nshort\r\n', encoding="utf-8")
    (tmp_path / "empty.csv").write_text("")
    df = read_csv_by_header(spark, f"{tmp_path}/*.csv", ["id", "x,y", "stamp"])
    assert sorted((r.id or "", r["x,y"], r.stamp) for r in df.collect()) == [("", None, "short"), ("1", "2", "s1"), ("7", None, "s2")]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    assert df.select(F.col("_pos.stamp")).distinct().count() == 3
