"""One row per key over all days; maintained roll-ups."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from feedloom.operators import crossday, manifest
from feedloom.operators.crossday import compact_days_across, index_path, index_table
from feedloom.operators.deltas import append_delta
from feedloom.operators.merge import compact_days
from feedloom.plans import rollup

SCHEMA = "id bigint, v double, ts timestamp_ntz, ingest_day date"
D = [dt.date(2026, 3, k) for k in range(1, 9)]


def row(k, v, day, hour=0):
    return (k, float(v), dt.datetime.combine(day, dt.time(hour, 30)), day)


def _df(spark, recs):
    return spark.createDataFrame(recs, SCHEMA)


def _table(spark, path):
    return {r.id: (r.v, r.ingest_day) for r in spark.read.parquet(path).collect()}


def _files(path, days):
    out = {}
    for d in days:
        for f in os.listdir(os.path.join(path, f"ingest_day={d}")):
            out[f"{d}/{f}"] = os.stat(os.path.join(path, f"ingest_day={d}", f)).st_mtime_ns
    return out


BASE = [row(k, k, D[k // 20], k % 24) for k in range(100)]  # five days, ids grow with time


@pytest.mark.parametrize("mode", ["latest", "insert_only"])
def test_keys_are_unique_over_all_days(spark, tmp_path, mode):
    table = str(tmp_path / "t")
    compact_days_across(spark, table, _df(spark, BASE), "id", file_rows=10)
    untouched = _files(table, [D[0], D[2]])
    batch = [row(25, -1, D[5]), row(26, -2, D[1]), row(70, -3, D[4]), row(200, -4, D[5]), row(200, -5, D[6])]
    report = compact_days_across(spark, table, _df(spark, batch + [(None, 0.0, None, D[0])]), "id", order=[F.desc("ts")], mode=mode, file_rows=10)
    got = _table(spark, table)
    want = {k: (v, d) for k, v, _, d in BASE}
    new = {25: (-1.0, D[5]), 26: (-2.0, D[1]), 70: (-3.0, D[4]), 200: (-5.0, D[6])}
    want = {**want, **new} if mode == "latest" else {**new, **want}
    assert got == want and spark.read.parquet(table).count() == len(want)
    assert report["days"] == ([D[1], D[3], D[4], D[5], D[6]] if mode == "latest" else [D[6]])
    assert _files(table, [D[0], D[2]]) == untouched and report["rejects"] == 1
    index = {r.id: r.ingest_day for r in manifest.read(spark, index_path(table)).collect()}
    assert index == {k: d for k, (_, d) in want.items()}
    again = compact_days_across(spark, table, _df(spark, batch), "id", order=[F.desc("ts")], mode=mode, file_rows=10)
    assert _table(spark, table) == want and again["rows_after"] == again["rows_before"]


def test_a_day_whose_rows_all_move_goes(spark, tmp_path):
    table = str(tmp_path / "t")
    compact_days_across(spark, table, _df(spark, BASE), "id")
    report = compact_days_across(spark, table, _df(spark, [row(k, 7, D[6]) for k in range(20)]), "id")
    assert report["emptied"] == [str(D[0])] and not os.path.exists(os.path.join(table, f"ingest_day={D[0]}"))
    assert len(_table(spark, table)) == 100 == spark.read.parquet(table).count()


def test_failure_before_the_index_is_mended_by_the_replay(spark, tmp_path, monkeypatch):
    table = str(tmp_path / "t")
    compact_days_across(spark, table, _df(spark, BASE), "id")
    batch = _df(spark, [row(5, -1, D[6]), row(300, -1, D[7])])

    def fails(*a, **k):
        raise OSError("store is away")

    monkeypatch.setattr(crossday.manifest, "merge", fails)
    with pytest.raises(OSError):
        compact_days_across(spark, table, batch, "id")
    monkeypatch.undo()
    for _ in range(2):
        compact_days_across(spark, table, batch, "id")
        got = _table(spark, table)
        assert got[5] == (-1.0, D[6]) and got[300] == (-1.0, D[7]) and spark.read.parquet(table).count() == 101
    compact_days_across(spark, table, _df(spark, [row(5, 9, D[2])]), "id")
    assert _table(spark, table)[5] == (9.0, D[2]) and spark.read.parquet(table).count() == 101


def test_index_of_an_existing_table_and_deltas(spark, tmp_path):
    table = str(tmp_path / "t")
    compact_days(spark, table, _df(spark, BASE), "id")
    index_table(spark, table, "id", file_rows=10)
    append_delta(spark, table, _df(spark, [row(3, 33, D[0])]), "id")
    report = compact_days_across(spark, table, _df(spark, [row(4, 44, D[1])]), "id")
    assert report["days"] == [D[0], D[1]]
    got = _table(spark, table)
    assert got[3] == (33.0, D[0]) and got[4] == (44.0, D[1]) and spark.read.parquet(table).count() == 100


def test_lookups_open_only_index_files_in_range(spark, tmp_path):
    table = str(tmp_path / "t")
    compact_days_across(spark, table, _df(spark, BASE), "id", file_rows=10)
    met = crossday._met(spark, table, _df(spark, [row(95, 0, D[5]), row(99, 0, D[5])]).drop("ts"), ["id"], "id")
    assert len(met.inputFiles()) < manifest.files(spark, index_path(table)).count() / 2 and met.count() == 2


def test_rollup_follows_the_report(spark, tmp_path):
    table, roll, names = (str(tmp_path / n) for n in ("t", "r", "d"))
    rows = [row(k, k * 0.1, D[k % 3], k % 5) for k in range(60)] + [row(100, float("nan"), D[0], 23), row(101, 1e300, D[1], 22)]
    days = compact_days(spark, table, _df(spark, rows), "id")["days"]
    rollup.refresh(spark, table, roll, days, value="v", group="id", distinct="id")
    rollup.refresh_distinct(spark, table, names, days, "id")
    before = _files(roll, [D[0], D[2]]) | _files(names, [D[0], D[2]])
    report = compact_days(spark, table, _df(spark, [row(1, 50.0, D[1], 4), row(500, 2.0, D[1], 9)]), "id")
    rollup.refresh(spark, table, roll, report["days"], value="v", group="id", distinct="id")
    rollup.refresh_distinct(spark, table, names, report["days"], "id")
    assert report["days"] == [D[1]] and _files(roll, [D[0], D[2]]) | _files(names, [D[0], D[2]]) == before
    kept = spark.read.parquet(roll)
    got = {(r.h, r.n, str(r.tone)) for r in rollup.hourly_rollup(kept, days=30, digits=6).collect()}
    t = spark.read.parquet(table)
    want = {(r.h, r.n, str(r.tone)) for r in t.groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("h")).agg(
        F.count("*").alias("n"), F.round(F.avg("v"), 6).alias("tone")).collect()}
    assert got == want
    assert [r.distinct for r in rollup.combined(kept, []).collect()] == [63]
    assert rollup.distinct_exact(spark.read.parquet(names)).first().distinct == 63
    per_day = {r.ingest_day: r.distinct for r in rollup.distinct_exact(spark.read.parquet(names), ["ingest_day"]).collect()}
    assert per_day == {D[0]: 21, D[1]: 22, D[2]: 20}


def test_rollup_days_that_vanish(spark, tmp_path):
    table, roll = str(tmp_path / "t"), str(tmp_path / "r")
    days = compact_days_across(spark, table, _df(spark, BASE), "id")["days"]
    rollup.refresh(spark, table, roll, days, value="v")
    report = compact_days_across(spark, table, _df(spark, [row(k, 7, D[6]) for k in range(20)]), "id")
    rollup.refresh(spark, table, roll, report["days"], value="v")
    assert spark.read.parquet(roll).agg(F.sum("n")).first()[0] == 100 and f"ingest_day={D[0]}" not in os.listdir(roll)
