"""Late rows kept aside, closed and open hours, deltas from a stream, strict headers and ragged lines of a stream."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.operators.deltas import delta_days, read_merged
from feedloom.operators.layout import current_version, drop_versions, land, write_snapshot
from feedloom.sources.csv import CORRUPT
from feedloom.streaming import stream as st

COLS = ("id", "ts", "v", "stamp")
TEXT = T.StructType([T.StructField(c, T.StringType()) for c in COLS] + [T.StructField("ingest_day", T.DateType())])
T0 = dt.datetime(2026, 9, 1)


def _typed(df):
    return df.withColumns({"id": F.col("id").cast("bigint"), "v": F.col("v").cast("double"),
                           "ts": F.to_timestamp("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")})


def _pull(spark, root, stamp, recs):
    land(spark.createDataFrame(recs, "id bigint, ts timestamp, v double").coalesce(1), root, stamp)


def _recs(first, last, step=97):
    """Readings every ``step`` minutes of the days ``first`` to ``last``."""
    return [(k, T0 + dt.timedelta(minutes=step * k), float(k)) for k in range(first * 1440 // step, last * 1440 // step)]


SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("ts", T.TimestampType()), T.StructField("v", T.DoubleType()),
                       T.StructField("stamp", T.StringType()), T.StructField("ingest_day", T.DateType())])


def test_first_copies_and_late_rows_are_all_rows(spark, tmp_path):
    root, ok, late, out, c1, c2 = (str(tmp_path / n) for n in ("landing", "ok", "late", "out", "c1", "c2"))
    pulls = [_recs(0, 4), _recs(3, 8), [(k, t, -v) for k, t, v in _recs(0, 1)] + _recs(8, 12), [(9_999, T0, 1.0), (9_998, None, 1.0)] + _recs(11, 13)]

    def run():
        s = _typed(st.landed_stream(spark, root, TEXT, position=False))
        st.run_until_done(st.split_late(s, "ts", "2 days", ok, late, c1))
        rows = st.on_time_stream(spark, ok, SCHEMA)
        st.run_until_done(st.append_to_table(st.dedup_stream(rows, ["id"], "ts", "2 days"), out, c2))

    for k, recs in enumerate(pulls):  # each pull in a run of its own, state and watermark from the checkpoints
        _pull(spark, root, f"2026090{k + 1}000000", recs)
        run()
    run()
    kept = {r.id: r.v for r in spark.read.parquet(out).collect()}
    assert kept == {k: v for k, _, v in _recs(0, 13)} and spark.read.parquet(out).count() == len(kept)
    aside = sorted((r.id, r.v) for r in st.read_late(spark, late, SCHEMA).collect())
    assert aside == sorted([(k, -v) for k, _, v in _recs(0, 1)] + [(9_999, 1.0), (9_998, 1.0)])


def test_replayed_epoch_writes_its_places_again(spark, tmp_path, monkeypatch):
    root, ok, late, c1 = (str(tmp_path / n) for n in ("landing", "ok", "late", "c1"))
    stream = lambda: st.split_late(_typed(st.landed_stream(spark, root, TEXT, position=False)), "ts", "2 days", ok, late, c1)
    _pull(spark, root, "20260901000000", _recs(0, 5))
    st.run_until_done(stream())
    _pull(spark, root, "20260902000000", _recs(0, 1) + _recs(5, 6))
    st.run_until_done(stream())
    for f in ("1", ".1.crc"):  # the batch was written, its commit was not
        os.remove(os.path.join(c1, "commits", f))
    st.run_until_done(stream())
    assert st.read_late(spark, late, SCHEMA).count() == len(_recs(0, 1))
    assert spark.read.schema(SCHEMA).parquet(ok).count() == len(_recs(0, 6))


def test_closed_and_open_hours_give_the_batch_answer_at_any_moment(spark, tmp_path):
    root, closed, ck = (str(tmp_path / n) for n in ("landing", "closed", "ck"))
    landed = lambda: _typed(spark.read.schema(TEXT).option("header", "true").csv(root))
    emitted = 0
    for k in range(4):
        _pull(spark, root, f"2026090{k + 1}000000", _recs(2 * k, 2 * k + 2, 13))
        if k != 1:  # one landing is answered before any run
            s = _typed(st.landed_stream(spark, root, TEXT, position=False))
            st.run_until_done(st.append_to_table(st.hourly_stream(s, "ts", "v", "3 hours"), closed, ck))
            done = spark.read.parquet(closed)
            assert done.count() >= emitted and done.select("h").distinct().count() == done.count()
            emitted = done.count()
        want = landed().groupBy(F.date_trunc("hour", "ts").alias("h")).agg(F.count("*").alias("n"), F.avg("v").alias("tone"))
        got = st.hours_now(spark, closed, landed(), "ts", "v")
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert emitted > 150


def test_stream_writes_deltas_and_folds_them(spark, tmp_path):
    root, table, ck = (str(tmp_path / n) for n in ("landing", "table", "ck"))
    rows = [(k, T0 + dt.timedelta(minutes=k), k / 7) for k in range(600)]

    def run(share):
        q = st.compaction_query(st.landed_stream(spark, root, TEXT, max_files=1), table, "id", ck, order=[F.desc("ts")], normalise=_typed, fold_share=share)
        st.run_until_done(q)

    _pull(spark, root, "20260901000000", rows)
    run(0.5)  # no base yet: folded at once
    assert delta_days(spark, table) == set()
    base = {f: os.stat(os.path.join(table, "ingest_day=2026-09-01", f)).st_mtime_ns for f in os.listdir(os.path.join(table, "ingest_day=2026-09-01"))}
    _pull(spark, root, "20260901001500", [(3, rows[3][1], -1.0), (700, rows[5][1], 7.0)])
    _pull(spark, root, "20260901003000", [(3, rows[3][1], -2.0)])
    run(1.0)
    assert delta_days(spark, table) == {"2026-09-01"}
    assert base == {f: os.stat(os.path.join(table, "ingest_day=2026-09-01", f)).st_mtime_ns for f in os.listdir(os.path.join(table, "ingest_day=2026-09-01"))}
    got = {r.id: r.v for r in read_merged(spark, table, "id", [F.desc("ts")]).collect()}
    assert got == {**{k: v for k, _, v in rows}, 3: -2.0, 700: 7.0}


def test_stream_refuses_another_header_order(spark, tmp_path):
    root = tmp_path / "landing" / "ingest_day=2026-09-01"
    root.mkdir(parents=True)
    (root / "a.csv").write_text("v,id,ts,stamp\n2.0,1,2026-09-01T00:00:00.000000,20260901000000\n")
    s = st.landed_stream(spark, str(tmp_path / "landing"), TEXT, position=False)
    with pytest.raises(Exception, match="(?i)header|FAILED_READ_FILE"):
        st.run_until_done(st.append_to_table(s, str(tmp_path / "out"), str(tmp_path / "ck")))


def test_stream_keeps_ragged_lines(spark, tmp_path):
    root, table = tmp_path / "landing" / "ingest_day=2026-09-01", str(tmp_path / "t")
    root.mkdir(parents=True)
    (root / "a.csv").write_text("id,ts,v,stamp\n1,2026-09-01T00:00:00.000000,2.0,s\n2,2026-09-01T00:00:00.000000,2.0,s,more,fields\n")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*COLS, CORRUPT)] + [T.StructField("ingest_day", T.DateType())])
    s = st.landed_stream(spark, str(tmp_path / "landing"), schema)
    st.run_until_done(st.compaction_query(s, table, "id", str(tmp_path / "ck"), normalise=_typed, raw_col=CORRUPT))
    assert sorted(r.id for r in spark.read.parquet(table).collect()) == [1, 2]
    kept = spark.read.parquet(f"{table}/_rejects/batch=stream-0").collect()
    assert [r[CORRUPT] for r in kept] == ["2,2026-09-01T00:00:00.000000,2.0,s,more,fields"]


def test_versions_and_pointers_stay_few(spark, tmp_path):
    root = str(tmp_path / "s")
    for k in range(5):
        write_snapshot(spark.range(k + 1), root, ["id"])
        drop_versions(spark, root)
    assert current_version(spark, root, with_rows=True)[0::2] == (5, 5)
    assert sorted(os.listdir(root)) == ["_pointer", "_v=000004", "_v=000005"] and len([p for p in os.listdir(f"{root}/_pointer")]) == 2
