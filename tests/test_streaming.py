"""Streams over the landing give the batch answer."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.operators.layout import land, read_snapshot
from feedloom.streaming import stream as st

TEXT = T.StructType([T.StructField(c, T.StringType()) for c in ("id", "ts", "v", "stamp")]
                    + [T.StructField("ingest_day", T.DateType())])


def _typed(df):
    return df.withColumns({"id": F.col("id").cast("bigint"), "v": F.col("v").cast("double"),
                           "ts": F.to_timestamp("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")})


def _pull(spark, root, stamp, recs):
    df = spark.createDataFrame(recs, "id bigint, ts timestamp, v double")
    land(df.coalesce(1), root, stamp)


def _recs(day, n, base=0.0):
    t0 = dt.datetime.combine(day, dt.time())
    return [(i, t0 + dt.timedelta(minutes=7 * i), base + i) for i in range(n)]


D1, D2 = dt.date(2026, 9, 16), dt.date(2026, 9, 17)


def test_compaction_stream_over_several_micro_batches(spark, tmp_path):
    root, table, ck = (str(tmp_path / n) for n in ("landing", "table", "ck"))
    _pull(spark, root, "20260916120000", _recs(D1, 50))
    _pull(spark, root, "20260916180000", _recs(D1, 10, base=100.0))  # a re-sent part of day one
    _pull(spark, root, "20260917000000", [(r[0] + 1000, *r[1:]) for r in _recs(D2, 20)])
    _pull(spark, root, "20260917001500", [(1005, dt.datetime(2026, 9, 17, 0, 35), -1.0)])
    s = st.landed_stream(spark, root, TEXT, max_files=1)
    q = st.compaction_query(s, table, "id", ck, order=[F.desc("ts")], normalise=_typed)
    st.run_until_done(q)
    got = {(r.ingest_day, r.id): r.v for r in spark.read.parquet(table).collect()}
    assert len(got) == 50 + 20  # day two's ids live under their own ingest day
    assert got[(D1, 3)] == 103.0 and got[(D1, 40)] == 40.0  # the later pull wins
    assert got[(D2, 1005)] == -1.0
    runs = spark.read.parquet(f"{table}/_runs").count()
    assert runs == 4  # one compaction per micro-batch (one file each)


def test_dedup_stream_equals_batch_distinct(spark, tmp_path):
    root, out, ck = (str(tmp_path / n) for n in ("landing", "out", "ck"))
    recs = _recs(D1, 40)
    _pull(spark, root, "20260916120000", recs)
    _pull(spark, root, "20260916121500", recs[30:])  # a repeated delivery
    typed = _typed(st.landed_stream(spark, root, TEXT, position=False))
    st.run_until_done(st.append_to_table(st.dedup_stream(typed, ["id"], "ts"), out, ck))
    assert spark.read.parquet(out).count() == 40


def test_hourly_stream_complete_equals_batch_and_append_holds_open_hours(spark, tmp_path):
    root = str(tmp_path / "landing")
    recs = _recs(D1, 60)
    _pull(spark, root, "20260916120000", recs)
    typed = _typed(st.landed_stream(spark, root, TEXT, position=False))
    out, ck = str(tmp_path / "h"), str(tmp_path / "ck")
    st.run_until_done(st.complete_to_table(st.hourly_stream(typed, "ts", "v"), out, ck))
    batch = (spark.createDataFrame(recs, "id bigint, ts timestamp, v double")
             .groupBy(F.date_trunc("hour", "ts").alias("h")).agg(F.count(F.lit(1)).alias("n"), F.avg("v").alias("tone")))
    got = read_snapshot(spark, out)
    assert got.count() == batch.count() and got.exceptAll(batch.select(*got.columns)).count() == 0
    out2, ck2 = str(tmp_path / "h2"), str(tmp_path / "ck2")
    st.run_until_done(st.append_to_table(st.hourly_stream(typed, "ts", "v", delay="1 hour"), out2, ck2))
    assert spark.read.parquet(out2).count() < batch.count()  # open hours are held back


def test_latest_and_distinct_streams(spark, tmp_path):
    root = str(tmp_path / "landing")
    _pull(spark, root, "20260916120000", _recs(D1, 30))
    typed = _typed(st.landed_stream(spark, root, TEXT, position=False)).withColumn("g", F.col("id") % 3)
    out, ck = str(tmp_path / "l"), str(tmp_path / "ck")
    st.run_until_done(st.complete_to_table(st.latest_stream(typed, "g", "v", "ts"), out, ck))
    assert {r.g: r.last_value for r in read_snapshot(spark, out).collect()} == {0: 27.0, 1: 28.0, 2: 29.0}
    out2, ck2 = str(tmp_path / "d"), str(tmp_path / "ck2")
    st.run_until_done(st.complete_to_table(st.distinct_stream(typed, "id"), out2, ck2))
    r = read_snapshot(spark, out2).first()
    assert r.rows == 30 and abs(r.distinct_approx - 30) <= 2


def test_dedup_stream_pre_reduces_a_hot_key(spark, tmp_path):
    root, out, ck = (str(tmp_path / n) for n in ("landing", "out", "ck"))
    recs = _recs(D1, 60)
    hot = [(7, r[1], r[2]) for r in recs]  # one key delivered in every row of a pull
    _pull(spark, root, "20260916120000", recs)
    _pull(spark, root, "20260916121500", hot)
    typed = _typed(st.landed_stream(spark, root, TEXT, position=False))
    st.run_until_done(st.append_to_table(st.dedup_stream(typed, ["id"], "ts", pre_reduce=True), out, ck))
    got = spark.read.parquet(out)
    assert got.count() == 60 and got.select("id").distinct().count() == 60


def test_compaction_stream_restarts_from_its_checkpoint(spark, tmp_path):
    root, table, ck = (str(tmp_path / n) for n in ("landing", "table", "ck"))
    _pull(spark, root, "20260916120000", _recs(D1, 30))
    run = lambda: st.run_until_done(st.compaction_query(
        st.landed_stream(spark, root, TEXT), table, "id", ck, order=[F.desc("ts")], normalise=_typed))
    run()
    first = spark.read.parquet(f"{table}/_runs").count()
    _pull(spark, root, "20260916180000", _recs(D1, 5, base=100.0))  # lands while the stream is down
    run()                                                            # restart: only the new pull is read
    runs = spark.read.parquet(f"{table}/_runs").orderBy("run_at").collect()
    assert first == 1 and len(runs) == 2 and runs[-1].rows_in == 5
    got = {r.id: r.v for r in spark.read.parquet(table).collect()}
    assert len(got) == 30 and got[2] == 102.0 and got[20] == 20.0
    run()                                                            # nothing new: no batch, same table
    assert spark.read.parquet(f"{table}/_runs").count() == 2


def test_no_late_row_is_lost_by_the_insert_only_stream(spark, tmp_path):
    """Six micro-batches, newest day first: later than any watermark, and one pull twice."""
    root, table, ck = (str(tmp_path / n) for n in ("landing", "table", "ck"))
    days = [D1 + dt.timedelta(days=30 - 5 * k) for k in range(5)]
    for k, day in enumerate([*days, days[0]]):
        _pull(spark, root, f"2026100{k + 1}000000", [(r[0] + 100 * days.index(day), *r[1:]) for r in _recs(day, 10)])
    s = st.landed_stream(spark, root, TEXT, max_files=1)
    st.run_until_done(st.compaction_query(s, table, "id", ck, normalise=lambda b: _typed(b).withColumn("day", F.to_date("ts")),
                                          day_col="day", mode="insert_only"))
    t = spark.read.parquet(table)
    assert t.count() == 50 and t.select("id").distinct().count() == 50
    assert spark.read.parquet(f"{table}/_runs").count() == 6


def test_latest_stream_settles_tied_times(spark, tmp_path):
    at = dt.datetime(2026, 9, 16, 1)
    batch = spark.createDataFrame([("a", at, 1.0), ("a", at, 3.0), ("a", at, 2.0)], "g string, ts timestamp, v double")
    assert st.latest_stream(batch.repartition(3), "g", "v", "ts").first().last_value == 3.0
