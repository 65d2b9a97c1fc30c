"""Merge laws, traps of the merges (null keys, duplicates in a batch) and the layouts."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from feedloom.operators.dedup import keep_latest, keep_one
from feedloom.operators.layout import current_version, read_snapshot, write_snapshot
from feedloom.operators import merge
from feedloom.operators.merge import compact_days, merge_insert_only, merge_into_snapshot, merge_latest, read_days_only

SCHEMA = "id bigint, v double, ts string, day date"


def _df(spark, recs):
    return spark.createDataFrame(recs, SCHEMA)


def _set(df):
    return sorted(tuple(r) for r in df.collect())


OLD = [(1, 1.0, "a", None), (2, 2.0, "a", None), (3, 3.0, "a", None)]
NEW = [(2, 20.0, "b", None), (4, 40.0, "b", None), (4, 41.0, "c", None)]


def test_merge_latest_new_wins_and_batch_is_deduplicated(spark):
    m, _ = merge_latest(_df(spark, OLD), _df(spark, NEW), "id", order=[F.desc("ts")])
    assert _set(m.select("id", "v")) == [(1, 1.0), (2, 20.0), (3, 3.0), (4, 41.0)]


def test_merge_insert_only_old_wins(spark):
    m, _ = merge_insert_only(_df(spark, OLD), _df(spark, NEW), "id", order=[F.desc("ts")])
    assert _set(m.select("id", "v")) == [(1, 1.0), (2, 2.0), (3, 3.0), (4, 41.0)]


def test_merge_is_idempotent_and_keys_unique(spark):
    o, n = _df(spark, OLD), _df(spark, NEW)
    once, _ = merge_latest(o, n, "id", order=[F.desc("ts")])
    twice, _ = merge_latest(once, n, "id", order=[F.desc("ts")])
    assert _set(once) == _set(twice)
    assert once.groupBy("id").count().filter("count > 1").count() == 0


def test_merge_does_not_depend_on_partitioning(spark):
    o, n = _df(spark, OLD), _df(spark, NEW)
    a, _ = merge_latest(o, n, "id", order=[F.desc("ts")])
    b, _ = merge_latest(o.repartition(3), n.repartition(5, "v"), "id", order=[F.desc("ts")])
    assert _set(a) == _set(b)


def test_full_window_path_equals_anti_join_path(spark):
    o, n = _df(spark, OLD), _df(spark, NEW)
    a, _ = merge_latest(o, n, "id", order=[F.desc("ts")])
    b, _ = merge_latest(o, n, "id", order=[F.desc("ts")], history_unique=True)
    assert _set(a) == _set(b)


def test_duplicates_in_history_go(spark):
    old = _df(spark, OLD + [(1, 1.5, "b", None), (1, 1.5, "b", None), (None, 7.0, "a", None)])
    for merge, two in ((merge_latest, 20.0), (merge_insert_only, 2.0)):
        m, _ = merge(old, _df(spark, NEW), "id", order=[F.desc("ts")])
        assert sorted((r.id or -1, r.v) for r in m.collect()) == [(-1, 7.0), (1, 1.5), (2, two), (3, 3.0), (4, 41.0)]


def test_null_keys_are_rejected_not_merged(spark):
    old = _df(spark, OLD + [(None, 9.0, "a", None)])
    new = _df(spark, [(None, 8.0, "b", None), (5, 50.0, "b", None)])
    m, rejects = merge_insert_only(old, new, "id")
    ids = sorted((r.id is None, r.id) for r in m.collect())
    # NOT IN would add nothing once history holds a NULL id; the anti join still adds id 5.
    assert (False, 5) in ids and rejects.count() == 1


def test_keep_one_needs_no_order_and_is_total(spark):
    df = _df(spark, [(1, 1.0, "x", None), (1, 1.0, "y", None)])
    a = keep_one(df, "id").collect()
    b = keep_one(df.repartition(2), "id").collect()
    assert len(a) == 1 and a == b


def test_keep_latest_plans_a_partial_group_limit(spark):
    df = _df(spark, OLD + NEW)
    plan = keep_latest(df, "id", by=["ts"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def _files(path):
    out = {}
    for root, _, files in os.walk(path):
        for f in files:
            if f.endswith(".parquet"):
                out[os.path.join(root, f)] = os.path.getmtime(os.path.join(root, f))
    return out


def test_compact_days_rewrites_only_touched_days(spark, tmp_path):
    table = str(tmp_path / "t")
    d1, d2 = "2026-09-16", "2026-09-17"
    first = spark.createDataFrame([(1, 1.0, "a", d1), (2, 2.0, "a", d2)], "id bigint, v double, ts string, day string")
    first = first.withColumn("day", F.to_date("day"))
    r1 = compact_days(spark, table, first, "id", order=[F.desc("ts")], day_col="day")
    assert r1["rows_after"] == 2 and r1["partitions"] == 2
    before = _files(table)
    day1 = {p: t for p, t in before.items() if f"day={d1}" in p}
    again = spark.createDataFrame([(2, 20.0, "b", d2), (3, 3.0, "b", d2), (3, 30.0, "c", d2), (None, 0.0, "x", d2)],
                                  "id bigint, v double, ts string, day string").withColumn("day", F.to_date("day"))
    r2 = compact_days(spark, table, again, "id", order=[F.desc("ts")], day_col="day")
    assert r2["bytes"] > 0
    assert r2["rows_before"] == 1 and r2["rows_in"] == 4 and r2["rows_after"] == 2 and r2["rejects"] == 1
    after = _files(table)
    assert {p: t for p, t in after.items() if f"day={d1}" in p} == day1  # untouched day: same files
    got = _set(spark.read.parquet(table).select("id", "v"))
    assert got == [(1, 1.0), (2, 20.0), (3, 30.0)]
    runs = spark.read.parquet(f"{table}/_runs")
    assert runs.count() == 2
    # idempotent: the same batch again changes nothing
    compact_days(spark, table, again, "id", order=[F.desc("ts")], day_col="day")
    assert _set(spark.read.parquet(table).select("id", "v")) == got


def test_compact_days_insert_only_keeps_history(spark, tmp_path):
    table = str(tmp_path / "t")
    mk = lambda recs: spark.createDataFrame(recs, "id bigint, v double, ts string, day string").withColumn(
        "day", F.to_date("day"))
    compact_days(spark, table, mk([(1, 1.0, "a", "2026-09-16")]), "id", day_col="day")
    compact_days(spark, table, mk([(1, 9.0, "b", "2026-09-16"), (2, 2.0, "b", "2026-09-16")]), "id",
                 day_col="day", mode="insert_only")
    assert _set(spark.read.parquet(table).select("id", "v")) == [(1, 1.0), (2, 2.0)]


def test_snapshot_versions_never_overwrite_what_they_read(spark, tmp_path):
    root = str(tmp_path / "snap")
    o, n = _df(spark, OLD), _df(spark, NEW)
    p1 = write_snapshot(o, root, ["id"])
    merged, _ = merge_latest(read_snapshot(spark, root), n, "id", order=[F.desc("ts")])
    p2 = write_snapshot(merged, root, ["id"])
    assert p1 != p2 and current_version(spark, root)[0] == 2
    assert _set(read_snapshot(spark, root).select("id", "v")) == [(1, 1.0), (2, 20.0), (3, 3.0), (4, 41.0)]
    assert _set(spark.read.parquet(p1)) == _set(o)  # the old version is intact


def test_keep_first_keeps_the_oldest_copy(spark):
    from feedloom.operators.dedup import keep_first
    df = _df(spark, [(1, 1.0, "b", None), (1, 2.0, "a", None), (2, 3.0, "c", None)])
    assert _set(keep_first(df, "id", by=["ts"]).select("id", "v")) == [(1, 2.0), (2, 3.0)]


def test_read_days_prunes_to_the_requested_days(spark, tmp_path):
    from feedloom.sources.parquet import last_days, read_days
    root = str(tmp_path / "t")
    df = spark.createDataFrame([(i, dt.date(2026, 9, 10 + i)) for i in range(6)], "id bigint, ingest_day date")
    df.write.partitionBy("ingest_day").parquet(root)
    assert sorted(r.id for r in read_days(spark, root, "2026-09-12", "2026-09-13").collect()) == [2, 3]
    got = last_days(spark, root, dt.date(2026, 9, 15), 3)
    assert sorted(r.id for r in got.collect()) == [3, 4, 5]
    assert "PartitionFilters: [isnotnull(ingest_day" in got._jdf.queryExecution().executedPlan().toString()


def _history(spark, table, days=40):
    hist = spark.createDataFrame([(i, float(i), "a", dt.date(2026, 8, 1) + dt.timedelta(i % days)) for i in range(10 * days)], SCHEMA)
    compact_days(spark, table, hist, "id", day_col="day", run_log=False)


def test_compaction_lists_only_the_touched_day(spark, tmp_path):
    table = str(tmp_path / "t")
    _history(spark, table)
    batch = _df(spark, [(5, 50.0, "b", dt.date(2026, 8, 6)), (900, 9.0, "b", dt.date(2026, 12, 1))])
    report, merged = compact_days(spark, table, batch, "id", day_col="day", dry_run=True)
    from_table = [f for f in merged.inputFiles() if f"{table}/day=" in f]
    assert from_table and all("day=2026-08-06" in f for f in from_table)
    assert report["partitions"] == 2
    got = {r.id: r.v for r in merged.collect()}
    assert len(got) == 11 and got[5] == 50.0  # the touched day's ten ids and the new day's one
    opened = read_days_only(spark, table, "day", [dt.date(2026, 8, 6), dt.date(2026, 12, 1)])
    assert len({f.rsplit("/", 2)[1] for f in opened.inputFiles()}) == 1


def test_replace_drops_rows_that_the_backfill_lacks(spark, tmp_path):
    table = str(tmp_path / "t")
    _history(spark, table, days=3)
    day = dt.date(2026, 8, 2)
    compact_days(spark, table, _df(spark, [(1, 10.0, "b", day), (1, 11.0, "c", day)]), "id", order=[F.desc("ts")], day_col="day", mode="replace")
    t = spark.read.parquet(table)
    assert _set(t.filter(F.col("day") == F.lit(day)).select("id", "v")) == [(1, 11.0)]
    assert t.count() == 21


def test_a_failure_in_the_swap_loses_nothing(spark, tmp_path, monkeypatch):
    """The merged days are complete before the table is touched; whatever ran next puts them in place."""
    table = str(tmp_path / "t")
    _history(spark, table, days=3)
    day = dt.date(2026, 8, 2)
    whole = merge.publish_days

    def breaks(spark, path, day_col):
        if os.path.exists(f"{path}/_staged/days/_SUCCESS"):
            for root, _, files in os.walk(f"{path}/day={day}"):  # half way: the old day is gone, the new one not there
                for f in files:
                    os.remove(os.path.join(root, f))
            raise RuntimeError("lost in the swap")
        whole(spark, path, day_col)

    monkeypatch.setattr(merge, "publish_days", breaks)
    with pytest.raises(RuntimeError):
        compact_days(spark, table, _df(spark, [(1, 10.0, "b", day)]), "id", day_col="day")
    monkeypatch.setattr(merge, "publish_days", whole)
    compact_days(spark, table, _df(spark, [(2, 20.0, "b", dt.date(2026, 8, 3))]), "id", day_col="day")  # another day's batch
    got = {r.id: r.v for r in spark.read.parquet(table).collect()}
    assert len(got) == 30 and got[1] == 10.0 and got[4] == 4.0 and got[2] == 20.0
    assert not os.path.exists(f"{table}/_staged/days")


def test_a_replayed_batch_writes_its_rejects_and_report_once(spark, tmp_path):
    table = str(tmp_path / "t")
    batch = _df(spark, [(1, 1.0, "a", dt.date(2026, 8, 1)), (None, 2.0, "a", dt.date(2026, 8, 1))])
    for _ in range(2):
        compact_days(spark, table, batch, "id", day_col="day", batch_id="stream-7")
    assert spark.read.parquet(f"{table}/_rejects").count() == 1 and spark.read.parquet(f"{table}/_runs").count() == 1


def test_snapshot_merge_keeps_its_rejects_and_drops_old_versions(spark, tmp_path):
    root = str(tmp_path / "snap")
    for k in range(4):
        report = merge_into_snapshot(spark, root, _df(spark, [(k, float(k), "a", None), (None, 9.0, "a", None)]), "id")
        assert (report["rows_in"], report["rejects"], report["rows_after"]) == (2, 1, k + 1) and report["bytes"] > 0
    assert spark.read.parquet(f"{root}/_rejects").count() == 4
    assert sorted(d for d in os.listdir(root) if d.startswith("_v=")) == ["_v=000003", "_v=000004"]


def test_map_columns_do_not_break_tie_breaks_or_audits(spark):
    from feedloom.operators import audit
    df = spark.createDataFrame([(1, {"a": 1}), (1, {"a": 2}), (2, {"b": 1})], "id bigint, m map<string,int>")
    assert keep_one(df, "id").count() == 2
    assert {r.id: r.versions for r in audit.duplicates(df, "id").collect()} == {1: 2}
