"""Deltas beside a day table: merge on read equals compaction, folding, replays, interrupted runs."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from feedloom.operators import deltas
from feedloom.operators.deltas import append_delta, delta_days, fold_deltas, read_merged
from feedloom.operators.merge import compact_days

SCHEMA = "id bigint, v double, ts string, ingest_day date"
D = [dt.date(2026, 3, k) for k in range(1, 6)]


def _df(spark, recs):
    return spark.createDataFrame(recs, SCHEMA)


def _rows(df):
    return sorted(tuple(r) for r in df.select("id", "v", "ts", "ingest_day").collect())


def _files(path):
    return {os.path.join(r, f): os.stat(os.path.join(r, f)).st_mtime_ns for r, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


BASE = [(k, float(k), "a", D[k % 4]) for k in range(40)]
BATCHES = [[(1, 100.0, "b", D[1]), (1, 101.0, "c", D[1]), (90, 9.0, "b", D[1])],
           [(1, 200.0, "d", D[1]), (2, 22.0, "d", D[2]), (91, 9.0, "d", D[4]), (None, 0.0, "d", D[1])],
           [(2, 23.0, "e", D[2]), (90, 9.5, "e", D[1])]]


@pytest.mark.parametrize("mode", ["latest", "insert_only"])
def test_deltas_read_and_fold_like_compactions(spark, tmp_path, mode):
    plain, table = str(tmp_path / "plain"), str(tmp_path / "table")
    for path in (plain, table):
        compact_days(spark, path, _df(spark, BASE), "id", order=[F.desc("ts")])
    before = _files(table)
    for k, b in enumerate(BATCHES):
        compact_days(spark, plain, _df(spark, b), "id", order=[F.desc("ts")], mode=mode)
        report = append_delta(spark, table, _df(spark, b), "id", order=[F.desc("ts")], batch_id=f"b{k}")
        assert report["rows_after"] == len({(r[0], r[3]) for r in b if r[0] is not None})
    assert {p: t for p, t in _files(table).items() if "/_" not in p[len(table):]} == {p: t for p, t in before.items() if "/_" not in p[len(table):]}
    want = _rows(spark.read.parquet(plain))
    assert _rows(read_merged(spark, table, "id", [F.desc("ts")], mode)) == want
    some = read_merged(spark, table, "id", [F.desc("ts")], mode, days=[D[1], D[4]])
    assert _rows(some) == [r for r in want if r[3] in (D[1], D[4])]
    assert delta_days(spark, table) == {str(D[1]), str(D[2]), str(D[4])}
    untouched = {p: t for p, t in _files(table).items() if f"={D[0]}" in p or f"={D[3]}" in p}
    assert fold_deltas(spark, table, "id", [F.desc("ts")], mode, share=0.0)["days"] == [str(D[1]), str(D[2]), str(D[4])]
    assert delta_days(spark, table) == set() and not os.listdir(os.path.join(table, "_delta"))
    assert _rows(spark.read.parquet(table)) == want == _rows(read_merged(spark, table, "id", [F.desc("ts")], mode))
    assert untouched.items() <= _files(table).items()


def test_small_deltas_wait(spark, tmp_path):
    table = str(tmp_path / "t")
    compact_days(spark, table, _df(spark, [(k, k / 7, f"{k * 7919}", D[k % 2]) for k in range(4000)]), "id")
    append_delta(spark, table, _df(spark, [(2, 0.5, "z", D[0]), (9_000, 0.5, "z", D[3])]), "id")
    assert fold_deltas(spark, table, "id", share=0.5) == {"target": table, "days": [str(D[3])], "left": [str(D[0])]}
    assert read_merged(spark, table, "id").filter("id IN (2, 9000) AND v = 0.5").count() == 2


def test_replayed_delta_and_unfinished_delta(spark, tmp_path):
    table = str(tmp_path / "t")
    append_delta(spark, table, _df(spark, [(1, 1.0, "a", D[0])]), "id", batch_id="x")
    append_delta(spark, table, _df(spark, [(1, 2.0, "a", D[0])]), "id", batch_id="y")
    append_delta(spark, table, _df(spark, [(1, 1.5, "a", D[0])]), "id", batch_id="x")  # again: its place in the order stays
    assert _rows(read_merged(spark, table, "id")) == [(1, 2.0, "a", D[0])]
    os.remove(os.path.join(table, "_delta", "seq=000000000002", "batch=y", "_SUCCESS"))
    assert _rows(read_merged(spark, table, "id")) == [(1, 1.5, "a", D[0])]
    assert read_merged(spark, str(tmp_path / "none"), "id") is None


def test_fold_that_fails_after_the_swap_changes_nothing(spark, tmp_path, monkeypatch):
    table = str(tmp_path / "t")
    compact_days(spark, table, _df(spark, BASE), "id")
    for k, b in enumerate(BATCHES):
        append_delta(spark, table, _df(spark, b), "id", order=[F.desc("ts")], batch_id=f"b{k}")
    want = _rows(read_merged(spark, table, "id"))
    dropped = []

    def fails(spark, path, real=deltas.delete_path):
        if "/_delta/" in path and dropped:
            raise OSError("store is away")
        dropped.append(path)
        real(spark, path)

    monkeypatch.setattr(deltas, "delete_path", fails)
    with pytest.raises(OSError):
        fold_deltas(spark, table, "id", share=0.0)
    monkeypatch.undo()
    assert _rows(read_merged(spark, table, "id")) == want
    fold_deltas(spark, table, "id", share=0.0)
    assert _rows(spark.read.parquet(table)) == want


def test_compaction_folds_what_lies_beside_its_days(spark, tmp_path):
    table = str(tmp_path / "t")
    compact_days(spark, table, _df(spark, BASE), "id")
    append_delta(spark, table, _df(spark, [(1, 7.0, "b", D[1]), (2, 7.0, "b", D[2])]), "id")
    compact_days(spark, table, _df(spark, [(5, 8.0, "c", D[1])]), "id")
    assert delta_days(spark, table) == {str(D[2])}
    assert spark.read.parquet(table).filter("id IN (1, 5)").agg(F.sum("v")).first()[0] == 15.0


def test_merge_on_read_shuffles_no_base_rows(spark, tmp_path):
    table = str(tmp_path / "t")
    compact_days(spark, table, _df(spark, BASE), "id")
    append_delta(spark, table, _df(spark, BATCHES[0]), "id")
    plan = read_merged(spark, table, "id")._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan and "PartitionFilters" in plan
