"""A key, hour or group holding a third of the rows: right answers, and plans that reduce it
before any shuffle (partial group limits, partial aggregates, two-level distinct counts)."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from feedloom.operators import audit
from feedloom.operators.dedup import keep_latest
from feedloom.operators.merge import compact_days, merge_latest
from feedloom.plans.dashboard import top_groups
from feedloom.plans.hourly import hourly

N = 30_000


@pytest.fixture(scope="module")
def skewed(spark):
    """Every third row has key 0, hour 00:00 and group 'hot'."""
    return spark.range(0, N, 1, 6).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        F.timestamp_seconds(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") * 60)).alias("ts"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("g"), (F.col("id") % 50).cast("string"))).alias("g"),
        (F.col("id") % 11).cast("double").alias("v"),
    ).cache()


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_keep_latest_with_a_hot_key(spark, skewed):
    out = keep_latest(skewed, "k", by=["ts", "v"])
    assert "WindowGroupLimit" in _plan(out) and "Partial" in _plan(out)
    assert out.count() == N - N // 3 + 1
    assert out.filter("k = 0").first().v == max(float(i % 11) for i in range(0, N, 3))


def test_duplicates_audit_with_a_hot_key(spark, skewed):
    got = {r.k: (r.copies, r.versions) for r in audit.duplicates(skewed, "k", ["v"]).collect()}
    assert got == {0: (N // 3, 11)}


def test_hourly_and_top_groups_with_a_hot_group(spark, skewed):
    h = hourly(skewed, as_of="latest", days=10_000, ts="ts", value="v")
    assert "partial_count" in _plan(h)
    hot_hour = h.orderBy(F.desc("n")).first()
    assert hot_hour.n >= N // 3
    top = top_groups(skewed, "g", 1).first()
    assert (top.country, top.events) == ("hot", N // 3)


def test_merges_with_a_hot_key_in_the_batch(spark, skewed, tmp_path):
    old = spark.range(0, 100).select(F.col("id").alias("k"), F.timestamp_seconds(F.lit(0)).alias("ts"),
                                     F.lit("old").alias("g"), F.lit(-1.0).alias("v"))
    m, _ = merge_latest(old, skewed, "k", order=[F.desc("ts"), F.desc("v")])
    assert m.count() == (N - N // 3 + 1) + (100 - old.join(skewed.select("k").distinct(), "k", "left_semi").count())
    table = str(tmp_path / "t")
    rep = compact_days(spark, table, skewed.withColumn("day", F.to_date("ts")), "k",
                       order=[F.desc("ts"), F.desc("v")], day_col="day", run_log=False)
    assert rep["rows_after"] == spark.read.parquet(table).count() == \
        skewed.select(F.to_date("ts").alias("d"), "k").distinct().count()


def test_payloads_of_a_hot_user_are_bounded(spark):
    ev = spark.range(6000).select(F.col("id").alias("event_id"), F.expr("CASE WHEN id % 3 = 0 THEN 7 WHEN id = 1 THEN NULL ELSE id % 400 END").alias("user_id"),
                                  F.expr("timestamp_ntz'2026-01-01 00:00:00'").alias("ts"), F.col("id").cast("double").alias("value"))
    sent = E._payloads(ev)
    read = sent.select("user_id", "start", F.from_json("value", "array<struct<latitude: double>>").alias("a")).filter("a IS NOT NULL")
    got = {}
    for r in read.collect():
        assert 0 < len(r["a"]) <= 10 and r["start"] % 10 == 0
        got.setdefault(r["user_id"], {})[r["start"]] = [x["latitude"] for x in r["a"]]
    want = {}
    for r in ev.orderBy("event_id").collect():
        if r["user_id"] is None or r["user_id"] % 10:
            want.setdefault(r["user_id"], []).append(r["value"])
    assert {u: sum((x[k] for k in sorted(x)), []) for u, x in got.items()} == want and len(got[7]) == -(-len(want[7]) // 10)
