"""

Every query reads the driver's tables (or tables Spark derives from them) in full. The driver
tables stand in for the two feeds: ``events(event_id, ts, user_id, event_type, value, props)``
plays both the event export and the weather readings (``event_id`` = GlobalEventID, ``ts`` =
DATEADDED / reading time, ``event_type`` = country / city, ``value`` = tone / temperature,
``props`` = raw payload text, ``user_id`` = a high-cardinality group for top-k).

The merge queries derive a history and a re-sent batch from ``events`` by time, the way the
feeds re-read "yesterday and today": history = every row up to the day before the newest day,
batch = every row from that day on, re-sent with a corrected value (``value + 1``). All rows
of the table take part. Doubles are rounded in both the Spark result and the oracle so that
summation order does not decide the comparison.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

# The package lives next to this file; make it importable however this file is loaded.
_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.operators import audit, manifest, normalize  # noqa: E402
from feedloom.operators.crossday import compact_days_across
from feedloom.operators.dedup import keep_latest
from feedloom.operators.deltas import append_delta, fold_deltas, read_merged
from feedloom.operators.joins import numbered
from feedloom.operators.layout import CSV_OPTIONS, backfill_day, land_partitioned, read_snapshot, write_snapshot
from feedloom.operators.merge import compact_days, merge_insert_only, merge_into_snapshot, merge_latest
from feedloom.plans import feeds, probes, rollup
from feedloom.plans.adhoc import DEFAULT_QUERY, adhoc
from feedloom.plans.dashboard import class_mix, dashboard, leaders_tone, top_groups
from feedloom.plans.hourly import hourly
from feedloom.plans.lookback import day_window, since, window_bounds, window_totals
from feedloom.plans.series import (
    axis_positions, daily_domain, daily_summary, day_ticks, hourly_domain, nested_series, readings, series_all, series_domain,
    series_one, series_totals, unnested,
)
from feedloom.schemas import CITIES, EVENT_FIELDS
from feedloom.session import scratch_path
from feedloom.sources.csv import read_csv_by_header, read_event_tsv, read_text_csv
from feedloom.sources.parquet import last_days
from feedloom.sources.payload import city_dim, read_payloads, rows_from_payload
from feedloom.sources.zipped import unzip_events
from feedloom.streaming import stream as st

try:  # the training-data operators come with their own queries; the rest works without them
    from feedloom.llm import registry as _llm
except ModuleNotFoundError as missing:
    if not (missing.name or "").startswith(("feedloom.llm", "corpus_pipeline")):
        raise
    _llm = None

SMOKE_DIR = "/root/testdata/sf0.001"
EVENT_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _events(spark, sf):
    return _t(spark, sf, "events")


def _with_day(df: DataFrame) -> DataFrame:
    return df.withColumn("day", F.to_date("ts"))


def _history_and_batch(ev: DataFrame) -> tuple[DataFrame, DataFrame]:
    """History up to the day before the newest day; batch = that day onward, value corrected.

    The cuts are plain ``ts`` ranges (no function of ``ts``), so they can reach the reader."""
    cut = F.date_sub(ev.select(F.max(F.to_date("ts"))).scalar(), 1).cast("timestamp_ntz")
    old = ev.filter(F.col("ts") < cut + F.make_dt_interval(days=F.lit(1)))
    new = ev.filter(F.col("ts") >= cut).withColumn("value", F.col("value") + 1)
    return old, new


# --------------------------------------------------------------------------- hourly

def q_events_per_hour(spark, sf):
    return hourly(_events(spark, sf), as_of="latest", days=7, ts="ts", value="value", digits=4)


def q_events_per_hour_type(spark, sf):
    return hourly(_events(spark, sf), as_of="latest", days=7, group="view", group_col="event_type",
                  normalise_group=False, ts="ts", value="value", digits=4)


def q_hourly_domain(spark, sf):
    return hourly_domain(q_events_per_hour(spark, sf))


# --------------------------------------------------------------------------- daily, series

def q_daily_summary(spark, sf):
    return daily_summary(_events(spark, sf), city_col="event_type", ts="ts", temp="value", rain="value")


def q_daily_summary_city(spark, sf):
    return daily_summary(_events(spark, sf), city="click", city_col="event_type", ts="ts", temp="value", rain="value")


def q_one_series(spark, sf):
    return series_one(_events(spark, sf), "view", as_of="latest", days=7, city_col="event_type", ts="ts",
                      value="value", extra=("user_id",), tie=("event_id",))


def q_all_series(spark, sf):
    return series_all(_events(spark, sf), as_of="latest", days=7, city_col="event_type", ts="ts",
                      value="value", tie=("event_id",))


def q_nested_series(spark, sf):
    """Every type's readings as one sorted array a day, put together again."""
    rows = readings(since(_events(spark, sf), "ts", "latest", 7), ["event_type"], "ts", tie=["event_id"])
    return unnested(nested_series(rows, "event_type", "ts", "value"))


# --------------------------------------------------------------------------- chart numbers

def _chart_window(spark, sf):
    """The de-duplicated readings behind the charts: one row per city and time."""
    return readings(since(_events(spark, sf), "ts", "latest", 7), ["event_type"], "ts", tie=["event_id"])


def q_daily_domain(spark, sf):
    return daily_domain(q_daily_summary(spark, sf))


def q_chart_domain(spark, sf):
    return series_domain(_chart_window(spark, sf), "value", rain="value")


def q_chart_totals(spark, sf):
    return series_totals(_chart_window(spark, sf), "event_type", "ts", "value", rain="value")


def q_chart_day_ticks(spark, sf):
    return day_ticks(_chart_window(spark, sf), "ts", "event_type")


def q_chart_axis(spark, sf):
    return axis_positions(_chart_window(spark, sf), "ts")


# --------------------------------------------------------------------------- keep one per key

def q_keep_latest(spark, sf):
    return keep_latest(_t(spark, sf, "conversations"), "conv_id", by=["turn"])


def q_latest_per_user(spark, sf):
    return keep_latest(_events(spark, sf), "user_id", by=["ts", "event_id"])


# --------------------------------------------------------------------------- merges

def q_merge_latest(spark, sf):
    old, new = _history_and_batch(_events(spark, sf))
    return merge_latest(old, new, "event_id", order=[F.desc("ts")])[0]


def q_merge_insert_only(spark, sf):
    old, new = _history_and_batch(_events(spark, sf))
    return merge_insert_only(old, new, "event_id", order=[F.desc("ts")])[0]


def _snapshot(spark, sf, mode):
    """Whole-history compaction of the re-sent batch into a history that holds two days twice."""
    ev = _events(spark, sf)
    old, new = _history_and_batch(ev)
    cut = F.date_sub(ev.select(F.max(F.to_date("ts"))).scalar(), 3)
    root = scratch_path(spark, "snapshot")
    write_snapshot(old.unionByName(old.filter(F.to_date("ts") >= cut)), root, ["event_id"])
    merge_into_snapshot(spark, root, new, "event_id", order=[F.desc("ts")], mode=mode)
    return read_snapshot(spark, root)


def q_snapshot_latest(spark, sf):
    return _snapshot(spark, sf, "latest")


def q_snapshot_insert_only(spark, sf):
    return _snapshot(spark, sf, "insert_only")


def q_backfill_replace(spark, sf):
    """The newest landing day is backfilled without its purchases; its table day becomes the backfill alone."""
    ev = _events(spark, sf)
    root, table = scratch_path(spark, "landing"), scratch_path(spark, "day-table")
    newest = ev.agg(F.max(F.to_date("ts"))).first()[0]
    day = F.to_date("ts")
    _land(ev, root, "000000")
    raw = read_text_csv(spark, root, EVENT_COLS + ["stamp"], basePath=root)
    compact_days(spark, table, _typed_from_text(raw).drop("stamp"), "event_id", order=[F.desc("ts")])
    again = ev.filter((day == F.lit(newest)) & (F.col("event_type") != "purchase"))
    backfill_day(again.withColumn("ingest_day", day).withColumn("stamp", F.concat(F.date_format(day, "yyyyMMdd"), F.lit("235959"))), root)
    raw = read_text_csv(spark, f"{root}/ingest_day={newest}", EVENT_COLS + ["stamp"], basePath=root)
    compact_days(spark, table, _typed_from_text(raw).drop("stamp"), "event_id", order=[F.desc("ts")], mode="replace")
    return spark.read.parquet(table).select(*EVENT_COLS, "ingest_day")


def q_csv_by_header(spark, sf):
    """The table landed as CSV in two column orders (odd and even ids) and read back by the files' headers."""
    ev = _events(spark, sf)
    root = scratch_path(spark, "by-header")
    for k, order in enumerate((EVENT_COLS, EVENT_COLS[::-1])):
        part = ev.filter(F.pmod("event_id", F.lit(2)) == k).select(*order)
        part.write.options(**CSV_OPTIONS).csv(f"{root}/order={k}")
    return _typed_from_text(read_csv_by_header(spark, f"{root}/order=*", EVENT_COLS, position=False))


def q_payload_rows(spark, sf):
    """Each user's events in event order as payloads of up to ten entries, matched to the cities by place; users
    without entries for all ten cities, cities too many (every payload after a user's first), or unreadable text show
    among the rejects."""
    rows, rejects = rows_from_payload(_payloads(_events(spark, sf)), city_dim(spark), keep=("user_id",), start="start")
    good = rows.select("user_id", "pos", F.col("city").alias("what"), "temperature_c")
    return good.unionByName(rejects.select("user_id", "pos", F.col("reason").alias("what"), F.lit(None).cast("double").alias("temperature_c")))


def _payloads(ev, entries=len(CITIES)):
    """A payload per ``entries`` events of a user, ``start`` the place of its first; one unreadable text for some users."""
    broken = F.coalesce(F.pmod("user_id", F.lit(10)) == 0, F.lit(False))
    entry = F.struct(F.col("value").alias("latitude"), F.col("value").alias("longitude"), F.struct(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm").alias("time"), F.col("value").alias("temperature_2m")).alias("current"))
    placed = numbered(ev.filter(~broken).select("user_id", "event_id", entry.alias("e")), "user_id", "event_id")
    sent = placed.groupBy("user_id", (F.col("pos") - F.pmod("pos", F.lit(entries))).alias("start")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "e"))), lambda x: x["e"]).alias("a"))
    no_json = ev.filter(broken).select("user_id").distinct().select("user_id", F.lit(0).cast("long").alias("start"), F.lit("no json [").alias("value"))
    return sent.select("user_id", "start", F.to_json("a").alias("value")).unionByName(no_json)


def _payload_files(ev, path):
    """One payload file per hour of events in a folder of its stamp: city k's entry is made of the hour's events whose id
    ends in k (no such event: a null entry). The newest day is pulled again half an hour later, one degree warmer."""
    hour = F.date_trunc("hour", "ts")
    city = ev.groupBy(hour.alias("h"), F.pmod("event_id", F.lit(len(CITIES))).alias("k")).agg(
        F.max("value").alias("t"), F.count("*").cast("double").alias("n"), F.max(F.pmod("user_id", F.lit(90))).alias("code"))
    newest = city.agg(F.max(F.to_date("h"))).scalar()
    again = city.filter(F.to_date("h") == newest).withColumn("t", F.col("t") + 1)
    pulls = city.withColumn("late", F.lit(0)).unionByName(again.withColumn("late", F.lit(30)))
    current = F.struct(F.date_format("h", "yyyy-MM-dd'T'HH:mm").alias("time"), F.col("t").alias("temperature_2m"), F.col("n").alias("precipitation"),
                       F.col("code").alias("weather_code"))
    by_city = F.map_from_entries(F.collect_list(F.struct("k", F.struct(current.alias("current")))))
    sent = pulls.groupBy("h", "late").agg(by_city.alias("m")).select(
        F.date_format(F.col("h") + F.make_dt_interval(mins=F.col("late")), "yyyyMMddHHmmss").alias("stamp"),
        F.to_json(F.transform(F.sequence(F.lit(0), F.lit(len(CITIES) - 1)), lambda i: F.try_element_at("m", i.cast("long")))).alias("value"))
    sent.write.partitionBy("stamp").text(path)


def q_weather_feed_daily(spark, sf):
    """The weather feed end to end: payload files, landed as CSV pulls, typed strictly, compacted with the later pull
    winning, then the daily summary of each city."""
    sent, landing, table = (scratch_path(spark, n) for n in ("payloads", "weather-landing", "weather-table"))
    _payload_files(_events(spark, sf), sent)
    pulls = read_payloads(spark, f"{sent}/stamp=*", position=False)
    feeds.land_payloads(pulls.withColumn("stamp", F.regexp_extract("_metadata.file_path", r"stamp=(\d{14})/", 1)), landing)
    feeds.compact_weather(spark, landing, table)
    return daily_summary(spark.read.parquet(table))


def q_last_days(spark, sf):
    """Rows per day of the last seven day files, one of them missing."""
    ev, table = _events(spark, sf), scratch_path(spark, "day-table")
    newest = ev.select(F.max(F.to_date("ts"))).scalar()
    days = ev.withColumn("ingest_day", F.to_date("ts")).filter(F.col("ingest_day") != F.date_sub(newest, 2))
    compact_days(spark, table, days, "event_id", order=[F.desc("ts")], run_log=False)
    as_of = ev.agg(F.max(F.to_date("ts"))).first()[0]
    return last_days(spark, table, as_of, 7).groupBy("ingest_day").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))


def q_run_report(spark, sf):
    """The run log of a day table after its history and a re-sent batch: rows before, in and after, rejects, days."""
    old, new = _history_and_batch(_events(spark, sf))
    table = scratch_path(spark, "day-table")
    for k, part in enumerate((old, new)):
        compact_days(spark, table, part.withColumn("ingest_day", F.to_date("ts")), "event_id", order=[F.desc("ts")], batch_id=f"run{k}")
    return spark.read.parquet(f"{table}/_runs").select("batch", "rows_before", "rows_in", "rows_after", "rejects", "partitions")


def q_adhoc_capped(spark, sf):
    """A read-only query with the row cap of the SQL endpoint."""
    return adhoc(spark, {"events": _events(spark, sf)}, "SELECT event_id, user_id, value FROM events ORDER BY value DESC, event_id", limit=500)


def q_day_compaction(spark, sf):
    """Build a day table from the history, then compact the re-sent batch into its two days."""
    ev = _events(spark, sf)
    old, new = _history_and_batch(ev)
    table = scratch_path(spark, "day-table")
    day = F.to_date("ts")
    compact_days(spark, table, old.withColumn("ingest_day", day), "event_id", order=[F.desc("ts")])
    compact_days(spark, table, new.withColumn("ingest_day", day), "event_id", order=[F.desc("ts")])
    return spark.read.parquet(table).select(*EVENT_COLS, "ingest_day")


def _three_deltas(spark, sf):
    """A day table of the history and, beside it, the re-sent days as three deltas; the last two correct half of the first."""
    old, new = _history_and_batch(_events(spark, sf))
    table, day = scratch_path(spark, "day-table"), F.to_date("ts")
    compact_days(spark, table, old.withColumn("ingest_day", day), "event_id", order=[F.desc("ts")])
    third = F.pmod("event_id", F.lit(3)) == 0
    stale = new.filter(F.pmod("event_id", F.lit(2)) == 0).withColumn("value", F.col("value") + 100)
    for part in (stale, new.filter(third), new.filter(~third)):
        append_delta(spark, table, part.withColumn("ingest_day", day), "event_id", order=[F.desc("ts")])
    return table


def q_delta_read(spark, sf):
    """Base and unfolded deltas, merged on read."""
    table = _three_deltas(spark, sf)
    return read_merged(spark, table, "event_id", [F.desc("ts")]).select(*EVENT_COLS, "ingest_day")


def q_delta_folded(spark, sf):
    table = _three_deltas(spark, sf)
    fold_deltas(spark, table, "event_id", [F.desc("ts")], share=0.0)
    return spark.read.parquet(table).select(*EVENT_COLS, "ingest_day")


def _incremental(spark, sf, mode):
    """The history in about twenty files, then the re-sent days merged into those that they meet."""
    old, new = _history_and_batch(_events(spark, sf))
    root, size = scratch_path(spark, "manifest"), max(1, -(-_events(spark, sf).count() // 20))
    for part in (old, new):
        manifest.merge(spark, root, part, "event_id", order=[F.desc("ts")], mode=mode, file_rows=size)
    return manifest.read(spark, root)


def q_snapshot_incremental(spark, sf):
    return _incremental(spark, sf, "latest")


def q_snapshot_incremental_insert_only(spark, sf):
    return _incremental(spark, sf, "insert_only")


def q_cross_day_dedup(spark, sf):
    """The newest days are sent again under the next day: each event moves there and leaves its old day."""
    old, new = _history_and_batch(_events(spark, sf))
    table, day = scratch_path(spark, "day-table"), F.to_date("ts")
    for part, d in ((old, day), (new, F.date_add(day, 1))):
        compact_days_across(spark, table, part.withColumn("ingest_day", d), "event_id", order=[F.desc("ts")])
    return spark.read.parquet(table).select(*EVENT_COLS, "ingest_day")


def q_cross_day_insert_only(spark, sf):
    old, new = _history_and_batch(_events(spark, sf))
    table, day = scratch_path(spark, "day-table"), F.to_date("ts")
    for part, d in ((old, day), (new, F.date_add(day, 1))):
        compact_days_across(spark, table, part.withColumn("ingest_day", d), "event_id", order=[F.desc("ts")], mode="insert_only")
    return spark.read.parquet(table).select(*EVENT_COLS, "ingest_day")


def _kept_up(spark, sf, refresh):
    """A day table compacted twice; ``refresh(table, days)`` follows each run's report."""
    old, new = _history_and_batch(_events(spark, sf))
    table = scratch_path(spark, "day-table")
    for part in (old, new):
        report = compact_days(spark, table, part.withColumn("ingest_day", F.to_date("ts")), "event_id", order=[F.desc("ts")])
        refresh(table, report["days"])


def q_hourly_rollup(spark, sf):
    """Hours and types from maintained partials."""
    path = scratch_path(spark, "rollup")
    _kept_up(spark, sf, lambda table, days: rollup.refresh(spark, table, path, days, value="value", group="event_type"))
    got = rollup.combined(spark.read.parquet(path), ["h", F.col("group").alias("event_type")])
    return got.select("h", "event_type", "n", "low", "high", F.col("total").cast("double").alias("total"), F.col("mean").alias("tone"))


def q_distinct_users(spark, sf):
    """Distinct users of each day: exact, and whether the merged hourly sketches come within 5 % of it."""
    path, sketches = scratch_path(spark, "distinct"), scratch_path(spark, "rollup")

    def refresh(table, days):
        rollup.refresh_distinct(spark, table, path, days, "user_id")
        rollup.refresh(spark, table, sketches, days, value="value", group="event_type", distinct="user_id")

    _kept_up(spark, sf, refresh)
    guess = rollup.combined(spark.read.parquet(sketches), ["ingest_day"]).select("ingest_day", F.col("distinct").alias("guess"))
    exact = rollup.distinct_exact(spark.read.parquet(path), ["ingest_day"])
    return exact.join(guess, "ingest_day").select("ingest_day", F.col("distinct").alias("users"),
                                                  (F.abs(F.col("guess") / F.col("distinct") - 1) <= 0.05).alias("sketch_near"))


def _typed_from_text(raw: DataFrame) -> DataFrame:
    """Landed event text back to the table's types; landing columns pass through."""
    extra = [c for c in raw.columns if c not in EVENT_COLS]
    return raw.select(
        F.col("event_id").cast("bigint").alias("event_id"),
        F.to_timestamp_ntz("ts", F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSSSS")).alias("ts"),
        F.col("user_id").cast("bigint").alias("user_id"), "event_type",
        F.col("value").cast("double").alias("value"), "props", *extra)


def _land(df: DataFrame, root: str, stamp_time: str) -> None:
    """Land rows as CSV pulls, one pull per day stamped ``<day><stamp_time>``."""
    day = F.to_date("ts")
    land_partitioned(df.withColumn("ingest_day", day)
                       .withColumn("stamp", F.concat(F.date_format(day, "yyyyMMdd"), F.lit(stamp_time))), root)


_LANDED_TEXT = T.StructType([T.StructField(c, T.StringType(), True) for c in EVENT_COLS + ["stamp"]]
                            + [T.StructField("ingest_day", T.DateType(), True)])


def q_csv_landing_roundtrip(spark, sf):
    """Land the table as day-partitioned CSV pulls, read it back as text, type it again."""
    root = scratch_path(spark, "landing")
    _land(_events(spark, sf), root, "000000")
    raw = read_text_csv(spark, root, EVENT_COLS + ["stamp"], basePath=root)
    return _typed_from_text(raw).select(*EVENT_COLS)


def q_layout_equivalence(spark, sf):
    """One hourly answer from three layouts of the same rows, tagged by layout.

    The CSV landing and the day table are written from the table; all three must agree."""
    ev = _events(spark, sf)
    root, days = scratch_path(spark, "landing"), scratch_path(spark, "day-table")
    _land(ev, root, "000000")
    compact_days(spark, days, ev.withColumn("ingest_day", F.to_date("ts")), "event_id", run_log=False)
    csv = _typed_from_text(read_text_csv(spark, root, EVENT_COLS + ["stamp"], basePath=root))
    answers = {
        "parquet": hourly(ev, as_of="latest", days=7, ts="ts", value="value", digits=4),
        "csv": hourly(csv, as_of="latest", days=7, ts="ts", value="value", digits=4, partition_col="ingest_day"),
        "days": hourly(spark.read.parquet(days), as_of="latest", days=7, ts="ts", value="value", digits=4,
                       partition_col="ingest_day"),
    }
    out = None
    for name, a in answers.items():
        a = a.select(F.lit(name).alias("layout"), "h", "n", "tone")
        out = a if out is None else out.unionByName(a)
    return out


def q_layout_report(spark, sf):
    """Rows per day of the day table built from events (files and bytes depend on the cluster)."""
    days = scratch_path(spark, "day-table")
    compact_days(spark, days, _events(spark, sf).withColumn("ingest_day", F.to_date("ts")), "event_id",
                 run_log=False)
    return audit.layout_report(spark, days).select("ingest_day", "rows")


def _as_exports(ev: DataFrame) -> DataFrame:
    """The table in the event export's 61-column text form, under its DATEADDED day."""
    mapped = {
        "GlobalEventID": F.col("event_id").cast("string"),
        "Day": F.date_format("ts", "yyyyMMdd"),
        "AvgTone": F.col("value").cast("string"),
        "ActionGeo_CountryCode": F.upper(F.substring("event_type", 1, 2)),
        "DATEADDED": F.date_format("ts", "yyyyMMddHHmmss"),
        "SOURCEURL": F.col("props"),
    }
    return ev.select(*[mapped.get(c, F.lit(None).cast("string")).alias(c) for c in EVENT_FIELDS],
                     F.to_date("ts").alias("ingest_day"))


def q_event_feed_hourly(spark, sf):
    """Events as tab-separated exports (the newest day delivered twice), read without quoting,
    typed leniently, compacted by day, then the hourly answer over the feed table."""
    ev = _events(spark, sf)
    root, table = scratch_path(spark, "exports"), scratch_path(spark, "event-table")
    newest = ev.select(F.max(F.to_date("ts"))).scalar()
    exports = _as_exports(ev).unionByName(_as_exports(ev.filter(F.to_date("ts") == newest)))
    (exports.write.partitionBy("ingest_day")
            .options(sep="\t", header="false", quote="\u0000", escapeQuotes="false", nullValue="")
            .csv(root))
    typed = normalize.events_flagged(read_event_tsv(spark, root, basePath=root)).drop("_corrupt_record")
    compact_days(spark, table, typed, "GlobalEventID", order=[F.desc("ts")], reject_col=normalize.BAD,
                 run_log=False)
    h = hourly(spark.read.parquet(table), as_of="newest_partition", days=7, partition_col="ingest_day", digits=4)
    return h.select(F.col("h").cast("timestamp_ntz").alias("h"), "n", "tone")


def _zipped(batches):
    """Each batch of export lines as one archive of two members."""
    import io
    import zipfile

    import pandas as pd
    for pdf in batches:
        out, lines = io.BytesIO(), pdf["line"].tolist()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            for k in range(2):
                z.writestr(f"{k}.export.CSV", "".join(x + "\r\n" for x in lines[k::2]))
        yield pd.DataFrame({"path": [f"/exports/{pdf['stamp'].iloc[0]}.export.CSV.zip"], "content": [out.getvalue()]})


def q_zip_roundtrip(spark, sf):
    """Events as zipped exports, written and unzipped in tasks, then typed leniently."""
    ev = _as_exports(_events(spark, sf))
    line = F.concat_ws("\t", *[F.coalesce(F.col(c), F.lit("")) for c in EVENT_FIELDS])
    path = scratch_path(spark, "archives")
    ev.select(F.col("DATEADDED").alias("stamp"), line.alias("line")).mapInPandas(_zipped, "path string, content binary").write.parquet(path)
    typed, _ = normalize.events(unzip_events(spark.read.parquet(path)))
    return typed.select("GlobalEventID", F.col("ts").cast("timestamp_ntz").alias("ts"), "AvgTone", "ActionGeo_CountryCode", "SOURCEURL", "event_day", "_nfields")


def q_landing_gaps(spark, sf):
    """Export archives of every quarter hour that has events, some hours lost on the way: the missing slots as runs."""
    ev = _events(spark, sf)
    lost = (F.pmod(F.dayofmonth("ts"), F.lit(3)) == 0) & F.hour("ts").between(22, 23) | (F.pmod(F.dayofmonth("ts"), F.lit(3)) == 1) & (F.hour("ts") < 5)
    slot = F.date_format(F.window("ts", "15 minutes").start, "yyyyMMddHHmmss")
    files = ev.filter(~lost).select(F.concat(F.lit("/exports/"), slot, F.lit(".export.CSV.zip")).alias("path"))
    span = ev.agg(F.min(F.to_date("ts")).alias("a"), F.max(F.to_date("ts")).alias("b")).first()
    return audit.landing_gaps(files, span.a, span.b)


# --------------------------------------------------------------------------- streams

def q_stream_compaction(spark, sf):
    """Two pulls land (history, then the re-sent days); the stream compacts them by day.

    Within a micro-batch the later pull wins by landing position (keep last, W5)."""
    old, new = _history_and_batch(_events(spark, sf))
    root, table, ck = (scratch_path(spark, n) for n in ("landing", "day-table", "ckpt"))
    _land(old, root, "000000")
    _land(new, root, "235959")
    stream = st.landed_stream(spark, root, _LANDED_TEXT)
    q = st.compaction_query(stream, table, "event_id", ck, normalise=_typed_from_text)
    st.run_until_done(q)
    return spark.read.parquet(table).select(*EVENT_COLS, "ingest_day")


def q_stream_dedup(spark, sf):
    """Six deliveries, the newest days first and the first one twice, each taken by the stream before the next lands: one
    copy per event id stays, however late its day comes."""
    ev = _events(spark, sf)
    root, table, ck = (scratch_path(spark, n) for n in ("landing", "day-table", "ckpt"))
    fifth = F.pmod(F.dayofyear("ts"), F.lit(5))
    for n, k in enumerate((4, 3, 2, 1, 0, 4)):
        _land(ev.filter(fifth == k), root, f"00000{n}")
        stream = st.landed_stream(spark, root, _LANDED_TEXT)
        st.run_until_done(st.compaction_query(stream, table, "event_id", ck, normalise=_typed_from_text, mode="insert_only"))
    return spark.read.parquet(table).select(*EVENT_COLS)


def q_stream_deltas(spark, sf):
    """Two pulls land one after the other; the stream writes each as deltas and folds what outgrows the base."""
    root, table, ck = (scratch_path(spark, n) for n in ("landing", "day-table", "ckpt"))
    for part, stamp in zip(_history_and_batch(_events(spark, sf)), ("000000", "235959")):
        _land(part, root, stamp)
        stream = st.landed_stream(spark, root, _LANDED_TEXT)
        st.run_until_done(st.compaction_query(stream, table, "event_id", ck, normalise=_typed_from_text, fold_share=1.5))
    return read_merged(spark, table, "event_id").select(*EVENT_COLS, "ingest_day")


def _in_thirds(spark, sf):
    """The events by thirds of their days, each third with the last day of the one before it sent again."""
    ev = _events(spark, sf)
    span = ev.agg(F.min(F.to_date("ts")).alias("a"), F.datediff(F.max(F.to_date("ts")), F.min(F.to_date("ts"))).alias("n")).first()
    at = F.datediff(F.to_date("ts"), F.lit(span.a))
    cut = [(span.n + 1) * k // 3 for k in range(4)]
    return ev, at, [ev.filter((at >= max(a - 1, 0)) & (at < b)) for a, b in zip(cut, cut[1:])]


def q_stream_late(spark, sf):
    """Thirds of the days land one after the other, the last with the second day sent again: first copies from the stateful
    de-duplication, rows under its watermark kept aside."""
    ev, at, parts = _in_thirds(spark, sf)
    parts[2] = parts[2].unionByName(ev.filter(at == 1))
    root, ok, late, out, c1, c2 = (scratch_path(spark, n) for n in ("landing", "on-time", "late", "first", "ckpt", "ckpt"))
    for k, part in enumerate(parts):
        _land(part, root, f"00000{k}")
        typed = _typed_from_text(st.landed_stream(spark, root, _LANDED_TEXT, position=False))
        st.run_until_done(st.split_late(typed, "ts", "2 days", ok, late, c1))
        rows = st.on_time_stream(spark, ok, typed.schema)
        st.run_until_done(st.append_to_table(st.dedup_stream(rows, ["event_id"], "ts", "2 days"), out, c2))
    first = spark.read.parquet(out).select(F.lit("first").alias("kind"), *EVENT_COLS)
    return first.unionByName(st.read_late(spark, late, typed.schema).select(F.lit("late").alias("kind"), *EVENT_COLS))


def q_stream_hourly_append(spark, sf):
    """Closed hours emitted once each over three landings, the open ones from the landing."""
    ev, at, _ = _in_thirds(spark, sf)
    third = F.floor(at * 3 / (ev.agg(F.max(at)).scalar() + 1))
    root, closed, ck = (scratch_path(spark, n) for n in ("landing", "closed-hours", "ckpt"))
    for k in range(3):
        _land(ev.filter(third == k), root, f"00000{k}")
        typed = _typed_from_text(st.landed_stream(spark, root, _LANDED_TEXT, position=False))
        st.run_until_done(st.append_to_table(st.hourly_stream(typed, "ts", "value", "1 day"), closed, ck))
    landed = _typed_from_text(read_text_csv(spark, root, EVENT_COLS + ["stamp"], basePath=root))
    hours = st.hours_now(spark, closed, landed, "ts", "value", "ingest_day")
    return hours.select(F.col("h").cast("timestamp_ntz").alias("h"), "n", F.round("tone", 4).alias("tone"))


def q_stream_hourly(spark, sf):
    root, out, ck = (scratch_path(spark, n) for n in ("landing", "hourly", "ckpt"))
    _land(_events(spark, sf), root, "000000")
    typed = _typed_from_text(st.landed_stream(spark, root, _LANDED_TEXT, position=False))
    st.run_until_done(st.complete_to_table(st.hourly_stream(typed, "ts", "value"), out, ck))
    return read_snapshot(spark, out).select("h", "n", F.round("tone", 4).alias("tone"))


def q_stream_latest(spark, sf):
    root, out, ck = (scratch_path(spark, n) for n in ("landing", "latest", "ckpt"))
    _land(_events(spark, sf), root, "000000")
    typed = _typed_from_text(st.landed_stream(spark, root, _LANDED_TEXT, position=False))
    st.run_until_done(st.complete_to_table(st.latest_stream(typed, "event_type", "value", "ts"), out, ck))
    return read_snapshot(spark, out)


# --------------------------------------------------------------------------- window, dashboard

def _day_events(spark, sf):
    return _with_day(_events(spark, sf))


def q_window_bounds(spark, sf):
    return window_bounds(_day_events(spark, sf), "day", 7)


def q_window_totals(spark, sf):
    return window_totals(_day_events(spark, sf), "day", 7)


def q_top_groups(spark, sf):
    w = day_window(_day_events(spark, sf), "day", 7)
    return top_groups(w, "event_type", 15, alias="country")


def q_top_users(spark, sf):
    w = day_window(_day_events(spark, sf), "day", 7)
    return top_groups(w, "user_id", 15, alias="user_id")


def q_top_hosts(spark, sf):
    pages = _t(spark, sf, "pages").withColumn("host", F.regexp_extract("url", r"^[a-z]+://([^/:?#]+)", 1))
    return top_groups(pages, "host", 15, alias="host", count_name="pages")


def q_leaders_by_day(spark, sf):
    w = day_window(_day_events(spark, sf), "day", 7)
    leaders = top_groups(w, "user_id", 15, alias="user_id").limit(6)
    return leaders_tone(w, leaders, "day", "user_id", "value", alias="user_id", digits=4)


def _dashboard(spark, sf):
    """The pack over events: types as countries, a class of 1 to 4 from the user."""
    ev = _day_events(spark, sf).withColumn("QuadClass", F.pmod("user_id", F.lit(4)) + 1)
    return dashboard(ev, days=7, top=3, tone=2, day="day", group="event_type", tone_col="value")


def q_dashboard_totals(spark, sf):
    return _dashboard(spark, sf)["totals"]


def q_dashboard_hours(spark, sf):
    return _dashboard(spark, sf)["per_hour"]


def q_dashboard_quad_labels(spark, sf):
    return _dashboard(spark, sf)["quad"].withColumn("share", F.round("share", 6))


def q_dashboard_tone(spark, sf):
    return _dashboard(spark, sf)["tone"].withColumn("tone", F.round("tone", 4))


def q_country_hours(spark, sf):
    """The hourly answer for a country given by its code, in lower case."""
    ev = _events(spark, sf).withColumn("country", F.upper(F.substring("event_type", 1, 2)))
    return hourly(ev, as_of="latest", days=7, group="vi", group_col="country", ts="ts", value="value", digits=4)


def q_class_mix(spark, sf):
    w = day_window(_day_events(spark, sf), "day", 7)
    return class_mix(w, "day", "event_type", label=False, digits=4)


# --------------------------------------------------------------------------- casts, probes, audits

def _props_k(ev: DataFrame) -> DataFrame:
    """Number texts of many forms, by the event id: plain, padded, with a fraction, an exponent, none at all."""
    k = F.get_json_object("props", "$.k")
    forms = [k, F.concat(F.lit(" "), k, F.lit(" ")), F.concat(k, F.lit(".5")), F.concat(F.lit("-"), k, F.lit(".25")),
             F.concat(k, F.lit("e1")), F.lit("nan"), F.lit(""), F.lit("abc")]
    form = F.pmod("event_id", F.lit(len(forms)))
    return ev.select("event_id", F.element_at(F.array(*forms), (form + 1).cast("int")).alias("k_raw"))


def q_lenient_cast(spark, sf):
    from feedloom.functions.casts import lenient
    return _props_k(_events(spark, sf)).select("event_id", lenient("k_raw", "bigint").alias("k"))


def q_cast_loss(spark, sf):
    from feedloom.functions.casts import lenient
    ev = _events(spark, sf)
    d = _props_k(ev).join(ev.select("event_id", F.col("event_type").alias("type_raw")), "event_id")
    d = d.withColumns({"k": lenient("k_raw", "bigint"), "event_type_code": lenient("type_raw", "bigint")})
    return audit.cast_loss(d, {"k": "k_raw", "event_type_code": "type_raw"})


def q_regex_count_urls(spark, sf):
    return probes.regex_count(_t(spark, sf, "pages"), "url")


def q_regex_count_docs(spark, sf):
    return probes.regex_count(_t(spark, sf, "documents"), "text")


def q_probe_modsum(spark, sf):
    return probes.modular_sum(_t(spark, sf, "lineitem"), "l_orderkey")


def q_probe_groups(spark, sf):
    return probes.group_count(_t(spark, sf, "lineitem"), "l_orderkey", 7)


def q_gap_audit(spark, sf):
    return audit.gaps(_events(spark, sf), "ts", 15)


def q_dup_audit_docs(spark, sf):
    d = _t(spark, sf, "documents").select(F.sha2("text", 256).alias("text_sha256"), "lang", "source")
    return audit.duplicates(d, "text_sha256", ["lang", "source"])


def q_dup_audit_events(spark, sf):
    ev = _events(spark, sf)
    _, new = _history_and_batch(ev)
    return audit.duplicates(ev.unionByName(new), "event_id")


def q_freshness(spark, sf):
    return audit.freshness(_events(spark, sf), "latest", "ts", group="event_type")


def q_adhoc_sql(spark, sf):
    ev = _events(spark, sf)
    weather = ev.select(F.col("event_type").alias("city"), F.col("ts").alias("time"),
                        F.col("value").alias("temperature_c"))
    return adhoc(spark, {"weather": weather}, DEFAULT_QUERY)


# --------------------------------------------------------------------------- contract

def entry(spark: SparkSession) -> DataFrame:
    """Flagship: events and mean value per hour over the newest seven days."""
    return q_events_per_hour(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "events_per_hour": q_events_per_hour,
        "events_per_hour_type": q_events_per_hour_type,
        "hourly_domain": q_hourly_domain,
        "daily_summary": q_daily_summary,
        "daily_summary_city": q_daily_summary_city,
        "one_series": q_one_series,
        "all_series": q_all_series,
        "daily_domain": q_daily_domain,
        "chart_domain": q_chart_domain,
        "chart_totals": q_chart_totals,
        "chart_day_ticks": q_chart_day_ticks,
        "chart_axis": q_chart_axis,
        "keep_latest": q_keep_latest,
        "latest_per_user": q_latest_per_user,
        "merge_latest": q_merge_latest,
        "merge_insert_only": q_merge_insert_only,
        "day_compaction": q_day_compaction,
        "csv_landing_roundtrip": q_csv_landing_roundtrip,
        "event_feed_hourly": q_event_feed_hourly,
        "layout_equivalence": q_layout_equivalence,
        "layout_report": q_layout_report,
        "stream_compaction": q_stream_compaction,
        "stream_dedup": q_stream_dedup,
        "stream_hourly": q_stream_hourly,
        "stream_latest": q_stream_latest,
        "window_bounds": q_window_bounds,
        "window_totals": q_window_totals,
        "top_groups": q_top_groups,
        "top_users": q_top_users,
        "top_hosts": q_top_hosts,
        "leaders_by_day": q_leaders_by_day,
        "class_mix": q_class_mix,
        "dashboard_totals": q_dashboard_totals,
        "dashboard_hours": q_dashboard_hours,
        "dashboard_quad_labels": q_dashboard_quad_labels,
        "dashboard_tone": q_dashboard_tone,
        "country_hours": q_country_hours,
        "snapshot_latest": q_snapshot_latest,
        "snapshot_insert_only": q_snapshot_insert_only,
        "backfill_replace": q_backfill_replace,
        "csv_by_header": q_csv_by_header,
        "payload_rows": q_payload_rows,
        "weather_feed_daily": q_weather_feed_daily,
        "last_days": q_last_days,
        "run_report": q_run_report,
        "adhoc_capped": q_adhoc_capped,
        "delta_read": q_delta_read,
        "delta_folded": q_delta_folded,
        "snapshot_incremental": q_snapshot_incremental,
        "snapshot_incremental_insert_only": q_snapshot_incremental_insert_only,
        "cross_day_dedup": q_cross_day_dedup,
        "cross_day_insert_only": q_cross_day_insert_only,
        "hourly_rollup": q_hourly_rollup,
        "distinct_users": q_distinct_users,
        "stream_deltas": q_stream_deltas,
        "stream_late": q_stream_late,
        "stream_hourly_append": q_stream_hourly_append,
        "nested_series": q_nested_series,
        "zip_roundtrip": q_zip_roundtrip,
        "landing_gaps": q_landing_gaps,
        "lenient_cast": q_lenient_cast,
        "cast_loss": q_cast_loss,
        "regex_count_urls": q_regex_count_urls,
        "regex_count_docs": q_regex_count_docs,
        "probe_modsum": q_probe_modsum,
        "probe_groups": q_probe_groups,
        "gap_audit": q_gap_audit,
        "dup_audit_docs": q_dup_audit_docs,
        "dup_audit_events": q_dup_audit_events,
        "freshness": q_freshness,
        "adhoc_sql": q_adhoc_sql,
        **(_llm.QUERIES if _llm else {}),
    }


_WINDOW7 = "ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY"
_READINGS = (f"(SELECT * FROM events WHERE {_WINDOW7} QUALIFY row_number() OVER "
             "(PARTITION BY event_type, ts ORDER BY event_id DESC) = 1)")
_DAY7 = ("CAST(ts AS DATE) BETWEEN (SELECT max(CAST(ts AS DATE)) - 6 FROM events) "
         "AND (SELECT max(CAST(ts AS DATE)) FROM events)")
_SPLIT = """
    cut AS (SELECT max(CAST(ts AS DATE)) - 1 AS c FROM events),
    old AS (SELECT * FROM events WHERE CAST(ts AS DATE) <= (SELECT c FROM cut)),
    new AS (SELECT event_id, ts, user_id, event_type, value + 1 AS value, props
            FROM events WHERE CAST(ts AS DATE) >= (SELECT c FROM cut))"""
_NUMBER_TEXTS = """
    SELECT event_id, CASE event_id % 8 WHEN 0 THEN k WHEN 1 THEN ' ' || k || ' ' WHEN 2 THEN k || '.5' WHEN 3 THEN '-' || k || '.25'
                     WHEN 4 THEN k || 'e1' WHEN 5 THEN 'nan' WHEN 6 THEN '' ELSE 'abc' END AS k_raw
    FROM (SELECT event_id, json_extract_string(props, '$.k') AS k FROM events)"""
_DASH = f"(SELECT *, CAST(ts AS DATE) AS day, user_id % 4 + 1 AS QuadClass FROM events WHERE {_DAY7})"
_MERGE_LATEST = f"""
    WITH {_SPLIT}
    SELECT * FROM old o WHERE NOT EXISTS (SELECT 1 FROM new n WHERE n.event_id = o.event_id)
    UNION ALL SELECT * FROM new"""


def oracle_sql() -> dict[str, str]:
    return {
        "events_per_hour": f"""
            SELECT date_trunc('hour', ts) AS h, count(*) AS n, round(avg(value), 4) AS tone
            FROM events WHERE {_WINDOW7} GROUP BY 1""",
        "events_per_hour_type": f"""
            SELECT date_trunc('hour', ts) AS h, count(*) AS n, round(avg(value), 4) AS tone
            FROM events WHERE {_WINDOW7} AND event_type = 'view' GROUP BY 1""",
        "hourly_domain": f"""
            SELECT CAST(max(n) AS DOUBLE) * 1.05 AS top, CAST(sum(n) AS BIGINT) AS total FROM (
              SELECT date_trunc('hour', ts) AS h, count(*) AS n FROM events WHERE {_WINDOW7} GROUP BY 1)""",
        "daily_summary": """
            SELECT event_type AS city, CAST(ts AS DATE) AS day, round(avg(value), 1) AS mean_c,
                   round(min(value), 1) AS min_c, round(max(value), 1) AS max_c,
                   CAST(round(sum(CAST(value AS DECIMAL(38, 6))), 1) AS DOUBLE) AS rain_mm,
                   count(*) AS readings
            FROM events GROUP BY 1, 2""",
        "daily_summary_city": """
            SELECT event_type AS city, CAST(ts AS DATE) AS day, round(avg(value), 1) AS mean_c,
                   round(min(value), 1) AS min_c, round(max(value), 1) AS max_c,
                   CAST(round(sum(CAST(value AS DECIMAL(38, 6))), 1) AS DOUBLE) AS rain_mm,
                   count(*) AS readings
            FROM events WHERE event_type = 'click' GROUP BY 1, 2""",
        "one_series": f"""
            SELECT strftime(ts, '%Y-%m-%dT%H:%M') AS time, value, user_id
            FROM events WHERE event_type = 'view' AND {_WINDOW7}
            QUALIFY row_number() OVER (PARTITION BY ts ORDER BY event_id DESC) = 1""",
        "all_series": f"""
            SELECT event_type AS city, strftime(ts, '%Y-%m-%dT%H:%M') AS time, value
            FROM events WHERE {_WINDOW7}
            QUALIFY row_number() OVER (PARTITION BY event_type, ts ORDER BY event_id DESC) = 1""",
        "daily_domain": """
            SELECT min(round(lo, 1)) - 1 AS lo, max(round(hi, 1)) + 1 AS hi FROM (
              SELECT min(value) AS lo, max(value) AS hi FROM events GROUP BY event_type, CAST(ts AS DATE))""",
        "chart_domain": f"""
            SELECT min(value) - 1 AS lo, max(value) + 1 AS hi, greatest(max(value), 1.0) AS rmax
            FROM {_READINGS}""",
        "chart_totals": f"""
            SELECT event_type, count(*) AS readings, max(ts) AS latest, arg_max(value, ts) AS last_value,
                   count(*) FILTER (WHERE value > 0) AS wet_readings,
                   CAST(round(sum(CAST(value AS DECIMAL(38, 6))), 1) AS DOUBLE) AS rain_total
            FROM {_READINGS} GROUP BY 1""",
        "chart_day_ticks": f"""
            SELECT event_type, CAST(ts AS DATE) AS day, min(ts) AS first_time
            FROM {_READINGS} GROUP BY 1, 2""",
        "chart_axis": f"""
            SELECT ts, row_number() OVER (ORDER BY ts) - 1 AS pos
            FROM (SELECT DISTINCT ts FROM events WHERE {_WINDOW7} AND ts IS NOT NULL)""",
        "keep_latest": """
            SELECT * FROM conversations
            QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1""",
        "latest_per_user": """
            SELECT * FROM events
            QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
        "merge_latest": _MERGE_LATEST,
        "merge_insert_only": f"""
            WITH {_SPLIT}
            SELECT * FROM old
            UNION ALL
            SELECT * FROM new n WHERE NOT EXISTS (SELECT 1 FROM old o WHERE o.event_id = n.event_id)""",
        "snapshot_latest": _MERGE_LATEST,
        "snapshot_insert_only": f"""
            WITH {_SPLIT}
            SELECT * FROM old
            UNION ALL
            SELECT * FROM new n WHERE NOT EXISTS (SELECT 1 FROM old o WHERE o.event_id = n.event_id)""",
        "delta_read": f"SELECT *, CAST(ts AS DATE) AS ingest_day FROM ({_MERGE_LATEST})",
        "delta_folded": f"SELECT *, CAST(ts AS DATE) AS ingest_day FROM ({_MERGE_LATEST})",
        "snapshot_incremental": _MERGE_LATEST,
        "snapshot_incremental_insert_only": f"""
            WITH {_SPLIT}
            SELECT * FROM old
            UNION ALL
            SELECT * FROM new n WHERE NOT EXISTS (SELECT 1 FROM old o WHERE o.event_id = n.event_id)""",
        "cross_day_dedup": f"""
            WITH {_SPLIT}
            SELECT *, CAST(ts AS DATE) AS ingest_day FROM old o WHERE NOT EXISTS (SELECT 1 FROM new n WHERE n.event_id = o.event_id)
            UNION ALL SELECT *, CAST(ts AS DATE) + 1 FROM new""",
        "cross_day_insert_only": f"""
            WITH {_SPLIT}
            SELECT *, CAST(ts AS DATE) AS ingest_day FROM old
            UNION ALL SELECT *, CAST(ts AS DATE) + 1 FROM new n WHERE NOT EXISTS (SELECT 1 FROM old o WHERE o.event_id = n.event_id)""",
        "hourly_rollup": f"""
            SELECT date_trunc('hour', ts) AS h, event_type, count(*) AS n, min(value) AS low, max(value) AS high,
                   CAST(sum(CAST(value AS DECIMAL(38, 10))) AS DOUBLE) AS total,
                   CAST(sum(CAST(value AS DECIMAL(38, 10))) AS DOUBLE) / count(value) AS tone
            FROM ({_MERGE_LATEST}) GROUP BY 1, 2""",
        "distinct_users": """
            SELECT CAST(ts AS DATE) AS ingest_day, count(DISTINCT user_id) AS users, true AS sketch_near FROM events
            WHERE user_id IS NOT NULL GROUP BY 1""",
        "stream_deltas": f"SELECT *, CAST(ts AS DATE) AS ingest_day FROM ({_MERGE_LATEST})",
        "stream_late": """
            SELECT 'first' AS kind, event_id, ts, user_id, event_type, value, props FROM events
            UNION ALL
            SELECT 'late', event_id, ts, user_id, event_type, value, props FROM events
            WHERE CAST(ts AS DATE) = (SELECT min(CAST(ts AS DATE)) + 1 FROM events)""",
        "stream_hourly_append": """
            SELECT date_trunc('hour', ts) AS h, count(*) AS n, round(avg(value), 4) AS tone FROM events GROUP BY 1""",
        "nested_series": f"SELECT event_type AS city, ts AS time, value FROM {_READINGS}",
        "zip_roundtrip": """
            SELECT event_id AS GlobalEventID, date_trunc('second', ts) AS ts, value AS AvgTone, upper(event_type[1:2]) AS ActionGeo_CountryCode,
                   props AS SOURCEURL, CAST(ts AS DATE) AS event_day, 61 AS _nfields FROM events""",
        "landing_gaps": """
            WITH b AS (SELECT min(CAST(ts AS DATE)) AS a, max(CAST(ts AS DATE)) AS z FROM events),
            slots AS (SELECT unnest(generate_series(CAST(a AS TIMESTAMP), CAST(z AS TIMESTAMP) + INTERVAL 1425 MINUTE, INTERVAL 15 MINUTE)) AS slot FROM b),
            seen AS (SELECT DISTINCT time_bucket(INTERVAL 15 MINUTE, ts) AS slot FROM events
                     WHERE NOT ((day(ts) % 3 = 0 AND hour(ts) BETWEEN 22 AND 23) OR (day(ts) % 3 = 1 AND hour(ts) < 5))),
            gone AS (SELECT slot, slot - row_number() OVER (ORDER BY slot) * INTERVAL 15 MINUTE AS run
                     FROM slots WHERE slot NOT IN (SELECT slot FROM seen))
            SELECT min(slot) AS gap_from, max(slot) AS gap_to, count(*) AS slots FROM gone GROUP BY run""",
        "backfill_replace": """
            SELECT *, CAST(ts AS DATE) AS ingest_day FROM events
            WHERE event_type <> 'purchase' OR CAST(ts AS DATE) < (SELECT max(CAST(ts AS DATE)) FROM events)""",
        "csv_by_header": "SELECT event_id, ts, user_id, event_type, value, props FROM events",
        "weather_feed_daily": f"""
            WITH pull AS (SELECT date_trunc('hour', ts) AS h, event_id % {len(CITIES)} AS k, max(value) AS t, CAST(count(*) AS DECIMAL(38, 6)) AS n
                          FROM events GROUP BY 1, 2),
            got AS (SELECT {[c[0] for c in CITIES]}[k + 1] AS city, CAST(h AS DATE) AS day, n,
                           CASE WHEN CAST(h AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events) THEN t + 1 ELSE t END AS t FROM pull)
            SELECT city, day, round(avg(t), 1) AS mean_c, round(min(t), 1) AS min_c, round(max(t), 1) AS max_c,
                   CAST(round(sum(n), 1) AS DOUBLE) AS rain_mm, count(*) AS readings FROM got GROUP BY 1, 2""",
        "last_days": """
            WITH newest AS (SELECT max(CAST(ts AS DATE)) AS d FROM events)
            SELECT CAST(ts AS DATE) AS ingest_day, count(*) AS n, round(sum(value), 2) AS total FROM events, newest
            WHERE CAST(ts AS DATE) > d - 7 AND CAST(ts AS DATE) <> d - 2 GROUP BY 1""",
        "run_report": f"""
            WITH {_SPLIT},
            days AS (SELECT DISTINCT CAST(ts AS DATE) AS d FROM new),
            met AS (SELECT event_id, CAST(ts AS DATE) AS d FROM old WHERE CAST(ts AS DATE) IN (SELECT d FROM days))
            SELECT 'run0' AS batch, 0::BIGINT AS rows_before, count(*) AS rows_in, count(*) AS rows_after, 0::BIGINT AS rejects,
                   count(DISTINCT CAST(ts AS DATE)) AS partitions FROM old
            UNION ALL SELECT 'run1', (SELECT count(*) FROM met), (SELECT count(*) FROM new),
                   (SELECT count(*) FROM (SELECT * FROM met UNION SELECT event_id, CAST(ts AS DATE) FROM new)), 0, (SELECT count(*) FROM days)""",
        "adhoc_capped": "SELECT event_id, user_id, value FROM events ORDER BY value DESC, event_id LIMIT 500",
        "payload_rows": f"""
            WITH city(pos, name) AS (VALUES {", ".join(f"({k}, '{c[0]}')" for k, c in enumerate(CITIES))}),
            sent AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS pos, value FROM events),
            size AS (SELECT user_id, count(*) AS n FROM sent GROUP BY 1),
            place AS (SELECT user_id, unnest(range(greatest(n, {len(CITIES)}))) AS pos FROM size WHERE user_id % 10 <> 0)
            SELECT user_id, 0 AS pos, 'unreadable' AS what, NULL::DOUBLE AS temperature_c FROM size WHERE user_id % 10 = 0
            UNION ALL
            SELECT place.user_id, place.pos, CASE WHEN name IS NULL THEN 'no city' WHEN sent.user_id IS NULL THEN 'no entry'
                   ELSE name END, CASE WHEN name IS NOT NULL THEN value END
            FROM place LEFT JOIN city USING (pos) LEFT JOIN sent ON sent.user_id = place.user_id AND sent.pos = place.pos""",
        "layout_report": "SELECT CAST(ts AS DATE) AS ingest_day, count(*) AS rows FROM events GROUP BY 1",
        "dashboard_totals": f"SELECT count(*) AS rows_scanned, count(DISTINCT day) AS days FROM {_DASH}",
        "dashboard_hours": f"SELECT date_trunc('hour', ts) AS hour, count(*) AS events FROM {_DASH} GROUP BY 1",
        "dashboard_quad_labels": f"""
            SELECT day, QuadClass, events, round(events / sum(events) OVER (PARTITION BY day), 6) AS share,
                   CASE QuadClass WHEN 1 THEN 'verbal coop' WHEN 2 THEN 'material coop' WHEN 3 THEN 'verbal conflict'
                        WHEN 4 THEN 'material conflict' END AS class
            FROM (SELECT day, QuadClass, count(*) AS events FROM {_DASH} GROUP BY 1, 2)""",
        "dashboard_tone": f"""
            SELECT day, event_type AS country, round(avg(value), 4) AS tone FROM {_DASH}
            WHERE event_type IN (SELECT event_type FROM {_DASH} GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 2) GROUP BY 1, 2""",
        "country_hours": f"""
            SELECT date_trunc('hour', ts) AS h, count(*) AS n, round(avg(value), 4) AS tone
            FROM events WHERE upper(event_type[1:2]) = 'VI' AND {_WINDOW7} GROUP BY 1""",
        "day_compaction": f"SELECT *, CAST(ts AS DATE) AS ingest_day FROM ({_MERGE_LATEST})",
        "csv_landing_roundtrip": "SELECT event_id, ts, user_id, event_type, value, props FROM events",
        "event_feed_hourly": """
            WITH t AS (SELECT date_trunc('second', ts) AS ts, value FROM events)
            SELECT date_trunc('hour', ts) AS h, count(*) AS n, round(avg(value), 4) AS tone
            FROM t WHERE ts >= (SELECT max(ts) FROM t) - INTERVAL 7 DAY GROUP BY 1""",
        "layout_equivalence": " UNION ALL ".join(f"""
            SELECT '{name}' AS layout, date_trunc('hour', ts) AS h, count(*) AS n, round(avg(value), 4) AS tone
            FROM events WHERE {_WINDOW7} GROUP BY 2""" for name in ("parquet", "csv", "days")),
        "stream_compaction": f"SELECT *, CAST(ts AS DATE) AS ingest_day FROM ({_MERGE_LATEST})",
        "stream_dedup": "SELECT event_id, ts, user_id, event_type, value, props FROM events",
        "stream_hourly": """
            SELECT date_trunc('hour', ts) AS h, count(*) AS n, round(avg(value), 4) AS tone
            FROM events GROUP BY 1""",
        "stream_latest": """
            SELECT event_type, arg_max(value, ts) AS last_value, max(ts) AS latest FROM events GROUP BY 1""",
        "window_bounds": """
            SELECT max(CAST(ts AS DATE)) AS last_day, max(CAST(ts AS DATE)) - 6 AS first_day FROM events""",
        "window_totals": f"""
            SELECT count(*) AS rows_scanned, count(DISTINCT CAST(ts AS DATE)) AS days
            FROM events WHERE {_DAY7}""",
        "top_groups": f"""
            SELECT event_type AS country, count(*) AS events FROM events
            WHERE {_DAY7} AND event_type IS NOT NULL AND event_type <> ''
            GROUP BY 1 ORDER BY events DESC, country LIMIT 15""",
        "top_users": f"""
            SELECT user_id, count(*) AS events FROM events
            WHERE {_DAY7} AND user_id IS NOT NULL
            GROUP BY 1 ORDER BY events DESC, user_id LIMIT 15""",
        "top_hosts": r"""
            SELECT regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1) AS host, count(*) AS pages
            FROM pages
            WHERE regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1) <> ''
            GROUP BY 1 ORDER BY pages DESC, host LIMIT 15""",
        "leaders_by_day": f"""
            WITH w AS (SELECT *, CAST(ts AS DATE) AS day FROM events WHERE {_DAY7}),
            leaders AS (SELECT user_id FROM w WHERE user_id IS NOT NULL
                        GROUP BY 1 ORDER BY count(*) DESC, user_id LIMIT 6)
            SELECT day, user_id, round(avg(value), 4) AS tone
            FROM w WHERE user_id IN (SELECT user_id FROM leaders) GROUP BY 1, 2""",
        "class_mix": f"""
            SELECT day, event_type, events, round(events / sum(events) OVER (PARTITION BY day), 4) AS share
            FROM (SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS events
                  FROM events WHERE {_DAY7} GROUP BY 1, 2)""",
        "lenient_cast": r"""
            SELECT event_id, TRY_CAST(trim(k_raw) AS BIGINT) AS k FROM (""" + _NUMBER_TEXTS + """)""",
        "cast_loss": r"""
            SELECT 'k' AS "column", count(*) FILTER (WHERE trim(k_raw) <> '' AND TRY_CAST(trim(k_raw) AS BIGINT) IS NULL) AS lost
            FROM (""" + _NUMBER_TEXTS + """)
            UNION ALL
            SELECT 'event_type_code', count(*) FILTER (WHERE trim(event_type) <> '' AND TRY_CAST(event_type AS BIGINT) IS NULL)
            FROM events""",
        "regex_count_urls": """
            SELECT count(*) FILTER (WHERE regexp_matches(url, '(news|press|times|post)')) AS n FROM pages""",
        "regex_count_docs": """
            SELECT count(*) FILTER (WHERE regexp_matches(text, '(news|press|times|post)')) AS n FROM documents""",
        "probe_modsum": """
            SELECT CAST(sum((l_orderkey * 2654435761) % 1000003) AS BIGINT) AS s FROM lineitem""",
        "probe_groups": """
            SELECT count(*) AS groups, CAST(sum(s) AS BIGINT) AS total FROM (SELECT l_orderkey % 7 AS k, sum(l_orderkey) AS s FROM lineitem GROUP BY 1)""",
        "gap_audit": """
            WITH b AS (SELECT min(CAST(ts AS DATE)) AS a, max(CAST(ts AS DATE)) AS z FROM events),
            slots AS (SELECT unnest(generate_series(CAST(a AS TIMESTAMP), CAST(z AS TIMESTAMP) + INTERVAL 1425 MINUTE,
                                                    INTERVAL 15 MINUTE)) AS slot FROM b),
            seen AS (SELECT DISTINCT time_bucket(INTERVAL 15 MINUTE, ts) AS slot FROM events WHERE ts IS NOT NULL)
            SELECT slot FROM slots WHERE NOT EXISTS (SELECT 1 FROM seen WHERE seen.slot = slots.slot)""",
        "dup_audit_docs": """
            SELECT sha256(text) AS text_sha256, count(*) AS copies, count(DISTINCT (lang, source)) AS versions
            FROM documents GROUP BY 1 HAVING count(*) > 1""",
        "dup_audit_events": f"""
            WITH {_SPLIT},
            both_ AS (SELECT * FROM events UNION ALL SELECT * FROM new)
            SELECT event_id, count(*) AS copies,
                   count(DISTINCT (ts, user_id, event_type, value, props)) AS versions
            FROM both_ GROUP BY 1 HAVING count(*) > 1""",
        "freshness": """
            SELECT event_type, max(ts) AS newest,
                   CAST(epoch_us((SELECT max(ts) FROM events)) - epoch_us(max(ts)) AS DOUBLE) / 1000000 AS age_seconds
            FROM events GROUP BY 1""",
        "adhoc_sql": """
            SELECT event_type AS city, count(*) AS readings FROM events GROUP BY 1""",
        **(_llm.ORACLES if _llm else {}),
    }
