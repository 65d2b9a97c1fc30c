"""Jobs for spark-submit: ``python -m feedloom <command> ...``.

Each command is one Spark job over files; query commands print their (bounded) answer as
JSON rows: hourly and daily answers have one row per hour or day; SQL prints at most ``--limit`` rows and says
whether there were more. Compactions take today's and yesterday's landing folders unless told ``--days``.

  land-events     --exports GLOB --landing PATH
  compact-events  --landing PATH --table PATH [--days D ... | --days all] [--layout day|snapshot]
                  [--mode latest|insert_only|replace] [--by-name]
  land-weather    --payloads GLOB --landing PATH
  compact-weather --landing PATH --table PATH [--days D ... | --days all] [--layout day|snapshot]
                  [--mode latest|insert_only] [--by-name]
  stream-compact  --landing PATH --table PATH --checkpoint PATH [--feed events|weather] [--every "15 minutes"]
  hourly          --table PATH | --landing PATH [--country CA] [--days 7] [--as-of now|latest|newest_partition]
  daily           --table PATH [--city NAME]
  series          --table PATH --out PATH [--city NAME] [--days 7] [--as-of now|latest|newest_partition]
  dashboard       --table PATH [--days 7] [--top 15] [--tone 6]
  sql             --table PATH [--view weather] [--q "SELECT ..."] [--limit 500]
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from pyspark.sql import DataFrame


def _emit(name: str, df: DataFrame, out=sys.stdout) -> None:
    from feedloom.operators.layout import to_json_rows
    rows = [json.loads(r.json) for r in to_json_rows(df).collect()]
    print(json.dumps({name: rows}), file=out)


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="feedloom")
    sub = p.add_subparsers(dest="cmd", required=True)
    a = sub.add_parser("land-events"); a.add_argument("--exports", required=True); a.add_argument("--landing", required=True)
    a = sub.add_parser("compact-events"); a.add_argument("--landing", required=True); a.add_argument("--table", required=True)
    a.add_argument("--days", nargs="*"); a.add_argument("--layout", default="day", choices=["day", "snapshot"])
    a.add_argument("--mode", default="latest", choices=["latest", "insert_only", "replace"]); a.add_argument("--by-name", action="store_true")
    a = sub.add_parser("land-weather"); a.add_argument("--payloads", required=True); a.add_argument("--landing", required=True)
    a = sub.add_parser("compact-weather"); a.add_argument("--landing", required=True); a.add_argument("--table", required=True)
    a.add_argument("--days", nargs="*"); a.add_argument("--layout", default="day", choices=["day", "snapshot"])
    a.add_argument("--mode", default="latest", choices=["latest", "insert_only"]); a.add_argument("--by-name", action="store_true")
    a = sub.add_parser("stream-compact"); a.add_argument("--landing", required=True); a.add_argument("--table", required=True)
    a.add_argument("--checkpoint", required=True); a.add_argument("--feed", default="events", choices=["events", "weather"])
    a.add_argument("--every", default=None, help="processing-time trigger, e.g. '15 minutes'; default availableNow")
    a = sub.add_parser("hourly"); a.add_argument("--table"); a.add_argument("--landing"); a.add_argument("--country")
    a.add_argument("--days", type=int, default=7); a.add_argument("--as-of", default="now")
    a = sub.add_parser("daily"); a.add_argument("--table", required=True); a.add_argument("--city")
    a = sub.add_parser("series"); a.add_argument("--table", required=True); a.add_argument("--out", required=True)
    a.add_argument("--city"); a.add_argument("--days", type=int, default=7); a.add_argument("--as-of", default="now")
    a = sub.add_parser("dashboard"); a.add_argument("--table", required=True); a.add_argument("--days", type=int, default=7)
    a.add_argument("--top", type=int, default=15); a.add_argument("--tone", type=int, default=6)
    a = sub.add_parser("sql"); a.add_argument("--table", required=True); a.add_argument("--view", default="weather")
    a.add_argument("--q"); a.add_argument("--limit", type=int, default=500)
    return p


def _days(given: list[str] | None) -> list[str] | None:
    """The landing days a compaction takes: those given, all (None), or today and yesterday (UTC)."""
    if given == ["all"]:
        return None
    today = dt.datetime.now(dt.timezone.utc).date()
    return given or [str(today - dt.timedelta(days=1)), str(today)]


def main(argv=None, spark=None, out=sys.stdout) -> int:
    args = _parser().parse_args(argv)
    from feedloom.session import build_session
    spark = spark or build_session()
    from feedloom.plans import feeds

    if args.cmd == "land-events":
        print(json.dumps(feeds.land_event_exports(spark, args.exports, args.landing)), file=out)
    elif args.cmd == "compact-events":
        print(json.dumps(feeds.compact_events(spark, args.landing, args.table, _days(args.days), args.layout, args.mode, args.by_name),
                         default=str), file=out)
    elif args.cmd == "land-weather":
        print(json.dumps({"unmatched": feeds.land_weather_payloads(spark, args.payloads, args.landing).count()}), file=out)
    elif args.cmd == "compact-weather":
        print(json.dumps(feeds.compact_weather(spark, args.landing, args.table, _days(args.days), args.layout, args.mode, args.by_name),
                         default=str), file=out)
    elif args.cmd == "stream-compact":
        _stream_compact(spark, args)
    elif args.cmd == "hourly":
        from feedloom.plans.hourly import hourly
        t = feeds.landed_events(spark, args.landing) if args.landing else _table(spark, args.table)
        part = "ingest_day" if "ingest_day" in t.columns else None
        _emit("hourly", hourly(t, as_of=args.as_of, days=args.days, group=args.country, partition_col=part)
              .orderBy("h"), out)
    elif args.cmd == "daily":
        from feedloom.plans.series import daily_summary
        _emit("daily", daily_summary(_table(spark, args.table), city=args.city), out)
    elif args.cmd == "series":
        # The pre-rendered series (K7): written as a sorted table rather than drawn.
        from feedloom.operators.layout import materialise
        from feedloom.plans.series import series_all, series_one
        t = _table(spark, args.table)
        part = "day" if "day" in t.columns else None
        if args.city:
            s = series_one(t, args.city, as_of=args.as_of, days=args.days, partition_col=part)
            order = ["time"]
        else:
            s = series_all(t, as_of=args.as_of, days=args.days, partition_col=part)
            order = ["city", "time"]
        n = materialise(s, args.out, sort_by=order).count()
        print(json.dumps({"written": args.out, "rows": n}), file=out)
    elif args.cmd == "dashboard":
        from feedloom.plans.dashboard import dashboard
        d = dashboard(spark.read.parquet(args.table), days=args.days, top=args.top, tone=args.tone)
        for name, df in d.items():
            _emit(name, df, out)
    elif args.cmd == "sql":
        from feedloom.operators.layout import to_json_rows
        from feedloom.plans.adhoc import adhoc
        rows = adhoc(spark, {args.view: _table(spark, args.table)}, args.q)
        shown = [json.loads(r.json) for r in to_json_rows(rows.limit(args.limit + 1)).collect()]
        print(json.dumps({"rows": shown[:args.limit], "truncated": len(shown) > args.limit}), file=out)
    return 0


def _table(spark, path: str):
    """A day table, or the current version of a snapshot root."""
    from feedloom.operators.layout import current_version, read_snapshot
    return read_snapshot(spark, path) if current_version(spark, path)[1] else spark.read.parquet(path)


def _stream_compact(spark, args) -> None:
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    from feedloom.operators import normalize
    from feedloom.schemas import EVENT_FIELDS, WEATHER_FIELDS
    from feedloom.sources.csv import CORRUPT
    from feedloom.streaming import stream as st

    fields = EVENT_FIELDS if args.feed == "events" else WEATHER_FIELDS
    ragged = [CORRUPT] if args.feed == "events" else []
    schema = T.StructType([T.StructField(c, T.StringType()) for c in fields + ["stamp"] + ragged]
                          + [T.StructField("ingest_day", T.DateType())])
    s = st.landed_stream(spark, args.landing, schema)
    trigger = {"processingTime": args.every} if args.every else st.AVAILABLE_NOW
    if args.feed == "events":
        def typed(b):
            return normalize.events_flagged(b).drop("stamp")
        q = st.compaction_query(s, args.table, "GlobalEventID", args.checkpoint, order=[F.desc("ts")],
                                normalise=typed, trigger=trigger, cluster_by=["GlobalEventID"],
                                reject_col=normalize.BAD, raw_col=CORRUPT)
    else:
        def typed(b):
            return normalize.weather_flagged(b).withColumn("day", F.to_date("time")).drop("stamp", "ingest_day")
        q = st.compaction_query(s, args.table, ["city", "time"], args.checkpoint, day_col="day",
                                normalise=typed, trigger=trigger, cluster_by=["time", "city"],
                                reject_col=normalize.BAD)
    if args.every:
        q.awaitTermination()
    else:
        st.run_until_done(q)


if __name__ == "__main__":
    raise SystemExit(main())
