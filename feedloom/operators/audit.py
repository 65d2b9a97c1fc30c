"""Audits: what the feeds' own code drops silently, reported as tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedloom.functions.casts import lost_in_cast
from feedloom.operators.dedup import comparable
from feedloom.sources.files import slots, stamp_of


def _cols(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def gaps(df: DataFrame, ts: str = "ts", minutes: int = 15, first=None, last=None) -> DataFrame:
    """Slots of ``minutes`` with no row, over every calendar day from the first to the last (A1).

    Both sides are bounded by the calendar (96 slots a day), so the anti join is small
    whatever the row count; the landed side is reduced to distinct slots map-side first.
    """
    t = df.schema[ts].dataType.simpleString()
    days = df.agg(F.min(F.to_date(ts)).alias("a"), F.max(F.to_date(ts)).alias("b"))
    if first is not None:
        days = days.withColumn("a", F.lit(first).cast("date"))
    if last is not None:
        days = days.withColumn("b", F.lit(last).cast("date"))
    cal = days.select(F.explode(F.sequence("a", "b")).alias("day")).repartition("day")  # slots come from many tasks
    expected = slots(cal, "day", minutes, as_ntz=(t == "timestamp_ntz")).select("slot")
    seen = df.select(F.window(ts, f"{minutes} minutes").start.cast(t).alias("slot")).distinct()
    return expected.join(seen, "slot", "left_anti")


def landing_gaps(files: DataFrame, first, last, minutes: int = 15, path: str = "path") -> DataFrame:
    """Missing slots of a landing, joined to runs: ``gap_from``, ``gap_to`` (first and last missing slot), ``slots``.

    ``files`` lists landed files (``layout.list_files``); their stamps come from their names, names without one and
    stamps outside the days ``first`` to ``last`` do not count, nor do files of no bytes (Spark's listing passes over them). Runs inside a day are found in that day's own window, runs
    across days from one row per day that has any file, so no task sees all slots.
    """
    step = minutes * 60
    at = F.unix_seconds(F.try_to_timestamp(stamp_of(path), F.lit("yyyyMMddHHmmss")))
    low = F.unix_date(F.lit(first).cast("date")).cast("bigint") * (86_400 // step)
    high = (F.unix_date(F.lit(last).cast("date")).cast("bigint") + 1) * (86_400 // step) - 1
    seen = files.select(F.floor(at / step).alias("n")).filter(F.col("n").between(low, high)).distinct()
    seen = seen.withColumn("day", F.floor(F.col("n") / (86_400 // step)))
    inside = seen.withColumn("next", F.lead("n").over(Window.partitionBy("day").orderBy("n"))).select((F.col("n") + 1).alias("a"), (F.col("next") - 1).alias("b"))
    edges = files.sparkSession.range(1).select(F.explode(F.array(F.struct((low - 1).alias("a"), (low - 1).alias("b")),
                                                                 F.struct((high + 1).alias("a"), (high + 1).alias("b")))).alias("e")).select("e.*")
    days = seen.groupBy("day").agg(F.min("n").alias("a"), F.max("n").alias("b")).select("a", "b").unionByName(edges)
    over = Window.orderBy("a")  # one row per day
    between = days.select((F.lag("b").over(over) + 1).alias("a"), (F.col("a") - 1).alias("b"))
    runs = inside.unionByName(between).filter("b >= a")
    time = lambda c: F.timestamp_seconds(F.col(c) * step).cast("timestamp_ntz")
    return runs.select(time("a").alias("gap_from"), time("b").alias("gap_to"), (F.col("b") - F.col("a") + 1).alias("slots"))


def cast_loss(typed: DataFrame, pairs: dict[str, str]) -> DataFrame:
    """One row per column: how many non-empty raw values became NULL (A2).

    ``pairs`` maps a typed column to its raw text column in the same frame.
    """
    aggs = [F.count_if(lost_in_cast(raw, col)).alias(col) for col, raw in pairs.items()]
    wide = typed.agg(*aggs)
    stack = ", ".join(f"'{c}', `{c}`" for c in pairs)
    return wide.selectExpr(f"stack({len(pairs)}, {stack}) as (column, lost)")


def duplicates(df: DataFrame, keys, value_cols: Sequence[str] | None = None) -> DataFrame:
    """Keys with more than one row: ``copies`` and ``versions`` (distinct non-key contents) (A3).

    ``versions > 1`` means the copies conflict. Contents travel as 128-bit digests, and the distinct count
    is planned as a two-level aggregate on (key, digest), so a hot key's copies are spread and combined first.
    """
    ks = _cols(keys)
    vals = list(value_cols) if value_cols is not None else [c for c in df.columns if c not in ks]
    contents = F.unhex(F.md5(F.to_json(F.struct(*[comparable(df, c).alias(c) for c in vals]), {"ignoreNullFields": "false"}).cast("binary")))
    return (df.groupBy(*ks)
              .agg(F.count(F.lit(1)).alias("copies"), F.count_distinct(contents).alias("versions"))
              .filter(F.col("copies") > 1))


def ragged(df: DataFrame, corrupt: str = "_corrupt_record", width_col: str | None = None,
           expected: int | None = None) -> DataFrame:
    """Rows whose field count differs from the schema (A4)."""
    if width_col is not None:
        return df.filter(F.col(width_col) != F.lit(expected))
    return df.filter(F.col(corrupt).isNotNull())


def freshness(df: DataFrame, as_of="latest", ts: str = "ts", group: str | None = None) -> DataFrame:
    """Newest row and its age in seconds at ``as_of``, per group or overall (A5).

    ``as_of`` is ``"latest"`` (newest row of the whole table), ``"now"``, a literal or a Column.
    """
    from feedloom.plans.lookback import resolve_as_of
    anchor = resolve_as_of(df, ts, as_of)
    out = (df.groupBy(group) if group else df.groupBy()).agg(F.max(ts).alias("newest"))
    micros = F.unix_micros(anchor.cast("timestamp")) - F.unix_micros(F.col("newest").cast("timestamp"))
    return out.withColumn("age_seconds", (micros / 1_000_000).cast("double"))


def layout_report(spark: SparkSession, root: str, day_col: str = "ingest_day") -> DataFrame:
    """Files, rows and bytes per day partition of a Parquet table (A6), from Spark's own file metadata."""
    rows = spark.read.parquet(root).select(day_col, F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"))
    files = rows.groupBy(day_col, "path").agg(F.count(F.lit(1)).alias("rows"), F.max("size").alias("size"))
    return files.groupBy(day_col).agg(F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"), F.sum("size").alias("bytes"))


def same_answer(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows in one answer and not the other, both ways, tagged by side (A7). Empty = equal."""
    cols = a.columns
    b = b.select(*cols)
    return (a.exceptAll(b).withColumn("side", F.lit("left_only"))
             .unionByName(b.exceptAll(a).withColumn("side", F.lit("right_only"))))
