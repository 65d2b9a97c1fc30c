"""Streams over the landing folder.

The feeds' timers and object-created events become a file-source stream: each pull lands as
new files (never a grown file, which the file source would not re-read), a trigger
(``processingTime='15 minutes'`` or a scheduled ``availableNow``) picks them up, and the
checkpoint is the queue. One query per table keeps compactions serial (T3).

* ``compaction_query`` - T2/T8: ``foreachBatch`` merges the micro-batch into the day partitions
  it touches (``merge.compact_days``). The merge is idempotent, so a replayed batch after a
  failure writes the same rows.
* ``dedup_stream``     - T4/T5: duplicate deliveries dropped by key within a watermark.
* ``split_late``       - T4: rows under the watermark put aside before a stateful step would drop them.
* ``hourly_stream``    - T6: tumbling hour counts and mean; ``hours_now`` joins closed and open hours.
* ``latest_stream``    - T7: newest value per group.
* ``distinct_stream``  - T9: approximate distinct count (exact distinct is refused on streams).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from feedloom.operators.dedup import POS, number_rows, with_position
from feedloom.operators.deltas import append_delta, fold_deltas
from feedloom.operators.layout import CSV_OPTIONS, drop_versions, write_snapshot
from feedloom.operators.merge import compact_days
from feedloom.session import child_folders, path_exists, ship_package
from feedloom.sources.csv import CORRUPT

EVERY_QUARTER_HOUR = {"processingTime": "15 minutes"}
AVAILABLE_NOW = {"availableNow": True}


def landed_stream(spark: SparkSession, root: str, schema: T.StructType, fmt: str = "csv",
                  max_files: int | None = None, position: bool = True, **options) -> DataFrame:
    """New files under ``root`` as a stream. ``schema`` lists the file columns (ending with
    the pull ``stamp``), optionally the column of ragged lines, and then ``ingest_day``, which is filled from the folder name."""
    r = spark.readStream.schema(schema)
    if fmt == "csv":
        # As in the batch readers, a header that names other columns, or in another order, is an error.
        r = r.options(**{k: v for k, v in CSV_OPTIONS.items() if k != "lineSep"}, enforceSchema="false",
                      columnNameOfCorruptRecord=CORRUPT)
    if max_files:
        r = r.option("maxFilesPerTrigger", str(max_files))
    df = r.options(**options).format(fmt).load(root)
    return with_position(df) if position else df


def event_time(c: str | Column) -> Column:
    """Watermarks need TIMESTAMP, not TIMESTAMP_NTZ (H4): naive UTC read in the UTC session."""
    col = F.col(c) if isinstance(c, str) else c
    return col.cast("timestamp")


def _first_per_key(keys: list[str]):
    def first(batches):
        for pdf in batches:
            yield pdf.drop_duplicates(subset=keys, keep="first")
    return first


def dedup_stream(df: DataFrame, keys: Sequence[str], ts: str, delay: str = "2 days",
                 pre_reduce: bool = False) -> DataFrame:
    """First delivery of each key; copies arriving within ``delay`` of event time are dropped.

    The stateful de-dup shuffles every copy of a key to one task. With ``pre_reduce`` each
    Arrow batch (10k rows by default) first drops its own repeated keys in the map task, so a
    key delivered in a third of the rows reaches the shuffle as one row per batch. This costs
    a pass through Python for every row, so it is for feeds that do repeat keys heavily.

    Rows later than ``delay`` are dropped by the watermark (the query's progress counts them in
    ``numRowsDroppedByWatermark``). Where no row may be lost, however late, use ``compaction_query`` with
    ``mode="insert_only"``: it keeps the first delivery of each key against the table itself.
    """
    ks = list(keys)
    if pre_reduce:
        ship_package(df.sparkSession)
        df = df.mapInPandas(_first_per_key(ks), df.schema)
    return (df.withColumn("_event_time", event_time(ts)).withWatermark("_event_time", delay)
              .dropDuplicatesWithinWatermark(ks).drop("_event_time"))


def hourly_stream(df: DataFrame, ts: str, value: str, delay: str | None = None) -> DataFrame:
    """``h, n, tone`` per tumbling hour. With ``delay`` (append mode) an hour is emitted once
    the watermark passes it; without it run in ``complete`` mode for the batch answer."""
    if delay:
        df = df.withColumn("_event_time", event_time(ts)).withWatermark("_event_time", delay)
        w = F.window("_event_time", "1 hour")
    else:
        w = F.window(ts, "1 hour")
    return (df.groupBy(w.alias("w"))
              .agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("tone"))
              .select(F.col("w.start").alias("h"), "n", "tone"))


def latest_stream(df: DataFrame, group: str, value: str, ts: str) -> DataFrame:
    """Newest value per group, of tied times the largest (``complete`` or ``update`` mode)."""
    return df.groupBy(group).agg(F.max_by(value, F.struct(ts, value)).alias("last_value"), F.max(ts).alias("latest"))


def distinct_stream(df: DataFrame, col: str, group: str | None = None) -> DataFrame:
    g = df.groupBy(group) if group else df.groupBy()
    return g.agg(F.approx_count_distinct(col).alias("distinct_approx"), F.count(F.lit(1)).alias("rows"))


def compaction_query(stream: DataFrame, table_path: str, keys, checkpoint: str,
                     order: Sequence[Column | str] = (), day_col: str = "ingest_day",
                     mode: str = "latest", normalise=None, trigger: dict | None = None,
                     name: str | None = None, fold_share: float | None = None, **compact_options) -> StreamingQuery:
    """Start the compaction stream: each micro-batch is merged into the days it touches.

    With ``fold_share`` a micro-batch writes only its own rows, as a delta (``operators.deltas``; read the table with
    ``read_merged`` then), and days whose deltas outgrow that share of the base are folded.

    ``normalise`` turns the landed text into typed rows; it may return ``(typed, rejects)``,
    and the rejects are kept with the table (``_rejects``) by the compaction.
    """

    def merge_batch(batch: DataFrame, epoch_id: int) -> None:
        batch = number_rows(batch)
        out = normalise(batch) if normalise else batch
        typed, rejects = out if isinstance(out, tuple) else (out, None)
        spark, options = batch.sparkSession, {"rejects": rejects, "batch_id": f"stream-{epoch_id}", **compact_options}
        if fold_share is None:
            compact_days(spark, table_path, typed, keys, order=order, day_col=day_col, mode=mode, **options)
        else:
            append_delta(spark, table_path, typed, keys, order=order, day_col=day_col, **options)
            fold_deltas(spark, table_path, keys, order, mode, day_col, fold_share, compact_options.get("cluster_by"))

    w = stream.writeStream.foreachBatch(merge_batch).option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    return w.trigger(**(trigger or AVAILABLE_NOW)).start()


def complete_to_table(agg: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Run an aggregate in ``complete`` mode; each batch's full answer is a new version of the snapshot at
    ``path`` (``layout.read_snapshot``), so a reader's files are not overwritten under it."""

    def write(batch: DataFrame, epoch_id: int) -> None:
        write_snapshot(batch, path, batch.columns[:1])
        drop_versions(batch.sparkSession, path)

    return (agg.writeStream.outputMode("complete").foreachBatch(write)
               .option("checkpointLocation", checkpoint).trigger(**(trigger or AVAILABLE_NOW)).start())


def append_to_table(df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Append-mode stream into a Parquet folder (exactly-once through the sink's log)."""
    return (df.writeStream.outputMode("append").format("parquet").option("path", path)
              .option("checkpointLocation", checkpoint).trigger(**(trigger or AVAILABLE_NOW)).start())


def split_late(df: DataFrame, ts: str, delay: str, on_time: str, late: str, checkpoint: str,
               trigger: dict | None = None) -> StreamingQuery:
    """Put rows under the watermark aside, before a stateful step would drop them (T4): the others go on to ``on_time``.

    The watermark of a micro-batch is the newest time of all earlier ones less ``delay``, the rule of Spark's own
    watermark. Each batch's newest time, its rows on time and its late rows are kept by epoch (``<on_time>/_high``,
    ``<on_time>/epoch=N``, ``<late>/epoch=N``), so a replayed batch writes the same rows to the same places. A stream over
    ``on_time`` with the same delay sees batches in this order or several at once; its watermark is never ahead of this one,
    so it drops none of these rows. Rows without a time are late.
    """
    def write(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        high = f"{on_time.rstrip('/')}/_high"
        seen = [e for e in child_folders(spark, high) if int(e.split("=", 1)[1]) < epoch_id]
        known = spark.read.option("basePath", high).parquet(*[f"{high}/{e}" for e in seen]).agg(F.max("high")).first()[0] if seen else None
        at = event_time(ts)
        batch = batch.drop(*[c for c in (POS,) if c in batch.columns])
        batch.agg(F.max(at).alias("high")).write.mode("overwrite").parquet(f"{high}/epoch={epoch_id}")  # one row
        bar = F.lit(known).cast("timestamp") - F.expr(f"INTERVAL {delay}")
        behind = F.coalesce(at <= bar, F.lit(False)) | at.isNull()
        batch.filter(behind).write.mode("overwrite").parquet(f"{late.rstrip('/')}/epoch={epoch_id}")
        batch.filter(~behind).write.mode("overwrite").parquet(f"{on_time.rstrip('/')}/epoch={epoch_id}")

    return (df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
              .trigger(**(trigger or AVAILABLE_NOW)).start())


def on_time_stream(spark: SparkSession, on_time: str, schema: T.StructType) -> DataFrame:
    """The rows that :func:`split_late` lets pass, as a stream (``schema`` of its input)."""
    return spark.readStream.schema(T.StructType(list(schema.fields) + [T.StructField("epoch", T.LongType())])).parquet(on_time).drop("epoch")


def read_late(spark: SparkSession, late: str, schema: T.StructType) -> DataFrame:
    """The rows put aside so far."""
    have = [e for e in child_folders(spark, late) if path_exists(spark, f"{late.rstrip('/')}/{e}/_SUCCESS")]
    if not have:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{late.rstrip('/')}/{e}" for e in have])


def hours_now(spark: SparkSession, closed: str, landed: DataFrame, ts: str, value: str, partition_col: str | None = None) -> DataFrame:
    """``h, n, tone`` at any moment (T6): closed hours from the table that ``append_to_table(hourly_stream(..., delay))`` fills,
    hours after the newest closed one from the landed rows.

    A closed hour is never counted again: rows that came too late for it are not in its count (see ``split_late``). With
    ``partition_col`` only the days from that hour on are read."""
    schema = "h timestamp, n bigint, tone double"
    have = path_exists(spark, f"{closed.rstrip('/')}/_spark_metadata")
    done = spark.read.schema(schema).parquet(closed) if have else spark.createDataFrame([], schema)
    newest = done.agg(F.max("h")).first()[0]
    rows = landed.withColumn("_at", event_time(ts))
    if newest is not None:
        rows = rows.filter(F.col("_at") >= F.lit(newest) + F.expr("INTERVAL 1 HOUR"))
        if partition_col:
            rows = rows.filter(F.col(partition_col) >= F.to_date(F.lit(newest)))
    open_ = rows.filter("_at IS NOT NULL").groupBy(F.date_trunc("hour", "_at").alias("h")).agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("tone"))
    return done.unionByName(open_)


def run_until_done(q: StreamingQuery) -> None:
    """Wait for an ``availableNow`` query to end, however long it takes; raise its error if it failed."""
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
