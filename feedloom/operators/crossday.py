"""One row per key over all days of a day table (W3, C4): duplicates across days.

``compact_days`` de-duplicates inside a day; a key that is sent again under another day stays twice. Here an index from key
to day stands beside the table (``<table>/_keys``, a snapshot by manifest: key columns and the day). A batch looks its keys
up in the index files whose range meets them, so only the days that really hold one of its keys are opened:

* ``"latest"``: the batch's row wins; the old row leaves its day (that day is rewritten without it);
* ``"insert_only"``: a key that any day has stays as it is, and the batch's row is left out.

Days are put in place first, the index follows; a batch that runs again after a failure in between finds its rows under
the index or in its own days and gives the same table. The table must have been built by this function (or be given to
``index_table`` once). One writer at a time per table; deltas of the touched days are folded first.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from feedloom.operators import manifest
from feedloom.operators.deltas import delta_days, drop_deltas, read_merged
from feedloom.operators.dedup import POS, SRC, keep_one
from feedloom.operators.merge import _cols, day_files, publish_days, stage_batch, swap_in, union_by_name
from feedloom.session import delete_path, path_bytes, scratch_path

_DAY = "_old_day"


def index_path(table_path: str) -> str:
    return f"{table_path.rstrip('/')}/_keys"


def index_table(spark: SparkSession, table_path: str, keys, day_col: str = "ingest_day", range_by: str | None = None,
                file_rows: int = manifest.FILE_ROWS) -> dict:
    """Make the index of a table that has none: of a key on several days, the newest day counts."""
    ks = _cols(keys)
    rows = spark.read.parquet(table_path).select(*ks, day_col)
    return manifest.merge(spark, index_path(table_path), rows, ks, range_by, [F.desc(day_col)], file_rows=file_rows)


def _met(spark: SparkSession, table_path: str, batch: DataFrame, ks: list[str], range_by: str) -> DataFrame | None:
    """The batch's keys that the index knows, with their day; index files outside the batch's range are not opened."""
    if not manifest.versions(spark, index_path(table_path)):
        return None
    span = batch.agg(F.min(range_by).alias("low"), F.max(range_by).alias("high")).first()
    index = manifest.read(spark, index_path(table_path), low=span.low, high=span.high)
    day = next(c for c in index.columns if c not in ks)
    return index.withColumnRenamed(day, _DAY).join(batch.select(*ks), ks, "left_semi")


def compact_days_across(spark: SparkSession, table_path: str, new: DataFrame, keys, order: Sequence[Column | str] = (),
                        day_col: str = "ingest_day", mode: str = "latest", range_by: str | None = None,
                        cluster_by: Sequence[str] | None = None, rejects: DataFrame | None = None, reject_col: str | None = None,
                        raw_col: str | None = None, batch_id: str | None = None, keep_rejects: bool = True, run_log: bool = True,
                        file_rows: int = manifest.FILE_ROWS) -> dict:
    """Merge a batch so that a key has one row in the whole table. The report's ``days`` names the days rewritten."""
    if mode not in ("latest", "insert_only"):
        raise ValueError("mode must be 'latest' or 'insert_only'")
    ks = _cols(keys)
    range_by = range_by or ks[0]
    batch_id = batch_id or uuid.uuid4().hex[:12]
    batch = stage_batch(spark, table_path, new, ks, order, day_col, keep_rejects, rejects, reject_col, batch_id, raw_col)
    report = batch.report
    publish_days(spark, table_path, day_col)  # what an interrupted run has left
    rows = batch.rows.drop(POS)
    if batch.days:
        met_path = scratch_path(spark, "met")
        met = _met(spark, table_path, rows, ks, range_by)
        if met is None:
            met = rows.select(*ks, F.col(day_col).alias(_DAY)).limit(0)
        met.write.parquet(met_path)
        met = spark.read.schema(met.schema).parquet(met_path)
        if mode == "insert_only":
            rows = rows.join(met.select(*ks), ks, "left_anti")
            days = sorted(r[0] for r in rows.select(day_col).distinct().collect())
        else:
            days = sorted({*batch.days, *(r[0] for r in met.select(_DAY).distinct().collect())})  # one row per day
        report["days"], report["partitions"] = days, len(days)
        if days:
            before, after = Observation("before"), Observation("after")
            base = read_merged(spark, table_path, ks, order, mode, day_col, days)
            both = rows.withColumn(SRC, F.lit(1))
            if base is not None:
                both = union_by_name(base.withColumn(SRC, F.lit(0)), both)
            both = both.observe(before, F.count_if(F.col(SRC) == 0).alias("n"))
            # Over the touched days: the batch's row first, or the row that was there first.
            merged = keep_one(both, ks, [F.desc(SRC) if mode == "latest" else F.asc(SRC), *order]).drop(SRC)
            out = day_files(merged.observe(after, F.count(F.lit(1)).alias("n")), day_col, list(cluster_by or ks))
            folded = set(map(str, days)) & delta_days(spark, table_path, day_col)
            placed = set(swap_in(spark, table_path, out, day_col))
            report["emptied"] = [str(d) for d in days if str(d) not in placed]
            for d in report["emptied"]:  # its last row has moved to another day
                delete_path(spark, f"{table_path.rstrip('/')}/{day_col}={d}")
            if folded:
                drop_deltas(spark, table_path, day_col, days)
            report["rows_before"], report["rows_after"] = before.get.get("n", 0), after.get.get("n", 0)
            report["bytes"] = path_bytes(spark, [f"{table_path.rstrip('/')}/{day_col}={d}" for d in days])
            manifest.merge(spark, index_path(table_path), rows.select(*ks, day_col), ks, range_by, mode=mode, file_rows=file_rows, run_log=False)
        delete_path(spark, met_path)
    delete_path(spark, batch.path)
    if run_log:
        from feedloom.operators.layout import log_run
        log_run(spark, table_path, "compact_days_across", report, batch_id)
    return report
