"""Physical layouts and sinks.

* Landing (K1/K2): append-only, one new file set per pull under ``<root>/ingest_day=YYYY-MM-DD/``,
  every row carrying its pull's ``stamp`` (``YYYYMMDDHHMMSS``) as the last column. Nothing is
  ever rewritten in place (a file source never re-reads a grown file, and concurrent pulls
  cannot race); a backfill replaces a whole day folder.
* Snapshot (K3): the whole-history table as versioned folders ``<root>/_v=NNNNNN`` plus a
  pointer row per version kept; a merge reads version N and writes N+1, so it never overwrites
  what it reads. Files are range-partitioned and sorted, not coalesced into one.
* Day table (K4): ``partitionBy(day)`` + dynamic partition overwrite (see ``merge.compact_days``).
* Run log (K5): one row per job appended to ``<table>/_runs``.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.schemas import RUN_LOG
from feedloom.session import child_folders, delete_path

# CSV dialect of the landing: quotes doubled (never backslash), full microseconds on times.
CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "lineSep": "\n",
}


def _landing_order(df: DataFrame, day_col: str, stamp_col: str) -> DataFrame:
    """Raw columns, then the stamp, then the day: the file layout readers rely on."""
    data = [c for c in df.columns if c not in (day_col, stamp_col)]
    return df.select(*data, stamp_col, day_col)


def _write(w, fmt: str, path: str) -> None:
    if fmt == "csv":
        w.options(**CSV_OPTIONS).csv(path)
    elif fmt == "json":
        w.json(path)
    else:
        w.format(fmt).save(path)


def land(df: DataFrame, root: str, stamp: str, day: str | None = None, fmt: str = "csv",
         day_col: str = "ingest_day") -> str:
    """Append one pull to the landing (K1). ``stamp`` is the pull's ``YYYYMMDDHHMMSS``.

    The day folder defaults to the stamp's UTC day. Returns the folder written.
    """
    day = day or f"{stamp[:4]}-{stamp[4:6]}-{stamp[6:8]}"
    path = f"{root.rstrip('/')}/{day_col}={day}"
    _write(df.withColumn("stamp", F.lit(stamp)).write.mode("append"), fmt, path)
    return path


def land_partitioned(df: DataFrame, root: str, day_col: str = "ingest_day", stamp_col: str = "stamp",
                     fmt: str = "csv") -> None:
    """Append many pulls at once: rows carry their own ``day_col`` and ``stamp_col``."""
    _write(_landing_order(df, day_col, stamp_col).write.mode("append").partitionBy(day_col), fmt, root)


def backfill_day(df: DataFrame, root: str, day_col: str = "ingest_day", stamp_col: str = "stamp",
                 fmt: str = "csv") -> None:
    """Replace whole landing days with ``df``'s rows (K2): dynamic overwrite of those days only.

    Compact the day with ``mode="replace"`` afterwards, so that rows which the backfill no longer has leave
    the table too."""
    w = (_landing_order(df, day_col, stamp_col).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(day_col))
    _write(w, fmt, root)



# --------------------------------------------------------------------------- snapshots (K3)

def _pointer(root: str) -> str:
    return f"{root.rstrip('/')}/_pointer"


def current_version(spark: SparkSession, root: str, with_rows: bool = False):
    """``(version, path)`` of the current snapshot, ``(0, None)`` if none; with ``with_rows`` also
    its row count as recorded by the writer (``None`` for versions written without it)."""
    from feedloom.operators.merge import table_exists
    if not table_exists(spark, _pointer(root)):
        return (0, None, 0) if with_rows else (0, None)
    ptr = spark.read.parquet(_pointer(root))
    rows = F.col("rows") if "rows" in ptr.columns else F.lit(None).cast("long")
    row = ptr.agg(F.max(F.struct("version", "path", rows.alias("rows"))).alias("v")).first()
    if not row or not row.v:
        return (0, None, 0) if with_rows else (0, None)
    return (row.v.version, row.v.path, row.v.rows) if with_rows else (row.v.version, row.v.path)


def write_snapshot(df: DataFrame, root: str, sort_by: Sequence[str], version: int | None = None,
                   return_rows: bool = False):
    """Write ``df`` as the next version and flip the pointer after the write succeeded.

    The row count is observed during the write (above the range exchange, whose sampler
    re-runs the plan below it) and recorded in the pointer row."""
    from pyspark.sql import Observation
    spark = df.sparkSession
    if version is None:
        version, _ = current_version(spark, root)
    path = f"{root.rstrip('/')}/_v={version + 1:06d}"
    written = Observation("snapshot_rows")
    # A folder of this version can only be left by a run that failed before the pointer moved;
    # nothing reads an unpointed version, so a retry may overwrite it.
    (df.repartitionByRange(*sort_by).observe(written, F.count(F.lit(1)).alias("n"))
       .sortWithinPartitions(*sort_by).write.mode("overwrite").parquet(path))
    n = written.get.get("n", 0)
    ptr = spark.createDataFrame([(path, _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None), n)],
                                "path string, committed_at timestamp_ntz, rows long")
    ptr.coalesce(1).write.mode("overwrite").parquet(f"{_pointer(root)}/version={version + 1}")
    return (path, n) if return_rows else path


def drop_versions(spark: SparkSession, root: str, keep: int = 2) -> None:
    """Remove all but the newest ``keep`` versions and their pointer rows (readers of those before have had a version's
    time to end). What is gone is not looked at again, so the work does not grow with the number of merges."""
    number = lambda name: int(name.split("=", 1)[1])
    pointed = [number(p) for p in child_folders(spark, _pointer(root))]
    last = max(pointed, default=0) - keep
    for v in child_folders(spark, root):
        if v.startswith("_v=") and number(v) <= last:
            delete_path(spark, f"{root.rstrip('/')}/{v}")
    for p in pointed:
        if p <= last:
            delete_path(spark, f"{_pointer(root)}/version={p}")


def read_snapshot(spark: SparkSession, root: str, schema=None) -> DataFrame:
    """The current version, or a typed empty frame when none exists."""
    _, path = current_version(spark, root)
    if path is None:
        if schema is None:
            raise FileNotFoundError(f"no snapshot under {root}")
        return spark.createDataFrame([], schema)
    return spark.read.parquet(path)


# --------------------------------------------------------------------------- run log, JSON (K5, K6)

def log_run(spark: SparkSession, table_path: str, job: str, report: dict, batch_id: str) -> None:
    """One row per batch, in a folder of its own: a replayed batch replaces its row."""
    row = (_dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None), job, report.get("target"),
           report.get("rows_before"), report.get("rows_in"), report.get("rows_after"),
           report.get("rejects"), report.get("partitions"), report.get("bytes"))
    spark.createDataFrame([row], RUN_LOG).coalesce(1).write.mode("overwrite").parquet(
        f"{table_path.rstrip('/')}/_runs/batch={batch_id}")


def to_json_rows(df: DataFrame, name: str = "json") -> DataFrame:
    """Each row as one JSON object text (K6); times as ISO text."""
    return df.select(F.to_json(F.struct(*df.columns), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss"}).alias(name))


def materialise(df: DataFrame, path: str, sort_by: Sequence[str] = ()) -> DataFrame:
    """Write a result table (e.g. the pre-rendered series, K7) and return it read back."""
    out = df.repartitionByRange(*sort_by).sortWithinPartitions(*sort_by) if sort_by else df
    out.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


# --------------------------------------------------------------------------- listings

def list_files(spark: SparkSession, pattern: str, recursive: bool = True) -> DataFrame:
    """Files matching a glob as data: ``path, length, modificationTime`` (contents not read)."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
            .load(pattern).select("path", "length", "modificationTime"))
