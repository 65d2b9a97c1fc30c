"""Whole-history snapshots that rewrite only what a batch meets.

A version is a list of files, each with the smallest and largest value of one key column, its rows and bytes
(``<root>/_manifest/v=N``). A merge finds the files whose range of that column meets a key of the batch, merges their rows
with the batch, and writes new files for them alone; all others are carried into the next version by reference. The
ranges of a version's files do not overlap: every file owns the values from its smallest one up to the next file's, and
batch rows go to the owner, neighbouring files that are met being rewritten together.

The manifest is written after the data, and readers take the newest complete one, so they never see half a merge. A file
that a version has replaced is deleted when that version is ``keep`` versions old: the work per merge does not grow with
the table's age. On the driver there is one row per file, as in Spark's own file listing; batch keys find their file by a
binary search over the sorted bounds, without a shuffle.

The history has one row per key from the first version on. ``range_by`` must be one of the keys, best the one that
grows with time, so that re-sent days meet few files.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from feedloom.operators.dedup import POS, SRC, keep_one, split_null_keys
from feedloom.operators.layout import log_run
from feedloom.operators.merge import _cols, union_by_name
from feedloom.session import child_folders, delete_path, path_exists, scratch_path

FILE_ROWS = 5_000_000


def _folder(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/_manifest/v={version:08d}"


def versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the complete versions, oldest first."""
    found = [int(v.split("=", 1)[1]) for v in child_folders(spark, f"{root.rstrip('/')}/_manifest")]
    return [v for v in sorted(found) if path_exists(spark, f"{_folder(root, v)}/_SUCCESS")]


def files(spark: SparkSession, root: str, version: int | None = None) -> DataFrame | None:
    """The files of a version (the newest): ``path, low, high, rows, bytes, since``; ``since`` is the version that wrote it."""
    have = versions(spark, root)
    if not have:
        return None
    return spark.read.parquet(_folder(root, version or have[-1])).filter("NOT dropped").drop("dropped")


def _open(spark: SparkSession, root: str, paths: Sequence[str]) -> DataFrame:
    return spark.read.parquet(*[f"{root.rstrip('/')}/{p}" for p in sorted(paths)])


def read(spark: SparkSession, root: str, version: int | None = None, low=None, high=None) -> DataFrame:
    """A version (the newest), or of it the files that may hold values from ``low`` to ``high`` of the range column."""
    listed = files(spark, root, version)
    if listed is None:
        raise FileNotFoundError(f"no snapshot under {root}")
    if low is not None:
        listed = listed.filter(F.col("high") >= F.lit(low))
    if high is not None:
        listed = listed.filter(F.col("low") <= F.lit(high))
    paths = [r.path for r in listed.select("path").collect()]
    if not paths:
        paths, none = [r.path for r in files(spark, root, version).select("path").limit(1).collect()], True
    else:
        none = False
    out = _open(spark, root, paths)
    return out.limit(0) if none else out


def owner(key: Column, bounds: Column, count: int) -> Column:
    """Place (from 0) of the last of ``count`` sorted bounds that is not above the key; below all of them it is the first."""
    steps = [1 << k for k in reversed(range(max(count, 1).bit_length()))]
    at = F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), lambda low, step: F.when(
        F.coalesce(F.get(bounds, low + step - 1) <= key, F.lit(False)), low + step).otherwise(low))
    return F.greatest(at - 1, F.lit(0))


def _write(spark: SparkSession, root: str, rows: DataFrame, total: int, range_by: str, sort_by: Sequence[str], version: int,
           file_rows: int, run: str) -> DataFrame:
    """Write rows (with a ``run`` column: files never cross runs) and list the new files."""
    folder = f"data/{version:08d}-{uuid.uuid4().hex[:8]}"  # a folder that an interrupted run has left is never used
    parts = max(1, -(-total // file_rows))
    (rows.repartitionByRange(parts, run, range_by).sortWithinPartitions(run, range_by, *[c for c in sort_by if c != range_by])
         .write.partitionBy(run).parquet(f"{root.rstrip('/')}/{folder}"))
    schema = rows.drop(run).schema
    back = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(f"{root.rstrip('/')}/{folder}")
    name = F.concat(F.lit(f"{folder}/"), F.regexp_extract("_metadata.file_path", f"{folder}/(.*)$", 1))
    return back.groupBy(name.alias("path")).agg(
        F.min(range_by).alias("low"), F.max(range_by).alias("high"), F.count(F.lit(1)).alias("rows"),
        F.max("_metadata.file_size").alias("bytes")).withColumn("since", F.lit(version))


def _commit(spark: SparkSession, root: str, version: int, kept: DataFrame | None, new: DataFrame | None, dropped: DataFrame | None) -> None:
    parts = [df.withColumn("dropped", F.lit(gone)) for df, gone in ((kept, False), (new, False), (dropped, True)) if df is not None]
    union_by_name(*parts).coalesce(1).write.mode("overwrite").parquet(_folder(root, version))  # one row per file


def expire(spark: SparkSession, root: str, keep: int) -> None:
    """Delete the files that version ``newest - keep + 1`` has replaced, and the manifest before it."""
    have = versions(spark, root)
    if len(have) <= keep:
        return
    for old, first_kept in zip(have[:-keep], have[1:]):
        for r in spark.read.parquet(_folder(root, first_kept)).filter("dropped").select("path").collect():
            delete_path(spark, f"{root.rstrip('/')}/{r.path}")
        delete_path(spark, _folder(root, old))


def merge(spark: SparkSession, root: str, new: DataFrame, keys, range_by: str | None = None, order: Sequence[Column | str] = (),
          mode: str = "latest", sort_by: Sequence[str] | None = None, file_rows: int = FILE_ROWS, keep: int = 2,
          rejects: DataFrame | None = None, run_log: bool = True) -> dict:
    """Merge a batch into the snapshot (the first batch makes it): ``"latest"`` (the batch wins) or ``"insert_only"``.

    Rows without a key, and ``rejects``, go to ``<root>/_rejects/batch=<version>``. The report counts files rewritten and kept."""
    if mode not in ("latest", "insert_only"):
        raise ValueError("mode must be 'latest' or 'insert_only'")
    ks = _cols(keys)
    range_by = range_by or ks[0]
    if range_by not in ks:
        raise ValueError("range_by must be one of the keys")
    sort = list(sort_by or [range_by, *ks])
    have = versions(spark, root)
    version = (have[-1] if have else 0) + 1
    keyed, bad = split_null_keys(new, ks)
    bad = bad.drop(POS) if rejects is None else union_by_name(bad.drop(POS), rejects.drop(POS))
    taken, lost, written = Observation("batch"), Observation("rejects"), Observation("rows")
    bad.observe(lost, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{root.rstrip('/')}/_rejects/batch={version}")
    path = scratch_path(spark, "batch")
    one = keep_one(keyed, ks, order).drop(POS)
    one.observe(taken, F.count(F.lit(1)).alias("n")).write.parquet(path)  # staged once: read for the files it meets, then merged
    one = spark.read.schema(one.schema).parquet(path)
    report = {"target": root, "rows_in": taken.get.get("n", 0), "rejects": lost.get.get("n", 0), "partitions": None,
              "rows_before": 0, "files_kept": 0, "files_rewritten": 0}
    listed = files(spark, root) if have else None
    old = [] if listed is None else sorted(listed.collect(), key=lambda r: r.low)  # one row per file
    report["rows_before"] = sum(r.rows for r in old)
    if not old or not report["rows_in"]:
        fresh = None
        if report["rows_in"]:
            fresh = _write(spark, root, one.withColumn("_run", F.lit(0)), report["rows_in"], range_by, sort, version, file_rows, "_run")
        if fresh is not None or listed is not None:
            _commit(spark, root, version, listed, fresh, None)
        report["files_kept"] = len(old)
    else:
        bounds = spark.createDataFrame([([r.low for r in old],)], listed.select(F.array("low").alias("bounds")).schema)
        # One row with a value per file of the table.
        owned = one.crossJoin(F.broadcast(bounds)).withColumn("_file", owner(F.col(range_by), F.col("bounds"), len(old))).drop("bounds")
        hit = sorted(r[0] for r in owned.select("_file").distinct().collect())  # at most one for each file
        run_of, run = {}, -1
        for k, f in enumerate(hit):
            run += not k or f != hit[k - 1] + 1  # neighbours are rewritten together
            run_of[f] = run
        runs = spark.createDataFrame(sorted(run_of.items()), "_file int, _run int")
        names = spark.createDataFrame([(old[f].path.rsplit("/", 1)[1], r) for f, r in run_of.items()], "_name string, _run int")
        base = _open(spark, root, [old[f].path for f in hit])
        base = base.withColumn("_name", F.col("_metadata.file_name")).join(F.broadcast(names), "_name").drop("_name")
        batch = owned.join(F.broadcast(runs), "_file").drop("_file")
        both = union_by_name(base.withColumn(SRC, F.lit(0)), batch.withColumn(SRC, F.lit(1)))
        merged = keep_one(both, ks, [F.desc(SRC) if mode == "latest" else F.asc(SRC), *order]).drop(SRC)
        merged = merged.select(*base.columns, *[c for c in merged.columns if c not in base.columns])
        size = sum(old[f].rows for f in hit) + report["rows_in"]
        fresh = _write(spark, root, merged, size, range_by, sort, version, file_rows, "_run")
        met = spark.createDataFrame([(old[f].path,) for f in hit], "path string")
        _commit(spark, root, version, listed.join(F.broadcast(met), "path", "left_anti"), fresh, listed.join(F.broadcast(met), "path", "left_semi"))
        report["files_kept"], report["files_rewritten"] = len(old) - len(hit), len(hit)
    delete_path(spark, path)
    now = files(spark, root)
    sums = now.agg(F.sum("rows").alias("n"), F.sum("bytes").alias("b")).first() if now is not None else None
    report["rows_after"], report["bytes"] = (sums.n or 0, sums.b or 0) if sums else (0, 0)
    expire(spark, root, keep)
    if run_log:
        log_run(spark, root, f"manifest_{mode}", report, str(version))
    return report
