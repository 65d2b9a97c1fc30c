"""Merges of a new batch into history.

* ``merge_latest``      - one row per key, the new batch wins (C1; C2 folded in with a total order).
* ``merge_insert_only`` - history wins, only unseen keys are added (C3).
* ``compact_days``      - the core layout: merge (or replace) only the touched day partitions (C4 / K4).
  Time for one day does not grow with history: no other day is listed, read or written.

The new batch is always de-duplicated first (A-8); rows without a key never merge and are returned as
rejects (A-5). Joins carry no hint: the planner knows the sizes at run time and picks the strategy.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from feedloom.operators.dedup import POS, SRC, keep_one, split_null_keys
from feedloom.session import child_folders, delete_path, path_bytes, path_exists, scratch_path


def _cols(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def union_by_name(*dfs: DataFrame) -> DataFrame:
    """Bag union aligned by column name; a column missing on one side is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def _ordered(df: DataFrame, first: Sequence[str]) -> DataFrame:
    cols = [c for c in first if c in df.columns] + [c for c in df.columns if c not in first]
    return df.select(*[c for c in cols if c not in (POS, SRC)])


def dedup_batch(new: DataFrame, keys, order: Sequence[Column | str] = ()) -> tuple[DataFrame, DataFrame]:
    """``(one row per key, rejects)`` for an incoming batch."""
    ks = _cols(keys)
    keyed, rejects = split_null_keys(new, ks)
    return keep_one(keyed, ks, order), rejects


def merge_latest(old: DataFrame, new: DataFrame, keys, order: Sequence[Column | str] = (),
                 history_unique: bool = False) -> tuple[DataFrame, DataFrame]:
    """``(merged, rejects)``: one row per key over both; a key present in ``new`` takes the new row.

    Both sides go through one keyed ``row_number`` with the batch ranked first, so duplicates in
    history go too; history rows without a key stay as they are. With ``history_unique`` (the
    caller knows that history has one row per key) history rows whose key is not in the batch pass
    through an anti join, and only keys are compared.
    """
    ks = _cols(keys)
    new_d, rejects = dedup_batch(new, ks, order)
    if history_unique:
        nk = split_null_keys(new, ks)[0].select(*ks).distinct()  # pre-aggregated before any shuffle
        out = union_by_name(old.join(nk, ks, "left_anti"), new_d)
    else:
        keyed, keyless = split_null_keys(old, ks)
        both = union_by_name(keyed.withColumn(SRC, F.lit(0)), new_d.withColumn(SRC, F.lit(1)))
        out = union_by_name(keep_one(both, ks, [F.desc(SRC), *order]), keyless)
    return _ordered(out, old.columns), rejects


def merge_insert_only(old: DataFrame, new: DataFrame, keys, order: Sequence[Column | str] = (),
                      history_unique: bool = False) -> tuple[DataFrame, DataFrame]:
    """``(merged, rejects)``, history wins: one row of each key of history, plus the batch rows whose key
    history lacks (C3).

    Written as a left-anti join, never ``NOT IN``: a literal ``NOT IN`` plans a null-aware
    broadcast of the history and adds nothing once history holds one NULL key.
    """
    ks = _cols(keys)
    new_d, rejects = dedup_batch(new, ks, order)
    # distinct() pre-aggregates history keys map-side and shares the join's partitioning.
    added = new_d.join(old.select(*ks).distinct(), ks, "left_anti")
    if not history_unique:
        keyed, keyless = split_null_keys(old, ks)
        old = union_by_name(_ordered(keep_one(keyed, ks, order), old.columns), keyless)
    return _ordered(union_by_name(old, added), old.columns), rejects


def table_exists(spark: SparkSession, path: str) -> bool:
    """A readable Parquet table at ``path``. The filesystem is asked first: a failed read
    would be reported to every query listener of the session."""
    if path_exists(spark, path) is False:
        return False
    try:
        spark.read.parquet(path).schema  # noqa: B018
        return True
    except AnalysisException:
        return False


REJECT = "_reject"


def read_days_only(spark: SparkSession, table_path: str, day_col: str, days) -> DataFrame | None:
    """Some day partitions of a table, opened by their own folders: no other day is listed."""
    root = table_path.rstrip("/")
    there = [p for p in (f"{root}/{day_col}={d}" for d in days) if path_exists(spark, p) is not False]
    return spark.read.option("basePath", root).parquet(*there) if there else None


def publish_days(spark: SparkSession, table_path: str, day_col: str) -> None:
    """Put staged days in place of the table's, from a complete staged copy only.

    The copy is removed after the swap. A run that fails in between leaves it, and the next one (of any
    batch) swaps it in again first, whole days at a time; so no day is lost or half merged."""
    staged = f"{table_path.rstrip('/')}/_staged/days"
    if path_exists(spark, f"{staged}/_SUCCESS"):
        (spark.read.parquet(staged).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
              .partitionBy(day_col).parquet(table_path))
    delete_path(spark, staged)


class Staged:
    """A batch written to the shared scratch folder: its good rows (one per key), their days, and counts."""

    def __init__(self, path: str, rows: DataFrame, days: list, report: dict):
        self.path, self.rows, self.days, self.report = path, rows, days, report


def stage_batch(spark: SparkSession, table_path: str, new: DataFrame, keys: Sequence[str], order: Sequence[Column | str] = (),
                day_col: str = "ingest_day", keep_rejects: bool = True, rejects: DataFrame | None = None,
                reject_col: str | None = None, batch_id: str = "", raw_col: str | None = None) -> Staged:
    """De-duplicate ``new`` by ``keys`` and stage it once; rejects go to ``<table>/_rejects/batch=<batch_id>``.

    One pass over the batch: a row is rejected when a key or the day is missing or ``reject_col`` says so
    (e.g. an unreadable time from the normaliser). Each reject gets its own group in the
    de-dup window, so it passes through untouched, while keyed rows keep one per key.
    (A separate filter per outcome would scan the landing once per outcome.)
    """
    bad_row = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in dict.fromkeys([day_col, *keys])])
    if reject_col:
        bad_row = bad_row | F.coalesce(F.col(reject_col), F.lit(False))
    tagged = new.withColumn(REJECT, bad_row)
    tagged = tagged.withColumn("_uniq", F.when(F.col(REJECT), F.monotonically_increasing_id()))
    raw, staging = Observation("raw"), Observation("staging")
    tagged = tagged.observe(raw, F.count(F.lit(1)).alias("n"))
    parts_in = [keep_one(tagged, [REJECT, "_uniq", *keys], order).drop("_uniq")]
    if rejects is not None:
        parts_in.append(rejects.withColumn(REJECT, F.lit(True)))
    good = ~F.col(REJECT)
    path = scratch_path(spark, "batch")
    staged = union_by_name(*parts_in)
    ragged = good & F.col(raw_col).isNotNull() if raw_col else F.lit(False)
    (staged.observe(staging, F.count_if(ragged).alias("ragged"), F.count_if(~good).alias("rejects"),
                    F.collect_set(F.when(good, F.col(day_col))).alias("days")).write.parquet(path))
    staged = spark.read.schema(staged.schema).parquet(path)
    m = staging.get
    days = sorted(m["days"])
    report = {"target": table_path, "rows_in": raw.get["n"], "rejects": m["rejects"], "partitions": len(days),
              "rows_before": 0, "rows_after": 0, "bytes": 0, "days": days}
    if keep_rejects and report["rejects"] + m["ragged"]:
        staged.filter(F.col(REJECT) | ragged).drop(REJECT).write.mode("overwrite").parquet(
            f"{table_path.rstrip('/')}/_rejects/batch={batch_id}")
    data_cols = [c for c in new.columns if c not in (reject_col, raw_col)]
    return Staged(path, staged.filter(~F.col(REJECT)).select(*data_cols), days, report)


def day_files(merged: DataFrame, day_col: str, cluster: Sequence[str]) -> DataFrame:
    """Files of even size by day, each sorted by key."""
    return merged.hint("rebalance", day_col).sortWithinPartitions(day_col, *cluster)


def swap_in(spark: SparkSession, table_path: str, out: DataFrame, day_col: str) -> list[str]:
    """Stage whole days inside the table, complete, then put them in place (see :func:`publish_days`); names the days."""
    staged = f"{table_path.rstrip('/')}/_staged/days"
    # Static mode: the whole folder is replaced, and its _SUCCESS marks a complete copy.
    out.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(day_col).parquet(staged)
    days = [d.split("=", 1)[1] for d in child_folders(spark, staged) if d.startswith(f"{day_col}=")]
    publish_days(spark, table_path, day_col)
    return days


def compact_days(spark: SparkSession, table_path: str, new: DataFrame, keys,
                 order: Sequence[Column | str] = (), day_col: str = "ingest_day",
                 cluster_by: Sequence[str] | None = None, mode: str = "latest",
                 run_log: bool = True, keep_rejects: bool = True,
                 rejects: DataFrame | None = None, dry_run: bool = False, reject_col: str | None = None,
                 batch_id: str | None = None, raw_col: str | None = None):
    """Merge ``new`` into the day partitions it touches and overwrite only those partitions.

    De-duplication is per day (key = ``day_col`` + ``keys``; ``operators.crossday`` does it over all days); ``mode`` is
    ``"latest"`` (the batch wins), ``"insert_only"`` (history wins) or ``"replace"`` (the touched days become the batch's
    rows; history is not read). Untouched days are neither listed, read nor written. Rows without a key or
    a day, rows flagged by ``reject_col`` and any upstream ``rejects`` (e.g. rows whose time did not parse) go to
    ``<table>/_rejects/batch=<batch_id>``, so a replayed batch writes the same place again. ``raw_col`` holds the
    whole line of rows that did not fit the columns: these rows merge, and are kept there too. Deltas of the touched days
    (``operators.deltas``) are folded in on the way. Returns the run report, whose ``days`` names the touched days; with
    ``dry_run`` it returns ``(report, merged DataFrame)`` and writes nothing to the table.

    The de-duplicated batch and its rejects are staged once as Parquet in the shared scratch folder, where the
    touched days and counts are observed; the merged days are staged inside the table and then swapped
    in (see :func:`publish_days`). One batch at a time per table.
    """
    from feedloom.operators.deltas import delta_days, drop_deltas, read_merged
    if mode not in ("latest", "insert_only", "replace"):
        raise ValueError("mode must be 'latest', 'insert_only' or 'replace'")
    ks = [day_col, *_cols(keys)]
    cluster = list(cluster_by or _cols(keys))
    batch_id = batch_id or uuid.uuid4().hex[:12]
    batch = stage_batch(spark, table_path, new, ks, order, day_col, keep_rejects and not dry_run, rejects, reject_col,
                        batch_id, raw_col)
    report, days = batch.report, batch.days
    if not dry_run:
        publish_days(spark, table_path, day_col)  # what an interrupted run has left
    if not days:
        if not dry_run:
            delete_path(spark, batch.path)
        return (report, None) if dry_run else report
    before, after = Observation("before"), Observation("after")
    parts = [batch.rows.withColumn(SRC, F.lit(1))]
    folded = bool(set(map(str, days)) & delta_days(spark, table_path, day_col))
    if mode == "replace":
        existing = None
    elif folded:
        existing = read_merged(spark, table_path, keys, order, mode, day_col, days)
    else:
        existing = read_days_only(spark, table_path, day_col, days)
    if existing is not None:
        parts.insert(0, existing.withColumn(SRC, F.lit(0)))
    # Each key appears at most once per side here, so no partition can meet a hot key.
    both = union_by_name(*parts).observe(before, F.count_if(F.col(SRC) == 0).alias("n"))
    rank_src = F.asc(SRC) if mode == "insert_only" else F.desc(SRC)
    merged = keep_one(both, ks, [rank_src, *order]).drop(SRC, POS)
    out = day_files(merged.observe(after, F.count(F.lit(1)).alias("n")), day_col, cluster)
    if dry_run:
        return report, out
    swap_in(spark, table_path, out, day_col)
    if folded:
        drop_deltas(spark, table_path, day_col, days)
    delete_path(spark, batch.path)
    report["rows_after"] = after.get.get("n", 0)
    report["rows_before"] = before.get.get("n", 0)
    report["bytes"] = path_bytes(spark, [f"{table_path.rstrip('/')}/{day_col}={d}" for d in days])
    if run_log:
        from feedloom.operators.layout import log_run
        log_run(spark, table_path, "compact_days", report, batch_id)
    return report


def merge_into_snapshot(spark: SparkSession, root: str, new: DataFrame, keys, order: Sequence[Column | str] = (),
                        mode: str = "latest", sort_by: Sequence[str] | None = None,
                        rejects: DataFrame | None = None, keep_versions: int = 2) -> dict:
    """Whole-history compaction into the snapshot layout (C1 / C3 + K3).

    Reads the current version, merges the batch (``"latest"``: the batch wins; ``"insert_only"``:
    history wins) and writes the next version; the pointer moves only after the write, and all but the
    newest ``keep_versions`` versions are removed. Rejects go to ``<root>/_rejects/batch=<version>``. Every
    run rewrites the whole history, so prefer ``compact_days`` once history is large.
    """
    from feedloom.operators.layout import current_version, drop_versions, log_run, write_snapshot
    ks = _cols(keys)
    version, path, rows_before = current_version(spark, root, with_rows=True)
    old = new.limit(0).drop(POS) if path is None else spark.read.parquet(path)
    if path is not None and rows_before is None:  # a version written without a recorded count
        rows_before = old.count()
    batch = Observation("batch")
    new = new.observe(batch, F.count(F.lit(1)).alias("n"))
    fn = merge_latest if mode == "latest" else merge_insert_only
    merged, keyless = fn(old, new, ks, order=order)
    bad = [keyless.drop(POS)] + ([rejects.drop(POS)] if rejects is not None else [])
    bad_path = f"{root.rstrip('/')}/_rejects/batch={version + 1}"
    kept = Observation("rejects")
    union_by_name(*bad).observe(kept, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(bad_path)
    target, rows_after = write_snapshot(merged, root, list(sort_by or ks), version=version, return_rows=True)
    drop_versions(spark, root, keep_versions)
    report = {"target": target, "rows_before": rows_before or 0, "rows_after": rows_after,
              "rejects": kept.get.get("n", 0), "partitions": None, "rows_in": batch.get.get("n", 0),
              "bytes": path_bytes(spark, [target])}
    log_run(spark, root, f"snapshot_{mode}", report, str(version + 1))
    return report
