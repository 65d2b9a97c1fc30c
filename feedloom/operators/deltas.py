"""Small deltas beside a day table, merged on read and folded later.

A quarter-hour compaction that rewrites its day writes a day 96 times. Here a batch writes only its own rows, one per key,
to ``<table>/_delta/seq=N/batch=<id>/<day_col>=D``; the base partitions stay as they are. ``read_merged`` gives the
table as if every batch had been compacted: days without deltas are read plainly, in the others the base rows whose key a
delta has give way (a join on the delta's keys alone, so the base is shuffled only where the deltas are too large to
broadcast). ``fold_deltas`` merges the days whose deltas have outgrown a share of the base and drops those deltas.

Readers see a delta once its folder is complete. Folding puts whole days in place first and drops deltas after it, the
oldest first: whatever is left by a run that ends in between gives the same rows again when read or folded. One writer
at a time per table, as for ``compact_days``.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from feedloom.operators.dedup import POS, keep_one
from feedloom.operators.merge import _cols, day_files, publish_days, read_days_only, stage_batch, swap_in, union_by_name
from feedloom.session import child_folders, delete_path, path_bytes, path_exists


def _root(table_path: str) -> str:
    return f"{table_path.rstrip('/')}/_delta"


def _deltas(spark: SparkSession, table_path: str) -> list[tuple[int, str, str]]:
    """``(sequence, batch id, folder)`` of the deltas, oldest first; unfinished ones too."""
    root, out = _root(table_path), []
    for s in child_folders(spark, root):
        for b in child_folders(spark, f"{root}/{s}"):
            out.append((int(s.split("=", 1)[1]), b.split("=", 1)[1], f"{root}/{s}/{b}"))
    return sorted(out)


def _day_folders(spark: SparkSession, table_path: str, day_col: str) -> list[tuple[int, str, str]]:
    """``(sequence, day, folder)`` of every day folder of the finished deltas, oldest delta first."""
    out = []
    for seq, _, path in _deltas(spark, table_path):
        if path_exists(spark, f"{path}/_SUCCESS"):
            out += [(seq, d.split("=", 1)[1], f"{path}/{d}") for d in child_folders(spark, path) if d.startswith(f"{day_col}=")]
    return out


def delta_days(spark: SparkSession, table_path: str, day_col: str = "ingest_day") -> set[str]:
    """The days that have unfolded deltas."""
    return {d for _, d, _ in _day_folders(spark, table_path, day_col)}


def append_delta(spark: SparkSession, table_path: str, new: DataFrame, keys, order: Sequence[Column | str] = (),
                 day_col: str = "ingest_day", cluster_by: Sequence[str] | None = None, batch_id: str | None = None,
                 rejects: DataFrame | None = None, reject_col: str | None = None, raw_col: str | None = None,
                 keep_rejects: bool = True, run_log: bool = True) -> dict:
    """Write the batch, one row per day and key, as the table's newest delta; nothing else is read or written.

    A replayed ``batch_id`` replaces its own delta. Rejects are kept as by ``compact_days``."""
    batch_id = batch_id or uuid.uuid4().hex[:12]
    ks = _cols(keys)
    batch = stage_batch(spark, table_path, new, [day_col, *ks], order, day_col, keep_rejects, rejects, reject_col, batch_id, raw_col)
    report = batch.report
    if batch.days:
        there = _deltas(spark, table_path)
        seq = next((s for s, b, _ in there if b == batch_id), max((s for s, _, _ in there), default=0) + 1)
        path = f"{_root(table_path)}/seq={seq:012d}/batch={batch_id}"
        written = Observation("delta")
        rows = batch.rows.drop(POS).observe(written, F.count(F.lit(1)).alias("n"))
        (day_files(rows, day_col, list(cluster_by or ks)).write.mode("overwrite").option("partitionOverwriteMode", "static")
            .partitionBy(day_col).parquet(path))
        report["rows_after"] = written.get.get("n", 0)
        report["bytes"] = path_bytes(spark, [path])
    delete_path(spark, batch.path)
    if run_log:
        from feedloom.operators.layout import log_run
        log_run(spark, table_path, "append_delta", report, batch_id)
    return report


def read_merged(spark: SparkSession, table_path: str, keys, order: Sequence[Column | str] = (), mode: str = "latest",
                day_col: str = "ingest_day", days: Sequence | None = None) -> DataFrame | None:
    """The table with its deltas: per day and key the newest delta's row (``"latest"``), or the oldest row (``"insert_only"``).

    ``days`` opens only those days' folders. ``None`` if there is nothing to read."""
    wanted = None if days is None else {str(d) for d in days}
    folders = [x for x in _day_folders(spark, table_path, day_col) if wanted is None or x[1] in wanted]
    touched = sorted({d for _, d, _ in folders})
    if wanted is not None:
        base = read_days_only(spark, table_path, day_col, sorted(wanted))
    else:
        have = any(d.startswith(f"{day_col}=") for d in child_folders(spark, table_path))
        base = spark.read.parquet(table_path) if have else None
    if not folders:
        return base
    ks = [day_col, *_cols(keys)]
    delta = spark.read.option("basePath", _root(table_path)).parquet(*[p for _, _, p in folders])
    newest = F.desc("seq") if mode == "latest" else F.asc("seq")
    one = keep_one(delta.drop("batch"), ks, [newest, *order]).drop("seq")
    if base is None:
        return one
    one = one.select(*[c for c in base.columns if c in one.columns], *[c for c in one.columns if c not in base.columns])
    here = F.col(day_col).cast("string").isin(touched)
    plain, under = base.filter(~here), base.filter(here)
    if mode == "latest":
        met = union_by_name(under.join(one.select(*ks), ks, "left_anti"), one)
    else:
        met = union_by_name(under, one.join(under.select(*ks), ks, "left_anti"))
    out = union_by_name(plain, met)
    return out.select(*base.columns, *[c for c in out.columns if c not in base.columns])


def drop_deltas(spark: SparkSession, table_path: str, day_col: str, days: Sequence) -> None:
    """Remove the deltas of some days, the oldest first."""
    gone = {str(d) for d in days}
    for _, d, path in _day_folders(spark, table_path, day_col):
        if d in gone:
            delete_path(spark, path)
    for _, _, path in _deltas(spark, table_path):
        if path_exists(spark, f"{path}/_SUCCESS") and not child_folders(spark, path):
            delete_path(spark, path.rsplit("/", 1)[0])


def fold_deltas(spark: SparkSession, table_path: str, keys, order: Sequence[Column | str] = (), mode: str = "latest",
                day_col: str = "ingest_day", share: float = 0.1, cluster_by: Sequence[str] | None = None) -> dict:
    """Merge the deltas into the base for the days whose deltas hold more than ``share`` of the base's bytes.

    Other days are not opened. Returns the folded days."""
    publish_days(spark, table_path, day_col)  # what an interrupted run has left
    sizes: dict[str, int] = {}
    for _, d, path in _day_folders(spark, table_path, day_col):
        sizes[d] = sizes.get(d, 0) + path_bytes(spark, [path])
    base = {d: path_bytes(spark, [f"{table_path.rstrip('/')}/{day_col}={d}"]) for d in sizes}
    days = sorted(d for d, n in sizes.items() if n > share * base[d])
    if days:
        merged = read_merged(spark, table_path, keys, order, mode, day_col, days)
        swap_in(spark, table_path, day_files(merged, day_col, list(cluster_by or _cols(keys))), day_col)
        drop_deltas(spark, table_path, day_col, days)
    return {"target": table_path, "days": days, "left": sorted(set(sizes) - set(days))}
