"""Session construction and shared-folder helpers.

Everything that cuts lineage or writes an intermediate table goes under the folder the
cluster names in ``spark.checkpoint.dir``. Only when that setting is absent (a laptop,
a test) do we pick a folder of our own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the library relies on. Times are naive UTC throughout (the feeds publish UTC).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",   # AQE coalesces shuffle output to ~128 MB
    "spark.sql.files.maxPartitionBytes": "256m",                 # scan splits: ~400k tasks per 100 TB
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",  # staged batches are removed once unreferenced
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "feedloom",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or fetch) a session with the library's settings.

    On a cluster leave ``master`` unset so spark-submit decides; size
    ``shuffle_partitions`` to the data (about 128-256 MB of shuffle per partition).
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in {**DEFAULT_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only when the cluster names none."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not (sc.master or "").split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="feedloom-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder, for intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/feedloom-scratch/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the reliable checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def path_exists(spark: SparkSession, path: str) -> bool | None:
    """Whether ``path`` exists, through the cluster's Hadoop filesystem (HDFS, S3, local).

    Returns None where the JVM is not reachable (Spark Connect); callers then try a read.
    """
    try:
        sc = spark.sparkContext
        jvm, conf = sc._jvm, sc._jsc.hadoopConfiguration()
    except Exception:  # noqa: BLE001 - Spark Connect has no JVM handle
        return None
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(conf).exists(p))


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder that this library has written."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def path_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Bytes under some folders (those that exist)."""
    total = 0
    for path in paths:
        fs, p = _fs(spark, path)
        if fs.exists(p):
            total += fs.getContentSummary(p).getLength()
    return total


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly under ``path`` (none if it does not exist)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``feedloom`` importable in Python workers (once per application).

    ``mapInPandas`` functions are pickled by reference to their module, so executors must be
    able to import the package. Spark distributes the zipped sources itself (``addPyFile``);
    the zip holds code only, built on the driver.
    """
    import os
    import zipfile

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    import feedloom
    pkg = os.path.dirname(os.path.abspath(feedloom.__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="feedloom-code-"), "feedloom.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)
