"""CSV / TSV sources (S1, S2, S3, S10 plain).

All feed files are read as text with an explicit schema and typed afterwards in one
normalise step, so a bad value is counted rather than guessed.
"""

from __future__ import annotations

import csv
from collections.abc import Iterable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.operators.dedup import POS, with_position
from feedloom.operators.merge import union_by_name
from feedloom.schemas import EVENT_FIELDS, WEATHER_FIELDS

CORRUPT = "_corrupt_record"

# Dialect written by Python's csv module (the pulls): quotes doubled, header line.
# A header that names other columns, or in another order, is an error, never a silent swap.
DAY_CSV = {"header": "true", "quote": '"', "escape": '"', "multiLine": "false", "mode": "PERMISSIVE",
           "enforceSchema": "false"}


def text_schema(columns: Iterable[str], corrupt: bool = False) -> T.StructType:
    fields = [T.StructField(c, T.StringType(), True) for c in columns]
    if corrupt:
        fields.append(T.StructField(CORRUPT, T.StringType(), True))
    return T.StructType(fields)


def read_text_csv(spark: SparkSession, paths, columns: Iterable[str], position: bool = False,
                  corrupt: bool = False, **options) -> DataFrame:
    """All-string CSV read with a header (S2). Empty fields read as NULL (A-4)."""
    opts = {**DAY_CSV, **options}
    if corrupt:
        opts["columnNameOfCorruptRecord"] = CORRUPT
    df = spark.read.schema(text_schema(columns, corrupt)).options(**opts).csv(paths)
    return with_position(df) if position else df


def read_weather_csv(spark: SparkSession, paths, position: bool = True, landed: bool = True,
                     **options) -> DataFrame:
    """Weather day files (S1), as text; ``operators.normalize.weather`` types them strictly.

    ``landed``: files of this library's landing, whose rows end with the pull ``stamp``."""
    cols = WEATHER_FIELDS + (["stamp"] if landed else [])
    return read_text_csv(spark, paths, cols, position=position, **options)


def read_event_csv(spark: SparkSession, paths, position: bool = True, landed: bool = True,
                   **options) -> DataFrame:
    """Event day files: header, comma, doubled quotes, all 61 columns as text (+ ``stamp``)."""
    cols = EVENT_FIELDS + (["stamp"] if landed else [])
    return read_text_csv(spark, paths, cols, position=position, corrupt=True, **options)


def read_event_tsv(spark: SparkSession, paths, position: bool = True, **options) -> DataFrame:
    """Unzipped event exports (S10 plain): tab-separated, no header, no quoting.

    Quoting must be off, otherwise a field starting with ``"`` swallows the next tab. Rows
    with other than 61 fields keep their raw line in ``_corrupt_record`` (A4).
    """
    df = (spark.read.schema(text_schema(EVENT_FIELDS, corrupt=True))
          .options(sep="\t", header="false", quote="\u0000", escape="\u0000", mode="PERMISSIVE",
                   columnNameOfCorruptRecord=CORRUPT)
          .options(**options)
          .csv(paths))
    return with_position(df) if position else df


# --------------------------------------------------------------------------- S3: align by header

def _headers(spark: SparkSession, pattern, base_path: str | None) -> dict[str, list[str]]:
    """Files by their header line: one row per file on the driver, as in Spark's own file listing."""
    reader = spark.read.option("basePath", base_path) if base_path else spark.read
    lines = reader.text(pattern).filter(F.col("_metadata.file_block_start") == 0).select(
        F.col("_metadata.file_path").alias("file"), F.struct(F.monotonically_increasing_id().alias("row"), "value").alias("line"))
    found: dict[str, list[str]] = {}
    for r in lines.groupBy("file").agg(F.min("line").alias("line")).collect():
        header = r.line.value.rstrip("\r").removeprefix("\ufeff")
        found.setdefault(header, []).append(unquote(r.file))
    return {h: sorted(found[h]) for h in sorted(found)}


def read_csv_by_header(spark: SparkSession, pattern, columns: Iterable[str] | None = None, sep: str = ",",
                       position: bool = True, base_path: str | None = None) -> DataFrame:
    """Several CSV files whose header order or width differs, aligned by column name (S3).

    A multi-file CSV read is positional in Spark. Here one pass finds each file's first line; the files are then read in
    groups of equal headers, each group by its own names in one CSV scan (split, pruned and parsed like any other), and
    united by name. Lines are never shuffled or joined.
    A column that a file lacks is NULL there; ``columns`` picks and orders columns (default: all, by name). With
    ``base_path`` (e.g. the landing root) partition folders such as ``ingest_day=`` become columns. A file without
    lines adds nothing.
    """
    wanted = list(columns) if columns is not None else None
    frames = []
    for k, (header, files) in enumerate(_headers(spark, pattern, base_path).items()):
        names = [c.strip() for c in next(csv.reader([header], delimiter=sep))]
        reader = spark.read.option("basePath", base_path) if base_path else spark.read
        options = {**DAY_CSV, "enforceSchema": "true", "sep": sep}  # the schema is the files' own header
        rows = reader.schema(text_schema(names)).options(**options).csv(files)
        if position:
            stamp = F.col("stamp") if "stamp" in names else F.lit(None).cast("string")
            row = F.monotonically_increasing_id() + F.lit(k << 55)  # groups in the order of their headers
            rows = rows.withColumn(POS, F.struct(stamp.alias("stamp"), row.alias("row")))
        if wanted is not None:
            kept = [c for c in rows.columns if c in wanted or c not in names]
            rows = rows.select(*kept)
        frames.append(rows)
    out = union_by_name(*frames) if frames else spark.createDataFrame([], text_schema(wanted or []))
    for c in wanted or []:
        if c not in out.columns:
            out = out.withColumn(c, F.lit(None).cast("string"))
    if position and POS not in out.columns:
        out = out.withColumn(POS, F.struct(F.lit(None).cast("string").alias("stamp"), F.lit(None).cast("bigint").alias("row")))
    return out if wanted is None else out.select(*wanted, *[c for c in out.columns if c not in wanted])
