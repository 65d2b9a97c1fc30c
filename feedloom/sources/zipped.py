"""Zipped event exports (S10): one archive per quarter hour, tab-separated, no header.

``binaryFile`` lists the archives; ``mapInPandas`` streams each one's members inside a task, decodes
UTF-8 with replacement and splits lines on ``\\n`` / ``\\r\\n`` only (A-13); Spark splits the fields on tab.
Rows are padded or cut to the 61 columns; the whole line (``_raw``) and its field count are kept beside them for
the ragged audit (A4). Archives are independent, so the work spreads one archive per row.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.schemas import EVENT_FIELDS
from feedloom.session import ship_package
from feedloom.sources.files import stamp_of

ZIP_LINES = "_file string, _member string, _line long, _raw string"
LINES = 5_000  # that are held at a time


def _unzip(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The lines of each archive's members, a bounded number at a time: no member is held whole."""
    for pdf in it:
        for path, content in zip(pdf["path"], pdf["content"]):
            with zipfile.ZipFile(io.BytesIO(content)) as z:
                for member in z.namelist():
                    with io.TextIOWrapper(z.open(member), encoding="utf-8", errors="replace", newline="\n") as lines:
                        for block in _blocks(enumerate(lines)):
                            yield pd.DataFrame({"_file": path, "_member": member, "_line": [k for k, _ in block],
                                                "_raw": pd.Series([x for _, x in block], dtype=object)})


def _blocks(lines: Iterator[tuple[int, str]]) -> Iterator[list[tuple[int, str]]]:
    held = []
    for k, line in lines:
        line = line.removesuffix("\n").removesuffix("\r")
        if line:  # blank lines carry no event
            held.append((k, line))
        if len(held) == LINES:
            yield held
            held = []
    if held:
        yield held


def unzip_events(archives: DataFrame) -> DataFrame:
    """Rows of archives (path, content): the 61 fields, where the line stood, the whole line and its number of fields;
    ``stamp`` comes from the archive's name."""
    ship_package(archives.sparkSession)
    lines = archives.select("path", "content").mapInPandas(_unzip, ZIP_LINES)
    cut = lines.withColumn("_f", F.split("_raw", "\t"))
    fields = [F.nullif(F.get("_f", F.lit(k)), F.lit("")).alias(c) for k, c in enumerate(EVENT_FIELDS)]
    return cut.select(*fields, "_file", "_member", "_line", F.size("_f").alias("_nfields"), "_raw").withColumn("stamp", stamp_of("_file"))


def read_event_zips(spark: SparkSession, pattern: str) -> DataFrame:
    """Rows of every archive matching ``pattern`` (see :func:`unzip_events`). An archive is one value of Spark's
    ``binaryFile`` source (2 GB compressed at most); its members may be of any size."""
    return unzip_events(spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(pattern))
