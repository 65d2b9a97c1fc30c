"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.session import delete_path, scratch_path, ship_package

BLOCK_BYTES = 1 << 20  # of text that numpy works on at a time
GAP = np.zeros(256, bool)  # bytes between words
GAP[[9, 10, 11, 12, 13, 32]] = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def col(name: str) -> Column:
    """A column by its exact name (dots and spaces included)."""
    return F.col("`" + name.replace("`", "``") + "`")


def others(df: DataFrame, names) -> list[Column]:
    """The columns of ``df`` that none of ``names`` replaces."""
    taken = {n.lower() for n in names}
    return [col(c) for c in df.columns if c.lower() not in taken]


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have."""
    have, name = {c.lower() for c in df.columns}, base
    while name.lower() in have:
        name += "_"
    return name


def add_fields(df: DataFrame, struct: Column, fields) -> DataFrame:
    """``df`` with the fields of ``struct`` as columns; columns with these names are replaced."""
    tmp = free_name(df, "_fields")
    wide = df.withColumn(tmp, struct)
    return wide.select(*others(df, fields), *[col(tmp)[f].alias(f) for f in fields])


def packed(df: DataFrame, *names: str) -> DataFrame:
    """The whole rows as struct ``row`` and some columns beside it, so that no name of a row can clash."""
    return df.select(F.struct("*").alias("row"), *[col(n).alias(n) for n in names])


_OPEN: ContextVar[tuple[list[str], ...]] = ContextVar("open", default=())  # tables of the steps under way, outer ones first


@contextmanager
def tidied(spark: SparkSession) -> Iterator[None]:
    """A step whose stored tables are removed at its end, but for those stored with ``keep``: they belong to the step
    around it, if there is one. What leaves the step must not read the others any more."""
    made: list[str] = []
    token = _OPEN.set((*_OPEN.get(), made))
    try:
        yield
    finally:
        _OPEN.reset(token)
        for path in made:
            delete_path(spark, path)


def stored(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """``df`` written to the shared scratch folder and read again: lineage ends there, lost executors do no harm.
    The table goes with the step that it is stored in (see :func:`tidied`), with ``keep`` with the step around that."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    steps = _OPEN.get()[:-1] if keep else _OPEN.get()
    if steps:
        steps[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def hash_share(key: Column) -> Column:
    """A fixed pseudo-random number in [0, 1) for a key, alike on every run and engine (md5 of its text)."""
    head = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 13)
    return F.conv(head, 16, 10).cast("double") / F.lit(float(1 << 52))


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(df: DataFrame) -> None:
    """Let Python workers import this package, and keep Arrow batches small: where the session has Spark's default
    of 10,000 rows, which is much memory for rows of whole texts, it is set to 2,000."""
    spark = df.sparkSession
    ship_package(spark)
    if spark.conf.get(BATCH_ROWS) == "10000":
        spark.conf.set(BATCH_ROWS, "2000")


def utf8(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string array, one after the other, and the row offsets (rows + 1); nulls are empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    arr = arr.fill_null("")
    if pa.types.is_string(arr.type):
        kind = np.int32
    else:
        arr, kind = arr.cast(pa.large_string()), np.int64
    if len(arr) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = arr.buffers()
    offs = np.frombuffer(offsets, kind, len(arr) + 1, arr.offset * kind().itemsize).astype(np.int64)
    body = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return body[offs[0]:offs[-1]], offs - offs[0]


def blocks(offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each (one row at least), in order."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


_BASE, _STEP = np.uint64(0x9E3779B97F4A7C15), 1 << 12


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    for k in range(1, n):
        out[k] = out[k - 1] * np.uint64(base)
    return out


with np.errstate(over="ignore"):
    _LOW = _powers(int(_BASE), _STEP)
    _HIGH = _powers(int(_LOW[-1] * _BASE), _STEP)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (one-to-one)."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def span_hashes(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """64-bit polynomial hashes of the spans of ``data`` that begin at ``starts`` (increasing) and end at the next
    one, the last at the end. A span's hash depends on its bytes alone."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    data = data[starts[0]:]
    starts = starts - starts[0]
    k = np.arange(len(data)) - np.repeat(starts, np.diff(starts, append=len(data)))
    power = _LOW[k % _STEP]
    if len(k) and k.max() >= _STEP:
        power = power * _HIGH[k // _STEP % _STEP]
    return mixed(np.add.reduceat((data.astype(np.uint64) + np.uint64(1)) * power, starts))


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words (runs without space, tab, line and page breaks): their starts, ends, and the row of each."""
    gap = (data == 32) | ((data >= 9) & (data <= 13))
    inside = ~gap
    first = inside.copy()
    first[1:] &= gap[:-1]
    last = inside.copy()
    last[:-1] &= gap[1:]
    edge = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]  # words end with their text
    first[edge] = inside[edge]
    last[edge - 1] = inside[edge - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(offsets, starts, "right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of words given by their spans."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    keep = np.zeros(len(data) + 1, np.int8)
    keep[starts] += 1
    np.add.at(keep, ends, -1)
    sizes = ends - starts
    return span_hashes(data[np.cumsum(keep[:-1]) > 0], np.cumsum(sizes) - sizes)


def pieces(data: np.ndarray, offsets: np.ndarray, gap: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks (bytes, offsets, rows) of about ``limit`` bytes: whole texts, and parts of longer ones, each cut behind a
    byte that ``gap`` (by byte value) marks. ``rows`` names the text of each piece; pieces come in the order of the texts."""
    for i, j in blocks(offsets, limit):
        if offsets[j] - offsets[i] <= limit:
            yield data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], np.arange(i, j)
            continue
        at, end = int(offsets[i]), int(offsets[j])  # one long text
        while at < end:
            cut = at + limit
            while cut < end:
                here = np.flatnonzero(gap[data[cut - 1:cut + 4095]])
                if len(here):
                    cut += int(here[0])
                    break
                cut += 4096
            cut = min(cut, end)
            yield data[at:cut], np.array([0, cut - at]), np.array([i])
            at = cut
