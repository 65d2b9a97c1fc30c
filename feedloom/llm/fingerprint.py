"""Op 1: document fingerprints by context-triggered piecewise hashing.

A rolling hash of seven bytes ends a chunk where its low bits are zero: two bits at block size 4, one more
with each doubling, so the boundaries at a block size are also boundaries at all smaller ones. A chunk's
hash gives one of 64 characters; a text's block size is the smallest at which it has at most 64 chunks, and
its fingerprint is ``size:signature`` followed by the signatures at twice and four times that size. Every
byte takes part, the end of a text as a chunk of its own. Two fingerprints are compared at the smallest block
size that both have: likeness is 1 - distance / (sum of lengths), where distance counts inserted and deleted
characters, and 0 if no run of characters is common or no block size is.

Fingerprints depend on the text alone (equal texts, equal fingerprints). Null is the empty text, whose
fingerprint is ``4:::``. Texts of any length are hashed whole. Neighbours are taken in descending order of id
(null ids last, equal ids by text): a table of one row is its own neighbour, repeated rows are neighbours.
Other columns pass through :func:`fingerprints`; empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import _LOW, add_fields, blocks, col, mixed, ship, span_hashes, table, utf8

WINDOW, BASE_BITS, LONGEST, LEVELS = 7, 2, 64, 3
FACTOR = np.uint32(0x01000193)
ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)


def boundary_levels(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions after which a chunk ends at block size 4, and the largest doubling at which one still ends there."""
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    at = np.arange(len(data)) + (rows + 1) * (WINDOW - 1)  # nothing of the text before shows in a window
    spaced = np.zeros(len(data) + len(offsets) * (WINDOW - 1), np.uint32)
    spaced[at] = data.astype(np.uint32) + 1
    roll = np.zeros(len(spaced), np.uint32)
    for k in range(WINDOW):  # sum of byte[i - k] * FACTOR ** (k + 1), by Horner's rule from the oldest byte on
        roll *= FACTOR
        roll[WINDOW - 1:] += spaced[k:len(spaced) - WINDOW + 1 + k]
    roll = roll[at] * FACTOR
    roll ^= roll >> np.uint32(15)
    roll *= np.uint32(0x2C1B3C6D)
    roll ^= roll >> np.uint32(13)
    ends = np.flatnonzero(roll & ((1 << BASE_BITS) - 1) == 0)
    high = roll[ends] >> BASE_BITS
    lowest = (high & -high.astype(np.int64)).astype(np.float64)  # the lowest bit that is set
    return ends, np.where(high > 0, np.frexp(lowest)[1] - 1, 30).astype(np.int64)


def fingerprints_of(data: np.ndarray, offsets: np.ndarray) -> list[str]:
    """The fingerprint of each text."""
    n = len(offsets) - 1
    ends, level = boundary_levels(data, offsets)
    # The smallest chunks: spans that end after a boundary or with their text.
    cuts = np.concatenate([ends + 1, offsets[1:]])
    order = np.argsort(cuts, kind="stable")
    cuts, level = cuts[order], np.concatenate([level, np.full(n, 99)])[order]
    fresh = np.concatenate([cuts[1:] != cuts[:-1], [True]]) if len(cuts) else np.zeros(0, bool)  # the text's end wins
    cuts, level = cuts[fresh], level[fresh]
    real = cuts > 0
    cuts, level = cuts[real], level[real]
    starts = np.concatenate([[0], cuts[:-1]]) if len(cuts) else cuts
    small = span_hashes(data, starts)
    row = np.searchsorted(offsets, starts, "right") - 1
    top = 30
    per = np.bincount(row * (top + 1) + np.minimum(level, top), minlength=n * (top + 1)).reshape(n, top + 1)
    at_least = per[:, ::-1].cumsum(1)[:, ::-1]  # chunks at each doubling
    first = (at_least > LONGEST).sum(1)
    parts = [[str(1 << (BASE_BITS + k))] for k in first.tolist()]
    for more in range(LEVELS):
        last = level >= (first + more)[row]
        head = np.concatenate([[True], last[:-1]]) if len(last) else last
        begin = np.flatnonzero(head)
        k = np.arange(len(small)) - np.repeat(begin, np.diff(begin, append=len(small)))
        powers = _LOW[k % len(_LOW)] + (k // len(_LOW)).astype(np.uint64)
        whole = mixed(np.add.reduceat(small * powers, begin)) if len(begin) else small
        text = ALPHABET[(whole >> np.uint64(58)).astype(np.int64)].tobytes().decode()
        bounds = np.searchsorted(row[begin], np.arange(n + 1)).tolist()
        for p, a, b in zip(parts, bounds, bounds[1:]):
            p.append(text[a:b])
    return [":".join(p) for p in parts]


def common_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, on the bits of whole numbers."""
    where: dict[str, int] = {}
    for k, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << k
    full = (1 << len(a)) - 1
    free = full
    for c in b:
        hit = free & where.get(c, 0)
        free = (free + hit | free - hit) & full
    return len(a) - free.bit_count()


def likeness(f: str, g: str) -> float:
    """Similarity of two fingerprints, 0 to 1."""
    if f == g:
        return 1.0
    size_f, *sig_f = f.split(":")
    size_g, *sig_g = g.split(":")
    shift = int(size_f).bit_length() - int(size_g).bit_length()
    if shift > 0:
        sig_f, sig_g, shift = sig_g, sig_f, shift
    shift = abs(shift)
    if shift >= LEVELS:
        return 0.0
    a, b = sig_f[shift], sig_g[0]
    run = 5 if min(len(a), len(b)) >= 16 else 3 if min(len(a), len(b)) >= 6 else 1
    if not {a[k:k + run] for k in range(len(a) - run + 1)} & {b[k:k + run] for k in range(len(b) - run + 1)}:
        return 0.0
    distance = len(a) + len(b) - 2 * common_length(a, b)
    return 1 - distance / (len(a) + len(b))


def of_texts(texts: list[str]) -> list[str]:
    data, offsets = utf8(pa.array(texts, pa.large_string()))
    return [f for i, j in blocks(offsets) for f in fingerprints_of(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])]


def fingerprints(df: DataFrame, text: str = "text") -> DataFrame:
    """Add ``fingerprint`` of each whole text."""
    ship(df)

    @F.arrow_udf("struct<fingerprint: string>")
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for arr in texts:
            data, offsets = utf8(arr)
            found = [f for i, j in blocks(offsets) for f in fingerprints_of(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])]
            yield pa.StructArray.from_arrays([pa.array(found, pa.string())], ["fingerprint"])

    return add_fields(df, run(col(text)), ["fingerprint"])


def in_order(df: DataFrame, per_partition: int = 8) -> DataFrame:
    """Rows (bucket, guest, id, text): documents dealt by ranges of descending id, each range closed by a guest, the
    first document of the next one (after the last: of the first). The ranges are about equal; their number
    follows the shuffle partitions, and so do the few ids that the driver sees."""
    spark = df.sparkSession
    n = per_partition * int(spark.conf.get("spark.sql.shuffle.partitions"))
    points = df.agg(F.percentile_approx("id", [k / n for k in range(1, n)], 20 * n)).first()[0] or []
    points = np.unique(np.array(points, np.int64))

    @F.arrow_udf("int")
    def bucket(ids: pa.Array) -> pa.Array:
        known = ids.is_valid().to_numpy(zero_copy_only=False)
        at = len(points) - np.searchsorted(points, ids.fill_null(0).to_numpy(), "right")
        return pa.array(np.where(known, at, len(points)).astype(np.int32))

    rows = df.select(bucket(F.col("id")).alias("bucket"), F.lit(False).alias("guest"), "id", "text")
    heads = sorted(df.select(bucket(F.col("id")).alias("bucket"), "id").groupBy("bucket").agg(F.max("id").alias("id")).collect())
    if not heads:
        return rows
    # The head of a range is the guest of the range before it: one row for each range.
    at = spark.createDataFrame([(h.id, heads[k - 1].bucket) for k, h in enumerate(heads)], "head long, bucket int")
    guests = df.join(F.broadcast(at), F.col("id").eqNullSafe(F.col("head"))).groupBy("bucket", "id").agg(
        F.min(F.struct(F.col("text").isNotNull().alias("some"), "text")).alias("t"))
    return rows.unionByName(guests.select("bucket", F.lit(True).alias("guest"), "id", F.col("t.text").alias("text")))


OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def compare_neighbours(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited text (second half replaced by the next document's beginning), and
    the likeness of the first to the second and to the next document's."""
    ship(df)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256).to_pydict()
                held += zip(part["bucket"], part["guest"], part["id"], (t or "" for t in part["text"]))
                yield from out(held)
                held = held[-1:]  # its next document comes with the next rows

    def out(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        whole = of_texts([r[3] for r in rows])
        here = [k for k in range(len(rows) - 1) if not rows[k][1]]
        edited = []
        for k in here:
            t = rows[k][3]
            half = len(t) // 2
            edited.append(t[:len(t) - half] + rows[k + 1][3][:half])
        other = of_texts(edited)
        if here:
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array([rows[k][2] for k in here], pa.int64()),
                "n_chars": pa.array([len(rows[k][3]) for k in here], pa.int64()),
                "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in edited],
                "fingerprint": [whole[k] for k in here], "edited_fingerprint": other,
                "near_edited": pa.array([likeness(whole[k], f) for k, f in zip(here, other)], pa.float64()),
                "near_next": pa.array([likeness(whole[k], whole[k + 1]) for k in here], pa.float64())})

    rows = in_order(df.select(col(key).cast("long").alias("id"), col(text).alias("text")))
    dealt = rows.repartition("bucket").sortWithinPartitions("bucket", "guest", F.desc_nulls_last("id"), F.asc_nulls_first("text"))
    return dealt.mapInArrow(run, OUT)


def op1_fingerprints(spark, sf_dir: str) -> DataFrame:
    return compare_neighbours(table(spark, sf_dir, "documents").select("doc_id", "text"))
