"""Op 13: target-distribution importance resampling on hashed n-grams, their CRCs taken from running CRCs.

Each text is scanned once in its normal form (A-Z in lower case, words joined by one space): the CRC-32 of the text so
far is stored at the end of each word, and by one table step for the space, at the start of the next. The CRC of any
run of words follows from two of them: CRC-32 is linear over GF(2), so crc(B) = crc(AB) xor shift(crc(A), len(B)),
where the shift by a number of zero bytes is four table look-ups for each digit (base 64) of that number. No n-gram is
cut out or read a second time, whatever its length.

A bucket is a feature's CRC modulo ``buckets``. The buckets of all features of the corpus and of the target texts are
counted (per task first; at most ``buckets`` rows reach the driver), a bucket's gain is the scaled logarithm of its
smoothed shares, a document's weight the mean gain of its features. The draw adds fixed Gumbel noise from the hash of
the key, so the first ``share`` of the documents with at least ``least_words`` words, by score, are a sample without
replacement in proportion to exp(weight / 1000).

Scale: texts are read once and never shuffled; two bytes for each feature are written to the shared folder, counted
and weighed there. The ranks come from a range-partitioned order with row counts per range, not from one task.

Null and empty texts have no feature, weight 0, and are never drawn (unless ``least_words`` is 0). A null key's text is
empty. Repeated rows, and rows with one key, are rows of their own; of equal scores and keys either comes first.
Texts of any length are scanned in pieces cut between words. Empty tables give empty results; an empty target makes
all gains follow the corpus alone. Other columns pass through, apart from the text; columns named like an output are replaced.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import col, pieces, ship, stored, table, utf8, word_spans
from feedloom.operators.joins import numbered

WORDS, BUCKETS, LEAST_WORDS, PERCENT, SEED = 1, 10_000, 20, 10, "2024"
FIELDS = ["n_features", "weight", "score", "rank"]

_ONES = np.uint32(0xFFFFFFFF)
_POLYNOMIAL = np.uint32(0xEDB88320)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.zeros(256, bool)
_IN_WORD[48:58] = _IN_WORD[97:123] = _IN_WORD[128:] = True
_TEXT = np.where(_IN_WORD, np.arange(256), 32).astype(np.uint8)[_LOWER]  # bytes of words in lower case, else a space
_GAP = _TEXT == 32


def _table() -> np.ndarray:
    x = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        x = np.where(x & np.uint32(1), (x >> np.uint32(1)) ^ _POLYNOMIAL, x >> np.uint32(1))
    return x


_STEP = _table()


def _zero_byte(x: np.ndarray) -> np.ndarray:
    return _STEP[x & np.uint32(255)] ^ (x >> np.uint32(8))


@lru_cache(maxsize=None)
def _shifts(digit: int) -> np.ndarray:
    """[64, 4, 256]: what k * 64**digit zero bytes make of each byte of a CRC."""
    cur = np.arange(256, dtype=np.uint32)[None, :] << (np.arange(4, dtype=np.uint32) * 8)[:, None]
    out = np.empty((64, 4, 256), np.uint32)
    for k in range(64):
        out[k] = cur
        if digit == 0:
            cur = _zero_byte(cur)
        else:
            once = _shifts(digit - 1)
            cur = _through(once[63], _through(once[1], cur))  # 63 + 1 steps of the digit below
    return out


def _through(tables: np.ndarray, x: np.ndarray) -> np.ndarray:
    return (tables[0][x & np.uint32(255)] ^ tables[1][(x >> np.uint32(8)) & np.uint32(255)]
            ^ tables[2][(x >> np.uint32(16)) & np.uint32(255)] ^ tables[3][x >> np.uint32(24)])


def shift(crcs: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """CRCs carried on over so many zero bytes, without the initial and final inversion."""
    out, left, digit = crcs.astype(np.uint32), sizes.astype(np.int64), 0
    while left.any():
        t, k = _shifts(digit), left % 64
        out = (t[k, 0, out & np.uint32(255)] ^ t[k, 1, (out >> np.uint32(8)) & np.uint32(255)]
               ^ t[k, 2, (out >> np.uint32(16)) & np.uint32(255)] ^ t[k, 3, out >> np.uint32(24)])
        left, digit = left // 64, digit + 1
    return out


def after_space(crcs: np.ndarray) -> np.ndarray:
    x = crcs ^ _ONES
    return _STEP[(x ^ np.uint32(32)) & np.uint32(255)] ^ (x >> np.uint32(8)) ^ _ONES


def scan(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, crc: int) -> np.ndarray:
    """The running CRC at the end of each word, a space read before each."""
    sizes = ends - starts + 1
    stops = np.cumsum(sizes)
    normal = np.full(int(stops[-1]) if len(stops) else 0, 32, np.uint8)
    letters = np.ones(len(normal), bool)
    letters[stops - sizes] = False
    normal[letters] = data[data != 32]
    view, out, at, one = memoryview(normal), [], 0, zlib.crc32
    for stop in stops.tolist():
        crc = one(view[at:stop], crc)
        out.append(crc)
        at = stop
    return np.array(out, np.uint32)


def ngram_crcs(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of texts as UTF-8: the text and CRC of each run of 1 to ``n`` words, and the words of each text."""
    texts, found, words = [], [], np.zeros(len(offsets) - 1, np.int64)
    crc, place, tail = 0, 0, None  # running CRC, bytes scanned, and the last words of a text that goes on
    for part, offs, rows in pieces(data, offsets, _GAP):
        plain = _TEXT[part]
        starts, ends, which = word_spans(plain, offs)
        row = rows[which]
        words += np.bincount(row, minlength=len(words))
        if not len(starts):
            continue
        end_crc = scan(plain, starts, ends, crc)
        start_crc = after_space(np.concatenate([[np.uint32(crc)], end_crc[:-1]]).astype(np.uint32))
        end_at = place + np.cumsum(ends - starts + 1)
        start_at = end_at - (ends - starts)
        crc, place, fresh = int(end_crc[-1]), int(end_at[-1]), 0
        if tail is not None and tail[0][-1] == row[0]:
            fresh = len(tail[0])
            row, start_crc, end_crc, start_at, end_at = (np.concatenate(x) for x in zip(tail, (row, start_crc, end_crc, start_at, end_at)))
        for k in range(1, n + 1):
            last = np.arange(max(fresh, k - 1), len(row))
            first = last - k + 1
            same = row[first] == row[last]
            first, last = first[same], last[same]
            found.append(end_crc[last] ^ shift(start_crc[first], end_at[last] - start_at[first]))
            texts.append(row[last])
        mine = np.flatnonzero(row == row[-1])[-(n - 1):] if n > 1 else []
        tail = tuple(x[mine] for x in (row, start_crc, end_crc, start_at, end_at)) if len(mine) else None
    if not texts:
        return np.zeros(0, np.int64), np.zeros(0, np.uint32), words
    return np.concatenate(texts), np.concatenate(found), words


def with_buckets(df: DataFrame, text: str, n: int, buckets: int, fields: list[str]) -> DataFrame:
    """Add number of words, number of features and the features' buckets (binary, two or four bytes each)."""
    ship(df)
    kind = np.uint16 if buckets <= 1 << 16 else np.uint32

    @F.arrow_udf("struct<a: long, b: long, c: binary>")
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for arr in texts:
            data, offsets = utf8(arr)
            row, crc, words = ngram_crcs(data, offsets, n)
            bucket = (crc % np.uint32(buckets)).astype(kind)[np.argsort(row, kind="stable")]
            count = np.bincount(row, minlength=len(words))
            at = np.concatenate([[0], np.cumsum(count)])
            cells = [bucket[i:j].tobytes() for i, j in zip(at, at[1:])]
            yield pa.StructArray.from_arrays([pa.array(words), pa.array(count.astype(np.int64)), pa.array(cells, pa.binary())], ["a", "b", "c"])

    wide = df.withColumn("_found", run(F.col(text)))
    return wide.select(*[c for c in df.columns if c != text], *[F.col("_found")[x].alias(f) for x, f in zip("abc", fields)])


def bucket_counts(df: DataFrame, cells: str, buckets: int) -> np.ndarray:
    """How many features fall into each bucket: counted per task, then summed."""
    kind = np.uint16 if buckets <= 1 << 16 else np.uint32

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for cell in batch.column(0):
                total += np.bincount(np.frombuffer(cell.as_buffer(), kind), minlength=buckets)
        full = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(total[full])], ["bucket", "n"])

    got = df.select(col(cells)).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(buckets, np.int64)  # at most ``buckets`` rows
    for r in got:
        out[r.bucket] = r.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    s_all, t_all, b = int(source.sum()), int(target.sum()), len(source)
    return np.array([math.floor(1000 * math.log((t + 1) * (s_all + b) / ((s + 1) * (t_all + b))))
                     for s, t in zip(source.tolist(), target.tolist())], np.int64)


def weigh(df: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", n: int = WORDS, buckets: int = BUCKETS,
          least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: str = SEED) -> DataFrame:
    """The rows of ``df`` without their text, with ``n_features``, ``weight``, ``score`` and ``rank`` (null: not drawn).

    ``target`` holds the target texts in a column of the same name."""
    taken = {f.lower() for f in FIELDS} - {key.lower()} | {text.lower()}
    kept = [c for c in df.columns if c.lower() not in taken]
    rows = df.select(F.struct(*[col(c) for c in kept]).alias("row"), col(key).alias("id"), col(text).alias("text"))
    made = stored(with_buckets(rows, "text", n, buckets, ["words", "n_features", "cells"]), "features")
    aim = with_buckets(target.select(col(text).alias("text")), "text", n, buckets, ["words", "n_features", "cells"])
    gain = gains(bucket_counts(made, "cells", buckets), bucket_counts(aim, "cells", buckets))
    kind = np.uint16 if buckets <= 1 << 16 else np.uint32

    @F.arrow_udf("struct<weight: long, score: long>")
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for keys, parts in batches:
            mean, total = [], []
            for k, cell in zip(keys.to_pylist(), parts):
                got = np.frombuffer(cell.as_buffer(), kind)
                mean.append(int(gain[got].sum()) // len(got) if len(got) else 0)
                h = int(hashlib.sha256(f"{seed}:{'' if k is None else k}".encode()).hexdigest()[:8], 16)
                total.append(mean[-1] + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))))
            yield pa.StructArray.from_arrays([pa.array(mean, pa.int64()), pa.array(total, pa.int64())], ["weight", "score"])

    scored = made.withColumn("got", run(F.col("id").cast("string"), F.col("cells"))).select(
        "row", "n_features", "got.weight", "got.score", (F.col("words") >= least_words).alias("enough"), F.struct(-F.col("got.score"), "id").alias("place"))
    scored = stored(scored, "scored")
    drawn = scored.filter("enough").count() * percent // 100
    rank = F.when(F.col("enough") & (F.col("pos") < drawn), F.col("pos") + 1).cast("long")
    return numbered(scored, "enough", "place").select(*[F.col("row")[c].alias(c) for c in kept], "n_features", "weight", "score", rank.alias("rank"))


def resample(df: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The drawn rows of ``df`` (by key, which should be unique), whole."""
    ranks = weigh(df.select(col(key), col(text)), target.select(col(text)), key, text, **options)
    ranks = ranks.filter("rank IS NOT NULL").select(col(key).alias("_drawn")).distinct()
    return df.join(ranks, col(key).eqNullSafe(F.col("_drawn")), "left_semi")


def op13_importance(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return weigh(docs, table(spark, sf_dir, "benchmark").select("text")).select("doc_id", *FIELDS)


def _sql_words(of: str) -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return rf"regexp_extract_all(translate({of}, '{upper}', '{upper.lower()}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


ORACLE = rf"""
    WITH doc AS (SELECT row_number() OVER () AS row, doc_id, coalesce({_sql_words("text")}, []) AS words FROM documents),
    word AS (SELECT row, unnest(words) AS w FROM doc),
    aim AS (SELECT unnest({_sql_words("text")}) AS w FROM benchmark),
    hexed AS (SELECT w, hex(encode(w)) AS x FROM (SELECT w FROM word UNION SELECT w FROM aim)),
    crc AS (SELECT w, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(0, len(x) // 2),
                lambda i: ('0x' || substr(x, 2 * i::BIGINT + 1, 2))::BIGINT)), lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
                lambda c, d: xor(c >> 1, 3988292384::BIGINT * (c & 1)))), 4294967295::BIGINT) % {BUCKETS} AS bucket FROM hexed),
    s AS (SELECT bucket, count(*) AS n FROM word JOIN crc USING (w) GROUP BY 1),
    t AS (SELECT bucket, count(*) AS n FROM aim JOIN crc USING (w) GROUP BY 1),
    sums AS (SELECT (SELECT coalesce(sum(n), 0) FROM s)::BIGINT AS sn, (SELECT coalesce(sum(n), 0) FROM t)::BIGINT AS tn),
    gain AS (SELECT s.bucket, floor(1000 * ln((coalesce(t.n, 0) + 1) * (sn + {BUCKETS}) / ((s.n + 1) * (tn + {BUCKETS}))))::BIGINT AS gain
             FROM s LEFT JOIN t USING (bucket), sums),
    mean AS (SELECT row, floor(sum(gain) / count(*))::BIGINT AS weight, count(*) AS n FROM word JOIN crc USING (w) JOIN gain USING (bucket) GROUP BY 1),
    scored AS (SELECT doc.row, doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
                   coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE)
                   / 4294967296)))::BIGINT AS score FROM doc LEFT JOIN mean USING (row)),
    placed AS (SELECT row, row_number() OVER (ORDER BY score DESC, doc_id) AS place FROM scored WHERE n_features >= {LEAST_WORDS}),
    size AS (SELECT count(*) * {PERCENT} // 100 AS drawn FROM placed)
    SELECT doc_id, n_features, weight, score, CASE WHEN place <= drawn THEN place END AS rank FROM scored LEFT JOIN placed USING (row), size"""
