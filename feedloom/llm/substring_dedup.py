"""Op 12: removal of repeated passages, found level by level: windows repeated at one length alone go on to twice that length.

Words are runs without space, tab, line and page breaks, as they stand. A window is ``window`` consecutive words of one text;
every word under a window whose words also start anywhere else (in the same text included) goes.

1. Equal texts are one text with a count. Copies of a text of at least one window lose all words, so only one of them is
   searched, and a group of copies of any size is one row from here on.
2. A level looks at the short windows of one length, a quarter of the window's at first. Of the short windows inside a whole
   window the one with the smallest hash is its guard. Equal windows have equal guards, so only guards (a few in a hundred
   places) are compared; a window whose guard occurs once is out. The next level does the same with twice the length for the
   windows left, and the last one compares the windows still left by all their words. A level that nothing survives leaves
   the next ones without work.
3. Windows left at the whole length are brought together per text, and the words under them are cut out.

Texts move once, to be made distinct by a 64-bit hash; all levels and the cut read that one exchange again (its plan is alike, so
Spark uses it again), and places of repeated windows come to it by the same hash.

A level compares hashes by one shuffle on the hash, sorted, each row beside its equals. Within a batch of a task equal
hashes send one row as evidence; the others are known to repeat and travel by place, so a passage that stands in a third of all
texts costs its reducer one row per batch, not per text. Counting uses all rows of all texts: no caps, no samples.

Hashes have 64 bits. Two different windows or texts meet by chance with probability 2^-64: among 10^9 windows left at the last
level, or as many texts, about one pair in 37 runs; among 10^12 some 10^4 windows may be taken for repeated.

Null texts stay null and have no words. Texts of under one window keep all words. Texts of any length are cut into pieces
between words, windows go on across them. Repeated rows are copies. Empty tables give empty results; other columns pass
through (columns named like an output are replaced).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import col, mixed, pieces, ship, table, utf8, word_hashes, word_spans

WINDOW = 35
FIELDS = ["n_words", "n_removed", "kept_text"]
_GAP = np.zeros(256, bool)
_GAP[[9, 10, 11, 12, 13, 32]] = True


def levels(window: int) -> list[int]:
    """The three lengths: doubling up to the window (the last step overlaps where it does not divide)."""
    half = math.ceil(window / 2)
    return [math.ceil(half / 2), half, window]


def texts_words(data: np.ndarray, offsets: np.ndarray, overlap: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks (row, place in the text, hash) of words; a piece of a long text begins with the last ``overlap`` words of the one before."""
    tail = None
    for part, offs, rows in pieces(data, offsets, _GAP):
        starts, ends, which = word_spans(part, offs)
        if not len(starts):
            continue
        row, hashes = rows[which], word_hashes(part, starts, ends)
        begin = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        place = np.arange(len(row)) - np.repeat(begin, np.diff(begin, append=len(row)))
        if tail is not None and tail[0] == row[0]:
            place[row == row[0]] += tail[1][-1] + 1
            row = np.concatenate([np.full(len(tail[1]), tail[0]), row])
            place, hashes = np.concatenate([tail[1], place]), np.concatenate([tail[2], hashes])
        mine = np.flatnonzero(row == row[-1])[-overlap:]
        tail = (row[-1], place[mine], hashes[mine])
        yield row, place, hashes


def spans(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words of one sequence, by doubling: two runs make one of twice the length."""
    out, size, done, covered = words.astype(np.uint64), 1, None, 0
    while True:
        if n & size:
            done = out if done is None else joined(done[:len(done) - size], out[covered:], size)
            covered += size
            if covered == n:
                return done
        if size * 2 > n or len(out) <= size:
            return np.zeros(0, np.uint64)
        out = joined(out[:len(out) - size], out[size:], size)
        size *= 2


def joined(left: np.ndarray, right: np.ndarray, salt: int) -> np.ndarray:
    n = min(len(left), len(right))
    return mixed(left[:n] * np.uint64(0x9E3779B97F4A7C15) + mixed(right[:n] + np.uint64(salt)))


def least(x: np.ndarray, n: int, pick=np.minimum) -> np.ndarray:
    """The smallest (or by ``pick``) of each ``n`` neighbours."""
    size = 1
    while size * 2 <= n:
        x = pick(x[:len(x) - size], x[size:])
        size *= 2
    return x if size == n else pick(x[:len(x) - (n - size)], x[n - size:])


def whole(row: np.ndarray, n: int) -> np.ndarray:
    """Which runs of ``n`` places lie in one text."""
    return row[:max(len(row) - n + 1, 0)] == row[n - 1:] if len(row) >= n else np.zeros(0, bool)


def guards(h: np.ndarray, alive: np.ndarray, many: int) -> np.ndarray:
    """Which short windows (hashes ``h``) are the smallest of the ``many`` ones inside some window that is ``alive``."""
    if not alive.any():
        return np.zeros(len(h), bool)
    sure = np.where(alive, least(h, many), 0)  # 0: no window starts here
    edge = np.zeros(many - 1, np.uint64)
    reach = least(np.concatenate([edge, sure, edge]), many, np.maximum)
    # ``reach`` is the largest of the smallest hashes of all live windows around a place; each is at most the place's own.
    return (reach == h) & (reach > 0)


ASK = "h long, text long, place int"


def asked(h: np.ndarray, text: np.ndarray, place: np.ndarray) -> list[np.ndarray]:
    """Rows to compare. A hash that comes once asks; of one that comes again all rows are known to repeat (their hash is left out
    as 0, so that they travel by place), and one more row without a text is evidence."""
    h = np.maximum(h, np.uint64(1))
    order = np.argsort(h, kind="stable")
    s = h[order]
    twin = np.zeros(len(s), bool)
    twin[1:] = s[1:] == s[:-1]
    head = ~twin
    twin[:-1] |= s[1:] == s[:-1]
    proof = order[twin & head]  # the first of each that comes again
    known = h.copy()
    known[order[twin]] = 0
    none = np.full(len(proof), -1)
    return [np.concatenate([known, h[proof]]).view(np.int64), np.concatenate([text, none]).astype(np.int64), np.concatenate([place, none]).astype(np.int32)]


def record(arrays: list[np.ndarray], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names)


def gathered(batches: Iterator[pa.RecordBatch], rows: int = 1 << 16) -> Iterator[list[np.ndarray]]:
    """Small batches put together: the columns as arrays."""
    held, n = [], 0

    def out():
        return [np.concatenate([b.column(k).to_numpy(zero_copy_only=False) for b in held]) for k in range(held[0].num_columns)]

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            n += batch.num_rows
        if n >= rows:
            yield out()
            held, n = [], 0
    if held:
        yield out()


def repeated(rows: DataFrame) -> DataFrame:
    """The rows (text, place) whose hash occurs in another row as well."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, done = None, False  # the row before this batch, and whether it has gone out already
        for cols in gathered(batches):
            if last is not None:
                cols = [np.concatenate([a, b]) for a, b in zip(last, cols)]
            h, text, place = cols
            equal = (h[1:] == h[:-1]) & (h[1:] != 0)
            keep = h == 0
            keep[1:] |= equal
            keep[:-1] |= equal
            out = keep & (place >= 0)
            if done:
                out[0] = False
            done = bool(keep[-1])
            last = [c[-1:] for c in cols]
            yield record([text[out], place[out]], ["text", "place"])

    dealt = rows.repartition(F.when(F.col("h") == 0, F.xxhash64("text", "place")).otherwise(F.col("h"))).sortWithinPartitions("h")
    return dealt.mapInArrow(run, "text long, place int")


def by_text(rows: DataFrame) -> DataFrame:
    """Rows (text, places): the places of each text, in order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = [], None

        def out(texts, lists):
            return pa.RecordBatch.from_arrays([pa.array(texts, pa.int64()), pa.array(lists, pa.binary())], ["text", "places"])

        for text, place in gathered(batches):
            cut = np.flatnonzero(text[1:] != text[:-1]) + 1
            for t, p in zip(text[np.concatenate([[0], cut])].tolist(), np.split(place.astype(np.int32), cut)):
                if at is not None and t != at:
                    yield out([at], [np.concatenate(held).tobytes()])
                    held = []
                at = t
                held.append(p)
        if at is not None:
            yield out([at], [np.concatenate(held).tobytes()])

    dealt = rows.select("text", "place").repartition("text").sortWithinPartitions("text", "place")
    return dealt.mapInArrow(run, "text long, places binary")


def level(texts: DataFrame, before: int, length: int, window: int) -> DataFrame:
    """What a level compares, of texts (id, text, copies, and beyond the first level ``places``: the repeated guards of length
    ``before``): guards of ``length``, or at the whole length all windows left."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            ids = batch.column("id").to_numpy()
            places = [np.frombuffer(p.as_buffer(), np.int32) for p in batch.column("places")] if before else []
            found = [[np.zeros(0, t)] for t in (np.uint64, np.int64, np.int64)]
            for row, place, hashes in texts_words(data, offsets, window - 1):
                alive = whole(row, window)
                if before and alive.any():
                    h = spans(hashes, before)
                    hit = np.zeros(len(row), bool)
                    start = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
                    for a, n in zip(start.tolist(), np.diff(start, append=len(row)).tolist()):
                        mine = places[row[a]].astype(np.int64) - place[a]
                        hit[a + mine[(mine >= 0) & (mine < n)]] = True
                    # A window goes on if a short window that equals its guard is repeated.
                    alive &= np.isin(least(h, window - before + 1), np.unique(h[hit[:len(h)]]))
                if not alive.any():
                    continue
                h = spans(hashes, length)
                at = np.flatnonzero(alive if length == window else guards(h, alive, window - length + 1))
                for have, new in zip(found, (h[at], ids[row[at]], place[at])):
                    have.append(new)
            # A guard near the edge of a piece of a long text may come with both pieces; the next level drops what that lets through.
            yield record(asked(*(np.concatenate(x) for x in found)), ["h", "text", "place"])

    return texts.mapInArrow(run, ASK)


def cut(text: Column, places: Column, copies: Column, window: int) -> Column:
    """struct<n_words, n_removed, kept_text> of a text, the places of its repeated windows and its number of copies."""
    @F.arrow_udf("struct<n_words: long, n_removed: long, kept_text: string>")
    def run(parts: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, lists, counts in parts:
            data, offsets = utf8(texts)
            n, gone, kept = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64), [[] for _ in range(len(texts))]
            counts = counts.to_numpy()
            for part, offs, rows in pieces(data, offsets, _GAP):
                starts, ends, which = word_spans(part, offs)
                edge = np.searchsorted(which, np.arange(len(rows) + 1))
                for k, row in enumerate(rows.tolist()):
                    a, b = int(edge[k]), int(edge[k + 1])
                    drop = np.zeros(b - a, bool)
                    if lists[row].is_valid:
                        at = np.frombuffer(lists[row].as_buffer(), np.int32).astype(np.int64) - n[row]
                        step = np.zeros(b - a + 1, np.int64)
                        at = at[(at > -window) & (at < b - a)]
                        np.add.at(step, np.maximum(at, 0), 1)
                        np.add.at(step, np.minimum(at + window, b - a), -1)
                        drop = np.cumsum(step[:-1]) > 0
                    n[row] += b - a
                    gone[row] += drop.sum()
                    kept[row] += [part[i:j].tobytes() for i, j, d in zip(starts[a:b].tolist(), ends[a:b].tolist(), drop.tolist()) if not d]
            copied = (counts > 1) & (n >= window)
            words = ["" if c else b" ".join(w).decode("utf-8", "replace") for c, w in zip(copied.tolist(), kept)]
            yield pa.StructArray.from_arrays([pa.array(n), pa.array(np.where(copied, n, gone)), pa.array(words, pa.string())], FIELDS)

    return run(text, places, copies)


def text_id(text: str) -> Column:
    return F.when(col(text).isNotNull(), F.xxhash64(col(text)))


def cuts(df: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """Rows (id, n_words, n_removed, kept_text): one for each different text, named by :func:`text_id`."""
    if window < 4:
        raise ValueError("a window has four words at least")
    ship(df)
    texts = df.select(text_id(text).alias("id"), col(text).alias("text")).filter("text IS NOT NULL").groupBy("id").agg(
        F.first("text").alias("text"), F.count("*").alias("copies"))

    def with_places(places: DataFrame, how: str) -> DataFrame:
        return texts.join(places.withColumnRenamed("text", "of"), F.col("id") == F.col("of"), how).select("id", "text", "copies", "places")

    asked_of, before = texts, 0
    for length in levels(window):
        places = by_text(repeated(level(asked_of, before, length, window)))
        asked_of, before = with_places(places, "inner"), length
    done = with_places(places, "left").select("id", cut(F.col("text"), F.col("places"), F.col("copies"), window).alias("r"))
    return done.select("id", *[F.col("r")[f].alias(f) for f in FIELDS])


def drop_repeated(df: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """The rows of ``df`` with ``n_words``, ``n_removed`` and ``kept_text`` (the words left, joined by one space; null for null)."""
    done = cuts(df, text, window).select(F.col("id").alias("of"), F.struct(*FIELDS).alias("r"))
    rows = df.select(F.struct(*[col(c) for c in df.columns]).alias("row"), text_id(text).alias("id"))
    keep = [c for c in df.columns if c.lower() not in FIELDS]
    zero = lambda f: F.coalesce(F.col("r")[f], F.lit(0)).cast("long").alias(f)
    return rows.join(done, F.col("id") == F.col("of"), "left").select(
        *[F.col("row")[c].alias(c) for c in keep], zero("n_words"), zero("n_removed"), F.col("r")["kept_text"].alias("kept_text"))


def op12_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """The digests come from the different texts; only they move to the rows."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    digest = lambda t: F.sha2(F.coalesce(t, F.lit("")).cast("binary"), 256)
    done = cuts(docs).select(F.col("id").alias("of"), "n_words", "n_removed", digest(F.col("kept_text")).alias("kept"))
    rows = docs.select("doc_id", text_id("text").alias("id")).join(done, F.col("id") == F.col("of"), "left")
    zero = lambda f: F.coalesce(f, F.lit(0)).cast("long").alias(f)
    return rows.select("doc_id", zero("n_words"), zero("n_removed"), F.coalesce("kept", digest(F.lit(""))).alias("kept_sha256"))


ORACLE = rf"""
    WITH doc AS (SELECT row_number() OVER () AS row, doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS words FROM documents),
    word AS (SELECT row, doc_id, unnest(words) AS w, generate_subscripts(words, 1) AS place,
                    CASE WHEN generate_subscripts(words, 1) + {WINDOW - 1} <= len(words)
                    THEN array_to_string(words[generate_subscripts(words, 1):generate_subscripts(words, 1) + {WINDOW - 1}], ' ') END AS win FROM doc),
    again AS (SELECT win FROM word WHERE win IS NOT NULL GROUP BY win HAVING count(*) > 1),
    covered AS (SELECT row, w, place, coalesce(max(again.win IS NOT NULL) OVER (PARTITION BY row ORDER BY place ROWS {WINDOW - 1} PRECEDING), false) AS gone
                FROM word LEFT JOIN again USING (win)),
    kept AS (SELECT row, count(*) FILTER (WHERE gone) AS n_removed, coalesce(string_agg(w, ' ' ORDER BY place) FILTER (WHERE NOT gone), '') AS t FROM covered GROUP BY row)
    SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
    FROM doc LEFT JOIN kept USING (row)"""
