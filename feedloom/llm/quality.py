"""Op 9: quality classifier, histogram gradient-boosted trees over document statistics.

Statistics of whole texts (shares of character kinds, word and line shapes, repetition) are computed on
Arrow batches with numpy. The trees are grown level by level on histograms of binned statistics, with
logistic loss, and kept as flat arrays: a complete tree of one depth each, so that all rows walk all trees
together by index arithmetic. The model is fitted on a bounded sample of the labelled rows (``rows``, by a
fixed hash of the id); everything else covers all documents.

Null and empty texts have all statistics 0 and get a score like any other. Without labelled rows, or with one
class only, the score is the smoothed share of label 1. Label rows without id or quality are left out;
repeated label rows count once, and a document with both labels once with each. Rows are scored
independently: repeated rows, ties, empty tables and other columns pass through. Very long texts are read whole, a megabyte
at a time (cut between words); a few numbers of each word are what is held.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import GAP, add_fields, blocks, col, hash_share, packed, pieces, ship, table, utf8, word_hashes, word_spans

SAMPLE_ROWS = 20_000
TREES, DEPTH, BINS, RATE, SMOOTH, LEAST = 60, 4, 64, 0.15, 1.0, 10
ACCEPT = 0.3
FIELDS = ["score", "predicted"]

KINDS = ("lower", "upper", "digit", "stop", "comma", "mark", "symbol", "blank", "newline", "wide")
_KIND = np.full(256, KINDS.index("mark"), np.uint8)
_KIND[[*range(97, 123)]] = KINDS.index("lower")
_KIND[[*range(65, 91)]] = KINDS.index("upper")
_KIND[[*range(48, 58)]] = KINDS.index("digit")
_KIND[[*b".?"]] = KINDS.index("stop")
_KIND[[*b",;:"]] = KINDS.index("comma")
_KIND[[*b"#*$%&|<>=_~^@{}[]\\/"]] = KINDS.index("symbol")
_KIND[[32, *range(9, 14)]] = KINDS.index("blank")
_KIND[10] = KINDS.index("newline")
_KIND[128:] = KINDS.index("wide")
STATISTICS = [*(f"share_{k}" for k in KINDS), "log_bytes", "log_words", "word_length", "longest_word", "line_words",
              "distinct_words", "top_word", "repeated_triples", "repeated_lines", "exclamations"]


def row_shares(keys: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per row: its number of different keys, of keys that recur, and the count of its most frequent key."""
    distinct, repeated, top = np.zeros(n), np.zeros(n), np.zeros(n)
    if len(keys):
        order = np.lexsort((keys, rows))
        k, r = keys[order], rows[order]
        first = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (r[1:] != r[:-1])]))
        sizes, row = np.diff(first, append=len(k)), r[first]
        distinct = np.bincount(row, minlength=n).astype(float)
        repeated = np.bincount(row, np.where(sizes > 1, sizes, 0), minlength=n)
        np.maximum.at(top, row, sizes)
    return distinct, repeated, top


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The statistics of each text [texts, statistics]."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    safe = np.maximum(size, 1)
    kinds, bangs, feeds, parts = np.zeros((n, len(KINDS)), np.int64), np.zeros(n, np.int64), 0, []
    for part, offs, which in pieces(data, offsets, GAP):
        row_of = np.repeat(np.arange(len(which)), np.diff(offs))
        kinds[which] += np.bincount(row_of * len(KINDS) + _KIND[part], minlength=kinds[which].size).reshape(-1, len(KINDS))
        bangs[which] += np.bincount(row_of[part == 33], minlength=len(which))
        starts, ends, owner = word_spans(part, offs)
        before = feeds + np.cumsum(part == 10)
        parts.append((which[owner], ends - starts, word_hashes(part, starts, ends), before[starts]))
        feeds = int(before[-1]) if len(before) else feeds
    rows, length, hashes, line_of = (np.concatenate([np.zeros(0, kind), *(p[k] for p in parts)])
                                     for k, kind in enumerate((np.int64, np.int64, np.uint64, np.int64)))
    words = np.bincount(rows, minlength=n)
    some = np.maximum(words, 1)
    longest = np.zeros(n)
    np.maximum.at(longest, rows, length)
    distinct, _, top = row_shares(hashes, rows, n)
    triple = hashes[:-2] * np.uint64(3) + hashes[1:-1] * np.uint64(5) + hashes[2:] * np.uint64(7)
    same = rows[:-2] == rows[2:]
    _, triples, _ = row_shares(triple[same], rows[:-2][same], n)
    head = np.flatnonzero(np.concatenate([[True], (line_of[1:] != line_of[:-1]) | (rows[1:] != rows[:-1])])) if len(rows) else np.zeros(0, np.int64)
    lines = np.add.reduceat(hashes * np.uint64(0x9E3779B1), head) if len(head) else np.zeros(0, np.uint64)
    n_lines = np.bincount(rows[head], minlength=n)
    _, line_repeats, _ = row_shares(lines, rows[head], n)
    return np.column_stack([
        kinds / safe[:, None], np.log1p(size), np.log1p(words), np.bincount(rows, length, minlength=n) / some,
        np.log1p(longest), np.log1p(words / np.maximum(n_lines, 1)), distinct / some, top / some, triples / some,
        line_repeats / np.maximum(n_lines, 1), bangs / some])


@dataclass
class Trees:
    """Complete trees as arrays: node k of a tree sends a row to 2k+1, or to 2k+2 if its statistic is above ``cut``."""
    base: float
    feature: np.ndarray  # [trees, 2**depth - 1]
    cut: np.ndarray
    leaf: np.ndarray     # [trees, 2**depth]

    def score(self, x: np.ndarray) -> np.ndarray:
        total, inner = np.full(len(x), self.base), self.feature.shape[1]
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf):
            node, row = np.zeros(len(x), np.int64), np.arange(len(x))
            while len(node) and node[0] < inner:
                node = 2 * node + 1 + (x[row, feature[node]] > cut[node])
            total += leaf[node - inner]
        return 1 / (1 + np.exp(-total))


def grow(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Trees:
    """Boosted trees for labels 0 and 1."""
    inner, n = 2 ** depth - 1, len(y)
    share = (y.sum() + 1) / (n + 2)
    model = Trees(float(np.log(share / (1 - share))), np.zeros((0, inner), np.int32), np.zeros((0, inner)), np.zeros((0, 2 ** depth)))
    if n == 0 or y.min() == y.max():
        return model
    cuts = [np.unique(np.quantile(c, np.arange(1, BINS) / BINS)) for c in x.T]
    bins = np.column_stack([np.searchsorted(c, v, "left") for c, v in zip(cuts, x.T)])
    slot = bins + np.arange(x.shape[1]) * BINS
    width = x.shape[1] * BINS
    total, kept = np.full(n, model.base), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        slope, bend = y - p, p * (1 - p)
        node = np.zeros(n, np.int64)
        feature, cut = np.zeros(inner, np.int32), np.full(inner, np.inf)
        for level in range(depth):
            first, count = 2 ** level - 1, 2 ** level
            key = ((node - first)[:, None] * width + slot).ravel()
            g, h, c = (np.bincount(key, np.repeat(w, x.shape[1]), count * width).reshape(count, -1, BINS).cumsum(2)
                       for w in (slope, bend, np.ones(n)))
            rest = [a[:, :, -1:] - a for a in (g, h, c)]
            gain = g ** 2 / (h + SMOOTH) + rest[0] ** 2 / (rest[1] + SMOOTH)
            gain = np.where((c >= LEAST) & (rest[2] >= LEAST), gain, -1).reshape(count, -1)
            best = gain.argmax(1)
            whole = g[:, 0, -1] ** 2 / (h[:, 0, -1] + SMOOTH)
            for k, b in enumerate(best.tolist()):
                f, at = divmod(b, BINS)
                if gain[k, b] > whole[k] and at < len(cuts[f]):
                    feature[first + k], cut[first + k] = f, cuts[f][at]
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > cut[node])
        at = node - inner
        leaf = RATE * np.bincount(at, slope, inner + 1) / (np.bincount(at, bend, inner + 1) + SMOOTH)
        total += leaf[at]
        kept.append((feature, cut, leaf))
    return Trees(model.base, *map(np.array, zip(*kept)))


def with_statistics(df: DataFrame, text: str, name: str) -> DataFrame:
    """Add the statistics of a text as array<double>."""
    ship(df)

    @F.arrow_udf("array<double>")
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for arr in texts:
            data, offsets = utf8(arr)
            parts = [statistics(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]) for i, j in blocks(offsets)]
            flat = np.concatenate(parts).ravel() if parts else np.zeros(0)
            yield pa.ListArray.from_arrays(np.arange(len(arr) + 1, dtype=np.int32) * len(STATISTICS), pa.array(flat))

    return df.withColumn(name, run(col(text)))


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, key: str = "doc_id", text: str = "text",
          label: str = "quality") -> Trees:
    """Fit on at most about ``rows`` labelled rows, chosen by a fixed hash of their id."""
    marks = labels.select(col(key).alias("k"), col(label).cast("int").alias("y")).dropna().filter("y in (0, 1)").distinct()
    n = marks.count()
    if n > rows:
        marks = marks.filter(hash_share(F.col("k")) < rows / n)
    # The sample is bounded by ``rows``, and so is this broadcast and what the driver gets.
    known = docs.select(col(key).alias("k"), col(text).alias("t")).join(F.broadcast(marks), "k")
    got = with_statistics(known, "t", "x").select("k", "y", "x").toArrow()
    x = np.array(got["x"].to_pylist(), float).reshape(len(got), len(STATISTICS))
    y, order = got["y"].to_numpy().astype(float), got["k"].to_numpy()
    order = np.lexsort((*x.T, y, order))  # alike however the rows came in
    return grow(x[order], y[order])


def classify(df: DataFrame, model: Trees, text: str = "text", accept: float = ACCEPT) -> DataFrame:
    """Add ``score`` and ``predicted`` for each whole text."""
    ship(df)

    @F.arrow_udf("struct<score: double, predicted: int>")
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for arr in texts:
            data, offsets = utf8(arr)
            parts = [model.score(statistics(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])) for i, j in blocks(offsets)]
            score = np.concatenate(parts) if parts else np.zeros(0)
            yield pa.StructArray.from_arrays([pa.array(score), pa.array((score >= accept).astype(np.int32))], FIELDS)

    return add_fields(df, run(col(text)), FIELDS)


def fold(key: Column, folds: int) -> Column:
    """crc32 of the key's text, modulo the number of folds; a null key's text is empty."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def trained(spark, sf_dir: str, docs: DataFrame) -> Trees:
    """The model of a folder's labels, the rows of fold 0 held out."""
    labels = table(spark, sf_dir, "labels")
    return train(docs, labels.filter(fold(F.col("doc_id"), 5) != 0))


def op9_quality(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = classify(docs, trained(spark, sf_dir, docs))
    return scored.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted")


def stage_quality(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier accepts."""
    scored = classify(packed(docs, "text"), trained(spark, sf_dir, docs))
    return scored.filter("predicted = 1").select("row.*")
