"""Hard negatives, repeated passages and importance resampling against plain versions."""

import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from llm_cases import BASE, LONG, SF001, SF01, edges, empty  # noqa: F401 - fixtures
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.llm import importance, negatives, substring_dedup
from feedloom.llm.common import utf8


def same_as_sql(df, sql, sf):
    con = duckdb.connect()
    for name in ("documents", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    order = sorted(df.columns)
    want = con.execute(f"SELECT {', '.join(order)} FROM ({sql})").fetchall()
    got = [tuple(r) for r in df.select(*order).collect()]
    assert len(got) == len(want) and sorted(map(str, got)) == sorted(map(str, want))


# --------------------------------------------------------------------------- op 11

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                        T.StructField("label", T.IntegerType()), T.StructField("Q", T.StringType())])


def plain_negatives(rows, positives=5, most=5, low=80, high=100, scale=256):
    """rows: (id, vector, label). The whole result, pair by pair."""
    known = {}
    for i, v, lab in rows:
        if i is None or v is None or lab is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        x = tuple(math.floor(scale * float(np.float32(c))) for c in v)
        if sum(c * c for c in x) >= 2 ** 55:
            continue
        key = (lab, b"".join(c.to_bytes(8, "little", signed=True) for c in x))
        if i not in known or key < known[i][0]:
            known[i] = (key, lab, x)
    out = []
    for a, (_, lab, x) in known.items():
        if a % 100:
            continue
        scored = sorted((-sum(p * q for p, q in zip(x, y)), i, other) for i, (_, other, y) in known.items() if i != a)
        for s, i, _ in [r for r in scored if r[2] == lab][:positives]:
            near = [r for r in scored if r[2] != lab and low * -s <= 100 * -r[0] <= high * -s][:most]
            out += [(a, i, k, j, -s, -t) for k, (t, j, _) in enumerate(near, 1)]
    return sorted(out)


def negatives_of(spark, rows):
    df = spark.createDataFrame([(*r, "x") for r in rows], VECTORS).repartition(3)
    got = negatives.hard_negatives(df, F.col("id") % 100 == 0)
    return sorted(tuple(r) for r in got.collect())


def random_rows(n, seed, spread=0.3, size=8):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, size))
    x = centres[rng.integers(0, 12, n)] + spread * rng.normal(size=(n, size))
    return [(int(i) * 10, [float(c) for c in v], int(lab)) for i, v, lab in zip(rng.permutation(n), x, rng.integers(0, 4, n))]


def test_negatives_match_pairs(spark, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK_VALUES", 600)  # many blocks, deep trees
    monkeypatch.setattr(negatives, "LEAF", 4)
    rows = random_rows(500, 1)
    hot = [(7_000 + k, rows[0][1], rows[0][2]) for k in range(200)]  # one vector on a third of all rows
    other = [(9_000 + k, rows[0][1], rows[0][2] + 1) for k in range(30)]
    rows += hot + other
    assert negatives_of(spark, rows) == plain_negatives(rows)


def test_negatives_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5], 1), (100, [1.0, 0.5], 1), (100, [1.0, 0.5], 1), (100, [0.5, 0.5], 0), (200, [-1.0, -0.5], 1), (300, [0.0, 0.0], 2),
            (-100, [0.9], 1), (1, [1.0, 0.4, 0.3], 1), (2, [1.0, 0.3], 2), (3, [0.9, 0.5], 3), (4, [], 2), (5, [1.0, None], 1), (6, [nan, 1.0], 2),
            (7, [inf, 1.0], 2), (None, [1.0, 1.0], 1), (8, None, 1), (9, [1.0, 1.0], None), (10, [3e38, 0.0], 1), (11, [-0.2, 0.1], 1), (12, [-0.3, 0.1], 2)]
    assert negatives_of(spark, rows) == plain_negatives(rows)
    assert negatives_of(spark, []) == []
    assert negatives_of(spark, [(0, [], 1), (100, [], 2), (200, [], 1)]) == plain_negatives([(0, [], 1), (100, [], 2), (200, [], 1)])


def test_negative_scores_window(spark):
    """Negative positive scores have no window; zero has one score."""
    rows = [(0, [1.0], 1), (1, [0.0], 1), (2, [-1.0], 1), (3, [0.0], 2), (4, [-1.0], 2), (5, [0.001], 2)]
    assert negatives_of(spark, rows) == plain_negatives(rows) == [(0, 1, 1, 3, 0, 0), (0, 1, 2, 5, 0, 0)]


def test_tree_bounds_hold():
    rng = np.random.default_rng(3)
    x = rng.integers(-200, 200, (700, 6))
    x[300:400] = x[0]
    t = negatives.Tree(negatives.plant(np.arange(700), np.zeros(700, np.int64), x))
    assert sorted(t.ids.tolist()) == list(range(700)) and (x[t.ids] == t.x).all()
    q = rng.integers(-200, 200, 6).astype(float)
    size = float(np.linalg.norm(q)) * t.length

    def rows_of(node):
        a, b = t.begin[node], t.end[node]
        return list(range(a, b)) if node >= t.leaves else [r for j in range(a, b) for r in rows_of(j)]

    assert sorted(rows_of(0)) == list(range(700))
    for node in range(len(t.centres)):
        angle = np.arccos(np.clip(t.centres[node] @ q / size, -1, 1))
        scores = t.x[rows_of(node)] @ q
        assert scores.max() <= size * np.cos(max(angle - t.wide[node], 0)) + 0.5
        assert scores.min() >= size * np.cos(min(angle + t.wide[node], np.pi)) - 0.5


@pytest.mark.parametrize("sf", [SF001, SF01])
def test_negatives_query(spark, sf):
    same_as_sql(negatives.op11_hard_negatives(spark, sf), negatives.ORACLE, sf)


# --------------------------------------------------------------------------- op 12

def words(t):
    return re.findall("[^\x20\x09-\x0D]+", t or "")


def plain_cut(texts, window):
    docs = [words(t) for t in texts]
    seen = Counter(tuple(w[i:i + window]) for w in docs for i in range(len(w) - window + 1))
    out = []
    for w in docs:
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def cut_of(spark, texts, window=35):
    df = spark.createDataFrame([(k, t, "keep") for k, t in enumerate(texts)], "k int, text string, N_Words string").repartition(4)
    got = sorted(substring_dedup.drop_repeated(df, window=window).collect())
    assert [r.text for r in got] == list(texts)
    return [(r.n_words, r.n_removed, r.kept_text) for r in got]


@pytest.mark.parametrize("window", [4, 5, 7, 12, 35])
def test_cut_matches_plain(spark, window):
    rng = np.random.default_rng(window)
    few = [" ".join(rng.choice(list("abc"), int(n))) for n in rng.integers(0, 40, 60)]  # repeats everywhere, within texts as well
    many = [" ".join(f"w{x}" for x in rng.integers(0, 10 ** 6, int(n))) for n in rng.integers(0, 120, 40)]
    passages = [" ".join(f"p{x}" for x in rng.integers(0, 10 ** 6, window + k)) for k in (-1, 0, 1, 9, window, 3 * window)]
    mixed = [f"{many[k]}\t{passages[k % 6]} \n{many[-k]}" for k in range(30)]
    texts = few + many + mixed + [passages[1] + " é漢\x85x " + passages[1], "a " * 200, "", "  \n ", many[0], many[0]]
    assert cut_of(spark, texts, window) == plain_cut(texts, window)


def test_cut_long_texts(spark, monkeypatch):
    """Windows across the pieces of a long text."""
    monkeypatch.setattr(substring_dedup, "pieces", lambda d, o, g: __import__("feedloom.llm.common", fromlist=["pieces"]).pieces(d, o, g, 700))
    rng = np.random.default_rng(5)
    text = [f"w{x}" for x in rng.integers(0, 10 ** 6, 3000)]
    texts = [" ".join(text), " ".join(text[900:1100] + ["z"] + text[40:100]), " ".join(text[2000:2034])]
    data, offsets = utf8(pa.array(texts))
    got = [np.zeros(0, np.int64) for _ in texts]
    for row, place, hashes in substring_dedup.texts_words(data, offsets, 34):
        at = np.flatnonzero(substring_dedup.whole(row, 35))
        for r in range(len(texts)):
            got[r] = np.concatenate([got[r], place[at][row[at] == r]])
    assert [g.tolist() for g in got] == [list(range(max(len(t.split()) - 34, 0))) for t in texts]
    assert cut_of(spark, texts) == plain_cut(texts, 35)
    assert cut_of(spark, [LONG, LONG + " more", BASE, None]) == plain_cut([LONG, LONG + " more", BASE], 35) + [(0, 0, None)]


def test_cut_empty_and_small_batches(spark):
    assert cut_of(spark, []) == []
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")  # equals in batches of their own
    try:
        texts = [BASE, "start " + BASE, BASE.replace("word40 ", "other ") + " tail", BASE + " end"]
        assert cut_of(spark, texts) == plain_cut(texts, 35)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")


def test_cut_hot_passage(spark):
    """A passage in two thirds of all texts sends one row a batch, not one a text."""
    passage = " ".join(f"p{k}" for k in range(40))
    h = np.repeat(np.arange(5, dtype=np.uint64), 1000)
    h, text, place = substring_dedup.asked(h + np.uint64(7), np.arange(5000), np.arange(5000))
    assert sorted(h[h != 0].tolist()) == list(range(7, 12)) and (text[h != 0] == -1).all() and (h == 0).sum() == 5000
    texts = [f"{passage} only{k} here" if k % 3 else f"none{k} " * 40 for k in range(90)]
    assert cut_of(spark, texts) == plain_cut(texts, 35)


@pytest.mark.parametrize("sf", [SF001])
def test_cut_query(spark, sf):
    same_as_sql(substring_dedup.op12_substring_dedup(spark, sf), substring_dedup.ORACLE, sf)


# --------------------------------------------------------------------------- op 13

def plain_words(t):
    low = bytes(c + 32 if 65 <= c <= 90 else c for c in (t or "").encode())
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def plain_runs(t, n):
    w = plain_words(t)
    return [zlib.crc32(b" ".join(w[i:i + k])) for k in range(1, n + 1) for i in range(len(w) - k + 1)]


TEXTS = [None, "", "Hello wORLD it's 12 x", "é漢 A-b \x00 zz", "one", " ".join(["ab", "Cde", "é" * 90, "y" * 5000, "q"] * 200), "-- !!", "a b c d e f"]


@pytest.mark.parametrize("n", [1, 2, 5])
@pytest.mark.parametrize("limit", [1 << 20, 64])
def test_crcs_of_runs(n, limit, monkeypatch):
    from feedloom.llm.common import pieces
    monkeypatch.setattr(importance, "pieces", lambda d, o, g: pieces(d, o, g, limit))
    data, offsets = utf8(pa.array(TEXTS))
    row, crc, count = importance.ngram_crcs(data, offsets, n)
    assert count.tolist() == [len(plain_words(t)) for t in TEXTS]
    for k, t in enumerate(TEXTS):
        assert sorted(crc[row == k].tolist()) == sorted(plain_runs(t, n))


def test_shift_is_zero_bytes():
    sizes = np.array([0, 1, 63, 64, 65, 4095, 4096, 300_000])
    a, b = b"some text", b"another"
    for size in sizes.tolist():
        tail = b * (size // len(b)) + b[:size % len(b)]
        assert int(importance.shift(np.array([zlib.crc32(a)], np.uint32), np.array([size]))[0]) ^ zlib.crc32(a + tail) == zlib.crc32(tail)


def plain_weigh(rows, target, n, buckets, least, percent, seed):
    def count(texts):
        return Counter(c % buckets for t in texts for c in plain_runs(t, n))

    s, t = count(r[1] for r in rows), count(target)
    sn, tn = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (sn + buckets) / ((s[b] + 1) * (tn + buckets)))) for b in range(buckets)}
    out = []
    for k, x in rows:
        got = [gain[c % buckets] for c in plain_runs(x, n)]
        weight = sum(got) // len(got) if got else 0
        h = int(hashlib.sha256(f"{seed}:{'' if k is None else k}".encode()).hexdigest()[:8], 16)
        out.append((k, len(got), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32))), len(plain_words(x)) >= least))
    order = sorted((r for r in out if r[4]), key=lambda r: (-r[3], -1 if r[0] is None else r[0]))
    drawn = Counter()
    for place, r in enumerate(order[:len(order) * percent // 100], 1):
        drawn[r[:4], place] += 1
    return sorted(map(str, (r[:4] for r in out))), drawn


@pytest.mark.parametrize("n, buckets, percent", [(1, 10_000, 50), (3, 70_000, 25), (1, 7, 100)])
def test_weights_and_draw(spark, edges, n, buckets, percent):
    target = [(BASE,), ("no id here and the word7",), (None,)]
    rows = [(r.doc_id, r.text) for r in edges.collect()]
    wide = edges.withColumn("Rank", F.lit(9)).withColumn("_part", F.lit("p")).withColumn("a.b", F.lit(1))
    got = importance.weigh(wide, spark.createDataFrame(target, "text string"), n=n, buckets=buckets, least_words=2, percent=percent)
    assert got.columns == ["doc_id", "lang", "source", "n_chars", "_part", "a.b", "n_features", "weight", "score", "rank"]
    got = [(r.doc_id, r.n_features, r.weight, r.score, r.rank) for r in got.collect()]
    every, drawn = plain_weigh(rows, [t for t, in target], n, buckets, 2, percent, "2024")
    assert sorted(str(r[:4]) for r in got) == every
    assert Counter((r[:4], r[4]) for r in got if r[4]) == drawn


def test_weights_empty(spark, empty, edges):
    none = spark.createDataFrame([], "text string")
    assert importance.weigh(empty, none).collect() == []
    assert {r.weight for r in importance.weigh(edges, none, least_words=0).filter("n_features = 0").collect()} == {0}


def test_resample_whole_rows(spark, edges):
    target = spark.createDataFrame([(BASE,)], "text string")
    got = importance.resample(edges.filter("doc_id IN (1, 3, 7, 8)"), target, percent=50)
    assert got.columns == edges.columns and got.count() == 2


@pytest.mark.parametrize("sf", [SF001, SF01])
def test_importance_query(spark, sf):
    same_as_sql(importance.op13_importance(spark, sf), importance.ORACLE, sf)
