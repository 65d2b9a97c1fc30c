"""Op 11: hard negatives by exact inner products, found in cover trees over norm-augmented vectors.

A vector x is made integer (floor of ``scale`` * x) and, for the trees, given one more component so that all vectors
have one length M; a query gets 0 there, so inner products stay as they are and depend on the angle alone. The rows are
dealt to blocks of bounded size: to the nearest of a few pivots (found on a bounded sample), a large pivot's rows then
by hash. Each block becomes a cover tree: a farthest-first order of its rows, whose prefixes are nested nets, is cut into
levels; a node is the parent of the next level's centres nearest to it and knows its covering radius (as an angle w). All
rows below a node with centre c have an inner product between |q| M cos(angle(q, c) + w) and |q| M cos(angle(q, c) - w).

1. Rows with the same label and vector have the same scores and come in the order of their ids, so no search can want
   more than the first ``positives`` + 1 of them: only those are indexed. Anchors with one label and vector are one query.
2. Queries, packed in chunks, go to every block (a stated set against all rows). A best-first descent takes the node with
   the highest bound, passes over nodes outside all windows, and ends when no bound beats what is found; rows of leaves
   are scored exactly. The first search finds each query's positives, the second the negatives in the window of each.
3. The best of all blocks are merged by limited ranks (partial limits before the shuffle), and anchors take their
   query's answer without themselves.

Bounded on the driver: pivots (at most ``PIVOTS``) from a sample of ``SAMPLE_ROWS`` rows. A task holds one block's tree
and one chunk. Hot vectors shrink to a few rows, a hot pivot is split by hash, a hot query's anchors meet its few answers in
a join that Spark splits at run time.

Rows with a null id, label or vector, with a null or non-finite component, or whose integer vector's squared length
reaches 2^55 (percentages of scores could leave a long) take no part. Rows are named by their id: of several with one id the one with the
smallest label, then vector, counts. Vectors of unequal length are compared as if filled up with zeros. Ties go to the
smaller id. An anchor without rows in a window gives none; empty tables give an empty result. Other columns are not used.
"""

from __future__ import annotations

import heapq
import io
import math
from bisect import insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.common import col, ship, stored, table

SCALE, POSITIVES, NEGATIVES, LOW, HIGH = 256, 5, 5, 80, 100
SAMPLE_ROWS, PIVOTS, BLOCK_VALUES, CHUNK = 2048, 256, 1 << 17, 256
LEAF, FAN = 64, 8
MOST = 2.0 ** 55  # scores below it leave room for percentages in a long


def quantised(vectors: Column, scale: int) -> Column:
    """struct<vec binary, norm double>: the integer vector (8 bytes a component, little end first) and its length; null where unusable."""
    @F.arrow_udf("struct<vec: binary, norm: double>")
    def run(lists: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for arr in lists:
            sizes = arr.value_lengths().fill_null(0).to_numpy()
            at = np.concatenate([[0], np.cumsum(sizes)])
            x = arr.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
            with np.errstate(over="ignore", invalid="ignore"):
                x = np.floor(scale * x)
                square = np.array([float(np.dot(x[a:b], x[a:b])) for a, b in zip(at, at[1:])])
            known = arr.is_valid().to_numpy(zero_copy_only=False) & (square < MOST)  # not so for NaN and infinity
            cells = [x[a:b].astype("<i8").tobytes() if ok else None for a, b, ok in zip(at, at[1:], known.tolist())]
            yield pa.StructArray.from_arrays([pa.array(cells, pa.binary()), pa.array(np.sqrt(square), mask=~known)], ["vec", "norm"])

    return run(vectors)


def matrix(cells: list[bytes], width: int = 0) -> np.ndarray:
    """Integer vectors as rows, filled up with zeros to the longest (``width`` at least)."""
    sizes = np.array([len(c) // 8 for c in cells], np.int64)
    width = max(int(sizes.max(initial=0)), width)
    flat = np.frombuffer(b"".join(cells), "<i8")
    if (sizes == width).all():
        return flat.reshape(len(cells), width).astype(np.int64)
    out = np.zeros((len(cells), width), np.int64)
    out[np.arange(width)[None, :] < sizes[:, None]] = flat
    return out


def augmented(x: np.ndarray, length: float) -> np.ndarray:
    """Rows with one more component that brings them to ``length``, scaled to 1."""
    x = x.astype(np.float64)
    if not length:  # zero vectors alone
        return np.column_stack([x, np.ones(len(x))])
    rest = np.sqrt(np.maximum(length ** 2 - np.einsum("ij,ij->i", x, x), 0))
    return np.column_stack([x, rest]) / length


def farthest_first(a: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``count`` rows of a farthest-first order of unit vectors (fewer if all rows lie on them), and each row's nearest."""
    order, best, owner = [0], a @ a[0], np.zeros(len(a), np.int64)
    while len(order) < count:
        far = int(best.argmin())
        if best[far] >= 1 - 1e-12:
            break
        near = a @ a[far]
        closer = near > best
        owner[closer], best[closer] = len(order), near[closer]
        order.append(far)
    return np.array(order, np.int64), owner


def pack(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def unpack(data: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(data), allow_pickle=False) as z:
        return {k: z[k] for k in z.files}


def plant(ids: np.ndarray, labels: np.ndarray, x: np.ndarray) -> bytes:
    """A cover tree of some rows. Nodes come level by level, the children of one side by side; leaves hold row ranges."""
    xf = x.astype(np.float64)
    length = float(np.sqrt(np.einsum("ij,ij->i", xf, xf).max(initial=0)))
    a = augmented(x, length)
    order, owner = farthest_first(a, math.ceil(len(x) / LEAF))
    sizes = [1]
    while sizes[-1] < len(order):
        sizes.append(min(sizes[-1] * FAN, len(order)))
    above = [owner]  # from the leaves up: each row's centre on the level
    for upper, lower in zip(sizes[-2::-1], sizes[:0:-1]):
        up = (a[order[:lower]] @ a[order[:upper]].T).argmax(1)
        up[:upper] = np.arange(upper)
        above.append(up[above[-1]])
    above = above[::-1]
    rows = np.lexsort((ids, *above[::-1]))
    centre, wide, begin, end, first, base = [], [], [], [], [], 0
    for k, at in enumerate(above):
        at = at[rows]
        start = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        node = order[at[start]]
        cosine = np.einsum("ij,ij->i", a[rows], a[np.repeat(node, np.diff(start, append=len(rows)))])
        angle = np.arccos(np.clip(np.minimum.reduceat(cosine, start), -1, 1))
        centre.append(node)
        wide.append(angle)
        begin.append(start)
        end.append(np.append(start[1:], len(rows)))
        first.append(base)
        base += len(node)
    # Inner nodes: row ranges become ranges of the next level's nodes.
    for k in range(len(above) - 1):
        stops = np.append(begin[k + 1], len(rows))
        begin[k], end[k] = (first[k + 1] + np.searchsorted(stops, v) for v in (begin[k], end[k]))
    return pack(ids=ids[rows], labels=labels[rows], x=x[rows], centres=x[np.concatenate(centre)], wide=np.concatenate(wide),
                begin=np.concatenate(begin), end=np.concatenate(end), leaves=np.array(first[-1]), length=np.array(length))


class Tree:
    def __init__(self, data: bytes):
        t = unpack(data)
        self.ids, self.labels, self.x, self.centres = t["ids"], t["labels"], t["x"], t["centres"]
        self.wide, self.begin, self.end = t["wide"], t["begin"].tolist(), t["end"].tolist()
        self.leaves, self.length = int(t["leaves"]), float(t["length"])

    def search(self, queries: np.ndarray, labels: np.ndarray, same: bool, windows: list[list[tuple]], most: int) -> Iterator[tuple]:
        """(query, window, row id, score) of the ``most`` best rows in each window (low, high) of each query, by score then
        id, among rows of its label or of others."""
        width = max(queries.shape[1], self.x.shape[1])
        queries, x, centres = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (queries, self.x, self.centres))
        sizes = np.sqrt(np.einsum("ij,ij->i", *[queries.astype(np.float64)] * 2)) * self.length
        if sizes.max(initial=0) < 2.0 ** 52:  # then doubles hold every sum exactly
            queries, x = queries.astype(np.float64), x.astype(np.float64)
        around = centres.astype(np.float64).T
        for k, q in enumerate(queries):
            size, slack = sizes[k], 1e-6 * sizes[k] + 0.5
            angle = np.arccos(np.clip(q.astype(np.float64) @ around / (size or 1.0), -1, 1))
            upper = size * np.cos(np.maximum(angle - self.wide, 0)) + slack
            lower = size * np.cos(np.minimum(angle + self.wide, np.pi)) - slack
            mine = [list(w) for w in windows[k] if w[0] <= w[1]]
            if not mine:
                continue
            found: list[list[tuple]] = [[] for _ in mine]
            need, high = min(w[0] for w in mine), max(w[1] for w in mine)
            heap = [(-upper[0], 0)]
            while heap:
                bound, node = heapq.heappop(heap)
                if -bound < need:
                    break
                a, b = self.begin[node], self.end[node]
                if node < self.leaves:
                    for j in range(a, b):
                        if upper[j] >= need and lower[j] <= high:
                            heapq.heappush(heap, (-upper[j], j))
                    continue
                score = x[a:b] @ q
                hit = np.flatnonzero((score >= need) & (score <= high) & ((self.labels[a:b] == labels[k]) == same))
                for j in hit.tolist():
                    s, row = int(score[j]), int(self.ids[a + j])
                    for w, best in zip(mine, found):
                        if w[0] <= s <= w[1] and (len(best) < most or (-s, row) < best[-1]):
                            insort(best, (-s, row))
                            del best[most:]
                if len(hit):  # a full window wants nothing below its last row any more
                    need = min(max(w[0], -best[-1][0]) if len(best) == most else w[0] for w, best in zip(mine, found))
            for w, best in zip(mine, found):
                for s, row in best:
                    yield k, w[1], row, -s


def trees(rows: DataFrame) -> DataFrame:
    """Rows (block, data): a tree for each block of (block, id, label, vec)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def out():
            ids, labels, cells = zip(*(r[1:] for r in held))
            data = plant(np.array(ids, np.int64), np.array(labels, np.int64), matrix(list(cells)))
            return pa.RecordBatch.from_arrays([pa.array([held[0][0]], pa.int32()), pa.array([data], pa.large_binary()).cast(pa.binary())], ["block", "data"])

        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if held and held[-1][0] != row[0]:
                    yield out()
                    held.clear()
                held.append(row)
        if held:
            yield out()

    dealt = rows.select("block", "id", "label", "vec").repartition("block").sortWithinPartitions("block", "id")
    return dealt.mapInArrow(run, "block int, data binary")


def chunks(queries: DataFrame) -> DataFrame:
    """Rows (data): up to ``CHUNK`` queries (q, label, vec, lows, highs) packed together."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                part = batch.slice(at, CHUNK).to_pydict()
                lows, highs = part["lows"], part["highs"]
                data = pack(q=np.frombuffer(b"".join(part["q"]), np.uint8).reshape(-1, 16), label=np.array(part["label"], np.int64), x=matrix(part["vec"]),
                            count=np.array([len(w) for w in lows], np.int64), low=np.array(sum(lows, []), np.int64), high=np.array(sum(highs, []), np.int64))
                yield pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["data"])

    return queries.select("q", "label", "vec", "lows", "highs").mapInArrow(run, "data binary")


def search(forest: DataFrame, queries: DataFrame, blocks: int, same: bool, most: int) -> DataFrame:
    """Rows (q, high, id, score): of each block the best rows in each window of each query."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = None
        for batch in batches:
            for kind, data in zip(batch.column("kind").to_pylist(), batch.column("data")):
                if kind == 0:
                    tree = Tree(data.as_py())
                    continue
                c = unpack(data.as_py())
                ends = np.cumsum(c["count"])
                windows = [list(zip(c["low"][e - n:e].tolist(), c["high"][e - n:e].tolist())) for e, n in zip(ends, c["count"])]
                got = list(tree.search(c["x"], c["label"], same, windows, most))
                if got:
                    k, high, row, score = zip(*got)
                    yield pa.RecordBatch.from_arrays([pa.array([c["q"][i].tobytes() for i in k], pa.binary()), *[pa.array(v, pa.int64()) for v in (high, row, score)]],
                                                     ["q", "high", "id", "score"])

    asked = chunks(queries).select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(1).alias("kind"), "data")
    both = forest.select("block", F.lit(0).alias("kind"), "data").unionByName(asked)
    dealt = both.repartition("block").sortWithinPartitions("block", "kind")  # a block's tree, then the chunks
    return dealt.mapInArrow(run, "q binary, high long, id long, score long")


def first(rows: DataFrame, by: list[str], most: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), "id"))
    return rows.withColumn("place", place).filter(F.col("place") <= most)


def hard_negatives(df: DataFrame, anchors: Column, key: str = "vec_id", vector: str = "embedding", label: str = "label",
                   positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, scale: int = SCALE) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each row that ``anchors`` (of the
    key, as column ``id``) selects and each of its best ``positives`` rows of the same label, the best ``negatives`` rows of other labels
    whose score is between ``low`` and ``high`` percent of the positive's."""
    spark = df.sparkSession
    ship(df)
    made = df.select(col(key).cast("long").alias("id"), col(label).cast("long").alias("label"), quantised(col(vector), scale).alias("v"))
    made = made.filter("id IS NOT NULL AND label IS NOT NULL AND v.vec IS NOT NULL")
    one = made.groupBy("id").agg(F.min(F.struct("label", "v.vec", "v.norm")).alias("r"))
    rows = stored(one.select("id", "r.label", "r.vec", "r.norm", F.unhex(F.md5(F.concat(F.col("r.label").cast("string").cast("binary"), F.lit(b":"), "r.vec"))).alias("q")), "vectors")
    total = rows.agg(F.count("*").alias("n"), F.max("norm").alias("length"), F.max(F.length("vec")).alias("bytes")).first()
    if not total.n:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    block_rows = max(BLOCK_VALUES // max(total.bytes // 8, 1), LEAF)
    length, width = float(total.length), total.bytes // 8
    sample = [r.vec for r in rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS).collect()]
    points = augmented(matrix(sample, width), length)
    points = points[farthest_first(points, min(PIVOTS, math.ceil(total.n / block_rows)))[0]]

    @F.arrow_udf("int")
    def nearest(cells: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for arr in cells:
            yield pa.array((augmented(matrix(arr.to_pylist(), width), length) @ points.T).argmax(1).astype(np.int32))

    copy = F.row_number().over(Window.partitionBy("label", "vec").orderBy("id"))
    known = rows.withColumn("copy", copy).filter(F.col("copy") <= max(positives + 1, negatives)).select("id", "label", "vec")
    known = stored(known.withColumn("pivot", nearest(F.col("vec"))), "candidates")
    held = {r.pivot: r.n for r in known.groupBy("pivot").agg(F.count("*").alias("n")).collect()}  # a row for each pivot
    parts = [math.ceil(held.get(p, 0) / block_rows) for p in range(len(points))]
    base, blocks = np.cumsum([0, *parts]).tolist(), sum(parts)
    pick = lambda values: F.element_at(F.array(*[F.lit(int(v)) for v in values]), F.col("pivot") + 1)
    block = (pick(base[:-1]) + F.pmod(F.xxhash64("vec"), pick(parts))).cast("int")
    forest = stored(trees(known.withColumn("block", block)), "trees")

    anchor = rows.filter(anchors).select(F.col("id").alias("anchor_id"), "label", "vec", "q")
    queries = stored(anchor.groupBy("q").agg(F.first(F.struct("label", "vec")).alias("r")).select("q", "r.*"), "queries")
    all_scores = {"lows": F.array(F.lit(-(1 << 62))), "highs": F.array(F.lit(1 << 62))}
    best = first(search(forest, queries.withColumns(all_scores), blocks, True, positives + 1), ["q"], positives + 1)
    best = stored(best.select("q", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"), "place"), "positives")
    floor = "({0} * positive_score - pmod({0} * positive_score, 100L)) div 100"  # of a percentage, whatever its sign
    best = best.withColumns({"low": -F.expr(floor.format(-low)), "high": F.expr(floor.format(high))})
    windows = best.select("q", "low", "high").distinct().groupBy("q").agg(F.array_sort(F.collect_list(F.struct("low", "high"))).alias("w"))
    asked = queries.join(windows, "q").withColumns({"lows": F.col("w.low"), "highs": F.col("w.high")})
    other = search(forest, asked, blocks, False, negatives)
    other = first(other, ["q", "high"], negatives).select("q", "high", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"), F.col("place").alias("rank"))
    answer = stored(best.join(other, ["q", "high"]), "answers")
    # The anchor is no positive of its own: places move up behind it.
    own = best.select("q", F.col("positive_id").alias("anchor_id"), F.col("place").alias("own"))
    mine = anchor.select("anchor_id", "q").join(own, ["q", "anchor_id"], "left")
    met = mine.join(answer, "q").filter("positive_id != anchor_id")
    met = met.filter(F.col("place") - F.when(F.col("place") > F.col("own"), 1).otherwise(0) <= positives)
    return met.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def op11_hard_negatives(spark, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.select("vec_id", "embedding", label.alias("label")), F.col("id") % 100 == 0)


ORACLE = f"""
    WITH e AS (SELECT vec_id, (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END)::BIGINT AS label,
                      list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v
               FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
               AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    p AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
          FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
    pos AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM p WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= {POSITIVES})
    SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)::INTEGER AS rank,
           id AS negative_id, positive_score, score AS negative_score
    FROM pos JOIN p USING (anchor_id) WHERE NOT same AND {LOW} * positive_score <= 100 * score AND 100 * score <= {HIGH} * positive_score
    QUALIFY rank <= {NEGATIVES}"""
