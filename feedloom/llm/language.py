"""Op 7: language identification by prediction with partial matching (PPM).

Each language has a frozen model of its own: a tree of contexts of up to four bytes with the counts of the bytes after
them. A text's code length under a language is exact: for each byte, the longest context of the language's tree
gives the byte's share, or else pays the escape share (escape method C: different successors over
successors plus different successors) and asks the context without its first byte, down to the uniform
share of 256 bytes. Code lengths are kept in whole 1/65536 bits, so sums do not depend on their order. The
language with the shortest code wins (ties: the smaller name); the score is its share of probability.

Scoring is an automaton over each tree: the context of each length follows from the context one shorter at
the byte before, so a whole block advances by table lookups. Training counts five-byte windows in tasks, of
a bounded sample per language (``docs_per_language``, by a fixed hash of the id), and builds each language's tree in a task
of its own. A tree keeps the contexts seen ``LEAST_SEEN`` times or more, of these the ``max_contexts`` most frequent: the size of
a language's model, the same for each language and untouched by the others, so that the models together grow with the
number of languages alone (2 to 3 MB for each). Everything else covers all documents.

Null texts and texts without a letter are ``und`` with score 0, as are all texts if there is nothing to learn
from. Very long texts are scored whole, a quarter of a megabyte at a time behind the four bytes before it. Rows are independent:
repeated rows, empty tables and other columns pass through unchanged.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import add_fields, blocks, col, free_name, hash_share, others, ship, table, utf8
from feedloom.llm.quality import fold

ORDER = 4
DOCS_PER_LANGUAGE, MAX_CONTEXTS, LEAST_SEEN = 300, 5_000, 3  # of each language
UNIT = 1 << 16
BLOCK = 1 << 18  # bytes scored at a time
FIELDS = ["lang_pred", "score"]
UNKNOWN = "und"


def spaced(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes with ORDER zeros before each text, and where each byte went."""
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    at = np.arange(len(data)) + (rows + 1) * ORDER
    out = np.zeros(len(data) + (len(offsets)) * ORDER, np.uint8)
    out[at] = data
    return out, at


def window_counts(texts: DataFrame) -> DataFrame:
    """Rows (lang, gram, n): how often each window of ORDER + 1 bytes (packed, zeros before a text) occurs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            data, offsets = utf8(batch.column("text"))
            for lang in sorted(set(langs)):
                for i, j in blocks(offsets):
                    pick = [k for k in range(i, j) if langs[k] == lang]
                    for k in pick:
                        body, at = spaced(data[offsets[k]:offsets[k + 1]], offsets[k:k + 2] - offsets[k])
                        gram = np.zeros(len(at), np.int64)
                        for b in range(ORDER, -1, -1):
                            gram = gram << 8 | body[at - b]
                        found, n = np.unique(gram, return_counts=True)
                        yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(found), pa.string()), "gram": found, "n": n.astype(np.int64)})

    counts = texts.mapInArrow(run, "lang string, gram long, n long")
    return counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


@dataclass
class Tree:
    """One language's contexts as tables. Symbol 0 is the byte 0, the last one every byte that training has not seen."""
    symbol: np.ndarray        # of each byte
    follow: list[np.ndarray]  # follow[k][context of k bytes * symbols + symbol]: context of k + 1 bytes; 0: pruned
    first: list[int]          # state number of the first context of each length
    price: np.ndarray         # [state * symbols + symbol], in 1/UNIT bits

    def costs(self, body: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The price of the byte at each place ``at`` of the spaced bytes."""
        sym, width = self.symbol[body], int(self.symbol.max()) + 1
        context = np.zeros(len(sym), np.int32)  # of length k, before each position
        state = np.zeros(len(sym), np.int32)
        for k, follow in enumerate(self.follow):
            longer = np.zeros_like(context)
            longer[1:] = follow[context[:-1] * width + sym[:-1]]
            context = longer
            np.copyto(state, context + np.int32(self.first[k + 1]), where=context > 0)
        return self.price[state[at] * width + sym[at]]


@dataclass
class Languages:
    """The trees of all languages, by name."""
    langs: list[str]
    trees: list[Tree]

    def lengths(self, data: np.ndarray, offsets: np.ndarray, block: int = BLOCK) -> np.ndarray:
        """Code lengths [texts, languages] in 1/UNIT bits."""
        out = np.zeros((len(offsets) - 1, len(self.langs)), np.int64)
        if len(out) == 1:  # perhaps a long one
            body = np.concatenate([np.zeros(ORDER, np.uint8), data])
            for lo in range(0, len(data), block):
                part = body[lo:lo + block + ORDER]
                out[0] += [tree.costs(part, np.arange(ORDER, len(part))).sum(dtype=np.int64) for tree in self.trees]
            return out
        filled = np.flatnonzero(np.diff(offsets) > 0)
        if len(filled):
            body, at = spaced(data, offsets)
            for k, tree in enumerate(self.trees):
                out[filled, k] = np.add.reduceat(tree.costs(body, at), offsets[filled], dtype=np.int64)
        return out

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The index of the best language and its share of probability."""
        bits = self.lengths(data, offsets) / UNIT
        best = bits.argmin(axis=1)
        odds = np.exp2(-np.minimum(bits - bits.min(axis=1, keepdims=True), 1000.0))
        return best, 1 / odds.sum(axis=1)


def build(gram: np.ndarray, n: np.ndarray, max_contexts: int = MAX_CONTEXTS) -> Tree:
    """A language's tree from its window counts."""
    seen = np.unique(np.concatenate([gram & 255, [0]]))
    symbol = np.full(256, len(seen), np.int32)
    symbol[seen] = np.arange(len(seen))
    width = len(seen) + 1
    sym = symbol[gram & 255].astype(np.int64)
    # Contexts of each length by frequency; a context's suffixes are at least as frequent, so pruning keeps a tree.
    tables = [np.unique(gram >> 8 & ((1 << 8 * k) - 1), return_inverse=True) for k in range(1, ORDER + 1)]
    sums = [np.bincount(inverse, n) for _, inverse in tables]
    every = np.sort(np.concatenate(sums))[::-1]
    least = max(LEAST_SEEN, every[max_contexts] + 1 if len(every) > max_contexts else 0)
    kept = [np.flatnonzero(s >= least) for s in sums]
    # States: 0 is the empty context, those of length k are first[k] + 1, ...
    first = [0, 0]
    for k in range(1, ORDER):
        first.append(first[-1] + len(kept[k - 1]))
    prices, follow, names = [], [], [np.zeros(1, np.int64)]  # names: the kept contexts of each length, sorted
    shorter = np.full((1, width), 8 * UNIT, np.int64)  # below the empty context: 256 equal shares
    for k in range(ORDER + 1):
        if k == 0:
            row, rows, base = np.zeros(len(gram), np.int64), 1, shorter
        else:
            values, inverse = tables[k - 1]
            place = np.full(len(values), -1)
            place[kept[k - 1]] = np.arange(len(kept[k - 1]))
            row, rows, values = place[inverse], len(kept[k - 1]), values[kept[k - 1]]
            base = shorter[np.searchsorted(names[k - 1], values & ((1 << 8 * (k - 1)) - 1)) if k > 1 else np.zeros(rows, np.int64)]
        ok = row >= 0
        count = np.bincount(row[ok] * width + sym[ok], n[ok], rows * width).reshape(rows, width)
        total, kinds = count.sum(axis=1, keepdims=True), (count > 0).sum(axis=1, keepdims=True)
        whole = np.maximum(total + kinds, 1)
        hit = np.rint(-np.log2(np.maximum(count, 1) / whole) * UNIT).astype(np.int64)
        escape = np.where(kinds > 0, np.rint(-np.log2(np.maximum(kinds, 1) / whole) * UNIT), 0).astype(np.int64)
        shorter = np.where(count > 0, hit, escape + base)
        prices.append(shorter.reshape(-1))
        if k:  # from the context one shorter (at the byte before) and that byte
            before = np.searchsorted(names[k - 1], values >> 8) if k > 1 else np.zeros(rows, np.int64)
            there = np.ones(rows, bool)
            if k > 1:
                there = names[k - 1][np.minimum(before, len(names[k - 1]) - 1)] == values >> 8 if len(names[k - 1]) else ~there
            step = np.zeros((len(names[k - 1]) + 1 if k > 1 else 1) * width, np.int32)
            step[((before + (k > 1)) * width + symbol[values & 255])[there]] = np.arange(1, rows + 1)[there]
            follow.append(step)
            names.append(values)
    return Tree(symbol, follow, first, np.concatenate(prices).astype(np.int32))


def train(docs: DataFrame, per_language: int = DOCS_PER_LANGUAGE, max_contexts: int = MAX_CONTEXTS, key: str = "doc_id",
          text: str = "text", lang: str = "lang") -> Languages | None:
    """Fit on at most about ``per_language`` documents of each language, each language in a task of its own."""
    ship(docs)
    known = docs.select(col(key).alias("k"), col(text).alias("text"), col(lang).cast("string").alias("lang")).filter("lang IS NOT NULL AND text IS NOT NULL")
    sizes = known.groupBy("lang").agg(F.count("*").alias("n")).collect()
    if not sizes:
        return None
    share = F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], per_language / r["n"])])
    sample = known.filter(hash_share(F.col("k")) < share[F.col("lang")]).select("lang", "text")

    def grow(of_lang: pa.Table) -> pa.Table:
        tree = build(of_lang["gram"].to_numpy(), of_lang["n"].to_numpy(), max_contexts)
        return pa.table({"lang": of_lang["lang"][:1], "tree": pa.array([pickle.dumps(tree)], pa.binary())})

    grown = window_counts(sample).groupBy("lang").applyInArrow(grow, "lang string, tree binary")  # a group: one sample's windows
    trees = {r["lang"]: pickle.loads(r["tree"]) for r in grown.collect()}  # one bounded tree a language
    return Languages(sorted(trees), [trees[x] for x in sorted(trees)]) if trees else None


def identify(df: DataFrame, tree: Languages | None, text: str = "text") -> DataFrame:
    """Add ``lang_pred`` and ``score`` for each whole text."""
    ship(df)
    if tree is None:
        return add_fields(df, F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score")), FIELDS)
    model = df.sparkSession.sparkContext.broadcast(tree)  # languages x max_contexts x symbols

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        names = np.array(model.value.langs, object)
        for arr in texts:
            data, offsets = utf8(arr)
            parts = [model.value.predict(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]) for i, j in blocks(offsets, BLOCK)]
            best, score = (np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, np.int64), np.zeros(0))
            yield pa.StructArray.from_arrays([pa.array(names[best], pa.string()), pa.array(score)], FIELDS)

    lettered = F.coalesce(col(text).rlike(r"\p{L}"), F.lit(False))
    tmp = free_name(df, "_found")
    found = df.withColumn(tmp, run(col(text)))
    return found.select(*others(df, FIELDS), F.when(lettered, col(tmp)["lang_pred"]).otherwise(UNKNOWN).alias("lang_pred"),
                        F.when(lettered, col(tmp)["score"]).otherwise(0.0).alias("score"))


def op7_language(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    tree = train(docs.filter(fold(F.col("doc_id"), 4) != 2))
    found = identify(docs.select("doc_id", "text"), tree)
    return found.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score")
