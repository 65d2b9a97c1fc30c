"""Op 8: byte-pair encoding and decoding.

A text is cut into pieces (:mod:`bytelevel`); each piece is a doubly linked list of byte symbols, and a
priority queue holds the mergeable neighbours by merge rank, the leftmost first among equals. A queue
entry is stale, and skipped, when one of its two symbols has changed since. Decoding concatenates the
vocabulary's byte strings. Pieces recur, so each worker keeps the encodings of recent ones (bounded).

Nulls are empty texts: no ids, and ids of null decode to the empty text. Texts of any length are encoded
whole. A special string inside a text (``<|endoftext|>``) is its one special token, as the library does by
default. Rows are independent: repeated rows, empty tables and other columns pass through unchanged.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.llm.bytelevel import piece_starts
from feedloom.llm.common import add_fields, blocks, col, ship, table, utf8

DEFAULT = "byte_bpe_50k.json"
REMEMBER = 150_000  # pieces in each of a worker's two generations


def byte_alphabet() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: printable ones for themselves,
    the others, in order, from code point 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b if b in plain else next(rest)) for b in range(256)]


class Vocabulary:
    """Merge ranks, ids and byte strings of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_alphabet()
        back = {c: b for b, c in enumerate(alphabet)}
        ids = spec["model"]["vocab"]
        self.bytes_of: dict[int, bytes] = {i: bytes(back[c] for c in t) for t, i in ids.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of |= {i: s.encode() for s, i in self.special.items()}
        self.first = [ids[c] for c in alphabet]
        self.ranks = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[ids[a] << 32 | ids[b]] = (rank, ids[a + b])
        names = sorted(map(re.escape, self.special), key=len, reverse=True)
        self.split_special = re.compile("(" + "|".join(names) + ")") if names else None
        self.recent: dict[bytes, list[int]] = {}
        self.older: dict[bytes, list[int]] = {}

    def merge(self, piece: bytes) -> list[int]:
        """The ids of one piece."""
        symbols = [self.first[b] for b in piece]
        n = len(symbols)
        if n == 1:
            return symbols
        ranks = self.ranks.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = [(r[0], i, a, b, r[1]) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if (r := ranks(a << 32 | b))]
        heapq.heapify(queue)
        while queue:
            _, i, a, b, merged = heapq.heappop(queue)
            j = after[i]
            if symbols[i] != a or j == n or symbols[j] != b:
                continue  # stale
            symbols[i], symbols[j] = merged, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if r := ranks(merged << 32 | symbols[k]):
                    heapq.heappush(queue, (r[0], i, merged, symbols[k], r[1]))
            h = before[i]
            if h >= 0 and (r := ranks(symbols[h] << 32 | merged)):
                heapq.heappush(queue, (r[0], h, symbols[h], merged, r[1]))
        return [s for s in symbols if s >= 0]

    def piece_ids(self, piece: bytes) -> list[int]:
        ids = self.recent.get(piece)
        if ids is None:
            ids = self.older.get(piece)
            if ids is None:
                ids = self.merge(piece)
            if len(self.recent) >= REMEMBER:
                self.older, self.recent = self.recent, {}
            if len(piece) <= 64:
                self.recent[piece] = ids
        return ids

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> list[list[int]]:
        """The ids of each text without special strings; texts as bytes and offsets."""
        starts = piece_starts(data, offsets)
        raw, cuts = data.tobytes(), [*starts.tolist(), len(data)]
        firsts = np.searchsorted(starts, offsets).tolist()
        recent, piece_ids = self.recent.get, self.piece_ids
        out = []
        for p, q in zip(firsts, firsts[1:]):
            ids: list[int] = []
            for k in range(p, q):
                piece = raw[cuts[k]:cuts[k + 1]]
                found = recent(piece)
                if found is None:
                    found = piece_ids(piece)
                    recent = self.recent.get
                ids += found
            out.append(ids)
        return out

    def encode_texts(self, arr: pa.Array) -> Iterator[list[int]]:
        """The ids of each text of a string array, special strings as their tokens."""
        data, offsets = utf8(arr)
        names = [s.encode() for s in self.special]
        for i, j in blocks(offsets):
            part, offs = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
            if not any(s in part.tobytes() for s in names):
                yield from self.encode(part, offs)
                continue
            for a, b in zip(offs, offs[1:]):  # some text has a special string
                ids: list[int] = []
                for k, run in enumerate(self.split_special.split(part[a:b].tobytes().decode())):
                    if k % 2:
                        ids.append(self.special[run])
                    elif run:
                        body = np.frombuffer(run.encode(), np.uint8)
                        ids += self.encode(body, np.array([0, len(body)]))[0]
                yield ids

    def decode(self, ids) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


@functools.cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def encode(df: DataFrame, text: str = "text", ids: str = "ids", tokenizer: str | None = None,
           decoded: str | None = None) -> DataFrame:
    """Add column ``ids``, array<int>: the token ids of each whole text; and, if named, column ``decoded``: the text
    that these ids decode to, made in the same pass. ``tokenizer``: path of the file."""
    path = tokenizer or public_tokenizers.path(DEFAULT)
    ship(df)
    names = [ids, decoded] if decoded else [ids]
    kinds = [T.ArrayType(T.IntegerType()), T.StringType()]

    @F.arrow_udf(T.StructType([T.StructField(n, k) for n, k in zip(names, kinds)]))
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        vocab = vocabulary(path)
        for arr in texts:
            lengths, flat, back = [0], [], []
            for found in vocab.encode_texts(arr):
                flat.append(np.array(found, np.int32))
                lengths.append(len(found))
                if decoded:
                    back.append(vocab.decode(found))
            values = pa.array(np.concatenate(flat) if flat else np.zeros(0, np.int32), pa.int32())
            columns = [pa.ListArray.from_arrays(pa.array(np.cumsum(lengths), pa.int32()), values)]
            if decoded:
                columns.append(pa.array(back, pa.string()))
            yield pa.StructArray.from_arrays(columns, names)

    return add_fields(df, run(col(text)), names)


def decode(df: DataFrame, ids: str = "ids", text: str = "decoded", tokenizer: str | None = None) -> DataFrame:
    """Add column ``text``: the text of the token ids, special tokens included."""
    path = tokenizer or public_tokenizers.path(DEFAULT)
    ship(df)

    @F.arrow_udf(T.StructType([T.StructField(text, T.StringType())]))
    def run(lists: Iterator[pa.Array]) -> Iterator[pa.Array]:
        vocab = vocabulary(path)
        for arr in lists:
            flat, ends = arr.flatten().to_numpy(), np.cumsum(arr.value_lengths().fill_null(0).to_numpy())
            texts, at = [], 0
            for end in ends.tolist():
                texts.append(vocab.decode(flat[at:end].tolist()))
                at = end
            yield pa.StructArray.from_arrays([pa.array(texts, pa.string())], [text])

    return add_fields(df, run(col(ids)), [text])


def digests(df: DataFrame, keep=("doc_id",)) -> DataFrame:
    """Encode and decode, and give the count and digests of both instead of the values."""
    both = encode(df.select(*map(col, keep), "text"), decoded="decoded")
    joined = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return both.select(*map(col, keep), F.size("ids").cast("long").alias("n_tokens"), F.sha2(joined, 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


def op8_bpe(spark, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))


def stage_encode(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token ids, with ``n_tokens`` and whether decoding gives the text back."""
    both = encode(docs.select("doc_id", "source", "lang", "text"), decoded="decoded")
    return both.select("doc_id", "source", "lang", "ids", F.size("ids").cast("long").alias("n_tokens"),
                       F.col("decoded").eqNullSafe(F.coalesce("text", F.lit(""))).alias("round_trip"))
