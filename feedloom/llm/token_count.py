"""Op 3: token counts by a compiled finite-state tokenizer.

Two deterministic transducers, one after the other.

* The first (:mod:`bytelevel`) reads code points and marks where pieces start; chunk state maps composed by
  a parallel prefix scan let all chunks of a block step at once.
* The second reads the bytes of a piece and emits one token with every transition. Its states are tokens; there
  is a transition from a to b if the encoding of their joint text is a, b again (compiled when first asked
  for). Byte-pair encoding has exactly one path of such transitions through a piece, and the path to
  each prefix is unique too, so one left-to-right pass over the tokens that end at each byte finds it.

A piece start in the first machine carries the second one's count as its annotation, and prefix sums of the
annotations give the counts of texts. Counts of recent pieces are kept by each worker (bounded).

Nulls count as empty texts (0 bytes, 0 tokens). Texts of any length are counted whole; a special string
inside a text counts as one token, as the library's default has it. Rows are independent: repeated rows,
ties, empty tables and other columns pass through unchanged.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.bpe import DEFAULT, Vocabulary
from feedloom.llm.bytelevel import piece_starts
from feedloom.llm.common import add_fields, blocks, col, ship, table, utf8

REMEMBER = 250_000  # pieces in each of a worker's two generations
MAX_PAIRS, MAX_ARCS = 1_000_000, 300_000  # compiled so far; beyond, they are compiled anew
LIMIT = 512
FIELDS = ["n_bytes", "n_tokens", "over_limit"]


class Transducer:
    """The token-counting machine of one vocabulary, compiled as far as texts have needed it."""

    def __init__(self, path: str):
        self.vocab = Vocabulary(path)
        self.ids = {b: i for i, b in self.vocab.bytes_of.items() if i not in self.vocab.special.values()}
        self.growing = {b[:k] for b in self.ids for k in range(1, len(b))}
        self.follows: dict[int, bool] = {}
        self.arcs: dict[bytes, tuple] = {}
        self.recent: dict[bytes, int] = {}
        self.older: dict[bytes, int] = {}

    def transition(self, a: int, b: int) -> bool:
        """Whether the two tokens are the encoding of their joint text."""
        if len(self.follows) >= MAX_PAIRS:
            self.follows.clear()
        joint = self.vocab.bytes_of[a] + self.vocab.bytes_of[b]
        found = self.follows[a << 32 | b] = self.vocab.merge(joint) == [a, b]
        return found

    def arc(self, grown: bytes) -> tuple[tuple[tuple[int, int], ...], int]:
        """For a suffix with its new byte: the tokens that end there, the longest first, and how much may still grow."""
        if len(self.arcs) >= MAX_ARCS:
            self.arcs.clear()
        n = len(grown)
        ends = tuple((n - k, self.ids[grown[k:]]) for k in range(n) if grown[k:] in self.ids)
        reach = next((n - k for k in range(n) if grown[k:] in self.growing), 0)
        found = self.arcs[grown] = (ends, reach)
        return found

    def walk(self, piece: bytes) -> int:
        """Tokens along the one path through a piece."""
        arcs, follows = self.arcs.get, self.follows.get
        last, count, reach = [-1], [0], 0
        for end in range(1, len(piece) + 1):
            grown = piece[end - 1 - reach:end]
            ends, reach = arcs(grown) or self.arc(grown)
            for size, token in ends:
                before = last[end - size]
                if before < 0 or (known := follows(before << 32 | token)) or known is None and self.transition(before, token):
                    last.append(token)
                    count.append(count[end - size] + 1)
                    break
        return count[-1]

    def count_pieces(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Tokens of each piece of ``data``."""
        raw, cuts = data.tobytes(), [*starts.tolist(), len(data)]
        pieces = [raw[a:b] for a, b in zip(cuts, cuts[1:])]
        counts = list(map(self.recent.get, pieces))
        for k in [k for k, n in enumerate(counts) if n is None]:
            piece = pieces[k]
            n = self.recent.get(piece) or self.older.get(piece) or self.walk(piece)
            if len(self.recent) >= REMEMBER:
                self.older, self.recent = self.recent, {}
            if len(piece) <= 64:
                self.recent[piece] = n
            counts[k] = n
        return np.array(counts, np.int64)

    def count(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Tokens of each text."""
        specials = [s.encode() for s in self.vocab.special]
        found = np.zeros(len(offsets) - 1, np.int64)
        raw = data.tobytes()
        if any(s in raw for s in specials):  # cut at special strings; each is a token
            parts, owner = [], []
            for row, (a, b) in enumerate(zip(offsets, offsets[1:])):
                runs = self.vocab.split_special.split(raw[a:b].decode())
                found[row] = len(runs) // 2
                parts += [r.encode() for r in runs[::2]]
                owner += [row] * len(runs[::2])
            data = np.frombuffer(b"".join(parts), np.uint8)
            offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
            owner = np.array(owner)
        else:
            owner = np.arange(len(found))
        starts = piece_starts(data, offsets)
        totals = np.concatenate([[0], np.cumsum(self.count_pieces(data, starts))])
        at = np.searchsorted(starts, offsets)
        np.add.at(found, owner, totals[at[1:]] - totals[at[:-1]])
        return found


@functools.cache
def transducer(path: str) -> Transducer:
    return Transducer(path)


def count_tokens(df: DataFrame, text: str = "text", limit: int = LIMIT, tokenizer: str | None = None) -> DataFrame:
    """Add ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens) for each whole text."""
    path = tokenizer or public_tokenizers.path(DEFAULT)
    ship(df)

    @F.arrow_udf("struct<n_bytes: long, n_tokens: long, over_limit: boolean>")
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        machine = transducer(path)
        for arr in texts:
            data, offsets = utf8(arr)
            tokens = [machine.count(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]) for i, j in blocks(offsets)]
            tokens = np.concatenate(tokens) if tokens else np.zeros(0, np.int64)
            yield pa.StructArray.from_arrays(
                [pa.array(np.diff(offsets)), pa.array(tokens), pa.array(tokens > limit)], FIELDS)

    return add_fields(df, run(col(text)), FIELDS)


def op3_token_counts(spark, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
