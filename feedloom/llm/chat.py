"""Op 5: chat formatting with an offset-aligned loss mask.

A turn is rendered as ``<s>[INST]role[/INST]text</s>``, a conversation as its turns in order. The four control
strings are escaped inside roles and texts by one more backslash after their first character
(``[/INST]`` becomes ``[\\/INST]``, and that one in a text ``[\\\\/INST]``), which is undone without loss. They are
added to the tokenizer as special tokens, so the rendered text is encoded once, with offsets; each loss span
(the text of a turn whose role is the learner's) is found among the sorted token spans by binary search, and
the mask covers exactly the characters of the span that tokens cover.

Rows of a conversation are brought together and sorted by turn; a task streams through them and encodes runs of
whole turns (a control token starts every turn, so the runs' tokens are those of the whole). Only one run is
held at a time, so a conversation of any length takes bounded memory, though one task: its text has one order.

Null role or text is empty. Rows with equal turn are taken by role, then text; repeated rows are turns of their
own; a null conversation id is one conversation, a null turn comes first. Empty tables give empty results; other
columns are not used.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.bpe import DEFAULT
from feedloom.llm.common import col, ship, table

CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]")
LEARNER = "assistant"
RUN_CHARS = 1 << 18  # rendered at a time, to the end of a turn
_ESCAPE = re.compile(r"([<\[])(\\*)(?=/?s>|/?INST\])")
_ESCAPED = re.compile(r"([<\[])\\(\\*)(?=/?s>|/?INST\])")
_TURN = re.compile(r"<s>\[INST\](.*?)\[/INST\](.*?)</s>", re.S)


def escape(text: str) -> str:
    def one(m: re.Match) -> str:
        angle = text.startswith(("s>", "/s>"), m.end())
        return f"{m[1]}\\{m[2]}" if angle == (m[1] == "<") else m[0]
    return _ESCAPE.sub(one, text)


def unescape(text: str) -> str:
    def one(m: re.Match) -> str:
        angle = text.startswith(("s>", "/s>"), m.end())
        return m[1] + m[2] if angle == (m[1] == "<") else m[0]
    return _ESCAPED.sub(one, text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The text of some turns (role, text), and the spans of the learner's texts in it."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"<s>[INST]{escape(role)}[/INST]", escape(text)
        if role == LEARNER:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += (head, body, "</s>")
        at += len(head) + len(body) + 4
    return "".join(parts), spans


def read_back(rendered: str) -> list[tuple[str, str]]:
    """The turns of a rendered text."""
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(rendered)]


@functools.cache
def tokenizer(path: str):
    from tokenizers import AddedToken, Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_padding()
    tok.no_truncation()
    tok.add_special_tokens([AddedToken(c, normalized=False) for c in CONTROLS])
    return tok


def encode(rendered: str, spans: list[tuple[int, int]], path: str) -> tuple[list[int], np.ndarray, list[tuple[int, int]]]:
    """Token ids, the loss mask over tokens, and the characters under the mask as spans in order."""
    found = tokenizer(path).encode(rendered, add_special_tokens=False)
    offsets = np.array(found.offsets, np.int64).reshape(-1, 2)
    begin, end = offsets[:, 0], offsets[:, 1]
    mask, under = np.zeros(len(offsets), bool), []
    for a, b in spans:
        p, q = int(np.searchsorted(end, a, "right")), int(np.searchsorted(begin, b, "left"))
        mask[p:q] = True
        under.append((max(a, int(begin[p])), min(b, int(end[q - 1]))) if q > p else (a, a))
    return found.ids, mask, under


OUT_FIELDS = "conv_id long, part long, rendered string, ids array<int>, loss_mask array<boolean>, loss_spans array<struct<begin: long, end: long>>"


def by_turn(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    rows = df.select(col(conv).cast("long").alias("conv_id"), col(turn).alias("turn"), F.coalesce(col(role), F.lit("")).alias("role"),
                     F.coalesce(col(text), F.lit("")).alias("text"))
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, int, list[tuple[str, str]]]]:
    """(conversation, number of the run, turns) from sorted rows."""
    at, number, held, size = None, 0, [], 0
    started = False
    for batch in batches:
        convs, roles, texts = (batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))
        for conv, role, text in zip(convs, roles, texts):
            if started and conv != at or size >= RUN_CHARS:
                yield at, number, held
                number = number + 1 if conv == at else 0
                held, size = [], 0
            at, started = conv, True
            held.append((role, text))
            size += len(role) + len(text)
    if held:
        yield at, number, held


def format_chats(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                 tokenizer_path: str | None = None) -> DataFrame:
    """Rows (conv_id, part, rendered, ids, loss_mask, loss_spans): conversations as training text, long ones in parts
    of whole turns."""
    path = tokenizer_path or public_tokenizers.path(DEFAULT)
    ship(df)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for conv_id, part, turns in runs(batches):
            rendered, spans = render(turns)
            ids, mask, under = encode(rendered, spans, path)
            yield pa.RecordBatch.from_arrays([
                pa.array([conv_id], pa.int64()), pa.array([part], pa.int64()), pa.array([rendered], pa.string()),
                pa.array([ids], pa.list_(pa.int32())), pa.array([mask.tolist()], pa.list_(pa.bool_())),
                pa.array([[{"begin": a, "end": b} for a, b in under]], pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])))],
                ["conv_id", "part", "rendered", "ids", "loss_mask", "loss_spans"])

    return by_turn(df, conv, turn, role, text).mapInArrow(make, OUT_FIELDS)


def digests(formatted: DataFrame) -> DataFrame:
    """Read formatted conversations back: counts and digests of their turns and of the text under the loss mask."""
    ship(formatted)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state, started = None, None, False

        def out():
            return pa.RecordBatch.from_pydict({
                "conv_id": pa.array([at], pa.int64()), "n_turns": [state[0]], "turns_sha256": [state[1].hexdigest()], "loss_chars": [state[2]],
                "loss_sha256": [state[3].hexdigest()], "formatted_chars": [state[4]], "n_tokens": [state[5]], "n_loss_tokens": [state[6]]})

        for batch in batches:
            rows = (batch.column(c).to_pylist() for c in ("conv_id", "rendered", "n_tokens", "n_loss_tokens", "loss_spans"))
            for conv, rendered, tokens, loss_tokens, spans in zip(*rows):
                if not started or conv != at:
                    if started:
                        yield out()
                    at, started, state = conv, True, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0, 0]
                for role, text in read_back(rendered):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                for s in spans:
                    text = unescape(rendered[s["begin"]:s["end"]])
                    state[2] += len(text)
                    state[3].update(text.encode())
                state[4] += len(rendered)
                state[5] += tokens
                state[6] += loss_tokens
        if started:
            yield out()

    slim = formatted.select("conv_id", "part", "rendered", "loss_spans", F.size("ids").cast("long").alias("n_tokens"),
                            F.size(F.filter("loss_mask", lambda x: x)).cast("long").alias("n_loss_tokens"))
    sorted_ = slim.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return sorted_.mapInArrow(read, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                              "formatted_chars long, n_tokens long, n_loss_tokens long")


def op5_chat_format(spark, sf_dir: str) -> DataFrame:
    own = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", own), (-7, 1, LEARNER, own)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return digests(format_chats(rows))
