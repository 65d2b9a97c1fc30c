"""Ops 3 and 8 against the tokenizers library, byte-level splitting, round trips."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from llm_cases import SF001, SF01, edges, empty  # noqa: F401 (fixtures)
from feedloom.llm import bpe, bytelevel, token_count
from feedloom.llm.common import blocks, utf8

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIB = Tokenizer.from_file(PATH)


def lib_ids(text):
    return LIB.encode(text or "", add_special_tokens=False).ids


def as_bytes(texts):
    return utf8(pa.array(texts, pa.string()))


ALPHABET = st.sampled_from([*"aabtheé1 '\n\tsmdrvl!.²x漢😀", "  ", "'re", "'ll", "<|endoftext|>", " the", "　", "\x85", "\x1c"])


@settings(max_examples=200, deadline=None, derandomize=True)
@given(st.lists(st.lists(ALPHABET, max_size=30).map("".join), min_size=1, max_size=5))
def test_counts_and_ids_match_the_library(texts):
    data, offsets = as_bytes(texts)
    assert token_count.transducer(PATH).count(data, offsets).tolist() == [len(lib_ids(t)) for t in texts]
    vocab = bpe.vocabulary(PATH)
    assert list(vocab.encode_texts(pa.array(texts, pa.string()))) == [lib_ids(t) for t in texts]
    assert [vocab.decode(lib_ids(t)) for t in texts] == [LIB.decode(lib_ids(t), skip_special_tokens=False) for t in texts]


def test_pieces_do_not_depend_on_the_chunk():
    rng = random.Random(4)
    texts = ["".join(rng.choice("ab1 '\n\tstre!.é") for _ in range(rng.randrange(200))) for _ in range(50)]
    data, offsets = as_bytes(texts)
    expected = [t[a:b].encode() for t in texts for _, (a, b) in LIB.pre_tokenizer.pre_tokenize_str(t)]
    for chunk in (1, 2, 7, 64, 10_000):
        cuts = [*bytelevel.piece_starts(data, offsets, chunk).tolist(), len(data)]
        assert [data[a:b].tobytes() for a, b in zip(cuts, cuts[1:])] == expected


def test_state_maps_compose():
    rng = np.random.default_rng(0)
    maps = rng.integers(0, 8, (37, 8)).astype(np.uint8)
    state, expected = 0, []
    for m in maps:
        expected.append(state)
        state = m[state]
    assert bytelevel.scan(maps).tolist() == expected


def test_bounded_memories_change_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBER", 3)
    monkeypatch.setattr(token_count, "REMEMBER", 3)
    monkeypatch.setattr(token_count, "MAX_PAIRS", 2)
    monkeypatch.setattr(token_count, "MAX_ARCS", 2)
    texts = ["the cat sat on the mat and unbelievably elongated words"] * 3
    data, offsets = as_bytes(texts)
    assert token_count.Transducer(PATH).count(data, offsets).tolist() == [len(lib_ids(t)) for t in texts]
    assert list(bpe.Vocabulary(PATH).encode_texts(pa.array(texts))) == [lib_ids(t) for t in texts]


def test_long_runs_without_space():
    texts = ["a" * 20_000, "=" * 3_001, " " * 5_000 + "x", "\n" * 999]
    data, offsets = as_bytes(texts)
    assert token_count.transducer(PATH).count(data, offsets).tolist() == [len(lib_ids(t)) for t in texts]
    assert list(bpe.vocabulary(PATH).encode_texts(pa.array(texts))) == [lib_ids(t) for t in texts]


def test_edges_and_clashing_names(edges, empty):
    df = edges.withColumn("n_tokens", F.lit("old")).withColumn("IDS", F.lit("old")).withColumn("Decoded", F.lit(0))
    rows = token_count.count_tokens(df).collect()
    assert len(rows) == edges.count()
    for r in rows:
        n = len(lib_ids(r["text"]))
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len((r["text"] or "").encode()), n, n > 512)
    both = bpe.decode(bpe.encode(df)).collect()
    assert all(r["ids"] == lib_ids(r["text"]) and r["decoded"] == (r["text"] or "") for r in both)
    one_pass = bpe.encode(df, decoded="back").collect()
    assert [(r["ids"], r["back"]) for r in one_pass] == [(r["ids"], r["decoded"]) for r in both]
    assert token_count.count_tokens(empty).count() == 0 and bpe.decode(bpe.encode(empty)).count() == 0


def test_queries(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text").toArrow().to_pylist()
    ids = {d["doc_id"]: lib_ids(d["text"]) for d in docs}
    for r in token_count.op3_token_counts(spark, SF01).collect():
        assert r["n_tokens"] == len(ids[r["doc_id"]])
    for r in bpe.op8_bpe(spark, SF01).collect():
        joined = ",".join(map(str, ids[r["doc_id"]]))
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids[r["doc_id"]]), hashlib.sha256(joined.encode()).hexdigest())


def test_blocks_cover_all_rows():
    offsets = np.array([0, 5, 5, 30, 31, 60])
    assert list(blocks(offsets, 10)) == [(0, 2), (2, 3), (3, 4), (4, 5)]
    assert list(blocks(np.array([0]), 10)) == []
