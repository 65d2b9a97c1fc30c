"""Corpus pipeline: quality classifier, line de-duplication, near-duplicate removal, mixing, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet to the shared
folder and read again as the next stage's ``docs``. This module belongs to ``feedloom.llm`` and cannot be imported without it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from feedloom.llm.bpe import stage_encode
from feedloom.llm.common import stored, table, tidied
from feedloom.llm.line_dedup import stage_line_dedup
from feedloom.llm.mixing import stage_mixing
from feedloom.llm.ngram_join import stage_ngram_join
from feedloom.llm.quality import stage_quality

STAGES = [
    ("quality classifier", stage_quality),
    ("line dedup", stage_line_dedup),
    ("n-gram Jaccard join", stage_ngram_join),
    ("mixing sources to target weights", stage_mixing),
    ("BPE encoding and decoding", stage_encode),
]

# SQL cannot express boosted trees, MinHash or byte-pair merges; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        if k + 1 == len(STAGES):
            return stage(spark, docs, sf_dir)
        with tidied(spark):  # a stage's scratch tables go when its result is written
            docs = stored(stage(spark, docs, sf_dir), f"stage-{k}", keep=True)
