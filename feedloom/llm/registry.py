"""The queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

import corpus_pipeline
from feedloom.llm import (
    bpe, chat, fingerprint, importance, language, line_dedup, mixing, negatives, ngram_join, quality, rules, substring_dedup, token_count,
)

QUERIES = {
    "op1_fingerprints": fingerprint.op1_fingerprints,
    "op2_line_dedup": line_dedup.op2_line_dedup,
    "op3_token_counts": token_count.op3_token_counts,
    "op4_ngram_join": ngram_join.op4_ngram_join,
    "op5_chat_format": chat.op5_chat_format,
    "op6_quality_rules": rules.op6_quality_rules,
    "op7_language": language.op7_language,
    "op8_bpe": bpe.op8_bpe,
    "op9_quality": quality.op9_quality,
    "op10_mixing": mixing.op10_mixing,
    "op11_hard_negatives": negatives.op11_hard_negatives,
    "op12_substring_dedup": substring_dedup.op12_substring_dedup,
    "op13_importance": importance.op13_importance,
    "pipeline": corpus_pipeline.run,
}
ORACLES = {
    "op2_line_dedup": line_dedup.ORACLE,
    "op10_mixing": mixing.oracle(),
    "op11_hard_negatives": negatives.ORACLE,
    "op12_substring_dedup": substring_dedup.ORACLE,
    "op13_importance": importance.ORACLE,
}
