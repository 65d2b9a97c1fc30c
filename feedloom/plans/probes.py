"""CPU probes (F10, G10-G12) expressed over real tables."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the modular-hash probe.
HASH_MULTIPLIER = 2654435761
HASH_MODULUS = 1000003


_PLAIN = re.compile(r"^(\()?([A-Za-z0-9 _-]+(?:\|[A-Za-z0-9 _-]+)*)(?(1)\))$")


def literal_alternatives(pattern: str) -> list[str] | None:
    """``'(a|b|c)'`` -> ``['a', 'b', 'c']`` when the pattern is only literal alternatives."""
    m = _PLAIN.match(pattern)
    return m.group(2).split("|") if m else None


def matches(c, pattern: str):
    """``rlike`` with a fast path: literal alternatives become OR-ed ``contains`` (byte search)."""
    col = F.col(c) if isinstance(c, str) else c
    words = literal_alternatives(pattern)
    if not words:
        return col.rlike(pattern)
    cond = col.contains(words[0])
    for w in words[1:]:
        cond = cond | col.contains(w)
    return cond


def regex_count(df: DataFrame, col: str, pattern: str = "(news|press|times|post)") -> DataFrame:
    """One row: rows whose ``col`` matches ``pattern`` anywhere."""
    return df.agg(F.count_if(matches(col, pattern)).alias("n"))


def group_count(df: DataFrame, col: str, modulus: int = 7) -> DataFrame:
    """Groups of ``col % modulus`` and the sum over their sums (G11): a nested aggregate."""
    inner = df.groupBy((F.col(col) % modulus).alias("k")).agg(F.sum(col).alias("s"))
    return inner.agg(F.count(F.lit(1)).alias("groups"), F.sum("s").alias("total"))


def modular_sum(df: DataFrame, col: str) -> DataFrame:
    """One row: ``sum((x * 2654435761) % 1000003)`` (G12), remainder signed like ``x``.

    Evaluated as ``((x % m) * (2654435761 % m)) % m``: congruent, same sign, same range, so
    the same value; and the product stays below 2^63 for any BIGINT input, so ANSI overflow
    cannot trip on large keys.
    """
    x = F.col(col)
    term = ((x % F.lit(HASH_MODULUS)) * F.lit(HASH_MULTIPLIER % HASH_MODULUS)) % F.lit(HASH_MODULUS)
    return df.agg(F.sum(term).alias("s"))
