"""Code -> label lookups as literal maps (no join, no UDF)."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom.schemas import QUAD_LABELS


def code_label(c, mapping: dict) -> Column:
    """Look ``c`` up in ``mapping``; unknown codes give NULL."""
    m = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    col = F.col(c) if isinstance(c, str) else c
    return F.try_element_at(m, col)


def quad_label(c) -> Column:
    return code_label(c, QUAD_LABELS)
