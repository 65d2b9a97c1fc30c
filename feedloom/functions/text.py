"""Text predicates and normalisers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def country_code(value: str | None) -> Column | None:
    """A user-given 2-letter country code in upper case, as a literal (never spliced into SQL)."""
    if value is None:
        return None
    if len(value) != 2 or not value.isascii() or not value.isalpha():
        raise ValueError(f"a country is given by its 2-letter code, not {value!r}")
    return F.lit(value.upper())


def non_blank(c) -> Column:
    col = _c(c)
    return col.isNotNull() & (col != "")


def blank_to_null(c) -> Column:
    """Empty or all-space text becomes NULL (one policy for every reader)."""
    col = _c(c)
    return F.when(F.trim(col) == "", F.lit(None).cast("string")).otherwise(col)
