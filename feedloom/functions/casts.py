"""Strict and lenient casts.

Strict casts raise on bad input, as the weather feed does. Lenient casts turn
bad input into NULL, as the event feed does; ``lost_in_cast`` says which values were lost
so nothing disappears silently. Text of a number that is no integer is rounded for an integer
column (``'1.5'`` is 2, ``'1e3'`` is 1000).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strict(c, to: str) -> Column:
    """Cast that fails the job on a non-empty value it cannot read, whatever the session's
    ANSI setting (the weather feed's own rule: a bad reading is an error, not a NULL)."""
    col = _c(c)
    typed = F.trim(col.cast("string")).try_cast(to) if to not in ("string",) else col.cast(to)
    bad = col.isNotNull() & (F.trim(col.cast("string")) != "") & typed.isNull()
    return F.when(bad, F.raise_error(F.concat(F.lit(f"cannot cast to {to}: "), col.cast("string")))).otherwise(typed)


def lenient(c, to: str) -> Column:
    """``try_cast``: NULL instead of an error. Text is trimmed first, and rounded for integer types."""
    text = F.trim(_c(c).cast("string"))
    if to not in ("bigint", "int", "smallint", "tinyint"):
        return text.try_cast(to)
    return F.coalesce(text.try_cast(to), F.round(text.try_cast("double")).try_cast(to))


def lenient_number(c, to: str) -> Column:
    """Lenient cast that also reads ``nan`` and friends as NULL for doubles."""
    v = lenient(c, to)
    if to in ("double", "float"):
        return F.when(F.isnan(v), F.lit(None).cast(to)).otherwise(v)
    return v


def lost_in_cast(raw, typed) -> Column:
    """True where a non-empty raw value became NULL after the cast."""
    r = _c(raw)
    return r.isNotNull() & (F.trim(r.cast("string")) != "") & _c(typed).isNull()


def lenient_in(df, c: str, to: str) -> Column:
    """``lenient`` for a column of ``df``: only text goes through parsing; a numeric column is
    cast directly (no per-row string round trip)."""
    t = df.schema[c].dataType.simpleString()
    if t in ("string", "varchar", "char") or t.startswith(("varchar", "char")):
        return lenient(c, to)
    return F.col(c).cast(to)
