"""One row per key under a stated total order.

``row_number() = 1`` plans a partial group limit before the shuffle, so every map task sends
at most one row per key: a key holding a third of the rows costs one row per task, not a
third of the table in one task. Spark refuses ``row_number`` without an order; the caller
states the order, and the key columns plus a position are appended so the winner is total.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

POS = "_pos"      # struct(stamp, row id): where a raw row sat in the landing
SRC = "_src"      # 0 = history, 1 = new batch


def _cols(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def with_position(df: DataFrame) -> DataFrame:
    """Attach the row's place in the landing; call directly on a file scan.

    Landed rows carry their pull's ``stamp``, which orders pulls in time. Within a pull the
    row id (``monotonically_increasing_id`` at the scan: split index, then row order) orders
    the rows; landed pulls are small files that are never split, so this is file order. Both
    are stable for a given file listing, so a re-run task (executor loss) gets the same
    positions. No ``_metadata`` column is read: it costs a quarter of a CSV scan.
    """
    row = F.lit(None).cast("bigint") if df.isStreaming else F.monotonically_increasing_id()
    stamp = F.col("stamp").cast("string") if "stamp" in df.columns else F.lit(None).cast("string")
    return df.withColumn(POS, F.struct(stamp.alias("stamp"), row.alias("row")))


def number_rows(df: DataFrame) -> DataFrame:
    """Fill the row id of a position taken on a stream; call inside ``foreachBatch``.

    A micro-batch re-runs over the same files and splits, so the ids repeat on a retry.
    """
    if POS not in df.columns:
        return df
    return df.withColumn(POS, F.struct(F.col(f"{POS}.stamp").alias("stamp"),
                                       F.monotonically_increasing_id().alias("row")))


def split_null_keys(df: DataFrame, keys) -> tuple[DataFrame, DataFrame]:
    """``(keyed, rejects)``: rows with any NULL key never take part in a merge (A-5)."""
    ks = _cols(keys)
    has_key = F.lit(True)
    for k in ks:
        has_key = has_key & F.col(k).isNotNull()
    return df.filter(has_key), df.filter(~has_key)


def _has_map(t: T.DataType) -> bool:
    if isinstance(t, T.MapType):
        return True
    if isinstance(t, T.StructType):
        return any(_has_map(f.dataType) for f in t.fields)
    if isinstance(t, T.ArrayType):
        return _has_map(t.elementType)
    return False


def comparable(df: DataFrame, c: str) -> Column:
    """``c`` as something Spark can sort and compare (maps are not: they become JSON text)."""
    return F.to_json(F.col(c)) if _has_map(df.schema[c].dataType) else F.col(c)


def keep_one(df: DataFrame, keys, order: Sequence[Column | str] = (), keep_rank: bool = False) -> DataFrame:
    """Keep the first row per key under ``order`` (first = winner).

    ``order`` items are Columns (use ``F.desc``) or names (ascending). A position column,
    when present, breaks remaining ties (last position wins: "keep last"); otherwise the
    whole row is the tie-break so the result never depends on scheduling.
    """
    ks = _cols(keys)
    o = [F.col(c) if isinstance(c, str) else c for c in order]
    if POS in df.columns:
        o.append(F.desc(POS))
    else:
        o.extend(F.asc_nulls_last(comparable(df, c)) for c in df.columns if c not in ks)
    if not o:  # only key columns: every row of a group is the same row
        o = [F.col(k) for k in ks]
    w = Window.partitionBy(*ks).orderBy(*o)
    out = df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1)
    return out if keep_rank else out.drop("_rn")


def keep_latest(df: DataFrame, keys, by: Sequence[str] = ()) -> DataFrame:
    """Newest copy per key: ``by`` columns descending, then landing position."""
    return keep_one(df, keys, [F.desc_nulls_last(c) for c in by])


def keep_first(df: DataFrame, keys, by: Sequence[str] = ()) -> DataFrame:
    """Oldest copy per key: ``by`` columns ascending (W1-W3 with a stated order)."""
    return keep_one(df, keys, [F.asc_nulls_last(c) for c in by])
