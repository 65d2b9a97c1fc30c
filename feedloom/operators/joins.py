"""Distributed row indexes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from feedloom.session import cut_lineage


def dense_index(df: DataFrame, col: str, name: str = "pos") -> DataFrame:
    """Distinct values of ``col`` with their 0-based position in ascending order.

    No single-task window over the data: the distinct values are range-partitioned, sorted
    and checkpointed; each row's position is its place inside its partition (the low bits of
    ``monotonically_increasing_id``, stable on checkpointed data) plus the row count of the
    partitions before it. Only one row per partition is windowed and broadcast.
    """
    vals = cut_lineage(df.select(col).where(F.col(col).isNotNull()).distinct()
                       .repartitionByRange(col).sortWithinPartitions(col))
    mid = F.monotonically_increasing_id()
    local = vals.select(col, F.shiftright(mid, 33).alias("_part"),
                        mid.bitwiseAND(F.lit((1 << 33) - 1)).alias("_idx"))
    sizes = local.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_off"))
    return (local.join(F.broadcast(offsets), "_part")
                 .select(col, (F.col("_off") + F.col("_idx")).alias(name)))


def numbered(df: DataFrame, group: str, order: str, name: str = "pos") -> DataFrame:
    """The rows with their 0-based position by ``order`` within ``group``; ties get either order.

    A group of any size is spread: rows are range-partitioned by group and order and checkpointed, numbered inside
    their range (a window holds one range's rows of a group at most), and raised by the group's rows in the ranges before
    (a group has at most one row per range there)."""
    ranged = cut_lineage(df.repartitionByRange(group, order).sortWithinPartitions(group, order))
    local = ranged.withColumn("_part", F.shiftright(F.monotonically_increasing_id(), 33))
    local = local.withColumn("_idx", F.row_number().over(Window.partitionBy(group, "_part").orderBy(order)) - 1)
    sizes = ranged.select(F.col(group).alias("_group"), F.shiftright(F.monotonically_increasing_id(), 33).alias("_range"))
    sizes = sizes.groupBy("_group", "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.withColumn("_off", F.sum("_n").over(Window.partitionBy("_group").orderBy("_range")) - F.col("_n")).drop("_n")
    same = F.col(group).eqNullSafe(F.col("_group")) & (F.col("_part") == F.col("_range"))
    return local.join(before, same).select(*df.columns, (F.col("_off") + F.col("_idx")).alias(name))
