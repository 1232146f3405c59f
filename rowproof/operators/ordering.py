"""Orders: first rows of a sort, and row numbers over a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowproof import storage
from rowproof.operators.columns import quoted

_IN_SLICE = (1 << 33) - 1  # monotonically_increasing_id keeps the row's place in these bits


def top_rows(df: DataFrame, column: str, n: int = 100, tie_break: str | None = None) -> DataFrame:
    """The first ``n`` rows by falling ``column``; each task keeps ``n`` rows at most."""
    order = [quoted(column).desc()] + ([quoted(tie_break)] if tie_break else [])
    return df.orderBy(*order).limit(n)


def first_rows(df: DataFrame, order_by: list[str], n: int) -> DataFrame:
    return df.orderBy(*[quoted(c) for c in order_by]).limit(n)


def number_rows(df: DataFrame, order_by: list[str], name: str = "row_no") -> DataFrame:
    """``df`` with row numbers from 1 in the given order, nulls first.

    The rows are range-partitioned and sorted within partitions; a row's number is its
    place in its partition plus the sizes of the partitions before. The placed rows are
    written first, because a second evaluation could cut the ranges elsewhere. No task
    sees more than one range, unless one value of ``order_by`` fills it: order by a unique
    set of columns.
    """
    order = [quoted(c) for c in order_by]
    placed = storage.stage(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(
            "*",
            F.spark_partition_id().alias("__slice"),
            F.monotonically_increasing_id().bitwiseAND(F.lit(_IN_SLICE)).alias("__place"),
        ),
        storage.new_folder(df.sparkSession, "numbered"),
    )
    # One row per range partition, so the unpartitioned window and the broadcast stay
    # as small as the number of partitions, whatever the table's size.
    before = Window.orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("__slice")
        .agg(F.count(F.lit(1)).alias("__size"))
        .select("__slice", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__before"))
    )
    return placed.join(F.broadcast(offsets), "__slice").select(
        *[quoted(c) for c in df.columns], (F.col("__before") + F.col("__place") + 1).alias(name)
    )
