"""Column lists of many table pairs as one table.

Column names match in any case, and a name that a table has twice matches as often as the other side has it. The
lists of all pairs are one DataFrame, so a whole catalog is compared, filtered and stored like any other data.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rowproof.operators.columns import quoted

REFERENCE, DELIVERED = "reference", "delivered"
COMMON, ONE_SIDED = "common", {REFERENCE: "reference_only", DELIVERED: "delivered_only"}
ROWS = "pair string, side string, position int, name string, type string"
Pairs = Mapping[str, tuple[DataFrame, DataFrame]]


def column_rows(spark: SparkSession, pairs: Pairs) -> DataFrame:
    """``(pair, side, position, name, type)`` of all columns; a pair is a reference and a delivered table.

    Only schemas are read, no data.
    """
    rows = [
        (pair, side, i, f.name.lower(), f.dataType.simpleString())
        for pair, sides in pairs.items()
        for side, df in zip((REFERENCE, DELIVERED), sides, strict=True)
        for i, f in enumerate(df.schema.fields, start=1)
    ]
    return spark.createDataFrame(rows, ROWS)


def matched_columns(rows: DataFrame) -> DataFrame:
    """``rows`` with ``occurrence`` and ``status``: ``common``, ``reference_only`` or ``delivered_only``.

    The n-th column of a name matches the other side's n-th. Both windows share one shuffle by pair and name.
    """
    one_side = Window.partitionBy("pair", "name", "side").orderBy("position")
    both_sides = Window.partitionBy("pair", "name")
    counted = rows.repartition("pair", "name").withColumn("occurrence", F.row_number().over(one_side))
    least = F.least(*[F.count(F.when(F.col("side") == s, 1)).over(both_sides) for s in (REFERENCE, DELIVERED)])
    alone = F.when(F.col("side") == REFERENCE, ONE_SIDED[REFERENCE]).otherwise(ONE_SIDED[DELIVERED])
    return counted.withColumn("status", F.when(F.col("occurrence") <= least, COMMON).otherwise(alone))


def common_columns(rows: DataFrame) -> DataFrame:
    """The delivered columns of each pair that the reference has too, in the delivered order."""
    return matched_columns(rows).where((F.col("side") == DELIVERED) & (F.col("status") == COMMON))


def columns_only_on(rows: DataFrame, side: str) -> DataFrame:
    """Columns of one side that the other lacks."""
    return matched_columns(rows).where(F.col("status") == ONE_SIDED[side])


def column_counts(rows: DataFrame) -> DataFrame:
    """One row for each pair: how many columns either side has, and how many are common or not."""
    matched, side, status = matched_columns(rows), F.col("side"), F.col("status")

    def number(condition, name):
        return F.count(F.when(condition, 1)).alias(name)

    return matched.groupBy("pair").agg(
        number(side == REFERENCE, "n_reference"),
        number(side == DELIVERED, "n_delivered"),
        number((side == DELIVERED) & (status == COMMON), "n_common"),
        number(status == ONE_SIDED[REFERENCE], "n_reference_only"),
        number(status == ONE_SIDED[DELIVERED], "n_delivered_only"),
    )


def filled_values(df: DataFrame) -> DataFrame:
    """``(position, filled)``: how many rows of each column are not null. One pass over the data, one row for each task shuffled."""
    names = [f"c{i}" for i in range(1, len(df.columns) + 1)]
    counts = df.toDF(*names).agg(*[F.count(n).alias(n) for n in names])
    pairs = F.map_from_arrays(F.array(*[F.lit(i) for i in range(1, len(names) + 1)]), F.array(*[quoted(n) for n in names]))
    return counts.select(F.explode(pairs).alias("position", "filled"))


def filled_columns(rows: DataFrame, pairs: Pairs) -> DataFrame:
    """``matched_columns`` with ``filled``, how many values each column has.

    A table that is in several pairs is counted once.
    """
    counted, parts = {}, []
    for pair, sides in pairs.items():
        for side, df in zip((REFERENCE, DELIVERED), sides, strict=True):
            if id(df) not in counted:
                counted[id(df)] = filled_values(df), []
            counted[id(df)][1].append((pair, side))
    for filled, places in counted.values():
        names = F.array(*[F.struct(F.lit(p).alias("pair"), F.lit(s).alias("side")) for p, s in places])
        parts.append(filled.select(F.inline(names), "position", "filled"))
    if not parts:
        return matched_columns(rows).withColumn("filled", F.lit(None).cast("bigint"))
    every = parts[0]
    for part in parts[1:]:
        every = every.unionAll(part)
    return matched_columns(rows).join(every, ["pair", "side", "position"], "left")
