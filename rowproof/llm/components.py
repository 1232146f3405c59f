"""Connected components by alternating stars: only edges move, and hubs are pre-aggregated."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowproof.llm.common import Steps


def connected(edges: DataFrame, steps: Steps) -> DataFrame:
    """``node`` and ``root`` (the smallest node reachable) of every node of ``edges`` but the roots.

    ``edges`` has the columns ``a`` and ``b``, whole numbers. Each round is written, so a lost executor repeats
    one round at most. A round halves the depth of the trees, as in the large-star and
    small-star scheme of Kiveris et al. (2014).
    """
    a, b = F.col("a"), F.col("b")
    now = steps.write(
        edges.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()
    )
    mark = _mark(now)
    while mark[0]:
        both = now.union(now.select("b", "a"))
        # written, so that the join deals out both sides anew and a hub's rows can be split
        least = steps.write(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = steps.write(large)
        least = steps.write(large.groupBy("a").agg(F.min("b").alias("m")))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = steps.write(small.union(least).distinct())
        before, mark = mark, _mark(now)
        steps.drop(*range(steps.n - 4, steps.n))
        if mark == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))")).first()
    return row[0], row[1]
