"""Row totals, key counts and match percentages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowproof import settings
from rowproof.functions.rendering import percent_of, percent_text
from rowproof.operators.keys import PRESENT, KeyPair, tally, whole


def row_totals(reference: DataFrame, delivered: DataFrame) -> DataFrame:
    """Rows of both sides, duplicates counted: ``(side, n_rows)``."""
    return reference.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit("reference").alias("side"), "n_rows"
    ).unionAll(
        delivered.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit("delivered").alias("side"), "n_rows"
        )
    )


def key_counts(presence_frame: DataFrame) -> DataFrame:
    """Over ``presence``: distinct delivered keys found, and not found."""
    return presence_frame.agg(
        F.count_if(PRESENT).alias("n_present"),
        F.count_if(~F.col(PRESENT)).alias("n_absent"),
    )


def match_percent(counts: DataFrame) -> DataFrame:
    """``key_counts`` with the share of either kind among distinct delivered keys."""
    present, absent = F.col("n_present"), F.col("n_absent")
    return counts.select(
        "n_present",
        "n_absent",
        percent_of(present, absent).alias("match_percent"),
        percent_of(absent, present).alias("non_match_percent"),
    )


def percent_rows(counts: DataFrame) -> DataFrame:
    """Sheet of the two percentages: ``(type, percentage)``."""
    both = match_percent(counts)

    def row(label: str, column: str):
        return F.struct(
            F.lit(label).alias("type"), percent_text(F.col(column)).alias("percentage")
        )

    return both.select(
        F.inline(
            F.array(
                row(settings.LABEL_MATCHING, "match_percent"),
                row(settings.LABEL_NOT_MATCHING, "non_match_percent"),
            )
        )
    )


def summary(pair: KeyPair, n_reference_columns: int, n_delivered_columns: int) -> DataFrame:
    """One row with column counts, row totals, key counts and percentages.

    Everything comes from one pass over each side and one shuffle.
    """
    on_reference, on_delivered = F.col("__n_reference") > 0, F.col("__n_delivered") > 0
    found = on_reference & on_delivered & whole(pair)
    counts = tally(pair).agg(
        F.coalesce(F.sum("__n_reference"), F.lit(0)).alias("reference_rows"),
        F.coalesce(F.sum("__n_delivered"), F.lit(0)).alias("delivered_rows"),
        F.count_if(found).alias("n_present"),
        F.count_if(on_delivered & ~found).alias("n_absent"),
        F.count_if(on_reference & ~found).alias("reference_only_keys"),
    )
    present, absent = F.col("n_present"), F.col("n_absent")
    return counts.select(
        F.lit(n_reference_columns).alias("reference_columns"),
        F.lit(n_delivered_columns).alias("delivered_columns"),
        "reference_rows",
        "delivered_rows",
        present.alias("common_keys"),
        absent.alias("delivered_only_keys"),
        "reference_only_keys",
        percent_of(present, absent).alias("match_percent"),
        percent_of(absent, present).alias("non_match_percent"),
    )
