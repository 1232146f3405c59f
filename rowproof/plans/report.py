"""The five report sheets of a comparison as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowproof import settings, storage
from rowproof.functions.rendering import key_cell
from rowproof.operators import keys, totals
from rowproof.operators.columns import quoted
from rowproof.operators.ordering import number_rows
from rowproof.plans.compare import Comparison


def key_sheet(key_rows: DataFrame, legacy: bool = False) -> DataFrame:
    """Key rows as text, one column per key."""
    return key_rows.select(
        *[
            key_cell(quoted(f.name), f.dataType, legacy).alias(f.name)
            for f in key_rows.schema.fields
        ]
    )


def report_sheets(
    comparison: Comparison, presence: DataFrame, legacy: bool = False
) -> dict[str, DataFrame]:
    """The sheets by title, in the report's order.

    Three of them derive from ``presence``: pass a written one, so that the keys are compared once.
    """
    pair = comparison.pair
    return {
        settings.SHEET_COLUMN_COUNTS: comparison.column_counts(),
        settings.SHEET_COLUMNS: comparison.columns_side_by_side(),
        settings.SHEET_KEYS_PRESENT: key_sheet(keys.present_keys(presence, pair), legacy),
        settings.SHEET_KEYS_ABSENT: key_sheet(keys.absent_keys(presence, pair), legacy),
        settings.SHEET_PERCENT: totals.percent_rows(totals.key_counts(presence)),
    }


def one_table(sheets: dict[str, DataFrame], width: int) -> DataFrame:
    """All sheets in one DataFrame ``(sheet, cell_1 .. cell_<width>)`` of strings.

    Row numbers of the columns sheet are not cells; cells beyond a sheet's columns are null.
    """
    parts = []
    for title, sheet in sheets.items():
        names = [n for n in sheet.columns if (title, n) != (settings.SHEET_COLUMNS, "row_no")]
        cells = [quoted(name).cast("string") for name in names]
        cells += [F.lit(None).cast("string")] * (width - len(cells))
        parts.append(
            sheet.select(
                F.lit(title).alias("sheet"),
                *[cell.alias(f"cell_{i}") for i, cell in enumerate(cells, start=1)],
            )
        )
    table = parts[0]
    for part in parts[1:]:
        table = table.unionAll(part)
    return table


def first_key_side_by_side(comparison: Comparison, legacy: bool = False) -> DataFrame:
    """First key of the keys present and not present, next to each other by row number.

    Runs jobs when called: it writes the flagged keys and numbers them. Either list is sorted by all its keys; the shorter one is padded with ``''``. The keys
    are written once, so that both lists come from one pass over the two sides.
    """
    pair, first, order = comparison.pair, comparison.spec.keys[0], list(comparison.spec.keys)
    folder = storage.new_folder(comparison.reference.sparkSession, "presence")
    presence = storage.stage(comparison.presence(), folder)

    def numbered(key_rows: DataFrame, name: str) -> DataFrame:
        shown = key_cell(quoted(first), key_rows.schema[first].dataType, legacy)
        numbers = number_rows(key_rows, order, "__row_no")
        return numbers.select(F.col("__row_no").alias("row_no"), shown.alias(name))

    return (
        numbered(keys.present_keys(presence, pair), "present")
        .join(numbered(keys.absent_keys(presence, pair), "not_present"), "row_no", "full_outer")
        .select(
            "row_no",
            F.coalesce("present", F.lit("")).alias("present"),
            F.coalesce("not_present", F.lit("")).alias("not_present"),
        )
    )
