"""How values appear in report tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def key_cell(column: Column, data_type: T.DataType, legacy: bool = False) -> Column:
    """A key value as report text; null becomes the text ``null``.

    With ``legacy``, 32-bit integers appear as doubles, and all types but these and
    strings as blank cells.
    """
    if isinstance(data_type, T.StringType):
        text = column
    elif not legacy:
        text = column.cast("string")
    elif isinstance(data_type, T.IntegerType):
        text = column.cast("double").cast("string")
    else:
        text = F.when(column.isNotNull(), F.lit(""))
    return F.coalesce(text, F.lit("null"))


def percent_of(part: Column, other: Column) -> Column:
    """``part`` as percentage of ``part + other``, half-up to two places; null if both are 0."""
    share = F.try_divide(part.cast("double"), (part + other).cast("double"))
    return F.round(share * F.lit(100.0), 2)


def percent_text(value: Column) -> Column:
    return F.concat(value.cast("string"), F.lit("%"))
