"""Reading delivered values as the reference's types."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Visible ASCII characters other than digits and signs: no integer is spelled with them.
_NEVER_IN_INTEGERS = r"[!-*,./:-~]"
_DAY = r"\s*[+-]?\d{4,6}-\d{2}-\d{2}"
_CLOCK = r"[T ]\d{1,2}:\d{1,2}(?::\d{1,2}(?:\.\d{0,6}0*)?)?"
_PLAIN_NUMBER = r"^\s*[+-]?(?:\d+\.?\d*|\.\d+)\s*$"


def _decimal_text(column: Column, data_type: T.DecimalType, typed: Column) -> Column:
    """Only texts whose value the type holds as it is; a cast alone would round them."""
    fraction = F.regexp_replace(F.regexp_extract(column, r"\.(\d*)", 1), "0+$", "")
    plain = column.rlike(_PLAIN_NUMBER) & (F.length(fraction) <= data_type.scale)
    wide = column.try_cast(T.DecimalType(38, 18))
    power = column.rlike("[eE]") & (wide == typed) & (column.try_cast("double") == typed.cast("double"))
    return F.when(plain | power, typed)


def text_as(column: Column, data_type: T.DataType) -> Column:
    """A text as ``data_type``, or null if it is no spelling of exactly such a value.

    Integers: whatever the cast accepts. Decimals: no digits beyond the scale but zeros. Dates:
    a full ``yyyy-MM-dd``, alone or with the time of midnight. Timestamps: a full day, with a
    time or without (midnight), to microseconds; a zone only where the type has one. Booleans:
    ``true`` and ``false`` in any case. Other types: whatever the cast accepts.

    A failing integer cast costs far more than a succeeding one, as it raises and catches
    an error inside; texts with other characters are therefore sorted out before it. The
    patterns for the other types do the same.
    """
    typed = column.try_cast(data_type)
    if isinstance(data_type, T.IntegralType):
        return F.when(~column.rlike(_NEVER_IN_INTEGERS), typed)
    if isinstance(data_type, T.DecimalType):
        return _decimal_text(column, data_type, typed)
    if isinstance(data_type, T.BooleanType):
        return F.when(column.rlike(r"(?i)^\s*(?:true|false)\s*$"), typed)
    if isinstance(data_type, T.DateType):
        at_midnight = column.rlike(f"^{_DAY}{_CLOCK}\\s*$") & (
            column.try_cast(T.TimestampNTZType()) == typed.cast(T.TimestampNTZType())
        )
        return F.when(column.rlike(f"^{_DAY}\\s*$") | at_midnight, typed)
    if isinstance(data_type, T.TimestampNTZType):
        return F.when(column.rlike(f"^{_DAY}(?:{_CLOCK})?\\s*$"), typed)
    if isinstance(data_type, T.TimestampType):
        return F.when(column.rlike(f"^{_DAY}(?:{_CLOCK}\\s?(?:[A-Za-z+-][A-Za-z0-9:+/_-]*)?)?\\s*$"), typed)
    return typed


def value_as(column: Column, from_type: T.DataType, to_type: T.DataType) -> Column:
    """A value as ``to_type``, or null if it is not the same value there and back."""
    if isinstance(from_type, T.StringType):
        return text_as(column, to_type)
    typed = column.try_cast(to_type)
    return F.when(typed.try_cast(from_type) == column, typed)
