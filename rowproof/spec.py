"""What to compare: key columns and how the delivered side is read."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame

from rowproof import settings


class MissingKeys(ValueError):
    """A key column is absent on one side, or occurs there more than once."""


def parse_keys(text: str | None) -> tuple[str, ...]:
    """Lower-cased key names of a comma-separated list, in order."""
    names = [part.strip() for part in (text or "").lower().rstrip(", ").split(",")]
    if not all(names):
        raise ValueError(f"key list is empty or has a blank name: {text!r}")
    if len(set(names)) < len(names):
        raise ValueError(f"key list names a column twice: {text!r}")
    return tuple(names)


@dataclass(frozen=True)
class CompareSpec:
    """Keys of a comparison, and what is known of its two sides.

    ``small_delivered`` says that the distinct delivered keys are far fewer than the
    reference's, so that reducing the reference to them first pays. It only chooses the plan;
    results are the same.
    """

    keys: tuple[str, ...]
    small_delivered: bool = False
    reference_table: str | None = None
    delimiter: str = ","

    @classmethod
    def of(cls, keys: str | list[str] | tuple[str, ...], **known) -> CompareSpec:
        return cls(parse_keys(keys if isinstance(keys, str) else ",".join(keys)), **known)

    @classmethod
    def from_settings(cls, values: Mapping[str, str]) -> CompareSpec:
        for needed in (settings.PRIMARY_KEYS, settings.REFERENCE_DATABASE, settings.REFERENCE_TABLE):
            if not (values.get(needed) or "").strip():
                raise ValueError(f"setting {needed} is missing")
        return cls(
            keys=parse_keys(values[settings.PRIMARY_KEYS]),
            reference_table=(
                f"{values[settings.REFERENCE_DATABASE].strip()}"
                f".{values[settings.REFERENCE_TABLE].strip()}"
            ),
            delimiter=values.get(settings.DELIVERED_DELIMITER) or ",",
        )


def require_keys(reference: DataFrame, delivered: DataFrame, keys: tuple[str, ...]) -> None:
    """Raise unless each key names exactly one column, in any case, on both sides."""
    problems = []
    for side, df in (("reference", reference), ("delivered", delivered)):
        lowered = [name.lower() for name in df.columns]
        missing = [k for k in keys if k not in lowered]
        repeated = [k for k in keys if lowered.count(k) > 1]
        if missing:
            problems.append(f"{side} side lacks key column(s) {', '.join(missing)}")
        if repeated:
            problems.append(f"{side} side has key column(s) {', '.join(repeated)} more than once")
    if problems:
        raise MissingKeys("; ".join(problems))
