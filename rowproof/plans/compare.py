"""A comparison of two DataFrames as a set of lazy DataFrames."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowproof.operators import columns, keys, totals, values
from rowproof.spec import CompareSpec


@dataclass(frozen=True)
class Comparison:
    """Results of comparing ``delivered`` with ``reference``; nothing runs until used."""

    reference: DataFrame
    delivered: DataFrame
    spec: CompareSpec

    @cached_property
    def pair(self) -> keys.KeyPair:
        return keys.pair_keys(self.reference, self.delivered, self.spec.keys)

    def common_columns(self) -> list[str]:
        return columns.common_columns(self.delivered, self.reference)

    def delivered_only_columns(self) -> list[str]:
        return columns.columns_only_in(self.delivered, self.reference)

    def reference_only_columns(self) -> list[str]:
        return columns.columns_only_in(self.reference, self.delivered)

    def column_counts(self) -> DataFrame:
        return columns.column_counts(self.reference, self.delivered)

    def schema_rows(self) -> DataFrame:
        """Columns of both sides: ``side``, ``position``, ``name``, ``type``, ``nullable``, ``comment``."""
        sides = (("reference", self.reference), ("delivered", self.delivered))
        found = [columns.schema_rows(df).select(F.lit(side).alias("side"), "*") for side, df in sides]
        return found[0].unionAll(found[1])

    def columns_side_by_side(self) -> DataFrame:
        return columns.columns_side_by_side(self.reference, self.delivered)

    def keys_present(self) -> DataFrame:
        return keys.keys_present(self.pair, self.spec.small_delivered)

    def keys_delivered_only(self) -> DataFrame:
        return keys.keys_delivered_only(self.pair, self.spec.small_delivered)

    def keys_reference_only(self) -> DataFrame:
        return keys.keys_reference_only(self.pair)

    def keys_status(self, label: str = "status") -> DataFrame:
        return keys.keys_status(self.pair, label)

    def keys_found(self, label: str = "present") -> DataFrame:
        """Distinct delivered keys, as delivered, with a flag for those in the reference."""
        keys.require_free(self.pair, label)
        found = F.col(keys.PRESENT).alias(label)
        return self.presence().select(*self.pair.delivered_keys(), found)

    def presence(self) -> DataFrame:
        """``keys_found`` in the form that ``present_keys`` and ``absent_keys`` take."""
        return keys.presence(self.pair, self.spec.small_delivered)

    def row_totals(self) -> DataFrame:
        return totals.row_totals(self.reference, self.delivered)

    def match_percent(self) -> DataFrame:
        return totals.match_percent(totals.key_counts(self.presence()))

    def summary(self) -> DataFrame:
        return totals.summary(
            self.pair, len(self.reference.columns), len(self.delivered.columns)
        )

    def value_diff(self, only: list[str] | None = None) -> DataFrame:
        """What differs in the common columns, or in ``only`` these, between rows of equal key. Runs jobs when called."""
        return values.value_diff(self.reference, self.delivered, self.pair, self.common_columns(), only)

    def unequal_keys(self, only: list[str] | None = None) -> DataFrame:
        """Keys on both sides whose rows are not the same multiset."""
        chosen = values.value_columns(self.common_columns(), self.spec.keys, only)
        return values.unequal_keys(self.reference, self.delivered, self.pair, chosen)

    def duplicate_profile(self) -> DataFrame:
        """How many keys have how many rows, on either side."""
        return values.duplicate_profile(self.pair)

    def heaviest_keys(self, n: int = 100) -> DataFrame:
        """The keys with most rows."""
        return values.heaviest_keys(self.pair, n)

    def log(self) -> DataFrame:
        """What a run reports of itself, as numbered rows ``(step, item, value)``."""
        facts = [
            *_schema_facts("reference schema", self.reference),
            *_schema_facts("delivered schema", self.delivered),
            ("reference columns", str(len(self.reference.columns))),
            ("delivered columns", str(len(self.delivered.columns))),
            ("common columns", ",".join(self.common_columns())),
            ("delivered-only columns", ",".join(self.delivered_only_columns())),
            ("reference-only columns", ",".join(self.reference_only_columns())),
        ]
        spark = self.reference.sparkSession
        known = spark.createDataFrame(
            [(i, *fact) for i, fact in enumerate(facts, start=1)],
            "step int, item string, value string",
        )
        counted = self.summary().select(
            F.inline(
                F.array(
                    *[
                        F.struct(
                            F.lit(len(facts) + i).alias("step"),
                            F.lit(item).alias("item"),
                            F.col(column).cast("string").alias("value"),
                        )
                        for i, (item, column) in enumerate(
                            [
                                ("reference rows", "reference_rows"),
                                ("delivered rows", "delivered_rows"),
                                ("common keys", "common_keys"),
                                ("delivered-only keys", "delivered_only_keys"),
                                ("reference-only keys", "reference_only_keys"),
                            ],
                            start=1,
                        )
                    ]
                )
            )
        )
        return known.unionAll(counted)


def _schema_facts(item: str, df: DataFrame) -> list[tuple[str, str]]:
    """Name and type of each column, with ``not null`` and its comment where it has them."""
    return [
        (
            item,
            f"{field.name}: {field.dataType.simpleString()}"
            + ("" if field.nullable else " not null")
            + (f" ({field.metadata['comment']})" if field.metadata.get("comment") else ""),
        )
        for field in df.schema.fields
    ]


def compare(
    reference: DataFrame, delivered: DataFrame, spec: CompareSpec | str | list[str]
) -> Comparison:
    """Compare by ``spec``, or by the key columns given as a list or comma-separated text.

    Raises ``MissingKeys`` if a key column is absent on either side.
    """
    if not isinstance(spec, CompareSpec):
        spec = CompareSpec.of(spec)
    comparison = Comparison(reference, delivered, spec)
    comparison.pair
    return comparison
