"""Which keys occur on both sides, or on one.

Two plan shapes, both without any hint:

* ``tally`` and ``key_sides`` mark the key columns of both sides, union them and group
  once. One shuffle serves all three results; hot keys are combined before it.
* On request, for a small delivered side, the reference is first reduced to the delivered keys by a semi
  join: as long as Spark finds these small enough to broadcast, no unmatched reference row
  is shuffled, and beyond that the same plan runs as a sort-merge join of two distinct
  sides. For a delivered side known to be large the reduction is left out, since it would
  shuffle the delivered keys twice.

Both sides are made distinct by grouping, never by joining raw rows: a key that holds a
third of a table is one row per map task afterwards.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowproof.functions.casting import value_as
from rowproof.operators.columns import quoted
from rowproof.spec import require_keys

BOTH = "both"
DELIVERED_ONLY = "delivered_only"
REFERENCE_ONLY = "reference_only"

# Columns of the frames in here begin with two underscores, so that keys may have any name.
PRESENT = "__present"
_SPELLED = "__spelled"


def _field(df: DataFrame, key: str) -> T.StructField:
    return next(f for f in df.schema.fields if f.name.lower() == key)


@dataclass(frozen=True)
class KeyPair:
    """The key columns of both sides, in comparable types.

    ``reference`` has the keys. ``delivered`` has them as the reference's types; where a
    value has no such form, its key is null and the value itself stands in ``__odd_<n>``,
    so that it matches nothing yet stays apart from other such values. ``__spelled`` holds
    delivered texts that were read as another type.
    """

    keys: tuple[str, ...]
    reference: DataFrame
    delivered: DataFrame
    mixed: tuple[int, ...]
    delivered_types: tuple[T.DataType, ...]

    @property
    def odd(self) -> list[str]:
        return [f"__odd_{i}" for i in self.mixed]

    @property
    def spelled(self) -> list[int]:
        return [i for i in self.mixed if isinstance(self.delivered_types[i], T.StringType)]

    @property
    def grouping(self) -> list[Column]:
        return [quoted(name) for name in (*self.keys, *self.odd)]

    def typed_keys(self) -> list[Column]:
        """Keys in the reference's types."""
        return [quoted(k) for k in self.keys]

    def delivered_keys(self) -> list[Column]:
        """Keys as they were delivered."""
        columns = []
        for i, key in enumerate(self.keys):
            if i not in self.mixed:
                column = quoted(key)
            elif i in self.spelled:
                column = F.col(f"{_SPELLED}.s{i}")
            else:
                column = F.coalesce(
                    quoted(key).try_cast(self.delivered_types[i]), F.col(f"__odd_{i}")
                )
            columns.append(column.alias(key))
        return columns


def pair_keys(reference: DataFrame, delivered: DataFrame, keys: tuple[str, ...]) -> KeyPair:
    """Project both sides to their keys and bring the delivered ones to the reference's types.

    A delivered text is cast; what does not parse matches nothing. A value of any other type
    must survive the way to the reference's type and back, so 1.5 is not 1.
    """
    require_keys(reference, delivered, keys)
    left, right, mixed, types, texts = [], [], [], [], []
    for i, key in enumerate(keys):
        ref_field, del_field = _field(reference, key), _field(delivered, key)
        raw = quoted(del_field.name)
        types.append(del_field.dataType)
        left.append(quoted(ref_field.name).alias(key))
        if ref_field.dataType == del_field.dataType:
            right.append(raw.alias(key))
            continue
        mixed.append(i)
        typed = value_as(raw, del_field.dataType, ref_field.dataType)
        if isinstance(del_field.dataType, T.StringType):
            texts.append(raw.alias(f"s{i}"))
        right += [typed.alias(key), F.when(typed.isNull(), raw).alias(f"__odd_{i}")]
    if texts:
        right.append(F.struct(*texts).alias(_SPELLED))
    return KeyPair(
        keys, reference.select(*left), delivered.select(*right), tuple(mixed), tuple(types)
    )


def _smallest_spelling(pair: KeyPair) -> list[Column]:
    return [F.min(_SPELLED).alias(_SPELLED)] if pair.spelled else []


def distinct_reference(pair: KeyPair) -> DataFrame:
    return pair.reference.distinct()


def distinct_delivered(pair: KeyPair, spelling: bool = False) -> DataFrame:
    """Distinct delivered keys, on request with the smallest spelling of each."""
    if spelling and pair.spelled:
        spelled = pair.delivered.select(*pair.grouping, _SPELLED).distinct()
        return spelled.groupBy(*pair.grouping).agg(*_smallest_spelling(pair))
    return pair.delivered.select(*pair.grouping).distinct()


def _wanted(pair: KeyPair) -> DataFrame:
    """Distinct delivered keys in the reference's types, for use on the right of a join."""
    return pair.delivered.select(*pair.typed_keys()).distinct()


def _typed_sides(pair: KeyPair) -> DataFrame:
    """``key_sides`` without telling apart delivered values that have no typed form."""
    typed = pair.delivered.select(*pair.typed_keys())
    return key_sides(replace(pair, delivered=typed, mixed=()))


def keys_present(pair: KeyPair, small_delivered: bool = False) -> DataFrame:
    """Keys on both sides. A null key part matches nothing."""
    if small_delivered:
        return distinct_reference(pair).join(_wanted(pair), list(pair.keys), "left_semi")
    found = F.col("__on_reference") & F.col("__on_delivered") & whole(pair)
    return _typed_sides(pair).where(found).select(*pair.typed_keys())


def keys_reference_only(pair: KeyPair) -> DataFrame:
    """Reference keys that were not delivered.

    Nearly all reference keys remain if few were delivered, so filtering them before the
    shuffle would save nothing.
    """
    lacking = F.col("__on_reference") & ~(F.col("__on_delivered") & whole(pair))
    return _typed_sides(pair).where(lacking).select(*pair.typed_keys())


def presence(pair: KeyPair, small_delivered: bool = False) -> DataFrame:
    """Each distinct delivered key with a flag ``__present``.

    The key columns are in the pair's internal form; see ``present_keys`` and ``absent_keys``.

    Delivered keys are grouped with the reference's rather than joined to them: a join would
    send all delivered values without a typed form to one task, as they share the null key.
    """
    if small_delivered:
        pair = replace(pair, reference=keys_present(pair, small_delivered=True))
    delivered = key_sides(pair, spelling=True).where("__on_delivered")
    return delivered.withColumn(PRESENT, F.col("__on_reference") & whole(pair)).drop(
        "__on_reference", "__on_delivered"
    )


def present_keys(presence_frame: DataFrame, pair: KeyPair) -> DataFrame:
    return presence_frame.where(F.col(PRESENT)).select(*pair.typed_keys())


def absent_keys(presence_frame: DataFrame, pair: KeyPair) -> DataFrame:
    return presence_frame.where(~F.col(PRESENT)).select(*pair.delivered_keys())


def keys_delivered_only(pair: KeyPair, small_delivered: bool = False) -> DataFrame:
    """Delivered keys that the reference lacks, as delivered."""
    return absent_keys(presence(pair, small_delivered), pair)


def _union(
    pair: KeyPair, marks: dict[str, tuple[Column, Column]], spelling: bool = False
) -> DataFrame:
    """Keys of both sides in one DataFrame, each side with its own value of every mark."""
    columns = [*pair.keys, *pair.odd, *([_SPELLED] if spelling else [])]
    delivered = pair.delivered.select(*[quoted(c) for c in columns])
    # Columns that only the delivered side has are null on the reference side.
    reference = pair.reference.select(
        *pair.typed_keys(),
        *[
            F.lit(None).cast(field.dataType).alias(field.name)
            for field in delivered.schema.fields[len(pair.keys):]
        ],
    )
    return reference.select("*", *[m[0].alias(name) for name, m in marks.items()]).unionAll(
        delivered.select("*", *[m[1].alias(name) for name, m in marks.items()])
    )


def tally(pair: KeyPair) -> DataFrame:
    """Each distinct key of either side with its row counts ``__n_reference, __n_delivered``."""
    yes, no = F.lit(True), F.lit(None).cast("boolean")
    marked = _union(pair, {"__n_reference": (yes, no), "__n_delivered": (no, yes)})
    return marked.groupBy(*pair.grouping).agg(
        *[F.count(n).alias(n) for n in ("__n_reference", "__n_delivered")]
    )


def key_sides(pair: KeyPair, spelling: bool = False) -> DataFrame:
    """Each distinct key of either side with ``__on_reference`` and ``__on_delivered``.

    With ``spelling``, also the smallest spelling of texts that were read as another type.
    """
    spelling = spelling and bool(pair.spelled)
    side = (F.lit(1).cast("tinyint"), F.lit(2).cast("tinyint"))
    rows, on = _union(pair, {"__side": side}, spelling), F.bit_or("__side").alias("__side")
    if spelling:
        # The smallest text takes a sorting aggregate. It comes second, over distinct spellings: each
        # task hashes its raw rows first, however many there are of a key.
        rows = rows.groupBy(*pair.grouping, _SPELLED).agg(on)
    grouped = rows.groupBy(*pair.grouping).agg(on, *(_smallest_spelling(pair) if spelling else []))
    return grouped.select(
        "*",
        (F.col("__side") != 2).alias("__on_reference"),
        (F.col("__side") != 1).alias("__on_delivered"),
    ).drop("__side")


def require_free(pair: KeyPair, name: str) -> None:
    """Raise if a result column would have the name of a key."""
    if name in pair.keys:
        raise ValueError(f"a key is named {name}; choose another name for the result column")


def whole(pair: KeyPair) -> Column:
    """No part of the key is null; only such keys can match."""
    return reduce(and_, [c.isNotNull() for c in pair.typed_keys()])


def keys_status(pair: KeyPair, label: str = "status") -> DataFrame:
    """Each distinct key labelled ``both``, ``delivered_only`` or ``reference_only``.

    The label stands in the column ``label``, which must differ from the keys.

    A key with a null part on both sides gets a row for either side. A key whose types
    differ across the sides appears as text.
    """
    require_free(pair, label)
    on_both = F.col("__on_reference") & F.col("__on_delivered")

    def labels(*names: str) -> Column:
        return F.array(*[F.lit(n) for n in names])

    labelled = key_sides(pair, spelling=True).select(
        "*",
        F.explode(
            F.when(on_both & whole(pair), labels(BOTH))
            .when(on_both, labels(DELIVERED_ONLY, REFERENCE_ONLY))
            .when(F.col("__on_delivered"), labels(DELIVERED_ONLY))
            .otherwise(labels(REFERENCE_ONLY))
        ).alias("__status"),
    )
    shown = []
    for i, (typed, delivered) in enumerate(zip(pair.typed_keys(), pair.delivered_keys())):
        if i in pair.mixed:
            typed = F.when(
                F.col("__status") == DELIVERED_ONLY, delivered.cast("string")
            ).otherwise(typed.cast("string"))
        shown.append(typed.alias(pair.keys[i]))
    return labelled.select(*shown, F.col("__status").alias(label))
