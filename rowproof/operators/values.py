"""Differences of values between rows of equal key, and profiles of repeated keys.

A key may have several rows on either side, so its rows are compared as multisets. First each row becomes a
fingerprint, and per key and side the fingerprints are summed: sums are combined before the shuffle, so a
hot key is one row per task, and only keys, never values, are shuffled. The keys whose
sums differ are written and measured, and both sides are reduced to their rows where they are read (see ``reduction``).
Equal rows of a key cancel by counts; what is left is numbered by ranges, so that a key with any number of rows is
split over tasks.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowproof import storage
from rowproof.functions.casting import value_as
from rowproof.operators.columns import pick_columns, quoted
from rowproof.operators.keys import KeyPair, require_free, tally, whole
from rowproof.operators.reduction import measure_keys, reduced

CHANGED, REFERENCE_ROW, DELIVERED_ROW = "changed", "reference_row", "delivered_row"
_LOW = (1 << 32) - 1


def value_columns(common: list[str], keys: tuple[str, ...], columns: list[str] | None = None) -> list[str]:
    """Common columns that are no keys, or those of them that are asked for."""
    repeated = sorted({c for c in common if common.count(c) > 1})
    if repeated:
        raise ValueError(f"columns that occur more than once cannot be compared by value: {', '.join(repeated)}")
    values = [c for c in common if c not in keys]
    if columns is None:
        return values
    wanted = [c.lower() for c in columns]
    unknown = [c for c in wanted if c not in values]
    if unknown:
        raise ValueError(f"no common columns beside the keys: {', '.join(unknown)}")
    return wanted


def _compared(reference: DataFrame, delivered: DataFrame, pair: KeyPair, values: list[str]) -> tuple[DataFrame, DataFrame]:
    """Both sides as ``__k<i>`` (keys in the reference's types), ``__v<i>``, ``__odd<i>`` and ``__shown<i>``.

    Values are compared in the reference's type. A delivered value that has no such form stands in
    ``__odd<i>`` and equals nothing of the reference. Rows with a null key part are left out.
    """
    left, right = pick_columns(reference, [*pair.keys, *values]), pick_columns(delivered, [*pair.keys, *values])
    sides = []
    for df, is_delivered in ((left, False), (right, True)):
        columns: list[Column] = []
        for i, key in enumerate(pair.keys):
            column = quoted(key)
            if is_delivered and left.schema[key].dataType != df.schema[key].dataType:
                column = value_as(column, df.schema[key].dataType, left.schema[key].dataType)
            columns.append(column.alias(f"__k{i}"))
        for i, name in enumerate(values):
            raw, odd, kind = quoted(name), F.lit(None).cast("string"), left.schema[name].dataType
            typed = raw
            if is_delivered and df.schema[name].dataType != kind:
                typed = value_as(raw, df.schema[name].dataType, kind)
                odd = F.when(typed.isNull(), raw.cast("string"))
            columns += [typed.alias(f"__v{i}"), odd.alias(f"__odd{i}"), raw.cast("string").alias(f"__shown{i}")]
        known = reduce(lambda a, b: a & b, [F.col(f"__k{i}").isNotNull() for i in range(len(pair.keys))])
        sides.append(df.select(*columns).where(known))
    return sides[0], sides[1]


def _fingerprints(side: DataFrame, n_keys: int, n_values: int, sign: int) -> DataFrame:
    """Keys with the four halves of two hashes of a row's values, each counted with ``sign``."""
    values = [F.col(f"__{kind}{i}") for i in range(n_values) for kind in ("v", "odd")]
    marked = [x for v in values for x in (v, v.isNull())]  # hashes pass over nulls
    parts = []
    for seed in (1, 2):
        h = F.xxhash64(F.lit(seed), *marked)
        parts += [F.shiftrightunsigned(h, 32), h.bitwiseAND(F.lit(_LOW))]
    return side.select(
        *[f"__k{i}" for i in range(n_keys)], F.lit(sign).alias("__side"), *[(F.lit(sign) * p).alias(f"__h{i}") for i, p in enumerate(parts)]
    )


def unequal_keys(reference: DataFrame, delivered: DataFrame, pair: KeyPair, values: list[str]) -> DataFrame:
    """Keys on both sides whose rows are not the same multiset of values, in the reference's types."""
    keys = [F.col(f"__k{i}").alias(k) for i, k in enumerate(pair.keys)]
    return _unequal(*_compared(reference, delivered, pair, values), len(pair.keys), len(values)).select(*keys)


def _unequal(left: DataFrame, right: DataFrame, n_keys: int, n_values: int) -> DataFrame:
    both = _fingerprints(left, n_keys, n_values, 1).unionAll(_fingerprints(right, n_keys, n_values, -1))
    keys = [f"__k{i}" for i in range(n_keys)]
    # Halves of 32 bits, so that sums don't overflow. Sums of 128 bits are equal for unequal rows once in 2^128.
    sums = both.groupBy(*keys).agg(
        F.count_if(F.col("__side") > 0).alias("__n_left"),
        F.count_if(F.col("__side") < 0).alias("__n_right"),
        *[F.sum(f"__h{i}").alias(f"__h{i}") for i in range(4)],
    )
    differs = reduce(or_, [F.col(f"__h{i}") != 0 for i in range(4)], F.col("__n_left") != F.col("__n_right"))
    return sums.where((F.col("__n_left") > 0) & (F.col("__n_right") > 0) & differs).select(*keys)


def _numbered(rows: DataFrame, groups: list[str], order: list[str], name: str) -> DataFrame:
    """``rows`` numbered from 1 within ``groups``, whose rows may fill many tasks.

    Rows are dealt by ranges of groups and order and written; a row's number is its place in its group's part of a
    range, and the sizes of that group's parts before.
    """
    placed = storage.stage(
        rows.repartitionByRange(*groups, *order).select("*", F.spark_partition_id().alias("__slice")),
        storage.new_folder(rows.sparkSession, "placed"),
    )
    place = F.row_number().over(Window.partitionBy("__slice", *groups).orderBy(*order))
    before = Window.partitionBy(*groups).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("__slice", *groups).agg(F.count(F.lit(1)).alias("__size"))
    offsets = sizes.select("__slice", *groups, F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__before"))
    return placed.withColumn("__place", place).join(offsets, ["__slice", *groups]).select(
        *rows.columns, (F.col("__before") + F.col("__place")).alias(name)
    )


def value_diff(reference: DataFrame, delivered: DataFrame, pair: KeyPair, common: list[str], columns: list[str] | None = None) -> DataFrame:
    """What differs between rows of equal key: the keys, ``row_no``, ``column``, ``kind``, ``reference_value``, ``delivered_value``.

    Runs jobs when called: it writes the keys whose rows differ, and these rows.

    Rows that are the same on both sides cancel each other, one for one. The rows of a key that are left are
    numbered on either side by their values in column order (as text, nulls first), and rows of equal number are compared:
    each column that is not the same, nulls being equal, is a row of kind ``changed``. Where one side
    has more rows, each column of those is a row of kind ``reference_row`` or ``delivered_row``. Values show as text, as
    they stand on their side; keys in the reference's types. Keys with a null part and keys of one side only have no rows here.
    """
    for name in ("row_no", "column", "kind", "reference_value", "delivered_value"):
        require_free(pair, name)
    values = value_columns(common, pair.keys, columns)
    n, spark = len(values), reference.sparkSession
    if not values:
        return _no_differences(pair)
    left, right = _compared(reference, delivered, pair, values)
    keys = [f"__k{i}" for i in range(len(pair.keys))]
    folder = storage.new_folder(spark, "differences")
    wanted = storage.stage(_unequal(left, right, len(keys), n), f"{folder}/keys")
    sizes = measure_keys(wanted)

    def rest(side: DataFrame, mark: int) -> DataFrame:
        cells = F.array(*[
            F.struct(F.col(f"__v{i}").cast("string").alias("v"), F.col(f"__odd{i}").alias("odd"), F.col(f"__shown{i}").alias("shown")) for i in range(n)
        ])
        with reduced(side, wanted, keys, sizes) as some:
            chosen = some.join(wanted, keys, "left_semi").select(*keys, _same(n).alias("__same"), cells.alias("__cells"), F.lit(mark).alias("__side"))
            return storage.stage(chosen, f"{folder}/{mark}")

    # Equal rows of a key cancel: what is left is the surplus of one side, with its copies.
    rows = rest(left, 1).unionAll(rest(right, -1))
    surplus = rows.groupBy(*keys, "__same").agg(
        F.sum("__side").alias("__surplus"),
        F.min(F.when(F.col("__side") > 0, F.col("__cells"))).alias("__left"),
        F.min(F.when(F.col("__side") < 0, F.col("__cells"))).alias("__right"),
    ).where("__surplus <> 0")
    is_left = F.col("__surplus") > 0
    copies = surplus.select(
        *keys, is_left.alias("__is_left"), F.when(is_left, F.col("__left")).otherwise(F.col("__right")).alias("__cells"),
        F.explode(F.sequence(F.lit(1), F.abs("__surplus").cast("int"))).alias("__copy"),
    )
    numbered = _numbered(copies, [*keys, "__is_left"], ["__cells", "__copy"], "row_no")
    # One row of either side at most for each key and number.
    paired = numbered.groupBy(*keys, "row_no").agg(
        F.min(F.when(F.col("__is_left"), F.col("__cells"))).alias("__left"), F.min(F.when(~F.col("__is_left"), F.col("__cells"))).alias("__right")
    )
    of_left, of_right = F.col("__left").isNotNull(), F.col("__right").isNotNull()
    kind = F.when(of_left & of_right, CHANGED).when(of_left, REFERENCE_ROW).otherwise(DELIVERED_ROW)
    names = F.posexplode(F.array(*[F.lit(v) for v in values])).alias("__at", "column")
    cells = paired.select("*", kind.alias("kind"), names).select(
        "*", F.get("__left", F.col("__at")).alias("__l"), F.get("__right", F.col("__at")).alias("__r")
    )
    differs = ~(F.col("__l.v").eqNullSafe(F.col("__r.v")) & F.col("__r.odd").isNull())
    return cells.where((F.col("kind") != CHANGED) | differs).select(
        *[F.col(k).alias(name) for k, name in zip(keys, pair.keys, strict=True)],
        "row_no", "column", "kind", F.col("__l.shown").alias("reference_value"), F.col("__r.shown").alias("delivered_value"),
    )


def _no_differences(pair: KeyPair) -> DataFrame:
    texts = [F.lit(None).cast("string").alias(c) for c in ("column", "kind", "reference_value", "delivered_value")]
    return pair.reference.select(*pair.typed_keys(), F.lit(None).cast("bigint").alias("row_no"), *texts).where(F.lit(False))


def _same(n: int) -> Column:
    """Rows are the same if these are: typed values and odd spellings, not how they are shown."""
    return F.struct(*[F.struct(F.col(f"__v{i}").alias(f"v{i}"), F.col(f"__odd{i}").alias(f"odd{i}")) for i in range(n)])


def column_differences(differences: DataFrame) -> DataFrame:
    """How many keys and rows differ in each column: ``column``, ``kind``, ``n_rows``, over ``value_diff``."""
    return differences.groupBy("column", "kind").agg(F.count(F.lit(1)).alias("n_rows"))


def duplicate_profile(pair: KeyPair) -> DataFrame:
    """How often keys are repeated: ``side``, ``times`` (rows of a key), ``n_keys``, ``n_rows``.

    Both sides come from one pass and the shuffle of ``tally``. Keys with a null part count as keys here.
    """
    counted = tally(pair).select(F.inline(F.array(
        F.struct(F.lit("reference").alias("side"), F.col("__n_reference").alias("times")),
        F.struct(F.lit("delivered").alias("side"), F.col("__n_delivered").alias("times")),
    ))).where("times > 0")
    return counted.groupBy("side", "times").agg(F.count(F.lit(1)).alias("n_keys"), F.sum("times").alias("n_rows"))


def heaviest_keys(pair: KeyPair, n: int = 100) -> DataFrame:
    """The ``n`` keys with most rows on either side: the keys as text, ``n_reference``, ``n_delivered``, ``present``.

    Ties go to the smaller keys. Each task keeps ``n`` rows at most.
    """
    for name in ("n_reference", "n_delivered", "present"):
        require_free(pair, name)
    shown = [F.coalesce(typed.cast("string"), given.cast("string")).alias(k) for k, typed, given in zip(pair.keys, pair.typed_keys(), _given(pair), strict=True)]
    counted = tally(pair)
    both = (F.col("__n_reference") > 0) & (F.col("__n_delivered") > 0) & whole(pair)
    rows = counted.select(*shown, F.col("__n_reference").alias("n_reference"), F.col("__n_delivered").alias("n_delivered"), both.alias("present"))
    return rows.orderBy(F.greatest("n_reference", "n_delivered").desc(), *[quoted(k) for k in pair.keys]).limit(n)


def _given(pair: KeyPair) -> list[Column]:
    """Delivered values without a typed form, null for the others."""
    return [F.col(f"__odd_{i}") if i in pair.mixed else F.lit(None).cast(T.StringType()) for i in range(len(pair.keys))]
