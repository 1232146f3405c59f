"""Reducing a large side to the rows whose keys are wanted, before it is shuffled.

There are three ways, chosen by the measured size of the wanted keys:

* up to ``broadcast_bytes`` they are broadcast whole, and a semi join filters the scan;
* beyond, while they are far fewer than the side's rows, a shuffled semi join with a Bloom filter. Spark builds the
  filter by an aggregate over the wanted keys, and applies it where the side is read (its runtime filters). It is sized
  here from the measured number of keys, ``FILTER_BITS`` each, up to ``FILTER_BYTES``;
* else nothing but the range of the keys, as a reduction would only shuffle the side twice.

In every case the side is also filtered by the range of the wanted keys, which skips files and row
groups that are ordered by key. None of these loses a wanted row.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowproof import storage
from rowproof.operators.columns import quoted

# Wanted keys up to this size in total are sent to all executors, by default; measured, not guessed.
BROADCAST_BYTES = 64 * 1024 * 1024
_ROW_OVERHEAD = 24
# Bits for each key: with 16, one unwanted row in 2,000 passes.
FILTER_BITS = 16
FILTER_BYTES = 64 * 1024 * 1024
# A filter is built where the side is so many times as large as the wanted keys.
FILTER_RATIO = 8
HASH = "__key_hash"


def _row_bytes(key_rows: DataFrame) -> Column | None:
    """Upper estimate of a row's size in memory; nothing where a type has no bound."""
    size = F.lit(_ROW_OVERHEAD)
    for field in key_rows.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(quoted(field.name)), F.lit(0)) + 16
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            return None
        else:
            size = size + F.lit(24)
    return size.cast("bigint")


def _has_safe_bounds(data_type: T.DataType) -> bool:
    """Types whose values keep their order and are the same after a cast to text and back."""
    return data_type == T.StringType() or isinstance(
        data_type, (T.IntegralType, T.DateType, T.TimestampNTZType, T.DecimalType)
    )


@dataclass(frozen=True)
class KeySizes:
    """Size of some key rows, and a filter that all of them pass."""

    total_bytes: float
    within: Column | None
    n_rows: int = 0


def measure_keys(key_rows: DataFrame) -> KeySizes:
    """One aggregate over the key rows; one row reaches the driver."""
    row_bytes = _row_bytes(key_rows)
    bounded = [f for f in key_rows.schema.fields if _has_safe_bounds(f.dataType)]
    found = key_rows.agg(
        F.lit(None).cast("bigint") if row_bytes is None else F.sum(row_bytes),
        *[b(quoted(f.name)).cast("string") for f in bounded for b in (F.min, F.max)],
        F.count(F.lit(1)),
    ).head()
    within = None
    for i, field in enumerate(bounded):
        low, high = found[1 + 2 * i], found[2 + 2 * i]
        if low is not None:
            inside = quoted(field.name).between(
                F.lit(low).cast(field.dataType), F.lit(high).cast(field.dataType)
            )
            within = inside if within is None else within & inside
    return KeySizes(float("inf") if row_bytes is None else found[0] or 0, within, found[len(found) - 1])


def _broadcast_allowed(spark: SparkSession) -> bool:
    """Whether the session has broadcast joins on: -1 and 0 turn them off."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold").strip().lower()
    return not threshold.startswith("-") and bool(threshold.strip("0bkmgtp"))


def _scan_bytes(df: DataFrame) -> int:
    """Spark's estimate of a DataFrame's size: of files, their size, cut to the columns that are read."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def filter_settings(n_keys: int) -> dict[str, str]:
    """Settings under which Spark puts a Bloom filter of this many keys before a shuffled semi join."""
    runtime = "spark.sql.optimizer.runtime.bloomFilter."
    bits = max(1024, FILTER_BITS * n_keys)
    return {
        runtime + "enabled": "true",
        runtime + "creationSideThreshold": str(2**62),
        runtime + "applicationSideScanSizeThreshold": "0",
        runtime + "expectedNumItems": str(max(1, n_keys)),
        runtime + "maxNumItems": str(max(1, n_keys)),
        runtime + "numBits": str(bits),
        runtime + "maxNumBits": str(bits),
        "spark.sql.optimizer.runtimeFilter.number.threshold": "1",
    }


def filter_fits(n_keys: int, wanted_bytes: int, side_bytes: int) -> bool:
    """Whether a filter of the keys stays in its bounds, and is worth a second shuffle of what passes it."""
    return FILTER_BITS * n_keys <= 8 * FILTER_BYTES and FILTER_RATIO * wanted_bytes <= side_bytes


@contextmanager
def reduced(
    side: DataFrame, wanted: DataFrame, key_names: list[str], sizes: KeySizes, broadcast_bytes: int = BROADCAST_BYTES
) -> Iterator[DataFrame]:
    """``side`` without most of the rows, and by two of three ways all, whose keys are not among ``wanted``.

    ``wanted`` are distinct keys without nulls, read from a written table, and ``sizes`` their measure. Use the result, in a job, inside of the
    ``with`` block: the settings of the filter hold there.
    """
    spark = side.sparkSession
    whole = side if sizes.within is None else side.where(sizes.within)
    if _broadcast_allowed(spark) and sizes.total_bytes <= broadcast_bytes:
        yield whole.join(F.broadcast(wanted), key_names, "left_semi")
    elif sizes.within is not None and filter_fits(sizes.n_rows, _scan_bytes(wanted), _scan_bytes(side)):
        # Spark builds a filter only of rows that a condition selects: the range, which all wanted keys are in.
        # It builds one, of the first column of the join: composite keys make one hash for it.
        right, first = wanted.where(sizes.within), []
        if len(key_names) > 1:
            key_hash, first = F.xxhash64(*[quoted(k) for k in key_names]).alias(HASH), [HASH]
            whole, right = whole.select("*", key_hash), right.select("*", key_hash)
        with storage.settings_held(spark, filter_settings(sizes.n_rows)):
            yield whole.join(right, [*first, *key_names], "left_semi").select(*[quoted(c) for c in side.columns])
    else:
        yield whole
