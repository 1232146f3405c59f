"""Landing a delivered table in the catalog."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: One task sorts and writes a bucket's file, and one reads a bucket of both sides.
BUCKET_ROWS = 500_000


def _identifier(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _table(name: str) -> str:
    return ".".join(_identifier(part) for part in name.split("."))


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def empty_clone(df: DataFrame) -> DataFrame:
    """No rows, same schema."""
    return df.where(F.lit(False))


def land_managed(df: DataFrame, name: str) -> DataFrame:
    """Replace the managed table ``name`` by the rows of ``df`` and return it."""
    df.write.mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)


def buckets_for(*sides: DataFrame, rows: int = BUCKET_ROWS, least: int = 8) -> int:
    """The number of buckets in which each of ``sides`` has about ``rows`` rows a bucket; counts the rows."""
    most = int(sides[0].sparkSession.conf.get("spark.sql.sources.bucketing.maxBuckets"))
    return min(most, max(least, *(-(-df.count() // rows) for df in sides)))


def land_bucketed(
    df: DataFrame, name: str, keys: Sequence[str], buckets: int, files_per_bucket: int = 4
) -> DataFrame:
    """Replace the managed table ``name`` by ``df``, bucketed and sorted by ``keys``, and return it.

    Two tables bucketed by the same keys, of the same types, into as many buckets are compared without a
    shuffle: Spark keeps the buckets through the union of both sides. One task reads a bucket, so let ``buckets``
    grow with the tables, as ``buckets_for`` does. Rows of a bucket are dealt over ``files_per_bucket`` writing
    tasks by all their columns, so a hot key is not written by one task. Each task writes one file of one bucket.
    """
    bucket = F.pmod(F.hash(*[F.col(_identifier(k)) for k in keys]), F.lit(buckets))
    spread = F.pmod(F.xxhash64(*[F.col(_identifier(c)) for c in df.columns]), F.lit(files_per_bucket))
    dealt = df.repartitionById(buckets * files_per_bucket, (bucket * files_per_bucket + spread).cast("int"))
    dealt.write.bucketBy(buckets, *keys).sortBy(*keys).mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)


def land_external(
    spark: SparkSession, df: DataFrame, name: str, location: str, delimiter: str = ","
) -> DataFrame:
    """Register delimited files with a header as the external table ``name``; nothing is copied.

    ``df`` gives the columns. Dropping the table leaves the files in place.
    """
    columns = ", ".join(
        f"{_identifier(f.name)} {f.dataType.simpleString()}" for f in df.schema.fields
    )
    spark.sql(f"DROP TABLE IF EXISTS {_table(name)}")
    spark.sql(
        f"CREATE TABLE {_table(name)} ({columns}) USING csv "
        f"OPTIONS (header 'true', sep {_literal(delimiter)}) LOCATION {_literal(location)}"
    )
    return spark.table(name)


def write_delimited(df: DataFrame, path: str, delimiter: str = ",") -> str:
    """Write ``df`` as delimited text with headers, in as many files as it has partitions."""
    df.write.mode("overwrite").options(header=True, sep=delimiter).csv(path)
    return path
