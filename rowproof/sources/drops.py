"""Which delivered file is the newest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from rowproof import settings
from rowproof.functions.names import file_name, run_key


def list_folder(spark: SparkSession, folder: str) -> DataFrame:
    """Plain files right below ``folder`` as ``(path, modificationTime, length)``.

    File contents are not read, since their column is not selected.
    """
    return (
        spark.read.format("binaryFile")
        .load(folder)
        .select("path", "modificationTime", "length")
    )


def newest_drop(
    listing: DataFrame, by: list[str] | None = None, prefix: str = settings.DROP_PREFIX
) -> DataFrame:
    """Newest file whose name starts with ``prefix``, in any case; ties go to the last name.

    ``listing`` has ``path`` and ``modificationTime``. With ``by``, one file per group.
    """
    named = listing.withColumn("name", file_name(F.col("path")))
    candidates = named.where(F.lower("name").startswith(prefix.lower()))
    newest = F.max(F.struct("modificationTime", "name", "path")).alias("newest")
    groups = by or []
    return (
        candidates.groupBy(*groups)
        .agg(newest)
        .where(F.col("newest").isNotNull())
        .select(*groups, "newest.name", "newest.modificationTime", "newest.path")
    )


def find_newest_drop(
    spark: SparkSession,
    folder: str,
    at: Column | None = None,
    prefix: str = settings.DROP_PREFIX,
) -> Row:
    """The newest drop of a folder as a row ``(name, modificationTime, path, run_id)``.

    ``run_id`` names a run over the drop at the time ``at``, by default now. Raises ``FileNotFoundError`` if
    the folder has no files, or none with the prefix.
    """
    listing = list_folder(spark, folder)
    at = F.current_timestamp() if at is None else at
    found = (
        newest_drop(listing, prefix=prefix)
        .withColumn("run_id", run_key(F.col("name"), at))
        .head()
    )
    if found is None:
        what = "is empty" if listing.isEmpty() else f"has no file named {prefix}*"
        raise FileNotFoundError(f"drop folder {folder} {what}")
    return found
