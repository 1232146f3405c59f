"""Key=value settings, from text files or any DataFrame of lines.

Lines come as ``(source, line_no, line)``. ``line_no`` only needs to rise within a source.
Many sources are read in one job; each has its own settings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rowproof import settings

_BLANKS = " \t\f"


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of the text files at ``path``.

    Splits of a file are told apart by their offset, and a task numbers the lines of its
    split in rising order, so ``line_no`` follows the file without one task reading all of it.
    """
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("source"),
        F.struct(
            F.col("_metadata.file_block_start").alias("offset"),
            F.monotonically_increasing_id().alias("number"),
        ).alias("line_no"),
        F.col("value").alias("line"),
    )


def first_lines(lines: DataFrame, n: int) -> DataFrame:
    """The first ``n`` lines of each source."""
    by_line = Window.partitionBy("source").orderBy("line_no")
    return (
        lines.withColumn("__n", F.row_number().over(by_line)).where(F.col("__n") <= n).drop("__n")
    )


def _last_wins(entries: DataFrame) -> DataFrame:
    return entries.groupBy("source", "key").agg(F.max_by("value", "line_no").alias("value"))


def sheet_entries(lines: DataFrame, legacy: bool = False) -> DataFrame:
    """Settings ``(source, key, value)`` in the sheet dialect; a later duplicate key wins.

    The key is the text before the first ``=`` without ``[``, the value the text behind it
    without ``]``. Lines without ``=`` are left out; see ``sheet_rejects``. With ``legacy``,
    a value ends at a second ``=``, and a line without ``=`` is an error.
    """
    # The line is split on "=" once; a dropped value tail is the only difference of legacy.
    parts = F.split("line", "=", -1 if legacy else 2)
    if legacy:
        complaint = F.concat(F.lit("settings line without '=': "), F.col("line"))
        usable = F.when(F.size(parts) > 1, F.lit(True)).otherwise(
            F.raise_error(complaint).cast("boolean")
        )
    else:
        usable = F.col("line").contains("=")
    return _last_wins(
        lines.where(usable).select(
            "source",
            "line_no",
            F.replace(F.get(parts, F.lit(0)), F.lit("["), F.lit("")).alias("key"),
            F.replace(F.get(parts, F.lit(1)), F.lit("]"), F.lit("")).alias("value"),
        )
    )


class UnreadableSettings(ValueError):
    """Settings hold lines that are none."""


def require_readable(rejects: DataFrame, where: str) -> None:
    """Raise, naming a few of the lines, if there are any."""
    found = [row["line"] for row in rejects.select("line").limit(5).collect()]
    if found:
        raise UnreadableSettings(f"{where}: lines that are no settings, such as {found}")


def legacy_lines(lines: DataFrame) -> DataFrame:
    """The lines a legacy run reads; more lines than those in a source are an error."""
    kept = first_lines(lines, settings.SETTINGS_ROWS + 1)
    beyond = kept.groupBy("source").count().where(F.col("count") > settings.SETTINGS_ROWS)
    if not beyond.isEmpty():
        raise UnreadableSettings(f"settings have more than {settings.SETTINGS_ROWS} lines")
    return kept


def sheet_rejects(lines: DataFrame) -> DataFrame:
    """Lines that the sheet dialect cannot read: those without ``=``."""
    return lines.where(~F.coalesce(F.col("line").contains("="), F.lit(False)))


def properties_rejects(lines: DataFrame) -> DataFrame:
    """Lines that the properties dialect cannot read: no comment, not blank, without ``=``."""
    stripped = _without_margin(F.col("line"))
    comment = stripped.startswith("#") | stripped.startswith("!")
    return lines.where((F.trim(stripped) != "") & ~comment & ~stripped.contains("="))


def _without_margin(column: Column) -> Column:
    return F.ltrim(column, F.lit(_BLANKS))


def properties_entries(lines: DataFrame) -> DataFrame:
    """Settings ``(source, key, value)`` in the properties dialect; a later duplicate wins.

    Blank lines and those that start with ``#`` or ``!`` are skipped, as are lines without
    ``=``. Keys are trimmed; values lose leading blanks only.
    """
    stripped = _without_margin(F.col("line"))
    parts = F.split(stripped, "=", 2)
    return _last_wins(
        lines.where(
            ~stripped.startswith("#") & ~stripped.startswith("!") & stripped.contains("=")
        ).select(
            "source",
            "line_no",
            F.trim(F.get(parts, F.lit(0)), F.lit(_BLANKS)).alias("key"),
            _without_margin(F.get(parts, F.lit(1))).alias("value"),
        )
    )


def as_mapping(entries: DataFrame) -> dict[str, str]:
    """The entries of one run's settings as a dict; a handful of rows by nature."""
    return {row["key"]: row["value"] for row in entries.select("key", "value").collect()}
