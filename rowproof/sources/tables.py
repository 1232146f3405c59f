"""Reading the two sides."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowproof import settings
from rowproof.operators.columns import quoted


def catalog_table(spark: SparkSession, database: str, table: str) -> DataFrame:
    return spark.table(f"{database}.{table}")


def delimited(spark: SparkSession, path: str, delimiter: str = ",", **options) -> DataFrame:
    """Delimited text with a header row: all columns are strings, an empty field is null,
    quoted or not.

    Files are split across tasks, so a quoted field may hold no line break unless
    ``multiLine=True`` is given. Headers are checked in every file: a file with its
    columns in another order is an error rather than misread.
    """
    reader = spark.read.options(
        header=True, sep=delimiter, inferSchema=False, enforceSchema=False
    )
    return reader.options(**options).csv(path)


CORRUPT = "__corrupt_line"


def _checked(spark: SparkSession, path: str, delimiter: str, **options) -> DataFrame:
    """All lines of delimited text; those with too few or too many cells also in ``CORRUPT``."""
    names = delimited(spark, path, delimiter, **options).columns
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, CORRUPT]])
    reader = spark.read.schema(schema).options(
        header=True, sep=delimiter, enforceSchema=False, mode="PERMISSIVE",
        columnNameOfCorruptRecord=CORRUPT, columnPruning=False,
    )
    return reader.options(**options).csv(path)


def good_lines(spark: SparkSession, path: str, delimiter: str = ",", **options) -> DataFrame:
    """``delimited`` without the lines that have too few or too many cells."""
    return _checked(spark, path, delimiter, **options).where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def rejected_lines(spark: SparkSession, path: str, delimiter: str = ",", **options) -> DataFrame:
    """The lines that ``good_lines`` leaves out: ``(path, line)``."""
    checked = _checked(spark, path, delimiter, **options)
    # Spark refuses to read the corrupt column alone, so a cell of each line is looked at too.
    looked_at = F.length(F.coalesce(quoted(checked.columns[0]), F.lit(""))) >= 0
    source = F.col("_metadata.file_path").alias("path")
    bad = checked.where(F.col(CORRUPT).isNotNull() & looked_at)
    return bad.select(source, F.col(CORRUPT).alias("line"))


def is_parquet(path: str) -> bool:
    return path.rstrip("/").lower().endswith(".parquet")


def delivered_table(spark: SparkSession, path: str, delimiter: str = ",") -> DataFrame:
    """A delivered drop: Parquet by its suffix, else the good lines of delimited text."""
    if is_parquet(path):
        return spark.read.parquet(path)
    return good_lines(spark, path, delimiter)


def rows(spark: SparkSession, data: Iterable[Sequence], names: Sequence[str] | str) -> DataFrame:
    """A DataFrame of given rows with these column names, or this schema."""
    return spark.createDataFrame(list(data), names)


def as_view(df: DataFrame, name: str = settings.DELIVERED_VIEW) -> DataFrame:
    """Register ``df`` for SQL under ``name`` and return the view."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)
