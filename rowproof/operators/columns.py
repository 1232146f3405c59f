"""Comparison of the two sides' columns.

Column lists are catalog metadata: they are read from the schemas, without a Spark job.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowproof import settings


def quoted(name: str) -> Column:
    """Column reference that takes dots and backticks in a name literally."""
    return F.col("`" + name.replace("`", "``") + "`")


def lower_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.lower() for name in df.columns])


def _occurrences(df: DataFrame) -> list[tuple[str, int]]:
    """Lower-cased names, each with the number of its occurrence (1 for the first)."""
    seen: dict[str, int] = defaultdict(int)
    numbered = []
    for name in df.columns:
        seen[name.lower()] += 1
        numbered.append((name.lower(), seen[name.lower()]))
    return numbered


def common_columns(delivered: DataFrame, reference: DataFrame) -> list[str]:
    """Names on both sides, in the delivered order. A repeated name counts as often as on both."""
    other = set(_occurrences(reference))
    return [name for name, n in _occurrences(delivered) if (name, n) in other]


def columns_only_in(df: DataFrame, other: DataFrame) -> list[str]:
    """Names of ``df`` beyond those of ``other``, in order."""
    known = set(_occurrences(other))
    return [name for name, n in _occurrences(df) if (name, n) not in known]


def pick_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` with only these columns, found in any case, named in lower case."""
    actual = {name.lower(): name for name in df.columns}
    return df.select(*[quoted(actual[name]).alias(name) for name in names])


def rename_by_comment(reference: DataFrame, delivered: DataFrame) -> DataFrame:
    """Give reference columns the delivered column name that stands in their comment.

    The comment must equal a delivered name exactly. All renames happen at once, so two
    columns may swap names. If two columns share a comment, the later one gets the name.
    """
    wanted = set(delivered.columns)
    owner = {}
    for position, field in enumerate(reference.schema.fields):
        comment = field.metadata.get("comment")
        if comment in wanted:
            owner[comment] = position
    target = {position: comment for comment, position in owner.items()}
    return reference.toDF(
        *[target.get(i, field.name) for i, field in enumerate(reference.schema.fields)]
    )


def schema_rows(df: DataFrame) -> DataFrame:
    """The schema as rows ``(position, name, type, nullable, comment)``."""
    rows = [
        (i, f.name, f.dataType.simpleString(), f.nullable, f.metadata.get("comment"))
        for i, f in enumerate(df.schema.fields, start=1)
    ]
    return df.sparkSession.createDataFrame(
        rows, "position int, name string, type string, nullable boolean, comment string"
    )


def column_list(spark: SparkSession, names: list[str]) -> DataFrame:
    return spark.createDataFrame(list(enumerate(names, start=1)), "position int, name string")


def column_counts(reference: DataFrame, delivered: DataFrame) -> DataFrame:
    """Sheet of the two column counts."""
    rows = [
        (settings.LABEL_REFERENCE, len(reference.columns)),
        (settings.LABEL_DELIVERED, len(delivered.columns)),
    ]
    return reference.sparkSession.createDataFrame(rows, "table_type string, n_columns int")


def columns_side_by_side(reference: DataFrame, delivered: DataFrame) -> DataFrame:
    """Sheet of delivered columns: present in the reference, and not, padded with ``''``."""
    present = common_columns(delivered, reference)
    absent = columns_only_in(delivered, reference)
    depth = max(len(present), len(absent))
    padded = [names + [""] * (depth - len(names)) for names in (present, absent)]
    return reference.sparkSession.createDataFrame(
        [(i, *pair) for i, pair in enumerate(zip(*padded), start=1)],
        "row_no int, present_columns string, not_present_columns string",
    )
