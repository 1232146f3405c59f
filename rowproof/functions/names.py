"""Names taken from paths: tables, folders and runs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rowproof import settings


def file_name(path: Column) -> Column:
    """Part of a path behind its last slash or backslash; empty if nothing follows."""
    return F.regexp_extract(path, r"([^/\\]*)$", 1)


def base_name(name: Column) -> Column:
    """A file name up to its first dot, or all of it where it has none."""
    return F.substring_index(name, ".", 1)


def table_name(path: Column, reference_table: Column | str) -> Column:
    """Table name for a delivered file; ``<reference table>_CSV`` if the path names no file."""
    fallback = F.lit(reference_table) if isinstance(reference_table, str) else reference_table
    name = F.coalesce(file_name(path), F.lit(""))
    return F.when(name == "", F.concat(fallback, F.lit(settings.TABLE_NAME_END))).otherwise(base_name(name))


def folder_of(path: Column, strict: bool = False) -> Column:
    """Part of a path up to and including its last slash or backslash.

    A path without one gives null, or with ``strict`` an error.
    """
    folder = F.regexp_extract(path, r"^((?s:.*)[/\\])", 1)
    if not strict:
        return F.when(folder != "", folder)
    complaint = F.concat(F.lit("path has no folder: "), F.coalesce(path, F.lit("null")))
    return F.when(folder != "", folder).otherwise(F.raise_error(complaint).cast("string"))


def run_name(file: Column, at: Column) -> Column:
    """Name of a run: file base name, ``_CompareData_``, and the run time.

    The time has milliseconds without trailing zeros, but one digit at least.
    """
    return F.concat(base_name(file), F.lit(settings.RUN_NAME_PART), _stamp(at))


def run_key(file: Column, at: Column) -> Column:
    """``run_name`` with all of the file name, so that no two drops share one."""
    return F.concat(file, F.lit(settings.RUN_NAME_PART), _stamp(at))


def _stamp(at: Column) -> Column:
    stamp = F.date_format(at, "yyyy-MM-dd'T'HH.mm.ss.SSS")
    return F.regexp_replace(stamp, r"(\.\d+?)0+$", "$1")
