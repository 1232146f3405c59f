"""A whole run: settings, newest drop, comparison, report.

Settings of the job are a properties file. Each drop ``<base>.<suffix>`` has settings of its
own (keys, reference table, delimiter) in ``config/<base>.properties`` below the drop folder.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from rowproof import settings, storage
from rowproof.operators.columns import rename_by_comment
from rowproof.plans.compare import Comparison, compare
from rowproof.sinks.report_store import sheet_folder, write_report
from rowproof.sources import config, drops, tables
from rowproof.spec import CompareSpec
from rowproof.streaming.intake import handle_drops


@dataclass(frozen=True)
class Run:
    """A finished run: its name, the comparison, the report tables, and how many lines were unreadable."""

    run_id: str
    comparison: Comparison
    sheets: dict[str, DataFrame]
    rejected_lines: int = 0
    settings: Mapping[str, str] = field(default_factory=dict)


def job_settings(spark: SparkSession, path: str) -> dict[str, str]:
    """Settings of the job from a properties file; a line that is none is an error."""
    lines = config.text_lines(spark, path)
    config.require_readable(config.properties_rejects(lines), path)
    return config.as_mapping(config.properties_entries(lines))


def drop_settings(spark: SparkSession, path: str, legacy: bool = False) -> dict[str, str]:
    """Settings of one drop, in the sheet dialect; a line that is none is an error."""
    lines = config.text_lines(spark, path).where(F.trim("line") != "")
    if legacy:
        return config.as_mapping(config.sheet_entries(config.legacy_lines(lines), legacy))
    config.require_readable(config.sheet_rejects(lines), path)
    return config.as_mapping(config.sheet_entries(lines))


def compare_drop(spark: SparkSession, path: str, values: Mapping[str, str]) -> Comparison:
    """Compare one delivered file with the reference table that its settings name."""
    spec = CompareSpec.from_settings(values)
    delivered = tables.as_view(tables.delivered_table(spark, path, spec.delimiter))
    reference = tables.catalog_table(spark, *spec.reference_table.split(".", 1))
    return compare(rename_by_comment(reference, delivered), delivered, spec)


def _needed(job: Mapping[str, str], name: str) -> str:
    value = (job.get(name) or "").strip()
    if not value:
        raise ValueError(f"setting {name} is missing")
    return value.rstrip("/")


def _settings_path(spark: SparkSession, folder: str, name: str) -> str:
    """The drop's own settings: by its name without the last suffix, else by its base name."""
    own, base = name.rsplit(".", 1)[0], name.split(".", 1)[0]
    path = f"{folder}/config/{own}.properties"
    return path if storage.exists(spark, path) else f"{folder}/config/{base}.properties"


def _run(spark: SparkSession, job: Mapping[str, str], drop: Row, legacy: bool) -> Run:
    folder, output = _needed(job, settings.DROP_FOLDER), _needed(job, settings.OUTPUT_PATH)
    path = _settings_path(spark, folder, drop["name"])
    values = drop_settings(spark, storage.literal_path(path), legacy)
    delivered = storage.literal_path(drop["path"])
    comparison = compare_drop(spark, delivered, values)
    rejected = write_rejects(spark, output, drop["run_id"], delivered, comparison.spec.delimiter)
    sheets = write_report(comparison, output, drop["run_id"], legacy)
    return Run(drop["run_id"], comparison, sheets, rejected, values)


def write_rejects(spark: SparkSession, output: str, run_id: str, path: str, delimiter: str) -> int:
    """Write the delivered lines that cannot be read to the report's ``rejects``, and count them."""
    if tables.is_parquet(path):
        return 0
    lines = tables.rejected_lines(spark, path, delimiter)
    return storage.stage(lines, sheet_folder(output, "rejects", run_id)).count()


def run_newest(
    spark: SparkSession, job_path: str, at: Column | None = None, legacy: bool = False
) -> Run:
    """Compare the newest drop, write its report, and archive it if the job names an archive.

    ``at`` is the run time, by default now.
    """
    job = job_settings(spark, job_path)
    drop = drops.find_newest_drop(spark, _needed(job, settings.DROP_FOLDER), at)
    run = _run(spark, job, drop, legacy)
    if archive := _archive(job):
        stamp = drop["run_id"].rsplit(settings.RUN_NAME_PART, 1)[1]
        moved = storage.move(spark, drop["path"], archive, f"{archive}/{stamp}")
        run = replace(run, comparison=compare_drop(spark, storage.literal_path(moved), run.settings))
    return run


def _archive(job: Mapping[str, str]) -> str | None:
    return (job.get(settings.ARCHIVE_FOLDER) or "").strip().rstrip("/") or None


def run_incoming(
    spark: SparkSession, job_path: str, ledger: str, legacy: bool = False, retry_failed: bool = False, at_once: int = 1
) -> DataFrame:
    """Compare every drop that the ledger lacks, write its report, and archive what was handled.

    A run is named by its drop's modification time, so a drop taken twice replaces its report.
    Raises ``DropsFailed`` after all drops if some failed. Up to ``at_once`` drops are compared side by side, each in
    a session of its own.
    """
    job = job_settings(spark, job_path)
    return handle_drops(
        spark,
        _needed(job, settings.DROP_FOLDER),
        lambda drop: _run(storage.own_session(spark) if at_once > 1 else spark, job, drop, legacy),
        ledger,
        archive=_archive(job),
        retry_failed=retry_failed,
        at_once=at_once,
    )
