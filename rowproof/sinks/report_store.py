"""Report tables on disk: one folder per sheet, one partition per run.

A run is published at once: its sheets are written to folders of an attempt that nobody reads, and when all
are there, one row appended to the table ``_runs`` names the attempt. Readers take the runs and their attempts from that
table only. So a run that stops between two sheets is invisible, and one that is written again is replaced as a
whole: until the new row is there, the sheets of the attempt before are read.
"""

from __future__ import annotations

import threading
import uuid
from dataclasses import replace
from datetime import datetime
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowproof import settings, storage
from rowproof.operators import keys
from rowproof.operators.columns import quoted
from rowproof.operators.reduction import BROADCAST_BYTES, measure_keys, reduced
from rowproof.plans.compare import Comparison
from rowproof.plans.report import report_sheets

FOLDERS = {
    settings.SHEET_COLUMN_COUNTS: "column_counts",
    settings.SHEET_COLUMNS: "columns",
    settings.SHEET_KEYS_PRESENT: "keys_present",
    settings.SHEET_KEYS_ABSENT: "keys_not_present",
    settings.SHEET_PERCENT: "percentage",
}

KEY_SHEETS = (settings.SHEET_KEYS_PRESENT, settings.SHEET_KEYS_ABSENT)
_KEYS = "key_names array<string>, key_values array<string>"
SCHEMAS = {
    settings.SHEET_COLUMN_COUNTS: "table_type string, n_columns int",
    settings.SHEET_COLUMNS: "row_no int, present_columns string, not_present_columns string",
    settings.SHEET_KEYS_PRESENT: _KEYS,
    settings.SHEET_KEYS_ABSENT: _KEYS,
    settings.SHEET_PERCENT: "type string, percentage string",
}

def sheet_folder(path: str, folder: str, run_id: str) -> str:
    return f"{path.rstrip('/')}/{folder}/run_id={quote(run_id, safe=' +,@~()')}"


def written_presence(
    comparison: Comparison, folder: str, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """``presence`` of a comparison, written below ``folder`` and read back.

    The distinct delivered keys are written first, so their size and range are known
    exactly. Reference keys outside that range are not read where the files or partitions
    are ordered by key. If the delivered keys are small, or far fewer than the reference, it is also
    filtered by them before anything of it is shuffled (see ``reduction``); then both sides go through one grouping
    shuffle.
    """
    pair = comparison.pair
    delivered = storage.stage(
        keys.distinct_delivered(pair, spelling=True), f"{folder}/delivered_keys"
    )
    wanted = delivered.where(keys.whole(pair)).select(*pair.typed_keys())
    with reduced(pair.reference, wanted, list(pair.keys), measure_keys(wanted), broadcast_bytes) as reference:
        pair = replace(pair, delivered=delivered, reference=reference)
        return storage.stage(keys.presence(pair, small_delivered=False), f"{folder}/presence")


def _stored(title: str, sheet: DataFrame) -> DataFrame:
    """A sheet as it is stored: key sheets in one form for all key lists."""
    if title not in KEY_SHEETS:
        return sheet
    names = sheet.columns
    return sheet.select(
        F.array(*[F.lit(n) for n in names]).alias("key_names"),
        F.array(*[quoted(n) for n in names]).alias("key_values"),
    )


def wide_keys(sheet: DataFrame, key_names: tuple[str, ...] | list[str]) -> DataFrame:
    """A stored key sheet with a column for each of these keys, besides ``run_id``."""
    values = [F.get("key_values", F.lit(i)).alias(n) for i, n in enumerate(key_names)]
    return sheet.select(*values, "run_id")


def write_report(
    comparison: Comparison,
    path: str,
    run_id: str,
    legacy: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> dict[str, DataFrame]:
    """Write the five sheets of a run below ``path`` and return them as read back.

    Each source is read once. Writing a run again replaces it, so a repeated run is safe. What
    is written on the way is deleted when the sheets are there. A reader that has begun with the attempt before should read anew.
    """
    keys.require_free(comparison.pair, "run_id")
    spark, work = comparison.reference.sparkSession, sheet_folder(path, "_work", run_id)
    attempt, before = uuid.uuid4().hex, attempts(spark, path).where(F.col("run_id") == run_id).collect()
    presence = written_presence(comparison, f"{work}/{attempt}", broadcast_bytes)
    for title, sheet in report_sheets(comparison, presence, legacy).items():
        _stored(title, sheet).write.parquet(_attempt_folder(path, title, run_id, attempt))
    publish(spark, path, run_id, attempt, comparison.spec.keys)
    storage.remove(spark, work)
    for old in before:  # a run has few attempts
        for title in FOLDERS:
            storage.remove(spark, _attempt_folder(path, title, run_id, old["attempt"]))
    return read_report(spark, path, run_id, comparison.spec.keys)


RUNS = "run_id string, attempt string, key_names array<string>, finished_at timestamp"


def _attempt_folder(path: str, title: str, run_id: str, attempt: str) -> str:
    return f"{sheet_folder(path, FOLDERS[title], run_id)}/attempt={attempt}"


# Appends to one folder share its temporary files, so runs side by side publish one after another.
_PUBLISHING = threading.Lock()


def publish(spark: SparkSession, path: str, run_id: str, attempt: str, key_names: tuple[str, ...] | list[str]) -> None:
    """Make an attempt the run's report: one row in one file, so it is there or not."""
    row = [(run_id, attempt, list(key_names), datetime.now())]
    with _PUBLISHING:
        spark.createDataFrame(row, RUNS).coalesce(1).write.mode("append").parquet(f"{path.rstrip('/')}/_runs")


def attempts(spark: SparkSession, path: str) -> DataFrame:
    """All attempts that were finished, of all runs."""
    folder = f"{path.rstrip('/')}/_runs"
    if not storage.exists(spark, folder):
        return spark.createDataFrame([], RUNS)
    return spark.read.schema(RUNS).parquet(storage.literal_path(folder))


def finished_runs(spark: SparkSession, path: str) -> DataFrame:
    """The finished runs, each with its latest attempt: ``run_id``, ``attempt``, ``key_names``, ``finished_at``."""
    latest = F.max_by(F.struct("attempt", "key_names", "finished_at"), F.struct("finished_at", "attempt")).alias("latest")
    return attempts(spark, path).groupBy("run_id").agg(latest).select("run_id", "latest.*")


def _attempt_of(spark: SparkSession, path: str, run_id: str) -> str:
    run = finished_runs(spark, path).where(F.col("run_id") == run_id).head()
    if run is None:
        raise FileNotFoundError(f"{path} has no finished run {run_id}")
    return run["attempt"]


def read_sheet(spark: SparkSession, path: str, title: str, run_id: str, attempt: str | None = None) -> DataFrame:
    """One sheet of a finished run with its ``run_id``."""
    attempt = attempt or _attempt_of(spark, path, run_id)
    sheet = spark.read.schema(SCHEMAS[title]).parquet(storage.literal_path(_attempt_folder(path, title, run_id, attempt)))
    return sheet.withColumn("run_id", F.lit(run_id))


def read_all(spark: SparkSession, path: str, title: str) -> DataFrame:
    """One sheet of all finished runs. Key sheets hold ``key_names`` and ``key_values``, whatever a run's keys."""
    folder = f"{path.rstrip('/')}/{FOLDERS[title]}"
    if not storage.exists(spark, folder):
        return spark.createDataFrame([], SCHEMAS[title] + ", run_id string")
    sheets = spark.read.schema(SCHEMAS[title] + ", run_id string, attempt string").parquet(storage.literal_path(folder))
    finished = finished_runs(spark, path).select("run_id", "attempt")
    return sheets.join(finished, ["run_id", "attempt"], "left_semi").select(*[c for c in sheets.columns if c != "attempt"])


def read_report(
    spark: SparkSession, path: str, run_id: str, key_names: tuple[str, ...] | None = None
) -> dict[str, DataFrame]:
    """All sheets of a run; with ``key_names``, its key sheets have a column for each key."""
    attempt = _attempt_of(spark, path, run_id)
    sheets = {title: read_sheet(spark, path, title, run_id, attempt) for title in FOLDERS}
    if key_names:
        sheets |= {title: wide_keys(sheets[title], key_names) for title in KEY_SHEETS}
    return sheets
