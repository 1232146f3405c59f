"""Picking up delivered files as they arrive, and archiving them.

``handle_drops`` keeps a ledger of the drops it has handled, by path, modification time and
length. ``land_drops`` appends feeds whose files never change: the streaming file source keeps
the list of paths already taken in its checkpoint and moves files to the archive folder when a
later batch is committed, so the files of a run's last batch are archived by the next run that
finds new ones. Lines that are no rows are kept in a table of rejects.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from datetime import datetime

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowproof import settings, storage
from rowproof.functions.names import file_name, run_key
from rowproof.sources import drops

# Files are taken however late they come; Spark's own limit is seven days behind the newest.
_ANY_AGE = "36500d"


def any_case_glob(prefix: str) -> str:
    """File glob for names that start with ``prefix`` in any case."""
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in prefix) + "*"


def _source_options(prefix: str, archive: str | None, files_per_batch: int) -> dict:
    options = {
        "pathGlobFilter": any_case_glob(prefix),
        "maxFilesPerTrigger": files_per_batch,
        "maxFileAge": _ANY_AGE,
    }
    if archive:
        options |= {"cleanSource": "archive", "sourceArchiveDir": archive}
    return options


_LINE, _SOURCE = "__line", "__source"
#: Lines that are no rows of the schema, as they were delivered.
REJECTS = "path string, line string"


def rejects_of(landed: str) -> str:
    """Where ``land_drops`` puts the rejected lines unless told otherwise: beside the landed table."""
    return landed.rstrip("/") + "_rejects"


def _query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a streaming query has kept in its checkpoint since it first started."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata", wholetext=True).head()["value"])["id"]


def _batches(spark: SparkSession, table: str, schema: T.StructType | str) -> DataFrame:
    """Rows of all batches that have been written to a table of ``land_drops``; none before the first."""
    if not storage.exists(spark, table):
        return spark.createDataFrame([], schema)
    # folders of batches are no columns, whatever the rows' columns are called
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(storage.literal_path(table))


def read_landed(spark: SparkSession, landed: str, schema: T.StructType | str) -> DataFrame:
    """What has been landed so far."""
    return _batches(spark, landed, schema)


def read_rejects(spark: SparkSession, rejects: str) -> DataFrame:
    """The lines that could not be landed so far: ``(path, line)``."""
    return _batches(spark, rejects, REJECTS)


def land_drops(
    spark: SparkSession,
    folder: str,
    landed: str,
    checkpoint: str,
    schema: T.StructType | str,
    archive: str | None = None,
    delimiter: str = ",",
    prefix: str = settings.DROP_PREFIX,
    files_per_batch: int = 1000,
    rejects: str | None = None,
) -> DataFrame:
    """Append the rows of all new drops of one schema to the Parquet table ``landed``.

    Takes what is there now, then stops, and returns all that has been landed so far. A path is
    taken once: where files are delivered again under their old names, use ``handle_drops``.

    A line with too few or too many cells, or with a cell that is no value of its column's type, is not landed:
    it goes as it is to the table ``rejects``, with its file. So every line but blank ones is in
    exactly one of the two tables. Each micro-batch has a folder of its own in both, named by the
    query and the batch's number. A batch that is repeated after a crash replaces its folders, and a
    checkpoint that starts anew leaves those of the one before.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    target = {landed: False, rejects or rejects_of(landed): True}
    incoming = (
        spark.readStream.format("csv")
        .schema(T.StructType([*schema.fields, T.StructField(_LINE, T.StringType())]))
        .options(header=True, sep=delimiter, enforceSchema=False, mode="PERMISSIVE")
        .options(columnNameOfCorruptRecord=_LINE, columnPruning=False)
        .options(**_source_options(prefix, archive, files_per_batch))
        .load(folder)
        .select("*", F.col("_metadata.file_path").alias(_SOURCE))
    )

    def write(batch: DataFrame, number: int) -> None:
        query_id = _query_id(batch.sparkSession, checkpoint)
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)  # parsed once for both tables
        try:
            for table, rejected in target.items():
                if rejected:
                    rows = batch.where(F.col(_LINE).isNotNull()).select(F.col(_SOURCE).alias("path"), F.col(_LINE).alias("line"))
                else:
                    rows = batch.where(F.col(_LINE).isNull()).drop(_LINE, _SOURCE)
                rows.write.mode("overwrite").parquet(f"{table.rstrip('/')}/query={query_id}/batch={number}")
        finally:
            batch.unpersist()

    query = (
        incoming.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return read_landed(spark, landed, schema)


class DropsFailed(RuntimeError):
    """Some drops could not be handled; the ledger has their errors."""


LEDGER = "path string, modificationTime timestamp, length bigint, name string, run_id string, outcome string, error string, taken_at timestamp"
DONE, FAILED = "done", "failed"
_IDENTITY = ["path", "modificationTime", "length"]


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """What has been handled, with the outcome; empty before the first drop."""
    if not storage.exists(spark, ledger):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(ledger)


def new_drops(
    spark: SparkSession, folder: str, ledger: str, prefix: str = settings.DROP_PREFIX, retry_failed: bool = False
) -> DataFrame:
    """Drops that the ledger doesn't know by path, modification time and length.

    A file delivered again under its old name is new, and so is one that is older than those
    taken before. With ``retry_failed``, drops that failed are new too.
    """
    known = read_ledger(spark, ledger)
    known = known.where(F.col("outcome") == DONE) if retry_failed else known
    found = drops.list_folder(spark, folder).withColumn("name", file_name(F.col("path")))
    found = found.where(F.lower("name").startswith(prefix.lower()))
    found = found.withColumn("run_id", run_key(F.col("name"), F.col("modificationTime")))
    return found.join(known.select(*_IDENTITY).distinct(), _IDENTITY, "left_anti")


def side_by_side(spark: SparkSession, call: Callable, items: Iterable, at_once: int) -> Iterator[tuple]:
    """``(item, call(item))`` as calls end, with up to ``at_once`` of them running; ``items`` is read as calls begin."""
    context, free = spark.sparkContext, list(range(at_once))

    def run(item, number: int):
        context.setLocalProperty("spark.scheduler.pool", f"drops-{number}")
        return call(item)

    with ThreadPoolExecutor(at_once) as threads:
        running: dict[Future, tuple] = {}
        items = iter(items)
        more = True
        while more or running:
            while more and free:
                try:
                    item = next(items)
                except StopIteration:
                    more = False
                    break
                number = free.pop()
                running[threads.submit(inheritable_thread_target(spark)(run), item, number)] = item, number
            for done in wait(running, return_when=FIRST_COMPLETED).done if running else ():
                item, number = running.pop(done)
                free.append(number)
                yield item, done.result()


def handle_drops(
    spark: SparkSession,
    folder: str,
    handle: Callable[[Row], None],
    ledger: str,
    archive: str | None = None,
    prefix: str = settings.DROP_PREFIX,
    files_per_batch: int = 10,
    retry_failed: bool = False,
    at_once: int = 1,
) -> DataFrame:
    """Call ``handle`` for every new drop, newest first, and return their rows of the ledger.

    A drop that fails is written to the ledger with its error, and the others go on; at the end
    ``DropsFailed`` names them. ``handle`` gets ``(path, modificationTime, length, name, run_id)`` and reads the file
    as a batch source, split over tasks. The ledger is appended after each ``files_per_batch`` drops, so after a
    crash some drops are handled again: ``handle`` must be safe to repeat. Exactly the drops
    that were handled well are moved to ``archive``.

    Up to ``at_once`` drops are handled side by side, each by a thread whose jobs have a scheduler pool of their own (with
    ``spark.scheduler.mode`` FAIR they share the executors evenly). ``handle`` must then be safe to call from several
    threads; give each call a session by ``storage.own_session`` if it uses views or settings. The ledger is written by one thread.
    """
    taken = storage.stage(
        new_drops(spark, folder, ledger, prefix, retry_failed), storage.new_folder(spark, "drops")
    )
    start = datetime.now()
    batch: list[tuple] = []
    failed: list[str] = []

    def record() -> None:
        if batch:
            spark.createDataFrame(batch, LEDGER).coalesce(1).write.mode("append").parquet(ledger)
            batch.clear()

    def attempt(drop: Row) -> str | None:
        try:
            handle(drop)
            if archive:
                again = f"{archive.rstrip('/')}/{drop['run_id'].rsplit(settings.RUN_NAME_PART, 1)[1]}"
                storage.move(spark, drop["path"], archive, again)
        except Exception as problem:  # noqa: BLE001 - one bad drop must not stop the others
            return f"{type(problem).__name__}: {problem}"
        return None

    def finish(drop: Row, error: str | None) -> None:
        if error is not None:
            failed.append(drop["name"])
        outcome = DONE if error is None else FAILED
        batch.append((*(drop[c] for c in (*_IDENTITY, "name", "run_id")), outcome, error, datetime.now()))
        if len(batch) >= files_per_batch:
            record()

    ordered = taken.orderBy(F.desc("modificationTime"), F.desc("name")).toLocalIterator()
    if at_once > 1:
        for drop, error in side_by_side(spark, attempt, ordered, at_once):
            finish(drop, error)
    else:
        for drop in ordered:
            finish(drop, attempt(drop))
    record()
    if failed:
        raise DropsFailed(f"{len(failed)} drops failed, such as {failed[:5]}; see {ledger}")
    done = read_ledger(spark, ledger).where(F.col("taken_at") >= F.lit(start))
    return done.join(taken.select(*_IDENTITY), _IDENTITY, "left_semi")
