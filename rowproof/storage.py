"""Tables written between two steps of a run."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_LOCAL_ROOTS: dict[str, str] = {}


def work_root(spark: SparkSession) -> str:
    """The cluster's shared folder for intermediate tables.

    It is the one named by ``spark.checkpoint.dir``. Only a local session without that
    setting gets a folder of its own; a cluster without it is an error, because a folder
    on one machine is lost with that machine and invisible to the others.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = context.applicationId
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="rowproof-")
    return _LOCAL_ROOTS[app]


def new_folder(spark: SparkSession, label: str) -> str:
    """Path of a folder below the shared one that nothing has used yet."""
    return f"{work_root(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as Parquet and return a DataFrame that reads it back.

    The written table cuts the lineage: later steps re-read it instead of recomputing
    the inputs, and it survives the loss of executors.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path, jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    at, store = _file_system(spark, path)
    return store.exists(at)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table that this library has written."""
    at, store = _file_system(spark, path)
    store.delete(at, True)


def move(spark: SparkSession, path: str, folder: str, second_folder: str) -> str:
    """Move a file into ``folder``, or into ``second_folder`` if there is one of its name already."""
    at, store = _file_system(spark, path)
    for target in (folder, second_folder):
        place = spark._jvm.org.apache.hadoop.fs.Path(target, at.getName())
        store.mkdirs(place.getParent())
        if not store.exists(place):
            if not store.rename(at, place):
                raise OSError(f"cannot move {path} to {target}")
            return place.toString()
    raise FileExistsError(f"{path} is in the archive already")


def literal_path(path: str) -> str:
    """A path for Spark readers in which ``[``, ``{``, ``*`` and ``?`` stand for themselves."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


@contextmanager
def settings_held(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Hold these settings of the session for the jobs that run inside."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def own_session(spark: SparkSession) -> SparkSession:
    """A session with the same settings and catalog, but with views and settings of its own."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            own.conf.set(key, value)
    return own
