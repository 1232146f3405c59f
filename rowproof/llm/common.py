"""What several operators share: reading, bounded Arrow batches, maps over texts."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from rowproof.storage import new_folder

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BATCH_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Let Arrow batches end at 1 MB, so that long texts don't make them as large as 10,000 rows."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


_KEPT: dict[tuple, object] = {}


def kept(key: tuple, build: Callable[[], object]) -> object:
    """What a Python worker keeps from one task to the next, such as a tokenizer and its cache."""
    if key not in _KEPT:
        _KEPT[key] = build()
    return _KEPT[key]


def release(keep: str | None = None) -> None:
    """Drop what tasks of other operators have left in this worker, and memory that Arrow holds for later."""
    for key in [k for k in _KEPT if k[0] != keep]:
        del _KEPT[key]
    pa.default_memory_pool().release_unused()


def fresh(name: str) -> str:
    """A column name that no input column has."""
    return f"__{name}_{uuid.uuid4().hex[:8]}"


class Steps:
    """Tables written between the jobs of an operator, in the shared folder."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.folder, self.n = spark, new_folder(spark, label), 0
        self.paths: list[str] = []
        self.dropped: set[int] = set()

    def write(self, df: DataFrame, *by: str) -> DataFrame:
        """``df`` from a table of its own, in folders ``by`` these columns (then the last ones)."""
        self.n += 1
        path = f"{self.folder}/{self.n}"
        self.paths.append(path)
        df.write.partitionBy(*by).parquet(path) if by else df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *numbers: int, part: str = "") -> None:
        """Delete tables that no later step reads, by their number from 1, or of each the folder of one ``part``."""
        jvm = self.spark._jvm
        for n in numbers:
            if not part:
                self.dropped.add(n)
            path = jvm.org.apache.hadoop.fs.Path(f"{self.paths[n - 1]}/{part}".rstrip("/"))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """Hold a session setting during jobs that run inside."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def map_texts(
    docs: DataFrame,
    text_col: str,
    keep: list[str],
    fields: list[tuple[str, T.DataType]],
    make: Callable[[], Callable[[list], Iterable]],
    as_bytes: bool = False,
    keeps: str | None = None,
) -> DataFrame:
    """``keep`` columns as they are, and ``fields`` computed from the texts of a batch.

    ``make()`` runs once for each task and returns a function from a list of texts (their
    UTF-8 bytes, if ``as_bytes``) to one list or Arrow array of values for each field. ``keeps``
    is the first part of the keys under which it has things ``kept`` in the worker.
    """
    text = fresh("text")
    schema = T.StructType(
        [T.StructField(c, docs.schema[c].dataType) for c in keep]
        + [T.StructField(n, t) for n, t in fields]
    )
    names = [f.name for f in schema.fields]
    kinds = [to_arrow_type(t) for _, t in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release(keeps)
        compute = make()
        for batch in batches:
            n = batch.num_columns - 1
            texts = batch.column(n).cast(pa.binary()) if as_bytes else batch.column(n)
            columns = compute(texts.to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(n)]
                + [v if isinstance(v, pa.Array) else pa.array(v, type=k) for v, k in zip(columns, kinds, strict=True)],
                names=names,
            )

    picked = docs.select(*[docs[c] for c in keep], docs[text_col].alias(text))
    return picked.mapInArrow(run, schema)


#: Ids up to this number, 8 bytes each, are broadcast to filter a table; more are joined by a shuffle.
BROADCAST_IDS = 400_000


def filtered(df: DataFrame, column: str, ids: DataFrame, how: str = "left_semi") -> DataFrame:
    """Rows of ``df`` whose whole-number ``column`` is among ``ids`` (one written column), or is not.

    A null id is among them if they hold a null.
    """
    (name,) = ids.columns
    own = fresh(name)
    ids = ids.select(F.col(name).alias(own)).distinct()
    if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return df.join(ids, df[column].eqNullSafe(ids[own]), how)
