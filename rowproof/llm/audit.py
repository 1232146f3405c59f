"""Operator 13, filter interaction audit: contractions of a contingency tensor.

Each document fails or passes each of five filters. Documents are counted by part of the corpus and by what they
fail, so a part's counts are a tensor of shape 2x2x2x2x2 (0 passes, 1 fails along each axis). Whatever one asks of the
filters in any order is a contraction of it: along each axis a vector selects pass, fail, or all. A step
of an order removes what passes the filters before it, fails its own, and does anything in those after. There are
3^5 such selections, computed for all parts of a batch by one ``einsum``; the 120 orders only look them up.

On Spark: one map makes a slim row of each document (flags, digest of the text), rows are counted by what they have in
common, and the counts, never documents, are brought together by part. The filter of repeated texts needs the smallest id
of each text in the table: it joins counts by text and part, so copies of one text are a few rows whatever
their number.

Defined cases: a null text counts as an empty one, a null part as the part ``''``. A document
repeats another if its id is greater than the smallest id of an identical text; rows that repeat an id and text
are no repeats of each other, and a null id is no smaller and no greater than any. Rows that repeat an id have its label
each; of several labels of an id any counts. An empty table has no parts and so no rows. Texts of any length
are read whole. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowproof.llm.common import bounded_batches, map_texts

FILTERS = "ABCDE"
MIN_WORDS = 50
MIN_DISTINCT_PERCENT = 65
MAX_CAPITAL_PERCENT = 5
SYMBOLS = b"#$%&*|"
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
WHITE = b"\x20\x09\x0a\x0b\x0c\x0d"
PASS, FAIL, ALL = 0, 1, 2
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def text_flags(text: bytes) -> int:
    """Bits of the filters A to D that a text fails, A the highest."""
    words = text.split()  # on exactly WHITE
    n_chars = len(text) if text.isascii() else len(text.decode("utf-8", "replace"))
    capitals = len(text) - len(text.translate(None, CAPITALS))
    return (
        (len(words) < MIN_WORDS) << 3
        | (100 * len(set(words)) < MIN_DISTINCT_PERCENT * len(words)) << 2
        | (100 * capitals > MAX_CAPITAL_PERCENT * n_chars) << 1
        | (len(text.translate(None, SYMBOLS)) < len(text))
    )


def _flagged(docs: DataFrame, id_col: str, text_col: str, part_col: str) -> DataFrame:
    """``id``, ``part``, ``fails`` (bits of A to D) and ``same`` (a digest of the text) of each document."""

    def make():
        def compute(texts: list) -> list:
            texts = [t or b"" for t in texts]
            return [pa.array([text_flags(t) for t in texts], pa.int32()), pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())]

        return compute

    slim = docs.select(
        docs[id_col].alias("id"), F.coalesce(docs[part_col].cast("string"), F.lit("")).alias("part"), docs[text_col].cast("string").alias("text")
    )
    return map_texts(slim, "text", ["id", "part"], [("fails", T.IntegerType()), ("same", T.BinaryType())], make, as_bytes=True)


def contingency(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source"
) -> DataFrame:
    """``part``, ``fails`` (bits of A to E), and how many documents there are: ``n``, ``n_good``, ``n_toxic``."""
    bounded_batches(docs.sparkSession)
    rows = _flagged(docs, id_col, text_col, part_col).groupBy("id", "part", "fails", "same").agg(F.count(F.lit(1)).alias("k"))
    known = labels.groupBy(labels[id_col].alias("id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    marks = [F.coalesce(c, F.lit(0)).alias(c) for c in ("good", "toxic")]
    labelled = rows.join(known, "id", "left").select("id", "part", "fails", "same", "k", *marks)
    kinds = ["part", "fails", "good", "toxic"]
    # rows of one text, part and label: how many, their least id, and how many have it; a null id is never the least
    grouped = labelled.groupBy("same", *kinds).agg(
        F.sum("k").alias("n"), F.sum(F.when(F.col("id").isNull(), F.col("k")).otherwise(0)).alias("n_null"), F.min("id").alias("least"), F.min_by("k", "id").alias("n_least")
    )
    first = grouped.groupBy("same").agg(F.min("least").alias("first"))
    here = F.when(F.col("least") == F.col("first"), F.col("n_least")).otherwise(0) + F.col("n_null")
    split = grouped.join(first, "same").select(*kinds, "n", here.alias("n_first"))
    counted = split.groupBy(*kinds).agg(F.sum("n").alias("n"), F.sum("n_first").alias("n_first"))
    both = counted.select("part", "good", "toxic", F.inline(F.array(
        F.struct((F.col("fails") * 2).alias("fails"), F.col("n_first").alias("n")),
        F.struct((F.col("fails") * 2 + 1).alias("fails"), (F.col("n") - F.col("n_first")).alias("n")),
    )))
    return both.where("n > 0").groupBy("part", "fails").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("n_good"), F.sum(F.col("n") * F.col("toxic")).alias("n_toxic")
    )


def selections(counts: np.ndarray) -> dict[tuple[int, ...], np.ndarray]:
    """Sums over documents of each way to select pass, fail or all along each axis.

    ``counts`` has the axes kind, part, and the five filters; a selection has kind and part.
    """
    ways = np.array(list(product((PASS, FAIL, ALL), repeat=len(FILTERS))))
    vectors = np.array([[1, 0], [0, 1], [1, 1]], np.int64)[ways]
    sums = np.einsum("kpabcde,sa,sb,sc,sd,se->skp", counts, *(vectors[:, i] for i in range(len(FILTERS))), optimize=True)
    return {tuple(way): s for way, s in zip(ways.tolist(), sums, strict=True)}


def interactions(counts: np.ndarray) -> Iterator[tuple[str, int, tuple[np.ndarray, ...]]]:
    """For each order and step, the seven ``COUNTS``, each an array over the parts.

    ``counts`` has the axes kind (documents, good ones, toxic ones), part, and the five filters.
    """
    sums = selections(counts)

    def select(passed: set[int], failed: int | None = None) -> np.ndarray:
        return sums[tuple(FAIL if i == failed else PASS if i in passed else ALL for i in range(len(FILTERS)))]

    orders = list(permutations(range(len(FILTERS))))
    shapley = [sum(select(set(o[: o.index(i)]), i)[0] for o in orders) for i in range(len(FILTERS))]
    for order in orders:
        name = "".join(FILTERS[i] for i in order)
        for step, i in enumerate(order):
            before = set(order[:step])
            removed = select(before, i)
            yield name, step + 1, (
                select(before | {i})[0], removed[0], select(set(), i)[0] - removed[0],
                select(set(range(len(FILTERS))) - {i}, i)[0], removed[1], removed[2], shapley[i],
            )


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """For each part, order of the filters and step: ``part``, ``filter_order``, ``step`` and the seven ``COUNTS``."""
    cells = contingency(docs, labels, id_col, text_col, part_col)
    # 32 cells a part at most
    parts = cells.groupBy("part").agg(F.collect_list(F.struct("fails", "n", "n_good", "n_toxic")).alias("cells"))
    schema = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                some = batch.slice(start, 256)
                lists = some.column(1)
                flat = lists.flatten()
                fails, *values = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(4))
                counts = np.zeros((3, some.num_rows, 2 ** len(FILTERS)), np.int64)
                part = np.repeat(np.arange(some.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
                for kind, value in enumerate(values):
                    counts[kind, part, fails] = value
                tensor = counts.reshape(3, some.num_rows, *[2] * len(FILTERS))
                for name, step, numbers in interactions(tensor):
                    yield pa.RecordBatch.from_arrays(
                        [some.column(0), pa.array([name] * some.num_rows), pa.array([step] * some.num_rows, pa.int32())] + [pa.array(x, pa.int64()) for x in numbers],
                        names=["part", "filter_order", "step", *COUNTS],
                    )

    return parts.mapInArrow(run, schema)


#: The same in SQL, from the definition: each order is applied to each document.
ORACLE = r"""
WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
     w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM t),
     f AS (SELECT doc_id, part, [len(words) < 50, 100 * len(list_distinct(words)) < 65 * len(words),
                  100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text),
                  regexp_matches(text, '[#$%&*|]'),
                  coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), FALSE)] AS fails FROM w),
     g AS (SELECT f.*, coalesce(l.quality = 1, FALSE) AS good, coalesce(l.toxic = 1, FALSE) AS toxic
           FROM f LEFT JOIN labels l ON f.doc_id = l.doc_id),
     p AS (SELECT part, fails, len(list_filter(fails, lambda x: x)) AS n_fails, count(*) AS n, count_if(good) AS good, count_if(toxic) AS toxic
           FROM g GROUP BY part, fails),
     x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
     o AS (SELECT a.c || b.c || c.c || d.c || e.c AS filter_order FROM x a, x b, x c, x d, x e
           WHERE len(list_distinct([a.c, b.c, c.c, d.c, e.c])) = 5),
     s AS (SELECT filter_order, CAST(step AS INTEGER) AS step, filter_order[step] AS letter,
                  [instr('ABCDE', y) FOR y IN string_split(filter_order[1:step - 1], '') IF y <> ''] AS earlier,
                  instr('ABCDE', filter_order[step]) AS own
           FROM o, (SELECT unnest(range(1, 6)) AS step) n),
     r AS (SELECT part, filter_order, step, letter, n, good, toxic, n_fails, fails[own] AS failed,
                  len(list_filter(earlier, lambda i: fails[i])) > 0 AS gone FROM p, s),
     q AS (SELECT part, filter_order, step, letter, sum(n) FILTER (NOT gone AND NOT failed) AS kept,
                  sum(n) FILTER (NOT gone AND failed) AS removed, sum(n) FILTER (gone AND failed) AS redundant,
                  sum(n) FILTER (failed AND n_fails = 1) AS unique_fails, sum(good) FILTER (NOT gone AND failed) AS good_lost,
                  sum(toxic) FILTER (NOT gone AND failed) AS toxic_lost FROM r GROUP BY ALL)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
       coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
       coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       coalesce(sum(removed) OVER (PARTITION BY part, letter), 0)::BIGINT AS shapley FROM q
"""
