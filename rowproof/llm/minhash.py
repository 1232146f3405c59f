"""Operator 9, near-duplicates: fast similarity sketches, banding, exact verification.

A document's set is its distinct shingles of ``k`` words (A-Z in lower case, words split at
ASCII white space). Each set gets a sketch of ``t`` coordinates by rounds of hashed bin
placement (Dahlgaard, Knudsen and Thorup, 2017): in round ``i`` every element falls into one of
the ``t`` bins, earlier rounds win, and from round ``t`` on bin ``i - t`` takes every element,
so each coordinate is filled, and few rounds are needed where the set has more elements than bins.
Bands of ``r`` coordinates bring candidates together. The number of bands follows from ``miss``,
the accepted chance to miss a pair that is just similar enough.

Equal sets are one class, found by one grouping; only classes are compared. In buckets of up to
``SMALL`` classes each pair is a candidate. Larger buckets are dealt into blocks of about
``BLOCK`` classes, and a task compares two blocks by matrix products and returns only a spanning
forest of the links, so neither a task nor the result grows with the square of a bucket. Every
link is confirmed on the full sets. Links are put together by connected components.

Defined cases: null, empty and wordless texts have the empty set, are linked with nothing, and
are kept. Fewer than ``k`` words are one shingle. Rows that repeat an id are judged by their own
texts; rows that are equal in id and text stay or go together. A null id takes part with its
text, and is nobody's smallest id as long as its group has another. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowproof.llm.common import Steps, bounded_batches, filtered, fresh, map_texts
from rowproof.llm.components import connected
from rowproof.llm.hashing import WordHashes, mix, windows

ROWS = 5
MISS = 1e-5
SMALL = 16
BLOCK = 512
_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def n_bands(percent: int, rows: int = ROWS, miss: float = MISS) -> int:
    return math.ceil(math.log(miss) / math.log(1 - (percent / 100) ** rows))


def shingles(text: bytes | None, k: int, hashes: WordHashes) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    return np.unique(windows(hashes.of(text.lower().split()), k)) if text else np.zeros(0, np.uint64)


def sketch(sets: list[np.ndarray], t: int) -> np.ndarray:
    """A row of ``t`` coordinates for each set; an empty set's row is all ones."""
    out = np.full(len(sets) * t, _FULL)
    element = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    for i in range(2 * t):
        if not len(element):
            break
        value = mix(element + np.uint64((i + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        place = (value % np.uint64(t)).astype(np.int64) if i < t else i - t
        np.minimum.at(out, owner * t + place, (np.uint64(i) << np.uint64(54)) | (value >> np.uint64(10)))
        open_ = (out.reshape(-1, t) == _FULL).any(axis=1)[owner]
        element, owner = element[open_], owner[open_]
    return out.reshape(-1, t)


def band_hashes(sketches: np.ndarray, rows: int) -> np.ndarray:
    n, t = sketches.shape
    cells = sketches.reshape(n, t // rows, rows)
    total = np.broadcast_to(np.arange(1, t // rows + 1, dtype=np.uint64), cells.shape[:2]).copy()
    for i in range(rows):
        total = mix(total * np.uint64(0x9E3779B97F4A7C15) + cells[:, :, i])
    return total.view(np.int64)


def _signed(x: bytes) -> int:
    return int.from_bytes(x, "little", signed=True)


def sketched(docs: DataFrame, keep: list[str], text_col: str, k: int, bands: int, rows: int, names: dict[str, str]) -> DataFrame:
    """``keep`` columns, the set's size, its 128-bit digest as two numbers, and its band hashes."""

    def make():
        hashes = WordHashes()

        def compute(texts):
            sets = [shingles(x, k, hashes) for x in texts]
            digests = [hashlib.blake2b(x.tobytes(), digest_size=16).digest() for x in sets]
            found = band_hashes(sketch(sets, bands * rows), rows)
            full = np.array([len(x) > 0 for x in sets], bool)
            offsets = np.concatenate([[0], np.cumsum(np.where(full, bands, 0))]).astype(np.int32)
            listed = pa.ListArray.from_arrays(pa.array(offsets), pa.array(found[full].ravel()))
            return [[len(x) for x in sets], [_signed(d[:8]) for d in digests], [_signed(d[8:]) for d in digests], listed]

        return compute

    fields = [(names["n"], T.LongType()), (names["a"], T.LongType()), (names["b"], T.LongType()), (names["bands"], T.ArrayType(T.LongType()))]
    return map_texts(docs, text_col, keep, fields, make, as_bytes=True)


def _sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """``node`` and ``set`` (its shingle hashes in order) of the classes in ``wanted`` (``node``, ``first``)."""

    def make():
        hashes = WordHashes()

        def compute(texts):
            sets = [shingles(x, k, hashes).tobytes() for x in texts]
            return [[_signed(hashlib.blake2b(x, digest_size=16).digest()[:8]) for x in sets], sets]

        return compute

    texts = filtered(docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")), "id", wanted.select("first"))
    found = map_texts(texts, "text", [], [("node", T.LongType()), ("set", T.BinaryType())], make, as_bytes=True)
    return found.join(wanted.select("node"), "node", "left_semi").dropDuplicates(["node"])


def _confirm_pairs(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (``a``, ``b``) whose full sets are similar enough."""
    both = pairs.join(sets.toDF("a", "set_a"), "a").join(sets.toDF("b", "set_b"), "b")

    def run(batches):
        for batch in batches:
            held = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                low, high = sorted((len(x), len(y)))
                same = 0 if 100 * low < percent * high else len(np.intersect1d(x, y, assume_unique=True))
                held.append(100 * same >= percent * (len(x) + len(y) - same))
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(held, pa.bool_()))

    return both.select("a", "b", "set_a", "set_b").mapInArrow(run, "a long, b long")


def linked_in_block(nodes: np.ndarray, side: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between two blocks, or within one."""
    n = len(nodes)
    element, owner = np.concatenate(sets), np.repeat(np.arange(n), [len(x) for x in sets])
    value, at, count = np.unique(element, return_inverse=True, return_counts=True)
    shared = np.flatnonzero(count > 1)
    number = np.full(len(value), -1)
    number[shared] = np.arange(len(shared))
    column = number[at]
    owner, column = owner[column >= 0], column[column >= 0]
    same = np.zeros((n, n), np.float32)
    for start in range(0, len(shared), 4096):
        part = (column >= start) & (column < start + 4096)
        has = np.zeros((n, min(4096, len(shared) - start)), np.float32)
        has[owner[part], column[part] - start] = 1
        same += has @ has.T
    size = np.array([len(x) for x in sets])
    same = same.astype(np.int64)
    held = 100 * same >= percent * (size[:, None] + size[None, :] - same)
    held &= np.triu(np.ones((n, n), bool), 1)
    if side.any() and not side.all():
        held &= side[:, None] != side[None, :]
    parent = list(range(n))

    def top(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    forest = []
    for i, j in zip(*np.nonzero(held), strict=True):
        x, y = top(int(i)), top(int(j))
        if x != y:
            parent[max(x, y)] = min(x, y)
            forest.append((int(nodes[i]), int(nodes[j])))
    return forest


def _confirm_blocks(large: DataFrame, sets: DataFrame, percent: int, block: int) -> DataFrame:
    """Links within buckets of any size; ``large`` has ``band``, ``node`` and the bucket's ``size``."""
    parts = F.ceil(F.col("size") / block).cast("int")
    own = F.pmod(F.xxhash64("node", F.lit(5)), parts.cast("long")).cast("int")
    dealt = large.select("band", "node", own.alias("own"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("other"))
    dealt = dealt.select("band", "node", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), (F.col("own") > F.col("other")).alias("side"))

    def run(group: pa.Table) -> pa.Table:
        sets_here = [np.frombuffer(x, np.uint64) for x in group["set"].to_pylist()]
        forest = linked_in_block(np.array(group["node"].to_pylist(), np.int64), np.array(group["side"].to_pylist(), bool), sets_here, percent)
        return pa.table([pa.array([e[i] for e in forest], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return dealt.join(sets, "node").groupBy("band", "x", "y").applyInArrow(run, "a long, b long")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    k: int = 5,
    percent: int = 80,
    rows: int = ROWS,
    miss: float = MISS,
    small: int = SMALL,
    block: int = BLOCK,
) -> DataFrame:
    """``id_col``, ``n_shingles``, ``component_id`` (the smallest id reachable) and ``kept`` for every row."""
    spark = docs.sparkSession
    bounded_batches(spark)
    steps = Steps(spark, "near-duplicates")
    key = fresh("id")
    docs = docs.select(docs[id_col].alias(key), docs[text_col].alias("text"))
    names = {"n": "n_shingles", "a": "node", "b": "more", "bands": "bands"}
    members = steps.write(sketched(docs, [key], "text", k, n_bands(percent, rows, miss), rows, names))
    classes = steps.write(
        members.where("n_shingles > 0").groupBy("node", "more").agg(F.min(key).alias("first"), F.first("bands").alias("bands"))
    )
    placed = classes.select("node", F.explode("bands").alias("band"))
    sizes = placed.groupBy("band").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    shared = steps.write(placed.join(sizes, "band"))
    wanted = steps.write(shared.select("node").distinct().join(classes.select("node", "first"), "node"))
    sets = steps.write(_sets(docs, wanted, key, "text", k))
    listed = shared.where(F.col("size") <= small).groupBy("band").agg(F.array_sort(F.collect_set("node")).alias("nodes"))
    pair = F.expr("explode(flatten(transform(nodes, (x, i) -> transform(slice(nodes, i + 2, size(nodes)), y -> struct(x as a, y as b)))))")
    pairs = listed.select(pair.alias("p")).select("p.a", "p.b").distinct()
    links = steps.write(
        _confirm_pairs(pairs, sets, percent).union(_confirm_blocks(shared.where(F.col("size") > small), sets, percent, block))
    )
    roots = connected(links, steps)
    grouped = classes.select("node", "first").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = grouped.groupBy("root").agg(F.min("first").alias("component_id"))
    labels = grouped.join(least, "root").select("node", "component_id").groupBy("node").agg(F.min("component_id").alias("component_id"))
    out = members.select(key, "n_shingles", F.when(F.col("n_shingles") > 0, F.col("node")).alias("node")).join(labels, "node", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col(key))
    out = out.select(key, "n_shingles", component.alias("component_id"))
    return out.select(F.col(key).alias(id_col), "n_shingles", "component_id", F.col(key).eqNullSafe(F.col("component_id")).alias("kept"))
