"""Operator 8, exact top-k search by MaxScore over shards.

Every vector's components are the postings of its terms. Vectors are dealt into shards of about
``SHARD_ROWS`` rows; a task holds one shard and streams the queries past it, in batches. For a
query and a shard each term has a bound: the most it can add to a score there. Terms are ordered
by bound; the non-essential ones are those whose bounds together cannot lift a row over the
tenth score so far. Essential postings are traversed for a block of rows; the other terms are
probed only for rows that can still compete, the largest bounds first. Shards' best rows are merged.

Negative components are handled by counting a term's score from its least value in the shard,
so that all contributions are at least 0. Scores are whole numbers, computed in doubles while
they are exact below 2**53 and in Python's whole numbers beyond; a component or score beyond 64 bits is an error.

Defined cases: vectors that are null or hold a null or non-finite component, and rows with a
null id, take no part; a shorter vector is filled up with zeros. A row is "own" to a query if it has its id, and
rows that repeat a query's id are one query with the least of their vectors. Rows that repeat a candidate's
id are candidates each. Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowproof.llm.common import Steps, bounded_batches

SHARD_ROWS = 1 << 16
ROWS = 4096
SCALE = 1024


def whole(embedding: Column, scale: int = SCALE) -> Column:
    """Components as whole numbers; one beyond 64 bits is an error, as a cast would only give the nearest one within."""

    def one(x: Column) -> Column:
        scaled = F.lit(float(scale)) * x.cast("double")
        beyond = F.concat(F.lit("component beyond 64 bits: "), x.cast("string"))
        return F.when(F.abs(scaled) < F.lit(2.0**63), F.floor(scaled)).otherwise(F.raise_error(beyond).cast("long"))

    return F.transform(embedding, one)


def usable(embedding: Column) -> Column:
    fine = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return embedding.isNotNull() & F.coalesce(fine, F.lit(False))


class Shard:
    """Postings by term, with their bounds."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, rows = ids[order], vectors[order]
        self.terms = np.ascontiguousarray(rows.T)
        self.low, self.high = (rows.min(axis=0), rows.max(axis=0)) if len(rows) else (np.zeros(rows.shape[1]), np.zeros(rows.shape[1]))

    def best(self, query_id: int, query: np.ndarray, k: int) -> list[tuple[int, int]]:
        """The ``k`` best (score, id) but the query's own rows."""
        n = max(len(query), len(self.terms))
        q = np.zeros(n, object)
        q[: len(query)] = [int(x) for x in query]
        q = q[: len(self.terms)]
        most = sum(abs(int(a)) * max(abs(int(b)), abs(int(c))) for a, b, c in zip(q, self.low, self.high, strict=True))
        kind = np.float64 if most < 1 << 53 else object
        q = q.astype(kind)
        low, high = self.low.astype(kind), self.high.astype(kind)
        ends = np.stack([q * low, q * high])
        least, bound = ends.min(axis=0), ends.max(axis=0) - ends.min(axis=0)
        used = np.flatnonzero(bound != 0)
        order = used[np.argsort(bound[used].astype(np.float64), kind="stable")]
        upto = np.concatenate([np.zeros(1, kind), np.cumsum(bound[order])])  # bounds of the first terms together
        base = least.sum()
        scores, ids, threshold = np.zeros(0, kind), np.zeros(0, np.int64), None
        for start in range(0, len(self.ids), ROWS):
            rows = np.arange(start, min(start + ROWS, len(self.ids)))
            rows = rows[self.ids[rows] != query_id]
            plain = 0 if threshold is None else int(np.searchsorted(upto.astype(np.float64), float(threshold - base), side="left"))
            plain = max(0, min(plain - 1, len(order)))  # terms 0..plain-1 are non-essential
            essential = order[plain:]
            block = slice(start, min(start + ROWS, len(self.ids)))
            score = np.full(len(rows), base, kind)
            if len(essential):
                part = (q[essential] - 0) @ self.terms[essential, block].astype(kind)
                score = score + part[rows - start] - least[essential].sum()
            for end in range(plain, 0, -8):
                if threshold is not None:
                    competes = score + upto[end] >= threshold
                    rows, score = rows[competes], score[competes]
                probed = order[max(0, end - 8) : end]
                score = score + q[probed] @ self.terms[probed][:, rows].astype(kind) - least[probed].sum()
            scores, ids = np.concatenate([scores, score]), np.concatenate([ids, self.ids[rows]])
            first = np.lexsort((ids, -scores)) if kind is np.float64 else np.array(sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i])), int)
            scores, ids = scores[first[:k]], ids[first[:k]]
            threshold = scores[k - 1] if len(scores) == k else None
        return [(int(s), int(i)) for s, i in zip(scores, ids, strict=True)]


def _matrix(column: pa.ListArray) -> np.ndarray:
    """Vectors as rows, shorter ones filled up with zeros."""
    rows = [np.asarray(x, np.int64) for x in column.to_numpy(zero_copy_only=False)]
    out = np.zeros((len(rows), max(map(len, rows), default=0)), np.int64)
    for i, x in enumerate(rows):
        out[i, : len(x)] = x
    return out


def _stacked(parts: list[np.ndarray]) -> np.ndarray:
    width = max((p.shape[1] for p in parts), default=0)
    return np.concatenate([np.pad(p, ((0, 0), (0, width - p.shape[1]))) for p in parts]) if parts else np.zeros((0, 0), np.int64)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``; both inputs have ``id`` (long) and ``v`` (array of long)."""
    spark = vectors.sparkSession
    bounded_batches(spark)
    n = vectors.count()
    shards = max(1, math.ceil(n / shard_rows), min(24, math.ceil(n / 1024)))
    shard = F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int")
    queries = queries.groupBy("id").agg(F.min("v").alias("v"))
    dealt = vectors.select(shard.alias("shard"), F.lit(0).alias("query"), "id", "v").union(
        queries.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(1).alias("query"), "id", "v")
    )
    dealt = dealt.repartition(max(shards, 1), "shard").sortWithinPartitions("shard", "query", "id")

    def run(batches):
        one, parts, shard = None, [], None
        for batch in batches:
            numbers = batch.column(0).to_numpy()
            asked = batch.column(1).to_numpy()
            cuts = [0, *(np.flatnonzero((np.diff(numbers) != 0) | (np.diff(asked) != 0)) + 1), len(numbers)]
            out = []
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a == b:
                    continue
                ids, rows = batch.column(2).slice(a, b - a).to_numpy(), _matrix(batch.column(3).slice(a, b - a))
                if numbers[a] != one:
                    one, parts, shard = numbers[a], [], None
                if not asked[a]:
                    parts.append((ids, rows))
                    continue
                if shard is None:
                    shard = Shard(np.concatenate([x for x, _ in parts] or [np.zeros(0, np.int64)]), _stacked([x for _, x in parts]))
                    parts = []
                for i, q in zip(ids, rows, strict=True):
                    out += [(int(i), v, s) for s, v in shard.best(int(i), q, k)]
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], pa.int64()) for c in range(3)], names=["query_id", "vec_id", "score"])

    found = dealt.mapInArrow(run, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def search_embeddings(embeddings: DataFrame, k: int = 10, every: int = 100, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The ``k`` best of all rows for each row whose id is divisible by ``every``."""
    spark = embeddings.sparkSession
    fine = embeddings.where(usable(embeddings[vector_col]) & embeddings[id_col].isNotNull())
    vectors = Steps(spark, "top-k").write(fine.select(fine[id_col].cast("long").alias("id"), whole(fine[vector_col]).alias("v")))
    return top_k(vectors, vectors.where(F.col("id") % every == 0), k)


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS w
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.w, c.w)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
), r AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s
)
SELECT * FROM r WHERE rank <= 10
"""
