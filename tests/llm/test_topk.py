import math
import random

import numpy as np
import pytest

from rowproof.llm import topk


def by_hand(rows, k=10, every=100):
    fine = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, q in fine:
        if i % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, v, strict=False)), j) for j, v in fine if j != i)
            out += [(i, r, j, -s) for r, (s, j) in enumerate(scores[:k], 1)]
    return sorted(out)


def found(df, **options):
    return sorted(map(tuple, topk.search_embeddings(df, **options).collect()))


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<float>, score int")


def test_embeddings(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    assert found(df) == by_hand(rows)


def test_cases(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=8)]) for i in range(350)]
    rows[200] = (200, [0.0] * 8)
    rows += [(1000 + i, rows[5][1]) for i in range(30)]  # ties
    rows += [(2000, None), (2001, [1.0, None]), (2002, [float("nan")] * 8), (2003, [float("inf")] + [0.0] * 7), (None, [1.0] * 8), (2100, []), (2101, [1.0, 2.0])]
    random.Random(1).shuffle(rows)
    assert found(frame(spark, rows)) == by_hand(rows)
    assert found(frame(spark, rows[:0])) == []
    few = [(0, [1.0, 2.0]), (1, [3.0, 4.0])]
    assert found(frame(spark, few)) == by_hand(few)


def test_large_components_are_exact(spark):
    rows = [(100, [2.0**21, 1.0]), (1, [2.0**20, 3.0]), (2, [2.0**20, 4.0]), (3, [2.0**20, 3.5])]
    df = spark.createDataFrame([(i, v) for i, v in rows], "vec_id long, embedding array<double>")
    assert found(df) == by_hand(rows)


@pytest.mark.parametrize("rows", [3, 50])
def test_pruning_loses_nothing(monkeypatch, rows):
    monkeypatch.setattr(topk, "ROWS", rows)
    rng = np.random.default_rng(4)
    vectors = rng.integers(-1000, 1000, (400, 12))
    shard = topk.Shard(np.arange(400), vectors)
    for i in range(0, 400, 37):
        scores = vectors @ vectors[i]
        want = sorted((-int(s), j) for j, s in enumerate(scores) if j != i)[:10]
        assert shard.best(i, vectors[i], 10) == [(-s, j) for s, j in want]


@pytest.mark.parametrize("huge", [1e16, -1e17, 2e17])
def test_components_beyond_64_bits_are_an_error(spark, huge):
    rows = spark.createDataFrame([(0, [1.0, 2.0]), (1, [huge, 0.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="component beyond 64 bits"):
        topk.search_embeddings(rows).collect()
    fits = spark.createDataFrame([(0, [0.0, 2.0]), (1, [8e15, 0.0])], "vec_id long, embedding array<double>")
    assert [tuple(r)[:3] for r in topk.search_embeddings(fits).select("query_id", "rank", "vec_id").collect()] == [(0, 1, 1)]
