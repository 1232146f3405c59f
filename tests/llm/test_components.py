import random

from rowproof.llm.common import Steps
from rowproof.llm.components import connected


def test_paths_stars_and_cycles(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(1, 40)] + [(200, 201), (201, 202), (202, 200), (7, 7), (201, 200)]
    random.Random(1).shuffle(edges)
    got = dict(map(tuple, connected(spark.createDataFrame(edges, "a long, b long"), Steps(spark, "test")).collect()))
    want = {i: 0 for i in range(1, 31)} | {100 + i: 100 for i in range(1, 40)} | {201: 200, 202: 200}
    assert got == want


def test_no_edges(spark):
    assert connected(spark.createDataFrame([], "a long, b long"), Steps(spark, "test")).count() == 0
