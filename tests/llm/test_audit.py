import re
from collections import Counter, defaultdict
from itertools import permutations

import pytest
from oracle import connect, differences

from rowproof.llm import audit, queries

SMALL = "/root/testdata/sf0.001"


def by_hand(docs, labels):
    """Each order applied to each document; ``docs`` are (id, text, part)."""
    first = {}
    for i, text, _ in docs:
        if i is not None:
            first[text or ""] = min(first.get(text or "", i), i)
    judged = defaultdict(list)
    for i, text, part in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 50,
            "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": i is not None and text in first and i > first[text],
        }
        judged[part or ""].append(({f for f, x in fails.items() if x}, (1, None) in labels.get(i, ()), (None, 1) in labels.get(i, ())))
    rows = []
    for part, some in judged.items():
        shapley, steps = Counter(), []
        for order in map("".join, permutations("ABCDE")):
            left = some
            for step, f in enumerate(order, 1):
                out = [d for d in left if f in d[0]]
                left = [d for d in left if f not in d[0]]
                shapley[f] += len(out)
                failing = sum(f in d[0] for d in some)
                steps.append((f, (part, order, step, len(left), len(out), failing - len(out), sum(d[0] == {f} for d in some), sum(d[1] for d in out), sum(d[2] for d in out))))
        rows += [(*row, shapley[f]) for f, row in steps]
    return sorted(rows)


def prepared(labels):
    known = defaultdict(set)
    for i, quality, toxic in labels:
        known[i] |= {(1, None)} if quality == 1 else set()
        known[i] |= {(None, 1)} if toxic == 1 else set()
    return known


def test_by_hand(spark):
    long = " ".join(f"w{i}" for i in range(60))
    docs = [
        (1, long, "a"), (2, long, "b"), (3, long, "a"), (4, long + " #", "a"), (5, "X " * 60, "a"), (6, "Y", None), (7, "", ""),
        (8, None, "b"), (9, None, None), (2, long, "b"), (None, long, "a"), (None, "z", "a"), (10, "ß" * 30 + "AB", "é"), (7, "", "a"), (7, "", ""),
        (11, "v w\x0bx\x1cy z " * 30, "a"), (12, "word " * 100_000, "long"),
    ]
    labels = [(1, 1, 0), (2, 1, 1), (2, 0, None), (6, None, 1), (7, 1, 1), (None, 1, 1), (99, 1, 1), (11, 0, 1)]
    table = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, source string, n int, fails string")
    found = audit.audit(table, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert sorted(map(tuple, found.collect())) == by_hand(docs, {k: v for k, v in prepared(labels).items() if k is not None})


def test_empty_tables(spark, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit.audit(empty, labels).count() == 0
    one = spark.createDataFrame([(1, "a", "s")], "doc_id long, text string, source string")
    assert audit.audit(one, labels).count() == 600


def test_query_against_sql_and_by_hand(spark, rows):
    assert differences(spark, connect(SMALL), queries.op13_filter_audit, queries.ORACLES["op13_filter_audit"], SMALL) == ""
    labels = [tuple(r) for r in spark.read.parquet(f"{SMALL}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    want = by_hand([(r["doc_id"], r["text"], r["source"]) for r in rows], prepared(labels))
    assert sorted(map(tuple, queries.op13_filter_audit(spark, SMALL).collect())) == want


@pytest.mark.parametrize("text,bits", [(b"", 0b1000), (b"A", 0b1010), ("é".encode() * 19 + b"A", 0b1000), (b"a" * 19 + b"BB", 0b1010), (b"a|b", 0b1001)])
def test_flags(text, bits):
    assert audit.text_flags(text) == bits
