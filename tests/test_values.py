from collections import Counter
from datetime import date
from decimal import Decimal

import pytest
from files import as_set
from hypothesis import HealthCheck, given
from hypothesis import settings as hypothesis_settings
from hypothesis import strategies as st

from rowproof import compare
from rowproof.operators import reduction, values


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def by_hand(left, right):
    """Differences of rows (key, x, y), keys without nulls."""
    found = []
    keys = {r[0] for r in left if r[0] is not None} & {r[0] for r in right}
    for key in keys:
        a, b = Counter(r[1:] for r in left if r[0] == key), Counter(r[1:] for r in right if r[0] == key)

        def order(row):
            return [(v is not None, "" if v is None else str(v)) for v in row]

        rest = [sorted((x - y).elements(), key=order) for x, y in ((a, b), (b, a))]
        for i in range(max(map(len, rest))):
            one, two = (side[i] if i < len(side) else None for side in rest)
            kind = "changed" if one and two else "reference_row" if one else "delivered_row"
            for j, name in enumerate(("x", "y")):
                shown = [None if row is None or row[j] is None else str(row[j]) for row in (one, two)]
                if kind != "changed" or one[j] != two[j]:
                    found.append((key, i + 1, name, kind, *shown))
    return sorted(found, key=repr)


rows = st.lists(st.tuples(st.sampled_from([1, 1, 1, 2, 3, None]), st.sampled_from([0, 1, 10, 9, None]), st.sampled_from(["", "a", "b", None])), max_size=12)


@hypothesis_settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows, rows)
def test_multisets_of_rows(spark, left, right):
    schema = "k int, x int, y string"
    result = compare(frame(spark, left, schema), frame(spark, right, schema), "k")
    assert as_set(result.value_diff()) == by_hand(left, right)
    assert {r[0] for r in as_set(result.unequal_keys())} == {r[0] for r in by_hand(left, right)}


def test_types_are_brought_together(spark):
    left = frame(spark, [(1, Decimal("1.50"), date(2024, 2, 29), 0.0)], "k int, price decimal(9,2), day date, only_here double")
    right = frame(spark, [("01", "1.5", "2024-02-29"), ("1", "1.505", "2024-02-30"), ("x", "0", None)], "K string, PRICE string, Day string")
    assert as_set(compare(left, right, "k").value_diff()) == [
        (1, 1, "day", "delivered_row", None, "2024-02-30"), (1, 1, "price", "delivered_row", None, "1.505"),
    ]
    changed = frame(spark, [("1", "1.505", "2024-02-29")], "K string, PRICE string, Day string")
    assert as_set(compare(left, changed, "k").value_diff()) == [(1, 1, "price", "changed", "1.50", "1.505")]
    assert as_set(compare(left, changed, "k").value_diff(["DAY"])) == []


def test_floats_nulls_and_places(spark):
    schema = "k int, x double, y double, z string"
    left = frame(spark, [(1, 0.0, float("nan"), None), (2, None, 1.0, ""), (3, 1.0, 2.0, "s")], schema)
    right = frame(spark, [(1, -0.0, float("nan"), None), (2, 1.0, None, ""), (3, 1.0, 2.0, "s")], schema)
    assert {r[0] for r in as_set(compare(left, right, "k").value_diff())} == {2}


def test_refused(spark):
    side = frame(spark, [(1, 2, 3)], "k int, x int, row_no int")
    with pytest.raises(ValueError, match="row_no"):
        compare(side, side, "row_no").value_diff()
    with pytest.raises(ValueError, match="no common columns beside the keys: k"):
        compare(side, side, "k").value_diff(["k"])
    twice = side.toDF("k", "x", "X")
    with pytest.raises(ValueError, match="more than once"):
        compare(twice, twice, "k").value_diff()


@pytest.mark.parametrize("case", ["only keys", "empty"])
def test_nothing_to_compare(spark, case):
    left = frame(spark, [(1, 2)] if case == "only keys" else [], "k int, x int")
    right = frame(spark, [(1, 3)], "k int, y int") if case == "only keys" else left
    assert as_set(compare(left, right, "k").value_diff()) == []


def test_a_hot_key_is_split(spark, tmp_path):
    """All rows have one key and differ: fingerprints are combined before the shuffle, the rows' numbers come from ranges."""
    spark.range(3000).selectExpr("1 AS k", "cast(id AS string) AS v").write.parquet(f"{tmp_path}/a")
    spark.range(3000).selectExpr("1 AS k", "concat(id, 'x') AS v").write.parquet(f"{tmp_path}/b")
    left, right = spark.read.parquet(f"{tmp_path}/a"), spark.read.parquet(f"{tmp_path}/b")
    found = compare(left, right, "k").value_diff().collect()
    names = sorted(map(str, range(3000)))
    assert sorted((r["row_no"], r["reference_value"], r["delivered_value"]) for r in found) == [
        (i, a, b) for i, (a, b) in enumerate(zip(names, sorted(n + "x" for n in names), strict=True), start=1)
    ]
    sums = compare(left, right, "k").unequal_keys()._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in sums and sums.count("Exchange") == 1 and "Join" not in sums


def test_duplicates(spark):
    left = frame(spark, [(1,), (1,), (1,), (2,), (None,), (None,)], "k int")
    right = frame(spark, [("1",), ("01",), ("x",), ("x",), ("3",)], "k string")
    result = compare(left, right, "k")
    assert as_set(result.duplicate_profile()) == sorted([
        ("reference", 1, 1, 1), ("reference", 2, 1, 2), ("reference", 3, 1, 3), ("delivered", 1, 1, 1), ("delivered", 2, 2, 4),
    ])
    assert [tuple(r) for r in result.heaviest_keys(3).collect()] == [("1", 3, 2, True), (None, 2, 0, False), ("x", 0, 2, False)]


# --- reduction --------------------------------------------------------------------------


def test_filter_of_many_keys_lowers_the_shuffle(spark, tmp_path):
    """Keys that are too many to broadcast: a Bloom filter at the scan, exact results, few rows in the shuffle."""
    spark.range(400_000).selectExpr("concat('key', id) AS a", "id % 7 AS b").write.parquet(f"{tmp_path}/side")
    spark.range(400).selectExpr("concat('key', id * 1009) AS a", "id * 1009 % 7 AS b").write.parquet(f"{tmp_path}/wanted")
    side, wanted = spark.read.parquet(f"{tmp_path}/side"), spark.read.parquet(f"{tmp_path}/wanted")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for names in (["a", "b"], ["a"]):
            keys = wanted.select(*names)
            with reduction.reduced(side, keys, names, reduction.measure_keys(keys), 0) as some:
                assert some.columns == ["a", "b"]
                plan = some._jdf.queryExecution().executedPlan()
                text = plan.toString()
                got = as_set(some)
            assert got == sorted((tuple(r) for r in side.join(wanted, names, "left_semi").collect()), key=repr)
            assert text.count("partial_bloom_filter_agg") == 1 and "might_contain" in text
            written = _shuffled_rows(plan)
            assert written < 400_000 / 10, written
        assert spark.conf.get("spark.sql.optimizer.runtimeFilter.number.threshold") == "10"
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _shuffled_rows(plan):
    """Rows written to shuffles by an executed plan, from its metrics."""
    total, todo = 0, [plan]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
            continue
        if name in ("ShuffleQueryStage", "BroadcastQueryStage", "TableCacheQueryStage"):
            todo.append(node.plan())
            continue
        if name == "Exchange":
            total += node.metrics().apply("shuffleRecordsWritten").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return total


def test_filter_is_left_out_beyond_its_bounds():
    assert reduction.filter_fits(1000, 10, 80) and not reduction.filter_fits(1000, 10, 79)
    assert not reduction.filter_fits(reduction.FILTER_BYTES * 8 // reduction.FILTER_BITS + 1, 0, 1)


def test_settings_come_back(spark):
    from rowproof import storage

    key = "spark.sql.optimizer.runtime.bloomFilter.numBits"
    before = spark.conf.get(key)
    with pytest.raises(ZeroDivisionError), storage.settings_held(spark, reduction.filter_settings(5)):
        assert spark.conf.get(key) == "1024"
        1 / 0
    assert spark.conf.get(key) == before
