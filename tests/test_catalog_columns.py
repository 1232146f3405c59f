from files import as_set

from rowproof.operators import catalog_columns as cc
from rowproof.operators import columns


def table(spark, names):
    return spark.range(0).select(*["id"] * len(names)).toDF(*names)


def test_lists_of_one_pair_equal_those_of_the_schemas(spark):
    reference, delivered = table(spark, ["A", "b", "a", "x y"]), table(spark, ["a", "c", "X Y", "A", "a"])
    rows = cc.column_rows(spark, {"p": (reference, delivered)})
    ordered = [r["name"] for r in cc.common_columns(rows).orderBy("position").collect()]
    assert ordered == columns.common_columns(delivered, reference) == ["a", "x y", "a"]
    only = [[r["name"] for r in cc.columns_only_on(rows, s).orderBy("position").collect()] for s in (cc.REFERENCE, cc.DELIVERED)]
    assert only == [columns.columns_only_in(reference, delivered), columns.columns_only_in(delivered, reference)] == [["b"], ["c", "a"]]
    assert as_set(cc.column_counts(rows)) == [("p", 4, 5, 3, 1, 2)]


def test_pairs_do_not_mix(spark):
    a, b = table(spark, ["k", "v"]), table(spark, ["k", "w"])
    rows = cc.column_rows(spark, {"one": (a, b), "two": (b, b), "three": (a, spark.createDataFrame([], "w int").drop("w"))})
    assert as_set(cc.column_counts(rows)) == [("one", 2, 2, 1, 1, 1), ("three", 2, 0, 0, 2, 0), ("two", 2, 2, 2, 0, 0)]
    assert cc.column_counts(cc.column_rows(spark, {})).count() == 0


def test_filled_values_are_counted_once_for_each_table(spark):
    a = spark.createDataFrame([(1, None), (2, "x"), (None, None)], "k int, `v w` string")
    b = spark.createDataFrame([], "k int, k2 array<int>")
    pairs = {"one": (a, b), "two": (b, a)}
    got = cc.filled_columns(cc.column_rows(spark, pairs), pairs)
    text = got._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("count(c1#") == 2
    assert as_set(got.select("pair", "side", "name", "status", "filled")) == sorted(
        [
            ("one", "reference", "k", "common", 2), ("one", "reference", "v w", "reference_only", 1), ("one", "delivered", "k", "common", 0),
            ("one", "delivered", "k2", "delivered_only", 0), ("two", "reference", "k", "common", 0), ("two", "reference", "k2", "reference_only", 0),
            ("two", "delivered", "k", "common", 2), ("two", "delivered", "v w", "delivered_only", 1),
        ],
        key=repr,
    )


def test_both_windows_share_one_shuffle(spark):
    rows = cc.column_rows(spark, {"p": (table(spark, ["k"]), table(spark, ["k"]))})
    text = cc.matched_columns(rows)._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1
