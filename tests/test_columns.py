from files import as_set

from rowproof import compare
from rowproof.operators import columns as C


def frame(spark, *names):
    return spark.createDataFrame([tuple(range(len(names)))], list(names))


def test_lists_ignore_case_and_keep_delivered_order(spark):
    reference, delivered = frame(spark, "A", "b", "C"), frame(spark, "c", "X", "a")
    assert C.common_columns(delivered, reference) == ["c", "a"]
    assert C.columns_only_in(delivered, reference) == ["x"]
    assert C.columns_only_in(reference, delivered) == ["b"]
    assert C.lower_columns(reference).columns == ["a", "b", "c"]


def test_repeated_names_count_as_often_as_on_both_sides(spark):
    reference, delivered = frame(spark, "a"), frame(spark, "a", "A", "b")
    assert C.common_columns(delivered, reference) == ["a"]
    assert C.columns_only_in(delivered, reference) == ["a", "b"]


def test_counts_and_sheet(spark):
    reference, delivered = frame(spark, "a", "b"), frame(spark, "a", "x", "y")
    assert as_set(C.column_counts(reference, delivered)) == [("CSV Table", 3), ("Hive Table", 2)]
    assert as_set(C.columns_side_by_side(reference, delivered)) == [(1, "a", "x"), (2, "", "y")]
    assert C.columns_side_by_side(frame(spark, "a"), frame(spark, "a")).count() == 1
    assert as_set(C.column_list(spark, ["p", "q"])) == [(1, "p"), (2, "q")]


def test_rename_by_comment_from_the_catalog(spark, database):
    spark.sql(
        f"CREATE TABLE {database}.t (a INT COMMENT 'b', b INT COMMENT 'a', c INT COMMENT 'Q', "
        "d INT, e INT COMMENT 'z', f INT COMMENT 'z') USING parquet"
    )
    spark.sql(f"INSERT INTO {database}.t VALUES (1, 2, 3, 4, 5, 6)")
    renamed = C.rename_by_comment(
        spark.table(f"{database}.t"), frame(spark, "a", "b", "q", "z", "d")
    )
    # a and b swap; 'Q' is not 'q'; of two columns with one comment the later is renamed.
    assert renamed.columns == ["b", "a", "c", "d", "e", "z"]
    assert tuple(renamed.head()) == (1, 2, 3, 4, 5, 6)


def test_schema_rows(spark, database):
    spark.sql(f"CREATE TABLE {database}.s (a INT COMMENT 'first', b STRING) USING parquet")
    assert as_set(C.schema_rows(spark.table(f"{database}.s"))) == [
        (1, "a", "int", True, "first"), (2, "b", "string", True, None),
    ]


def test_pick_columns(spark):
    picked = C.pick_columns(frame(spark, "A.x", "b"), ["a.x"])
    assert picked.columns == ["a.x"] and picked.head()[0] == 0


def test_schema_rows_of_both_sides(spark):
    reference = spark.sql("SELECT 1 AS k, 'x' AS v").withMetadata("v", {"comment": "a value"})
    delivered = spark.sql("SELECT cast(NULL AS bigint) AS K")
    result = compare(reference, delivered, "k")
    assert as_set(result.schema_rows()) == [
        ("delivered", 1, "K", "bigint", True, None),
        ("reference", 1, "k", "int", False, None), ("reference", 2, "v", "string", False, "a value"),
    ]
    shown = [r["value"] for r in result.log().collect() if r["item"].endswith("schema")]
    assert shown == ["k: int not null", "v: string not null (a value)", "K: bigint"]
