"""The shape of the plans: what is read, shuffled and broadcast."""

import re

import pytest

from pyspark.sql import functions as F
from rowproof import CompareSpec, compare
from rowproof.sinks import landing


@pytest.fixture
def sides(spark, tmp_path):
    spark.range(20000).selectExpr("id AS k", "id % 7 AS x", "uuid() AS pad").write.parquet(
        f"{tmp_path}/ref"
    )
    spark.range(500).selectExpr("id * 3 AS k", "id AS y", "uuid() AS pad").write.parquet(
        f"{tmp_path}/del"
    )
    return spark.read.parquet(f"{tmp_path}/ref"), spark.read.parquet(f"{tmp_path}/del")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_only_keys_are_read(sides):
    reference, delivered = sides
    result = compare(reference, delivered, "k")
    for df in (result.summary(), result.keys_status(), result.presence(), result.keys_present()):
        assert set(re.findall(r"ReadSchema: (\S+)", plan(df))) == {"struct<k:bigint>"}


def test_summary_reads_each_side_once_and_shuffles_once(sides):
    text = plan(compare(*sides, "k").summary())
    assert text.count("FileScan") == 2
    assert text.count("hashpartitioning") == 1
    assert "Join" not in text
    assert "partial_count" in text


def test_status_shuffles_once(sides):
    text = plan(compare(*sides, "k").keys_status())
    assert text.count("Exchange") == 1 and "Join" not in text and "SortAggregate" not in text


def test_small_delivered_side_filters_the_reference_before_its_shuffle(sides):
    text = plan(compare(*sides, CompareSpec.of("k", small_delivered=True)).presence())
    lines = text.splitlines()
    semi = next(i for i, line in enumerate(lines) if "LeftSemi" in line)
    assert "BroadcastHashJoin" in lines[semi]
    # Directly below the semi join comes the reference scan, without a shuffle between.
    below = "\n".join(lines[semi:semi + 5])
    assert "/ref]" in below and "Exchange hash" not in below.split("/ref]")[0]


def test_without_broadcast_the_same_results(spark, sides):
    expected = sorted(map(tuple, compare(*sides, "k").keys_delivered_only().collect()))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for small in (True, False):
            result = compare(*sides, CompareSpec.of("k", small_delivered=small))
            assert "Broadcast" not in plan(result.keys_delivered_only())
            assert sorted(map(tuple, result.keys_delivered_only().collect())) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_one_shuffle_and_no_join_by_default(sides):
    result = compare(*sides, "k")
    for df in (
        result.presence(), result.keys_present(), result.keys_delivered_only(),
        result.keys_reference_only(),
    ):
        assert "Join" not in plan(df) and plan(df).count("Exchange") == 1


def test_unreadable_texts_are_spread_over_tasks(spark, sides):
    """Values without a typed form have the null key in common; the shuffle tells them apart."""
    reference, delivered = sides
    texts = delivered.selectExpr("concat('no-', k) AS k")
    for small in (True, False):
        result = compare(reference, texts, CompareSpec.of("k", small_delivered=small))
        shuffles = re.findall(r"hashpartitioning\(([^)]*)\)", plan(result.keys_delivered_only()))
        assert "__odd_0" in shuffles[0]
        assert result.keys_delivered_only().count() == 500


def test_spellings_are_hashed_before_they_are_sorted(spark, sides):
    """Between the scans and the first shuffle there is no sort, so raw rows are only hashed."""
    reference, delivered = sides
    texts = delivered.selectExpr("concat('0', k) AS k")
    for df in (compare(reference, texts, "k").keys_status(), compare(reference, texts, "k").presence()):
        lines = plan(df).splitlines()
        last_shuffle = max(i for i, line in enumerate(lines) if "Exchange" in line)
        below = "\n".join(lines[last_shuffle:])
        assert "HashAggregate" in below and "Sort" not in below and below.count("FileScan") == 2


def test_bucketed_tables_are_compared_without_a_shuffle(spark, sides, database):
    reference, delivered = sides
    want = sorted(map(tuple, compare(reference, delivered, "k").keys_status().collect()))
    left = landing.land_bucketed(reference, f"{database}.left_side", ["k"], 4)
    right = landing.land_bucketed(delivered, f"{database}.right_side", ["k"], 4, files_per_bucket=1)
    result = compare(left, right, "k")
    for df in (result.keys_status(), result.presence(), result.keys_delivered_only(), result.keys_reference_only()):
        assert "Exchange" not in plan(df) and "Join" not in plan(df) and "Bucketed: true" in plan(df)
    assert "hashpartitioning" not in plan(result.summary())
    assert sorted(map(tuple, result.keys_status().collect())) == want


def test_tables_of_other_buckets_are_shuffled(spark, sides, database):
    reference, delivered = sides
    want = sorted(map(tuple, compare(reference, delivered, "k").keys_status().collect()))
    left = landing.land_bucketed(reference, f"{database}.left_other", ["k"], 4)
    right = landing.land_bucketed(delivered, f"{database}.right_other", ["k"], 3)
    result = compare(left, right, "k").keys_status()
    assert "Exchange" in plan(result) and sorted(map(tuple, result.collect())) == want


def test_a_hot_key_is_written_by_several_tasks(spark, database):
    rows = spark.range(4000).selectExpr("if(id % 3 = 0, null, if(id % 3 = 1, 7, id)) AS k", "id AS `x y`")
    landed = landing.land_bucketed(rows, f"{database}.hot", ["k"], 4, files_per_bucket=3)
    assert sorted(map(repr, landed.collect())) == sorted(map(repr, rows.collect()))
    assert landed.where("k = 7").select("_metadata.file_path").distinct().count() == 3
    assert len(landed.inputFiles()) <= 12
    assert landing.land_bucketed(rows.limit(0), f"{database}.hot", ["k"], 4).count() == 0


def test_buckets_grow_with_the_table_and_a_task_writes_one_file_of_one(spark, database):
    small, large = spark.range(300).toDF("k"), spark.range(5000).toDF("k")
    assert landing.buckets_for(small, large, rows=100) == landing.buckets_for(large, rows=100) == 50
    assert landing.buckets_for(small, rows=100) == landing.buckets_for(small.limit(0)) == 8
    landed = landing.land_bucketed(large, f"{database}.many", ["k"], 50, files_per_bucket=2)
    task = F.regexp_extract(F.col("_metadata.file_path"), r"part-(\d+)-.*_(\d+)\.c\d+", 1)
    bucket = F.regexp_extract(F.col("_metadata.file_path"), r"_(\d+)\.c\d+", 1)
    files = landed.select(task.alias("task"), bucket.alias("bucket")).distinct().collect()
    assert len(files) == len({r["task"] for r in files}) == 100 and len({r["bucket"] for r in files}) == 50
    assert landed.distinct().count() == 5000
