import pytest
from files import as_set, put
from pyspark.sql import functions as F

from rowproof.operators.ordering import first_rows, number_rows, top_rows
from rowproof.sources import config, drops, tables

def test_newest_drop(spark, tmp_path):
    put(tmp_path, "dq_check_a.csv", at=1000)
    put(tmp_path, "DQ_Check_b.csv", at=2000)
    put(tmp_path, "dqXcheckXc.csv", at=2500)
    put(tmp_path, "other.csv", at=3000)
    put(tmp_path, "sub/dq_check_z.csv", at=4000)
    at = F.lit("2024-01-02 03:04:05").cast("timestamp_ntz")
    found = drops.find_newest_drop(spark, str(tmp_path), at)
    assert found.name == "DQ_Check_b.csv"
    assert found.run_id == "DQ_Check_b.csv_CompareData_2024-01-02T03.04.05.0"


def test_newest_drop_tie_goes_to_the_last_name(spark, tmp_path):
    for name in ("dq_check_2.csv", "dq_check_3.csv", "dq_check_1.csv"):
        put(tmp_path, name, at=1000)
    assert drops.find_newest_drop(spark, str(tmp_path)).name == "dq_check_3.csv"


def test_no_drop(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="is empty"):
        drops.find_newest_drop(spark, str(tmp_path))
    put(tmp_path, "other.csv")
    with pytest.raises(FileNotFoundError, match="no file named"):
        drops.find_newest_drop(spark, str(tmp_path))


def test_newest_drop_per_group(spark):
    listing = spark.createDataFrame(
        [("f", "/f/dq_check_1", 1), ("f", "/f/DQ_check_2", 2), ("g", "/g/other", 9)],
        "folder string, path string, modificationTime int",
    )
    assert as_set(drops.newest_drop(listing, by=["folder"])) == [
        ("f", "DQ_check_2", 2, "/f/DQ_check_2")
    ]


def test_listing_reads_no_contents(spark, tmp_path):
    put(tmp_path, "a.csv")
    text = drops.list_folder(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in text.split("ReadSchema")[1]


def test_delimited(spark, tmp_path):
    put(tmp_path, "a.txt", 'P1|P2|n\nx||1\n"q|r"|""|02\n')
    df = tables.delimited(spark, f"{tmp_path}/a.txt", "|")
    assert {f.dataType.simpleString() for f in df.schema.fields} == {"string"}
    assert df.columns == ["P1", "P2", "n"]
    assert as_set(df) == [("q|r", None, "02"), ("x", None, "1")]


def test_delimited_columns_in_another_order_are_refused(spark, tmp_path):
    put(tmp_path, "d/a.csv", "a,b\n1,2\n")
    put(tmp_path, "d/b.csv", "b,a\n1,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        tables.delimited(spark, f"{tmp_path}/d").collect()
    with pytest.raises(Exception, match="(?i)header"):
        tables.delimited(spark, f"{tmp_path}/d").select("a").collect()


def test_delivered_table_by_suffix(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/x.parquet")
    assert tables.delivered_table(spark, f"{tmp_path}/x.parquet").count() == 3
    put(tmp_path, "x.csv", "a;b\n1;2\n")
    assert as_set(tables.delivered_table(spark, f"{tmp_path}/x.csv", ";")) == [("1", "2")]


def test_view_and_rows(spark):
    view = tables.as_view(tables.rows(spark, [(1, "a"), (2, "b")], ["n", "s"]))
    assert as_set(view) == [(1, "a"), (2, "b")]
    assert spark.sql("SELECT count(*) FROM csv_temp_table").head()[0] == 2


CONFIG = "[k=v]\nk2=a=b\nnoequals\na=[b]\nk=w\n=x\nempty=\n"


def test_sheet_entries(spark, tmp_path):
    lines = config.text_lines(spark, put(tmp_path, "c.txt", CONFIG))
    assert config.as_mapping(config.sheet_entries(lines)) == {
        "k": "w", "k2": "a=b", "a": "[b", "": "x", "empty": "",
    }
    assert [r.line for r in config.sheet_rejects(lines).collect()] == ["noequals"]


def test_sheet_entries_legacy(spark, tmp_path):
    lines = config.text_lines(spark, put(tmp_path, "c.txt", "k=a=b\nx=1\n"))
    assert config.as_mapping(config.sheet_entries(lines, legacy=True)) == {"k": "a", "x": "1"}
    bad = config.text_lines(spark, put(tmp_path, "d.txt", CONFIG))
    with pytest.raises(Exception, match="without '=': noequals"):
        config.sheet_entries(bad, legacy=True).collect()


def test_first_lines_are_those_of_each_file(spark, tmp_path):
    for name in ("a.txt", "b.txt"):
        put(tmp_path, f"many/{name}", "".join(f"k{i}={name}{i}\n" for i in range(300)))
    # Splits of a few bytes, so that the lines of one file come from many tasks.
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    try:
        lines = config.text_lines(spark, f"{tmp_path}/many")
        assert lines.rdd.getNumPartitions() > 4
        found = config.sheet_entries(config.first_lines(lines, 110))
        assert {(r.key, r.value) for r in found.collect()} == {
            (f"k{i}", f"{name}{i}") for name in ("a.txt", "b.txt") for i in range(110)
        }
        text = config.first_lines(lines, 110)._jdf.queryExecution().executedPlan().toString()
        assert "WindowGroupLimit" in text and "Partial" in text
        # The last of equal keys wins over all splits.
        put(tmp_path, "last.txt", "".join(f"k={i}\n" for i in range(2000)))
        last = config.sheet_entries(config.text_lines(spark, f"{tmp_path}/last.txt"))
        assert config.as_mapping(last) == {"k": "1999"}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_properties_entries(spark, tmp_path):
    text = "# note\n! note\n\napp.name = My App \n  x=1=2\nx=3=4\nplain\nout=\n"
    lines = config.text_lines(spark, put(tmp_path, "job.properties", text))
    assert config.as_mapping(config.properties_entries(lines)) == {
        "app.name": "My App ", "x": "3=4", "out": "",
    }


def test_top_and_first_rows(spark):
    df = spark.range(1000).selectExpr("id", "id % 10 AS v")
    assert [r.id for r in top_rows(df, "v", 3, tie_break="id").collect()] == [9, 19, 29]
    assert [r.id for r in first_rows(df, ["id"], 2).collect()] == [0, 1]
    text = top_rows(df, "v", 3, "id")._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in text


def test_row_numbers_over_many_partitions(spark):
    df = spark.range(5000).selectExpr("hash(id) AS v", "id")
    numbered = number_rows(df, ["v", "id"]).orderBy("row_no").collect()
    assert [r.row_no for r in numbered] == list(range(1, 5001))
    assert [(r.v, r.id) for r in numbered] == sorted((r.v, r.id) for r in numbered)
    assert number_rows(df.where("false"), ["id"]).count() == 0
