import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowproof.functions import casting as C
from rowproof.functions import names as N
from rowproof.functions import rendering as R


def one(spark, column):
    return spark.range(1).select(column).head()[0]


@pytest.mark.parametrize(
    "path, expected",
    [
        ("/data/in/orders.2024.csv", "orders"),
        ("orders", "orders"),
        ("c:\\data\\orders.csv", "orders"),
        ("/data/in/", "tab_CSV"),
        ("", "tab_CSV"),
        (None, "tab_CSV"),
    ],
)
def test_table_name(spark, path, expected):
    assert one(spark, N.table_name(F.lit(path).cast("string"), "tab")) == expected


@pytest.mark.parametrize(
    "path, expected",
    [("/a/b/c.csv", "/a/b/"), ("/a/b/", "/a/b/"), ("c:\\a\\b.csv", "c:\\a\\"), ("/f", "/"), ("f", None)],
)
def test_folder(spark, path, expected):
    assert one(spark, N.folder_of(F.lit(path))) == expected


def test_folder_is_demanded(spark):
    with pytest.raises(Exception, match="path has no folder: f"):
        one(spark, N.folder_of(F.lit("f"), strict=True))


@pytest.mark.parametrize(
    "micros, shown", [(0, "0"), (100_000, "1"), (120_000, "12"), (123_456, "123"), (7_000, "007")]
)
def test_run_name(spark, micros, shown):
    at = dt.datetime(2024, 3, 9, 10, 20, 30, micros)
    name = one(spark, N.run_name(F.lit("dq_check_a.b.csv"), F.lit(at).cast("timestamp_ntz")))
    assert name == f"dq_check_a_CompareData_2024-03-09T10.20.30.{shown}"


def test_run_name_of_a_file_without_suffix(spark):
    at = F.lit(dt.datetime(2024, 3, 9)).cast("timestamp_ntz")
    assert one(spark, N.run_name(F.lit("Test"), at)) == "Test_CompareData_2024-03-09T00.00.00.0"


@pytest.mark.parametrize(
    "value, kind, shown, legacy",
    [
        ("x", "string", "x", "x"),
        (None, "string", "null", "null"),
        (7, "int", "7", "7.0"),
        (None, "int", "null", "null"),
        (7, "bigint", "7", ""),
        (None, "bigint", "null", "null"),
        (1.5, "double", "1.5", ""),
        (True, "boolean", "true", ""),
        (dt.date(2024, 1, 2), "date", "2024-01-02", ""),
    ],
)
def test_key_cell(spark, value, kind, shown, legacy):
    data_type = T.DataType.fromDDL(kind)
    column = F.lit(value).cast(kind)
    assert one(spark, R.key_cell(column, data_type)) == shown
    assert one(spark, R.key_cell(column, data_type, legacy=True)) == legacy


@pytest.mark.parametrize(
    "part, other, expected",
    [(4, 3, 57.14), (3, 4, 42.86), (0, 5, 0.0), (5, 0, 100.0), (0, 0, None), (1, 799, 0.13)],
)
def test_percent(spark, part, other, expected):
    value = R.percent_of(F.lit(part), F.lit(other))
    assert one(spark, value) == expected
    text = None if expected is None else f"{expected}%"
    assert one(spark, R.percent_text(value)) == text


@pytest.mark.parametrize("kind", ["tinyint", "smallint", "int", "bigint"])
def test_text_as_integer_is_try_cast(spark, kind):
    texts = [
        "1", "-1", "+1", " 1", "1 ", "\t1\n", "\x001\x7f", "01", "1.0", "1.", "1e1", "1L", "", " ",
        "-", "+", "--1", "1-1", "9" * 30, "300", "no-1", "1_0", "0x1", "１", "1 ", " 1", None,
    ]
    texts += [chr(c) + "1" for c in range(0x180)] + ["1" + chr(c) for c in range(0x180)]
    df = spark.createDataFrame([(x,) for x in texts], "x string")
    data_type = T.DataType.fromDDL(kind)
    rows = df.select(
        "x", C.text_as(F.col("x"), data_type).alias("a"), F.col("x").try_cast(data_type).alias("b")
    ).collect()
    assert [r for r in rows if r.a != r.b] == []
    assert sum(r.a is not None for r in rows) > 50


@pytest.mark.parametrize(
    "kind,exact,other",
    [
        ("decimal(10,2)", ["1.01", "1.010", " 1.01", "+1.01", "101e-2"], ["1.005", "1.0100001", "1.0149e0", "x", "1e-30"]),
        ("date", ["2024-01-31", "2024-01-31 00:00:00", "2024-01-31T00:00"], ["2024", "2024-01", "2024-01-31 10:00:00", "2024-01-31x"]),
        ("boolean", ["true", "TRUE", " True "], ["1", "t", "yes", "0"]),
        ("timestamp_ntz", ["2024-01-31", "2024-01-31 10:00:00.5"], ["2024-01", "10:00", "2024-01-31 10:00:00+02:00", "2024-01-31 10:00:00.1234567"]),
        ("timestamp", ["2024-01-31 10:00:00", "2024-01-31 10:00:00+02:00", "2024-01-31 10:00:00 UTC"], ["2024", "10:00:00"]),
    ],
)
def test_texts_are_read_exactly(spark, kind, exact, other):
    from pyspark.sql.types import _parse_datatype_string

    from rowproof.functions.casting import text_as

    df = spark.createDataFrame([(x,) for x in exact + other], "s string")
    got = [r[0] for r in df.select(text_as(df["s"], _parse_datatype_string(kind))).collect()]
    assert all(x is not None for x in got[: len(exact)]), list(zip(exact, got))
    assert got[len(exact) :] == [None] * len(other), list(zip(other, got[len(exact) :]))
