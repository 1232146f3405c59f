import os

import pytest
from files import as_set, put
from fixture_pairs import fixtures

from rowproof import compare, storage
from rowproof.operators import reduction
from rowproof.plans.report import first_key_side_by_side, one_table, report_sheets
from rowproof.sinks import landing, report_store
from rowproof.sources import tables


def test_managed_table_is_replaced(spark, database):
    landing.land_managed(spark.range(5).toDF("a"), f"{database}.t")
    landed = landing.land_managed(spark.createDataFrame([("x",)], ["b"]), f"{database}.t")
    assert landed.columns == ["b"] and landed.count() == 1
    assert spark.catalog.getTable(f"{database}.t").tableType == "MANAGED"


def test_external_table_over_delivered_files(spark, database, tmp_path):
    put(tmp_path, "in/a.csv", "P1|P2\na|1\nb|\n")
    delivered = tables.delimited(spark, f"{tmp_path}/in", "|")
    name = f"{database}.ext"
    for _ in range(2):
        table = landing.land_external(spark, delivered, name, f"{tmp_path}/in", "|")
    assert as_set(table) == [("a", "1"), ("b", None)]
    assert spark.catalog.getTable(name).tableType == "EXTERNAL"
    spark.sql(f"DROP TABLE {name}")
    assert as_set(delivered) == [("a", "1"), ("b", None)]


def test_empty_clone(spark):
    df = spark.range(5).selectExpr("id", "'x' AS s")
    clone = landing.empty_clone(df)
    assert clone.schema == df.schema and clone.count() == 0
    assert "LocalTableScan <empty>" in clone._jdf.queryExecution().executedPlan().toString()


def test_delimited_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a,b", None), ('q"q', "y"), ("|", "x")], "s string, t string")
    path = landing.write_delimited(df, f"{tmp_path}/out", "|")
    assert as_set(tables.delimited(spark, path, "|")) == as_set(df)


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
@pytest.mark.parametrize("as_text", [False, True])
def test_report_tables(spark, tmp_path, threshold, as_text):
    case = fixtures()["tours"]
    reference, delivered = case.frames(spark)
    if as_text:
        delivered = delivered.select([delivered[c].cast("string") for c in delivered.columns])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        result = compare(reference, delivered, "Depot,Stops")
        for _ in range(2):  # writing again replaces
            sheets = report_store.write_report(result, f"{tmp_path}/report", "a#1_CompareData_x")
        report_store.write_report(result, f"{tmp_path}/report", "second")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    expected = report_sheets(result, result.presence())
    for title, sheet in sheets.items():
        assert as_set(sheet.drop("run_id")) == as_set(expected[title]), title
        assert {r.run_id for r in sheet.select("run_id").collect()} == {"a#1_CompareData_x"}
    whole = report_store.read_all(spark, f"{tmp_path}/report", "Percentage")
    assert {r.run_id for r in whole.collect()} == {"a#1_CompareData_x", "second"}
    left = sorted(os.listdir(f"{tmp_path}/report"))
    assert left == ["_runs", "_work", "column_counts", "columns", "keys_not_present", "keys_present", "percentage"]
    assert len(os.listdir(f"{tmp_path}/report/columns/run_id=second")) == 1
    assert os.listdir(f"{tmp_path}/report/_work") == []


def test_reports_with_other_keys_are_read_together(spark, tmp_path):
    reference, delivered = fixtures()["tours"].frames(spark)
    for run_id, key in (("one", "Depot,Mode"), ("two", "Crates")):
        report_store.write_report(compare(reference, delivered, key), str(tmp_path), run_id)
    sheet = report_store.read_all(spark, str(tmp_path), "Primary Keys Not Present")
    found = {(r.run_id, tuple(r.key_names), tuple(r.key_values)) for r in sheet.collect()}
    assert ("one", ("depot", "mode"), ("quarry", "road")) in found
    assert ("two", ("crates",), ("338",)) in found and len(found) == 3 + 5


def test_a_run_is_there_as_a_whole_or_not_at_all(spark, tmp_path, monkeypatch):
    reference, delivered = fixtures()["tours"].frames(spark)
    path, written = str(tmp_path), []
    stored = report_store._stored

    def stop_at_third(title, sheet):
        written.append(title)
        if len(written) % 5 == 3:
            raise ConnectionError("killed")
        return stored(title, sheet)

    def present():
        return {(r.run_id, r.key_names[0]) for t in report_store.KEY_SHEETS for r in report_store.read_all(spark, path, t).collect()}

    assert report_store.read_all(spark, path, "Percentage").count() == 0
    monkeypatch.setattr(report_store, "_stored", stop_at_third)
    with pytest.raises(ConnectionError):
        report_store.write_report(compare(reference, delivered, "Crates"), path, "r")
    assert os.listdir(f"{path}/columns") == ["run_id=r"] and present() == set()
    with pytest.raises(FileNotFoundError, match="no finished run r"):
        report_store.read_report(spark, path, "r")
    monkeypatch.setattr(report_store, "_stored", stored)
    report_store.write_report(compare(reference, delivered, "Crates"), path, "r")
    assert present() == {("r", "crates")}
    monkeypatch.setattr(report_store, "_stored", stop_at_third)
    written.clear()
    with pytest.raises(ConnectionError):
        report_store.write_report(compare(reference, delivered, "Depot"), path, "r")
    assert present() == {("r", "crates")}  # all sheets of the attempt before
    monkeypatch.setattr(report_store, "_stored", stored)
    report_store.write_report(compare(reference, delivered, "Depot"), path, "r")
    assert present() == {("r", "depot")}
    runs = report_store.finished_runs(spark, path).collect()
    assert [(r.run_id, r.key_names) for r in runs] == [("r", ["depot"])]


@pytest.mark.parametrize("threshold,allowed", [("-1", False), ("0", False), ("0b", False), ("10MB", True), ("10485760b", True)])
def test_broadcast_is_off_with_the_sessions(spark, threshold, allowed):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        assert reduction._broadcast_allowed(spark) == allowed
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_empty_key_sheet_can_be_read(spark, tmp_path):
    side = spark.createDataFrame([(1,)], "k int")
    sheets = report_store.write_report(compare(side, side, "k"), str(tmp_path), "r")
    assert sheets["Primary Keys Not Present"].count() == 0
    assert as_set(sheets["Percentage"].drop("run_id")) == [
        ("Matching Data", "100.0%"), ("Non Matching Data", "0.0%"),
    ]


def test_delivered_keys_are_measured(spark):
    keys = spark.createDataFrame([("ab", 1), (None, 2)], "s string, n int")
    assert reduction.measure_keys(keys).total_bytes == (24 + 2 + 16 + 24) + (24 + 0 + 16 + 24)
    nested = spark.createDataFrame([([1],)], "a array<int>")
    sizes = reduction.measure_keys(nested)
    assert sizes.total_bytes == float("inf") and sizes.within is None
    empty = reduction.measure_keys(keys.where("false"))
    assert empty.total_bytes == 0 and empty.within is None


def test_all_measured_keys_are_within_their_bounds(spark):
    keys = spark.sql(
        "SELECT * FROM VALUES "
        "('', 1L, 1.50BD, DATE'1999-12-31', TIMESTAMP_NTZ'2024-01-01 00:00:01', 1D), "
        "('zz', -5L, 9.25BD, DATE'2024-02-29', TIMESTAMP_NTZ'2024-06-01 00:00:00', double('nan')), "
        "('\u00e9', 77L, 0.01BD, DATE'0001-01-01', TIMESTAMP_NTZ'1960-01-01 00:00:00', -1D) "
        "AS t(s, n, d, day, at, x)"
    )
    within = reduction.measure_keys(keys).within
    assert keys.where(within).count() == 3
    text = keys.where(within)._jdf.queryExecution().analyzed().toString()
    assert " x#" not in text.split("Filter")[1].split("\n")[0]
    assert spark.sql(
        "SELECT '' s, 78L n, 1BD d, DATE'2000-01-01' day, TIMESTAMP_NTZ'2000-01-01' at, 0D x"
    ).where(within).count() == 0


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_reference_beyond_the_delivered_range_is_not_read(spark, tmp_path, threshold, monkeypatch):
    spark.range(1000).write.parquet(f"{tmp_path}/ref")
    reference = spark.read.parquet(f"{tmp_path}/ref").toDF("k")
    delivered = spark.createDataFrame([("10",), ("020",), ("x",), (None,)], "k string")
    plans = []
    stage = report_store.storage.stage
    monkeypatch.setattr(
        report_store.storage, "stage",
        lambda df, path: plans.append(df._jdf.queryExecution().toString()) or stage(df, path),
    )
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        presence = report_store.written_presence(compare(reference, delivered, "k"), f"{tmp_path}/w")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "GreaterThanOrEqual(id,10)" in plans[-1] and "LessThanOrEqual(id,20)" in plans[-1]
    assert ("BroadcastHashJoin" in plans[-1]) == (threshold != "-1")
    assert sorted(r["__present"] for r in presence.collect()) == [False, False, True, True]


def test_first_key_side_by_side(spark):
    reference, delivered = fixtures()["tours"].frames(spark)
    rows = as_set(first_key_side_by_side(compare(reference, delivered, "Depot,Mode")))
    assert rows == [
        (1, "harbor", ""), (2, "north", "harbor"), (3, "north", "quarry"), (4, "south", ""), (5, "south", ""),
    ]


def test_one_table(spark):
    reference, delivered = fixtures()["tours"].frames(spark)
    result = compare(reference, delivered, "Depot,Mode")
    table = one_table(report_sheets(result, result.presence()), 2)
    assert table.columns == ["sheet", "cell_1", "cell_2"]
    assert table.count() == 2 + 4 + 5 + 3 + 2


def test_work_folder_is_the_shared_one(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert storage.new_folder(spark, "x").startswith(f"{shared}/x-")


def test_cluster_without_a_shared_folder_is_refused():
    class Conf:
        def get(self, name, default):
            return default

    class Session:
        conf = Conf()

        class sparkContext:
            master, applicationId = "yarn", "app"

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        storage.work_root(Session())
    Session.sparkContext.master = "local[2]"
    assert storage.work_root(Session()) == storage.work_root(Session())
