import os
import threading
import time

import pytest
from files import as_set, put
from pyspark.sql import functions as F

from rowproof import storage
from rowproof.plans import job
from rowproof.sinks.report_store import read_report
from rowproof.streaming import intake


def test_any_case_glob():
    assert intake.any_case_glob("dq_1") == "[dD][qQ]_1*"


def test_drops_are_landed_once_and_archived(spark, tmp_path):
    def land():
        return intake.land_drops(
            spark, f"{tmp_path}/in", f"{tmp_path}/landed", f"{tmp_path}/cp",
            "k string, v string", archive=f"{tmp_path}/archive",
        )

    put(tmp_path, "in/dq_check_1.csv", "k,v\na,1\nb,2\n")
    put(tmp_path, "in/other.csv", "k,v\nz,9\n")
    assert as_set(land()) == [("a", "1"), ("b", "2")]
    assert as_set(land()) == [("a", "1"), ("b", "2")]
    put(tmp_path, "in/DQ_CHECK_2.csv", "k,v\nc,\n")
    assert as_set(land()) == [("a", "1"), ("b", "2"), ("c", None)]
    put(tmp_path, "in/dq_check_3.csv", "k,v\nd,4\n")
    assert len(as_set(land())) == 4
    archived = {f for _, _, files in os.walk(f"{tmp_path}/archive") for f in files}
    assert {"dq_check_1.csv"} <= {f for f in archived if not f.startswith(".")}
    assert "other.csv" not in archived and os.path.exists(f"{tmp_path}/in/other.csv")


def test_lines_that_are_no_rows_are_kept_apart(spark, tmp_path):
    """Every line is landed or rejected, once, also after a crash between the two tables or before the commit."""
    schema = "a int, b int, query string"

    def land():
        return intake.land_drops(spark, f"{tmp_path}/in", f"{tmp_path}/landed", f"{tmp_path}/cp", schema)

    def rejected():
        return sorted((r["path"].rsplit("/", 1)[1], r["line"]) for r in intake.read_rejects(spark, intake.rejects_of(f"{tmp_path}/landed")).collect())

    def forget_commit(number):
        for name in (f"{number}", f".{number}.crc"):
            os.remove(f"{tmp_path}/cp/commits/{name}")

    good, bad = "1,2,x\n,7,\n\n-5,,\"y,z\"\n", "3\n4,5,6,7\nzz,7,x\n1,2\n1.5,2,x\n"
    put(tmp_path, "in/dq_check_1.csv", "a,b,query\n" + good + bad)
    rows = [(-5, None, "y,z"), (1, 2, "x"), (None, 7, None)]
    lines = [("dq_check_1.csv", line) for line in bad.split()]
    assert as_set(land()) == rows and rejected() == sorted(lines)
    forget_commit(0)  # the batch is done but its query doesn't know
    assert as_set(land()) == rows and rejected() == sorted(lines)
    put(tmp_path, "in/dq_check_2.csv", "a,b,query\n8,8,8\n8,8,8\nq\n")
    rows, lines = [*rows, (8, 8, "8"), (8, 8, "8")], [*lines, ("dq_check_2.csv", "q")]
    assert as_set(land()) == sorted(rows, key=repr) and rejected() == sorted(lines)
    forget_commit(1)
    storage.remove(spark, next(str(p) for p in tmp_path.glob("landed_rejects/query=*/batch=1")))
    assert as_set(land()) == sorted(rows, key=repr) and rejected() == sorted(lines)
    storage.remove(spark, f"{tmp_path}/cp")  # another query takes all files again and replaces nothing
    assert land().count() == 2 * len(rows) and len(rejected()) == 2 * len(lines)


def test_a_file_with_other_columns_is_refused(spark, tmp_path):
    put(tmp_path, "in/dq_check_1.csv", "b,a\n1,2\n")
    with pytest.raises(Exception, match="header"):
        intake.land_drops(spark, f"{tmp_path}/in", f"{tmp_path}/landed", f"{tmp_path}/cp", "a int, b int")


@pytest.fixture
def setup(spark, database, tmp_path):
    spark.sql(f"CREATE TABLE {database}.ref (pk INT COMMENT 'Key_No', v STRING) USING parquet")
    spark.sql(f"INSERT INTO {database}.ref VALUES (1, 'a'), (2, 'b'), (3, 'c')")
    config = (
        f"hive.database={database}\nhive.table=ref\nprimary.keys=key_no\ncsv.delimiter=|\n"
    )
    put(tmp_path, "in/config/dq_check_a.properties", config)
    put(tmp_path, "in/config/DQ_check_b.properties", config)
    put(tmp_path, "in/dq_check_a.csv", "Key_No|w\n1|x\n9|y\n", at=1_700_000_000)
    put(tmp_path, "in/DQ_check_b.csv", "Key_No|w\n2|x\n3|x\nzz|y\n|n\n", at=1_700_000_100)
    put(
        tmp_path, "job.properties",
        f"source.file.path={tmp_path}/in/\narchive.directory={tmp_path}/archive\n"
        f"output.path={tmp_path}/out\n",
    )
    return tmp_path


def test_newest_drop_is_compared(spark, setup):
    at = F.lit("2024-05-06 07:08:09.5").cast("timestamp_ntz")
    run = job.run_newest(spark, f"{setup}/job.properties", at)
    assert run.run_id == "DQ_check_b.csv_CompareData_2024-05-06T07.08.09.5"
    rows = {t: as_set(s.drop("run_id")) for t, s in run.sheets.items()}
    assert rows["Column Counts"] == [("CSV Table", 2), ("Hive Table", 2)]
    assert rows["CSV Columns"] == [(1, "key_no", "w")]
    assert rows["Primary Keys Data Present"] == [("2",), ("3",)]
    assert rows["Primary Keys Not Present"] == [("null",), ("zz",)]
    assert rows["Percentage"] == [("Matching Data", "50.0%"), ("Non Matching Data", "50.0%")]
    assert run.comparison.summary().head().reference_only_keys == 1
    assert os.listdir(f"{setup}/archive") == ["DQ_check_b.csv"]
    assert not os.path.exists(f"{setup}/in/DQ_check_b.csv")


def test_all_new_drops_are_compared_once(spark, setup):
    def run():
        job.run_incoming(spark, f"{setup}/job.properties", f"{setup}/ledger")

    def written():
        return sorted(os.listdir(f"{setup}/out/percentage"))

    run()
    first = "run_id=dq_check_a.csv_CompareData_2023-11-14T22.13.20.0"
    second = "run_id=DQ_check_b.csv_CompareData_2023-11-14T22.15.00.0"
    assert written() == sorted([first, second])
    sheets = read_report(spark, f"{setup}/out", first.removeprefix("run_id="))
    absent = sheets["Primary Keys Not Present"]
    assert [(r.key_names, r.key_values) for r in absent.collect()] == [(["key_no"], ["9"])]
    os.remove(f"{setup}/in/config/dq_check_a.properties")  # would fail if taken again
    run()
    assert written() == sorted([first, second])


def test_name_with_wildcards_is_taken_literally(spark, setup):
    base = "dq_check_[ab]{1} 50%20"
    config = (setup / "in/config/dq_check_a.properties").read_text()
    put(setup, f"in/config/{base}.properties", config)
    put(setup, f"in/{base}.csv", "Key_No|w\n3|x\n", at=1_700_000_900)
    run = job.run_newest(spark, f"{setup}/job.properties")
    assert run.run_id.startswith(f"{base}.csv_CompareData_")
    put(setup, f"in/{base}.csv", "Key_No|w\n3|x\n", at=1_700_000_900)
    assert as_set(run.sheets["Primary Keys Data Present"].select("key_no")) == [("3",)]
    job.run_incoming(spark, f"{setup}/job.properties", f"{setup}/ledger")
    again = read_report(spark, f"{setup}/out", f"{base}.csv_CompareData_2023-11-14T22.28.20.0")
    assert [r.key_values for r in again["Primary Keys Data Present"].collect()] == [["3"]]


def test_missing_settings(spark, setup):
    put(setup, "bad.properties", "output.path=x\n")
    with pytest.raises(ValueError, match="source.file.path is missing"):
        job.run_newest(spark, f"{setup}/bad.properties")
    put(setup, "in/config/DQ_check_b.properties", "hive.database=d\nhive.table=t\n")
    with pytest.raises(ValueError, match="primary.keys is missing"):
        job.run_newest(spark, f"{setup}/job.properties")


def outcomes(rows):
    return sorted((r["name"], r["outcome"]) for r in rows.collect())


def test_redelivered_late_and_bad_drops(spark, setup):
    def run(**options):
        return job.run_incoming(spark, f"{setup}/job.properties", f"{setup}/ledger", **options)

    put(setup, "in/dq_check_nothing_known.csv", "Key_No\n1\n", at=1_700_000_050)
    with pytest.raises(intake.DropsFailed, match="1 drops failed.*nothing_known"):
        run()
    known = intake.read_ledger(spark, f"{setup}/ledger")
    assert outcomes(known) == [
        ("DQ_check_b.csv", "done"), ("dq_check_a.csv", "done"), ("dq_check_nothing_known.csv", "failed"),
    ]
    assert known.where("outcome = 'failed'").head().error
    assert sorted(os.listdir(f"{setup}/archive")) == ["DQ_check_b.csv", "dq_check_a.csv"]
    # Under its old name with other rows; and one far older than all that was taken.
    put(setup, "in/dq_check_a.csv", "Key_No|w\n2|x\n", at=1_700_005_000)
    put(setup, "in/config/dq_check_late.properties", (setup / "in/config/dq_check_a.properties").read_text())
    put(setup, "in/dq_check_late.csv", "Key_No|w\n3|x\n", at=1_600_000_000)
    assert outcomes(run()) == [("dq_check_a.csv", "done"), ("dq_check_late.csv", "done")]
    again = "dq_check_a.csv_CompareData_2023-11-14T23.36.40.0"
    assert again.rsplit("_", 1)[1] in os.listdir(f"{setup}/archive")
    assert [r.key_values for r in read_report(spark, f"{setup}/out", again)["Primary Keys Data Present"].collect()] == [["2"]]
    assert run().count() == 0
    put(setup, "in/config/dq_check_nothing_known.properties", (setup / "in/config/dq_check_a.properties").read_text())
    assert outcomes(run(retry_failed=True)) == [("dq_check_nothing_known.csv", "done")]


def test_drops_of_one_base_name_and_time_have_their_own_reports(spark, setup):
    put(setup, "in/dq_check_a.part2.csv", "Key_No|w\n2|x\n", at=1_700_000_000)
    job.run_incoming(spark, f"{setup}/job.properties", f"{setup}/ledger")
    runs = [r for r in os.listdir(f"{setup}/out/percentage") if "dq_check_a" in r]
    assert sorted(r.split("_CompareData_")[0] for r in runs) == ["run_id=dq_check_a.csv", "run_id=dq_check_a.part2.csv"]


def test_unreadable_lines_and_settings_do_not_vanish(spark, setup):
    put(setup, "in/DQ_check_b.csv", "Key_No|w\n2|x\n3|x|y\n1\n", at=1_700_000_100)
    run = job.run_newest(spark, f"{setup}/job.properties")
    assert run.rejected_lines == 2
    assert [r.key_values for r in read_report(spark, f"{setup}/out", run.run_id)["Primary Keys Data Present"].collect()] == [["2"]]
    lines = spark.read.parquet(f"{setup}/out/rejects").select("line").collect()
    assert sorted(r.line for r in lines) == ["1", "3|x|y"]
    config = (setup / "in/config/dq_check_a.properties").read_text()
    put(setup, "in/config/dq_check_a.properties", "x=y\n" * 200 + config)
    assert job.drop_settings(spark, f"{setup}/in/config/dq_check_a.properties")["primary.keys"] == "key_no"
    with pytest.raises(ValueError, match="more than 110"):
        job.drop_settings(spark, f"{setup}/in/config/dq_check_a.properties", legacy=True)
    put(setup, "in/config/dq_check_a.properties", config + "no setting\n")
    with pytest.raises(ValueError, match="no settings"):
        job.drop_settings(spark, f"{setup}/in/config/dq_check_a.properties")


def test_landing_takes_files_of_any_age_and_starts_empty(spark, tmp_path):
    def land():
        return intake.land_drops(spark, f"{tmp_path}/in", f"{tmp_path}/landed", f"{tmp_path}/cp", "k string")

    put(tmp_path, "in/other.csv", "k\nz\n")
    assert land().count() == 0
    put(tmp_path, "in/dq_check_1.csv", "k\na\n", at=1_700_000_000)
    assert land().count() == 1
    put(tmp_path, "in/dq_check_0.csv", "k\nb\n", at=1_600_000_000)
    assert land().count() == 2


def test_drops_side_by_side(spark, tmp_path):
    """Twenty drops and one that fails: one outcome each, several at a time, and none twice."""
    for i in range(20):
        put(tmp_path, f"in/dq_check_{i}.csv", f"k\n{i}\n", at=1000 + i)
    put(tmp_path, "in/dq_check_bad.csv", "k\n", at=500)
    lock, running, most, seen = threading.Lock(), set(), [0], []

    def handle(drop):
        with lock:
            running.add(drop["name"])
            most[0] = max(most[0], len(running))
        try:
            if "bad" in drop["name"]:
                raise ValueError("no drop")
            seen.append((drop["name"], spark.read.csv(storage.literal_path(drop["path"]), header=True).first()["k"]))
            time.sleep(0.05)
        finally:
            with lock:
                running.remove(drop["name"])

    with pytest.raises(intake.DropsFailed, match="dq_check_bad"):
        intake.handle_drops(spark, f"{tmp_path}/in", handle, f"{tmp_path}/ledger", archive=f"{tmp_path}/done", files_per_batch=6, at_once=4)
    assert sorted(seen) == sorted((f"dq_check_{i}.csv", str(i)) for i in range(20))
    assert 1 < most[0] <= 4
    ledger = intake.read_ledger(spark, f"{tmp_path}/ledger")
    assert as_set(ledger.select("name", "outcome")) == sorted([(f"dq_check_{i}.csv", "done") for i in range(20)] + [("dq_check_bad.csv", "failed")])
    assert sorted(os.listdir(f"{tmp_path}/in")) == ["dq_check_bad.csv"] and len(os.listdir(f"{tmp_path}/done")) == 20
    assert intake.handle_drops(spark, f"{tmp_path}/in", handle, f"{tmp_path}/ledger", at_once=4).count() == 0


def test_own_session_has_the_settings_and_its_own_views(spark):
    spark.range(3).createOrReplaceTempView("shared_view")
    own = storage.own_session(spark)
    assert own.conf.get("spark.checkpoint.dir") == spark.conf.get("spark.checkpoint.dir")
    assert own.conf.get("spark.sql.shuffle.partitions") == "4" and not own.catalog.tableExists("shared_view")
    spark.catalog.dropTempView("shared_view")
