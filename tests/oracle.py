"""Compare registered queries with their SQL in DuckDB. Usage: python tests/oracle.py [folder] [names]"""

import glob
import math
import os
import sys
import time

import duckdb


def connect(folder):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9))
    return repr(value)


def table_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def differences(spark, con, run, sql, folder):
    """Empty text if query and SQL agree in names, types, and rows."""
    df = run(spark, folder)
    got_names, got = table_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    want_names, want = table_of([d[0] for d in cursor.description], cursor.fetchall())
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    kinds = {
        "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
        "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
    }
    spark_types = {f.name: kinds[f.dataType.simpleString()] for f in df.schema.fields}
    sql_types = {d[0]: str(d[1]) for d in cursor.description}
    if spark_types != sql_types:
        return f"types {spark_types} != {sql_types}"
    if got != want:
        extra = [r for r in got if r not in set(want)][:3]
        lacking = [r for r in want if r not in set(got)][:3]
        return f"{len(got)} rows != {len(want)}; only here {extra}; only in SQL {lacking}"
    return ""


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", "/tmp/rowproof-warehouse")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(folder), 0
    wanted = sys.argv[2:] or list(entry.oracle_sql())
    for name in wanted:
        start = time.time()
        try:
            text = differences(
                spark, con, entry.queries()[name], entry.oracle_sql()[name], folder
            )
        except Exception as error:  # noqa: BLE001
            text = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(text)
        print(f"{'FAIL' if text else 'ok':5}{name:34}{time.time() - start:6.2f}s {text}", flush=True)
    print(f"{len(wanted) - bad} of {len(wanted)} agree")
    spark.stop()
    sys.exit(bool(bad))
