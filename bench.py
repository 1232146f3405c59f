"""Time the headline queries; print one JSON line.

Folder ``BENCH_SF_DIR`` and core count ``BENCH_CPUS`` come from the environment. Every query
runs once to warm up and then ``BENCH_RUNS`` times; its median counts. Results go to a sink
that drops them, so nothing passes through the driver.

distinct, and two anti joins) beside ``probe_*``, the same counts from one pass, on the same
sides, with broadcast joins off.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rowproof import catalogue, compare  # noqa: E402

HEADLINES = [
    "keys_common",
    "keys_common_composite",
    "keys_common_mixed_type",
    "keys_delivered_only",
    "keys_delivered_only_reduced",
    "keys_delivered_only_mixed_type",
    "keys_reference_only",
    "keys_presence_labels",
    "keys_presence_composite",
    "keys_status",
    "keys_mixed_type",
    "summary",
    "summary_composite",
    "summary_null",
    "summary_mixed_type",
    "match_percent",
    "report_all_sheets",
    "report_tables",
    "report_first_key_side_by_side",
    "managed_table",
    "external_table",
    "text_drop",
    "intake_archive",
    "config_rows",
    "latest_drop",
    "top_desc",
]


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def seconds(work, runs: int) -> float:
    work()
    times = []
    for _ in range(runs):
        start = time.perf_counter()
        work()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 3)


def probe_sides(spark, folder, key):
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    return lines.where(F.col(key) % 7 != 0), lines.where(F.col(key) % 5 != 0)


def one_pass(spark, folder, keys):
    drain(compare(*probe_sides(spark, folder, keys[0]), keys).summary())


def three_joins(spark, folder, keys):
    reference, delivered = probe_sides(spark, folder, keys[0])
    drain(reference.join(delivered, keys).select(*keys).dropDuplicates().agg(F.count(F.lit(1))))
    for one, other in ((delivered, reference), (reference, delivered)):
        only = one.join(other, keys, "left_anti").select(*keys).dropDuplicates()
        drain(only.agg(F.count(F.lit(1))))


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINES:
        times[name] = seconds(lambda: drain(catalogue.QUERIES[name](spark, folder)), runs)
    probes, shape = {}, {}
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    for name, keys in (
        ("composite", ["l_orderkey", "l_linenumber"]), ("partkey", ["l_partkey"])
    ):
        probes[f"probe_{name}"] = seconds(lambda: one_pass(spark, folder, keys), runs)
        shape[f"probe_{name}"] = seconds(lambda: three_joins(spark, folder, keys), runs)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    times |= probes
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "reference_shape": shape,
                "sf": folder.rsplit("sf", 1)[-1],
                "cpus": cpus,
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
