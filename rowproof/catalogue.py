"""Queries over the test tables, each with the SQL that checks it.

Every query reads whole tables. Sides that differ are made by a rule over a column, never by
leaving rows out: some keys are turned negative, some into null, some into odd texts.
"""

from __future__ import annotations

import contextlib
import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowproof import settings, storage
from rowproof.functions.names import folder_of, run_name, table_name
from rowproof.operators import catalog_columns, columns, keys, totals
from rowproof.operators.ordering import first_rows, top_rows
from rowproof.plans.compare import Comparison, compare
from rowproof.plans.job import compare_drop
from rowproof.plans.report import first_key_side_by_side, key_sheet, one_table, report_sheets
from rowproof.sinks import landing, report_store
from rowproof.sources import config, drops, tables
from rowproof.spec import CompareSpec
from rowproof.streaming.intake import DropsFailed, handle_drops, land_drops, read_rejects, rejects_of

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str):
    """Register a function ``(tables) -> DataFrame`` under its name, with its SQL."""

    def register(build):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(Tables(spark, folder))

        QUERIES[build.__name__] = run
        ORACLES[build.__name__] = sql
        return build

    return register


class Tables:
    """The Parquet tables of a folder by name."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getitem__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def new_database(self) -> str:
        """This session's catalog database, with its tables in the shared folder."""
        name = "rowproof_" + re.sub("[^a-z0-9]", "_", self.spark.sparkContext.applicationId.lower())
        if not self.spark.catalog.databaseExists(name):
            self.spark.sql(f"CREATE DATABASE {name} LOCATION '{storage.new_folder(self.spark, 'db')}'")
        return name

    def new_table(self, name: str) -> str:
        """Full name of a table that nothing has used yet."""
        return f"{self.new_database()}.{name}_{uuid.uuid4().hex}"


# --- pairs, and the same pairs in SQL as r (reference) and d (delivered) ----------------

ORDERS_LINEITEM = """
WITH r AS (SELECT o_orderkey AS order_key FROM orders),
     d AS (SELECT l_orderkey AS order_key FROM lineitem)
"""


def orders_lineitem(t: Tables) -> Comparison:
    """Orders against line items: delivered keys repeat, some orders have no items."""
    return compare(
        t["orders"].withColumnRenamed("o_orderkey", "order_key"),
        t["lineitem"].withColumnRenamed("l_orderkey", "Order_Key"),
        CompareSpec.of("order_key", small_delivered=False),
    )


MOVED_LINES = """
WITH r AS (SELECT l_orderkey, l_linenumber FROM lineitem),
     d AS (SELECT CASE WHEN l_returnflag = 'R' THEN -1 - l_orderkey ELSE l_orderkey END
                  AS l_orderkey, l_linenumber FROM lineitem)
"""


def moved_lines(t: Tables, small_delivered: bool = False) -> Comparison:
    """Line items against line items with a third of the order keys turned negative."""
    key = F.col("l_orderkey")
    moved = F.when(F.col("l_returnflag") == "R", -1 - key).otherwise(key)
    return compare(
        t["lineitem"],
        t["lineitem"].withColumn("l_orderkey", moved),
        CompareSpec.of("L_OrderKey, L_LineNumber", small_delivered=small_delivered),
    )


NULL_ORDERS = """
WITH r AS (SELECT CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '5-LOW' THEN NULL
                       ELSE o_orderkey END AS order_key FROM orders),
     d AS (SELECT CASE WHEN o_orderpriority = '5-LOW' THEN NULL
                       WHEN o_orderstatus = 'P' THEN -1 - o_orderkey
                       ELSE o_orderkey END AS order_key FROM orders)
"""


def null_orders(t: Tables) -> Comparison:
    """Orders against orders; a fifth of the delivered keys is null, a third of the rest moved."""
    key, low = F.col("o_orderkey"), F.col("o_orderpriority") == "5-LOW"
    reference = F.when(~(low & (F.col("o_orderstatus") == "F")), key)
    delivered = F.when(~low, F.when(F.col("o_orderstatus") == "P", -1 - key).otherwise(key))
    return compare(
        t["orders"].withColumn("order_key", reference),
        t["orders"].withColumn("order_key", delivered),
        CompareSpec.of("order_key", small_delivered=False),
    )


TEXT_LINES = """
WITH r AS (SELECT o_orderkey AS order_key FROM orders),
     spelled AS (
       SELECT CASE WHEN l_returnflag = 'R' THEN '0' || l_orderkey
                   WHEN l_returnflag = 'A' THEN 'no-' || l_orderkey
                   WHEN l_linestatus = 'O' THEN CAST(l_orderkey AS VARCHAR)
                   WHEN l_linenumber > 3 THEN '-0' || (l_orderkey + 1)
                   ELSE '-' || (l_orderkey + 1) END AS spelling FROM lineitem),
     d AS (SELECT typed AS order_key, min(spelling) AS spelling
           FROM (SELECT spelling, TRY_CAST(spelling AS BIGINT) AS typed FROM spelled) s
           GROUP BY typed, CASE WHEN typed IS NULL THEN spelling END)
"""


def text_lines(t: Tables, small_delivered: bool = False) -> Comparison:
    """Orders against line items whose keys are texts in several spellings, some unreadable."""
    key = F.col("l_orderkey")
    spelling = (
        F.when(F.col("l_returnflag") == "R", F.concat(F.lit("0"), key))
        .when(F.col("l_returnflag") == "A", F.concat(F.lit("no-"), key))
        .when(F.col("l_linestatus") == "O", key.cast("string"))
        .when(F.col("l_linenumber") > 3, F.concat(F.lit("-0"), key + 1))
        .otherwise(F.concat(F.lit("-"), key + 1))
    )
    return compare(
        t["orders"].withColumnRenamed("o_orderkey", "order_key"),
        t["lineitem"].select(spelling.alias("order_key")),
        CompareSpec.of("order_key", small_delivered=small_delivered),
    )


CUSTOMERS = """
WITH r AS (SELECT * FROM customer),
     d AS (SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN -1 - c_custkey ELSE c_custkey END
                  AS c_custkey, c_name, c_nationkey, c_mktsegment,
                  c_nationkey AS c_note FROM customer)
"""


def customers(t: Tables) -> Comparison:
    """Customers against customers with upper-case names, one column dropped and one added."""
    key = F.col("c_custkey")
    delivered = t["customer"].select(
        F.when(F.col("c_mktsegment") == "BUILDING", -1 - key).otherwise(key).alias("C_CUSTKEY"),
        F.col("c_name").alias("C_NAME"),
        F.col("c_nationkey").alias("C_NATIONKEY"),
        F.col("c_mktsegment").alias("C_MKTSEGMENT"),
        F.col("c_nationkey").alias("C_NOTE"),
    )
    return compare(t["customer"], delivered, "c_custkey")


def _has(other: str, *names: str, of: str) -> str:
    match = " AND ".join(f"{other}.{n} = {of}.{n}" for n in names)
    return f"EXISTS (SELECT 1 FROM {other} WHERE {match})"


# --- keys -------------------------------------------------------------------------------


@query(ORDERS_LINEITEM + f"SELECT DISTINCT order_key FROM r WHERE {_has('d', 'order_key', of='r')}")
def keys_common(t):
    return orders_lineitem(t).keys_present()


@query(
    MOVED_LINES
    + "SELECT DISTINCT l_orderkey, l_linenumber FROM r WHERE "
    + _has("d", "l_orderkey", "l_linenumber", of="r")
)
def keys_common_composite(t):
    return moved_lines(t).keys_present()


@query(
    "SELECT DISTINCT c_custkey AS user_id FROM customer "
    "WHERE EXISTS (SELECT 1 FROM events WHERE user_id = c_custkey)"
)
def keys_common_single(t):
    reference = t["customer"].withColumnRenamed("c_custkey", "user_id")
    return compare(reference, t["events"], "user_id").keys_present()


@query(TEXT_LINES + "SELECT DISTINCT r.order_key FROM r JOIN d ON r.order_key = d.order_key")
def keys_common_mixed_type(t):
    return text_lines(t).keys_present()


@query(
    MOVED_LINES
    + "SELECT DISTINCT l_orderkey, l_linenumber FROM d WHERE NOT "
    + _has("r", "l_orderkey", "l_linenumber", of="d")
)
def keys_delivered_only(t):
    return moved_lines(t).keys_delivered_only()


@query(ORACLES["keys_delivered_only"])
def keys_delivered_only_reduced(t):
    """The same by the plan for a small delivered side."""
    return moved_lines(t, small_delivered=True).keys_delivered_only()


@query(NULL_ORDERS + f"SELECT DISTINCT order_key FROM d WHERE NOT {_has('r', 'order_key', of='d')}")
def keys_delivered_only_null(t):
    return null_orders(t).keys_delivered_only()


@query(
    TEXT_LINES
    + "SELECT spelling AS order_key FROM d WHERE NOT "
    + _has("r", "order_key", of="d")
)
def keys_delivered_only_mixed_type(t):
    return text_lines(t).keys_delivered_only()


@query(ORACLES["keys_delivered_only_mixed_type"])
def keys_delivered_only_mixed_type_reduced(t):
    """The same by the plan for a small delivered side."""
    return text_lines(t, small_delivered=True).keys_delivered_only()


@query(
    ORDERS_LINEITEM
    + f"SELECT DISTINCT order_key FROM r WHERE NOT {_has('d', 'order_key', of='r')}"
)
def keys_reference_only(t):
    return orders_lineitem(t).keys_reference_only()


@query("SELECT doc_id, TRUE AS present FROM labels")
def keys_presence_labels(t):
    """Labels are few and documents many: the documents are filtered before any shuffle."""
    return compare(t["documents"], t["labels"], "doc_id").keys_found()


@query("SELECT doc_id, doc_id IN (SELECT doc_id FROM labels) AS present FROM documents")
def keys_presence_documents(t):
    """Which documents have a label? Here the documents are the delivered side."""
    spec = CompareSpec.of("doc_id", small_delivered=False)
    return compare(t["labels"], t["documents"], spec).keys_found()


@query(
    CUSTOMERS
    + f"SELECT c_custkey, {_has('r', 'c_custkey', of='d')} AS present FROM d"
)
def keys_presence(t):
    return customers(t).keys_found()


@query(
    MOVED_LINES
    + "SELECT l_orderkey, l_linenumber, "
    + _has("r", "l_orderkey", "l_linenumber", of="u")
    + " AS present FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM d) u"
)
def keys_presence_composite(t):
    return moved_lines(t).keys_found()


@query(
    MOVED_LINES
    + """
SELECT l_orderkey, l_linenumber,
       CASE WHEN bool_or(in_r) AND bool_or(in_d) THEN 'both'
            WHEN bool_or(in_d) THEN 'delivered_only' ELSE 'reference_only' END AS status
FROM (SELECT *, TRUE AS in_r, FALSE AS in_d FROM r
      UNION ALL SELECT *, FALSE, TRUE FROM d) u
GROUP BY l_orderkey, l_linenumber"""
)
def keys_status(t):
    return moved_lines(t).keys_status()


@query(ORACLES["keys_status"])
def keys_status_bucketed(t):
    """The same after both sides were landed bucketed by their keys: compared without a shuffle."""
    sides = moved_lines(t)
    buckets = landing.buckets_for(sides.reference, sides.delivered)
    reference, delivered = (
        landing.land_bucketed(df, t.new_table("lines"), sides.spec.keys, buckets, files_per_bucket=1)
        for df in (sides.reference, sides.delivered)
    )
    return compare(reference, delivered, sides.spec).keys_status()


@query(
    NULL_ORDERS
    + f"""
SELECT DISTINCT order_key, 'both' AS status FROM r WHERE {_has("d", "order_key", of="r")}
UNION ALL SELECT DISTINCT order_key, 'reference_only' FROM r
          WHERE NOT {_has("d", "order_key", of="r")}
UNION ALL SELECT DISTINCT order_key, 'delivered_only' FROM d
          WHERE NOT {_has("r", "order_key", of="d")}"""
)
def keys_status_null(t):
    return null_orders(t).keys_status()


@query(
    TEXT_LINES
    + f"""
SELECT DISTINCT CAST(order_key AS VARCHAR) AS order_key, 'both' AS status
          FROM r WHERE {_has("d", "order_key", of="r")}
UNION ALL SELECT DISTINCT CAST(order_key AS VARCHAR), 'reference_only' FROM r
          WHERE NOT {_has("d", "order_key", of="r")}
UNION ALL SELECT spelling, 'delivered_only' FROM d
          WHERE NOT {_has("r", "order_key", of="d")}"""
)
def keys_mixed_type(t):
    return text_lines(t).keys_status()


# --- values -----------------------------------------------------------------------------

CHANGED_ORDERS = """
WITH r AS (SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS cust, o_orderstatus AS status, o_orderpriority AS priority FROM orders),
     d AS (SELECT CASE WHEN o_orderstatus = 'P' AND o_custkey % 2 = 0 THEN -1 - o_orderkey ELSE o_orderkey END AS o_orderkey,
                  CAST(o_custkey + CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS VARCHAR) AS cust,
                  o_orderstatus AS status, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS priority FROM orders)
"""


def changed_orders(t: Tables) -> Comparison:
    """Orders against orders of which some have another customer, some no priority, and some another key."""
    key, priority = F.col("o_orderkey"), F.col("o_orderpriority")
    reference = t["orders"].select(
        "o_orderkey", F.col("o_custkey").alias("cust"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority")
    )
    moved = (F.col("o_orderstatus") == "P") & (F.col("o_custkey") % 2 == 0)
    delivered = t["orders"].select(
        F.when(moved, -1 - key).otherwise(key).alias("O_ORDERKEY"),
        (F.col("o_custkey") + (priority == "1-URGENT").cast("int")).alias("CUST"),
        F.col("o_orderstatus").alias("STATUS"),
        F.when(priority != "5-LOW", priority).alias("PRIORITY"),
    )
    return compare(reference, delivered, "o_orderkey")


@query(
    CHANGED_ORDERS
    + """
SELECT o_orderkey, CAST(1 AS BIGINT) AS row_no, 'cust' AS "column", 'changed' AS kind, r.cust AS reference_value, d.cust AS delivered_value
FROM r JOIN d USING (o_orderkey) WHERE r.cust IS DISTINCT FROM d.cust
UNION ALL SELECT o_orderkey, 1, 'status', 'changed', r.status, d.status FROM r JOIN d USING (o_orderkey) WHERE r.status IS DISTINCT FROM d.status
UNION ALL SELECT o_orderkey, 1, 'priority', 'changed', r.priority, d.priority FROM r JOIN d USING (o_orderkey) WHERE r.priority IS DISTINCT FROM d.priority"""
)
def value_diff(t):
    return changed_orders(t).value_diff()


@query(CHANGED_ORDERS + "SELECT o_orderkey FROM r JOIN d USING (o_orderkey) WHERE (r.cust, r.status, r.priority) IS DISTINCT FROM (d.cust, d.status, d.priority)")
def unequal_keys(t):
    return changed_orders(t).unequal_keys()


@query(
    """
WITH r AS (SELECT o_custkey AS cust, o_orderstatus AS status, o_orderpriority AS priority FROM orders),
     d AS (SELECT o_custkey AS cust, CASE WHEN o_orderpriority = '5-LOW' THEN 'X' ELSE o_orderstatus END AS status,
                  CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS priority FROM orders
           UNION ALL SELECT o_custkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderpriority = '2-HIGH'),
     left_only AS (SELECT * FROM r EXCEPT ALL SELECT * FROM d), right_only AS (SELECT * FROM d EXCEPT ALL SELECT * FROM r),
     a AS (SELECT *, row_number() OVER (PARTITION BY cust ORDER BY status NULLS FIRST, priority NULLS FIRST) AS row_no FROM left_only),
     b AS (SELECT *, row_number() OVER (PARTITION BY cust ORDER BY status NULLS FIRST, priority NULLS FIRST) AS row_no FROM right_only),
     p AS (SELECT coalesce(a.cust, b.cust) AS cust, coalesce(a.row_no, b.row_no) AS row_no, a.status AS s1, b.status AS s2, a.priority AS p1, b.priority AS p2,
                  CASE WHEN b.cust IS NULL THEN 'reference_row' WHEN a.cust IS NULL THEN 'delivered_row' ELSE 'changed' END AS kind
           FROM a FULL JOIN b ON a.cust = b.cust AND a.row_no = b.row_no),
     u AS (SELECT cust, row_no, 'status' AS "column", kind, s1 AS reference_value, s2 AS delivered_value FROM p
           UNION ALL SELECT cust, row_no, 'priority', kind, p1, p2 FROM p)
SELECT "column", kind, count(*) AS n_rows, count(DISTINCT cust) AS n_keys, min(reference_value) AS least_reference, max(delivered_value) AS greatest_delivered
FROM u WHERE kind <> 'changed' OR reference_value IS DISTINCT FROM delivered_value GROUP BY "column", kind"""
)
def value_diff_repeated(t):
    """Customers with many orders on either side: rows are compared as multisets. Counts of the differences."""
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    orders = t["orders"].select(F.col("o_custkey").alias("cust"), status.alias("status"), priority.alias("priority"))
    low, partial = F.col("priority") == "5-LOW", F.col("status") == "P"
    changed = orders.select("cust", F.when(low, "X").otherwise(F.col("status")).alias("status"), F.when(~partial, F.col("priority")).alias("priority"))
    found = compare(orders, changed.unionAll(orders.where("priority = '2-HIGH'")), "cust").value_diff()
    return found.groupBy("column", "kind").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("cust").alias("n_keys"),
        F.min("reference_value").alias("least_reference"), F.max("delivered_value").alias("greatest_delivered"),
    )


@query(
    ORDERS_LINEITEM
    + """SELECT side, times, count(*) AS n_keys, CAST(sum(times) AS BIGINT) AS n_rows FROM (
    SELECT 'reference' AS side, count(*) AS times FROM r GROUP BY order_key
    UNION ALL SELECT 'delivered', count(*) FROM d GROUP BY order_key) q GROUP BY side, times"""
)
def duplicate_keys(t):
    """How many orders have how many line items."""
    return orders_lineitem(t).duplicate_profile()


@query(
    """SELECT CAST(o_custkey AS VARCHAR) AS o_custkey, count(*) AS n_reference, CAST(0 AS BIGINT) AS n_delivered, FALSE AS present
FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') GROUP BY o_custkey
UNION ALL SELECT CAST(o_custkey AS VARCHAR), count(*), CAST(1 AS BIGINT), TRUE
FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') GROUP BY o_custkey
UNION ALL SELECT CAST(CASE WHEN c_mktsegment = 'BUILDING' THEN c_custkey ELSE -1 - c_custkey END AS VARCHAR), 0, 1, FALSE FROM customer
WHERE c_mktsegment <> 'BUILDING' OR c_custkey NOT IN (SELECT o_custkey FROM orders)
ORDER BY greatest(n_reference, n_delivered) DESC, o_custkey LIMIT 50"""
)
def heaviest_keys(t):
    """The customers with most orders; a part of the delivered customers' keys is turned negative."""
    key = F.col("c_custkey")
    moved = F.when(F.col("c_mktsegment") == "BUILDING", key).otherwise(-1 - key)
    return compare(t["orders"], t["customer"].select(moved.alias("o_custkey")), "o_custkey").heaviest_keys(50)


# --- totals -----------------------------------------------------------------------------


def _percent(part: str, other: str) -> str:
    # Half-up on the shortest decimal spelling of the double, as Spark's round does.
    share = f"{part}::DOUBLE / nullif({part} + {other}, 0)::DOUBLE * 100.0"
    return f"CAST(round(CAST(CAST({share} AS VARCHAR) AS DECIMAL(38, 30)), 2) AS DOUBLE)"


def _counts(*names: str, spelled: bool = False) -> str:
    keys = ", ".join(names)
    delivered = "d" if spelled else f"(SELECT DISTINCT {keys} FROM d) q"
    alias = "d" if spelled else "q"
    return f"""
, c AS (SELECT
    (SELECT count(*) FROM {delivered} WHERE {_has("r", *names, of=alias)}) AS n_present,
    (SELECT count(*) FROM {delivered} WHERE NOT {_has("r", *names, of=alias)}) AS n_absent,
    (SELECT count(*) FROM (SELECT DISTINCT {keys} FROM r) q
     WHERE NOT {_has("d", *names, of="q")}) AS n_reference_only)
"""


def _summary(r_columns: int, d_columns: int, d_rows: str = "d") -> str:
    return f"""
SELECT CAST({r_columns} AS INTEGER) AS reference_columns,
       CAST({d_columns} AS INTEGER) AS delivered_columns,
       (SELECT count(*) FROM r) AS reference_rows, (SELECT count(*) FROM {d_rows}) AS delivered_rows,
       n_present AS common_keys, n_absent AS delivered_only_keys,
       n_reference_only AS reference_only_keys,
       {_percent("n_present", "n_absent")} AS match_percent,
       {_percent("n_absent", "n_present")} AS non_match_percent FROM c"""


@query(ORDERS_LINEITEM + _counts("order_key") + _summary(6, 11))
def summary(t):
    return orders_lineitem(t).summary()


@query(MOVED_LINES + _counts("l_orderkey", "l_linenumber") + _summary(11, 11))
def summary_composite(t):
    return moved_lines(t).summary()


@query(NULL_ORDERS + _counts("order_key") + _summary(7, 7))
def summary_null(t):
    return null_orders(t).summary()


@query(TEXT_LINES + _counts("order_key", spelled=True) + _summary(6, 1, "spelled"))
def summary_mixed_type(t):
    return text_lines(t).summary()


@query(
    "SELECT 'reference' AS side, count(*) AS n_rows FROM orders "
    "UNION ALL SELECT 'delivered', count(*) FROM lineitem"
)
def row_totals(t):
    return orders_lineitem(t).row_totals()


@query(
    NULL_ORDERS
    + _counts("order_key")
    + f"""SELECT n_present, n_absent, {_percent("n_present", "n_absent")} AS match_percent,
       {_percent("n_absent", "n_present")} AS non_match_percent FROM c"""
)
def match_percent(t):
    return null_orders(t).match_percent()


# --- columns ----------------------------------------------------------------------------


@query(CUSTOMERS + "SELECT * FROM d")
def columns_lowered(t):
    return columns.lower_columns(customers(t).delivered)


@query(CUSTOMERS + "SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM d")
def columns_common(t):
    """The delivered table in the columns that it shares with the reference."""
    result = customers(t)
    return columns.pick_columns(result.delivered, result.common_columns())


@query(CUSTOMERS + "SELECT c_custkey, c_note FROM d")
def columns_delivered_only(t):
    """Keys of the delivered table with the columns that the reference lacks."""
    result = customers(t)
    return columns.pick_columns(
        result.delivered, [*result.spec.keys, *result.delivered_only_columns()]
    )


@query("SELECT c_custkey, c_acctbal FROM customer")
def columns_reference_only(t):
    """Keys of the reference table with the columns that were not delivered."""
    result = customers(t)
    return columns.pick_columns(
        result.reference, [*result.spec.keys, *result.reference_only_columns()]
    )


ALL_TABLES = (
    "benchmark", "conversations", "customer", "documents", "embeddings", "events", "labels", "lineitem", "nation", "orders", "pages", "part", "region",
    "supplier",
)


def table_pairs(t: Tables) -> dict[str, tuple[DataFrame, DataFrame]]:
    """Every table as the reference of the next one, in the order of names; columns without their table's letter."""
    bare = {n: t[n].toDF(*[re.sub("^[a-z]_", "", c) for c in t[n].columns]) for n in ALL_TABLES}
    return {f"{a}-{b}": (bare[a], bare[b]) for a, b in zip(ALL_TABLES, ALL_TABLES[1:], strict=False)}


_FILLED = " UNION ALL ".join(
    f"SELECT '{n}' AS t, CAST(row_number() OVER () AS INT) AS position, regexp_replace(lower(c), '^[a-z]_', '') AS name, filled "
    f"FROM (UNPIVOT (SELECT count(COLUMNS(*)) FROM {n}) ON COLUMNS(*) INTO NAME c VALUE filled)"
    for n in ALL_TABLES
)
_PAIRS = ", ".join(f"('{a}-{b}', '{a}', '{b}')" for a, b in zip(ALL_TABLES, ALL_TABLES[1:], strict=False))


@query(
    f"""WITH c AS ({_FILLED}), pairs(pair, reference, delivered) AS (VALUES {_PAIRS}),
rows AS (SELECT pair, 'reference' AS side, c.* EXCLUDE t FROM pairs JOIN c ON t = reference
         UNION ALL SELECT pair, 'delivered', c.* EXCLUDE t FROM pairs JOIN c ON t = delivered),
n AS (SELECT *, CAST(row_number() OVER (PARTITION BY pair, side, name ORDER BY position) AS INT) AS occurrence FROM rows)
SELECT n.*, CASE WHEN EXISTS (SELECT 1 FROM n o WHERE o.pair = n.pair AND o.side <> n.side AND o.name = n.name AND o.occurrence = n.occurrence)
                 THEN 'common' ELSE n.side || '_only' END AS status FROM n"""
)
def columns_of_pairs(t):
    """Columns of all tables, paired by rule, with what they have in common and how many values each has."""
    pairs = table_pairs(t)
    rows = catalog_columns.column_rows(t.spark, pairs)
    return catalog_columns.filled_columns(rows, pairs).drop("type")


@query(
    "SELECT c_custkey AS customer_no, c_mktsegment AS c_name, c_nationkey, c_acctbal, "
    "c_name AS c_mktsegment FROM customer"
)
def rename_by_comment(t):
    """The whole reference table under the names in its comments; two of them swap."""
    comments = {"c_custkey": "customer_no", "c_name": "c_mktsegment", "c_mktsegment": "c_name"}
    reference = t["customer"]
    for name, comment in comments.items():
        reference = reference.withMetadata(name, {"comment": comment})
    delivered = t["customer"].withColumnRenamed("c_custkey", "customer_no")
    return columns.rename_by_comment(reference, delivered)


@query(
    CUSTOMERS
    + _counts("c_custkey")
    + """
SELECT * FROM (VALUES
  (1, 'reference schema', 'c_custkey: bigint'), (2, 'reference schema', 'c_name: string'),
  (3, 'reference schema', 'c_nationkey: int'), (4, 'reference schema', 'c_acctbal: double (balance)'),
  (5, 'reference schema', 'c_mktsegment: string'), (6, 'delivered schema', 'C_CUSTKEY: bigint'),
  (7, 'delivered schema', 'C_NAME: string'), (8, 'delivered schema', 'C_NATIONKEY: int'),
  (9, 'delivered schema', 'C_MKTSEGMENT: string'), (10, 'delivered schema', 'C_NOTE: int'),
  (11, 'reference columns', '5'), (12, 'delivered columns', '5'),
  (13, 'common columns', 'c_custkey,c_name,c_nationkey,c_mktsegment'),
  (14, 'delivered-only columns', 'c_note'), (15, 'reference-only columns', 'c_acctbal')
) v(step, item, value)
UNION ALL SELECT 16, 'reference rows', CAST(count(*) AS VARCHAR) FROM r
UNION ALL SELECT 17, 'delivered rows', CAST(count(*) AS VARCHAR) FROM d
UNION ALL SELECT 18, 'common keys', CAST(n_present AS VARCHAR) FROM c
UNION ALL SELECT 19, 'delivered-only keys', CAST(n_absent AS VARCHAR) FROM c
UNION ALL SELECT 20, 'reference-only keys', CAST(n_reference_only AS VARCHAR) FROM c"""
)
def run_log(t):
    """Schemas, column lists and counts of a comparison, as a run reports them; one column has a comment."""
    sides = customers(t)
    commented = sides.reference.withMetadata("c_acctbal", {"comment": "balance"})
    return compare(commented, sides.delivered, sides.spec).log()


# --- report -----------------------------------------------------------------------------

CUSTOMER_SHEETS = (
    CUSTOMERS
    + _counts("c_custkey")
    + f"""
SELECT * FROM (VALUES
  ('Column Counts', 'Hive Table', '5'), ('Column Counts', 'CSV Table', '5'),
  ('CSV Columns', 'c_custkey', 'c_note'), ('CSV Columns', 'c_name', ''),
  ('CSV Columns', 'c_nationkey', ''), ('CSV Columns', 'c_mktsegment', '')
) v(sheet, cell_1, cell_2)
UNION ALL SELECT DISTINCT 'Primary Keys Data Present', CAST(c_custkey AS VARCHAR), NULL
          FROM r WHERE {_has("d", "c_custkey", of="r")}
UNION ALL SELECT DISTINCT 'Primary Keys Not Present', CAST(c_custkey AS VARCHAR), NULL
          FROM d WHERE NOT {_has("r", "c_custkey", of="d")}
UNION ALL SELECT 'Percentage', 'Matching Data',
                 CAST({_percent("n_present", "n_absent")} AS VARCHAR) || '%' FROM c
UNION ALL SELECT 'Percentage', 'Non Matching Data',
                 CAST({_percent("n_absent", "n_present")} AS VARCHAR) || '%' FROM c"""
)


@query(CUSTOMER_SHEETS)
def report_all_sheets(t):
    """All sheets from one pass: the keys with their flag are written, then used three times."""
    result = customers(t)
    presence = storage.stage(result.presence(), storage.new_folder(t.spark, "presence"))
    return one_table(report_sheets(result, presence), 2)


@query(CUSTOMER_SHEETS)
def report_tables(t):
    """The report written as tables of a run and read back."""
    folder = storage.new_folder(t.spark, "report")
    sheets = report_store.write_report(customers(t), folder, "dq_check_customers")
    return one_table({title: sheet.drop("run_id") for title, sheet in sheets.items()}, 2)


@query(
    TEXT_LINES
    + "SELECT DISTINCT CAST(order_key AS VARCHAR) AS order_key FROM r WHERE "
    + _has("d", "order_key", of="r")
)
def report_keys_present(t):
    result = text_lines(t)
    return key_sheet(keys.present_keys(result.presence(), result.pair))


@query(
    NULL_ORDERS
    + "SELECT DISTINCT coalesce(CAST(order_key AS VARCHAR), 'null') AS order_key FROM d WHERE NOT "
    + _has("r", "order_key", of="d")
)
def report_keys_absent(t):
    result = null_orders(t)
    return key_sheet(keys.absent_keys(result.presence(), result.pair))


@query(
    MOVED_LINES
    + """SELECT '' AS l_orderkey, CAST(l_linenumber AS VARCHAR) || '.0' AS l_linenumber
FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM d) q WHERE NOT """
    + _has("r", "l_orderkey", "l_linenumber", of="q")
)
def report_keys_absent_legacy(t):
    result = moved_lines(t)
    return key_sheet(keys.absent_keys(result.presence(), result.pair), legacy=True)


@query(
    MOVED_LINES
    + _counts("l_orderkey", "l_linenumber")
    + f"""SELECT 'Matching Data' AS type,
       CAST({_percent("n_present", "n_absent")} AS VARCHAR) || '%' AS percentage FROM c
UNION ALL SELECT 'Non Matching Data',
       CAST({_percent("n_absent", "n_present")} AS VARCHAR) || '%' FROM c"""
)
def report_percent(t):
    return totals.percent_rows(totals.key_counts(moved_lines(t).presence()))


@query(
    NULL_ORDERS
    + f""", p AS (SELECT row_number() OVER (ORDER BY order_key) AS row_no, order_key
        FROM (SELECT DISTINCT order_key FROM r WHERE {_has("d", "order_key", of="r")}) q),
  n AS (SELECT row_number() OVER (ORDER BY order_key NULLS FIRST) AS row_no,
               coalesce(CAST(order_key AS VARCHAR), 'null') AS order_key
        FROM (SELECT DISTINCT order_key FROM d WHERE NOT {_has("r", "order_key", of="d")}) q)
SELECT coalesce(p.row_no, n.row_no) AS row_no,
       coalesce(CAST(p.order_key AS VARCHAR), '') AS present,
       coalesce(n.order_key, '') AS not_present
FROM p FULL OUTER JOIN n ON p.row_no = n.row_no"""
)
def report_first_key_side_by_side(t):
    return first_key_side_by_side(null_orders(t))


# --- sources and sinks ------------------------------------------------------------------


@query("SELECT l_orderkey, l_partkey, l_returnflag FROM lineitem")
def view_scan(t):
    tables.as_view(t["lineitem"])
    return t.spark.sql(f"SELECT l_orderkey, l_partkey, l_returnflag FROM {settings.DELIVERED_VIEW}")


@query("SELECT * FROM customer")
def catalog_table(t):
    name = t.new_table("customer")
    t.spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{t.folder}/customer.parquet'")
    return tables.catalog_table(t.spark, *name.split("."))


@query("SELECT * FROM orders")
def managed_table(t):
    return landing.land_managed(t["orders"], t.new_table("orders"))


@query("SELECT * FROM part")
def empty_clone(t):
    """An empty table of the same columns, then filled with all rows."""
    name = t.new_table("part")
    landing.land_managed(landing.empty_clone(t["part"]), name)
    t["part"].write.insertInto(name)
    return t.spark.table(name)


@query(
    "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus, "
    "CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS o_orderpriority FROM orders"
)
def external_table(t):
    priority = F.col("o_orderpriority")
    delivered = t["orders"].select(
        "o_orderkey", "o_orderstatus", F.when(priority != "5-LOW", priority).alias("o_orderpriority")
    )
    path = landing.write_delimited(delivered, storage.new_folder(t.spark, "drop"), "|")
    read = tables.delimited(t.spark, path, "|")
    return landing.land_external(t.spark, read, t.new_table("orders"), path, "|")


@query(
    "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name || '|\"' || p_brand AS p_name, "
    "CASE WHEN p_size > 25 THEN CAST(p_size AS VARCHAR) END AS p_size FROM part"
)
def delimited_roundtrip(t):
    size = F.col("p_size")
    written = t["part"].select(
        "p_partkey",
        F.concat("p_name", F.lit('|"'), "p_brand").alias("p_name"),
        F.when(size > 25, size).alias("p_size"),
    )
    path = landing.write_delimited(written, storage.new_folder(t.spark, "drop"), "|")
    return tables.delivered_table(t.spark, path, "|")


@query(ORDERS_LINEITEM + _counts("order_key") + _summary(2, 2))
def text_drop(t):
    """A delivered text file against a typed catalog table, by settings and column comment."""
    database, name = t.new_table("orders").split(".")
    t.spark.sql(
        f"CREATE TABLE {database}.{name} "
        "(o_orderkey BIGINT COMMENT 'Order_Key', o_orderstatus STRING) "
        f"USING parquet LOCATION '{t.folder}/orders.parquet'"
    )
    lines = t["lineitem"].select(F.col("l_orderkey").alias("Order_Key"), "l_returnflag")
    path = landing.write_delimited(lines, storage.new_folder(t.spark, "drop"), "|")
    values = {
        settings.PRIMARY_KEYS: "order_key",
        settings.REFERENCE_DATABASE: database,
        settings.REFERENCE_TABLE: name,
        settings.DELIVERED_DELIMITER: "|",
    }
    return compare_drop(t.spark, path, values).summary()


@query("SELECT event_id, user_id, event_type, props FROM events")
def intake_archive(t):
    """All events delivered as text files, taken in once by a stream that archives them."""
    events = t["events"].select("event_id", "user_id", "event_type", "props")
    root = storage.new_folder(t.spark, "intake")
    landing.write_delimited(events, f"{root}/incoming")
    return land_drops(
        t.spark, f"{root}/incoming", f"{root}/landed", f"{root}/checkpoint", events.schema,
        archive=f"{root}/archive", prefix="part-",
    )


@query(
    """SELECT 'landed' AS kind, CAST(event_id AS VARCHAR) || ',' || user_id AS line FROM events
       WHERE event_type NOT IN ('error', 'view')
UNION ALL SELECT 'rejected', CASE event_type WHEN 'view' THEN CAST(event_id AS VARCHAR)
       ELSE 'e' || event_id || ',' || user_id END FROM events WHERE event_type IN ('error', 'view')"""
)
def landing_rejects(t):
    """All events delivered as lines: those of one type lack a cell, those of another have an unreadable one."""
    whole = F.concat_ws(",", "event_id", "user_id")
    line = F.when(F.col("event_type") == "view", F.col("event_id").cast("string"))
    line = line.when(F.col("event_type") == "error", F.concat(F.lit("e"), whole)).otherwise(whole)
    root = storage.new_folder(t.spark, "intake")
    lines = t["events"].select(line.alias("event_id,user_id"))
    lines.write.options(header=True, sep="\x01").csv(f"{root}/incoming")
    schema = "event_id bigint, user_id bigint"
    landed = land_drops(t.spark, f"{root}/incoming", f"{root}/landed", f"{root}/checkpoint", schema, prefix="part-")
    rejects = read_rejects(t.spark, rejects_of(f"{root}/landed"))
    good = landed.select(F.lit("landed").alias("kind"), F.concat_ws(",", "event_id", "user_id").alias("line"))
    return good.unionAll(rejects.select(F.lit("rejected").alias("kind"), "line"))


@query(
    """SELECT user_id AS source, event_type AS key,
       arg_max(props || '=' || event_id, event_id) AS value
FROM events GROUP BY user_id, event_type"""
)
def config_rows(t):
    """Settings of every user: one line per event, the last line of a key wins."""
    line = F.concat(
        F.lit("["), "event_type", F.lit("="), "props", F.lit("="), "event_id", F.lit("]")
    )
    return config.sheet_entries(
        t["events"].select(
            F.col("user_id").alias("source"), F.col("event_id").alias("line_no"), line.alias("line")
        )
    )


@query(
    """SELECT event_type AS source, 'user' || user_id AS key, arg_max(props, event_id) AS value
FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS n FROM events) e
WHERE n <= 110 GROUP BY event_type, user_id"""
)
def config_first_rows(t):
    """Settings of every event type from its first 110 lines; values end at a second ``=``."""
    line = F.concat(F.lit("user"), "user_id", F.lit("="), "props", F.lit("="), "event_id")
    lines = t["events"].select(
        F.col("event_type").alias("source"), F.col("event_id").alias("line_no"), line.alias("line")
    )
    return config.sheet_entries(config.first_lines(lines, settings.SETTINGS_ROWS), legacy=True)


@query(
    """SELECT doc_id AS source, CAST(i AS BIGINT) AS line_no, lines[i + 1] AS line
FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents) s,
     unnest(range(len(lines))) AS u(i)
WHERE NOT contains(lines[i + 1], '=')"""
)
def config_rejects(t):
    """Lines of all documents that are no settings."""
    lines = t["documents"].select(
        F.col("doc_id").alias("source"),
        F.posexplode(F.split("text", "\n")).alias("line_no", "line"),
    )
    return config.sheet_rejects(lines.withColumn("line_no", F.col("line_no").cast("bigint")))


@query(
    "SELECT c_name AS key, c_mktsegment || '=' || c_custkey || ' ' AS value FROM customer "
    "WHERE c_mktsegment <> 'BUILDING'"
)
def config_file(t):
    """A properties file per written partition; lines of one segment are comments."""
    start = F.when(F.col("c_mktsegment") == "BUILDING", "  #").otherwise("  ")
    line = F.concat(
        start, "c_name", F.lit(" = "), "c_mktsegment", F.lit("="), "c_custkey", F.lit(" ")
    )
    path = storage.new_folder(t.spark, "config")
    t["customer"].select(line.alias("value")).write.text(path)
    return config.properties_entries(config.text_lines(t.spark, path)).select("key", "value")


TEXT_PRICES = """
WITH p AS (SELECT CAST(CASE WHEN o_orderpriority = '5-LOW' THEN -o_totalprice ELSE o_totalprice END
                       AS DECIMAL(14,2)) AS moved, o_orderstatus FROM orders),
     d AS (SELECT moved, CAST(moved AS VARCHAR) || CASE o_orderstatus WHEN 'F' THEN '' WHEN 'O' THEN '00'
                         ELSE '4' END AS spelling, o_orderstatus IN ('F', 'O') AS exact FROM p)
SELECT min(spelling) AS price,
       exact AND moved IN (SELECT CAST(o_totalprice AS DECIMAL(14,2)) FROM orders) AS present
FROM d GROUP BY exact, moved, CASE WHEN NOT exact THEN spelling END
"""


@query(TEXT_PRICES)
def keys_text_decimal(t):
    """Prices as decimals against texts: as they are, with zeros behind, and with a digit too much."""
    price = F.col("o_totalprice").cast("decimal(14,2)")
    moved = F.when(F.col("o_orderpriority") == "5-LOW", -F.col("o_totalprice")).otherwise(F.col("o_totalprice"))
    end = F.when(F.col("o_orderstatus") == "F", "").when(F.col("o_orderstatus") == "O", "00").otherwise("4")
    spelled = F.concat(moved.cast("decimal(14,2)").cast("string"), end)
    return compare(
        t["orders"].select(price.alias("price")), t["orders"].select(spelled.alias("price")), "price"
    ).keys_found()


TEXT_DAYS = """
WITH d AS (SELECT CAST(o_orderdate AS DATE) AS day, strftime(o_orderdate, '%Y-%m-%d') || CASE
                    WHEN o_orderpriority = '5-LOW' THEN ' 10:30:00'
                    WHEN o_orderstatus = 'O' THEN ' 00:00:00' ELSE '' END AS spelling,
                  o_orderpriority <> '5-LOW' AS exact FROM orders)
SELECT min(spelling) AS day, exact AS present FROM d
GROUP BY exact, day, CASE WHEN NOT exact THEN spelling END
"""


@query(TEXT_DAYS)
def keys_text_date(t):
    """Days against texts: alone, at midnight, and at a time within the day."""
    time = (
        F.when(F.col("o_orderpriority") == "5-LOW", " 10:30:00")
        .when(F.col("o_orderstatus") == "O", " 00:00:00")
        .otherwise("")
    )
    spelled = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), time)
    reference = t["orders"].select(F.col("o_orderdate").cast("date").alias("day"))
    return compare(reference, t["orders"].select(spelled.alias("day")), "day").keys_found()


@query(
    """SELECT l_orderkey || '|' || l_linenumber ||
       CASE WHEN l_returnflag = 'R' THEN '|' || l_quantity::INTEGER || '|more' ELSE '' END AS line
FROM lineitem WHERE l_returnflag IN ('R', 'A')"""
)
def delimited_rejects(t):
    """Line items as text lines of three cells; returned ones have four, and accepted ones two."""
    cells = [F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_quantity").cast("int")]
    more = F.when(F.col("l_returnflag") == "R", F.concat_ws("|", *cells, F.lit("more")))
    line = more.when(F.col("l_returnflag") == "A", F.concat_ws("|", *cells[:2])).otherwise(F.concat_ws("|", *cells))
    lines = t["lineitem"].select(line.alias("order|line|quantity"))
    path = storage.new_folder(t.spark, "drop")
    lines.write.options(header=True, sep="\x01").csv(path)
    return tables.rejected_lines(t.spark, path, "|").select("line")


@query(
    CUSTOMERS
    + f"""SELECT 'one' AS run_id, 'c_custkey' AS key_names, CAST(c_custkey AS VARCHAR) AS key_values
FROM (SELECT DISTINCT c_custkey FROM r WHERE {_has("d", "c_custkey", of="r")}) q
UNION ALL SELECT 'two', 'c_nationkey,c_mktsegment', n || ',' || c_mktsegment
FROM (SELECT DISTINCT r.c_nationkey AS n, r.c_mktsegment FROM r JOIN d USING (c_nationkey, c_mktsegment)) q"""
)
def report_two_runs(t):
    """Keys present of two reports with other keys, read together."""
    folder, sides = storage.new_folder(t.spark, "report"), customers(t)
    for run_id, key_list in (("one", "c_custkey"), ("two", "c_nationkey,c_mktsegment")):
        report_store.write_report(compare(sides.reference, sides.delivered, key_list), folder, run_id)
    sheet = report_store.read_all(t.spark, folder, settings.SHEET_KEYS_PRESENT)
    return sheet.select("run_id", *[F.array_join(c, ",").alias(c) for c in ("key_names", "key_values")])


@query("SELECT event_id, CAST(2 AS BIGINT) AS times FROM events")
def intake_redelivered(t):
    """All events delivered as files and delivered again under the same names, beside an unreadable drop.

    Half of the files come with times long past. Every event is taken once for each delivery.
    """
    root = storage.new_folder(t.spark, "intake")
    landing.write_delimited(t["events"].select("event_id", "event_type"), f"{root}/incoming")
    t.spark.range(1).write.mode("append").parquet(f"{root}/incoming")
    path = t.spark._jvm.org.apache.hadoop.fs.Path(f"{root}/incoming")
    store = path.getFileSystem(t.spark._jsc.hadoopConfiguration())
    files = [f.getPath() for f in store.listStatus(path) if f.getPath().getName().startswith("part-")]

    def take(drop):
        if drop["name"].endswith(".parquet"):
            raise ValueError("no delimited text")
        rows = tables.delivered_table(t.spark, storage.literal_path(drop["path"]))
        rows.select(F.col("event_id").cast("bigint")).write.mode("append").parquet(f"{root}/landed")

    for hours in (1, 2):
        for i, file in enumerate(files):
            store.setTimes(file, (hours + 10_000 * (i % 2)) * 3_600_000, -1)
        with contextlib.suppress(DropsFailed):
            handle_drops(t.spark, f"{root}/incoming", take, f"{root}/ledger", prefix="part-")
    return t.spark.read.parquet(f"{root}/landed").groupBy("event_id").agg(F.count(F.lit(1)).alias("times"))


@query("SELECT event_id, event_type FROM events")
def intake_side_by_side(t):
    """All events delivered as 20 drops, of which four at a time are taken, beside two that cannot be read."""
    root = storage.new_folder(t.spark, "intake")
    landing.write_delimited(t["events"].select("event_id", "event_type").repartition(20), f"{root}/incoming")
    t.spark.range(0, 2, 1, 2).write.mode("append").parquet(f"{root}/incoming")

    def take(drop):
        if drop["name"].endswith(".parquet"):
            raise ValueError("no delimited text")
        own = storage.own_session(t.spark)
        rows = tables.delivered_table(own, storage.literal_path(drop["path"]))
        rows.select(F.col("event_id").cast("bigint"), "event_type").write.parquet(f"{root}/landed/drop={drop['run_id']}")

    with contextlib.suppress(DropsFailed):
        handle_drops(t.spark, f"{root}/incoming", take, f"{root}/ledger", prefix="part-", at_once=4)
    return t.spark.read.parquet(f"{root}/landed").drop("drop")


# --- names and orders -------------------------------------------------------------------


@query(
    r"""SELECT page_id, CASE WHEN name = '' THEN 'pages_CSV' ELSE split_part(name, '.', 1) END
       AS table_name
FROM (SELECT page_id, regexp_extract(url, '([^/\\]*)$', 1) AS name FROM pages) p"""
)
def table_name_from_path(t):
    return t["pages"].select("page_id", table_name(F.col("url"), "pages").alias("table_name"))


@query(r"SELECT page_id, nullif(regexp_extract(url, '^(.*[/\\])', 1), '') AS folder FROM pages")
def folder_from_path(t):
    return t["pages"].select("page_id", folder_of(F.col("url")).alias("folder"))


@query(
    rf"""SELECT event_id, 'dq_check_' || event_type || '{settings.RUN_NAME_PART}' ||
       regexp_replace(strftime(ts, '%Y-%m-%dT%H.%M.%S.%g'), '(\.\d+?)0+$', '\1') AS run_id
FROM events"""
)
def run_names(t):
    file = F.concat(F.lit("dq_check_"), "event_type", F.lit("."), "user_id", F.lit(".csv"))
    return t["events"].select("event_id", run_name(file, F.col("ts")).alias("run_id"))


@query(
    """SELECT user_id, name, ts AS "modificationTime", '/drops/' || user_id || '/' || name AS path
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, name DESC) AS n
      FROM (SELECT user_id, ts,
                   CASE event_type WHEN 'click' THEN 'DQ_Check_' WHEN 'view' THEN 'dq_check_'
                                   WHEN 'error' THEN 'dqxcheckx' ELSE 'other_' END
                   || event_id || '.csv' AS name FROM events) f
      WHERE starts_with(lower(name), 'dq_check_')) g
WHERE n = 1"""
)
def latest_drop(t):
    """The newest drop of every user's folder, from a listing with one file per event."""
    prefix = (
        F.when(F.col("event_type") == "click", "DQ_Check_")
        .when(F.col("event_type") == "view", "dq_check_")
        .when(F.col("event_type") == "error", "dqxcheckx")
        .otherwise("other_")
    )
    path = F.concat(F.lit("/drops/"), "user_id", F.lit("/"), prefix, "event_id", F.lit(".csv"))
    listing = t["events"].select(
        "user_id", path.alias("path"), F.col("ts").alias("modificationTime")
    )
    return drops.newest_drop(listing, by=["user_id"])


@query("SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def top_desc(t):
    return top_rows(t["orders"], "o_totalprice", 100, tie_break="o_orderkey")


@query("SELECT * FROM events ORDER BY event_id LIMIT 110")
def first_rows_in_order(t):
    return first_rows(t["events"], ["event_id"], settings.SETTINGS_ROWS)
