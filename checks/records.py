"""Whole records: one table, slices, audit columns, statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.mapping import AUDIT_SQL, BATCH, EVENT_RECORDS_SQL, MOMENT, event_records, table
from tidemark.operators.audit import add_audit_columns, key_first
from tidemark.operators.metrics import row_count, run_totals, throughput
from tidemark.operators.slices import batch_stats, number_batches
from tidemark.plans.records import process_slices, process_table
from tidemark.schema import BATCH as BATCH_COLUMN
from tidemark.schema import PATH, ROW
from tidemark.sources.parquet import read_parquet

SLICE = 1000


def process_table_events(spark, sf_dir):
    rows = process_table(event_records(spark, sf_dir), BATCH, MOMENT, tiebreak=["event_id"])
    return rows.drop("event_id")


PROCESS_TABLE_EVENTS = f"""
    SELECT id, name, email, status, updated_at, payload, {AUDIT_SQL}
    FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY updated_at DESC NULLS LAST, event_id DESC) AS rn
          FROM ({EVENT_RECORDS_SQL}))
    WHERE rn = 1
"""


def sliced_orders(spark, sf_dir):
    """Orders as records with their position in the file."""
    return read_parquet(spark, f"{sf_dir}/orders.parquet").select(
        F.col("o_custkey").alias("id"),
        F.col("o_orderpriority").alias("name"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").alias("updated_at"),
        F.col("o_orderkey").cast("string").alias("payload"),
        PATH,
        ROW,
    )


SLICED_ORDERS_SQL = f"""
    SELECT o_custkey AS id, o_orderpriority AS name, o_orderstatus AS status, o_orderdate AS updated_at,
           CAST(o_orderkey AS VARCHAR) AS payload, o_orderkey AS row_no,
           CAST(o_orderkey // {SLICE} + 1 AS INTEGER) AS batch_num
    FROM orders
"""


def batch_slices_orders(spark, sf_dir):
    rows = number_batches(read_parquet(spark, f"{sf_dir}/orders.parquet"), SLICE)
    return rows.select("o_orderkey", "o_custkey", F.col(BATCH_COLUMN).alias("batch_num"))


BATCH_SLICES_ORDERS = f"""
    SELECT o_orderkey, o_custkey, CAST(o_orderkey // {SLICE} + 1 AS INTEGER) AS batch_num FROM orders
"""


def batch_stats_orders(spark, sf_dir):
    rows = number_batches(sliced_orders(spark, sf_dir), SLICE)
    return batch_stats(rows).withColumnRenamed(BATCH_COLUMN, "batch_num").drop(PATH)


BATCH_STATS_ORDERS = f"""
    SELECT batch_num, count(*) AS input_rows, count(DISTINCT id) AS output_rows,
           count(*) - count(DISTINCT id) AS duplicates_removed
    FROM ({SLICED_ORDERS_SQL}) GROUP BY batch_num
"""


def table_stats_events(spark, sf_dir):
    return batch_stats(event_records(spark, sf_dir), by=())


TABLE_STATS_EVENTS = """
    SELECT count(*) AS input_rows, count(DISTINCT user_id) AS output_rows,
           count(*) - count(DISTINCT user_id) AS duplicates_removed FROM events
"""


def process_slices_orders(spark, sf_dir):
    rows = process_slices(sliced_orders(spark, sf_dir), SLICE, BATCH, MOMENT)
    return rows.withColumnRenamed(BATCH_COLUMN, "batch_num").drop(PATH, ROW)


PROCESS_SLICES_ORDERS = f"""
    SELECT id, name, status, updated_at, payload, batch_num,
           TIMESTAMP '2024-06-01 02:00:00' AS _etl_processed_at,
           '{BATCH}_b' || batch_num AS _etl_batch_id
    FROM (SELECT *, row_number() OVER (PARTITION BY batch_num, id ORDER BY updated_at DESC, row_no DESC) AS rn
          FROM ({SLICED_ORDERS_SQL}))
    WHERE rn = 1
"""


def audit_columns(spark, sf_dir):
    return add_audit_columns(table(spark, sf_dir, "customer"), BATCH, MOMENT)


AUDIT_COLUMNS = f"SELECT *, {AUDIT_SQL} FROM customer"


def key_first_orders(spark, sf_dir):
    """Position of each column once the key has been moved to the front, next to its rows."""
    rows = key_first(table(spark, sf_dir, "orders"), "o_custkey")
    order = ",".join(rows.columns)
    return rows.select("*", F.lit(order).alias("column_order"))


KEY_FIRST_ORDERS = """
    SELECT *, 'o_custkey,o_orderkey,o_orderstatus,o_totalprice,o_orderdate,o_orderpriority' AS column_order
    FROM orders
"""


def row_count_lineitem(spark, sf_dir):
    return row_count(table(spark, sf_dir, "lineitem"))


ROW_COUNT_LINEITEM = "SELECT count(*) AS rows FROM lineitem"


def run_totals_orders(spark, sf_dir):
    """Each order as a file result; orders in state P stand for failed files."""
    results = table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderstatus") == "P", "failed").otherwise("ok").alias("status"),
        F.col("o_custkey").alias("records"),
        F.length("o_orderpriority").cast("bigint").alias("records_failed"),
    )
    return run_totals(results)


RUN_TOTALS_ORDERS = """
    SELECT count(*) FILTER (o_orderstatus <> 'P') AS files_processed,
           count(*) FILTER (o_orderstatus = 'P') AS files_failed,
           CAST(sum(o_custkey) FILTER (o_orderstatus <> 'P') AS BIGINT) AS records_processed,
           CAST(sum(length(o_orderpriority)) FILTER (o_orderstatus <> 'P') AS BIGINT) AS records_failed
    FROM orders
"""


def run_throughput_lineitem(spark, sf_dir):
    """Runs from 1995 on, ended at the ship date; rows per second of each."""
    start = F.lit("1990-01-01 00:00:00").cast("timestamp")
    runs = table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("run_id"),
        start.alias("start_time"),
        F.col("l_shipdate").cast("timestamp").alias("end_time"),
        F.col("l_orderkey").alias("records_processed"),
    )
    return throughput(runs)


RUN_THROUGHPUT_LINEITEM = """
    SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey AS run_id,
           (epoch_us(l_shipdate) - epoch_us(TIMESTAMP '1990-01-01')) / 1e6 AS latency_seconds,
           l_orderkey / ((epoch_us(l_shipdate) - epoch_us(TIMESTAMP '1990-01-01')) / 1e6) AS rows_per_second
    FROM lineitem
"""

CHECKS = {
    "process_table_events": (process_table_events, PROCESS_TABLE_EVENTS),
    "batch_slices_orders": (batch_slices_orders, BATCH_SLICES_ORDERS),
    "batch_stats_orders": (batch_stats_orders, BATCH_STATS_ORDERS),
    "table_stats_events": (table_stats_events, TABLE_STATS_EVENTS),
    "process_slices_orders": (process_slices_orders, PROCESS_SLICES_ORDERS),
    "audit_columns": (audit_columns, AUDIT_COLUMNS),
    "key_first_orders": (key_first_orders, KEY_FIRST_ORDERS),
    "row_count_lineitem": (row_count_lineitem, ROW_COUNT_LINEITEM),
    "run_totals_orders": (run_totals_orders, RUN_TOTALS_ORDERS),
    "run_throughput_lineitem": (run_throughput_lineitem, RUN_THROUGHPUT_LINEITEM),
}
