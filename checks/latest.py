"""Latest row per key: ties, NULL dates, composite keys, key violations."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.mapping import event_records, table
from tidemark.operators.dedup import dedup_latest
from tidemark.operators.validate import key_violations


def dedup_latest_orders_ties(spark, sf_dir):
    """Some customers have two orders on their latest date; the higher order key wins."""
    return dedup_latest(
        table(spark, sf_dir, "orders"), ["o_custkey"], ["o_orderdate"], tiebreak=["o_orderkey"]
    )


DEDUP_LATEST_ORDERS_TIES = """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
    FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
          FROM orders)
    WHERE rn = 1
"""


def _undated_errors(spark, sf_dir):
    rows = event_records(spark, sf_dir)
    return rows.withColumn("updated_at", F.when(F.col("status") != "error", F.col("updated_at")))


def _undated_errors_sql(nulls: str) -> str:
    return f"""
    SELECT id, status, updated_at, event_id
    FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY updated_at DESC NULLS {nulls}, event_id DESC) AS rn
          FROM (SELECT user_id AS id, event_type AS status, event_id,
                       CASE WHEN event_type <> 'error' THEN ts END AS updated_at FROM events))
    WHERE rn = 1
"""


def dedup_latest_nulls_last(spark, sf_dir):
    rows = dedup_latest(_undated_errors(spark, sf_dir), tiebreak=["event_id"])
    return rows.select("id", "status", "updated_at", "event_id")


def dedup_latest_nulls_first(spark, sf_dir):
    rows = dedup_latest(_undated_errors(spark, sf_dir), tiebreak=["event_id"], nulls="first")
    return rows.select("id", "status", "updated_at", "event_id")


def dedup_null_key(spark, sf_dir):
    """Rows without a key count as one key; here every error event loses its user."""
    rows = event_records(spark, sf_dir)
    rows = rows.withColumn("id", F.when(F.col("status") != "error", F.col("id")))
    rows = dedup_latest(rows, tiebreak=["event_id"])
    return rows.select(F.col("id").cast("string").alias("id"), "status", "updated_at", "event_id")


DEDUP_NULL_KEY = """
    SELECT CAST(id AS VARCHAR) AS id, status, updated_at, event_id
    FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY updated_at DESC, event_id DESC) AS rn
          FROM (SELECT CASE WHEN event_type <> 'error' THEN user_id END AS id, event_type AS status,
                       event_id, ts AS updated_at FROM events))
    WHERE rn = 1
"""


def dedup_composite_lineitem(spark, sf_dir):
    return dedup_latest(
        table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"]
    )


DEDUP_COMPOSITE_LINEITEM = """
    SELECT * EXCLUDE (rn)
    FROM (SELECT *, row_number() OVER (
                 PARTITION BY l_orderkey, l_linenumber
                 ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
                          l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC,
                          l_linestatus DESC) AS rn
          FROM lineitem)
    WHERE rn = 1
"""


def pk_violations_lineitem(spark, sf_dir):
    return key_violations(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


PK_VIOLATIONS_LINEITEM = """
    SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
    GROUP BY ALL HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL
"""

CHECKS = {
    "dedup_latest_orders_ties": (dedup_latest_orders_ties, DEDUP_LATEST_ORDERS_TIES),
    "dedup_latest_nulls_last": (dedup_latest_nulls_last, _undated_errors_sql("LAST")),
    "dedup_latest_nulls_first": (dedup_latest_nulls_first, _undated_errors_sql("FIRST")),
    "dedup_null_key": (dedup_null_key, DEDUP_NULL_KEY),
    "dedup_composite_lineitem": (dedup_composite_lineitem, DEDUP_COMPOSITE_LINEITEM),
    "pk_violations_lineitem": (pk_violations_lineitem, PK_VIOLATIONS_LINEITEM),
}
