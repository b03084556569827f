"""How the shared test tables stand in for records, listings and logs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH = "run-2024-06-01"
MOMENT = datetime(2024, 6, 1, 2, 0, 0)

# The audit columns in SQL.
AUDIT_SQL = f"TIMESTAMP '2024-06-01 02:00:00' AS _etl_processed_at, '{BATCH}' AS _etl_batch_id"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as raw records, with ``event_id`` to break ties."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("id"),
        F.concat(F.lit("user_"), F.col("user_id")).alias("name"),
        F.concat(F.lit("user_"), F.col("user_id"), F.lit("@example.com")).alias("email"),
        F.col("event_type").alias("status"),
        F.col("ts").alias("updated_at"),
        F.col("props").alias("payload"),
        "event_id",
    )


EVENT_RECORDS_SQL = """
    SELECT user_id AS id, 'user_' || user_id AS name, 'user_' || user_id || '@example.com' AS email,
           event_type AS status, ts AS updated_at, props AS payload, event_id
    FROM events
"""


def order_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a file listing: a path per order, its date as modification time."""
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("raw/"), F.lpad(F.col("o_orderkey").cast("string"), 10, "0"), F.lit(".parquet")).alias("path"),
        F.col("o_orderdate").alias("modificationTime"),
        F.col("o_custkey").alias("length"),
        F.col("o_orderstatus"),
    )


ORDER_LISTING_SQL = """
    SELECT 'raw/' || lpad(CAST(o_orderkey AS VARCHAR), 10, '0') || '.parquet' AS path,
           o_orderdate AS "modificationTime", o_custkey AS length, o_orderstatus
    FROM orders
"""
