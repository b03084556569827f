"""Upserts, their closed form over many arrivals, and the change feed.

The stored table is the latest order per customer and priority among the orders in
state F or P, the incoming one the same among those in state O or P. Together they
cover the whole table, and every kind of change occurs.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.mapping import table
from checks.records import SLICE, SLICED_ORDERS_SQL, sliced_orders
from tidemark.operators.dedup import dedup_latest
from tidemark.operators.slices import number_batches
from tidemark.operators.upsert import change_feed, fold_arrivals, upsert
from tidemark.schema import BATCH, PATH, ROW, SUPPLIED

KEYS = ["o_custkey", "o_orderpriority"]


def _side(spark, sf_dir, *states):
    orders = table(spark, sf_dir, "orders").where(F.col("o_orderstatus").isin(*states))
    return dedup_latest(orders, KEYS, ["o_orderdate"], tiebreak=["o_orderkey"])


def _side_sql(*states):
    listed = ", ".join(f"'{s}'" for s in states)
    return f"""(SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderpriority
                                     ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
        FROM orders WHERE o_orderstatus IN ({listed})) WHERE rn = 1)"""


_JOIN_SQL = f"""
    FROM {_side_sql('F', 'P')} t
    FULL JOIN {_side_sql('O', 'P')} u
      ON t.o_custkey = u.o_custkey AND t.o_orderpriority = u.o_orderpriority
"""


def _merged_sql(take: str) -> str:
    columns = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    picked = ", ".join(f"CASE WHEN {take} THEN u.{c} ELSE t.{c} END AS {c}" for c in columns)
    return f"SELECT {picked} {_JOIN_SQL}"


def upsert_arrival(spark, sf_dir):
    return upsert(_side(spark, sf_dir, "F", "P"), _side(spark, sf_dir, "O", "P"), KEYS)


def upsert_latest(spark, sf_dir):
    return upsert(
        _side(spark, sf_dir, "F", "P"),
        _side(spark, sf_dir, "O", "P"),
        KEYS,
        conflict="latest",
        order_by="o_orderdate",
    )


def upsert_partial_columns(spark, sf_dir):
    """Updates without state and order key; a price supplied as NULL overwrites."""
    updates = _side(spark, sf_dir, "O", "P").select(
        *KEYS,
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("o_totalprice"),
        "o_orderdate",
    )
    rows = upsert(_side(spark, sf_dir, "F", "P"), updates, KEYS)
    return rows.withColumn("o_orderkey", F.col("o_orderkey").cast("string"))


UPSERT_PARTIAL_COLUMNS = f"""
    SELECT CAST(t.o_orderkey AS VARCHAR) AS o_orderkey, coalesce(t.o_custkey, u.o_custkey) AS o_custkey, t.o_orderstatus,
           CASE WHEN u.o_custkey IS NULL THEN t.o_totalprice
                WHEN u.o_orderstatus <> 'P' THEN u.o_totalprice END AS o_totalprice,
           CASE WHEN u.o_custkey IS NULL THEN t.o_orderdate ELSE u.o_orderdate END AS o_orderdate,
           coalesce(t.o_orderpriority, u.o_orderpriority) AS o_orderpriority
    {_JOIN_SQL}
"""


def change_feed_orders(spark, sf_dir):
    feed = change_feed(
        _side(spark, sf_dir, "F", "P"),
        _side(spark, sf_dir, "O", "P"),
        KEYS,
        order_by="o_orderdate",
        include_untouched=True,
    )
    return feed.withColumnRenamed("_change_type", "change_type")


def _feed_sql(join: str) -> str:
    columns = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    shown = ", ".join(f"CASE WHEN u.o_custkey IS NULL THEN t.{c} ELSE u.{c} END AS {c}" for c in columns)
    return f"""
    SELECT {shown}, CASE WHEN u.o_custkey IS NULL THEN 'untouched' WHEN t.o_custkey IS NULL THEN 'insert'
                         WHEN u.o_orderdate < t.o_orderdate THEN 'stale'
                         WHEN u.o_orderkey = t.o_orderkey THEN 'unchanged' ELSE 'update' END AS change_type
    {_JOIN_SQL.replace('FULL JOIN', join)}
"""


def change_feed_incoming_only(spark, sf_dir):
    feed = change_feed(
        _side(spark, sf_dir, "F", "P"), _side(spark, sf_dir, "O", "P"), KEYS, order_by="o_orderdate"
    )
    return feed.withColumnRenamed("_change_type", "change_type")


def replay_arrivals_orders(spark, sf_dir):
    """What is left after upserting the file slice by slice, each slice deduplicated on its own."""
    rows = number_batches(sliced_orders(spark, sf_dir), SLICE)
    return fold_arrivals(
        rows.drop("batch_num"),
        ["id"],
        [PATH, BATCH, "updated_at", ROW],
        ["name", "status", "updated_at", "payload"],
    )


REPLAY_ARRIVALS_ORDERS = f"""
    SELECT id, name, status, updated_at, payload
    FROM (SELECT *, row_number() OVER (PARTITION BY id
                    ORDER BY batch_num DESC, updated_at DESC NULLS LAST, row_no DESC) AS rn
          FROM ({SLICED_ORDERS_SQL}))
    WHERE rn = 1
"""


def replay_partial_arrivals(spark, sf_dir):
    """Arrivals that supply different columns.

    State F supplies price and date, O the priority, P all three but a NULL price.
    """
    state = F.col("o_orderstatus")
    rows = table(spark, sf_dir, "orders").select(
        "o_custkey",
        "o_orderkey",
        F.when(state != "P", F.col("o_totalprice")).alias("o_totalprice"),
        "o_orderdate",
        "o_orderpriority",
        F.when(state == "F", F.array(F.lit("o_totalprice"), F.lit("o_orderdate")))
        .when(state == "O", F.array(F.lit("o_orderpriority")))
        .otherwise(F.array(F.lit("o_totalprice"), F.lit("o_orderdate"), F.lit("o_orderpriority")))
        .alias(SUPPLIED),
    )
    folded = fold_arrivals(
        rows, ["o_custkey"], ["o_orderkey"], ["o_totalprice", "o_orderdate", "o_orderpriority"]
    )
    return folded.withColumn(SUPPLIED, F.concat_ws(",", SUPPLIED)).withColumnRenamed(
        SUPPLIED, "supplied"
    )


def _last_supplied(column: str, value: str, states: str) -> str:
    return f"""(SELECT o_custkey, {value} AS {column} FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn
        FROM orders WHERE o_orderstatus IN ({states})) WHERE rn = 1)"""


REPLAY_PARTIAL_ARRIVALS = f"""
    SELECT k.o_custkey, a.o_totalprice, b.o_orderdate, c.o_orderpriority,
           concat_ws(',', 'o_custkey', CASE WHEN a.o_custkey IS NOT NULL THEN 'o_totalprice' END,
                     CASE WHEN b.o_custkey IS NOT NULL THEN 'o_orderdate' END,
                     CASE WHEN c.o_custkey IS NOT NULL THEN 'o_orderpriority' END) AS supplied
    FROM (SELECT DISTINCT o_custkey FROM orders) k
    LEFT JOIN {_last_supplied('o_totalprice', "CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END", "'F', 'P'")} a USING (o_custkey)
    LEFT JOIN {_last_supplied('o_orderdate', 'o_orderdate', "'F', 'P'")} b USING (o_custkey)
    LEFT JOIN {_last_supplied('o_orderpriority', 'o_orderpriority', "'O', 'P'")} c USING (o_custkey)
"""

CHECKS = {
    "upsert_arrival": (upsert_arrival, _merged_sql("u.o_custkey IS NOT NULL")),
    "upsert_latest": (
        upsert_latest,
        _merged_sql("u.o_custkey IS NOT NULL AND (t.o_custkey IS NULL OR u.o_orderdate >= t.o_orderdate)"),
    ),
    "upsert_partial_columns": (upsert_partial_columns, UPSERT_PARTIAL_COLUMNS),
    "change_feed_orders": (change_feed_orders, _feed_sql("FULL JOIN")),
    "change_feed_incoming_only": (change_feed_incoming_only, _feed_sql("RIGHT JOIN")),
    "replay_arrivals_orders": (replay_arrivals_orders, REPLAY_ARRIVALS_ORDERS),
    "replay_partial_arrivals": (replay_partial_arrivals, REPLAY_PARTIAL_ARRIVALS),
}
