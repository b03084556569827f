"""Type conversion, NULL handling, validation and quarantine."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.mapping import event_records, table
from tidemark.functions.convert import iso_text, parse_mark_time
from tidemark.operators.normalize import cast_failure_counts, fill_nulls, normalize
from tidemark.operators.validate import check_rows, error_rate, split_quarantine
from tidemark.schema import ERRORS, RAW


def cast_string(spark, sf_dir):
    """Numbers under the names of text columns."""
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("name"),
        (F.col("o_orderstatus") == "F").alias("status"),
        F.col("o_orderdate").cast("date").alias("payload"),
    )
    return normalize(rows)


CAST_STRING = """
    SELECT o_orderkey AS id, CAST(o_custkey AS VARCHAR) AS name,
           CASE WHEN o_orderstatus = 'F' THEN 'true' ELSE 'false' END AS status,
           strftime(o_orderdate, '%Y-%m-%d') AS payload
    FROM orders
"""


def _text_ids(spark, sf_dir):
    """Keys as text; the priority decides whether and how the text is off."""
    key = F.col("o_orderkey").cast("string")
    priority = F.col("o_orderpriority")
    text = (
        F.when(priority == "1-URGENT", key)
        .when(priority == "2-HIGH", F.concat(F.lit(" "), key, F.lit(" ")))
        .when(priority == "3-MEDIUM", F.concat(key, F.lit(".5")))
        .when(priority == "4-NOT SPECIFIED", F.concat(F.lit("9999999999999999999"), key))
        .otherwise(F.concat(F.lit("-"), key))
    )
    return table(spark, sf_dir, "orders").select(
        text.alias("id"), F.col("o_orderstatus").alias("name"), "o_orderkey"
    )


_TEXT_IDS_SQL = """
    SELECT o_orderkey, o_orderstatus AS name, CASE o_orderpriority
        WHEN '1-URGENT' THEN CAST(o_orderkey AS VARCHAR)
        WHEN '2-HIGH' THEN ' ' || o_orderkey || ' '
        WHEN '3-MEDIUM' THEN o_orderkey || '.5'
        WHEN '4-NOT SPECIFIED' THEN '9999999999999999999' || o_orderkey
        ELSE '-' || o_orderkey END AS text
    FROM orders
"""
_ID_SQL = r"CASE WHEN regexp_full_match(trim(text), '[+-]?\d+') THEN TRY_CAST(trim(text) AS BIGINT) END"


def cast_int_try(spark, sf_dir):
    """The parsed numbers, written out as text again."""
    rows = normalize(_text_ids(spark, sf_dir))
    return rows.withColumn("id", F.col("id").cast("string"))


CAST_INT_TRY = f"SELECT CAST({_ID_SQL} AS VARCHAR) AS id, name, o_orderkey FROM ({_TEXT_IDS_SQL})"


def _text_dates(spark, sf_dir):
    """Order dates as text, in a shape that the priority decides."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    priority = F.col("o_orderpriority")
    text = (
        F.when(priority == "1-URGENT", F.concat(day, F.lit("T10:20:30")))
        .when(priority == "2-HIGH", F.concat(day, F.lit("T10:20:30.5")))
        .when(priority == "3-MEDIUM", F.concat(day, F.lit(" 10:20:30")))
        .when(
            priority == "4-NOT SPECIFIED",
            F.when(F.col("o_orderstatus") == "F", day).otherwise(F.concat(day, F.lit("T10:20:30Z"))),
        )
        .otherwise(F.concat(F.substring(day, 1, 8), F.lit("40T10:20:30.123456")))
    )
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), text.alias("updated_at")
    )


def parse_iso_ts(spark, sf_dir):
    return normalize(_text_dates(spark, sf_dir))


PARSE_ISO_TS = """
    SELECT o_orderkey AS id, CASE o_orderpriority
        WHEN '1-URGENT' THEN CAST(strftime(o_orderdate, '%Y-%m-%d') || ' 10:20:30' AS TIMESTAMP)
        WHEN '2-HIGH' THEN CAST(strftime(o_orderdate, '%Y-%m-%d') || ' 10:20:30.5' AS TIMESTAMP)
        END AS updated_at
    FROM orders
"""


def cast_failures_orders(spark, sf_dir):
    rows = _text_ids(spark, sf_dir).join(
        _text_dates(spark, sf_dir).withColumnRenamed("id", "o_orderkey"), "o_orderkey"
    )
    return cast_failure_counts(rows)


CAST_FAILURES_ORDERS = f"""
    SELECT (SELECT count(*) FROM ({_TEXT_IDS_SQL}) WHERE {_ID_SQL} IS NULL) AS id,
           CAST(0 AS BIGINT) AS name,
           (SELECT count(*) FROM orders
            WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH')) AS updated_at
"""


def cast_keep_column(spark, sf_dir):
    """``id`` has values that cannot be cast, so the whole column stays text; ``payload`` is cast."""
    rows = _text_ids(spark, sf_dir).withColumn("payload", F.col("o_orderkey"))
    return normalize(rows, on_error="keep_column")


CAST_KEEP_COLUMN = f"""
    SELECT text AS id, name, o_orderkey, CAST(o_orderkey AS VARCHAR) AS payload FROM ({_TEXT_IDS_SQL})
"""


def cast_quarantine(spark, sf_dir):
    """Rows set aside by a failed cast, with their errors and the untouched values."""
    rows = normalize(_text_ids(spark, sf_dir), on_error="quarantine")
    _, bad = split_quarantine(rows)
    return bad.select(
        "o_orderkey",
        F.col("id").isNull().alias("id_rejected"),
        F.concat_ws(",", ERRORS).alias("errors"),
        F.get_json_object(RAW, "$.id").alias("raw_id"),
    )


CAST_QUARANTINE = f"""
    SELECT o_orderkey, true AS id_rejected, 'cast:id' AS errors, text AS raw_id
    FROM ({_TEXT_IDS_SQL}) WHERE {_ID_SQL} IS NULL
"""


def null_policy_events(spark, sf_dir):
    rows = event_records(spark, sf_dir).select(
        "event_id",
        F.when(F.col("status") != "error", F.col("status")).alias("status"),
        F.when(F.col("status") != "view", F.col("payload")).alias("payload"),
    )
    return fill_nulls(rows, {"status": "unknown"})


NULL_POLICY_EVENTS = """
    SELECT event_id, coalesce(nullif(event_type, 'error'), 'unknown') AS status,
           CASE WHEN event_type <> 'view' THEN props END AS payload
    FROM events
"""


def _document_records(spark, sf_dir):
    """Documents as records: the text stands in for the name, a missing language for the key."""
    return table(spark, sf_dir, "documents").select(
        F.when(F.col("lang") != "en", F.col("doc_id")).alias("id"),
        F.col("text").alias("name"),
        F.col("source").alias("status"),
    )


_DOCUMENT_ERRORS_SQL = """
    SELECT doc_id, concat_ws(',', CASE WHEN lang = 'en' OR lang IS NULL THEN 'null:id' END,
                             CASE WHEN length(text) > 255 THEN 'length:name' END,
                             CASE WHEN length(source) > 50 THEN 'length:status' END) AS errors
    FROM documents
"""


def varchar_limits_documents(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("name"), "source")
    checked = check_rows(rows, required=(), limits={"name": 255, "source": 50})
    return checked.select("doc_id", F.concat_ws(",", ERRORS).alias("errors"))


VARCHAR_LIMITS_DOCUMENTS = """
    SELECT doc_id, concat_ws(',', CASE WHEN length(text) > 255 THEN 'length:name' END,
                             CASE WHEN length(source) > 50 THEN 'length:source' END) AS errors
    FROM documents
"""


def quarantine_split_documents(spark, sf_dir):
    """Both sides of the split, counted by the errors found."""
    checked = check_rows(_document_records(spark, sf_dir))
    good, bad = split_quarantine(checked)
    sides = good.withColumn("side", F.lit("good")).unionByName(bad.withColumn("side", F.lit("bad")))
    return sides.groupBy("side", F.concat_ws(",", ERRORS).alias("errors")).agg(
        F.count(F.lit(1)).alias("n")
    )


QUARANTINE_SPLIT_DOCUMENTS = f"""
    SELECT CASE WHEN errors = '' THEN 'good' ELSE 'bad' END AS side, errors, count(*) AS n
    FROM ({_DOCUMENT_ERRORS_SQL}) GROUP BY ALL
"""


def error_rate_gate_documents(spark, sf_dir):
    return error_rate(check_rows(_document_records(spark, sf_dir)))


ERROR_RATE_GATE_DOCUMENTS = f"""
    SELECT count(*) AS rows_total, count(*) FILTER (errors <> '') AS rows_failed,
           count(*) FILTER (errors <> '') / count(*) AS error_rate,
           count(*) FILTER (errors <> '') / count(*) < 0.001 AS within_limit
    FROM ({_DOCUMENT_ERRORS_SQL})
"""


def iso_text_events(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", iso_text(F.col("ts")).alias("ts_text"))


ISO_TEXT_EVENTS = "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS ts_text FROM events"


def mark_time_orders(spark, sf_dir):
    """Mark times as text, some with ``Z`` and some with an offset, as microseconds of the instant."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    suffix = F.when(F.col("o_orderstatus") == "F", "Z").otherwise("+02:00")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.unix_micros(parse_mark_time(F.concat(day, suffix))).alias("instant_us")
    )


MARK_TIME_ORDERS = """
    SELECT o_orderkey, epoch_us(o_orderdate)
           - CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 7200000000 END AS instant_us
    FROM orders
"""

CHECKS = {
    "cast_string": (cast_string, CAST_STRING),
    "cast_int_try": (cast_int_try, CAST_INT_TRY),
    "parse_iso_ts": (parse_iso_ts, PARSE_ISO_TS),
    "cast_failures_orders": (cast_failures_orders, CAST_FAILURES_ORDERS),
    "cast_keep_column": (cast_keep_column, CAST_KEEP_COLUMN),
    "cast_quarantine": (cast_quarantine, CAST_QUARANTINE),
    "null_policy_events": (null_policy_events, NULL_POLICY_EVENTS),
    "varchar_limits_documents": (varchar_limits_documents, VARCHAR_LIMITS_DOCUMENTS),
    "quarantine_split_documents": (quarantine_split_documents, QUARANTINE_SPLIT_DOCUMENTS),
    "error_rate_gate_documents": (error_rate_gate_documents, ERROR_RATE_GATE_DOCUMENTS),
    "iso_text_events": (iso_text_events, ISO_TEXT_EVENTS),
    "mark_time_orders": (mark_time_orders, MARK_TIME_ORDERS),
}
