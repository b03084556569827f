"""High-water marks and failed-file logs, in memory and through storage."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from checks.mapping import ORDER_LISTING_SQL, table
from tidemark.schema import MARK_SCHEMA
from tidemark.session import scratch_dir
from tidemark.state.deadletter import failed_rows, failures_of, log_failure, read_failed_log, write_failed_log
from tidemark.state.ledger import from_json_text, latest_mark, read_marks, to_json_text


def _marks(spark, sf_dir):
    """Every order as a mark: its date as the run time, its key as the id."""
    return table(spark, sf_dir, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("last_successful_run"),
        F.concat(F.lit("raw/"), F.lpad(F.col("o_orderkey").cast("string"), 10, "0"), F.lit(".parquet")).alias(
            "last_processed_file"
        ),
        F.col("o_custkey").alias("records_processed"),
        F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("watermark_id"),
    )


_MARKS_SQL = f"""
    SELECT strftime("modificationTime", '%Y-%m-%dT%H:%M:%SZ') AS last_successful_run,
           path AS last_processed_file, length AS records_processed,
           lpad(substr(path, 5, 10), 12, '0') AS watermark_id
    FROM ({ORDER_LISTING_SQL})
"""


def state_latest_mark(spark, sf_dir):
    return latest_mark(_marks(spark, sf_dir))


STATE_LATEST_MARK = f"""
    SELECT * FROM ({_MARKS_SQL}) ORDER BY last_successful_run DESC, watermark_id DESC LIMIT 1
"""


def state_json_roundtrip(spark, sf_dir):
    return from_json_text(to_json_text(_marks(spark, sf_dir)), MARK_SCHEMA)


def state_marks_stored(spark, sf_dir):
    """Marks written as JSON rows and read back; marks without a time do not count."""
    path = scratch_dir(spark, "marks")
    marks = _marks(spark, sf_dir)
    undated = F.col("last_successful_run").startswith("1999")
    marks.withColumn(
        "last_successful_run", F.when(~undated, F.col("last_successful_run"))
    ).write.json(path)
    return read_marks(spark, path)


STATE_MARKS_STORED = f"SELECT * FROM ({_MARKS_SQL}) WHERE last_successful_run NOT LIKE '1999%'"


def _page_failures(spark, sf_dir):
    """Pages as failures: the address as file name, the page as message, a day of the week each."""
    pages = table(spark, sf_dir, "pages")
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.length("url"), F.lit(7)))
    failures = pages.select(
        F.when(F.length("html") > 1000, F.col("url"))
        .otherwise(F.concat(F.col("url"), F.lit("\\x.error")))
        .alias("path"),
        F.lit("ProcessingError").alias("error_type"),
        F.col("html").alias("error_message"),
        F.col("page_id").alias("records"),
        day.alias("day"),
    )
    return failed_rows(failures, F.concat(F.col("day").cast("string"), F.lit("T02:00:00+00:00")), F.col("day"))


def _flat(rows):
    return rows.select(
        "error_type",
        "error_message",
        "record_count",
        F.col("timestamp").alias("logged_at"),
        "original_filename",
        F.col("additional_context.file_key").alias("file_key"),
        F.col("additional_context.exception_type").alias("exception_type"),
        "log_name",
        F.col("failed_date").cast("string").alias("failed_date"),
    )


_FAILURES_SQL = r"""
    SELECT 'ProcessingError' AS error_type, left(html, 1000) AS error_message, page_id AS record_count,
           CAST(day AS VARCHAR) || 'T02:00:00+00:00' AS logged_at, path AS original_filename,
           path AS file_key, 'ProcessingError' AS exception_type,
           CASE WHEN path LIKE '%.error' THEN replace(replace(path, '/', '_'), '\', '_')
                ELSE replace(replace(path, '/', '_'), '\', '_') || '.error' END AS log_name,
           CAST(day AS VARCHAR) AS failed_date
    FROM (SELECT *, CASE WHEN length(html) > 1000 THEN url ELSE url || '\x.error' END AS path,
                 CAST(DATE '2024-01-01' + CAST(length(url) % 7 AS INTEGER) AS DATE) AS day FROM pages)
"""


def failed_log_rows(spark, sf_dir):
    return _flat(_page_failures(spark, sf_dir))


def _stored_failures(spark, sf_dir):
    path = scratch_dir(spark, "failed")
    write_failed_log(_page_failures(spark, sf_dir), path)
    return path


def failed_log_stored(spark, sf_dir):
    return _flat(read_failed_log(spark, _stored_failures(spark, sf_dir)))


def failed_by_date(spark, sf_dir):
    return _flat(read_failed_log(spark, _stored_failures(spark, sf_dir), "2024-01-03"))


def failed_one_file(spark, sf_dir):
    """The log of the file whose name comes last."""
    log = read_failed_log(spark, _stored_failures(spark, sf_dir))
    last = log.agg(F.max("original_filename").alias("f")).first()["f"]
    return _flat(failures_of(log, last))


def log_failure_row(spark, sf_dir):
    """An exception raised on the driver, with the number of orders at stake."""
    path, orders = scratch_dir(spark, "failed"), table(spark, sf_dir, "orders").count()
    log_failure(spark, path, "raw/a.parquet", ValueError("no key"), orders, datetime(2024, 6, 1, 2, tzinfo=timezone.utc))
    return _flat(read_failed_log(spark, path))


LOG_FAILURE_ROW = """
    SELECT 'ValueError' AS error_type, 'no key' AS error_message, count(*) AS record_count,
           '2024-06-01T02:00:00+00:00' AS logged_at, 'raw/a.parquet' AS original_filename,
           'raw/a.parquet' AS file_key, 'ValueError' AS exception_type, 'raw_a.parquet.error' AS log_name,
           '2024-06-01' AS failed_date
    FROM orders
"""


CHECKS = {
    "log_failure_row": (log_failure_row, LOG_FAILURE_ROW),
    "state_latest_mark": (state_latest_mark, STATE_LATEST_MARK),
    "state_json_roundtrip": (state_json_roundtrip, _MARKS_SQL),
    "state_marks_stored": (state_marks_stored, STATE_MARKS_STORED),
    "failed_log_rows": (failed_log_rows, _FAILURES_SQL),
    "failed_log_stored": (failed_log_stored, _FAILURES_SQL),
    "failed_by_date": (failed_by_date, f"SELECT * FROM ({_FAILURES_SQL}) WHERE failed_date = '2024-01-03'"),
    "failed_one_file": (
        failed_one_file,
        f"""SELECT * FROM ({_FAILURES_SQL})
            WHERE original_filename = (SELECT max(original_filename) FROM ({_FAILURES_SQL}))""",
    ),
}
